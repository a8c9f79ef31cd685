"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re

SPACE = "\x20\x09-\x0d"


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text, width=5):
    found = re.findall(f"[^{SPACE}]+", lower(text))
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i:i + width]) for i in range(len(found) - width + 1)}


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def jaccard_classes(rows, percent=75):
    """(position -> set size, positions linked) of a list of texts."""
    sets = [shingles(t) for t in rows]
    union = Union(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                union.join(i, j)
    return [len(s) for s in sets], [union.find(i) for i in range(len(rows))]


def removed(texts, length=400):
    """(bytes, removed, spans, sha256 of what is left) per text."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p:p + length]] = seen.get(d[p:p + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                gone[p:p + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def kept_lines(rows, need=3, words=50):
    """Lines left of (id, text) rows in order of id; every run judged on the input, whatever its length."""
    lines = [(t or "").split("\n") for _, t in rows]
    first, gone = {}, [set() for _ in rows]
    for r, own in enumerate(lines):
        counts = [len(re.findall(f"[^{SPACE}]+", line)) for line in own]
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                if j - i < need and sum(counts[i:j]) < words:
                    continue
                run = tuple(own[i:j])
                if run in first:
                    gone[r].update(range(i, j))
                else:
                    first[run] = (r, i)
    return [[line for i, line in enumerate(own) if i not in gone[r]] for r, own in enumerate(lines)]


def exact_groups(rows):
    """keep_id and group size per (id, text) row; ids unique."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(f"[{SPACE}]", "", text or ""), []).append((-len(text or ""), doc_id))
    return {doc_id: (min(members)[1], len(members), hashlib.sha256(key.encode()).hexdigest())
            for key, members in groups.items() for _, doc_id in members}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields):
    return digest(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(nodes):
    """Root of a list of digests, and the siblings of each, level by level."""
    siblings = [[] for _ in nodes]
    own = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        grown, holders = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a:a + 8]
            for j, members in enumerate(own[a:a + 8]):
                for i in members:
                    siblings[i].append((run[:j], run[j + 1:]))
            grown.append(digest(*run))
            holders.append([i for members in own[a:a + 8] for i in members])
        nodes, own = grown, holders
    return nodes[0] if nodes else None, siblings


def manifest(rows, fields=lambda r: r):
    """(group, leaf, subroot, root, siblings) per row number; a row is (id, group, fields)."""
    groups = {}
    for n, (doc_id, group, own) in enumerate(rows):
        groups.setdefault(group, []).append(((doc_id is not None, doc_id or 0), leaf(own), n))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found, tops = {}, []
    for group in order:
        members = sorted(groups[group])
        top, siblings = tree([m[1] for m in members])
        tops.append(top)
        for (_, own, n), path in zip(members, siblings):
            found[n] = [group, own, top, path]
    root, over = tree(tops)
    for n in found:
        group, own, top, path = found[n]
        found[n] = (group, own, top, root, path + over[order.index(group)])
    return found


def terms(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", lower(text))


def ranked(items, docs, k=10):
    """[(item_id, rank, doc_id, score)] of lists of (id, text)."""
    import math
    from collections import Counter

    counts = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    n_docs, total = sum(1 for s in sizes if s), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), own, n in zip(docs, counts, sizes):
            score = 0
            for t in set(terms(text)):
                if t in own:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 10 + 90 * n * n_docs // total
                    score += w * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, None if none else doc_id, -score))
    return out
