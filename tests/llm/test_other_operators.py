"""Formatting, packing, search, mixing, classifier and shards."""

import random
import zlib

import duckdb
import numpy as np
import oracle
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import frame, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quillrun.llm import packing, pivot_search
from quillrun.llm.chat_format import rotate_perspectives
from quillrun.llm.hilbert_shards import by_name, by_size, hilbert_index, hilbert_shards, shard_ranges
from quillrun.llm.mixing_query import op5_raked_mixture, raking_sql
from quillrun.llm.model_queries import pack
from quillrun.llm.quality import fit_quality, fit_rows, indicators, keep_good, score_quality, scorer
from quillrun.llm.raking import bounded_chances, calibrated, margin_report, mix_sources, raked_cells

TALK = "conv_id long, turn long, role string, text string, part int, speaker int, assistant int"


def rendered(rows, assistant):
    out = []
    for _, _, role, text in rows:
        who = role or "unknown"
        head = ("assistant" if who == assistant else "system" if who == "system" else f"user name={who}")
        out.append((f"<|im_start|>{head}\n", (text or "") + "<|im_end|>\n", who == assistant))
    return out


def test_perspectives(spark):
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("system", "s"), ("ann", "hé"), ("bob", None), (None, "u"), ("ann", "")])]
    rows += [(2, t, "ann" if t % 2 else "bob", f"long {t}") for t in range(200)]
    rows += [(None, None, "ann", "x"), (3, 0, "system", "only")]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TALK)
    found = {}
    for r in rotate_perspectives(df).collect():
        found.setdefault((r.dialogue, r.assistant), []).append(r)
    assert set(found) == {(1, "ann"), (1, "bob"), (1, "unknown"), (2, "ann"), (2, "bob"), (None, "ann")}
    for (dialogue, who), parts in found.items():
        parts.sort(key=lambda r: (r.part or 0))
        turns = rendered([r for r in rows if r[0] == dialogue], who)
        assert "".join(p.rendered for p in parts) == "".join(a + b for a, b, _ in turns)
        learnt = [p.rendered[s.from_char:s.to_char] for p in parts for s in p.spans]
        assert learnt == [b for _, b, own in turns if own]
        assert max(p.n_turns for p in parts) <= 64


def test_many_turns_of_one_number_and_many_copies_stay_whole(spark):
    rows = [(1, 5, "ann", f"t{i}") for i in range(900)] + [(1, 5, "bob", "same")] * 500
    parts = rotate_perspectives(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TALK)).where("assistant = 'ann'")
    found = parts.collect()
    assert sum(p.n_turns for p in found) == 1400
    assert max(p.n_turns for p in found) <= 300
    assert sum(len(p.spans) for p in found) == 900


def test_no_turns(spark):
    assert rotate_perspectives(spark.createDataFrame([], TALK)).count() == 0


def test_packing_is_a_round_trip(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = list(enumerate(texts)) + [(900, "a<|endoftext|>b  c \n d"), (None, "no id"), (7000, "dup"), (7000, "dup")]
    df = frame(spark, rows).coalesce(1)
    pieces = packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True,
                                    ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                    pattern=public_tokenizers.PATTERN).collect()
    wanted = {}
    for i, t in rows:
        wanted.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    found, room = {}, {}
    for p in pieces:
        assert p.length == len(p.ids) > 0
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes())
        found.setdefault(p.doc_id, []).append(p)
        room.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, ids in wanted.items():
        if len(ids) == 1:
            own = sorted(found[i], key=lambda p: p.start)
            assert [x for p in own for x in p.ids] == ids[0]
            assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
            assert {p.doc_tokens for p in own} == {len(ids[0])}
    total = sum(len(x) for ids in wanted.values() for x in ids)
    assert sum(p.length for p in pieces) == total
    for used in room.values():
        used.sort()
        assert [o for o, _ in used] == np.cumsum([0] + [n for _, n in used])[:-1].tolist()
        assert sum(n for _, n in used) <= 2048
    assert len(room) == -(-total // 2048)


def test_packing_of_millions_of_blanks(spark):
    files = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")]
    tokenizer = Tokenizer.from_file(files[0])
    texts = [" " * 2_000_000, "a" + "\n" * 1_500_000, " \t" * 600_000 + "z", "one  two"]
    encode = packing.Encoder(*files, public_tokenizers.PATTERN)
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(encode(t), "<u4").tolist() for t in texts] == wanted
    pieces = pack(frame(spark, list(enumerate(texts)))).collect()
    for i, ids in enumerate(wanted):
        own = [p for p in pieces if p.doc_id == i]
        assert sum(p.length for p in own) == len(ids) + 1 == own[0].doc_tokens


def test_packing_goes_to_the_cheapest_sequence_with_room():
    pieces = packing.assign(np.array([60, 50, 40, 30, 20]), 100, 1.0, 0.01)
    # 60 | 50, then 40 and 30 go to the cheaper one with room; 20 fits neither whole and is cut
    assert pieces == [(0, 0, 60, 0, 0), (1, 0, 50, 1, 0), (2, 0, 40, 1, 50), (3, 0, 30, 0, 60),
                      (4, 0, 10, 1, 90), (4, 10, 10, 0, 90)]
    many = np.random.default_rng(1).integers(1, 2048, 800)
    pieces = packing.assign(many, 2048, 1.0, 1 / 2048)
    cost, used = np.zeros(4000), np.zeros(4000, dtype=int)
    for _, _, n, s, o in pieces:
        assert o == used[s]
        used[s] += n
        cost[s] += n + n * n / 2048
    assert used.max() <= 2048 and (used > 0).sum() == -(-many.sum() // 2048)
    assert len(pieces) < 1.5 * len(many)


def test_packing_without_documents(spark):
    assert pack(frame(spark, [])).count() == 0
    assert [(p.start, p.length) for p in pack(frame(spark, [(1, None)])).collect()] == [(0, 1)]


def brute_top(rows, k=20):
    def whole(v):
        return [int(np.floor(64 * float(x))) for x in v]

    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok.setdefault((i, tuple(v)), whole(v))
    out = []
    for (q, qv), a in ok.items():
        if q % 20 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for (i, v), b in ok.items()
                           if i != q and len(b) == len(a))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def test_exact_search_with_odd_vectors(spark, monkeypatch):
    pick = random.Random(2)
    monkeypatch.setattr(pivot_search, "SLICE", 64)
    monkeypatch.setattr(pivot_search, "QUERY_BLOCK", 4)
    rows = [(i, [pick.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [rows[5], rows[20], rows[20]]
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8),
             (None, rows[0][1]), (460, [1.0, 2.0]), (461, [3.0, 4.0]), (462, []), (480, []), (20, [0.5] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, hash int, rank int")
    found = pivot_search.pivot_search(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in found) == brute_top(rows)


def test_search_is_exact_for_large_numbers_and_stops_early(spark):
    rows = [(i, [2.0 ** 30 + i, 1.0 - i]) for i in range(0, 60, 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = pivot_search.pivot_search(df, F.col("vec_id") % 20 == 0, scale=1.0).collect()
    wanted = [(q, r + 1, i, s) for q, a in rows if q % 20 == 0 for r, (s, i) in enumerate(
        [(-n, i) for n, i in sorted((-sum(int(x) * int(y) for x, y in zip(a, b)), i) for i, b in rows if i != q)][:20])]
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert pivot_search.pivot_search(df.where("vec_id < 0"), F.lit(True)).count() == 0


def test_bounds_hold_and_leave_candidates_out():
    pick = np.random.default_rng(3)
    centres = pick.normal(size=(6, 16)) * 60
    ints = np.floor(centres[np.arange(600) % 6] + pick.normal(size=(600, 16)))
    points = ints[:pivot_search.PIVOTS]
    distances = np.stack([np.sqrt(((ints - p) ** 2).sum(axis=1)) for p in points]).astype(np.float32)
    block = (np.arange(600), np.zeros(600, np.int64), ints, (ints * ints).sum(axis=1), distances)
    found = pivot_search.search_slice(block, block, 5)
    scores = ints @ ints.T
    np.fill_diagonal(scores, -np.inf)
    for q, own in found.groupby("query_id"):
        assert own["score"].tolist() == (-np.sort(-scores[q]))[:5].tolist()


TARGETS = {"src0": 0.5, "src1": 0.2, "src2": 0.2}


def test_raking_matches_a_plain_loop(spark):
    pick = random.Random(5)
    cells = [(a, b, float(pick.randint(1, 50))) for a in ("src0", "src1", "(other)") for b in ("en", "de")]
    goals = [TARGETS, {"en": 0.3, "de": 0.7}]
    found = {(r.a, r.b): r.share for r in raked_cells(
        spark.createDataFrame(cells, "a string, b string, tokens double"), ["a", "b"], goals, 40).collect()}
    share = {(a, b): t for a, b, t in cells}
    for _ in range(40):
        for axis, goal in enumerate(goals):
            left = (1 - sum(goal.values())) / 2
            for name in {k[axis] for k in share}:
                own = sum(v for k, v in share.items() if k[axis] == name)
                for k in share:
                    if k[axis] == name:
                        share[k] *= goal.get(name, left) / own
    total = sum(share.values())
    assert all(abs(found[k] - v / total) < 1e-9 for k, v in share.items())


def test_plain_mixture(spark, texts, docs):
    margins = {"source": (F.col("source"), TARGETS), "lang": (F.col("lang"), {"en": 0.6, "de": 0.4})}
    rows = calibrated(docs, margins, 0.4, whole=False).collect()
    assert len(rows) == len(texts)
    assert all(r.probability == 0 for r in rows if not r.tokens)
    assert all(r.kept == (r.drawn < r.probability) for r in rows)
    # nulls and unlisted names have no share of a margin that the targets use up
    assert all(r.probability == 0 for r in rows if r.row.lang is None)
    kept = mix_sources(docs, margins, 0.4, whole=False)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.row.doc_id for r in rows if r.kept)
    assert mix_sources(docs.where("doc_id < 0"), margins, 0.4, whole=False).count() == 0
    with pytest.raises(ValueError, match="cells"):
        mix_sources(docs, {"a": (F.col("lang"), {str(i): 0.001 for i in range(200)}),
                           "b": (F.col("source"), {str(i): 0.001 for i in range(200)})}, 0.4)


def test_bounded_raking_meets_its_margins():
    pick = np.random.default_rng(4)
    codes = [np.repeat(np.arange(4), 5), np.tile(np.arange(5), 4)]
    tokens = pick.integers(50, 1000, 20).astype(float)
    targets = [np.array([0.55, 0.15, 0.15, 0.15]), np.array([0.3, 0.3, 0.2, 0.1, 0.1])]
    chances = bounded_chances(tokens, codes, targets, 0.5 * tokens.sum())
    drawn = chances * tokens
    assert (chances == 1).any() and chances.max() <= 1 and chances.min() > 0
    assert abs(drawn.sum() - 0.5 * tokens.sum()) < 1e-6 * tokens.sum()
    for code, target in zip(codes, targets):
        assert np.allclose(np.bincount(code, drawn) / drawn.sum(), target, atol=1e-6)
    # cells that are not full are products of one factor per category, as in plain raking
    free = chances < 1
    rows, cols = codes[0][free], codes[1][free]
    design = np.zeros((free.sum(), 9))
    design[np.arange(free.sum()), rows] = design[np.arange(free.sum()), 4 + cols] = 1
    logs = np.log(chances[free])
    fit = design @ np.linalg.lstsq(design, logs, rcond=None)[0]
    assert free.sum() > 9 and np.allclose(fit, logs, atol=1e-4)


def test_what_full_cells_lack_goes_to_others_and_missed_goals_are_named(spark, sf_dir):
    rows = [(i, prose(i, 50), "en" if i % 10 else "de", "src0" if i % 4 == 0 else f"src{1 + i % 3}")
            for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    margins = {"source": (F.col("source"), {f"src{i}": 0.25 for i in range(4)}),
               "lang": (F.col("lang"), {"en": 0.5, "de": 0.5})}
    with pytest.warns(UserWarning, match="lang de 0.2000 of 0.5000"):
        found = calibrated(df, margins, 0.5, whole=True).collect()
    drawn = sum(r.probability * r.tokens for r in found)
    assert abs(drawn - 0.5 * sum(r.tokens for r in found)) < 1e-6 * drawn
    assert all(r.kept for r in found if r.row.lang == "de")
    report = {(r.margin, r.category): r for r in margin_report(df, margins, 0.5).collect()}
    assert not report["lang", "de"].reached and not report["lang", "en"].reached
    assert all(report["source", f"src{i}"].reached for i in range(4))


def test_the_query_draws_its_budget_from_all_names(spark, folder):
    langs, sources = ["en", "en", "en", "de", "it", None, "fr", "xx"], ["src0", "src3", "web", None, "src7"]
    rows = [(i, None if i % 97 == 5 else prose(i, 5 + i % 60), langs[i * (i + 1) // 2 % 8], sources[i % 5], 0) for i in range(600)]
    path = f"{folder}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    found = op5_raked_mixture(spark, folder)
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert not oracle.compare(found, base, raking_sql())
    held = found.collect()
    expected = sum(r.tokens * r.probability for r in held)
    assert abs(expected / sum(r.tokens for r in held) - 0.5) < 1e-4
    assert all((r.probability > 0) == (r.tokens > 0) for r in held)
    shares = {lang: sum(r.tokens * r.probability for r in held if r.lang == lang) / expected
              for lang in ("(other)", "(none)")}
    own = {lang: sum(r.tokens for r in held if r.lang == lang) / sum(r.tokens for r in held) for lang in shares}
    # at least their own share of the tokens: the named ones that have no documents leave theirs to all
    assert all(shares[k] > own[k] - 1e-3 for k in shares)


def test_the_pipeline_draws_from_categories_that_no_target_names(spark, sf_dir):
    rows = [(i, prose(i, 40), lang, source, 0) for i, (lang, source) in enumerate(
        [("en", "src0"), ("it", "src1"), (None, "web"), ("de", None)] * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {}
    for r in corpus_pipeline.mixture(spark, df, sf_dir).collect():
        kept[r.lang] = kept.get(r.lang, 0) + 1
    assert set(kept) == {"en", "it", None, "de"} and 150 < sum(kept.values()) < 250
    fifth = corpus_pipeline.mixture(spark, df.where("lang = 'it'"), sf_dir).count()
    assert 30 < fifth < 70


def test_classifier_on_rows_it_has_not_seen(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    labels = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/labels.parquet")
    learnt, unseen = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    model = fit_quality(docs, learnt)
    rows = score_quality(docs, model).join(unseen.withColumnRenamed("doc_id", "id"), "id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.98
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == score_quality(docs, model).where("predicted = 1").count()


def test_classifier_with_little_to_learn_from(spark, texts, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score_quality(docs, fit_quality(docs, labels)).collect()} == {0.5}
    one = spark.createDataFrame([(0, 1), (1, 1), (2, None), (None, 0), (77_000, 0)], "doc_id long, quality int")
    rows = score_quality(docs, fit_quality(docs, one)).collect()
    assert len(rows) == len(texts) and {r.score for r in rows} == {0.75}
    assert score_quality(docs.where("doc_id < 0"), fit_quality(docs, labels)).count() == 0
    repeated = frame(spark, [(1, "good words here")] * 9 + [(2, "BAD!! BAD!! BAD!!")] * 9)
    both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert score_quality(repeated, fit_quality(repeated, both)).count() == 18


def test_indicators_stay_within_a_text():
    alone = [next(indicators(pa.array([t]))) for t in ("abc def ghi jkl", "", "xyz XYZ !!!")]
    together = list(indicators(pa.array(["abc def ghi jkl", None, "xyz XYZ !!!"])))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(alone, together))
    model = fit_rows(alone[::2] * 6, np.array([1, 0] * 6))
    scores = scorer(model)(pa.array(["abc def ghi jkl", "xyz XYZ !!!"]))
    assert scores[0] > 0.5 > scores[1]


def test_hilbert_curve_steps_to_neighbours(spark):
    axes = [F.expr(f"cast(id div {16 ** i} % 16 as int)").alias(f"a{i}") for i in range(3)]
    cells = spark.range(16 ** 3).select(*axes).withColumn("h", hilbert_index(["a0", "a1", "a2"], 4)).collect()
    order = sorted(cells, key=lambda r: r.h)
    assert [r.h for r in order] == list(range(16 ** 3))
    assert all(sum(abs(a[i] - b[i]) for i in range(3)) == 1 for a, b in zip(order, order[1:]))


def shards_of(df, count=40):
    dims = {"source": by_name("source"), "lang": by_name("lang"), "n": by_size(F.col("n_chars"))}
    return hilbert_shards(df, count, dims)


def test_shards(spark, texts, docs):
    rows = shards_of(docs, 7).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r.id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    check_law(rows, 7, len(texts))
    assert max(r.curve_index for r in rows if r.shard == 0) <= min(r.curve_index for r in rows if r.shard == 6)


def check_law(rows, shards, total):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    if total >= shards:
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == shards


def test_shards_of_hot_groups_and_odd_rows(spark, monkeypatch):
    from quillrun.llm import hilbert_shards as module

    monkeypatch.setattr(module, "ROWS_PER_BUCKET", 16)
    rows = [(i, "same") for i in range(300)] + [(None, None)] * 5 + [(4, "same")] * 3 + [(1000 + i, f"t{i}") for i in range(90)]
    found = shards_of(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    check_law(found, 40, len(rows))
    assert shards_of(frame(spark, [])).count() == 0
    check_law(shards_of(frame(spark, rows[:3])).collect(), 40, 3)
    assert shard_ranges(shards_of(frame(spark, rows)), ["curve_index"]).count() == 40
