import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from conftest import CLASHES, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillrun.llm import manifest_query, norm_buckets, token_files
from quillrun.llm.merkle import build_manifest, folded, leaf_digest, proof_digest, proofs
from quillrun.llm.norm_buckets import Best, ranked_search
from quillrun.session import fresh_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


# --- Merkle manifest ---------------------------------------------------------------------------


def checked_proofs(spark, rows, claimed=None, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit(7) for c in [*CLASHES, "tree", "group", "node", "members", "level0", "path"]})
    manifest = build_manifest(df, manifest_query.FIELDS, claimed=claimed)
    return manifest, proofs(manifest).withColumns({
        "proof": proof_digest(F.col("path")), "folded": folded(F.coalesce("claimed", "leaf"), F.col("path"))})


def plain_manifest(rows):
    return brute.manifest([(i, lang, (i, source, lang, n, text)) for i, text, lang, source, n in rows])


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 9}, {"en": 513, "é": 65, "de": 1}, {"en": 5000, None: 2}])
def test_proofs_agree_with_a_plain_tree(spark, sizes):
    rows = [(n, f"text {n} of {lang}" if n % 7 else None, lang, None if n % 3 else "src", n)
            for lang, size in sizes.items() for n in range(size)]
    random.Random(3).shuffle(rows)
    manifest, found = checked_proofs(spark, rows)
    wanted = plain_manifest(rows)
    plain = {(rows[n][0], w[0]): (w[1], w[2], w[3], brute.digest(*[d for a, b in w[4] for d in a + b]), w[3])
             for n, w in wanted.items()}
    got = {(r.id, r.group): (r.leaf, r.subroot, r.root, r.proof, r.folded) for r in found.collect()}
    assert got == plain
    assert {r.group: r.n_rows for r in manifest.groups.collect()} == sizes


def test_a_changed_row_fails_and_only_it(spark):
    rows = [(n, f"Text {n}", "en" if n % 5 else None, "s", n) for n in range(700)]
    changed = leaf_digest([F.col(c) for c in manifest_query.FIELDS[:-1]] + [F.lower("text")])
    _, found = checked_proofs(spark, rows, F.when(F.col("doc_id") % 100 == 3, changed), extra=True)
    bad = {r.id for r in found.where(F.col("folded") != F.col("root")).collect()}
    assert bad == set(range(3, 700, 100))


def test_manifest_of_odd_rows(spark, texts):
    rows = [(None if n % 4 == 0 else n // 3, t, ["en", None, ""][n % 3], None, None) for n, t in enumerate(texts)]
    rows += rows[:5] * 40 + [(1, "x" * 2_000_000, "en", "s", 1)]
    _, found = checked_proofs(spark, rows)
    got = sorted((r.leaf, r.subroot, r.root, r.proof) for r in found.collect())
    assert got == sorted((w[1], w[2], w[3], brute.digest(*[d for a, b in w[4] for d in a + b]))
                         for w in plain_manifest(rows).values())


def test_manifest_of_no_rows(spark):
    manifest, found = checked_proofs(spark, [])
    assert manifest.root is None and found.count() == 0


def test_a_group_that_holds_nearly_all_rows_is_dealt_out(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"),
                                      F.when(F.col("id") % 50 == 0, "de").otherwise("en").alias("lang"))
    manifest = build_manifest(rows, ["doc_id", "lang", "text"])
    assert manifest.rounds[0].agg(F.max(F.size("members"))).first()[0] == 512
    assert proofs(manifest).where(folded(F.col("leaf"), F.col("path")) == F.col("root")).count() == 20_000


# --- token files -------------------------------------------------------------------------------


def whole_encoding(rows):
    tokenizer, start, out = Tokenizer.from_file(WORD_BPE), 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def word_ids():
    return token_files.WordIds(WORD_BPE)


ODD = st.sampled_from(["'s", "'T", "re", " ", "\n", "\x85", "\xa0", "\x1c", "é", "é", "É", "İ", "ß", "²", "Σ", "ǅ",
                       "<|endoftext|>", "<|", "|>", "漢", "​", "\t", "\r\n", "ﬁ", "9", "A", "\x7f", "\xad"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(ODD, st.characters(exclude_categories=["Cs"])), max_size=12).map("".join))
def test_ids_by_word_are_those_of_the_text(word_ids, text):
    whole = word_ids.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(word_ids.of_text(text), dtype="<u4").tolist() == whole


CUTS = ["'s", "'t", "'re", "'ve", "'ll", "'l", "'", "''", "!", "s", "re", "É", "ª", "²", "9", " ", "\n", "\x85", "\xa0", "\x1c",
        "漢", "Σ", "<|endoftext|>", "don't", "l'été"]


def test_texts_encoded_together_are_those_encoded_alone(word_ids):
    pick = random.Random(4)
    texts = ["", "漢", "'"] + ["".join(pick.choices(CUTS, k=pick.randrange(12))) for _ in range(600)]
    got = [np.frombuffer(ids, dtype="<u4").tolist() for ids in word_ids.of_texts(texts)]
    assert got == [word_ids.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert word_ids.of_texts([]) == []


def test_a_very_long_text_is_encoded_in_parts(word_ids, monkeypatch):
    monkeypatch.setattr(token_files, "CHARS_AT_ONCE", 10)
    pick, parts = random.Random(5), []
    monkeypatch.setattr(word_ids, "_latin", lambda runs: parts.extend(runs) or type(word_ids)._latin(word_ids, runs))
    texts = ["".join(pick.choices(CUTS, k=60)) for _ in range(100)] + ["1" * 99, "x" * 99, "don't " * 9, "漢 " + "ab " * 30]
    got = [np.frombuffer(ids, dtype="<u4").tolist() for ids in word_ids.of_texts(texts)]
    assert got == [word_ids.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert parts.count("1" * 10) == 9 and "x" * 99 in parts


def test_a_piece_is_looked_up_once_for_many_texts():
    words, asked = token_files.WordIds(WORD_BPE), []
    words.pieces = type("Pieces", (), {"__getitem__": lambda self, piece: asked.append(piece) or b"\0\0\0\0"})()
    words.of_texts(["To be, or not to be.", "To be or not 22", "ÊTRE ou ne pas être", "漢 to be"])
    assert sorted(asked) == sorted(set(asked)) and {"to", "be", ",", ".", "2", "être"} <= set(asked)


def test_small_batches_meet_and_long_texts_go_alone(monkeypatch):
    monkeypatch.setattr(token_files, "CHARS_AT_ONCE", 100)
    texts = ["a b " * n for n in (1, 2, 3, 200, 1, 1, 0)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [n], "text": [t]}) for n, t in enumerate(texts)]
    sizes = [b.num_rows for b in token_files._joined(iter(batches))]
    assert sum(sizes) == len(texts) and len(sizes) == 3 and sizes[1] == 1
    assert list(token_files._joined(iter([]))) == []


def test_forgotten_words_come_back_alike(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS_KEPT", 8)
    words = token_files.WordIds(WORD_BPE)
    text = prose(5, 400) + " " + "long" * 40 + " 漢字 " + prose(5, 400)
    assert np.frombuffer(words.of_text(text), "<u4").tolist() == words.tokenizer.encode(
        text, add_special_tokens=False).ids
    assert len(words.pieces) <= 8


def test_a_word_is_not_merged_again_after_half_a_million_others():
    merged = []
    kept = token_files.Kept(lambda word: merged.append(word) or [int(word)])
    for i in range(600_000):
        kept[str(i)]
    assert kept["0"] == (0).to_bytes(4, "little") and len(merged) == 600_000


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_hold_what_the_tokenizer_gives(spark, docs, texts, encoding):
    path = fresh_dir(spark, "tokens")
    token_files.write_token_files(docs.repartition(5), path, WORD_BPE, 2, encoding, page_rows=8)
    tokens = token_files.read_tokens(spark, path)
    got = sorted(map(tuple, token_files.checksums(tokens).collect()))
    assert got == whole_encoding(enumerate(texts))
    assert [r.position for r in tokens.orderBy("doc_id").collect()] == list(range(len(texts)))
    assert tokens.select("meta.id", "meta.Text_", "meta.lang").count() == len(texts)
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in spark.read.parquet(f"{path}/tokens").inputFiles()]
    used = {e for f in files for g in range(f.num_row_groups)
            for c in range(f.metadata.num_columns) if f.metadata.row_group(g).column(c).path_in_schema.startswith("ids")
            for e in f.metadata.row_group(g).column(c).encodings}
    assert ("DELTA_BINARY_PACKED" in used) == (encoding == "delta")
    assert any("DICTIONARY" in e for e in used) == (encoding == "dictionary")
    assert all(f.metadata.row_group(g).column(0).has_column_index for f in files for g in range(f.num_row_groups))


def test_repeated_null_and_hot_ids_are_dealt_out(spark, texts):
    rows = [(None if n % 3 == 0 else 7, t) for n, t in enumerate(texts)] * 3
    path = fresh_dir(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows would fit one task
    try:
        token_files.write_token_files(frame(spark, rows).repartition(4), path, WORD_BPE, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = token_files.checksums(token_files.read_tokens(spark, path)).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in found), key=lambda i: (i is not None, i))
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert sorted((r.n_tokens, r.ids_crc32) for r in found) == sorted((n, c) for _, _, n, c in whole_encoding(rows))
    assert token_files.read_shards(spark, path).agg(F.max("n_docs")).first()[0] < len(rows) / 3


def test_reading_in_part(spark, docs, texts):
    path = fresh_dir(spark, "tokens")
    token_files.write_token_files(docs, path, WORD_BPE, 2, page_rows=4)
    whole = token_files.read_tokens(spark, path).orderBy("start").collect()
    stream = [i for r in whole for i in r.ids]
    for first, length in ((0, 1), (5, 900), (len(stream) - 3, 50), (100, 0), (len(stream) + 9, 5)):
        got = token_files.read_stretch(spark, path, first, length).orderBy("start").collect()
        assert [i for r in got for i in r.ids] == stream[first:first + length]
    some = token_files.read_tokens(spark, path, 10, 12)
    assert sorted(r.doc_id for r in some.collect()) == [10, 11, 12]
    assert "GreaterThanOrEqual(doc_id,10)" in some._jdf.queryExecution().executedPlan().toString()
    known = token_files.read_metadata(spark, path).select("doc_id", "start", "meta.lang")
    assert "ids" not in known._jdf.queryExecution().executedPlan().toString().replace("doc_id", "")
    assert sorted((r.doc_id, r.start) for r in known.collect()) == sorted((r.doc_id, r.start) for r in whole)


def test_token_files_of_no_rows(spark):
    path = fresh_dir(spark, "tokens")
    token_files.write_token_files(frame(spark, []), path, WORD_BPE, 2)
    assert token_files.checksums(token_files.read_tokens(spark, path)).count() == 0


# --- ranked search -----------------------------------------------------------------------------


def search(spark, items, rows, **options):
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("item", "terms")})
    found = ranked_search(asked, frame(spark, rows), **options)
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()),
                  key=lambda r: (str(r[0]), r[1]))


def by_item(found):
    return sorted(found, key=lambda r: (str(r[0]), r[1]))


@pytest.mark.parametrize("bucket", [4, 1024])
def test_ranking_agrees_with_a_plain_one(spark, texts, monkeypatch, bucket):
    monkeypatch.setattr(norm_buckets, "BUCKET", bucket)
    rows = [(n, t) for n, t in enumerate(texts)] + [(200, "Ünïcode straße 漢字 x2"), (201, "x" * 3_000_000)]
    items = [(1, texts[0][:200]), (2, "one Two ab"), (3, None), (4, "zzz"), (5, ""), (6, "ÜNÏCODE straße"), (7, texts[15])]
    assert search(spark, items, rows) == by_item(brute.ranked(items, rows))


def test_ties_repeated_rows_and_null_ids(spark):
    rows = [(5, "red fox")] * 14 + [(None, "red fox"), (3, "red fox"), (4, "blue fox"), (9, None), (8, "")]
    items = [(1, "red red RED"), (2, "fox-red"), (None, "blue")]
    assert search(spark, items, rows) == by_item(brute.ranked(items, rows))
    assert search(spark, items, rows, k=30) == by_item(brute.ranked(items, rows, 30))


def test_blocks_of_items_give_the_same_ranking(spark, texts):
    rows = list(enumerate(texts))
    items = [(n, prose(n, 12)) for n in range(30)]
    assert search(spark, items, rows, terms_in_block=40) == by_item(brute.ranked(items, rows))


def test_search_over_empty_tables(spark):
    assert search(spark, [], [(1, "a")]) == [] == search(spark, [(1, "a")], [])


def test_a_score_at_the_floor_is_kept():
    best = Best(2, 10)
    best.add(np.array([9, 10, 10, 11]), np.array([1, 7, 4, 9]), np.zeros(4, bool))
    assert best.score.tolist() == [11, 10] and best.doc.tolist() == [9, 4]


def test_short_buckets_are_left_out():
    """Vectors too short for the k-th best score are never added up."""
    best = Best(1, 100)
    term, impact = np.array([0, 1, 0, 1]), np.array([80, 60, 3, 4])
    postings = norm_buckets._postings(np.array([0, 2, 4]), term, impact)
    seen = []
    best.add = lambda score, doc, none: seen.append(doc.tolist())
    norm_buckets._search_bucket(best, np.array([0, 1]), np.array([0]), np.array([100.0, 5.0]), postings,
                                np.array([10, 11]), np.zeros(2, bool))
    assert seen == [[10]]


# --- mended in the same round ------------------------------------------------------------------


def test_equal_vectors_are_candidates_each(spark):
    from quillrun.llm.pivot_search import pivot_search

    rows = [(20, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0])]
    found = pivot_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3),
                         F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in found.collect()) == [(20, 1, 1, 4096), (20, 2, 1, 4096), (20, 3, 2, 2048)]


def test_one_table_gives_one_model_however_it_is_laid_out(spark):
    from quillrun.llm.quality import fit_quality

    rows = [(n % 40, prose(n, 30) if n % 2 else "!! " + prose(n, 5)) for n in range(160)]  # ids come again
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)] + [(3, 0)], "doc_id long, quality int")
    models = [fit_quality(d, lab) for d, lab in ((docs, labels), (docs.repartition(7), labels.repartition(3)),
                                                 (docs.orderBy(F.desc("text")), labels.orderBy("quality")))]
    assert models[0] == models[1] == models[2] and models[0]["weights"]
    fewer = fit_quality(docs, labels, budget=300)
    assert fewer["weights"] and fewer != models[0]


def test_a_column_named_like_the_row_key_stays(spark):
    from quillrun.llm.jaccard_join import one_row_per_class

    docs = frame(spark, [(1, prose(1, 60)), (2, prose(1, 60)), (3, prose(2, 60))], extra=False).withColumn(
        "__Row_Key", F.col("doc_id") * 10)
    kept = one_row_per_class(docs)
    assert kept.columns == docs.columns and sorted(r["__Row_Key"] for r in kept.collect()) == [10, 30]


def test_what_is_left_of_repeats_is_returned(spark, sf_dir):
    from quillrun.llm.repeat_queries import op8_repeated_strings

    rows = op8_repeated_strings(spark, sf_dir)
    assert rows.where("n_kept <> n_bytes - n_removed").count() == 0
    assert rows.where("n_removed = 0 AND sha2(kept_text, 256) <> kept_sha256").count() == 0
