import random
import sys
import pathlib

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

WORDS = [a + b for a in ("ba", "ke", "lo", "mi", "nu", "ra", "so", "ti") for b in ("n", "r", "st", "v", "", "x")]
CLASHES = ["id", "row", "digest", "maybe", "kept", "key", "n", "at", "rank", "tokens", "probability",
           "drawn", "shard", "score", "size", "place", "bitmap_bits1", "doc_id_", "Text_", "__row_key"]


def prose(seed, count):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(count))


def edited(text, seed, edits):
    pick, found = random.Random(seed), text.split(" ")
    for _ in range(edits):
        found[pick.randrange(len(found))] = pick.choice(WORDS) + "q"
    return " ".join(found)


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, shared passages, odd spaces, empty, null and long texts."""
    base, passage = prose(1, 300), prose(2, 120)
    rows = [base, base, base.upper(), "  ".join(base.split(" ")), None, "", " \t\n", "one two", "One Two",
            "one\x0btwo", "é ß", "É ß", prose(3, 4), prose(4, 5), prose(5, 6), prose(6, 20_000)]
    rows += [edited(base, s, s) for s in range(1, 40)]
    rows += [prose(100 + s, 40) + "\n" + passage + "\n" + prose(200 + s, 40) for s in range(12)]
    rows += [prose(300 + s, 30) for s in range(30)] + ["ab " * 400, "ab " * 400 + "c", "x" * 900]
    return rows


@pytest.fixture()
def docs(spark, texts):
    return frame(spark, list(enumerate(texts)))


def frame(spark, rows, extra=True):
    """A documents table; with ``extra``, columns whose names operators might use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, ["en", "de", None][(i or 0) % 3], f"src{(i or 0) % 4}", len(t) if t is not None else None)
            for i, t in rows]
    df = spark.createDataFrame(full, schema)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(7) for c in CLASHES})
    return df
