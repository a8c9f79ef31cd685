import datetime
import json

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillrun import schema as js
from quillrun.functions import requests as rq
from quillrun.functions import responses as rs
from quillrun.functions import text as tx
from quillrun.functions.payload import NULL, render, text_slot

PLAIN = st.text(st.characters(exclude_categories=["Cs"]), max_size=30)


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema) \
        .select(column.alias("x")).first()["x"]


def body(spark, column, text="Hello \"you\"\n"):
    return json.loads(one(spark, column, id=("string", "r1"), text=("string", text)))


@pytest.fixture(autouse=True)
def columns(spark):
    """Columns need a running session."""
    global TEXT, ID
    TEXT, ID = F.col("text"), F.col("id")


def test_template_drops_none_keeps_null_and_whole_numbers(spark):
    got = one(spark, render({"a": None, "b": NULL, "c": 1.0, "d": [True, 0.25], "e": text_slot(TEXT)}),
              text=("string", "é"))
    assert got == '{"b":null,"c":1,"d":[true,0.25],"e":"é"}'


@settings(max_examples=20, deadline=None)
@given(st.lists(PLAIN.filter(bool), min_size=1, max_size=20))
def test_any_text_survives_a_payload(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = rows.select("i", rq.chat_request(TEXT, system_prompt='a "b"').alias("r")).collect()
    assert [json.loads(r["r"])["messages"][1]["content"] for r in sorted(found)] == texts


def test_request_bodies(spark):
    assert body(spark, rq.inference_request(TEXT, rq.classify_parameters())) == {
        "inputs": "Hello \"you\"\n",
        "parameters": {"return_all_scores": True, "truncation": True, "max_length": 512}}
    assert body(spark, rq.embedding_request(TEXT, dimensions=8))["dimensions"] == 8
    chat = body(spark, rq.chat_request(TEXT))
    assert chat["messages"] == [{"role": "user", "content": "Hello \"you\"\n"}]
    assert "response_format" not in chat and chat["temperature"] == 0
    messages = body(spark, rq.messages_request(TEXT, system_prompt="p"))
    assert messages["system"] == [{"type": "text", "text": "p",
                                   "cache_control": {"type": "ephemeral"}}]
    assert list(messages) == ["model", "messages", "max_tokens", "temperature", "system"]
    entry = body(spark, rq.messages_batch_entry(ID, TEXT, system_prompt="p"))
    assert entry["params"]["system"] == "p"
    assert entry["params"]["cache_control"] == {"type": "ephemeral"}
    assert "system" not in body(spark, rq.messages_batch_entry(ID, TEXT))["params"]


def test_batch_lines(spark):
    line = body(spark, rq.embedding_batch_line(ID, TEXT))
    assert (line["custom_id"], line["method"], line["url"]) == ("r1", "POST", "/v1/embeddings")
    assert "dimensions" not in line["body"]
    line = body(spark, rq.chat_batch_line(ID, TEXT, temperature=0.7, max_tokens=1000))
    assert line["body"]["temperature"] == 0.7 and line["body"]["max_tokens"] == 1000
    named = js.JsonSchema("sentiment_schema", js.object_(s=js.string()))
    line = body(spark, rq.chat_batch_line(ID, TEXT, schema=named))
    assert line["body"]["response_format"]["json_schema"]["name"] == "sentiment_schema"


def test_no_request_without_text(spark):
    for missing in ("", None):
        assert one(spark, rq.chat_request(TEXT), text=("string", missing)) is None


def test_parameter_checks():
    with pytest.raises(ValueError, match="from 0 to 2"):
        rq.chat_request(TEXT, temperature=2.5)
    with pytest.raises(ValueError, match="from 0 to 1"):
        rq.messages_request(TEXT, temperature=1.5)
    with pytest.raises(ValueError, match="max_tokens"):
        rq.chat_request(TEXT, max_tokens=0)
    with pytest.raises(TypeError, match="system_prompt"):
        rq.chat_request(TEXT, system_prompt=["a"])
    assert rq.safe_max_length(512) == 460


@pytest.mark.parametrize("status, text, failure, message", [
    (400, '{"error":{"message":"No such field","type":"x"}}', None, "No such field"),
    (503, '{"error":"Still warming up"}', None, "Still warming up"),
    (529, '{"message":"Come back later"}', None, "Come back later"),
    (502, '{"unexpected":"x"}', None, "HTTP 502"),
    (403, "Not JSON", None, "HTTP 403"),
    (404, None, None, "HTTP 404"),
    (200, '{"error":"ignored"}', None, None),
    (None, None, "no route to host", "no route to host"),
    (None, None, None, "Unknown error"),
])
def test_api_error(spark, status, text, failure, message):
    got = one(spark, rs.api_error(F.col("s"), F.col("b"), F.col("f")),
              s=("int", status), b=("string", text), f=("string", failure))
    assert got == message


@pytest.mark.parametrize("code", [400, 401, 403, 404, 429, 500, 502, 503])
def test_api_error_for_each_status(spark, code):
    assert one(spark, rs.api_error(F.col("s"), F.col("b")), s=("int", code),
               b=("string", json.dumps({"error": {"message": f"refused with {code}"}}))) == f"refused with {code}"


def test_embedding_shapes(spark):
    def vectors(text):
        return one(spark, rs.embedding_vectors(F.col("b")), b=("string", text))

    assert vectors("[0.1,0.2,0.3]") == [[0.1, 0.2, 0.3]]
    assert vectors("[[1,2],[3,4]]") == [[1, 2], [3, 4]]
    assert vectors('{"embedding":[1,2]}') == [[1, 2]]
    assert vectors('{"data":1}') is None and vectors("no") is None


def test_indexed_embeddings(spark):
    data = [{"object": "embedding", "index": 0, "embedding": [0.5, 1]},
            {"object": "embedding", "index": 1, "embedding": [2, 3]}]
    for shape in ({"data": data}, data):
        got = one(spark, rs.indexed_embeddings(F.col("b")), b=("string", json.dumps(shape)))
        assert [tuple(r) for r in got] == [(0, [0.5, 1.0]), (1, [2.0, 3.0])]
    for odd in ('{"data":[]}', '{"x":1}', "no"):
        assert one(spark, rs.indexed_embeddings(F.col("b")), b=("string", odd)) is None


def test_classification(spark):
    pos = [{"label": "positive", "score": 0.9}, {"label": "negative", "score": 0.05},
           {"label": "neutral", "score": 0.05}]

    def scores(value):
        return one(spark, rs.classification_scores(F.col("b")), b=("string", json.dumps(value)))

    expected = {"positive": 0.9, "negative": 0.05, "neutral": 0.05}
    assert scores([pos]) == expected and scores(pos) == expected
    assert scores([pos[:1] * 2]) is None and scores({"a": 1}) is None and scores([]) is None
    many = one(spark, rs.classification_scores_multi(F.col("b")),
               b=("string", json.dumps([pos, pos[:1]])))
    assert many == [expected, {"positive": 0.9}]
    assert one(spark, rs.rename_labels(rs.classification_scores(F.col("b")), {"positive": "good"}),
               b=("string", json.dumps([pos[:2]]))) == {"good": 0.9, "negative": 0.05}


def test_message_content(spark):
    def content(blocks):
        return one(spark, rs.message_content(F.col("b")),
                   b=("string", json.dumps({"content": blocks})))

    text = {"type": "text", "text": "first"}
    assert content([text, {"type": "text", "text": "second"}]) == "first"
    assert content([{"type": "tool_use", "name": "t"}, text]) == "first"
    assert content([]) is None and content([{"type": "tool_use"}]) is None


def test_response_fields(spark):
    def fields(status, text):
        return tuple(one(spark, rs.response_fields(F.col("s"), F.col("b")),
                         s=("int", status), b=("string", text)))

    good = json.dumps({"choices": [{"message": {"content": "yes"}}]})
    assert fields(200, good) == (200, "yes", None)
    assert fields(500, '{"error":"down"}') == (500, None, "down")
    assert fields(None, None) == (None, None, "Invalid response object")


def test_token_usage(spark):
    def usage(value):
        return tuple(one(spark, rs.token_usage(F.col("b")),
                         b=("string", json.dumps({"usage": value}))))

    assert usage({"input_tokens": 3, "output_tokens": 4}) == (3, 4, 7)
    assert usage({"prompt_tokens": 3, "completion_tokens": 4, "total_tokens": 9}) == (3, 4, 9)
    assert usage({}) == (None, None, None)


def test_http_date(spark):
    assert one(spark, rs.http_date(F.col("d")), d=("string", "Mon, 06 Jan 2025 10:00:00 GMT")) \
        == datetime.date(2025, 1, 6)
    assert one(spark, rs.http_date(F.col("d")), d=("string", "2025-01-06")) is None


def test_extract_field_at_any_depth(spark):
    nested = {"k": {"k": 1, "x": [{"k": 2}]}, "y": [{"z": {"k": None}}, {"k": []}, {"k": "é"}]}
    got = one(spark, rs.extract_field(F.col("b"), "k"), b=("string", json.dumps(nested)))
    assert got == ['{"k":1,"x":[{"k":2}]}', "1", "2", '"é"']
    assert one(spark, rs.extract_field(F.col("b"), "k"), b=("string", "no")) is None


def test_widen_needs_the_right_length(spark):
    frame = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "v array<double>")
    rows = frame.select(*rs.widen(F.col("v"), 2)).collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.0), (None, None), (None, None)]


@settings(max_examples=25, deadline=None)
@given(PLAIN, st.integers(1, 7))
@example("a\r\nb\U0001f600c\u2028\n", 2)
def test_pieces_put_together_give_the_text(spark, text, size):
    got = one(spark, tx.pieces(F.col("t"), size), t=("string", text))
    if not text:
        assert got is None
    else:
        assert "".join(got) == text
        assert all(0 < len(p) <= size for p in got) and all(len(p) == size for p in got[:-1])


def test_text_limits(spark):
    frame = spark.createDataFrame([("word " * 100,), ("word " * 10000,)], "t string")
    flags = frame.select(tx.too_long(F.col("t")), tx.too_long(tx.truncate(F.col("t")))).collect()
    assert [tuple(r) for r in flags] == [(False, False), (True, False)]


@pytest.mark.parametrize("body", ["[[1,null]]", "[[]]", "[]", "[1,null]", '{"embedding":[]}', "[null]"])
def test_vectors_with_gaps_are_no_success(spark, body):
    assert one(spark, rs.embedding_vectors(F.col("b")), b=("string", body)) is None
    assert one(spark, rs.indexed_embeddings(F.col("b")), b=(
        "string", '{"data":[{"index":0,"embedding":%s}]}' % body)) is None


def test_fields_of_deep_and_unreadable_bodies(spark):
    deep = "[" * 400 + '{"a":1}' + "]" * 400
    hopeless = "[" * 200_000 + "]" * 200_000
    assert one(spark, rs.extract_field(F.col("b"), "a"), b=("string", deep)) == ["1"]
    assert one(spark, rs.extract_field(F.col("b"), "a"), b=("string", hopeless)) in (None, [])
    assert one(spark, rs.extract_field(F.col("b"), "a"), b=(
        "string", '{"a":{"a":2},"b":[{"a":3}]}')) == ['{"a":2}', "2", "3"]
