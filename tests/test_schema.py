import json

import pytest
from pyspark.sql import functions as F

from quillrun import schema as js
from quillrun.functions.responses import structured
from quillrun.functions.validation import violation_texts, violations


def problems(spark, schema, *values):
    rows = [(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    found = spark.createDataFrame(rows, "i int, content string").select(
        "i", violation_texts(violations(F.col("content"), schema)).alias("v"))
    return [r["v"] for r in found.orderBy("i").collect()]


def test_name_must_be_given():
    with pytest.raises(ValueError):
        js.JsonSchema("", js.object_())
    with pytest.raises(TypeError):
        js.JsonSchema("x", "not a schema")
    with pytest.raises(TypeError):
        js.JsonSchema("x", js.object_(), strict="yes")


def test_object_defaults():
    node = js.object_(city=js.string(), borough=js.string(), required=["city", "borough"])
    assert node["additionalProperties"] is False
    assert node["required"] == ["city", "borough"]
    assert set(node["properties"]) == {"city", "borough"}
    assert "required" not in js.object_(city=js.string())
    assert js.object_(a=js.string(), required="a")["required"] == ["a"]


def test_leaf_builders_keep_only_what_is_given():
    assert js.string() == {"type": "string"}
    assert js.string("d", ["a"]) == {"type": "string", "description": "d", "enum": ["a"]}
    assert js.number(minimum=0) == {"type": "number", "minimum": 0}
    assert js.integer(maximum=9) == {"type": "integer", "maximum": 9}
    assert js.boolean("flag") == {"type": "boolean", "description": "flag"}
    assert js.array(js.string(), min_items=1, max_items=3) == {
        "type": "array", "items": {"type": "string"}, "minItems": 1, "maxItems": 3}


def test_enum_types():
    assert js.enum([1, 2], type="integer") == {"type": "integer", "enum": [1, 2]}
    with pytest.raises(ValueError, match="an enum of type"):
        js.enum([True], type="boolean")


def test_payload_shapes():
    named = js.JsonSchema("s", js.object_(a=js.string()))
    assert named.chat_format() == {"type": "json_schema", "json_schema": {
        "name": "s", "schema": named.schema, "strict": True}}
    described = js.JsonSchema("s", js.object_(), False, "text")
    assert described.chat_format()["json_schema"]["description"] == "text"
    assert described.chat_format()["json_schema"]["strict"] is False
    assert named.messages_format() == {"format": {"type": "json_schema", "schema": named.schema}}
    assert json.loads(named.dumps()) == named.chat_format()
    raw = {"anything": [1]}
    assert js.chat_format(raw) is raw and js.messages_format(raw) is raw
    with pytest.raises(TypeError):
        js.messages_format("text")


def test_require_all_and_strict_problems():
    loose = js.JsonSchema("s", js.object_(
        a=js.string(), b=js.array(js.object_(c=js.integer(), additional_properties=True))))
    assert loose.strict_problems() == [
        "root: not required: a, b", "b/items: not required: c",
        "b/items: additionalProperties must be false"]
    full = loose.require_all()
    assert full.schema["required"] == ["a", "b"]
    assert full.schema["properties"]["b"]["items"]["required"] == ["c"]
    assert loose.schema.get("required") is None


def test_spark_type():
    named = js.JsonSchema("s", js.object_(
        a=js.string(), n=js.number(), i=js.integer(), b=js.boolean(),
        l=js.array(js.object_(x=js.enum([1], type="integer")))))
    assert named.to_struct().simpleString() == (
        "struct<a:string,n:double,i:bigint,b:boolean,l:array<struct<x:bigint>>>")


def parcel(**changes):
    """A parcel that keeps to ``parcel_schema``, with changes."""
    return {"weight_g": 1250, "service": "post", "zone": 2, "fragile": False, **changes}


def parcel_schema():
    return js.JsonSchema("parcel", js.object_(
        weight_g=js.integer(minimum=1, maximum=31_500), service=js.enum(["post", "courier"]),
        zone=js.enum([1, 2, 4, 8], type="integer"), fragile=js.boolean(),
        insured=js.number(minimum=0.5, maximum=2_500), required=["weight_g"]))


def test_keys_the_schema_does_not_know_or_asks_for(spark):
    whole, bare, empty = parcel(), {"weight_g": 7}, {}
    found = problems(spark, parcel_schema(), whole, bare, empty, parcel(colour="red", size="L"),
                     "{weight", None)
    assert found[0] == found[1] == []
    assert found[2] == ["Field 'root': must have required property 'weight_g'"]
    assert found[3] == ["Field 'root': must NOT have additional properties"] * 2
    assert found[4] == ["Field 'root': must be valid JSON"]
    assert found[5] is None


def test_values_outside_a_list(spark):
    one_of = "must be equal to one of the allowed values"
    found = problems(spark, parcel_schema(), parcel(service="pigeon"), parcel(zone=3),
                     parcel(zone="2"), parcel(zone=8), '{"weight_g":5,"zone":4.0}')
    assert found[0] == [f"Field 'service': {one_of}"]
    assert found[1] == [f"Field 'zone': {one_of}"]
    assert found[2][0] == "Field 'zone': must be integer"
    assert found[3] == found[4] == []


def test_numbers_outside_a_range(spark):
    found = problems(spark, parcel_schema(), parcel(weight_g=0), parcel(weight_g=31_501),
                     parcel(weight_g=0.25), parcel(insured=0.4), parcel(insured=0.5, weight_g=31_500),
                     '{"weight_g":12e2}', parcel(weight_g="1", insured=None, fragile=1))
    assert found[0] == ["Field 'weight_g': must be >= 1"]
    assert found[1] == ["Field 'weight_g': must be <= 31500"]
    assert found[2][0] == "Field 'weight_g': must be integer"
    assert found[3] == ["Field 'insured': must be >= 0.5"]
    assert found[4] == found[5] == []
    assert sorted(found[6]) == ["Field 'fragile': must be boolean", "Field 'insured': must be number",
                                "Field 'weight_g': must be integer"]


def test_paths_into_lists_and_objects(spark):
    route = js.JsonSchema("route", js.object_(depot=js.string(), van=js.object_(
        plate=js.string(), axles=js.integer(maximum=4)),
        stops=js.array(js.object_(minute=js.integer(minimum=0), drops=js.array(js.number(minimum=0))))))
    stops = [{"minute": 0, "drops": []}, {"minute": 35, "drops": [2, 0.5]}]
    found = problems(
        spark, route, {"depot": "north", "van": {"plate": "K 7", "axles": 2}, "stops": stops},
        {"stops": [stops[0], {"minute": -1, "drops": [1, -0.5, "x"]}]},
        {"van": [2], "stops": {"minute": 3}}, {"van": {"axles": 5}, "depot": 9}, [])
    assert found[0] == []
    assert found[1] == ["Field 'stops/1/minute': must be >= 0", "Field 'stops/1/drops/1': must be >= 0",
                        "Field 'stops/1/drops/2': must be number"]
    assert found[2] == ["Field 'van': must be object", "Field 'stops': must be array"]
    assert found[3] == ["Field 'depot': must be string", "Field 'van/axles': must be <= 4"]
    assert found[4] == ["Field 'root': must be object"]


def test_array_sizes_and_booleans(spark):
    sized = js.JsonSchema("s", js.object_(
        l=js.array(js.boolean(), min_items=1, max_items=2), required=["l"]))
    found = problems(spark, sized, {"l": []}, {"l": [True]}, {"l": [True, False, 1]}, {})
    assert found[0] == ["Field 'l': must NOT have fewer than 1 items"]
    assert found[1] == []
    assert found[2] == ["Field 'l': must NOT have more than 2 items", "Field 'l/2': must be boolean"]
    assert found[3] == ["Field 'root': must have required property 'l'"]


def test_odd_keys(spark):
    odd = js.JsonSchema("s", js.object_({"x.y": js.string(), "it's": js.integer(), "a/b": js.string()}))
    found = problems(spark, odd, {"x.y": 1, "it's": "z", "a/b": 2}, {"x.y": "t", "it's": 1, "a/b": "u"})
    assert found[0] == ["Field 'x.y': must be string", "Field 'it's': must be integer",
                        "Field 'a~1b': must be string"]
    assert found[1] == []


def test_top_level_array_and_leaf(spark):
    assert problems(spark, js.array(js.integer()), [1, "x"], {"a": 1}) == [
        ["Field '1': must be integer"], ["Field 'root': must be array"]]


def test_free_schema_is_refused():
    with pytest.raises(ValueError):
        violations(F.lit("x"), {"type": ["string", "null"]})


def test_structured_reads_what_fits(spark):
    named = js.JsonSchema("s", js.object_(a=js.integer(), b=js.string()))
    rows = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("bad",)], "c string").select(
        structured(F.col("c"), named).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (None, None)]
