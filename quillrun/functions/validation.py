"""JSON-Schema validation compiled to Columns over VARIANT.

``violations`` turns a schema into one expression that lists everything wrong with a JSON text
as (path, message) structs: no UDF, no second parse per rule. Scalar types are tested with
``schema_of_variant``, never with casts, because scalar variant casts are lenient (``"5"`` casts
to 5); only objects cast to maps and only arrays to arrays, so those casts are tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillrun.schema import JsonSchema, Node

VIOLATIONS = "array<struct<path:string,message:string>>"
ROOT = "root"
NOT_JSON = "must be valid JSON"

# The wording of the public JSON-Schema validators.
MUST_BE = "must be {}"
MUST_BE_ALLOWED = "must be equal to one of the allowed values"
MUST_BE_AT_LEAST = "must be >= {}"
MUST_BE_AT_MOST = "must be <= {}"
MUST_HAVE = "must have required property '{}'"
MUST_NOT_HAVE_MORE_KEYS = "must NOT have additional properties"
MUST_NOT_HAVE_FEWER = "must NOT have fewer than {} items"
MUST_NOT_HAVE_MORE = "must NOT have more than {} items"


def _number_text(value: float) -> str:
    return str(int(value)) if float(value).is_integer() else repr(value)


def _none() -> Column:
    return F.array().cast(VIOLATIONS)


def _violation(path: Column, message: str) -> Column:
    shown = F.when(path == "", F.lit(ROOT)).otherwise(path)
    return F.struct(shown.alias("path"), F.lit(message).alias("message"))


def _checked(path: Column, rules: list[tuple[Column, str]]) -> Column:
    """One violation for each rule whose condition is not met."""
    if not rules:
        return _none()
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(met, F.lit(False)), _violation(path, message))
        for met, message in rules]))


def _child_path(path: Column, key: Column) -> Column:
    return F.when(path == "", key).otherwise(F.concat(path, F.lit("/"), key))


def _pointer(key: str) -> str:
    return key.replace("~", "~0").replace("/", "~1")


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _bound(value: Column, compute: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times."""
    return F.flatten(F.transform(F.array(value), compute))


def _leaf(node: Node, value: Column, path: Column) -> Column:
    kind_name = node["type"]

    def check(kind: Column) -> Column:
        number = F.try_variant_get(value, "$", "double")
        is_type = {
            "string": kind == "STRING",
            "boolean": kind == "BOOLEAN",
            "number": _is_number(kind),
            "integer": _is_number(kind) & (F.floor(number) == number),
        }[kind_name]
        rules: list[tuple[Column, str]] = [(is_type, MUST_BE.format(kind_name))]
        numeric = _is_number(kind)
        if "minimum" in node:
            low = node["minimum"]
            rules.append((~numeric | (number >= F.lit(float(low))),
                          MUST_BE_AT_LEAST.format(_number_text(low))))
        if "maximum" in node:
            high = node["maximum"]
            rules.append((~numeric | (number <= F.lit(float(high))),
                          MUST_BE_AT_MOST.format(_number_text(high))))
        if "enum" in node:
            allowed = node["enum"]
            texts = [x for x in allowed if isinstance(x, str)]
            numbers = [float(x) for x in allowed if not isinstance(x, str)]
            hit = F.lit(False)
            if texts:
                hit = hit | ((kind == "STRING") & F.try_variant_get(value, "$", "string").isin(texts))
            if numbers:
                hit = hit | (numeric & number.isin(numbers))
            rules.append((hit, MUST_BE_ALLOWED))
        return _checked(path, rules)

    return _bound(F.schema_of_variant(value), check)


def _array(node: Node, value: Column, path: Column) -> Column:
    def check(items: Column) -> Column:
        rules = []
        if "minItems" in node:
            rules.append((F.size(items) >= node["minItems"],
                          MUST_NOT_HAVE_FEWER.format(node["minItems"])))
        if "maxItems" in node:
            rules.append((F.size(items) <= node["maxItems"],
                          MUST_NOT_HAVE_MORE.format(node["maxItems"])))
        inside = F.flatten(F.transform(items, lambda item, i: _node(
            node["items"], item, _child_path(path, i.cast("string")))))
        return F.when(items.isNull(), _checked(path, [(F.lit(False), MUST_BE.format("array"))])) \
            .otherwise(F.concat(_checked(path, rules), inside))

    return _bound(F.try_variant_get(value, "$", "array<variant>"), check)


def _object(node: Node, value: Column, path: Column) -> Column:
    properties: dict[str, Node] = node.get("properties", {})

    def child(key: str, node: Node) -> Callable[[Column], Column]:
        at = _child_path(path, F.lit(_pointer(key)))
        # an explicit null is a value; only an absent key is NULL here
        return lambda part: F.when(part.isNotNull(), _node(node, part, at)).otherwise(_none())

    def check(fields: Column) -> Column:
        def field(key: str) -> Column:
            return F.try_element_at(fields, F.lit(key))

        found = [_checked(path, [(field(key).isNotNull(), MUST_HAVE.format(key))
                                 for key in node.get("required", [])])]
        if not node.get("additionalProperties", True):
            keys = F.map_keys(fields)
            extra = F.filter(keys, lambda k: ~k.isin(list(properties))) if properties else keys
            found.append(F.transform(extra, lambda _: _violation(path, MUST_NOT_HAVE_MORE_KEYS)))
        found += [_bound(field(key), child(key, sub)) for key, sub in properties.items()]
        return F.when(fields.isNull(), _checked(path, [(F.lit(False), MUST_BE.format("object"))])) \
            .otherwise(F.concat(*found))

    return _bound(F.try_variant_get(value, "$", "map<string,variant>"), check)


def _node(node: Node, value: Column, path: Column) -> Column:
    kind = node.get("type")
    if kind == "object":
        return _object(node, value, path)
    if kind == "array":
        return _array(node, value, path)
    if kind in ("string", "number", "integer", "boolean"):
        return _leaf(node, value, path)
    raise ValueError(f"cannot validate a schema node of type {kind!r}")


def violations(content: Column, schema: JsonSchema | Node) -> Column:
    """Everything wrong with a JSON text under a schema; empty when valid, NULL for no text."""
    node = schema.schema if isinstance(schema, JsonSchema) else schema

    def check(parsed: Column) -> Column:
        bad = _checked(F.lit(""), [(F.lit(False), NOT_JSON)])
        return F.when(parsed.isNull(), bad).otherwise(_node(node, parsed, F.lit("")))

    return F.when(content.isNotNull(), _bound(F.try_parse_json(content), check))


def violation_texts(found: Column) -> Column:
    """``Field '<path>': <message>`` for each violation."""
    return F.transform(found, lambda x: F.concat(
        F.lit("Field '"), x["path"], F.lit("': "), x["message"]))
