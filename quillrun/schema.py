"""JSON-Schema builders for structured output.

The builders return plain JSON-Schema documents (dicts). ``JsonSchema`` names one and turns it
into provider payloads and Spark types; ``functions.validation`` compiles it into Columns.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

Node = dict[str, Any]

ENUM_TYPES = ("string", "integer", "number")
_SPARK_LEAF = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
}


def _node(kind: str, **keywords: Any) -> Node:
    return {"type": kind, **{k: v for k, v in keywords.items() if v is not None}}


def object_(properties: dict[str, Node] | None = None, *, required: Sequence[str] | None = None,
            additional_properties: bool = False, **named: Node) -> Node:
    """An object; keys that are no Python names go into ``properties``."""
    if isinstance(required, str):
        required = [required]
    return _node(
        "object",
        properties={**(properties or {}), **named},
        additionalProperties=additional_properties,
        required=None if required is None else list(required),
    )


def string(description: str | None = None, enum: Sequence[str] | None = None) -> Node:
    return _node("string", description=description, enum=None if enum is None else list(enum))


def number(description: str | None = None, minimum: float | None = None,
           maximum: float | None = None) -> Node:
    return _node("number", description=description, minimum=minimum, maximum=maximum)


def integer(description: str | None = None, minimum: float | None = None,
            maximum: float | None = None) -> Node:
    return _node("integer", description=description, minimum=minimum, maximum=maximum)


def boolean(description: str | None = None) -> Node:
    return _node("boolean", description=description)


def enum(values: Sequence[Any], description: str | None = None, type: str = "string") -> Node:
    if type not in ENUM_TYPES:
        raise ValueError(f"an enum of type {type!r}: use {', '.join(ENUM_TYPES)}")
    return _node(type, enum=list(values), description=description)


def array(items: Node, description: str | None = None, min_items: int | None = None,
          max_items: int | None = None) -> Node:
    return _node("array", items=items, description=description, minItems=min_items,
                 maxItems=max_items)


def spark_type(node: Node) -> T.DataType:
    """The Spark type a value of this schema node is read into."""
    kind = node["type"]
    if kind == "object":
        return T.StructType([
            T.StructField(name, spark_type(child))
            for name, child in node.get("properties", {}).items()
        ])
    if kind == "array":
        return T.ArrayType(spark_type(node["items"]))
    return _SPARK_LEAF[kind]


@dataclass(frozen=True)
class JsonSchema:
    name: str
    schema: Node
    strict: bool = True
    description: str = ""

    def __post_init__(self) -> None:
        if not isinstance(self.name, str) or not self.name:
            raise ValueError("a schema needs a name")
        if not isinstance(self.schema, dict):
            raise TypeError("schema must be a dict")
        if not isinstance(self.strict, bool):
            raise TypeError("strict must be a single boolean")

    def chat_format(self) -> Node:
        """``response_format`` of a chat request."""
        inner: Node = {"name": self.name, "schema": self.schema, "strict": self.strict}
        if self.description:
            inner["description"] = self.description
        return {"type": "json_schema", "json_schema": inner}

    def messages_format(self) -> Node:
        """``output_config`` of a messages request."""
        return {"format": {"type": "json_schema", "schema": self.schema}}

    def dumps(self) -> str:
        return json.dumps(self.chat_format(), ensure_ascii=False, separators=(",", ":"))

    def to_struct(self) -> T.StructType:
        if self.schema.get("type") != "object":
            raise TypeError("only an object schema maps to columns")
        return spark_type(self.schema)

    def require_all(self) -> JsonSchema:
        """Every property of every object required, as strict mode wants."""
        def walk(node: Node) -> Node:
            if node.get("type") == "object":
                children = {k: walk(v) for k, v in node.get("properties", {}).items()}
                return {**node, "properties": children, "required": list(children)}
            if node.get("type") == "array":
                return {**node, "items": walk(node["items"])}
            return copy.deepcopy(node)

        return JsonSchema(self.name, walk(self.schema), self.strict, self.description)

    def strict_problems(self) -> list[str]:
        """What a provider's strict mode would reject."""
        problems: list[str] = []

        def walk(node: Node, path: str) -> None:
            if node.get("type") == "object":
                children = node.get("properties", {})
                optional = [k for k in children if k not in node.get("required", [])]
                if optional:
                    problems.append(f"{path}: not required: {', '.join(optional)}")
                if node.get("additionalProperties", True):
                    problems.append(f"{path}: additionalProperties must be false")
                for key, child in children.items():
                    walk(child, key if path == "root" else f"{path}/{key}")
            elif node.get("type") == "array":
                walk(node["items"], f"{path}/items")

        walk(self.schema, "root")
        return problems


def chat_format(schema: JsonSchema | Node | None) -> Node | None:
    """A raw dict is trusted and passed through unchanged."""
    return schema.chat_format() if isinstance(schema, JsonSchema) else schema


def messages_format(schema: JsonSchema | Node | None) -> Node | None:
    if schema is None or isinstance(schema, dict):
        return schema
    if isinstance(schema, JsonSchema):
        return schema.messages_format()
    raise TypeError("schema must be a JsonSchema or a dict")
