"""JSON payload templates as Columns.

A payload is mostly constant: model, prompt, schema. The template is serialised on the driver
once and only the slots are filled per row, so a large schema costs one string literal.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Slot:
    """A place in a template filled with a Column that already holds JSON text."""

    json_text: Column


NULL = object()  # an explicit JSON null; None drops the key


def json_value(value: Column) -> Column:
    """JSON text of a scalar Column (a NULL becomes ``null``)."""
    return F.btrim(F.to_json(F.array(value)), F.lit("[]"))


def text_slot(text: Column) -> Slot:
    return Slot(json_value(text.cast("string")))


def _compact(value: float | int) -> float | int:
    return int(value) if isinstance(value, float) and value.is_integer() else value


def _pieces(value: Any, out: list[str | Column]) -> None:
    if isinstance(value, Slot):
        out.append(value.json_text)
    elif value is NULL:
        out.append("null")
    elif isinstance(value, dict):
        out.append("{")
        fields = [(k, v) for k, v in value.items() if v is not None]
        for i, (key, child) in enumerate(fields):
            out.append(("," if i else "") + json.dumps(key, ensure_ascii=False) + ":")
            _pieces(child, out)
        out.append("}")
    elif isinstance(value, (list, tuple)):
        out.append("[")
        for i, child in enumerate(value):
            out.append("," if i else "")
            _pieces(child, out)
        out.append("]")
    else:
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            value = _compact(value)
        out.append(json.dumps(value, ensure_ascii=False))


def render(template: Any) -> Column:
    """JSON text of a template as a string Column. ``None`` fields are dropped."""
    pieces: list[str | Column] = []
    _pieces(template, pieces)
    columns: list[Column] = []
    run = ""
    for piece in pieces:
        if isinstance(piece, str):
            run += piece
            continue
        if run:
            columns.append(F.lit(run))
            run = ""
        columns.append(piece)
    if run:
        columns.append(F.lit(run))
    return F.concat(*columns)
