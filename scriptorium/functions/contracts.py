"""Contracts of model replies: JSON schemas as Spark types and as checks of replies (SRC-09, FN-21)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
_DDL = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}


def _kinds(schema: dict) -> list[str]:
    kind = schema.get("type", [])
    return [kind] if isinstance(kind, str) else list(kind)


def ddl(schema: dict) -> str:
    """The Spark type of values that a schema allows; a value of several types, null aside, is a string."""
    kinds = [k for k in _kinds(schema) if k != "null"]
    if kinds == ["object"]:
        return "struct<" + ",".join(f"`{name}`:{ddl(s)}" for name, s in schema.get("properties", {}).items()) + ">"
    if kinds == ["array"]:
        return f"array<{ddl(schema.get('items', {}))}>"
    return _DDL.get(kinds[0], "string") if len(kinds) == 1 else "string"


def columns(schema: dict, path: str = "", required: bool = True) -> list[tuple[str, str, bool]]:
    """(path, type, required) of every leaf of a schema; [] stands for any element."""
    kinds = [k for k in _kinds(schema) if k != "null"]
    if kinds == ["object"]:
        dot = "." if path else ""
        return [row for name, s in schema.get("properties", {}).items() for row in columns(s, f"{path}{dot}{name}", name in schema.get("required", ()))]
    if kinds == ["array"]:
        return columns(schema.get("items", {}), f"{path}[]", required)
    return [(path, ddl(schema), required)]


def _is(value, kind: str) -> bool:
    if kind == "integer":
        return not isinstance(value, bool) and (isinstance(value, int) or isinstance(value, float) and value.is_integer())
    if kind == "number":
        return isinstance(value, int | float) and not isinstance(value, bool)
    return isinstance(value, _TYPES[kind]) if kind in _TYPES else True


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """What of a value breaks its schema: type, enum, bounds, length, required and closed objects, and so below."""
    kinds = _kinds(schema)
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not allowed")
    if _is(value, "number"):
        if value < schema.get("minimum", value):
            out.append(f"{path}: below {schema['minimum']}")
        if value > schema.get("maximum", value):
            out.append(f"{path}: above {schema['maximum']}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{path}: too short")
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            out.append(f"{path}: too few")
        for i, v in enumerate(value):
            out += violations(v, schema.get("items", {}), f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{name}: missing" for name in schema.get("required", ()) if name not in value]
        out += [f"{path}.{name}: unknown" for name in value if name not in known and schema.get("additionalProperties", True) is False]
        for name, s in known.items():
            if name in value:
                out += violations(value[name], s, f"{path}.{name}")
    return out


def checked(schema: dict):
    """Arrow UDF: the violations of a reply's JSON, joined, or null for a sound one; broken JSON is one violation."""

    @F.pandas_udf(StringType())
    def run(replies: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return "$: no reply"
            try:
                found = violations(json.loads(text), schema)
            except ValueError:
                return "$: no JSON"
            return "; ".join(found) or None

        return replies.map(one)

    return run


#: The contract of claim replies. Names and allowed labels.
CLAIMS = {
    "type": "object",
    "required": ["claims"],
    "properties": {
        "claims": {
            "type": "array",
            "items": {
                "type": "object",
                "required": ["claim_text", "evidence"],
                "properties": {
                    "claim_text": {"type": "string", "minLength": 1},
                    "polarity": {"type": ["string", "null"], "enum": ["assert", "deny", "conditional", None]},
                    "confidence": {"type": ["number", "null"], "minimum": 0, "maximum": 1},
                    "evidence": {"type": "array", "minItems": 1, "items": {"type": "integer", "minimum": 0}},
                },
            },
        }
    },
}
