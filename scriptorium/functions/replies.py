"""Model replies and hashes: canonical JSON, key repair, contracts, durations (FN-03, FN-18, FN-20, FN-21, FN-25)."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def canonical_json(text: str | None) -> str | None:
    """The value with sorted keys and no blanks, so that equal values have equal text; None if it doesn't parse."""
    try:
        return json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    except (TypeError, ValueError):
        return None


@F.pandas_udf(StringType())
def canonical(texts: pd.Series) -> pd.Series:
    return texts.map(canonical_json)


def json_hash(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def repaired_keys(value):
    """Keys without blanks and trailing colons; a missing gloss is taken from prose under a mistyped key."""
    if isinstance(value, list):
        return [repaired_keys(v) for v in value]
    if not isinstance(value, dict):
        return value
    out, gloss = {}, None
    for key, v in value.items():
        name = re.sub(r"\s*:\s*$", "", key.strip())
        mistyped = name.lower() == "original_term_vernacular" and name != key.strip() and isinstance(v, str) and len(v.strip()) >= 25 and (" " in v.strip() or v.strip().endswith("."))
        if mistyped and gloss is None:
            gloss = v.strip()
        out[name] = None if mistyped and "gloss" not in value else repaired_keys(v)
    if "gloss" not in out and gloss is not None:
        out["gloss"] = gloss
    return out


@F.pandas_udf(StringType())
def repaired(texts: pd.Series) -> pd.Series:
    """Canonical JSON with repaired keys; null for what doesn't parse."""

    def one(text):
        try:
            return json.dumps(repaired_keys(json.loads(text)), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except (TypeError, ValueError):
            return None

    return texts.map(one)


def checked_label(value: Column, allowed: tuple[str, ...], kind: str) -> Column:
    """A label that must be known if present: raises on any other."""
    return F.when(value.isNull() | value.isin(*allowed), value).otherwise(F.raise_error(F.concat(F.lit(f"unknown {kind}: "), value)))


def in_range(indices: Column, size: Column) -> Column:
    """Whether all sentence indices exist."""
    return F.coalesce(F.forall(indices, lambda i: (i >= 0) & (i < size)), F.lit(False))


def duration(seconds: Column) -> Column:
    """Seconds, minutes or hours; halves go to the even digit."""
    return F.when(seconds < 60, F.format_string("%.0fs", seconds.cast("double"))).when(seconds < 3600, F.format_string("%.1fm", F.bround(seconds / 60.0, 1))).otherwise(F.format_string("%.1fh", F.bround(seconds / 3600.0, 1)))
