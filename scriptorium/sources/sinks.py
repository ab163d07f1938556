"""Keyed sinks as merges of DataFrames (SRC-04, SRC-15 to SRC-19): the caller writes the result as a new version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_absent(target: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """target plus the rows whose key it lacks; of repeated new keys the smallest row."""
    others = [c for c in target.columns if c not in key]
    new = rows.groupBy(*key).agg(F.min(F.struct(*others)).alias("r")).select(*key, *(F.col(f"r.{c}").alias(c) for c in others)).join(target, key, "left_anti")
    return target.unionByName(new.select(*target.columns))


def overwrite(target: DataFrame, rows: DataFrame, key: list[str], only_missing: bool = False) -> DataFrame:
    """Rows replace the target's by key; only_missing keeps what is there and fills nulls."""
    a, b = target.alias("a"), rows.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]
    first, second = ("a", "b") if only_missing else ("b", "a")
    joined = a.join(b, on, "full")
    has = F.col(f"{first}.{key[0]}").isNotNull()
    pick = (lambda c: F.coalesce(f"a.{c}", f"b.{c}")) if only_missing else (lambda c: F.when(has, F.col(f"{first}.{c}")).otherwise(F.col(f"{second}.{c}")))
    return joined.select(*(F.coalesce(f"a.{c}", f"b.{c}").alias(c) if c in key else pick(c).alias(c) for c in target.columns))


def append_top(evidence: DataFrame, k: int, group: str, order: list) -> DataFrame:
    from ..operators.windows import top_per_group

    return top_per_group(evidence, k, [group], order)


def cache_key(*parts: Column) -> Column:
    """Key of a cached request: hash of its canonical JSON."""
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def is_fresh(fetched_at: Column, now: Column, ttl_seconds: int) -> Column:
    """Whether no more than a time to live has passed, to the microsecond."""
    return fetched_at >= now - F.make_dt_interval(secs=F.lit(ttl_seconds))


def fresh(cache: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """Cached rows younger than a time to live."""
    return cache.filter(is_fresh(F.col("fetched_at"), now, ttl_seconds))
