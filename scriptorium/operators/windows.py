"""Ordered and partitioned behaviour (WN) as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..registry import query
from .graph import checkpointed


def neighbours(df: DataFrame, key: str, group: list[str], order: list[str]) -> DataFrame:
    """prev_* and next_* links of a key within a group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumns({f"prev_{key}": F.lag(key).over(w), f"next_{key}": F.lead(key).over(w)})


def ordinal(group: list[str], order: list[str]) -> Column:
    """Place from 0 within a group."""
    return F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1


def placed(df: DataFrame, group: list[str], order: list[str], cost: str | None = None) -> DataFrame:
    """df with place (rows before it in its group) and, of a cost, spent_before (their sum), however large a group is.

    Rows are range-partitioned by group and order, counted within each range, and shifted by what earlier ranges of the
    group hold, so no task sees a whole group. Rows that tie in all of order get places in any order.
    """
    own = df.withColumn("_cost", F.col(cost) if cost else F.lit(0))
    rows = checkpointed(own.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()))
    here = Window.partitionBy("_range", *group).orderBy(*order)
    before = F.coalesce(F.sum("_cost").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumns({"place": F.row_number().over(here) - 1, "spent_before": before})
    sums = rows.groupBy("_range", *group).agg(F.count("*").alias("_n"), F.sum("_cost").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range and group
    shift = sums.select(F.col("_range").alias("_r"), *(F.col(g).alias(f"_{g}") for g in group), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum"))
    same = (F.col("_range") == F.col("_r"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return rows.join(shift, same).select(*df.columns, (F.col("place") + F.col("_n")).alias("place"), (F.col("spent_before") + F.col("_sum")).alias("spent_before"))


def top_per_group(df: DataFrame, k: int, group: list[str], order: list) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")


def last_two(array: Column) -> Column:
    """The last two elements of an array, or the one it has."""
    return F.slice(array, F.greatest(F.size(array) - 1, F.lit(1)), 2)


def within_budget(df: DataFrame, cost: str, budget: int, group: list[str], order: list[str]) -> DataFrame:
    """Rows whose running cost before them is below the budget."""
    return placed(df, group, order, cost).drop("place").filter(F.col("spent_before") < budget)


@query("wn01_prev_next", "SELECT conv_id, turn, lag(turn) OVER w AS prev_turn, lead(turn) OVER w AS next_turn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def prev_next(t):
    return neighbours(t.conversations.select("conv_id", "turn"), "turn", ["conv_id"], ["turn"])


@query("wn02_ordinals", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS ord FROM lineitem")
def ordinals(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", ordinal(["l_orderkey"], ["l_linenumber"]).cast("bigint").alias("ord"))


@query(
    "wn03_anaphora",
    """WITH s AS (SELECT conv_id, turn, list_filter(string_split(text, '. '), lambda x: x <> '') AS a FROM conversations)
    SELECT conv_id, turn, coalesce(array_to_string(lag(a) OVER (PARTITION BY conv_id ORDER BY turn)[-2:], ' | '), '') AS context FROM s""",
)
def anaphora(t):
    """Context of a paragraph: the last two sentences of the one before; an empty one before resets it."""
    sentences = F.filter(F.split("text", r"\. "), lambda x: x != "")
    rows = t.conversations.select("conv_id", "turn", sentences.alias("a"))
    before = F.lag("a").over(Window.partitionBy("conv_id").orderBy("turn"))
    return rows.select("conv_id", "turn", F.coalesce(F.array_join(last_two(before), " | "), F.lit("")).alias("context"))


@query("wn04_top_k_per_group", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def top_k(t):
    return top_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), 3, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("wn05_keep_first", "SELECT source, lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1")
def keep_first(t):
    return t.documents.groupBy("source", "lang").agg(F.min("doc_id").alias("doc_id"))


@query("wn06_rank_then_score", "SELECT user_id, event_id FROM events WHERE value >= 25 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 ELSE 9 END, value DESC, event_id) = 1")
def rank_then_score(t):
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "click", 2).otherwise(9)
    best = F.min(F.struct(rank.alias("r"), (-F.col("value")).alias("v"), "event_id"))
    return t.events.filter("value >= 25").groupBy("user_id").agg(best.alias("b")).select("user_id", "b.event_id")


@query(
    "wn07_round_robin",
    """WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents)
    SELECT doc_id FROM r JOIN s USING (source) ORDER BY k, n DESC, source, doc_id LIMIT 37""",
)
def round_robin(t):
    sizes = t.documents.groupBy("source").agg(F.count("*").alias("n"))
    rows = top_per_group(t.documents.select("doc_id", "source"), 37, ["source"], ["doc_id"])  # no source gives more than all
    rows = rows.withColumn("k", ordinal(["source"], ["doc_id"]))
    return rows.join(sizes, "source").orderBy("k", F.desc("n"), "source", "doc_id").limit(37).select("doc_id")


@query("wn08_budget", "SELECT source, doc_id FROM (SELECT source, doc_id, coalesce(sum(n_chars // 4) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM documents) WHERE spent < 3000")
def budget(t):
    rows = t.documents.select("source", "doc_id", F.floor(F.col("n_chars") / 4).alias("tokens"))
    return within_budget(rows, "tokens", 3000, ["source"], ["doc_id"]).select("source", "doc_id")


@query("wn09_batches", "SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 15 AS batch FROM documents")
def batches(t):
    rows = placed(t.documents.select("source", "doc_id"), ["source"], ["doc_id"])
    return rows.select("source", "doc_id", F.floor(F.col("place") / 15).cast("bigint").alias("batch"))


@query(
    "wn10_adaptive_batches",
    """SELECT event_id, depth, (row_number() OVER (PARTITION BY depth, CASE WHEN depth >= 4 THEN user_id ELSE -1 END ORDER BY event_id) - 1) // CASE WHEN depth >= 4 THEN 5 ELSE 15 END AS batch
    FROM (SELECT event_id, user_id, event_id % 7 AS depth FROM events)""",
)
def adaptive(t, n: int = 5):
    """Deep levels batch n per parent, shallow ones 3n across parents."""
    rows = t.events.select("event_id", "user_id", (F.col("event_id") % 7).alias("depth"))
    rows = rows.withColumn("parent", F.when(F.col("depth") >= 4, F.col("user_id")).otherwise(-1))
    size = F.when(F.col("depth") >= 4, n).otherwise(3 * n)
    return placed(rows, ["depth", "parent"], ["event_id"]).select("event_id", "depth", F.floor(F.col("place") / size).cast("bigint").alias("batch"))


@query("wn11_duplicate_ordinals", "SELECT conv_id, pos, count(*) AS n FROM (SELECT conv_id, turn // 2 AS pos FROM conversations) GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_ordinals(t):
    return t.conversations.groupBy("conv_id", F.floor(F.col("turn") / 2).alias("pos")).agg(F.count("*").alias("n")).filter("n > 1")
