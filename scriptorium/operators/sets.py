"""Set operations (SO)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query


@query("so01_union_distinct", "SELECT count(*) AS n FROM (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def union_distinct(t):
    return t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey").union(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey")).distinct().agg(F.count("*").alias("n"))


@query("so02_bag_union", "SELECT o_orderkey AS k, 'a' AS origin FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT l_orderkey, 'b' FROM lineitem WHERE l_quantity > 49")
def bag_union(t):
    return t.orders.filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("k"), F.lit("a").alias("origin")).unionByName(t.lineitem.filter("l_quantity > 49").select(F.lit("b").alias("origin"), F.col("l_orderkey").alias("k")))


@query("so03_intersection", "SELECT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N'")
def intersection(t):
    flags = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("r"), F.bool_or(F.col("l_returnflag") == "N").alias("n"))  # one scan and shuffle
    return flags.filter("r AND n").select("k")


@query("so04_difference", "SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def difference(t):
    return t.orders.select(F.col("o_custkey").alias("k")).distinct().join(t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("k")), "k", "left_anti")


@query("so05_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct(t):
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("so06_ordered_dedup", "WITH w AS (SELECT doc_id, string_split(text, ' ') AS a FROM documents), f AS (SELECT doc_id, x, min(i) AS i FROM (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM w) GROUP BY 1, 2) SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS kept FROM f GROUP BY 1")
def ordered_dedup(t):
    words = F.array_distinct(F.split("text", " "))
    return t.documents.filter("text IS NOT NULL").select("doc_id", F.size(words).cast("bigint").alias("n"), F.array_join(words, " ").alias("kept"))
