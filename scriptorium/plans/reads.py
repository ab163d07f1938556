"""Read queries (Q-01 to Q-08) over the bound tables: customer = author, orders = work, lineitem = paragraph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import percent
from ..operators.filters import conjuncts, display_label
from ..operators.sorts import ordered
from ..registry import query


def _extracted(t) -> DataFrame:
    """Works with an extraction: a returned line (mention) or a discounted large one (claim)."""
    lines = t.lineitem
    return lines.filter("l_returnflag = 'R'").select("l_orderkey").union(lines.filter("l_quantity > 45").select("l_orderkey")).distinct()


@query(
    "q01_stats",
    """SELECT (SELECT count(*) FROM customer) AS authors, (SELECT count(*) FROM orders) AS works, (SELECT count(*) FROM lineitem) AS paragraphs, x AS works_with_extractions,
    round(x * 100.0 / (SELECT count(*) FROM orders), 3)::DOUBLE AS coverage FROM (SELECT count(DISTINCT l_orderkey) AS x FROM lineitem WHERE l_returnflag = 'R' OR l_quantity > 45)""",
)
def stats(t):
    n = lambda df, name: df.agg(F.count("*").alias(name))
    row = n(t.customer, "authors").crossJoin(n(t.orders, "works")).crossJoin(n(t.lineitem, "paragraphs")).crossJoin(n(_extracted(t), "works_with_extractions"))  # one row each
    return row.withColumn("coverage", percent(F.col("works_with_extractions"), F.col("works")))


@query("q02_authors", "SELECT c_custkey, c_name, count(o_orderkey) AS works FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_name ILIKE '%1%' GROUP BY 1, 2 ORDER BY works DESC NULLS LAST, c_custkey LIMIT 50")
def authors(t, limit: int = 50, q: str = "1"):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("works"))
    rows = conjuncts(t.customer, contains=("c_name", q)).join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return ordered(rows.select("c_custkey", "c_name", F.coalesce("works", F.lit(0)).alias("works")), "works", "desc", "c_custkey").limit(limit)


@query("q03_author", "SELECT o_orderkey, o_orderpriority AS title, year(o_orderdate)::BIGINT AS year, count(l_linenumber) AS paragraphs, coalesce(bool_or(l_returnflag = 'R' OR l_quantity > 45), false) AS has_extractions FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = 7 GROUP BY 1, 2, 3")
def author(t, author_id: int = 7):
    works = t.orders.filter(F.col("o_custkey") == author_id)
    lines = t.lineitem.join(works, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    facts = lines.groupBy("l_orderkey").agg(F.count("*").alias("paragraphs"), F.bool_or((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 45)).alias("x"))
    joined = works.join(facts, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select("o_orderkey", F.col("o_orderpriority").alias("title"), F.year("o_orderdate").cast("bigint").alias("year"), F.coalesce("paragraphs", F.lit(0)).alias("paragraphs"), F.coalesce("x", F.lit(False)).alias("has_extractions"))


@query(
    "q04_works",
    """SELECT o_orderkey, c_name, o_orderpriority AS title, year(o_orderdate)::BIGINT AS year, count(DISTINCT l_linenumber) AS paragraphs, 'evidence' AS label
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND year(o_orderdate) BETWEEN 1993 AND 1996 GROUP BY ALL ORDER BY title, o_orderkey LIMIT 50 OFFSET 10""",
)
def works(t, limit: int = 50, offset: int = 10):
    rows = conjuncts(t.orders.withColumn("year", F.year("o_orderdate").cast("bigint")), equal={"o_orderstatus": "F"}, between={"year": (1993, 1996)})
    lines = t.lineitem.groupBy("l_orderkey").agg(F.countDistinct("l_linenumber").alias("paragraphs"))
    rows = rows.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    page = rows.orderBy("o_orderpriority", "o_orderkey").offset(offset).limit(limit)
    label = display_label(F.col("year"), F.lit("catalog"), F.lit("first_publication_date"), F.lit(0.9))
    return page.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", "c_name", F.col("o_orderpriority").alias("title"), "year", F.coalesce("paragraphs", F.lit(0)).alias("paragraphs"), label.alias("label"))


@query("q05_work", "SELECT o_orderkey, c_name, count(l_linenumber) AS paragraphs, count(DISTINCT l_suppkey) AS editions, count(*) FILTER (l_returnflag = 'R') AS mentions, count(*) FILTER (l_quantity > 45) AS claims FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey = 7 GROUP BY 1, 2")
def work(t, work_id: int = 7):
    facts = t.lineitem.filter(F.col("l_orderkey") == work_id).agg(F.count("*").alias("paragraphs"), F.countDistinct("l_suppkey").alias("editions"), F.count_if(F.col("l_returnflag") == "R").alias("mentions"), F.count_if(F.col("l_quantity") > 45).alias("claims"))
    return t.orders.filter(F.col("o_orderkey") == work_id).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name").crossJoin(facts)  # one row each


@query("q06_paragraphs", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, min(l_shipdate::VARCHAR) AS text, count(DISTINCT l_partkey) AS concepts FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100 OFFSET 20")
def paragraphs(t):
    rows = t.lineitem.groupBy("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    return rows.agg(F.min(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("text"), F.countDistinct("l_partkey").alias("concepts")).orderBy("l_orderkey", "l_linenumber").offset(20).limit(100)


@query("q07_extractions", "SELECT DISTINCT l_orderkey, l_linenumber, 'concept' AS kind, p_name AS label FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' UNION ALL SELECT DISTINCT l_orderkey, l_linenumber, 'claim', s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity > 45")
def extractions(t):
    concepts = t.lineitem.filter("l_returnflag = 'R'").join(t.part, F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "l_linenumber", F.lit("concept").alias("kind"), F.col("p_name").alias("label"))
    claims = t.lineitem.filter("l_quantity > 45").join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select("l_orderkey", "l_linenumber", F.lit("claim"), "s_name")
    return concepts.distinct().unionAll(claims.distinct())


@query(
    "q08_search",
    """SELECT * FROM (SELECT 'author' AS kind, c_custkey AS id, count(o_orderkey) AS works FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_name ILIKE '%01%' GROUP BY 2 ORDER BY works DESC, id LIMIT 10)
    UNION ALL SELECT * FROM (SELECT 'work', o_orderkey, NULL::BIGINT FROM orders WHERE o_orderpriority ILIKE '%urg%' ORDER BY o_orderpriority, o_orderkey LIMIT 10)""",
)
def search(t, limit: int = 20):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("works"))
    found = t.customer.filter(F.col("c_name").ilike("%01%")).join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    people = found.select(F.lit("author").alias("kind"), F.col("c_custkey").alias("id"), F.coalesce("works", F.lit(0)).alias("works")).orderBy(F.desc("works"), "id").limit(limit // 2)
    texts = t.orders.filter(F.col("o_orderpriority").ilike("%urg%")).orderBy("o_orderpriority", "o_orderkey").limit(limit // 2)
    return people.unionAll(texts.select(F.lit("work"), "o_orderkey", F.lit(None).cast("bigint")))
