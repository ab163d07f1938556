"""Sorts, limits, pages and samples (SL). Every limited order is total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import query


def ordered(df: DataFrame, column: str, direction: str, tie: str) -> DataFrame:
    """Sort by a named column, NULLS LAST in both directions, ties by key."""
    key = F.desc_nulls_last(column) if direction == "desc" else F.asc_nulls_last(column)
    return df.orderBy(key, tie)


def page(df: DataFrame, column: str, tie: str, limit: int, offset: int) -> DataFrame:
    """A page with the total before paging on every row."""
    total = df.agg(F.count("*").alias("total"))
    return ordered(df, column, "asc", tie).offset(offset).limit(limit).crossJoin(F.broadcast(total))  # one row


@query("sl01_nulls_last", "SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id ORDER BY quality DESC NULLS LAST, d.doc_id LIMIT 60")
def nulls_last(t):
    return ordered(t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality"), "quality", "desc", "doc_id").limit(60)


@query("sl02_page", "SELECT o_orderkey, o_orderpriority, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS total FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderpriority, o_orderkey LIMIT 20 OFFSET 10")
def paged(t):
    return page(t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 20, 10)


@query("sl03_top_k", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def top_k(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


@query("sl04_halved_limit", "(SELECT 'author' AS kind, c_custkey AS id FROM customer WHERE c_name ILIKE '%1%' ORDER BY c_custkey LIMIT 10) UNION ALL (SELECT 'work', o_orderkey FROM orders WHERE o_orderpriority ILIKE '%1%' ORDER BY o_orderkey LIMIT 10)")
def halved_limit(t, limit: int = 21):
    authors = t.customer.filter(F.col("c_name").ilike("%1%")).orderBy("c_custkey").limit(limit // 2).select(F.lit("author").alias("kind"), F.col("c_custkey").alias("id"))
    return authors.unionAll(t.orders.filter(F.col("o_orderpriority").ilike("%1%")).orderBy("o_orderkey").limit(limit // 2).select(F.lit("work"), F.col("o_orderkey")))


@query("sl05_first_by", "SELECT source, arg_min(doc_id, (lang, doc_id)) AS first_id FROM documents GROUP BY 1")
def first_by(t):
    return t.documents.groupBy("source").agg(F.min_by("doc_id", F.struct("lang", "doc_id")).alias("first_id"))


@query("sl06_seeded_sample")
def seeded_sample(t, n: int = 25, seed: int = 7):
    """Random rows by a seeded hash, so that reruns and other partitionings agree."""
    return t.documents.select("doc_id", "lang").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n)


@query("sl07_stable_ties", "SELECT o_orderkey FROM orders ORDER BY -round(o_totalprice / 100000), o_orderstatus, coalesce(nullif(o_orderpriority, '5-LOW'), ''), o_orderkey LIMIT 40")
def stable_ties(t):
    locator = F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit(""))
    return t.orders.orderBy(-F.round(F.col("o_totalprice") / 100000), "o_orderstatus", locator, "o_orderkey").limit(40).select("o_orderkey")


@query("sl08_null_aware_key", "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id ORDER BY toxic IS NULL, -toxic, d.doc_id LIMIT 30")
def null_aware(t):
    return t.documents.join(t.labels, "doc_id", "left").orderBy(F.desc_nulls_last("toxic"), "doc_id").limit(30).select("doc_id")


def url_rank(url):
    """Sort key of a work's pages: index, preface, numbered chapters, the rest by name."""
    name = F.regexp_extract(F.lower(url), r"([^/?#]*)/?(?:[?#].*)?$", 1)
    chapter = F.regexp_extract(name, r"^ch(?:apter)?[-_]?0*([0-9]{1,9})", 1).try_cast("int")
    rank = F.when(name.startswith("index"), 0).when(name.startswith("preface"), 1).when(chapter.isNotNull(), 2).otherwise(3)
    return F.struct(rank.alias("rank"), F.coalesce(chapter, F.lit(0)).alias("chapter"), name.alias("name"))


@query("sl09_url_rank", "SELECT page_id, row_number() OVER (ORDER BY CASE WHEN page_id % 7 = 0 THEN 0 WHEN page_id % 7 = 1 THEN 1 WHEN page_id % 7 < 5 THEN 2 ELSE 3 END, CASE WHEN page_id % 7 IN (2, 3, 4) THEN page_id ELSE 0 END, page_id::VARCHAR, page_id) AS place FROM pages ORDER BY place LIMIT 30")
def url_ranked(t):
    p = F.col("page_id").cast("string")
    m = F.col("page_id") % 7
    url = F.when(m == 0, F.concat(F.lit("/w/index"), p, F.lit(".htm"))).when(m == 1, F.concat(F.lit("/w/preface"), p)).when(m < 5, F.concat(F.lit("/w/ch"), p)).otherwise(F.concat(F.lit("/w/x"), p))
    rows = t.pages.select("page_id", url_rank(url).alias("key")).withColumn("tail", F.regexp_extract("key.name", "([0-9]+)", 1))
    top = rows.orderBy("key.rank", "key.chapter", "tail", "page_id").limit(30)
    from pyspark.sql import Window

    return top.select("page_id", F.row_number().over(Window.orderBy("key.rank", "key.chapter", "tail", "page_id")).cast("bigint").alias("place"))  # 30 rows


@query("sl11_clusters_by_size", "SELECT p_brand, count(*) AS n, min(p_partkey) AS first_seen FROM part GROUP BY 1 ORDER BY n DESC, first_seen LIMIT 20")
def clusters_by_size(t):
    return t.part.groupBy("p_brand").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(20)


@query("sl12_difference_sort", "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_extendedprice - l_quantity * 1000 DESC, l_orderkey, l_linenumber LIMIT 25")
def difference_sort(t):
    return t.lineitem.orderBy(F.desc(F.col("l_extendedprice") - F.col("l_quantity") * 1000), "l_orderkey", "l_linenumber").limit(25).select("l_orderkey", "l_linenumber")
