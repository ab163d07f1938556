"""Aggregations (AG). Distinct counts are exact; ratios guard against empty groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query


def percent(part, whole, places: int = 3):
    """100 * part / whole, rounded; 0 for an empty whole."""
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, places)).otherwise(F.lit(0.0))


@query("ag01_count", "SELECT (SELECT count(*) FROM customer) AS authors, (SELECT count(*) FROM orders) AS works, (SELECT count(*) FROM lineitem) AS paragraphs")
def counts(t):
    one = lambda df, name: df.agg(F.count("*").alias(name))
    return one(t.customer, "authors").crossJoin(one(t.orders, "works")).crossJoin(one(t.lineitem, "paragraphs"))  # one row each


@query("ag02_count_distinct", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS works, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def distinct_counts(t):
    works = t.lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("works"))
    return works.join(t.lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts")), "l_suppkey")


@query("ag03_coverage", "SELECT count(*) AS n, count(quality) AS with_quality, count(toxic) AS with_toxic FROM documents LEFT JOIN labels USING (doc_id)")
def coverage(t):
    return t.documents.join(t.labels, "doc_id", "left").agg(F.count("*").alias("n"), F.count("quality").alias("with_quality"), F.count("toxic").alias("with_toxic"))


@query("ag04_group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def group_count(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type")


@query("ag05_top50", "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 50")
def top50(t):
    return t.part.groupBy("p_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_type").limit(50)


@query("ag06_min_representative", "SELECT source, min(lang) AS lang, min(text) AS text, min(doc_id::VARCHAR) AS id FROM documents GROUP BY 1")
def representative(t):
    return t.documents.groupBy("source").agg(F.min("lang").alias("lang"), F.min("text").alias("text"), F.min(F.col("doc_id").cast("string")).alias("id"))


@query("ag07_max_depth", "SELECT user_id, max(event_id % 9) AS depth FROM events WHERE event_type = 'view' GROUP BY 1")
def max_depth(t):
    return t.events.filter("event_type = 'view'").groupBy("user_id").agg(F.max(F.col("event_id") % 9).alias("depth"))


@query("ag08_having_max", "SELECT user_id, min(value) AS lo, max(value) AS hi, count(*) AS n FROM events GROUP BY 1 HAVING max(value) < 90")
def having_max(t):
    return t.events.groupBy("user_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")).filter("hi < 90")


@query("ag09_having_distinct", "SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS years FROM orders GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) >= 3")
def having_distinct(t):
    return t.orders.groupBy("o_custkey").agg(F.countDistinct(F.year("o_orderdate")).alias("years")).filter("years >= 3")


@query("ag10_array_agg_distinct", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS kinds FROM orders GROUP BY 1")
def array_agg_distinct(t):
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("kinds"))


@query("ag11_array_agg", "SELECT o_custkey, string_agg(o_orderstatus, '' ORDER BY o_orderstatus) AS states FROM orders GROUP BY 1")
def array_agg(t):
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("o_orderstatus")), "").alias("states"))


@query("ag12_fan_out", "SELECT c_custkey, count(*) AS inflated, count(DISTINCT o_orderkey) AS works FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def fan_out(t):
    """The product of two child tables inflates a plain count; the distinct count is the right one."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    rows = t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.sum("n").alias("inflated"), F.count("*").alias("works"))
    return rows.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "inflated", "works")


@query("ag13_percent", "SELECT source, CASE WHEN count(*) > 0 THEN round(count(quality) * 100.0 / count(*), 3) ELSE 0 END::DOUBLE AS pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def percents(t):
    return t.documents.join(t.labels, "doc_id", "left").groupBy("source").agg(percent(F.count("quality"), F.count("*")).alias("pct"))


@query("ag14_group_collect", "SELECT role, count(*) AS n, count(DISTINCT conv_id) AS convs FROM conversations GROUP BY 1")
def group_collect(t):
    return t.conversations.groupBy("role", "conv_id").agg(F.count("*").alias("m")).groupBy("role").agg(F.sum("m").alias("n"), F.count("*").alias("convs"))


@query("ag15_group_size_filter", "SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1 HAVING count(*) >= 4")
def group_size_filter(t):
    return t.conversations.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n >= 4")


@query("ag16_histogram", "SELECT CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 5000 THEN 'medium' ELSE 'long' END AS band, count(*) AS n FROM documents GROUP BY 1")
def histogram(t):
    band = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 5000, "medium").otherwise("long")
    return t.documents.groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@query("ag17_min_year", "SELECT o_custkey, min(TRY_CAST(nullif(regexp_extract('/w/' || year(o_orderdate) || '/', '/([0-9]{4})/', 1), '') AS INTEGER))::BIGINT AS year FROM orders GROUP BY 1")
def min_year(t):
    url = F.concat(F.lit("/w/"), F.year("o_orderdate").cast("string"), F.lit("/"))
    return t.orders.groupBy("o_custkey").agg(F.min(F.regexp_extract(url, "/([0-9]{4})/", 1).try_cast("bigint")).alias("year"))


@query("ag18_max_score_per_year", "SELECT o_custkey, year(o_orderdate)::BIGINT AS year, max(o_totalprice) AS score, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS first_key FROM orders GROUP BY 1, 2")
def max_score(t):
    best = F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey")))
    return t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("year")).agg(F.max("o_totalprice").alias("score"), best.alias("first_key"))


@query("ag19_argmax_role", "SELECT o_custkey, o_orderpriority AS role, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderstatus, o_orderkey) = 1")
def argmax_role(t):
    best = F.min(F.struct((-F.col("o_totalprice")).alias("c"), "o_orderstatus", "o_orderkey"))  # one pass, combined map-side
    return t.orders.groupBy("o_custkey", F.col("o_orderpriority").alias("role")).agg(best.alias("b")).select("o_custkey", "role", "b.o_orderkey")


@query("ag20_run_counters", "SELECT user_id, count(*) AS scanned, count(*) FILTER (event_type = 'purchase') AS updated, count(*) FILTER (event_type = 'view') AS skipped, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1")
def run_counters(t):
    of = lambda kind, name: F.count_if(F.col("event_type") == kind).alias(name)
    return t.events.groupBy("user_id").agg(F.count("*").alias("scanned"), of("purchase", "updated"), of("view", "skipped"), of("error", "failed"))


@query("ag21_two_level", "SELECT n_regionkey::BIGINT AS region, sum(n)::BIGINT AS works FROM nation JOIN (SELECT c_nationkey, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1) ON c_nationkey = n_nationkey GROUP BY 1")
def two_level(t):
    by_nation = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("n").alias("n"))
    return by_nation.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").cast("bigint").alias("region")).agg(F.sum("n").alias("works"))


@query("ag22_model_benchmark", "SELECT event_type AS model, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(avg(value), 4) AS avg_time, arg_max(event_id, (value, event_id)) AS best FROM events GROUP BY 1")
def model_benchmark(t):
    return t.events.groupBy(F.col("event_type").alias("model")).agg(F.round(F.avg((F.col("value") > 50).cast("double")), 6).alias("accuracy"), F.round(F.avg("value"), 4).alias("avg_time"), F.max_by("event_id", F.struct("value", "event_id")).alias("best"))


@query("ag23_two_dimensions", "SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (o_orderpriority = '5-LOW') AS low FROM orders GROUP BY 1")
def two_dimensions(t):
    return t.orders.groupBy("o_orderstatus").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).agg(F.count(F.lit(1))).select("o_orderstatus", F.coalesce("1-URGENT", F.lit(0)).alias("urgent"), F.coalesce("5-LOW", F.lit(0)).alias("low"))
