"""Reports and audits (Q-17 to Q-38)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.aggregates import percent
from ..operators.windows import top_per_group
from ..registry import query


@query("q17_crawl_review", "SELECT source, lang, doc_id FROM documents d JOIN labels USING (doc_id) WHERE quality = 1 QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) <= 5")
def crawl_review(t):
    rows = t.documents.select("doc_id", "source", "lang").join(t.labels.filter("quality = 1").select("doc_id"), "doc_id", "left_semi")
    return top_per_group(rows, 5, ["source", "lang"], ["doc_id"]).select("source", "lang", "doc_id")


@query("q18_reset_failed", "SELECT event_id, CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN 'pending' ELSE event_type END AS status FROM events")
def reset_failed(t):
    return t.events.select("event_id", F.when((F.col("event_type") == "error") & (F.col("user_id") % 2 == 0), "pending").otherwise(F.col("event_type")).alias("status"))


@query("q19_monitor", "SELECT user_id, count(*) AS urls, max(event_id % 7) AS depth, round(count(*) FILTER (event_type <> 'error') * 100.0 / count(*), 3)::DOUBLE AS ok FROM events WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1) GROUP BY 1")
def monitor(t):
    last = t.events.agg(F.max_by("user_id", F.struct("ts", "event_id")).alias("user_id"))  # one row
    rows = t.events.join(F.broadcast(last), "user_id", "left_semi")
    return rows.groupBy("user_id").agg(F.count("*").alias("urls"), F.max(F.col("event_id") % 7).alias("depth"), percent(F.count_if(F.col("event_type") != "error"), F.count("*")).alias("ok"))


@query("q20_corpus_gaps", "SELECT count(*) AS works, count(quality) AS labelled, count(*) FILTER (quality IS NULL) AS missing, count(*) FILTER (regexp_matches(text, '(?i)license')) AS with_license FROM documents LEFT JOIN labels USING (doc_id)")
def corpus_gaps(t):
    return t.documents.join(t.labels, "doc_id", "left").agg(F.count("*").alias("works"), F.count("quality").alias("labelled"), F.count_if(F.col("quality").isNull()).alias("missing"), F.count_if(F.col("text").rlike("(?i)license")).alias("with_license"))


@query(
    "q21_date_audit",
    """SELECT 'too_late' AS finding, count(*) AS n FROM orders WHERE year(o_orderdate) > 1997 UNION ALL SELECT 'low_confidence', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING max(o_totalprice) < 100000)
    UNION ALL SELECT 'conflicting_years', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) >= 3)""",
)
def date_audit(t):
    year = F.year("o_orderdate")
    facts = t.orders.groupBy("o_custkey").agg(F.count_if(year > 1997).alias("late"), F.max("o_totalprice").alias("top"), F.countDistinct(year).alias("years"))
    totals = facts.agg(F.coalesce(F.sum("late"), F.lit(0)).alias("too_late"), F.count_if(F.col("top") < 100000).alias("low_confidence"), F.count_if(F.col("years") >= 3).alias("conflicting_years"))
    return totals.unpivot([], ["too_late", "low_confidence", "conflicting_years"], "finding", "n")


@query("q22_simple_audit", "SELECT year(o_orderdate)::BIGINT AS year, o_orderstatus, count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1993 AND 1997 GROUP BY 1, 2")
def simple_audit(t):
    return t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("year"), "o_orderstatus").agg(F.count("*").alias("n")).filter(F.col("year").between(1993, 1997))


@query("q23_conflicts", "SELECT o_custkey, string_agg(DISTINCT year(o_orderdate)::VARCHAR, ',' ORDER BY year(o_orderdate)::VARCHAR) AS years, count(*) AS n FROM orders GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) > 1")
def conflicts(t):
    years = F.array_sort(F.collect_set(F.year("o_orderdate").cast("string")))
    return t.orders.groupBy("o_custkey").agg(F.array_join(years, ",").alias("years"), F.count("*").alias("n"), F.size(F.collect_set(F.year("o_orderdate"))).alias("k")).filter("k > 1").drop("k")


@query("q24_stratified_sample", "WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) SELECT o_orderkey FROM r WHERE k <= 5 ORDER BY k, n DESC, o_custkey LIMIT 100")
def stratified(t):
    w = Window.partitionBy("o_custkey")
    rows = t.orders.select("o_orderkey", "o_custkey", F.row_number().over(w.orderBy("o_orderkey")).alias("k"), F.count("*").over(w).alias("n")).filter("k <= 5")
    return rows.orderBy("k", F.desc("n"), "o_custkey").limit(100).select("o_orderkey")


@query("q25_status_report", "SELECT lang, count(*) AS n, count(quality) AS dated, round(count(quality) * 100.0 / count(*), 3)::DOUBLE AS pct, CASE WHEN avg(n_chars) < 1000 THEN 'low' WHEN avg(n_chars) < 2400 THEN 'mid' ELSE 'high' END AS band FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def status_report(t):
    rows = t.documents.join(t.labels, "doc_id", "left").groupBy("lang")
    band = F.when(F.avg("n_chars") < 1000, "low").when(F.avg("n_chars") < 2400, "mid").otherwise("high")
    return rows.agg(F.count("*").alias("n"), F.count("quality").alias("dated"), percent(F.count("quality"), F.count("*")).alias("pct"), band.alias("band"))


@query("q26_author_listing", "SELECT c_name, count(o_orderkey) AS works FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1 ORDER BY works DESC, c_name")
def author_listing(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("works"))
    return counts.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_name").agg(F.sum("works").alias("works")).orderBy(F.desc("works"), "c_name")


@query("q29_pages_to_works", "SELECT source, lang, count(*) AS pages, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM documents JOIN labels USING (doc_id) WHERE quality = 1 GROUP BY 1, 2 HAVING count(*) >= 2")
def pages_to_works(t):
    rows = t.documents.select("doc_id", "source", "lang").join(t.labels.filter("quality = 1").select("doc_id"), "doc_id")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",")
    return rows.groupBy("source", "lang").agg(F.count("*").alias("pages"), ids.alias("ids")).filter("pages >= 2")


@query("q32_post_death", "SELECT o_orderpriority AS source, count(*) AS n FROM orders WHERE year(o_orderdate) > 1992 + o_custkey % 5 GROUP BY 1")
def post_death(t):
    return t.orders.filter(F.year("o_orderdate") > 1992 + F.col("o_custkey") % 5).groupBy(F.col("o_orderpriority").alias("source")).agg(F.count("*").alias("n"))


@query("q33_json_distinct", "SELECT DISTINCT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_distinct(t):
    k = F.get_json_object("props", "$.k")
    return t.events.filter(k.isNotNull()).select("event_type", (k.try_cast("bigint") % 3).alias("k")).distinct()


@query("q34_evidence_by_score", "SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 40")
def evidence_by_score(t):
    return t.events.select("event_id", "event_type", "value").orderBy(F.desc("value"), "event_id").limit(40)


@query("q36_model_table", "SELECT event_type AS model, count(*) AS runs, round(avg(value) * 0.7 + max(value) * 0.3, 4) AS weighted FROM events GROUP BY 1 ORDER BY weighted DESC, model")
def model_table(t):
    return t.events.groupBy(F.col("event_type").alias("model")).agg(F.count("*").alias("runs"), F.round(F.avg("value") * 0.7 + F.max("value") * 0.3, 4).alias("weighted")).orderBy(F.desc("weighted"), "model")


@query("q38_url_years", r"SELECT page_id % 50 AS work, min(TRY_CAST(nullif(regexp_extract(url, '/([0-9]{4})(?:\.html?|/)', 1), '') AS INTEGER)) AS year, string_agg(DISTINCT regexp_extract(url, '^[a-z]+', 0), ',' ORDER BY regexp_extract(url, '^[a-z]+', 0)) AS schemes FROM pages GROUP BY 1")
def url_years(t):
    year = F.regexp_extract("url", r"/([0-9]{4})(?:\.html?|/)", 1).try_cast("int")
    return t.pages.groupBy((F.col("page_id") % 50).alias("work")).agg(F.min(year).alias("year"), F.array_join(F.array_sort(F.collect_set(F.regexp_extract("url", "^[a-z]+", 0))), ",").alias("schemes"))
