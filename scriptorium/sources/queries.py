"""Sources and sinks over the driver's tables (SRC)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import contracts
from ..registry import query
from ..streaming.incremental import shared
from .files import json_lines, mapping
from .model import RecordedClient, completions
from .tables import views
from .sinks import append_top, cache_key, fresh, insert_absent, overwrite


@query("src04_cache_misses", "SELECT count(*) AS requests, count(*) FILTER (event_type = 'view' AND epoch(ts) >= (SELECT max(epoch(ts)) FROM events) - 86400) AS hits FROM events")
def cache_misses(t):
    """Requests answered by cached rows younger than a day."""
    requests = t.events.select(cache_key(F.col("event_id").alias("id"), F.col("props").alias("p")).alias("key"))
    now = t.events.agg(F.max("ts").alias("now"))  # one row
    cache = t.events.filter("event_type = 'view'").select(cache_key(F.col("event_id").alias("id"), F.col("props").alias("p")).alias("key"), F.col("ts").cast("timestamp").alias("fetched_at")).crossJoin(F.broadcast(now))
    hits = fresh(cache, F.col("now").cast("timestamp"), 86400).select("key", F.lit(1).alias("hit"))
    return requests.join(hits, "key", "left").agg(F.count("*").alias("requests"), F.count("hit").alias("hits"))


@query("src06_manifest", "SELECT regexp_extract(url, '^https?://([^/]*)', 1) AS root, count(*) AS pages, string_agg(page_id::VARCHAR, ',' ORDER BY page_id) AS snapshots FROM pages GROUP BY 1")
def manifest(t):
    ids = F.transform(F.array_sort(F.collect_list("page_id")), lambda x: x.cast("string"))
    return t.pages.groupBy(F.regexp_extract("url", "^https?://([^/]*)", 1).alias("root")).agg(F.count("*").alias("pages"), F.array_join(ids, ",").alias("snapshots"))


@query("src15_insert_absent", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, upper(c_name) FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 = 0")
def absent(t):
    target = t.customer.filter("c_custkey % 2 = 0").select("c_custkey", "c_name")
    return insert_absent(target, t.customer.filter("c_custkey % 3 = 0").select("c_custkey", F.upper("c_name").alias("c_name")), ["c_custkey"])


@query("src16_append_top8", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 8")
def top8(t):
    return append_top(t.events.select("user_id", "event_id", "value"), 8, "user_id", [F.desc("value"), "event_id"]).select("user_id", "event_id")


@query("src17_overwrite", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'new' ELSE p_brand END AS p_brand FROM part")
def overwritten(t):
    return overwrite(t.part.select("p_partkey", "p_brand"), t.part.filter("p_partkey % 4 = 0").select("p_partkey", F.lit("new").alias("p_brand")), ["p_partkey"])


@query("src17_only_missing", "SELECT d.doc_id, coalesce(l.quality, 9)::INTEGER AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def only_missing(t):
    target = t.documents.select("doc_id").join(t.labels.select("doc_id", F.col("quality").cast("int").alias("quality")), "doc_id", "left")
    return overwrite(target, t.documents.select("doc_id", F.lit(9).alias("quality")), ["doc_id"], only_missing=True)


@query("src18_bulk_update", "SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN o_custkey - 1 ELSE o_custkey END AS o_custkey FROM orders")
def bulk_update(t):
    return t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("o_custkey"))


@query("src19_delete", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW')")
def delete(t):
    return t.customer.join(t.orders.filter("o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("src20_json_rows", "SELECT o_orderkey, concat('{\"id\":', o_orderkey, ',\"status\":\"', o_orderstatus, '\"}') AS json FROM orders")
def json_rows(t):
    return t.orders.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))).alias("json"))


def fetch_outcomes(attempts, most: int = 3):
    """attempts(url, attempt, status) -> (url, outcome, attempts, waited): the first answer among most tries, 2 ** attempt seconds apart (SRC-02).

    200 is fetched and 304 cached; any other status is tried again, and is an error after the last try.
    """
    tried = attempts.filter(F.col("attempt") <= most).groupBy("url").agg(F.min(F.when(F.col("status").isin(200, 304), F.struct("attempt", "status"))).alias("won"), F.max("attempt").alias("last"))
    used = F.coalesce("won.attempt", "last")
    outcome = F.when(F.col("won.status") == 200, "fetched").when(F.col("won.status") == 304, "cached").otherwise("error")
    return tried.select("url", outcome.alias("outcome"), used.alias("attempts"), (F.pow(F.lit(2.0), used) - 2).cast("bigint").alias("waited"))


@query(
    "src02_fetch_outcomes",
    "SELECT event_id AS url, CASE k WHEN 0 THEN 'fetched' WHEN 1 THEN 'cached' WHEN 2 THEN 'fetched' ELSE 'error' END AS outcome, CASE k WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 3 END::INTEGER AS attempts, CASE WHEN k < 2 THEN 0 ELSE 6 END::BIGINT AS waited FROM (SELECT event_id, event_id % 4 AS k FROM events)",
)
def fetches(t):
    """Recorded tries of conditional fetches: at once, unchanged, after two failures, and never within three tries."""
    k = F.col("event_id") % 4
    statuses = F.when(k == 0, F.array(F.lit(200))).when(k == 1, F.array(F.lit(304))).when(k == 2, F.array(F.lit(503), F.lit(429), F.lit(200))).otherwise(F.array(F.lit(500), F.lit(500), F.lit(404), F.lit(200)))
    rows = t.events.select(F.col("event_id").alias("url"), F.posexplode(statuses).alias("at", "status"))
    return fetch_outcomes(rows.select("url", (F.col("at") + 1).alias("attempt"), "status"))


@query("src07_relational_views", "SELECT c_name, count(o_orderkey) AS works FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def relational(t):
    """Stored SQL over views of the tables."""
    return views(t, "customer", "orders").sql("SELECT c_name, count(o_orderkey) AS works FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")


#: A mapping in both shapes: lists of variants, and a display name with aliases.
MAPPING = """
'1-URGENT': [urgent, '1-urgent']
'5-LOW': {display: Low, aliases: ['5-low', low]}
'3-MEDIUM': {display: Medium, aliases: ['3-medium']}
empty: []
"""


@query("src08_yaml_mapping", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1-URGENT' WHEN '5-LOW' THEN 'Low' WHEN '3-MEDIUM' THEN 'Medium' END AS display FROM orders")
def mapped(t):
    names = mapping(t.spark, MAPPING)  # a file's few rows
    return t.orders.select("o_orderkey", F.lower("o_orderpriority").alias("variant")).join(F.broadcast(names), "variant", "left").select("o_orderkey", "display")


@query(
    "src09_contract_columns",
    "SELECT * FROM (VALUES ('claims[].claim_text', 'string', true), ('claims[].polarity', 'string', false), ('claims[].confidence', 'double', false), ('claims[].evidence[]', 'bigint', true)) v(path, type, required)",
)
def contract_columns(t):
    """The leaves of a contract's schema, as Spark types."""
    return t.spark.createDataFrame(contracts.columns(contracts.CLAIMS), "path string, type string, required boolean")


@query("src10_json_lines", "SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN event_type END AS kind, event_id % 13 = 0 AS damaged FROM events")
def lines(t):
    """Results written a line each and read back under a schema; damaged lines are kept whole."""
    path = f"{shared(t.spark)}/lines"
    line = F.concat(F.lit('{"kind": "'), "event_type", F.lit('", "id": '), F.col("event_id").cast("string"), F.when(F.col("event_id") % 13 == 0, "").otherwise("}"))
    t.events.select(line.alias("value")).write.text(path)
    rows = json_lines(t.spark, path, "kind string, id long").select("kind", "id", "_corrupt")
    number = F.coalesce("id", F.regexp_extract("_corrupt", '"id": ([0-9]+)', 1).try_cast("long"))
    return rows.select(number.alias("event_id"), F.when(F.col("_corrupt").isNull(), F.col("kind")).alias("kind"), F.col("_corrupt").isNotNull().alias("damaged"))


_REPLIES = """SELECT event_id AS key, CASE k WHEN 0 THEN '{"kind":"fine","n":' || event_id || '}' WHEN 1 THEN '{"kind":"repair","n":' || event_id || '}' WHEN 2 THEN '{"kind":"busy","n":' || event_id || '}' END AS reply,
 [1, 2, 3, 3, 3][k + 1]::INTEGER AS attempts, CASE k WHEN 3 THEN 'no JSON object' WHEN 4 THEN 'ConnectionError: try later' END AS error FROM (SELECT event_id, event_id % 5 AS k FROM events)"""


def _asked(t):
    kind = F.element_at(F.array(*map(F.lit, ("fine", "repair", "busy", "prose", "down"))), (F.col("event_id") % 5 + 1).cast("int"))
    return completions(t.events.select(F.col("event_id").alias("key"), F.concat(kind, F.lit(" "), F.col("event_id").cast("string")).alias("prompt")), RecordedClient)


@query("src11_completions", f"SELECT key, reply FROM ({_REPLIES}) WHERE reply IS NOT NULL")
def replies(t):
    """Replies of an injected client, as canonical JSON."""
    return _asked(t).filter("reply IS NOT NULL").select("key", "reply")


@query("st07_retries", f"SELECT key, attempts, error FROM ({_REPLIES})")
def retries(t):
    """How often each prompt was asked, with a repair note or after a failure, and what went wrong in the end."""
    return _asked(t).select("key", "attempts", "error")


def label_batches(ids, size: int = 50):
    """ids(id) -> (batch, n, ids): requests of at most size ids each, in order of id within a spread of ranges (SRC-12).

    Places are counted within ranges of the ids, so no task sees them all; the last batch of a range may be small.
    """
    from pyspark.sql import Window

    rows = ids.select("id").distinct().withColumn("range", F.floor(F.col("id") / (size * 100)))
    placed = rows.withColumn("place", F.floor((F.row_number().over(Window.partitionBy("range").orderBy("id")) - 1) / size))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda x: x.cast("string")), "|")
    return placed.groupBy("range", "place").agg(F.count("*").alias("n"), joined.alias("ids")).select((F.col("range") * 100 + F.col("place")).alias("batch"), "n", "ids")


@query("src12_label_batches", "SELECT o_custkey // 5000 * 100 + p AS batch, count(*) AS n, string_agg(o_custkey::VARCHAR, '|' ORDER BY o_custkey) AS ids FROM (SELECT o_custkey, (row_number() OVER (PARTITION BY o_custkey // 5000 ORDER BY o_custkey) - 1) // 50 AS p FROM (SELECT DISTINCT o_custkey FROM orders)) GROUP BY o_custkey // 5000, p")
def batches(t):
    """Entities that works name, in look-ups of fifty."""
    return label_batches(t.orders.select(F.col("o_custkey").alias("id")))
