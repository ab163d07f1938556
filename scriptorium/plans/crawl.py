"""Crawl plans over recorded pages: bounded discovery, resume, stages, samples for classification (GR-02, GR-03, GR-06, SL-10, ST-06, DT-03, TF-20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTHS, month_number
from ..functions.replies import duration, json_hash
from ..functions.urls import directory, is_html, part
from ..operators.graph import breadth_first, checkpointed
from ..operators.windows import top_per_group
from ..registry import query


def bounded_crawl(links: DataFrame, root: str, max_depth: int, max_urls: int) -> DataFrame:
    """links(src, dst, place) -> (id, depth, parent): pages below the root's directory, nearest first, max_urls at most."""
    spark = links.sparkSession
    below = directory(F.lit(root))
    inside = links.filter(F.col("dst").startswith(F.concat(below, F.lit("/"))) & is_html(F.col("dst")))
    found = breadth_first(spark.createDataFrame([(root,)], "id string"), checkpointed(inside), max_depth)
    return found.orderBy("depth", "id").limit(max_urls)


def resume(catalog: DataFrame, links: DataFrame) -> DataFrame:
    """Frontier of an interrupted crawl: failed pages, and children of fetched ones that the catalog lacks."""
    failed = catalog.filter("status = 'error'").select("id")
    children = links.join(catalog.filter("status = 'fetched'").select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
    return failed.unionByName(children.join(catalog, "id", "left_anti")).distinct()


def url_date_loose(url: Column) -> Column:
    """Dates of less regular addresses: no closing part, month names, no range checks (DT-03)."""
    get = lambda p, i: F.nullif(F.regexp_extract(url, p, i), F.lit(""))
    named = "(?i)/([0-9]{4})/(" + "|".join(m[:3] for m in MONTHS) + ")"
    day, month = r"/([0-9]{4})/([0-9]{2})/([0-9]{2})", r"/([0-9]{4})/([0-9]{2})/"
    return F.coalesce(
        F.when(get(day, 1).isNotNull(), F.concat_ws("-", get(day, 1), get(day, 2), get(day, 3))),
        F.when(get(named, 1).isNotNull(), F.concat_ws("-", get(named, 1), F.lpad(month_number(get(named, 2)).cast("string"), 2, "0"))),
        F.when(get(month, 1).isNotNull(), F.concat_ws("-", get(month, 1), get(month, 2))),
        get("/([0-9]{4})/", 1),
    )


@query("gr02_bounded_crawl", "WITH RECURSIVE w AS (SELECT 1::BIGINT AS n, 0 AS depth UNION SELECT n * 2 + k, depth + 1 FROM w, (VALUES (0), (1)) v(k) WHERE depth < 5 AND n * 2 + k <= (SELECT max(page_id) FROM pages)) SELECT min(depth)::BIGINT AS depth, n AS page FROM w GROUP BY n")
def crawl(t):
    """Pages link to 2n and 2n + 1 below one directory, and to addresses outside it."""
    url = lambda n: F.concat(F.lit("https://e.org/a/p"), n.cast("string"), F.lit(".htm"))
    n = F.col("page_id")
    most = t.pages.agg(F.max("page_id").alias("most"))  # one row
    rows = t.pages.filter("page_id > 0").crossJoin(F.broadcast(most))
    links = rows.select(url(n).alias("src"), F.posexplode(F.array(F.when(n * 2 <= F.col("most"), url(n * 2)), F.when(n * 2 + 1 <= F.col("most"), url(n * 2 + 1)), F.lit("https://e.org/b/out.htm"))).alias("place", "dst")).filter("dst IS NOT NULL")
    found = bounded_crawl(links, "https://e.org/a/p1.htm", 5, 10_000)
    return found.select(F.col("depth").cast("bigint").alias("depth"), F.regexp_extract("id", "p([0-9]+)", 1).cast("bigint").alias("page"))


@query("gr03_resume", "SELECT event_id AS id FROM events WHERE event_type = 'error' UNION SELECT event_id + 1000000 FROM events WHERE event_type = 'view'")
def resumed(t):
    """Every page links to itself and to a child that the catalog lacks; ids of children are apart from those of pages, however many events there are."""
    status = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "fetched").otherwise("new")
    address = lambda kind, n: F.struct(F.lit(kind).alias("kind"), n.alias("n"))
    page = address("page", F.col("event_id"))
    catalog = t.events.select(page.alias("id"), status.alias("status"))
    links = t.events.select(page.alias("src"), F.explode(F.array(address("child", F.col("event_id") + 1000000), page)).alias("dst"))
    return resume(catalog, links).select(F.col("id.n").alias("id")).distinct()


@query("gr06_staged_discovery", r"WITH p AS (SELECT page_id, regexp_extract(url, '^https?://[^/]*/([a-z]{2})/', 1) AS lang, regexp_extract(url, '^https?://([^/]*)', 1) AS host FROM pages), h AS (SELECT lang, host FROM (SELECT DISTINCT lang, host FROM p) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY host) <= 5) SELECT lang, host, page_id FROM p JOIN h USING (lang, host) QUALIFY row_number() OVER (PARTITION BY lang, host ORDER BY page_id) <= 3")
def staged(t):
    """Languages, then up to five sites of each, then up to three pages of each site."""
    pages = t.pages.select("page_id", F.regexp_extract("url", r"^https?://[^/]*/([a-z]{2})/", 1).alias("lang"), part(F.col("url"), "host").alias("host"))
    sites = top_per_group(pages.select("lang", "host").distinct(), 5, ["lang"], ["host"])
    return top_per_group(pages.join(sites, ["lang", "host"]), 3, ["lang", "host"], ["page_id"]).select("lang", "host", "page_id")


@query("dt03_loose_url_dates", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y') END AS date FROM orders")
def loose(t):
    y, k = F.date_format("o_orderdate", "yyyy"), F.col("o_orderkey") % 3
    name = F.element_at(F.array(*map(F.lit, MONTHS)), F.month("o_orderdate"))
    url = F.when(k == 0, F.concat(F.lit("/x/"), F.date_format("o_orderdate", "yyyy/MM/dd"))).when(k == 1, F.concat(F.lit("/x/"), y, F.lit("/"), name)).otherwise(F.concat(F.lit("/x/"), y, F.lit("/index")))
    return t.orders.select("o_orderkey", url_date_loose(url).alias("date"))


@query("tf20_penalised_votes", "SELECT o_custkey, arg_max(y, (n - CASE WHEN y >= 1997 THEN 10 ELSE 0 END, -y))::INTEGER AS year FROM (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2) WHERE n - CASE WHEN y >= 1997 THEN 10 ELSE 0 END > 0 GROUP BY 1")
def penalised(t, recent: int = 1997, penalty: int = 10):
    """Most frequent year, recent ones penalised as likely page dates; none if no vote is left."""
    votes = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    votes = votes.withColumn("v", F.col("n") - F.when(F.col("y") >= recent, penalty).otherwise(0)).filter("v > 0")
    return votes.groupBy("o_custkey").agg(F.max_by("y", F.struct("v", -F.col("y"))).cast("int").alias("year"))


@query("fn03_canonical_json", "SELECT event_id, true AS same FROM events")
def hashes(t):
    """Equal JSON values hash alike however they are written."""
    spaced = F.concat(F.lit('{"b": 1,  "a": '), "props", F.lit("}"))
    tight = F.concat(F.lit('{"a":'), "props", F.lit(',"b":1}'))
    return t.events.select("event_id", (json_hash(spaced) == json_hash(tight)).alias("same"))


@query("fn25_durations", "SELECT event_id, CASE WHEN s < 60 THEN printf('%.0fs', s::DOUBLE) WHEN s < 3600 THEN printf('%.1fm', s / 60.0) ELSE printf('%.1fh', s / 3600.0) END AS took FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id % 60 ELSE event_id * 360 % 36000 END AS s FROM events)")
def durations(t):
    return t.events.select("event_id", duration(F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 60).otherwise(F.col("event_id") * 360 % 36000)).alias("took"))


@query("sl10_priority_urls", "SELECT page_id % 40 AS work, arg_min(page_id, (CASE WHEN contains(url, '?') THEN 1 ELSE 0 END, length(url), page_id)) AS first_page FROM pages GROUP BY 1")
def priority(t):
    """First address to look at for each work: without a query, shortest, then smallest."""
    key = F.struct(F.col("url").contains("?").cast("int").alias("q"), F.length("url").alias("l"), "page_id")
    return t.pages.groupBy((F.col("page_id") % 40).alias("work")).agg(F.min_by("page_id", key).alias("first_page"))
