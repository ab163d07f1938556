"""Scalar functions over the driver's tables (FN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query
from . import contracts, dates, identity, names, replies, text, urls


@query("fn01_hashes", "SELECT doc_id, sha256(text) AS h FROM documents")
def hashes(t):
    return t.documents.select("doc_id", identity.text_hash(F.col("text")).alias("h"))


_AUTHOR, _TITLE = identity.uuid5_sql(identity.AUTHOR, "trim(c_name)"), "trim(o_orderpriority)"


@query("fn02_identifiers", f"SELECT o_orderkey, author_id, {identity.uuid5_sql(identity.WORK, 'author_id || chr(58) || ' + _TITLE)} AS work_id FROM (SELECT o_orderkey, o_orderpriority, {_AUTHOR} AS author_id FROM orders JOIN customer ON o_custkey = c_custkey)")
def identifiers(t):
    authors = t.customer.select(F.col("c_custkey").alias("o_custkey"), identity.author_id(F.col("c_name")).alias("author_id"))
    return t.orders.join(authors, "o_custkey").select("o_orderkey", "author_id", identity.work_id(F.col("author_id"), F.col("o_orderpriority")).alias("work_id"))


@query("fn04_group_hash", "SELECT conv_id, sha256(string_agg(turn::VARCHAR, '|' ORDER BY turn)) AS h FROM conversations GROUP BY 1")
def group_hash(t):
    ids = F.transform(F.array_sort(F.collect_list("turn")), lambda x: x.cast("string"))
    return t.conversations.groupBy("conv_id").agg(identity.group_hash(ids).alias("h"))


_CANON = r"concat(lower(regexp_extract(url, '^([A-Za-z]+)://', 1)), '://', lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1))"


@query("fn05_canonical_url", f"SELECT page_id, {_CANON} AS canonical FROM pages")
def canonical(t):
    return t.pages.select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query("fn06_directory", r"SELECT page_id, concat(regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1), regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', ''), '/?[^/]*$', '')) AS dir FROM pages")
def directory(t):
    return t.pages.select("page_id", urls.directory(F.col("url")).alias("dir"))


@query("fn07_html_url", r"SELECT page_id, NOT regexp_matches(lower(concat(url, CASE page_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.htm' ELSE '' END)), '\.(pdf|txt|jpg|jpeg|png|gif|svg|css|js|json|xml|zip|tar|gz|mp3|mp4|avi|mov|wav|epub|mobi|azw3|prc)$') AS ok FROM pages")
def html_url(t):
    end = F.when(F.col("page_id") % 3 == 0, ".pdf").when(F.col("page_id") % 3 == 1, ".htm").otherwise("")
    return t.pages.select("page_id", urls.is_html(F.concat("url", end)).alias("ok"))


@query("fn09_likely_content", r"SELECT page_id, NOT (contains(url, '?') OR page_id % 4 = 0) AS ok FROM pages")
def likely_content(t):
    part = F.when(F.col("page_id") % 4 == 0, "/subject/x").when(F.col("page_id") % 4 == 1, "/archive/y").otherwise("")
    head, query_ = F.regexp_extract("url", r"^([^?#]*)", 1), F.regexp_extract("url", r"(\?[^#]*)", 1)
    return t.pages.select("page_id", urls.likely_content(F.concat(head, part, query_)).alias("ok"))


@query(
    "fn10_canonical_title",
    "SELECT title, 'The State of ' || CASE p WHEN 'HIGH' THEN 'High' WHEN 'URGENT' THEN 'Urgent' WHEN 'MEDIUM' THEN 'Medium' WHEN 'NOT SPECIFIED' THEN 'Not Specified' WHEN 'LOW' THEN 'Low' END || ' in Vol II' AS canonical, n FROM (SELECT 'THE STATE OF ' || upper(substr(o_orderpriority, 3)) || ' IN VOL II' AS title, upper(substr(o_orderpriority, 3)) AS p, count(*) AS n FROM orders GROUP BY 1, 2)",
)
def titles(t):
    """Titles in capitals get title case; others keep theirs."""
    return t.orders.groupBy(F.concat(F.lit("THE STATE OF "), F.upper(F.substring("o_orderpriority", 3, 99)), F.lit(" IN VOL II")).alias("title")).agg(F.count("*").alias("n")).select("title", names.canonical_title("title").alias("canonical"), "n")


@query("fn11_match_form", "SELECT c_custkey, regexp_replace(trim(replace(lower(c_name || ' Jr.'), '.', '')), ' jr$', '') AS form FROM customer")
def match_form(t):
    return t.customer.select("c_custkey", names.match_form(F.concat("c_name", F.lit(" Jr."))).alias("form"))


@query(
    "fn12_similarity",
    "SELECT a.n_name AS a, b.n_name AS b, 2.0 * (7 + CASE WHEN regexp_matches(substr(b.n_name, 8), '[' || substr(a.n_name, 8) || ']') THEN 1 ELSE 0 END) / (length(a.n_name) + length(b.n_name)) AS ratio FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
)
def similarity(t):
    pairs = t.nation.alias("a").join(t.nation.alias("b"), (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey")))
    return pairs.select(F.col("a.n_name").alias("a"), F.col("b.n_name").alias("b")).select("a", "b", names.similarity("a", "b").alias("ratio"))


@query("fn16_cluster_key", r"SELECT p_partkey, trim(regexp_replace(lower(p_name || ' (x-y) Z!'), '[^\w\-]+', ' ', 'g')) AS key FROM part")
def cluster_key(t):
    return t.part.select("p_partkey", text.cluster_key(F.concat("p_name", F.lit(" (x-y) Z!"))).alias("key"))


@query("fn22_http_status", "SELECT event_id, CASE code WHEN 200 THEN 'fetched' WHEN 304 THEN 'cached' WHEN 404 THEN 'not_found' ELSE CASE WHEN code >= 400 THEN 'error' ELSE 'skipped' END END AS status FROM (SELECT event_id, [200, 304, 404, 500, 302][event_id % 5 + 1] AS code FROM events)")
def http_status(t):
    code = F.element_at(F.array(*map(F.lit, (200, 304, 404, 500, 302))), (F.col("event_id") % 5 + 1).cast("int"))
    return t.events.select("event_id", catalog_status(code).alias("status"))


def catalog_status(code):
    return F.when(code == 200, "fetched").when(code == 304, "cached").when(code == 404, "not_found").when(code >= 400, "error").otherwise("skipped")


@query("fn23_sort_name", r"SELECT p_partkey, regexp_replace(p_name, '^(.*) ([^ ]+)$', '\2, \1') AS name_sort FROM part")
def sort_name(t):
    return t.part.select("p_partkey", names.sort_name(F.col("p_name")).alias("name_sort"))


@query("fn26_token_estimate", "SELECT doc_id, length(text) // 4 AS tokens FROM documents")
def tokens(t):
    return t.documents.select("doc_id", F.floor(F.length("text") / 4).alias("tokens"))


@query("fn27_prompt_lines", "SELECT conv_id, coalesce(string_agg('[' || i || '] ' || text, chr(10) ORDER BY i), '(none)') AS prompt FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations) GROUP BY 1")
def prompt_lines(t):
    rows = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("a"))
    lines = F.transform("a", lambda x, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), x["text"]))
    return rows.select("conv_id", F.coalesce(F.nullif(F.array_join(lines, "\n"), F.lit("")), F.lit("(none)")).alias("prompt"))


@query("fn28_longest_name", "SELECT p_brand, arg_max(p_name, (length(p_name), -p_partkey)) AS name FROM part GROUP BY 1")
def longest_name(t):
    return t.part.groupBy("p_brand").agg(F.max_by("p_name", F.struct(F.length("p_name"), -F.col("p_partkey"))).alias("name"))


@query("fn30_arrays", "SELECT conv_id, len(a) AS n, a[1:3] [1] AS head, list_min(list_transform(a, lambda x: length(x))) AS shortest, list_contains(r, 'user') AS has_user FROM (SELECT conv_id, list(text ORDER BY turn) AS a, list(role ORDER BY turn) AS r FROM conversations GROUP BY 1)")
def arrays(t):
    rows = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("a"))
    texts = F.transform("a", lambda x: x["text"])
    return rows.select("conv_id", F.size("a").cast("bigint").alias("n"), F.slice(texts, 1, 3)[0].alias("head"), F.array_min(F.transform(texts, lambda x: F.length(x))).cast("bigint").alias("shortest"), F.array_contains(F.transform("a", lambda x: x["role"]), "user").alias("has_user"))


@query("fn31_chapter_urls", r"SELECT count(*) FILTER (regexp_matches(url, '(?i)ch\d+|chapter|/en/')) AS chapters, count(*) AS n FROM pages")
def chapter_urls(t):
    return t.pages.agg(F.count_if(F.col("url").rlike(r"(?i)ch\d+|chapter|/en/")).alias("chapters"), F.count("*").alias("n"))


def _dated(t):
    """Header-like lines made of order dates: day forms, month-first forms, lone years, unknown months, none."""
    month = F.element_at(F.array(*(F.lit(m.capitalize()) for m in dates.MONTHS)), F.month("o_orderdate"))
    y, d, k = F.year("o_orderdate").cast("string"), F.dayofmonth("o_orderdate").cast("string"), F.col("o_orderkey") % 5
    line = F.when(k == 0, F.concat(d, F.lit(" "), month, F.lit(" "), y)).when(k == 1, F.concat(month, F.lit(" "), d, F.lit("th, "), y)).when(k == 2, F.concat(F.lit("Issue of "), y)).when(k == 3, F.concat(d, F.lit(" Brumaire "), y)).otherwise("undated")
    return t.orders.select("o_orderkey", line.alias("line"))


@query(
    "dt01_parse_dateish",
    """SELECT o_orderkey, CASE WHEN k < 4 THEN year(o_orderdate) END::INTEGER AS year, CASE WHEN k < 2 THEN month(o_orderdate) END::INTEGER AS month,
    CASE WHEN k < 2 THEN day(o_orderdate) END::INTEGER AS day, CASE WHEN k < 2 THEN 'day' WHEN k < 4 THEN 'year' END AS precision FROM (SELECT *, o_orderkey % 5 AS k FROM orders)""",
)
def parsed(t):
    return _dated(t).select("o_orderkey", dates.parse_dateish(F.col("line")).alias("d")).select("o_orderkey", "d.*")


_URL = "concat('/a/', year(o_orderdate), '/', CASE WHEN k < 3 THEN lpad(month(o_orderdate)::VARCHAR, 2, '0') || CASE WHEN k < 2 THEN '/' || lpad((day(o_orderdate) + 31 * k)::VARCHAR, 2, '0') || '.htm' ELSE '/' END ELSE 'x.htm' END)"


@query(
    "dt02_url_date",
    f"""SELECT o_orderkey, url, year(o_orderdate)::INTEGER AS year, CASE WHEN k = 0 OR k = 2 THEN month(o_orderdate) WHEN k = 1 THEN month(o_orderdate) END::INTEGER AS month,
    CASE WHEN k = 0 THEN day(o_orderdate) END::INTEGER AS day, CASE WHEN k = 0 THEN 'day' WHEN k < 3 THEN 'month' ELSE 'year' END AS precision FROM (SELECT *, {_URL} AS url FROM (SELECT *, o_orderkey % 4 AS k FROM orders))""",
)
def url_dates(t):
    k, two = F.col("o_orderkey") % 4, lambda c: F.lpad(c.cast("string"), 2, "0")
    day = F.concat(F.lit("/"), two(F.dayofmonth("o_orderdate") + 31 * k), F.lit(".htm"))
    tail = F.when(k < 3, F.concat(two(F.month("o_orderdate")), F.when(k < 2, day).otherwise("/"))).otherwise("x.htm")
    rows = t.orders.select("o_orderkey", F.concat(F.lit("/a/"), F.year("o_orderdate").cast("string"), F.lit("/"), tail).alias("url"))
    return rows.select("o_orderkey", "url", dates.url_date(F.col("url")).alias("d")).select("o_orderkey", "url", "d.*")


@query("dt23_year_ranges", "SELECT o_orderkey, concat(y, ',', CASE WHEN y % 100 < 98 THEN y + 2 ELSE y END) AS years FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders) WHERE y % 100 < 98")
def ranges(t):
    y = F.year("o_orderdate")
    line = F.concat(F.lit("in "), y.cast("string"), F.lit("-"), F.lpad(((y + 2) % 100).cast("string"), 2, "0"), F.lit(" and again "), y.cast("string"))
    return t.orders.filter(y % 100 < 98).select("o_orderkey", F.array_join(F.transform(dates.years_of_ranges(line), lambda v: v.cast("string")), ",").alias("years"))


@query("fn08_on_domain", r"SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) IN ('ththan.example.com', 'www.ththan.example.com') AS ok FROM pages")
def on_domain(t):
    return t.pages.select("page_id", urls.on_domain(F.col("url"), "ththan.example.com").alias("ok"))


@query(
    "fn13_title_similarity",
    """SELECT p_partkey, round(CASE k WHEN 0 THEN 1.0 WHEN 1 THEN 0.55 * (2.0 * length(p_name) / (2 * length(p_name) + 11)) + 0.45 * (w / (w + 2.0)) ELSE 0.0 END, 9)::DOUBLE AS similarity
    FROM (SELECT p_partkey, p_name, p_partkey % 3 AS k, len(list_distinct(string_split(p_name, ' '))) AS w FROM part)""",
)
def title_similarity(t):
    from ..plans.catalog import best_similarity, title_norm

    label = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" Volume, Two"))).otherwise("")
    return t.part.select("p_partkey", F.round(best_similarity(title_norm(label), F.array(title_norm(F.col("p_name")))), 9).alias("similarity"))


@query("fn14_same_author", "SELECT c_custkey, c_custkey % 6 < 4 AS same FROM customer")
def same_author(t):
    """Equal forms, a typing error, a lone surname and initials name one author; other initials and other surnames don't."""
    last = F.translate(F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 10), "0123456789abcdef", "bcdfgklmnprstvzh")
    name = F.concat(F.lit("Wilhelmina "), last)
    k = F.col("c_custkey") % 6
    other = F.when(k == 0, F.concat(F.lit(" wilhelmina  "), last, F.lit(" Jr."))).when(k == 1, F.concat(F.lit("Wilhelmine "), last)).when(k == 2, last).when(k == 3, F.concat(F.lit("W. "), last)).when(k == 4, F.concat(F.lit("E. "), last)).otherwise(F.concat(F.lit("Wolfgang "), F.reverse(last), F.lit("qqqqq")))
    forms = t.customer.select("c_custkey", names.match_form(other).alias("a"), names.match_form(name).alias("b"))
    return forms.select("c_custkey", names.same_author(0.85)("a", "b").alias("same"))


@query("fn15_title_norm", r"SELECT p_partkey, trim(regexp_replace(regexp_replace(lower('The ' || p_name || ': No. ' || p_size || ' (new)!'), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')) AS norm FROM part")
def title_norms(t):
    from ..plans.catalog import title_norm

    return t.part.select("p_partkey", title_norm(F.concat(F.lit("The "), "p_name", F.lit(": No. "), F.col("p_size").cast("string"), F.lit(" (new)!"))).alias("norm"))


@query("fn18_enum_labels", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'assert' WHEN 1 THEN 'deny' END AS polarity, CASE event_id % 4 WHEN 2 THEN 'Maybe' END AS polarity_raw, CASE event_id % 2 WHEN 0 THEN 'must' END AS modality FROM events")
def enum_labels(t):
    """Unknown labels become null with the raw value beside them; a modality must be known, and is here."""
    from ..plans.extraction import ALLOWED, allowed, raw_if_unknown

    raw = F.element_at(F.array(F.lit(" Assert"), F.lit("DENY"), F.lit("Maybe"), F.lit(None).cast("string")), (F.col("event_id") % 4 + 1).cast("int"))
    modality = F.when(F.col("event_id") % 2 == 0, "must")
    return t.events.select("event_id", allowed(raw, "polarity").alias("polarity"), raw_if_unknown(raw, "polarity").alias("polarity_raw"), replies.checked_label(modality, ALLOWED["modality"], "modality").alias("modality"))


@query("fn19_first_object", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"k": ' || event_id || ', "s": "a } b"}' WHEN 1 THEN '{"in": {"k": ' || event_id || '}}' END AS found FROM events""")
def first_objects(t):
    """The first balanced object of a reply, whatever stands around it; arrays and broken objects are none."""
    from ..plans.extraction import json_object

    number, k = F.col("event_id").cast("string"), F.col("event_id") % 4
    reply = F.when(k == 0, F.concat(F.lit('Sure: ```json {"k": '), number, F.lit(', "s": "a } b"} ``` and {"x": 1}'))).when(k == 1, F.concat(F.lit('{not json} {"in": {"k": '), number, F.lit("}}"))).when(k == 2, F.lit('[1, 2] {"open": ')).otherwise("nothing")
    return t.events.select("event_id", json_object(reply).alias("found"))


@query("fn20_repaired_keys", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{"gloss":"value of goods","term":"' || event_type || '"}' WHEN 1 THEN '{"gloss":"labour that is already embodied","term":"' || event_type || '"}' END AS repaired FROM events""")
def repaired_keys(t):
    k = F.col("event_id") % 3
    value = F.when(k == 0, F.concat(F.lit('{" term :": "'), "event_type", F.lit('", "gloss :": "value of goods"}'))).when(k == 1, F.concat(F.lit('{"term": "'), "event_type", F.lit('", "original_term_vernacular:": "labour that is already embodied"}'))).otherwise("{broken")
    found = F.from_json(replies.repaired(value), "map<string,string>")
    return t.events.select("event_id", F.to_json(F.map_from_entries(F.filter(F.array_sort(F.map_entries(found)), lambda e: e["value"].isNotNull()))).alias("repaired"))


@query(
    "fn21_contract_violations",
    """SELECT event_id, CASE event_id % 7 WHEN 1 THEN '$.claims: missing' WHEN 2 THEN '$.claims[0].claim_text: not string' WHEN 3 THEN '$.claims[0].confidence: above 1; $.claims[0].evidence: too few' WHEN 4 THEN '$.claims[0].polarity: not allowed'
    WHEN 5 THEN '$: no JSON' END AS violations, event_id % 7 = 0 AS in_range FROM events""",
)
def contract_violations(t):
    """Replies against their contract, and whether evidence points at sentences that exist."""
    k = F.col("event_id") % 7
    claim = lambda rest: F.lit('{"claims": [{"claim_text": "All is flux", ' + rest + "}]}")
    reply = F.when(k == 1, F.lit('{"other": 1}')).when(k == 2, F.lit('{"claims": [{"claim_text": 4, "evidence": [9]}]}')).when(k == 3, claim('"confidence": 1.5, "evidence": []')).when(k == 4, claim('"polarity": "maybe", "evidence": [7]')).when(k == 5, "{").when(k == 6, claim('"polarity": null, "evidence": [0, 3]')).otherwise(claim('"confidence": null, "evidence": [0, 2]'))
    indices = F.flatten(F.transform(F.from_json(reply, contracts.ddl(contracts.CLAIMS))["claims"], lambda c: c["evidence"]))
    return t.events.select("event_id", contracts.checked(contracts.CLAIMS)(reply).alias("violations"), (replies.in_range(indices, F.lit(3)) & (F.size(indices) > 0)).alias("in_range"))


@query("fn29_sql_scalars", "SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS a, lower(o_orderpriority) AS b, CAST(o_orderkey AS VARCHAR) AS c, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS d, strftime(o_orderdate, '%Y-%m-%d') AS e, greatest(year(o_orderdate), 1995)::BIGINT AS f FROM orders")
def sql_scalars(t):
    """The SQL scalars of the stored queries, as SQL over a view."""
    t.orders.createOrReplaceTempView("scalar_orders")
    return t.spark.sql("SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS a, lower(o_orderpriority) AS b, CAST(o_orderkey AS STRING) AS c, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS d, date_format(o_orderdate, 'yyyy-MM-dd') AS e, CAST(greatest(year(o_orderdate), 1995) AS BIGINT) AS f FROM scalar_orders")
