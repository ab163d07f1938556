"""Projections and predicates (PF)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query


def conjuncts(df, *, equal: dict | None = None, contains: tuple | None = None, between: dict | None = None, true: list | None = None):
    """Apply only the predicates that are given; a NULL never passes a range. Wildcards in a substring stay active."""
    for column, value in (equal or {}).items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    if contains and contains[1]:
        df = df.filter(F.col(contains[0]).ilike(f"%{contains[1]}%"))
    for column, (low, high) in (between or {}).items():
        if low is not None:
            df = df.filter(F.col(column) >= low)
        if high is not None:
            df = df.filter(F.col(column) <= high)
    for column in true or []:
        df = df.filter(F.col(column).eqNullSafe(F.lit(True)))
    return df


@query("pf01_projection_labels", "SELECT o_orderkey AS work_id, o_orderpriority AS title, year(o_orderdate)::BIGINT AS year FROM orders")
def projection(t):
    return t.orders.select(F.col("o_orderkey").alias("work_id"), F.col("o_orderpriority").alias("title"), F.year("o_orderdate").cast("bigint").alias("year"))


@query("pf02_dynamic_conjuncts", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority ILIKE '%urg%' AND year(o_orderdate) >= 1993 AND o_totalprice > 50000")
def dynamic(t):
    df = t.orders.withColumn("year", F.year("o_orderdate")).withColumn("dear", F.col("o_totalprice") > 50000)
    return conjuncts(df, equal={"o_orderstatus": "F", "o_custkey": None}, contains=("o_orderpriority", "urg"), between={"year": (1993, None)}, true=["dear"]).select("o_orderkey", "o_custkey")


@query("pf03_ilike", "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%r#0%1%'")
def ilike(t):
    return t.customer.filter(F.col("c_name").ilike("%r#0%1%")).select("c_custkey", "c_name")


@query("pf04_like", "SELECT p_partkey FROM part WHERE p_type LIKE '%E%'")
def like(t):
    return t.part.filter(F.col("p_type").like("%E%")).select("p_partkey")


@query("pf05_regex", r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)\bthe\b.*\n') OR regexp_matches(text, '[0-9]{4}')")
def regex(t):
    return t.documents.filter(F.col("text").rlike(r"(?i)\bthe\b.*\n") | F.col("text").rlike("[0-9]{4}")).select("doc_id")


@query("pf06_nullable_range", "SELECT doc_id, y FROM (SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '(1[5-9][0-9]{2}|20[0-3][0-9])', 1), '') AS INTEGER) AS y FROM documents) WHERE y >= 1500 AND y <= 2030")
def nullable_range(t):
    year = F.regexp_extract("text", "(1[5-9][0-9]{2}|20[0-3][0-9])", 1).try_cast("int")
    return conjuncts(t.documents.select("doc_id", year.alias("y")), between={"y": (1500, 2030)})


@query("pf07_boolean_is", "SELECT doc_id, (toxic = 1) IS TRUE AS is_toxic, (toxic = 1) IS NOT TRUE AS not_toxic FROM documents LEFT JOIN labels USING (doc_id)")
def boolean_is(t):
    toxic = (F.col("toxic") == 1).eqNullSafe(F.lit(True))
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", toxic.alias("is_toxic"), (~toxic).alias("not_toxic"))


@query("pf08_in_list", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def in_list(t):
    picked = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).join(picked, "o_custkey", "left_semi").select("o_orderkey")


@query("pf09_not_in_or_null", "SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NULL OR quality NOT IN (0)")
def not_in_or_null(t):
    return t.documents.join(t.labels, "doc_id", "left").filter(F.col("quality").isNull() | ~F.col("quality").isin(0)).select("doc_id", "quality")


@query("pf10_null_pairs", "SELECT event_id FROM events WHERE (CASE WHEN event_type IN ('click', 'view') THEN event_type END) IS NULL AND event_type IS NOT NULL")
def null_pairs(t):
    canonical = F.when(F.col("event_type").isin("click", "view"), F.col("event_type"))
    return t.events.filter(canonical.isNull() & F.col("event_type").isNotNull()).select("event_id")


@query("pf11_json_path", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50")
def json_path(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k")).filter("k >= 50")


@query("pf12_struct_predicate", "SELECT doc_id, lang FROM (SELECT d.doc_id, lang, quality = 1 AS prim, CASE WHEN n_chars > 500 THEN 'work_page' ELSE 'other' END AS ty FROM documents d JOIN labels l ON d.doc_id = l.doc_id) WHERE prim AND ty = 'work_page'")
def struct_predicate(t):
    result = F.struct((F.col("quality") == 1).alias("is_primary_content"), F.when(F.col("n_chars") > 500, "work_page").otherwise("other").alias("page_type"))
    rows = t.documents.join(t.labels, "doc_id").select("doc_id", "lang", result.alias("result"))
    return rows.filter("result.is_primary_content AND result.page_type = 'work_page'").select("doc_id", "lang")


@query("pf13_status_scope", "SELECT event_id, ts FROM events WHERE event_type = 'error' AND user_id = 7")
def status_scope(t):
    return conjuncts(t.events, equal={"event_type": "error", "user_id": 7}).select("event_id", "ts")


@query("pf14_latest_run", "SELECT event_id, event_type FROM events WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)")
def latest_run(t):
    last = t.events.agg(F.max_by("user_id", F.struct("ts", "event_id")).alias("user_id"))  # one row
    return t.events.join(F.broadcast(last), "user_id", "left_semi").select("event_id", "event_type")


@query("pf15_count_filters", "SELECT o_orderkey FROM orders o WHERE (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R') > 0 AND (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_quantity > 45) = 0")
def count_filters(t):
    key = F.col("l_orderkey").alias("o_orderkey")
    returned, large = t.lineitem.filter("l_returnflag = 'R'").select(key), t.lineitem.filter("l_quantity > 45").select(key)
    return t.orders.join(returned, "o_orderkey", "left_semi").join(large, "o_orderkey", "left_anti").select("o_orderkey")


def display_label(year, source, field, confidence):
    """Year and its label (DT-09): heuristic for weak origins, evidence otherwise; no year, no label."""
    weak = (source == "heuristic_url_year") | (field == "heuristic_publication_year") | (confidence <= 0.3)
    return F.when(year.isNotNull(), F.when(F.coalesce(weak, F.lit(False)), "heuristic").otherwise("evidence"))


@query(
    "pf16_display_label",
    """SELECT o_orderkey, CASE WHEN y IS NOT NULL THEN CASE WHEN src = 'heuristic_url_year' OR conf <= 0.3 THEN 'heuristic' ELSE 'evidence' END END AS label FROM
    (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) END AS y, CASE WHEN o_orderkey % 3 = 0 THEN 'heuristic_url_year' ELSE 'catalog' END AS src, (o_orderkey % 10) / 10.0 AS conf FROM orders)""",
)
def display(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.year("o_orderdate")).alias("y"), F.when(F.col("o_orderkey") % 3 == 0, "heuristic_url_year").otherwise("catalog").alias("src"), ((F.col("o_orderkey") % 10) / F.lit(10.0)).alias("conf"))
    return rows.select("o_orderkey", display_label(F.col("y"), F.col("src"), F.lit("first_publication_date"), F.col("conf")).alias("label"))


@query("pf17_url_scope", r"SELECT page_id FROM pages WHERE starts_with(url, 'https://') AND regexp_matches(url, '^https?://[^/]*example\.(org|net)/en/') AND NOT contains(url, '?')")
def url_scope(t):
    return t.pages.filter(F.col("url").startswith("https://") & F.col("url").rlike(r"^https?://[^/]*example\.(org|net)/en/") & ~F.col("url").contains("?")).select("page_id")
