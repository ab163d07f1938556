"""Jobs that chain steps into one rerunnable plan (Q-37, Q-39, ST-08), header rows (DT-18), run logs (SRC-21), source kinds (DT-05), labels (DT-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import canonical_title
from ..operators.filters import display_label
from ..registry import query
from ..sources.tables import spread
from ..streaming.incremental import keyed_append, read_stream, run_available, shared
from .date_pipeline import _EVIDENCE_SQL, _evidence, _years, bundle, edition_like, evidence_candidates, finalised, header_candidates, resolved, source_kind, upgrades, within_lifespan


@query(
    "dt05_source_kinds",
    "SELECT o_orderkey, ['periodical', 'edition', 'unknown', 'periodical'][o_orderkey % 4 + 1] AS kind, o_orderkey % 4 = 1 OR o_orderkey % 3 = 1 AND o_orderkey % 4 = 1 AS edition FROM orders",
)
def source_kinds(t):
    line = F.element_at(F.array(*map(F.lit, ("Pravda, a daily", "Collected Works, in English", "A pamphlet", "Selected Works, Issue 3"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    header = F.when(F.col("o_orderkey") % 3 == 0, "1919").otherwise("in 1919")
    return t.orders.select("o_orderkey", source_kind(line).alias("kind"), edition_like(header, source_kind(line)).alias("edition"))


@query(
    "dt09_display_labels",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 4 = 1 OR o_orderkey % 2 = 0 AND o_orderkey % 10 <= 2 THEN 'heuristic' ELSE 'evidence' END AS label FROM orders",
)
def display_labels(t):
    k = F.col("o_orderkey") % 4
    field = F.when(k == 1, "heuristic_publication_year").otherwise("first_publication_date")
    confidence = F.when(F.col("o_orderkey") % 10 <= 2, 0.3).otherwise(0.9)
    return t.orders.select("o_orderkey", display_label(F.when(k < 3, F.year("o_orderdate")), F.lit("page"), field, confidence).alias("label"))


def header_rows(editions: DataFrame, site: str) -> DataFrame:
    """editions(edition_id, meta JSON) -> typed header columns; metadata of another site's extractor is left out (DT-18).

    A date is kept only as an object with a whole number as its year, a field only as a string.
    """
    rows = editions.withColumn("m", F.try_parse_json("meta")).filter(F.schema_of_variant("m").startswith("OBJECT"))
    kind = lambda path: F.schema_of_variant(F.try_variant_get("m", path, "variant"))
    text = lambda path: F.when(kind(path) == "STRING", F.try_variant_get("m", path, "string"))
    date = lambda name: F.when(kind(f"$.dates.{name}.year") == "BIGINT", F.try_variant_get("m", f"$.dates.{name}.year", "int")).alias(f"{name}_year")
    own = F.coalesce(F.lower(text("$.source")).contains(site), F.lit(True))
    fields = {"source_citation": "Source", "translated": "Translated", "transcription": "Transcription/Markup", "public_domain": "Public Domain"}
    return rows.filter(own).select("edition_id", *(date(n) for n in ("written", "first_published", "published")), *(text(f'$.fields["{label}"]').alias(name) for name, label in fields.items()), text("$.raw_sha256").alias("raw_sha256"))


@query(
    "dt18_header_rows",
    """SELECT o_orderkey AS edition_id, CASE WHEN k = 0 THEN y END::INTEGER AS written_year, y::INTEGER AS first_published_year, NULL::INTEGER AS published_year, CASE WHEN k < 2 THEN o_orderpriority END AS source_citation,
    NULL::VARCHAR AS translated, NULL::VARCHAR AS transcription, 'yes' AS public_domain, NULL::VARCHAR AS raw_sha256 FROM (SELECT *, o_orderkey % 4 AS k, year(o_orderdate) AS y FROM orders) WHERE k < 3""",
)
def header_row_query(t):
    y, k = F.year("o_orderdate").cast("string"), F.col("o_orderkey") % 4
    meta = F.concat(
        F.lit('{"source": '), F.when(k == 0, '"site_header"').when(k == 1, "7").when(k == 2, '"the SITE parser"').otherwise('"another"'), F.lit(', "raw_sha256": null, "fields": {"Public Domain": "yes", "Translated": 4, "Source": '),
        F.when(k < 2, F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))).otherwise("[1]"), F.lit('}, "dates": {"first_published": {"year": '), y, F.lit('}, "written": {"year": '), F.when(k == 0, y).otherwise(F.concat(F.lit('"'), y, F.lit('"'))), F.lit('}, "published": "1919"}}'),
    )
    broken = t.orders.select((-F.col("o_orderkey") - 1).alias("edition_id"), F.lit("{broken").alias("meta"))
    return header_rows(t.orders.select(F.col("o_orderkey").alias("edition_id"), meta.alias("meta")).unionAll(broken), "site")


def canonical_titles(works: DataFrame, only_missing: bool = True) -> DataFrame:
    """works(work_id, title, title_canonical) with title_canonical filled, and what became of each: filled, changed, skipped (Q-37)."""
    rows = works.withColumn("_new", canonical_title("title"))
    missing = F.col("title_canonical").isNull()
    skipped = (F.lit(only_missing) & ~missing) | F.col("_new").eqNullSafe(F.coalesce("title_canonical", F.lit("")))
    done = F.when(skipped, "skipped").when(missing, "filled").otherwise("changed")
    return rows.select("work_id", "title", F.when(skipped, F.col("title_canonical")).otherwise(F.col("_new")).alias("title_canonical"), done.alias("outcome"))


@query(
    "q37_canonical_titles",
    """SELECT o_orderkey AS work_id, CASE WHEN k = 2 THEN 'Kept' WHEN k = 0 THEN 'The Anvil of ' || upper(p[1]) || lower(substr(p, 2)) ELSE 'A fine Title' END AS title_canonical, CASE WHEN k = 2 THEN 'skipped' ELSE 'filled' END AS outcome
    FROM (SELECT o_orderkey, o_orderkey % 3 AS k, ['Ring', 'Gear', 'Widget'][o_orderkey % 7 % 3 + 1] AS p FROM orders)""",
)
def title_job(t):
    k = F.col("o_orderkey") % 3
    noun = F.element_at(F.array(*map(F.lit, ("RING", "GEAR", "WIDGET"))), (F.col("o_orderkey") % 7 % 3 + 1).cast("int"))
    works = t.orders.select(F.col("o_orderkey").alias("work_id"), F.when(k == 1, "A  fine Title").otherwise(F.concat(F.lit("THE ANVIL OF "), noun)).alias("title"), F.when(k == 2, "Kept").alias("title_canonical"))
    return canonical_titles(works).drop("title")


def date_job(editions: DataFrame, evidence: DataFrame, lives: DataFrame, current: DataFrame) -> DataFrame:
    """One date per work from all evidence: extract, weigh by lifespans, derive, resolve, finalise (Q-39).

    editions(work_id, url, fields, title); evidence(work_id, source, year string, score, excerpt, locator, order);
    lives(work_id, birth, death); current(work_id, year, score): what is resolved already. A plan of its inputs alone, so it
    can run again at any time. Works without any evidence come out as unknown.
    """
    extracted = header_candidates(editions).unionByName(evidence_candidates(evidence))
    derived = bundle(within_lifespan(extracted.join(lives, "work_id", "left")))
    years = evidence.withColumn("year", F.when(F.col("year").rlike("^[0-9]{4}$"), F.col("year").cast("int"))).filter("year IS NOT NULL")
    written = upgrades(resolved(years), current)
    final = finalised(years)
    works = editions.select("work_id").union(evidence.select("work_id")).distinct()
    out = works.join(derived.select("work_id", "display_year", "display_field", "display_confidence"), "work_id", "left")
    out = out.join(written.select("work_id", F.col("source").alias("resolved_source"), F.col("year").alias("resolved_year")), "work_id", "left")
    out = out.join(final.select("work_id", F.col("source").alias("final_source"), F.col("year").alias("final_year")), "work_id", "left")
    return out.withColumn("display_field", F.coalesce("display_field", F.lit("unknown")))


@query(
    "q39_date_job",
    f"""WITH {_EVIDENCE_SQL}, u AS (SELECT o_orderkey AS work_id, year(o_orderdate)::INTEGER AS year, (year(o_orderdate) - 40 - o_custkey % 30) AS birth, (year(o_orderdate) - o_custkey % 12) AS death FROM orders WHERE o_orderkey % 4 = 0),
    x AS (SELECT work_id, year, role, confidence FROM a UNION ALL SELECT work_id, year, 'first_publication_date', CASE WHEN year > death + 5 OR year < birth - 10 THEN 0.98 * 0.15 ELSE 0.98 END FROM u),
    d AS (SELECT work_id, max(year) FILTER (role = 'first_publication_date') AS display_year, max(confidence) FILTER (role = 'first_publication_date') AS display_confidence FROM x GROUP BY 1),
    s AS (SELECT work_id, source, year FROM e WHERE score >= 0.75 AND year IS NOT NULL AND source <> 'manual' AND NOT (work_id % 9 = 0 AND score < 0.9 + 0.05)),
    f AS (SELECT work_id, source, year FROM e WHERE score >= 0.85 AND year IS NOT NULL AND source <> 'heuristic_url_year')
    SELECT o.o_orderkey AS work_id, display_year, CASE WHEN display_year IS NULL THEN 'unknown' ELSE 'first_publication_date' END AS display_field, round(display_confidence, 6)::DOUBLE AS display_confidence,
    s.source AS resolved_source, s.year AS resolved_year, f.source AS final_source, f.year AS final_year FROM orders o LEFT JOIN d ON d.work_id = o.o_orderkey LEFT JOIN s ON s.work_id = o.o_orderkey LEFT JOIN f ON f.work_id = o.o_orderkey""",
)
def date_job_query(t):
    t = _Orders(spread(t.orders))
    y = F.year("o_orderdate").cast("string")
    url = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("https://e.org/a/"), y, F.lit("/x.htm"))).otherwise("https://e.org/a/x.htm")
    editions = t.orders.select(F.col("o_orderkey").alias("work_id"), url.alias("url"), F.create_map(F.lit("Editor"), F.lit("nobody")).alias("fields"), F.lit("A title").alias("title"))
    evidence = _evidence(t).drop("birth", "death").withColumn("order", F.lit(0))
    current = _years(t).filter(F.col("work_id") % 9 == 0).select("work_id", F.col("y").alias("year"), F.lit(0.9).alias("score"))
    rows = date_job(editions, evidence, _years(t).select("work_id", "birth", "death"), current)
    return rows.withColumn("display_confidence", F.round("display_confidence", 6))


@query(
    "st08_rederived",
    f"WITH {_EVIDENCE_SQL} SELECT work_id, max(year) FILTER (role = 'first_publication_date') AS display_year, max(year) FILTER (role = 'edition_publication_date') AS edition_year FROM c GROUP BY 1",
)
def rederived(t):
    """Evidence is only ever appended, in two runs that overlap; dates are then derived anew from all of it."""
    folder = shared(t.spark)
    orders = read_stream(t.spark, t.sf_dir, "orders")
    for run, part in (("first", orders.filter("o_orderkey % 3 < 2")), ("second", orders.filter("o_orderkey % 3 > 0"))):
        run_available(_evidence(_Orders(part)), keyed_append(f"{folder}/evidence", ["work_id"], run), f"{folder}/{run}")
    evidence = t.spark.read.parquet(f"{folder}/evidence").drop("batch")
    rows = bundle(evidence_candidates(evidence))
    return rows.select("work_id", "display_year", F.col("edition_publication_date.year").alias("edition_year"))


class _Orders:
    """A table set of one, so that plans over orders take a stream."""

    def __init__(self, orders: DataFrame):
        self.orders = orders


def run_log(rows: DataFrame, run: Column, at: Column, outcome: Column) -> DataFrame:
    """One row a run: when it began and ended, whether it failed, and how many items came to each outcome (SRC-21)."""
    counted = rows.select(run.alias("run"), at.alias("at"), outcome.alias("outcome")).groupBy("run", "outcome").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))
    counters = F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n")))))
    failed = F.coalesce(F.sum(F.when(F.col("outcome") == "error", F.col("n"))), F.lit(0))
    done = F.sum("n")
    return counted.groupBy("run").agg(F.min("first").alias("started"), F.max("last").alias("finished"), done.alias("items"), F.when(failed == done, "failed").when(failed > 0, "partial").otherwise("completed").alias("status"), counters.alias("counters"))


@query(
    "src21_run_log",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2)
    SELECT user_id AS run, min(a) AS started, max(b) AS finished, sum(n)::BIGINT AS items, CASE WHEN bool_and(event_type = 'error') THEN 'failed' WHEN bool_or(event_type = 'error') THEN 'partial' ELSE 'completed' END AS status,
    '{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}' AS counters FROM c GROUP BY 1""",
)
def run_log_query(t):
    return run_log(t.events, F.col("user_id"), F.col("ts"), F.col("event_type"))
