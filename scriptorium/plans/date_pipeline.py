"""Date evidence to one explainable date per work (DT-04 to DT-11, DT-15, DT-21, DT-22, Q-39)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import TYPE, parse_dateish, url_date
from ..registry import query

#: Markers of collected editions, of periodicals, and of uploads, looked for in lower case.
EDITION = ("collected works", "selected works", "progress publishers", "foreign languages publishing house", "volume", "vol.", "selected articles", "selected writings")
PERIODICAL = ("no.", "number", "issue", "pravda", "iskra", "new international", "workers' weekly", "monthly review", "socialist appeal", "new york")
UPLOAD = ("internet archive", "transcription", "markup", "mark-up", "proofread", "public domain", "copyleft", "copyright")
ROLES = ("first_publication_date", "written_date", "edition_publication_date", "ingest_upload_year", "heuristic_publication_year")
#: Confidences of candidates by origin.
URL_CONFIDENCE, TITLE_CONFIDENCE, PERIODICAL_CONFIDENCE, UNKNOWN_CONFIDENCE = 0.98, 0.45, 0.90, 0.75
FIELDS = {"written": ("written_date", 0.85, None), "first_published": ("first_publication_date", 0.95, 0.60), "published": ("first_publication_date", 0.90, 0.55), "date": ("first_publication_date", 0.92, None), "delivered": ("first_publication_date", 0.90, None)}


def holds(line: Column, markers: tuple) -> Column:
    low = F.lower(F.coalesce(line, F.lit("")))
    found = F.lit(False)
    for m in markers:
        found = found | low.contains(m)
    return found


def source_kind(line: Column) -> Column:
    """A citation's kind: periodical markers win over edition markers."""
    return F.when(holds(line, PERIODICAL), "periodical").when(holds(line, EDITION), "edition").otherwise("unknown")


def edition_like(line: Column, kind: Column) -> Column:
    """Whether a header line's date is an edition's: its own markers decide, else the source line's kind."""
    return F.when(holds(line, PERIODICAL), False).when(holds(line, EDITION), True).otherwise(kind == "edition")


def _candidate(role, date, confidence, source, locator, notes=None) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_col(role).alias("role"), date.cast(TYPE).alias("date"), as_col(confidence).cast("double").alias("confidence"), F.lit(source).alias("source"), locator.alias("locator"), as_col(notes).cast("string").alias("notes"))


def header_candidates(editions: DataFrame) -> DataFrame:
    """editions(work_id, url, fields map, title) -> one row per candidate (DT-04): URL, header fields, title, source line."""
    url, line = F.col("url"), lambda label: F.try_element_at("fields", F.lit(label))
    kind = source_kind(line("Source"))
    made = [_candidate(ROLES[0], url_date(url), URL_CONFIDENCE, "url_path", url)]
    for name, (role, confidence, cap) in FIELDS.items():
        label = name.replace("_", " ").title()
        demoted = edition_like(line(label), kind) if cap else F.lit(False)
        made.append(_candidate(F.when(demoted, ROLES[2]).otherwise(role), parse_dateish(line(label)), F.when(demoted, min(confidence, cap or 1)).otherwise(confidence), "source_metadata", url))
    made.append(_candidate(ROLES[0], parse_dateish(F.col("title")), TITLE_CONFIDENCE, "source_metadata", url, "title_date_heuristic"))
    from_source = F.when(kind != "edition", parse_dateish(line("Source")))
    made.append(_candidate(ROLES[0], from_source, F.when(kind == "periodical", PERIODICAL_CONFIDENCE).otherwise(UNKNOWN_CONFIDENCE), "source_metadata", url))
    return editions.select("work_id", F.explode(F.filter(F.array(*made), lambda c: c["date"]["year"].isNotNull())).alias("c")).select("work_id", "c.*")


def evidence_candidates(evidence: DataFrame) -> DataFrame:
    """evidence(work_id, source, year string, score, excerpt, locator) -> candidates (DT-06)."""
    year = F.when(F.col("year").rlike("^[0-9]{4}$"), F.col("year").cast("int"))
    heuristic, read = F.col("source") == "heuristic_url_year", F.col("source").isin("ingested_html", "page", "source_metadata")
    edition, upload = read & holds(F.col("excerpt"), EDITION), read & holds(F.col("excerpt"), UPLOAD)
    score = F.coalesce("score", F.lit(0.0))
    role = F.when(heuristic, ROLES[4]).when(edition, ROLES[2]).when(upload, ROLES[3]).otherwise(ROLES[0])
    confidence = F.when(heuristic, score).when(edition, F.least(score, F.lit(0.55))).when(upload, F.least(score, F.lit(0.25))).otherwise(score)
    notes = F.when(~heuristic & edition, "edition_contamination").when(~heuristic & upload, "upload_or_transcription_year")
    date = F.struct(year.alias("year"), F.lit(None).cast("int").alias("month"), F.lit(None).cast("int").alias("day"), F.lit("year").alias("precision"))
    return evidence.filter(year.isNotNull()).select("work_id", role.alias("role"), date.alias("date"), confidence.alias("confidence"), "source", "locator", notes.alias("notes"))


def within_lifespan(candidates: DataFrame) -> DataFrame:
    """candidates with birth and death: years long after death or before birth lose confidence or role (DT-07)."""
    year = F.col("date.year")
    late, early = year > F.col("death") + 5, year < F.col("birth") - 10
    moved = late & (F.col("source") == "openlibrary") & (F.col("role") == ROLES[0])
    note = F.when(moved, "after_death_openlibrary_demoted").when(late, "after_death_penalized").when(early, "before_birth_penalized")
    known = F.coalesce("notes", F.lit(""))
    return candidates.withColumns(
        {
            "role": F.when(moved, ROLES[2]).otherwise(F.col("role")),
            "confidence": F.when(moved, F.least("confidence", F.lit(0.40))).when(F.coalesce(late | early, F.lit(False)), F.col("confidence") * 0.15).otherwise(F.col("confidence")),
            "notes": F.when(note.isNull() | known.contains(note), F.col("notes")).when(known == "", note).otherwise(F.concat_ws(";", "notes", note)),
        }
    ).drop("birth", "death")


def bundle(candidates: DataFrame) -> DataFrame:
    """The best candidate per role and the displayed date (DT-08): one pass, combined map-side; order of rows is moot."""
    key = lambda role: F.min(F.when(F.col("role") == role, F.struct((-F.col("confidence")).alias("minus"), "source", F.coalesce("locator", F.lit("")).alias("locator"), F.col("date.year").alias("year"), F.col("date.month").alias("month"), F.col("date.day").alias("day"), F.col("date.precision").alias("precision")))).alias(role)
    best = candidates.groupBy("work_id").agg(*map(key, ROLES))
    shown = F.coalesce(ROLES[0], ROLES[1])
    field = F.when(F.col(ROLES[0]).isNotNull(), ROLES[0]).when(F.col(ROLES[1]).isNotNull(), ROLES[1]).otherwise("unknown")
    return best.select("work_id", *ROLES, field.alias("display_field"), shown["year"].alias("display_year"), (-shown["minus"]).alias("display_confidence"), shown["source"].alias("display_source"))


#: Order of sources for resolution and finalisation; other sources come last.
RANKS = {"ingested_html": 0, "page": 0, "wikidata": 1, "openlibrary": 2, "heuristic_url_year": 3}


def source_rank(source: Column) -> Column:
    ranks = F.create_map(*(F.lit(x) for pair in RANKS.items() for x in pair))
    return F.coalesce(F.try_element_at(ranks, source), F.lit(9))


def resolved(candidates: DataFrame, min_score: float = 0.75) -> DataFrame:
    """candidates(work_id, source, score, year, order) -> the best of the best-ranked source (DT-10)."""
    ranked = candidates.filter((F.col("score") >= min_score) & (source_rank(F.col("source")) < 9))
    best = F.min(F.struct(source_rank(F.col("source")).alias("rank"), (-F.col("score")).alias("minus"), "order", "source", "year"))
    return ranked.groupBy("work_id").agg(best.alias("b")).select("work_id", "b.source", "b.year", (-F.col("b.minus")).alias("score"))


def upgrades(new: DataFrame, current: DataFrame, min_improvement: float = 0.05) -> DataFrame:
    """Resolutions to write: no current year, another year, or enough more confidence."""
    rows = new.alias("n").join(current.select("work_id", F.col("year").alias("_year"), F.col("score").alias("_score")), "work_id", "left")
    return rows.filter(F.col("_year").isNull() | (F.col("_year") != F.col("year")) | (F.col("score") >= F.coalesce("_score", F.lit(0.0)) + min_improvement)).drop("_year", "_score")


def finalised(evidence: DataFrame, min_score: float = 0.85, allow_heuristic: bool = False) -> DataFrame:
    """evidence(work_id, source, score, year, order) -> final dates (DT-11); sources without a rank may win when alone."""
    rows = evidence.filter(F.col("year").between(1500, 2030) & (F.col("score") >= min_score))
    rows = rows if allow_heuristic else rows.filter("source <> 'heuristic_url_year'")
    best = F.min(F.struct(source_rank(F.col("source")).alias("rank"), (-F.col("score")).alias("minus"), "order", "source", "year"))
    return rows.groupBy("work_id").agg(best.alias("b")).select("work_id", "b.source", "b.year", F.when(F.col("b.source") == "heuristic_url_year", "heuristic").otherwise("finalized").alias("status"))


def _years(t) -> DataFrame:
    """Works with their authors' lifespans, synthesised from keys and dates."""
    y = F.year("o_orderdate")
    return t.orders.select(F.col("o_orderkey").alias("work_id"), "o_orderdate", y.alias("y"), (y - 40 - F.col("o_custkey") % 30).cast("int").alias("birth"), (y - F.col("o_custkey") % 12).cast("int").alias("death"))


def _evidence(t) -> DataFrame:
    k = F.col("work_id") % 6
    source = F.element_at(F.array(*map(F.lit, ("openlibrary", "wikidata", "page", "heuristic_url_year", "page", "manual"))), (k + 1).cast("int"))
    excerpt = F.when(k == 2, "Collected Works, Volume 3").when(k == 4, "Transcription: a volunteer")
    return _years(t).select("work_id", source.alias("source"), F.when(k == 5, "n.d.").otherwise(F.col("y").cast("string")).alias("year"), (F.lit(0.4) + (F.col("work_id") % 7) / F.lit(10.0)).alias("score"), excerpt.alias("excerpt"), F.lit(None).cast("string").alias("locator"), "birth", "death")


@query(
    "dt04_header_candidates",
    """WITH o AS (SELECT o_orderkey AS work_id, o_orderkey % 4 AS k, year(o_orderdate)::INTEGER AS y FROM orders),
    c AS (SELECT work_id, 'first_publication_date' AS role, y AS year, NULL::INTEGER AS month, NULL::INTEGER AS day, 'year' AS precision, 0.98 AS confidence, 'url_path' AS source FROM o
    UNION ALL SELECT work_id, 'written_date', y, 5, 1, 'day', 0.85, 'source_metadata' FROM o
    UNION ALL SELECT work_id, 'first_publication_date', y, NULL, NULL, 'year', 0.95, 'source_metadata' FROM o WHERE k = 3
    UNION ALL SELECT work_id, CASE k WHEN 1 THEN 'edition_publication_date' ELSE 'first_publication_date' END, y, NULL, NULL, 'year', CASE k WHEN 1 THEN 0.55 ELSE 0.90 END, 'source_metadata' FROM o
    UNION ALL SELECT work_id, 'first_publication_date', y, 3, 4, 'day', 0.90, 'source_metadata' FROM o WHERE k = 0
    UNION ALL SELECT work_id, 'first_publication_date', y, NULL, NULL, 'year', 0.75, 'source_metadata' FROM o WHERE k = 2)
    SELECT work_id, role, year, month, day, precision, confidence::DOUBLE AS confidence, source, NULL::VARCHAR AS notes FROM c""",
)
def header_rows(t):
    y = F.year("o_orderdate").cast("string")
    k = F.col("o_orderkey") % 4
    source = F.when(k == 0, F.concat(F.lit("Pravda No. 4, March 4, "), y)).when(k == 1, F.concat(F.lit("Collected Works, Volume 2, "), y)).when(k == 2, F.concat(F.lit("Pamphlet, "), y))
    fields = F.create_map(F.lit("Source"), source, F.lit("Written"), F.concat(F.lit("1 May "), y), F.lit("First Published"), F.when(k == 3, F.concat(F.lit("Iskra No. 3, "), y)), F.lit("Published"), y)
    editions = t.orders.select(F.col("o_orderkey").alias("work_id"), F.concat(F.lit("https://example.org/a/"), y, F.lit("/x.htm")).alias("url"), fields.alias("fields"), F.lit("A title").alias("title"))
    return header_candidates(editions).select("work_id", "role", "date.*", "confidence", "source", "notes")


_EVIDENCE_SQL = """e AS (SELECT o_orderkey AS work_id, ['openlibrary', 'wikidata', 'page', 'heuristic_url_year', 'page', 'manual'][o_orderkey % 6 + 1] AS source, CASE WHEN o_orderkey % 6 < 5 THEN year(o_orderdate)::INTEGER END AS year,
 0.4 + (o_orderkey % 7) / 10.0 AS score, o_orderkey % 6 AS k, (year(o_orderdate) - 40 - o_custkey % 30)::INTEGER AS birth, (year(o_orderdate) - o_custkey % 12)::INTEGER AS death FROM orders),
 c AS (SELECT work_id, source, year, birth, death, CASE WHEN k = 3 THEN 'heuristic_publication_year' WHEN k = 2 THEN 'edition_publication_date' WHEN k = 4 THEN 'ingest_upload_year' ELSE 'first_publication_date' END AS role,
 CASE WHEN k = 2 THEN least(score, 0.55) WHEN k = 4 THEN least(score, 0.25) ELSE score END AS confidence FROM e WHERE year IS NOT NULL),
 a AS (SELECT work_id, source, year, CASE WHEN year > death + 5 AND source = 'openlibrary' AND role = 'first_publication_date' THEN 'edition_publication_date' ELSE role END AS role,
 CASE WHEN year > death + 5 AND source = 'openlibrary' AND role = 'first_publication_date' THEN least(confidence, 0.40) WHEN year > death + 5 OR year < birth - 10 THEN confidence * 0.15 ELSE confidence END AS confidence FROM c)"""


@query("dt06_evidence_candidates", f"WITH {_EVIDENCE_SQL} SELECT work_id, role, year, round(confidence, 6)::DOUBLE AS confidence FROM c")
def evidence_rows(t):
    return evidence_candidates(_evidence(t)).select("work_id", "role", F.col("date.year").alias("year"), F.round("confidence", 6).alias("confidence"))


def _adjusted(t) -> DataFrame:
    lives = _years(t).select("work_id", "birth", "death")
    return within_lifespan(evidence_candidates(_evidence(t)).join(lives, "work_id"))


@query("dt07_lifespan", f"WITH {_EVIDENCE_SQL} SELECT work_id, role, year, round(confidence, 6)::DOUBLE AS confidence FROM a")
def lifespan_rows(t):
    return _adjusted(t).select("work_id", "role", F.col("date.year").alias("year"), F.round("confidence", 6).alias("confidence"))


@query(
    "dt08_bundle",
    f"""WITH {_EVIDENCE_SQL}, b AS (SELECT work_id, min(year) FILTER (role = 'first_publication_date') AS f, min(year) FILTER (role = 'edition_publication_date') AS ed, max(confidence) FILTER (role = 'first_publication_date') AS cf FROM a GROUP BY 1)
    SELECT work_id, f AS display_year, CASE WHEN f IS NOT NULL THEN 'first_publication_date' ELSE 'unknown' END AS display_field, ed AS edition_year, round(cf, 6)::DOUBLE AS display_confidence FROM b""",
)
def bundles(t):
    rows = bundle(_adjusted(t))
    return rows.select("work_id", "display_year", "display_field", F.col("edition_publication_date.year").alias("edition_year"), F.round("display_confidence", 6).alias("display_confidence"))


def _scored(t) -> DataFrame:
    """Three pieces of evidence a work."""
    i = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("order")
    rows = t.orders.select(F.col("o_orderkey").alias("work_id"), F.year("o_orderdate").cast("int").alias("y"), i)
    k = F.col("work_id") + F.col("order")
    source = F.element_at(F.array(*map(F.lit, ("wikidata", "openlibrary", "page", "heuristic_url_year", "manual"))), (k % 5 + 1).cast("int"))
    return rows.select("work_id", "order", source.alias("source"), ((k % 8) / F.lit(10.0) + F.lit(0.25)).alias("score"), (F.col("y") + F.col("order")).alias("year"))


_SCORED_SQL = """s AS (SELECT o_orderkey AS work_id, i AS ord, ['wikidata', 'openlibrary', 'page', 'heuristic_url_year', 'manual'][(o_orderkey + i) % 5 + 1] AS source, ((o_orderkey + i) % 8) / 10.0 + 0.25 AS score, (year(o_orderdate) + i)::INTEGER AS year FROM orders, (VALUES (0), (1), (2)) v(i)),
 r AS (SELECT *, CASE source WHEN 'page' THEN 0 WHEN 'wikidata' THEN 1 WHEN 'openlibrary' THEN 2 WHEN 'heuristic_url_year' THEN 3 ELSE 9 END AS rank FROM s)"""


@query("dt10_resolution", f"WITH {_SCORED_SQL} SELECT work_id, source, year FROM r WHERE score >= 0.75 AND rank < 9 QUALIFY row_number() OVER (PARTITION BY work_id ORDER BY rank, score DESC, ord) = 1")
def resolution(t):
    return resolved(_scored(t)).select("work_id", "source", "year")


@query("dt11_finalisation", f"WITH {_SCORED_SQL} SELECT work_id, source, year, 'finalized' AS status FROM r WHERE score >= 0.85 AND source <> 'heuristic_url_year' QUALIFY row_number() OVER (PARTITION BY work_id ORDER BY rank, score DESC, ord) = 1")
def finalisation(t):
    return finalised(_scored(t))


@query("dt22_bad_evidence", "SELECT o_orderkey FROM orders WHERE NOT (year(o_orderdate) > year(o_orderdate) - o_custkey % 80 + 50 OR (o_orderpriority = '5-LOW' AND o_orderkey % 10 < 4))")
def bad_evidence(t):
    """Evidence years far beyond the author's death, and weak manual findings, are dropped."""
    y = F.year("o_orderdate")
    bad = (y > y - F.col("o_custkey") % 80 + 50) | ((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 10 < 4))
    return t.orders.filter(~bad).select("o_orderkey")


@query("dt21_finding_ladder", "SELECT o_orderkey, CASE WHEN k = 0 THEN 'source_day' WHEN k IN (1, 2) THEN 'url_day' WHEN k = 3 THEN 'source_any' WHEN k = 4 THEN 'url_any' WHEN k = 5 THEN 'existing' ELSE 'uncertain' END AS finding FROM (SELECT o_orderkey, o_orderkey % 7 AS k FROM orders)")
def finding_ladder(t):
    """Day-precise source dates first, then day-precise URL dates, then any, then the existing date."""
    k = F.col("o_orderkey") % 7
    source, url, existing = F.when(k == 0, "day").when((k == 2) | (k == 3), "year"), F.when(k.isin(1, 2), "day").when(k == 4, "month"), k == 5
    rows = t.orders.select("o_orderkey", source.alias("s"), url.alias("u"), existing.alias("e"))
    s, u = F.col("s"), F.col("u")
    return rows.select("o_orderkey", F.when(s == "day", "source_day").when(u == "day", "url_day").when(s.isNotNull(), "source_any").when(u.isNotNull(), "url_any").when(F.col("e"), "existing").otherwise("uncertain").alias("finding"))
