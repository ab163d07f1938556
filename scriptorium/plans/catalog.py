"""Outside evidence: catalog records and entities, page header years, merges and curated dates (DT-12 to DT-20, DT-24)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.dates import parse_dateish
from ..functions.names import title_similarity
from ..functions.text import clean
from ..registry import query

YEARS = (1500, 2030)


def title_norm(text: Column) -> Column:
    """Lower case, punctuation to spaces, collapsed (FN-15)."""
    return clean(F.regexp_replace(F.lower(text), r"(?U)[^\w\s]", " "))


def title_variants(title: Column, url: Column) -> Column:
    """Ways to write a title: as is, without a bracketed tail, without its article, without punctuation, from its URL (DT-14)."""
    t = F.trim(title)
    bare = F.trim(F.regexp_replace(t, r"\s*[(\[].*?[)\]]\s*$", ""))
    parts = F.filter(F.split(F.regexp_extract(url, r"^([^?]*)", 1), "/"), lambda p: p != "")
    last = F.regexp_replace(F.try_element_at(parts, F.lit(-1)), r"\.html?", "")
    named = F.when(last.isin("index", "preface", "contents") & (F.size(parts) >= 2), F.try_element_at(parts, F.lit(-2))).otherwise(last)
    made = F.array(t, bare, F.when(F.lower(bare).rlike("^(?:the|a|an) "), F.trim(F.regexp_replace(bare, "^(?i)(?:the|a|an) ", ""))), F.trim(F.regexp_replace(bare, r"(?U)[^\w\s]", " ")), F.trim(F.regexp_replace(named, "[_-]+", " ")))
    return F.array_distinct(F.filter(made, lambda v: v.isNotNull() & (v != "")))


@F.pandas_udf(DoubleType())
def best_similarity(label: pd.Series, variants: pd.Series) -> pd.Series:
    """Best similarity of a label to at most twelve variants, all in normal form (FN-13)."""
    return pd.Series([max((title_similarity(v, x) for v in list(vs)[:12] if v), default=0.0) if x else 0.0 for x, vs in zip(label, variants, strict=True)])


def catalog_scores(records: DataFrame) -> DataFrame:
    """records(work_id, source, label, variants, author_similarity, instances, year) -> scored candidates (DT-15).

    Open-library records start at 0.45 and need 0.70 of author similarity; entities start at 0.55, need 0.72 and a kind
    that is a written work.
    """
    entity = F.col("source") == "wikidata"
    normal = F.transform("variants", title_norm)
    rows = records.withColumn("sim", best_similarity(title_norm(F.col("label")), normal))
    score = F.when(entity, F.least(F.lit(0.98), F.lit(0.55) + F.lit(0.35) * F.col("sim") + F.lit(0.15) * F.col("author_similarity"))).otherwise(F.least(F.lit(0.95), F.lit(0.45) + F.lit(0.4) * F.col("sim") + F.lit(0.15) * F.col("author_similarity")))
    enough = F.when(entity, (F.col("author_similarity") >= 0.72) & written_work(F.col("instances"))).otherwise(F.col("author_similarity") >= 0.70)
    return rows.filter(enough & F.col("year").between(*YEARS)).select("work_id", "source", "year", score.alias("score"))


#: Kinds of entity that are texts, and kinds that are not.
TEXTS = ("book", "written work", "literary work", "essay", "pamphlet", "article", "speech", "treatise", "monograph", "text", "novel")
NOT_TEXTS = ("concept", "theory", "doctrine", "ideology", "school", "movement", "method", "approach")


def written_work(kinds: Column) -> Column:
    """Some kind is a text, and none is only a notion."""
    is_text = lambda k: title_norm(k).rlike("|".join(TEXTS))
    notion = lambda k: title_norm(k).rlike("|".join(NOT_TEXTS)) & ~is_text(k)
    return F.exists(kinds, is_text) & ~F.exists(kinds, notion)


ENTITY = "labels map<string,struct<value:string>>, claims map<string,array<struct<mainsnak:struct<datavalue:struct<value:struct<time:string,id:string>>>>>>"


def entity_facts(rows: DataFrame, json: str) -> DataFrame:
    """Adds year, birth, death, human and label of a recorded entity's JSON (DT-16)."""
    e = F.from_json(json, ENTITY)
    values = lambda p: F.try_element_at(e["claims"], F.lit(p))
    years = lambda p, lo, hi: F.filter(F.transform(values(p), lambda c: F.regexp_extract(c["mainsnak"]["datavalue"]["value"]["time"], r"^[+-]?([0-9]{4})-", 1).try_cast("int")), lambda y: y.between(lo, hi))
    published = F.when(F.size(values("P577")) > 0, years("P577", *YEARS)).otherwise(years("P571", *YEARS))
    human = F.coalesce(F.exists(values("P31"), lambda c: c["mainsnak"]["datavalue"]["value"]["id"] == "Q5"), F.lit(False))
    first = lambda p: F.get(years(p, 1200, 2030), 0)
    label = F.coalesce(F.try_element_at(e["labels"], F.lit("en"))["value"], F.get(F.map_values(e["labels"]), 0)["value"])
    return rows.withColumns({"year": F.array_min(published), "birth": first("P569"), "death": first("P570"), "human": human, "label": label})


def lifespan_candidates(people: DataFrame, current_year: int) -> DataFrame:
    """people(author_id, similarity, birth, death, human) -> plausible lifespans with scores (DT-17)."""
    known = F.coalesce("birth", "death").isNotNull()
    plausible = ~F.coalesce(F.col("death").isNull() & (F.col("birth") <= current_year - 110), F.lit(False)) & (F.coalesce(F.greatest("birth", "death"), F.lit(0)) <= current_year)
    bonus = F.when(F.col("birth").isNotNull() & F.col("death").isNotNull(), 0.08).otherwise(0.0)
    rows = people.filter((F.col("similarity") >= 0.82) & F.col("human") & known & plausible)
    return rows.withColumn("score", F.least(F.lit(0.99), F.lit(0.6) + F.lit(0.35) * F.col("similarity") + bonus))


def apply_lifespans(authors: DataFrame, candidates: DataFrame, min_score: float = 0.85, most_conflict: int = 25) -> DataFrame:
    """Missing years are filled from the best candidate, unless it is far from a year that is known."""
    best = candidates.filter(F.col("score") >= min_score).groupBy("author_id").agg(F.max_by(F.struct("birth", "death"), F.struct("score", -F.coalesce("birth", F.lit(0)))).alias("c"))
    far = F.coalesce(F.abs(F.col("birth") - F.col("c.birth")) > most_conflict, F.lit(False)) | F.coalesce(F.abs(F.col("death") - F.col("c.death")) > most_conflict, F.lit(False))
    fill = lambda c: F.when(~far, F.coalesce(c, f"c.{c}")).otherwise(F.col(c)).alias(c)
    return authors.join(best, "author_id", "left").select("author_id", fill("birth"), fill("death"))


#: Labels of date lines, what ends such a line, and scores and tags by label.
_LABEL = re.compile(r"\s*(first\s+published|published|publication\s+date|first\s+edition|first\s+printed)\s*:\s*(.*)$", re.I)
_BARE = frozenset(("first published", "published", "publication date", "first edition", "first printed"))
_TAIL = re.compile("transcribed|transcription|markup|proofread|last updated|copyleft|cc by|source:", re.I)
_YEAR = re.compile(r"(?<!\d)(1[5-9]\d{2}|20[0-3]\d)(?!\d)")
_TAGS = (("first published", "first_published", 0.92), ("publication date", "publication_date", 0.90), ("published", "published", 0.86), ("", "edition", 0.84))
HEAD_LINES = 140


def header_years(lines: list[str]) -> list[tuple[int, float, str]]:
    """(year, score, tag) from labelled lines at the top of a page; best per year, best first (DT-13)."""
    head = [s for line in lines if (s := line.strip())][:HEAD_LINES]
    best: dict[int, tuple[float, str]] = {}

    def offer(text: str, score: float, tag: str) -> None:
        after = text.partition(":")[2]
        if (m := _YEAR.search(after if after.strip() else text)) and YEARS[0] <= (y := int(m[1])) <= YEARS[1] and score > best.get(y, (-1.0, ""))[0]:
            best[y] = (score, tag)

    for i, line in enumerate(head):
        if m := _LABEL.match(line):
            label, rest, at = re.sub(r"\s+", " ", m[1].lower()), m[2].strip(), i + 1
        elif line.lower() in _BARE and i + 1 < len(head) and head[i + 1].startswith(":"):
            label, rest, at = line.lower(), head[i + 1][1:].strip(), i + 2
        else:
            continue
        window = [f"{label}: {rest}".strip()]
        for following in head[at : at + (3 if rest else 2)]:
            if _LABEL.match(following) or "source:" in following.lower():
                break
            window.append(following)
        text = _TAIL.split(" ".join(window), maxsplit=1)[0]
        tag, score = next((t, s) for start, t, s in _TAGS if label.startswith(start))
        before, cut, _ = text.lower().partition("translation published")
        if cut:
            offer(text[: len(before)], score, tag)
            offer(text, 0.70, "translation_published")
        else:
            offer(text, score, tag)
    return sorted(((y, s, t) for y, (s, t) in best.items()), key=lambda c: -c[1])


def ingested_candidate(fields: Column) -> Column:
    """Date of an ingested header: first published, else a plausible published line, else, without a published year, the source line (DT-12)."""
    line = lambda label: F.try_element_at(fields, F.lit(label))
    first, published, source = (parse_dateish(line(x)) for x in ("First Published", "Published", "Source"))
    pick = lambda d, score, field: F.struct(d["year"].alias("year"), F.lit(score).alias("score"), F.lit(field).alias("field"))
    return (
        F.when(first.isNotNull(), pick(first, 0.95, "First Published"))
        .when(published.isNotNull(), F.when(plausible_publication(line("Published")), pick(published, 0.92, "Published")))
        .when(source.isNotNull() & plausible_publication(line("Source")), pick(source, 0.90, "Source"))
    )


#: What rules a header line out as a first publication, and what speaks for one.
RULED_OUT = ("internet archive", "transcription", "markup", "mark-up", "proof", "public domain", "copyleft", "creative commons", "collected works", "selected works", "progress publishers")
SPEAKS_FOR = ("no.", "issue", "vol.", "pp.", "pravda", "iskra", "new international", "new york", "gazette", "journal", "newspaper", "bulletin", "review")


def plausible_publication(line: Column) -> Column:
    low = F.lower(F.coalesce(line, F.lit("")))
    any_of = lambda words: low.rlike("|".join(re.escape(w) for w in words))
    return F.when(any_of(RULED_OUT), False).otherwise(any_of(SPEAKS_FOR) | low.rlike(r"(?<![0-9])(1[5-9][0-9]{2}|20[0-3][0-9])(?![0-9])"))


def merged_fields(existing: Column, incoming: Column) -> Column:
    """Fill-only merge of two string maps: what is there and not empty stays (DT-19)."""
    return F.map_zip_with(F.coalesce(existing, F.create_map().cast("map<string,string>")), F.coalesce(incoming, F.create_map().cast("map<string,string>")), lambda k, a, b: F.coalesce(F.nullif(a, F.lit("")), b))


@query("dt14_title_variants", "SELECT p_partkey, concat_ws('|', 'The ' || p_name || ' [excerpt]', 'The ' || p_name, p_name, p_partkey::VARCHAR) AS variants FROM part")
def variants(t):
    title = F.concat(F.lit("The "), "p_name", F.lit(" [excerpt]"))
    return t.part.select("p_partkey", F.array_join(title_variants(title, F.concat(F.lit("https://e.org/w/"), F.col("p_partkey").cast("string"), F.lit("/index.htm"))), "|").alias("variants"))


@query(
    "dt15_catalog_scores",
    """SELECT work_id, source, year, CASE source WHEN 'wikidata' THEN least(0.98, 0.55 + 0.35 * sim + 0.15 * a) ELSE least(0.95, 0.45 + 0.4 * sim + 0.15 * a) END::DOUBLE AS score FROM (
    SELECT p_partkey AS work_id, CASE WHEN p_partkey % 2 = 0 THEN 'wikidata' ELSE 'openlibrary' END AS source, (p_size + 1850)::INTEGER AS year, 0.6 + (p_partkey % 5) / 10.0 AS a, p_partkey % 4 <> 0 AS is_text,
    CASE WHEN p_partkey % 3 = 0 THEN 1.0 ELSE 0.55 * (2.0 * length(p_name) / (2 * length(p_name) + 11)) + 0.45 * (w / (w + 2.0)) END AS sim FROM (SELECT *, len(list_distinct(string_split(p_name, ' '))) AS w FROM part)
    ) WHERE CASE source WHEN 'wikidata' THEN a >= 0.72 AND is_text ELSE a >= 0.70 END""",
)
def scores(t):
    label = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" volume two")))
    kinds = F.when(F.col("p_partkey") % 4 == 0, F.array(F.lit("philosophical concept"))).otherwise(F.array(F.lit("literary work")))
    records = t.part.select(F.col("p_partkey").alias("work_id"), F.when(F.col("p_partkey") % 2 == 0, "wikidata").otherwise("openlibrary").alias("source"), label.alias("label"), F.array("p_name").alias("variants"), (F.lit(0.6) + (F.col("p_partkey") % 5) / F.lit(10.0)).alias("author_similarity"), kinds.alias("instances"), (F.col("p_size") + 1850).alias("year"))
    return catalog_scores(records)


@query(
    "dt16_entity_facts",
    """SELECT c_custkey, (1800 + c_custkey % 90)::INTEGER AS year, (1770 + c_custkey % 90)::INTEGER AS birth, CASE WHEN c_custkey % 2 = 0 THEN 1830 + c_custkey % 90 END::INTEGER AS death, c_custkey % 3 <> 0 AS human, c_name AS label FROM customer""",
)
def facts(t):
    y = F.col("c_custkey") % 90
    time = lambda base: F.concat(F.lit('{"mainsnak":{"datavalue":{"value":{"time":"+'), (base + y).cast("string"), F.lit('-01-01T00:00:00Z"}}}}'))
    kind = F.when(F.col("c_custkey") % 3 != 0, "Q5").otherwise("Q571")
    json = F.concat(
        F.lit('{"labels":{"en":{"value":"'), "c_name", F.lit('"}},"claims":{"P577":['), time(F.lit(1805)), F.lit(","), time(F.lit(1800)), F.lit('],"P569":['), time(F.lit(1770)), F.lit('],"P570":['), F.when(F.col("c_custkey") % 2 == 0, time(F.lit(1830))).otherwise(""),
        F.lit('],"P31":[{"mainsnak":{"datavalue":{"value":{"id":"'), kind, F.lit('"}}}}]}}'),
    )
    return entity_facts(t.customer.select("c_custkey", "c_name", json.alias("json")), "json").select("c_custkey", "year", "birth", "death", "human", "label")


@query("dt17_lifespans", "SELECT c_custkey AS author_id, CASE WHEN c_custkey % 5 = 0 THEN 1700 WHEN s THEN 1800 + c_custkey % 60 END::INTEGER AS birth, CASE WHEN s AND c_custkey % 5 <> 0 AND c_custkey % 2 = 0 THEN 1870 END::INTEGER AS death FROM (SELECT c_custkey, 0.6 + 0.35 * (0.8 + (c_custkey % 3) / 10.0) + CASE WHEN c_custkey % 2 = 0 THEN 0.08 ELSE 0 END >= 0.85 AND c_custkey % 3 > 0 AND c_custkey % 2 = 0 AS s FROM customer)")
def lifespans(t):
    k = F.col("c_custkey")
    people = t.customer.select(k.alias("author_id"), (F.lit(0.8) + (k % 3) / F.lit(10.0)).alias("similarity"), (1800 + k % 60).cast("int").alias("birth"), F.when(k % 2 == 0, F.lit(1870)).alias("death"), F.lit(True).alias("human"))
    authors = t.customer.select(k.alias("author_id"), F.when(k % 5 == 0, F.lit(1700)).alias("birth"), F.lit(None).cast("int").alias("death"))
    return apply_lifespans(authors, lifespan_candidates(people, 2025))


@query("dt19_merge", "SELECT o_orderkey, concat('Source=', CASE WHEN o_orderkey % 2 = 0 THEN 'old' ELSE 'new' END, ';Written=', o_orderstatus) AS fields FROM orders")
def merge(t):
    old = F.create_map(F.lit("Source"), F.when(F.col("o_orderkey") % 2 == 0, "old").otherwise(""))
    both = merged_fields(old, F.create_map(F.lit("Source"), F.lit("new"), F.lit("Written"), F.col("o_orderstatus")))
    entries = F.array_sort(F.transform(F.map_entries(both), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return t.orders.select("o_orderkey", F.array_join(entries, ";").alias("fields"))


@query("dt12_ingested_candidate", "SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, CASE k WHEN 0 THEN 'First Published' WHEN 1 THEN 'Published' ELSE 'Source' END AS field FROM (SELECT *, o_orderkey % 4 AS k FROM orders) WHERE k < 3")
def ingested(t):
    y, k = F.year("o_orderdate").cast("string"), F.col("o_orderkey") % 4
    fields = F.create_map(F.lit("First Published"), F.when(k == 0, y), F.lit("Published"), F.when(k == 1, F.concat(F.lit("Gazette, "), y)).when(k == 3, F.concat(F.lit("Collected Works, "), y)), F.lit("Source"), F.concat(F.lit("Journal No. 3, "), y))
    rows = t.orders.select("o_orderkey", ingested_candidate(fields).alias("c")).filter("c IS NOT NULL")
    return rows.select("o_orderkey", "c.year", "c.field")


@query("dt20_uncertain", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'status=uncertain;year=' ELSE concat('year=', year(o_orderdate)) END AS bundle FROM orders")
def uncertain(t):
    known = F.col("o_orderkey") % 3 != 0
    base = F.create_map(F.lit("year"), F.when(known, F.year("o_orderdate").cast("string")).otherwise(""))
    marked = F.when(known, base).otherwise(F.map_concat(base, F.create_map(F.lit("status"), F.lit("uncertain"))))
    return t.orders.select("o_orderkey", F.array_join(F.array_sort(F.transform(F.map_entries(marked), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";").alias("bundle"))


@query("dt24_curated", "SELECT o_orderpriority AS title, CASE WHEN o_orderpriority ILIKE '%urgent%' THEN 1848 ELSE 1867 END::INTEGER AS year, count(*) AS works FROM orders WHERE o_orderpriority ILIKE '%urgent%' OR o_orderpriority ILIKE '%medium%' GROUP BY 1, 2")
def curated(t):
    table = t.spark.createDataFrame([("urgent", 1848), ("medium", 1867)], "part string, year int")  # a constant table
    titles = t.orders.groupBy(F.col("o_orderpriority").alias("title")).agg(F.count("*").alias("works"))
    return titles.join(F.broadcast(table), F.lower("title").contains(F.col("part"))).select("title", "year", "works")


@query("q32_source_votes", "SELECT * FROM (SELECT o_orderstatus AS source, year(o_orderdate)::BIGINT AS year, count(*) AS n FROM orders GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, year) = 1")
def source_votes(t):
    votes = t.orders.groupBy(F.col("o_orderstatus").alias("source"), F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count("*").alias("n"))
    best = votes.groupBy("source").agg(F.min(F.struct((-F.col("n")).alias("m"), "year")).alias("b"))
    return best.select("source", "b.year", (-F.col("b.m")).alias("n"))
