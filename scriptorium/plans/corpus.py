"""Substrate build: documents -> paragraphs -> sentences with identifiers, hashes and links; integrity gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import text_hash
from ..functions.text import clean, sentences
from ..operators.windows import neighbours
from ..registry import query
from ..sources.tables import spread


def paragraphs(docs: DataFrame) -> DataFrame:
    """Lines of a document as paragraphs, in order, empty ones out."""
    rows = spread(docs.select("doc_id", "source", "lang", "text")).select("doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("para_index", "raw"))
    rows = rows.select("doc_id", "source", "lang", "para_index", clean(F.col("raw")).alias("text")).filter("text <> ''")
    return rows.withColumn("para_hash", text_hash(F.col("text")))


def sentence_spans(docs: DataFrame) -> DataFrame:
    rows = paragraphs(docs).select("doc_id", "source", "lang", "para_index", F.posexplode(sentences(F.col("text"))).alias("sent_index", "text"))
    return rows.withColumn("span_id", text_hash(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("para_index").cast("string"), F.col("sent_index").cast("string"))))


_PARAGRAPHS = r"""p AS (SELECT doc_id, source, lang, i - 1 AS para_index, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS text FROM
 (SELECT doc_id, source, lang, unnest(a) AS raw, generate_subscripts(a, 1) AS i FROM (SELECT *, string_split(text, chr(10)) AS a FROM documents)) WHERE trim(regexp_replace(raw, '\s+', ' ', 'g')) <> '')"""
_SENTENCES = _PARAGRAPHS + r""", s AS (SELECT doc_id, source, lang, para_index, i - 1 AS sent_index, text FROM (SELECT doc_id, source, lang, para_index, unnest(a) AS text, generate_subscripts(a, 1) AS i FROM
 (SELECT *, list_filter(string_split(regexp_replace(text, '([.!?])\s+(["''“”‘’(]*[A-Z0-9])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: x <> '') AS a FROM p)))"""


@query("flagship_source_sentences", f"WITH {_SENTENCES} SELECT source, lang, count(DISTINCT doc_id) AS documents, count(*) AS sentences, sum(length(text))::BIGINT AS characters, min(sha256(text)) AS first_hash FROM s GROUP BY 1, 2")
def flagship(t):
    """Documents to sentences to per-source counts, with content hashes."""
    return sentence_spans(t.documents).groupBy("source", "lang").agg(F.countDistinct("doc_id").alias("documents"), F.count("*").alias("sentences"), F.sum(F.length("text")).alias("characters"), F.min(text_hash(F.col("text"))).alias("first_hash"))


@query("corpus_paragraphs", f"WITH {_PARAGRAPHS} SELECT doc_id, para_index::INTEGER AS para_index, sha256(text) AS para_hash FROM p")
def paragraph_rows(t):
    return paragraphs(t.documents).select("doc_id", "para_index", "para_hash")


@query("tf12_sentences", f"WITH {_SENTENCES} SELECT doc_id, para_index::INTEGER AS para_index, sent_index::INTEGER AS sent_index, text FROM s")
def sentence_rows(t):
    return sentence_spans(t.documents).select("doc_id", "para_index", "sent_index", "text")


@query(
    "gr07_sentence_links",
    f"WITH {_SENTENCES}, k AS (SELECT doc_id, para_index, sent_index, para_index * 100000 + sent_index AS place FROM s) SELECT doc_id, place, lag(place) OVER w AS prev_place, lead(place) OVER w AS next_place FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY place)",
)
def sentence_links(t):
    place = (F.col("para_index").cast("bigint") * 100000 + F.col("sent_index")).alias("place")
    return neighbours(sentence_spans(t.documents).select("doc_id", place), "place", ["doc_id"], ["place"])


@query("corpus_immutability", "SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1")
def immutability(t):
    """Re-ingest with changed text is reported, not applied: here, texts of toxic documents arrive changed."""
    before = t.documents.select("doc_id", text_hash(F.col("text")).alias("hash"))
    changed = t.documents.join(t.labels.filter("toxic = 1"), "doc_id", "left").select("doc_id", text_hash(F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("new_hash"))
    return violations(before, changed)


def violations(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    return stored.join(arriving, "doc_id").filter(F.col("hash") != F.col("new_hash")).select("doc_id")


def integrity_gates(paras: DataFrame, spans: DataFrame) -> DataFrame:
    """(gate, violations) of a stored build: paragraphs without text, repeated span ids, sentences without a paragraph."""
    gate = lambda name, df: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("gate"), "violations")
    twice = spans.groupBy("span_id").agg(F.count("*").alias("n")).filter("n > 1")
    orphan = spans.select("doc_id", "para_index").distinct().join(paras, ["doc_id", "para_index"], "left_anti")
    return gate("empty_paragraph", paras.filter(F.trim(F.coalesce("text", F.lit(""))) == "")).unionAll(gate("duplicate_span", twice)).unionAll(gate("orphan_sentence", orphan))


@query(
    "q30_integrity_gates",
    f"""WITH {_SENTENCES} SELECT 'empty_paragraph' AS gate, count(*) AS violations FROM p WHERE doc_id % 7 = 0 AND para_index = 0 AND doc_id % 5 <> 0
    UNION ALL SELECT 'duplicate_span', count(*) FROM s WHERE doc_id % 11 = 0 AND sent_index = 0 UNION ALL SELECT 'orphan_sentence', count(DISTINCT (doc_id, para_index)) FROM s WHERE doc_id % 5 = 0 AND para_index = 0""",
)
def integrity(t):
    """The gates over a build that was stored with faults: texts lost, spans written twice, paragraphs left out."""
    first = F.col("para_index") == 0
    paras = paragraphs(t.documents).filter(~(first & (F.col("doc_id") % 5 == 0))).withColumn("text", F.when(first & (F.col("doc_id") % 7 == 0), " ").otherwise(F.col("text")))
    spans = sentence_spans(t.documents)
    return integrity_gates(paras, spans.unionAll(spans.filter((F.col("doc_id") % 11 == 0) & (F.col("sent_index") == 0))))


@query("q31_coverage", f"WITH {_SENTENCES} SELECT source, count(*) AS sentences, count(quality) AS labelled, round(count(quality) * 100.0 / count(*), 3)::DOUBLE AS pct FROM s LEFT JOIN labels USING (doc_id) GROUP BY 1")
def edition_coverage(t):
    rows = sentence_spans(t.documents).groupBy("source", "doc_id").agg(F.count("*").alias("n")).join(t.labels, "doc_id", "left")
    labelled = F.sum(F.when(F.col("quality").isNotNull(), F.col("n")).otherwise(0))
    return rows.groupBy("source").agg(F.sum("n").alias("sentences"), labelled.alias("labelled"), F.round(labelled * F.lit(100.0) / F.sum("n"), 3).alias("pct"))


@query("q35_work_details", f"WITH {_PARAGRAPHS} SELECT doc_id, string_agg(substring(text, 1, 500), chr(10) ORDER BY para_index) AS excerpt FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY para_index) AS r FROM p) WHERE r <= 3 GROUP BY 1")
def work_details(t):
    rows = paragraphs(t.documents).withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy("para_index"))).filter("r <= 3")
    ordered = F.array_sort(F.collect_list(F.struct("para_index", F.substring("text", 1, 500).alias("x"))))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda e: e["x"]), "\n").alias("excerpt"))
