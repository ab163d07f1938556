"""Corpus pipeline over documents: language ID, line dedup, near-dedup, benchmark decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet in the shared folder and
rereads it as the next one's docs. All but the last return the columns of documents; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import decontam, lang_id, line_dedup, mixing, near_dup
from scriptorium.llm.common import cut, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return lang_id.accepted(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier document's go; a document left without text goes."""
    return line_dedup.without_duplicate_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8) stays: its smallest doc_id and text hash.

    Two texts of one doc_id are two documents. Repeated rows of one doc_id and text count as one, with their least lang,
    source and n_chars; rows with a null doc_id stay.
    """
    kept = near_dup.components(docs).filter((F.col("doc_id") == F.col("least.doc_id")) & (F.col("version") == F.col("least.version"))).select("doc_id", "version").distinct()
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("version"))
    stay = rows.join(kept, ["doc_id", "version"], "left_semi").groupBy("doc_id", "version").agg(F.first("text").alias("text"), F.min(F.struct("lang", "source", "n_chars")).alias("rest"))
    return stay.select("doc_id", "text", "rest.*").unionByName(rows.filter("doc_id is null").drop("version")).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    bad = decontam.overlaps(docs, items).select("doc_id", "version").distinct().alias("bad")
    rows = docs.select(*COLUMNS).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("bad.doc_id")) & (F.xxhash64("d.text") == F.col("bad.version"))
    return rows.join(bad, same, "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, repeats included: columns doc_id, size, source_size, target, taken; one row for each row."""
    return mixing.mix(docs)


STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("mixing", mix_sources)]

#: Language fields, edit joins and sketches have no SQL; every stage is tested against brute force on its own input instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
