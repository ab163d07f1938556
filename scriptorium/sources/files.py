"""File scans: raw objects, manifests, mappings, JSON lines (SRC-01, SRC-05, SRC-06, SRC-08, SRC-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "root_url string, snapshots array<struct<url:string,sha256:string,raw_path:string,content_type:string>>"


def raw_objects(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """(sha256, html, path): pages below a folder, content-addressed; a caller may leave out larger ones than max_bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", "true").load(path)
    files = files if max_bytes is None else files.filter(F.col("length") <= max_bytes)
    return files.select(F.sha2("content", 256).alias("sha256"), F.decode("content", "UTF-8").alias("html"), "path").dropDuplicates(["sha256"])


def manifest_pages(spark: SparkSession, path: str, max_pages: int | None = None) -> DataFrame:
    """(root_url, place, url, sha256, raw_path): a manifest's pages, or its first max_pages, in order; damaged manifests give none."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", MANIFEST).alias("m"))
    pages = rows.select("m.root_url", F.posexplode(F.col("m.snapshots") if max_pages is None else F.slice("m.snapshots", 1, max_pages)).alias("place", "s"))
    return pages.select("root_url", "place", "s.url", "s.sha256", "s.raw_path")


def write_manifests(pages: DataFrame, path: str) -> None:
    """One JSON manifest row per root, its snapshots in order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "url", "sha256", "raw_path"))), lambda s: F.struct(s["url"].alias("url"), s["sha256"].alias("sha256"), s["raw_path"].alias("raw_path")))
    pages.groupBy("root_url").agg(listed.alias("snapshots")).write.mode("overwrite").json(path)


def mapping(spark: SparkSession, text: str) -> DataFrame:
    """(variant, canonical, display) of a YAML mapping in either shape: lists of variants, or display name and aliases."""
    import yaml

    rows = []
    for canonical, value in (yaml.safe_load(text) or {}).items():
        names, display = (value.get("aliases") or [], value.get("display")) if isinstance(value, dict) else (value or [], None)
        rows += [(str(v), str(canonical), display or str(canonical)) for v in names]
    return spark.createDataFrame(rows, "variant string, canonical string, display string")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file under a given schema; a damaged line is kept whole in _corrupt."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
