"""Streaming forms of batch queries; each gives what the batch gives (ST)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import query
from ..sources.sinks import is_fresh
from .incremental import keyed_append, read_stream, run_available, shared, status_counts


@query("st01_idempotent_append", "SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'")
def idempotent(t):
    """Two runs over the same input; the second adds nothing."""
    folder = shared(t.spark)
    for again in ("first", "second"):
        rows = read_stream(t.spark, t.sf_dir, "events").filter("event_type <> 'error'").select("event_id", "event_type", "value")
        run_available(rows, keyed_append(f"{folder}/rows", ["event_id"], again), f"{folder}/{again}")
    return t.spark.read.parquet(f"{folder}/rows").drop("batch")


@query("st05_status_dashboard", "SELECT event_type, count(*) AS n, max(event_id % 7) AS depth FROM events GROUP BY 1")
def dashboard(t):
    folder = shared(t.spark)
    run_available(status_counts(read_stream(t.spark, t.sf_dir, "events")), lambda b, i: b.write.mode("overwrite").parquet(f"{folder}/rows"), folder, "complete")
    return t.spark.read.parquet(f"{folder}/rows")


@query("st09_windowed_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed(t):
    """Hourly counts with a watermark; late rows within it are counted."""
    folder = shared(t.spark)
    rows = read_stream(t.spark, t.sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "1 day")
    counts = rows.groupBy(F.window("at", "1 hour"), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")
    run_available(counts, lambda b, i: b.write.mode("overwrite").parquet(f"{folder}/rows"), folder, "complete")
    return t.spark.read.parquet(f"{folder}/rows")


@query("st03_quarantine", "SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'bad value' END AS error FROM events")
def quarantine(t):
    """Errors are a column, not an exception: bad rows go on beside good ones."""
    raw = F.when(F.col("event_id") % 11 == 0, "x").otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", F.when(raw.try_cast("double").isNull(), "bad value").alias("error"))


@query("st04_work_queue", "SELECT doc_id, CASE WHEN quality = 1 THEN 'ingested' WHEN quality = 0 THEN 'failed' ELSE 'pending' END AS status FROM documents LEFT JOIN labels USING (doc_id)")
def work_queue(t):
    status = F.when(F.col("quality") == 1, "ingested").when(F.col("quality") == 0, "failed").otherwise("pending")
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", status.alias("status"))


@query("st02_commits", "SELECT event_id % 5 AS part, count(*) AS n, 5::BIGINT AS commits FROM events GROUP BY 1")
def commits(t):
    """A run over five files commits after each: its log holds a row a commit, and each batch one file's rows."""
    folder = shared(t.spark)
    t.events.withColumn("part", F.col("event_id") % 5).repartition(5, "part").write.partitionBy("part").parquet(f"{folder}/in")
    schema = t.spark.read.parquet(f"{folder}/in").schema
    rows = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    run_available(rows, lambda b, i: b.groupBy("part").agg(F.count("*").alias("n")).withColumn("number", F.lit(i)).write.mode("overwrite").parquet(f"{folder}/log/batch={i}"), folder)
    log = t.spark.read.parquet(f"{folder}/log")
    total = log.agg(F.countDistinct("batch").alias("commits"))  # one row
    return log.groupBy(F.col("part").cast("bigint").alias("part")).agg(F.sum("n").alias("n")).crossJoin(F.broadcast(total))


@query("st06_time_to_live", "SELECT event_id, ts >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS fresh FROM events")
def time_to_live(t):
    """Cached rows that are still fresh an hour after they were fetched."""
    now = t.events.agg(F.max("ts").alias("now"))  # one row
    return t.events.crossJoin(F.broadcast(now)).select("event_id", is_fresh(F.col("ts"), F.col("now"), 3600).alias("fresh"))
