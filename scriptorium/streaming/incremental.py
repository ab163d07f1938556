"""Incremental runs with Structured Streaming (ST): available-now triggers, keyed idempotent sinks, status aggregates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import checkpointed


def shared(spark: SparkSession) -> str:
    """A new folder below the one that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        checkpointed(spark.range(1))  # sets a folder where none is named
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


def status_counts(events: DataFrame) -> DataFrame:
    """Counts per status, as a dashboard polls them."""
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.max(F.col("event_id") % 7).alias("depth"))


def run_available(stream: DataFrame, sink, folder: str, mode: str = "append") -> None:
    """Process what is there now, batch by batch, with a checkpoint in folder, and stop."""
    running = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(sink).trigger(availableNow=True).start()
    running.awaitTermination()


def keyed_append(path: str, key: list[str], run: str = "run"):
    """A sink that adds only keys it has not got: a rerun, or a batch done twice, adds nothing.

    Each batch owns a folder named after its run and number and overwrites it, so a crash between write and commit
    leaves nothing behind; of what is there, only the keys of other batches are read.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"{run}-{number}"
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        new = batch.dropDuplicates(key)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            stored = spark.read.option("basePath", path).parquet(path).filter(F.col("batch") != name).select(*key)
            new = new.join(stored, key, "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/batch={name}")

    return sink


def read_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of parquet, one file or a folder of files, as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parquet")
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
