"""Shared plumbing of the training-data operators: lineage cuts, table reads, word arrays."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session; where that is unset, one of our own, which must be local mode's."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="scriptorium-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: later stages survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of cut() that nothing will read again: what was made of them is written itself."""
    for df in tables:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df._written)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """A table's columns, over all cores where it is smaller than what one scan task may read, as one row group is never split."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    df = df.select(*columns) if columns else df
    small = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(spark.sparkContext.defaultParallelism) if small else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tidied(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of Arrow batches that gives its memory back to the system when it ends: Python workers outlive their tasks."""

    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)

    return run


class WordIds(dict):
    """Word (bytes) -> 64-bit hash, remembered up to a bound."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def text_rows(batch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


#: Slots of a membership bitmap: a prime below 2**26, so 8 MB however many values it covers.
SLOTS = 67_108_859


def membership(values: DataFrame, column: str) -> np.ndarray:
    """Bitmap of a long column, of fixed size: a prefilter that lets every member pass, and few others while sparse."""
    slots = values.select(F.pmod(column, F.lit(SLOTS)).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")).toArrow()
    out = np.zeros((SLOTS >> 6) + 1, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def maybe_members(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = np.mod(values, SLOTS)
    return (bitmap[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
