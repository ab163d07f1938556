"""Table scans: parquet by name, pruned and filtered by Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Attribute access to the tables of a folder: Tables(spark, dir).orders."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a table is smaller than what one scan task may read, as one row group is never split; else df as it is."""
    spark = df.sparkSession
    small = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(spark.sparkContext.defaultParallelism) if small else df


def jdbc_table(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, tasks: int = 8, **options: str) -> DataFrame:
    """A relational table, read by ranges of a whole-number key where one is given; filters and columns are pushed down."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(tasks))
    return reader.load()


def views(tables: Tables, *names: str) -> SparkSession:
    """Temporary views of tables, so that SQL can name them."""
    for name in names:
        getattr(tables, name).createOrReplaceTempView(name)
    return tables.spark
