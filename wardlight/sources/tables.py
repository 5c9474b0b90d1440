"""Stored tables: scan, full refresh with observed counts, partition refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file systems hold something at ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, without rows when nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def write_observed(
    df: DataFrame, path: str, metrics: dict[str, Column], partition_by: tuple[str, ...] = ()
) -> dict[str, object]:
    """Replace the table at ``path`` and return aggregates of its rows, by name.

    They are observed while writing, so the plan runs once. The table that a plan reads must not
    be its own target: write to a new path instead. With ``partition_by`` only the partitions
    present in ``df`` are replaced.
    """
    seen = Observation()
    writer = df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return seen.get


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """As write_observed; returns the row count."""
    return write_observed(df, path, {"rows": F.count(F.lit(1))}, partition_by)["rows"]
