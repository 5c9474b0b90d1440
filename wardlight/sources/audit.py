"""Which expected files are there, and how large they are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.sources.schemas import EXPECTED_FILES

# A table may be one file or a folder of part files.
_PART_OF = r"/([^/]+\.(?:csv|parquet))(?:/[^/]+)?$"


def source_audit(
    spark: SparkSession, folder: str, expected: dict[str, bool] | None = None
) -> DataFrame:
    """``(file_name, required, present, size_bytes)``, one row per expected file.

    Only the listing is read: the file contents column is pruned from the scan.
    """
    expected = EXPECTED_FILES if expected is None else expected
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.regexp_extract("path", _PART_OF, 1).alias("file_name"), "length")
        .groupBy("file_name")
        .agg(F.sum("length").alias("size_bytes"))
    )
    manifest = spark.createDataFrame(
        [(name, required) for name, required in expected.items()],
        "file_name string, required boolean",
    )
    return manifest.join(listing, "file_name", "left").select(
        "file_name", "required", F.col("size_bytes").isNotNull().alias("present"), "size_bytes"
    )


def require_files(audit: DataFrame, names: Iterable[str] | None = None) -> None:
    """Raise when a required file (or one of ``names``) is missing."""
    wanted = F.col("required") if names is None else F.col("file_name").isin(list(names))
    missing = audit.filter(wanted & ~F.col("present")).select("file_name")
    # At most one row per manifest entry.
    absent = sorted(row.file_name for row in missing.collect())
    if absent:
        raise FileNotFoundError(f"missing source files: {absent}")
