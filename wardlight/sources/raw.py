"""Raw CSV tables to typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardlight.functions.casts import lenient
from wardlight.sources.schemas import MULTI_LINE_TABLES, RAW_TYPES


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as strings, names in upper case, quotes doubled inside quotes."""
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )
    return df.toDF(*[c.upper() for c in df.columns])


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the columns named in ``types`` that exist; bad values become NULL."""
    return df.select(
        *[lenient(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def with_provenance(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_file": F.col("_metadata.file_path")}
    )


def ingest(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One raw table, typed, with its load time and source file."""
    table = table.upper()
    raw = read_raw_csv(spark, path, multi_line=table in MULTI_LINE_TABLES)
    return typed(with_provenance(raw), RAW_TYPES.get(table, {}))


def ingest_observed(spark: SparkSession, path: str, table: str, out: str) -> dict[str, object]:
    """Write one raw table, typed, to ``out`` and return what was seen on the way.

    One pass gives the rows, the source files, the least and greatest value of the first time column,
    and per typed column how many values were there but could not be cast.
    """
    table = table.upper()
    types = RAW_TYPES.get(table, {})
    raw = with_provenance(read_raw_csv(spark, path, multi_line=table in MULTI_LINE_TABLES))
    cast = [c for c in raw.columns if types.get(c, "string") != "string"]
    kept = raw.select("*", *[F.col(c).alias(f"_raw_{c}") for c in cast])
    done = typed(kept, types)
    times = [c for c in cast if types[c] == "timestamp"]
    seen = {
        "rows": F.count(F.lit(1)),
        "files": F.approx_count_distinct("_source_file"),
        "first_time": F.min(times[0]) if times else F.lit(None).cast("timestamp"),
        "last_time": F.max(times[0]) if times else F.lit(None).cast("timestamp"),
        **{f"bad_{c}": F.count_if(F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull()) for c in cast},
    }
    observed = Observation()
    whole = done.observe(observed, *[v.alias(k) for k, v in seen.items()])
    whole.drop(*[f"_raw_{c}" for c in cast]).write.mode("overwrite").parquet(out)
    return observed.get


AUDIT = (
    "table_name string, status string, column_name string, n_rows long, n_files long, bad_values long, "
    "first_time timestamp, last_time timestamp"
)


def audit_rows(table: str, seen: dict[str, object] | None) -> list[tuple]:
    """A row per typed column of an ingested table; one row for a table without a source."""
    if seen is None:
        return [(table, "missing", None, None, None, None, None, None)]
    common = (seen["rows"], seen["files"])
    bad = {k[len("bad_") :]: n for k, n in seen.items() if k.startswith("bad_")} or {None: None}
    return [(table, "ingested", c, *common, n, seen["first_time"], seen["last_time"]) for c, n in bad.items()]
