"""The file drain: whole runs or nothing."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from wardlight.plans import jobs
from wardlight.sources import drain as d


def files(folder):
    return sorted(p for p in folder.rglob("*") if p.is_file())


def test_two_runs_are_read_back(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.range(100, numPartitions=4).select("id", F.concat(F.lit("ä\n\""), F.col("id").cast("string")).alias("t"), F.when(F.col("id") % 2 == 0, F.col("id") / 3).alias("x"), F.expr("timestamp_ntz'2024-01-01 05:00:00'").alias("at"))
    d.drain(df, str(path))
    d.drain(df.limit(5).withColumn("id", F.col("id") + 1000), str(path))
    back = d.read_drained(spark, str(path), df.schema)
    want = df.unionByName(df.limit(5).withColumn("id", F.col("id") + 1000))
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    runs = d.drained_runs(spark, str(path)).groupBy("run").agg(F.sum("rows").alias("n")).collect()
    assert sorted(r.n for r in runs) == [5, 100]


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    path = tmp_path / "out"
    d.drain(spark.range(10), str(path))
    before = files(path)
    bad = spark.range(0, 40, 1, 4).withColumn("x", F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise(F.lit("a")))
    with pytest.raises(Exception, match="lost"):
        d.drain(bad, str(path))
    assert files(path) == before
    assert d.read_drained(spark, str(path), "id long").count() == 10


def test_files_that_were_not_committed_are_removed(tmp_path):
    writer = d.DrainWriter(str(tmp_path), "json")
    folder = tmp_path / "data" / f"run={writer.run}"
    folder.mkdir(parents=True)
    for name in ("a.json", "b.json"):
        (folder / name).write_text("{}\n")
    writer.commit([d.Drained("a.json", 1), None])
    assert [p.name for p in files(folder)] == ["a.json"]
    manifest = json.loads((tmp_path / "manifests" / f"{writer.run}.json").read_text())
    assert [f["file"] for f in manifest["files"]] == [f"data/run={writer.run}/a.json"]


def test_csv_and_unknown_kinds(spark, tmp_path):
    d.drain(spark.createDataFrame([(1, "a,b"), (2, None)], "i int, t string").coalesce(1), str(tmp_path), "csv")
    text = next(p for p in files(tmp_path) if p.suffix == ".csv").read_text()
    assert text.splitlines() == ['1,"a,b"', "2,"]
    with pytest.raises(Exception, match="kind must be one of"):
        d.drain(spark.range(1), str(tmp_path), "xml")


def test_empty_tables_and_no_table(spark, tmp_path):
    d.drain(spark.range(0), str(tmp_path))
    assert d.read_drained(spark, str(tmp_path), "id long").count() == 0


def test_ingest_audit(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "ICUSTAYS.csv").write_text("icustay_id,intime,los\n1,2024-01-01 00:00:00,2.5\nx,2024-01-03 00:00:00,\n3,never,?\n")
    audit = jobs.audited_ingest(spark, str(raw), str(tmp_path / "typed"), ["ICUSTAYS", "PATIENTS"])
    got = {(r.table_name, r.column_name): (r.status, r.n_rows, r.n_files, r.bad_values) for r in audit.collect()}
    assert got == {
        ("ICUSTAYS", "ICUSTAY_ID"): ("ingested", 3, 1, 1),
        ("ICUSTAYS", "INTIME"): ("ingested", 3, 1, 1),
        ("ICUSTAYS", "LOS"): ("ingested", 3, 1, 1),
        ("PATIENTS", None): ("missing", None, None, None),
    }
    times = audit.filter("column_name = 'LOS'").first()
    assert (str(times.first_time), str(times.last_time)) == ("2024-01-01 00:00:00", "2024-01-03 00:00:00")
    typed = spark.read.parquet(str(tmp_path / "typed" / "icustays"))
    assert typed.columns == ["ICUSTAY_ID", "INTIME", "LOS", "_ingested_at", "_source_file"]
    assert typed.filter("_source_file LIKE '%ICUSTAYS.csv'").count() == 3
