"""Streams in several micro-batches against the batch result."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardlight.operators import cleaning
from wardlight.operators.embedding import embed_hashed
from wardlight.plans import proxies as px
from wardlight.streaming import jobs, sink
from wardlight.streaming.state import latest_version_changes, started

SF = "/root/testdata/sf0.001"


def parts(spark, df, path, order, n):
    """``df`` as n files in the given order of rows, oldest file first."""
    rows = df.orderBy(order).collect()
    step = -(-len(rows) // n)
    for i in range(n):
        spark.createDataFrame(rows[i * step : (i + 1) * step], df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def same(a, b):
    a = a.select(sorted(a.columns))
    b = b.select(sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hourly_vitals_over_many_batches(spark, tmp_path):
    chart = px.chart(spark, SF)
    stream = parts(spark, chart, str(tmp_path / "in"), "CHARTTIME", 4)
    got = jobs.run_hourly_vitals(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    want = cleaning.vitals_hourly(chart).drop("SUBJECT_ID", "HADM_ID")
    shown = [F.round(c, 9).alias(c) if c == "mean_val" else c for c in want.columns]
    assert same(got.select(shown), want.select(shown))
    assert spark.read.parquet(str(tmp_path / "out")).select("batch_id").distinct().count() >= 4


def test_late_readings_count(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 5)
    schema = "ICUSTAY_ID int, ITEMID int, CHARTTIME timestamp, VALUENUM double, ERROR int"
    path = str(tmp_path / "in")
    for at, value in ((t, 80.0), (t + dt.timedelta(hours=40), 70.0), (t, 60.0)):
        rows = [(1, 456, at, value, None)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = jobs.run_hourly_vitals(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert {r.hour_bucket: (r.mean_val, r.measurement_count) for r in got.collect()}[t] == (70.0, 2)


def test_restarted_stream_reads_only_new_files(spark, tmp_path):
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    chart = px.chart(spark, SF)
    half = chart.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    chart.filter(F.col("event_id") <= half).write.parquet(source)
    stream = lambda: spark.readStream.schema(chart.schema).parquet(source)
    jobs.run_hourly_vitals(spark, stream(), out, cp)
    chart.filter(F.col("event_id") > half).write.mode("append").parquet(source)
    got = jobs.run_hourly_vitals(spark, stream(), out, cp)
    want = cleaning.vitals_hourly(chart)
    assert got.count() == want.count()
    assert got.agg(F.sum("measurement_count")).first()[0] == want.agg(F.sum("measurement_count")).first()[0]


def test_note_dedup_over_batches(spark, tmp_path):
    notes = px.notes(spark, SF)
    stream = parts(spark, notes, str(tmp_path / "in"), "note_id", 3)
    got = jobs.run_note_dedup(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp"), "note_id")
    assert same(got, cleaning.clinical_notes(notes, "note_id"))


def test_embedding_replaces_a_note_that_comes_again(spark, tmp_path):
    schema = "note_id int, TEXT string"
    path = str(tmp_path / "in")
    for rows in ([(1, "word " * 700), (2, "two")], [(1, "short"), (3, "three")], [(2, "  ")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = jobs.run_embedding(
        spark, stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["note_id"], lambda df: embed_hashed(df, dim=8)
    )
    assert sorted((r.note_id, r.chunk_text, len(r.embedding)) for r in got.collect()) == [(1, "short", 8), (3, "three", 8)]


def test_metric_counters(spark, tmp_path):
    rows = px.metric_rows(spark, SF)
    stream = parts(spark, rows, str(tmp_path / "in"), "queried_at", 3)
    got = jobs.run_metric_counters(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert got.agg(F.sum("queries")).first()[0] == rows.count()
    assert got.agg(F.sum("cost_usd")).first()[0] == pytest.approx(rows.agg(F.sum("estimated_cost_usd")).first()[0])


def windows_by_loops(rows, hours=24):
    hourly: dict = {}
    for stay, _, at, value, _ in rows:
        hourly.setdefault((stay, at.replace(minute=0)), []).append(value)
    worst: dict = {}
    for (stay, hour), values in hourly.items():
        for i in range(1, hours + 1):
            key = (stay, hour + dt.timedelta(hours=i))
            worst[key] = min(worst.get(key, float("inf")), sum(values) / len(values))
    return worst


def test_trailing_worst_with_late_readings(spark, tmp_path):
    """Readings out of order over many batches and weeks, equal to the windows of all of them."""
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = [(i % 2, 456, start + dt.timedelta(minutes=rng.randrange(60 * 24 * 40)), float(rng.randrange(50, 90)), None) for i in range(400)]
    rows += [(0, 456, start + dt.timedelta(days=7 * w, hours=h, minutes=5), 40.0 + w, None) for w in range(5) for h in (0, 23, 24)]
    schema = "ICUSTAY_ID int, ITEMID int, CHARTTIME timestamp, VALUENUM double, ERROR int"
    path, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def add(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        return {(r.ICUSTAY_ID, r.window_end): r.worst for r in jobs.run_trailing_worst(spark, stream, out, cp).collect()}

    for i in range(3):
        add(rows[i * 100 : (i + 1) * 100])
    assert run() == pytest.approx(windows_by_loops(rows[:300]))
    written = spark.read.parquet(out)
    assert written.select("batch_id").distinct().count() == 3
    add(rows[300:])  # a restart goes on from its state
    assert run() == pytest.approx(windows_by_loops(rows))
    last = {(r.ICUSTAY_ID, r.window_end) for r in spark.read.parquet(out).filter("batch_id = 3").collect()}
    before, after = windows_by_loops(rows[:300]), windows_by_loops(rows)
    assert last == {k for k in after if after[k] != before.get(k)}  # only what changed
    add([])
    assert run() == pytest.approx(after)


def test_note_dedup_goes_on_after_a_failed_batch(spark, tmp_path):
    notes = px.notes(spark, SF).withColumn("CHARTTIME", F.when(F.col("note_id") % 5 != 0, F.col("CHARTTIME")))
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    stream = parts(spark, notes, source, F.xxhash64("note_id"), 5)
    changes = latest_version_changes(notes=stream, tie_break="note_id")

    def fail(batch):
        if next(fails, None):
            raise RuntimeError("lost")
        return batch

    fails = iter([False, False, True])
    with pytest.raises(Exception, match="lost"):
        started(spark, lambda: sink.write_versions(changes, out, cp, fail))
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 2
    got = jobs.run_note_dedup(spark, stream, out, cp, "note_id", every=2)
    assert same(got, cleaning.clinical_notes(notes, "note_id"))
    assert spark.read.parquet(out).count() < notes.count()


def test_parts_are_reduced(spark, tmp_path):
    path = str(tmp_path / "v")
    total = lambda rows: rows.groupBy("k").agg(F.sum("v").alias("v"))
    source = str(tmp_path / "in")
    for i in range(7):
        spark.createDataFrame([(1, 1), (i, 1)], "k int, v bigint").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("k int, v bigint").option("maxFilesPerTrigger", 1).parquet(source)
    sink.write_versions(stream, path, str(tmp_path / "cp"), total, "append", total, every=3).awaitTermination()
    left = sink.read_parts(spark, path)
    assert left.count() <= 9  # six batches reduced to a row per key, and one batch
    assert {r.k: r.v for r in total(left).collect()} == {0: 1, 1: 8, **{i: 1 for i in range(2, 7)}}
    again = sink.read_parts(spark, path, 5)  # as when batch 5 runs again
    assert sum(r.v for r in again.collect()) == 12


def test_rerun_of_a_batch_replaces_its_version(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(f"{path}/batch_id=0")
    spark.createDataFrame([(1, "c")], "k int, v string").write.parquet(f"{path}/batch_id=10")
    spark.createDataFrame([(1, "x")], "k int, v string").write.parquet(f"{path}/batch_id=9")
    assert sorted(tuple(r) for r in sink.latest_versions(spark, path, ["k"]).collect()) == [(1, "c"), (2, "b")]
    assert sorted(tuple(r) for r in sink.latest_children(spark, path, "k").collect()) == [(1, "c"), (2, "b")]


def test_a_batch_of_a_large_table_has_several_files(spark, tmp_path):
    """No file of the stream holds much more than a split of the table, and there are three batches still."""
    from wardlight.plans import queries

    spark.range(9000).repartition(9).write.parquet(str(tmp_path / "events.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        stream = queries._stream(spark, str(tmp_path), "events", "id")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    sizes = []
    started = stream.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True)
    started.foreachBatch(
        lambda batch, i: sizes.append((batch.count(), batch.select(F.input_file_name()).distinct().count()))
    ).start().awaitTermination()
    assert sum(n for n, _ in sizes) == 9000
    assert len(sizes) == 3 and all(files >= 3 for _, files in sizes)
