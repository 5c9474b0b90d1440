"""Embedding once per distinct text, the queue run and the backfill that goes on."""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.operators import vector_store as vs
from wardlight.plans import jobs

DIM = 16


def counting_model(log: Path, fail_on: str | None = None):
    """Vectors of two numbers; every text that the model sees is written down."""

    def model(texts):
        if fail_on in texts:
            raise RuntimeError("model is down")
        with log.open("a") as out:
            out.writelines(f"{t}\n" for t in texts)
        return [[float(len(t)), 1.0] for t in texts]

    return model


def test_terms_are_split_at_six_characters_and_few_are_kept(monkeypatch):
    monkeypatch.setattr(vs, "TERMS_KEPT", 3)
    texts = ["a\x1cb c\x85d A\x0bB\x0cC\n", "", None, " x\ty  x\u00a0Z\u2028\r\u0130 ", " ".join("abcdefgh" * 3)]
    known = vs.Positions(DIM)
    got = vs.term_counts(texts, known)
    for text, row in zip(texts, got):
        want = np.zeros(DIM)
        for word in re.findall(r"[^\x09-\x0D\x20]+", (text or "").lower()):
            want[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % DIM] += 1
        assert (row == want).all(), text
    assert len(known) <= 3


def test_every_distinct_text_is_embedded_once(spark, tmp_path):
    log, path = tmp_path / "calls", str(tmp_path / "vectors")
    rows = [(i, f"text {i % 7}") for i in range(100)] + [(100, None), (101, "")]
    df = spark.createDataFrame(rows, "i int, chunk_text string").repartition(5)
    got = {r.i: r.embedding for r in vs.embed_once(df, path, counting_model(log), dim=2).collect()}
    assert len(got) == len(rows) and got[100] is None and got[101] == [0.0, 1.0]
    assert all(got[i] == [float(len(t)), 1.0] for i, t in rows[:100])
    assert len(log.read_text().splitlines()) == 8
    more = spark.createDataFrame([(1, "text 1"), (2, "new")], "i int, chunk_text string")
    assert vs.embed_once(more, path, counting_model(log), dim=2).count() == 2
    assert log.read_text().splitlines()[8:] == ["new"]
    assert vs.stored_vectors(spark, path).count() == 9


def test_a_failed_run_keeps_its_finished_parts(spark, tmp_path):
    log, path = tmp_path / "calls", str(tmp_path / "vectors")
    df = spark.createDataFrame([(f"text {i}",) for i in range(60)], "chunk_text string")
    part = F.pmod(F.conv(F.substring(F.sha2("chunk_text", 256), 1, 8), 16, 10).cast("long"), F.lit(3))
    last = df.filter(part == 2).first().chunk_text
    with pytest.raises(Exception, match="model is down"):
        vs.embed_new(df, path, counting_model(log, last), dim=2, parts=3, tries=1)
    kept = vs.stored_vectors(spark, path).count()
    assert kept == df.filter(part < 2).count() > 0
    log.unlink()
    assert vs.embed_once(df, path, counting_model(log), dim=2, parts=3).filter("embedding IS NULL").count() == 0
    assert len(log.read_text().splitlines()) == 60 - kept


def test_term_vectors(spark):
    rows = [(1, "alpha beta beta"), (2, "Beta  ALPHA\tbeta"), (3, ""), (4, None), (5, "é È")]
    made = vs.embed_terms(spark.createDataFrame(rows, "i int, chunk_text string"), dim=DIM)
    assert dict(made.dtypes)["embedding"] == "array<float>"
    v = {r.i: np.array(r.embedding) for r in made.collect()}
    assert (v[1] == v[2]).all() and not v[3].any() and not v[4].any() and len(v[5]) == DIM
    assert np.linalg.norm(v[1]) == pytest.approx(1, abs=1e-6)
    model = vs.term_model(DIM)([t or "" for _, t in rows])
    assert all((v[i] == np.array(m, np.float32)).all() for (i, _), m in zip(rows, model))


def test_queue_run_by_batches(spark):
    queue = spark.createDataFrame(
        [(i, f"2024-01-{i:02d}" if i < 5 else None, "  " if i == 3 else f"note {i}", "2024-02-01" if i == 1 else None) for i in range(1, 7)],
        "queue_id int, charttime string, note_text string, embedded_at string",
    )
    old = spark.createDataFrame([(1, 0, "kept", [1.0]), (2, 0, "a", [1.0]), (2, 9, "stale", [1.0])], "note_id int, chunk_index int, chunk_text string, embedding array<float>")
    embed = lambda df: df.withColumn("embedding", F.array(F.lit(0.5)).cast("array<float>"))
    stored, after = jobs.run_queue(queue, old, embed, F.lit("now"), size=2)
    assert {r.queue_id for r in after.filter("embedded_at = 'now'").collect()} == {5, 6}  # undated ones come first
    stored, after = jobs.run_queue(after, stored, embed, F.lit("then"))
    assert {r.queue_id for r in after.filter("embedded_at = 'then'").collect()} == {2, 3, 4}
    assert sorted((r.note_id, r.chunk_text) for r in stored.collect()) == [(1, "kept"), (2, "note 2"), (4, "note 4"), (5, "note 5"), (6, "note 6")]
    _, again = jobs.run_queue(after, stored, embed, F.lit("later"))
    assert again.filter("embedded_at = 'later'").count() == 0


def test_backfill_goes_on_after_two_ranges(spark, tmp_path):
    log, path = tmp_path / "calls", str(tmp_path / "fill")
    notes = spark.createDataFrame([(i if i else None, f"note {i}") for i in range(40)], "note_id bigint, TEXT string")

    def embed(df):
        return df.withColumn("embedding", vs.term_embedding(F.col("chunk_text"), 4))

    def fill(most=None, made=embed):
        return jobs.backfill_in_units(notes, path, ["note_id"], made, units=5, most=most)

    part = fill(most=2)
    first = {r.note_id for r in part.collect()}
    assert 0 < len(first) < 40 and None in first

    def lost(df):
        log.write_text("asked")
        return df.withColumn("embedding", F.raise_error(F.lit("executor lost")).cast("array<float>"))

    with pytest.raises(Exception, match="executor lost"):
        fill(made=lost)
    assert log.exists() and spark.read.parquet(f"{path}/done").count() == 2
    whole = fill()
    assert sorted((r.note_id or 0) for r in whole.collect()) == list(range(40))
    assert spark.read.parquet(f"{path}/done").agg(F.sum("notes"), F.count("*")).first()[:] == (40, 5)
    assert fill(made=lost).count() == 40  # nothing is left to do


def test_backfill_of_no_notes(spark, tmp_path):
    none = spark.createDataFrame([], "note_id bigint, TEXT string")
    embed = lambda df: vs.embed_terms(df, dim=4)
    assert jobs.backfill_in_units(none, str(tmp_path / "f"), ["note_id"], embed, units=3).count() == 0
