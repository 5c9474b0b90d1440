"""Embedding with the built-in hash and with a user's model."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.operators import embedding

NOTES = "note_id int, TEXT string"
DIM = 32


def hashed(df):
    return embedding.embed_hashed(df, dim=DIM)


def test_hashed_vectors(spark):
    rows = [(1, "alpha beta"), (2, "beta  ALPHA"), (3, "gamma"), (4, "")]
    df = hashed(spark.createDataFrame(rows, "i int, chunk_text string"))
    v = {r.i: np.array(r.embedding) for r in df.collect()}
    assert all(len(x) == DIM for x in v.values())
    assert np.linalg.norm(v[1]) == pytest.approx(1.0, abs=1e-6)
    again = {r.i: np.array(r.embedding) for r in df.repartition(3).collect()}
    assert all((v[i] == again[i]).all() for i in v)
    assert dict(df.dtypes)["embedding"] == "array<float>"


def test_default_dimension(spark):
    df = embedding.embed_hashed(spark.createDataFrame([("a b",)], "chunk_text string"))
    assert df.select(F.size("embedding")).first()[0] == 1536


def test_user_model_keeps_order_and_batches(spark):
    def model(texts):
        assert 0 < len(texts) <= 4
        return [[float(len(t)), float(t)] for t in texts]

    df = spark.range(50).select("id", F.col("id").cast("string").alias("chunk_text")).repartition(3)
    rows = embedding.embed_with(df, model, dim=2, batch_texts=4).collect()
    assert len(rows) == 50
    assert all(r.embedding == [float(len(str(r.id))), float(r.id)] for r in rows)


def test_user_model_is_tried_again(spark):
    def make():
        calls = {"n": 0}

        def model(texts):
            calls["n"] += 1
            if calls["n"] < 3:
                raise RuntimeError("busy")
            return [[1.0] for _ in texts]

        return model

    df = spark.createDataFrame([("a",), ("b",)], "chunk_text string").coalesce(1)
    assert embedding.embed_with(df, make(), dim=1, first_delay=0.0).count() == 2
    with pytest.raises(Exception, match="busy"):
        embedding.embed_with(df, make(), dim=1, tries=2, first_delay=0.0).count()


@pytest.mark.parametrize("wrong", [[[1.0, 2.0, 3.0]], []])
def test_wrong_vectors_are_an_error(spark, wrong):
    df = spark.createDataFrame([("a",)], "chunk_text string")
    with pytest.raises(Exception, match="one vector of length 2"):
        embedding.embed_with(df, lambda texts: wrong, dim=2).count()


def test_incremental_run(spark):
    notes = spark.createDataFrame([(1, "one"), (2, "two"), (3, "  ")], NOTES)
    chunks, done = embedding.backfill(notes, ["note_id"], hashed)
    assert {r.note_id for r in chunks.collect()} == {1, 2} and done.count() == 3
    again, processed = embedding.embed_pending(notes, done, ["note_id"], hashed)
    assert again.count() == 0 and processed.count() == 0

    edited = spark.createDataFrame([(1, "one"), (2, "  "), (3, "  "), (4, "word " * 700)], NOTES)
    fresh, processed = embedding.embed_pending(edited, done, ["note_id"], hashed)
    assert {r.note_id for r in processed.collect()} == {2, 4}
    stored = embedding.refresh_chunks(chunks, fresh, processed)
    got = sorted((r.note_id, r.chunk_index) for r in stored.collect())
    assert got == [(1, 0), (4, 0), (4, 1), (4, 2)]
