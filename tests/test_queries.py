"""Every registered query against its SQL twin, on whole tables."""

from __future__ import annotations

import os

import numpy as np
import pytest
from compare import difference, duck

import __spark_entry__ as spark_entry
from wardlight.plans.oracle import ORACLE
from wardlight.plans.queries import all_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()
# Without a SQL twin: search by random projections. test_search compares it with brute force.
NO_TWIN = {"ann_lsh"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(ORACLE) == NO_TWIN and not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) == ""


def test_approximate_search_gives_ten_rows(spark):
    rows = QUERIES["ann_lsh"](spark, SF).collect()
    assert len(rows) == 10 and all(-1 <= r.cosine_similarity <= 1 for r in rows)


def test_retrieval_by_text_equals_brute_force(spark, monkeypatch):
    from wardlight.operators import search

    kept = {}
    original = search.top_k_batch

    def watch(chunks, asked, **kw):
        kept.update(chunks=chunks, asked=asked)
        return original(chunks, asked, **kw)

    monkeypatch.setattr(search, "top_k_batch", watch)
    got: dict[str, list] = {}
    for r in QUERIES["retrieve_notes"](spark, SF).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append((r.note_id, r.chunk_index))
    chunks = kept["chunks"].select("note_id", "chunk_index", "embedding").collect()
    asked = kept["asked"].select("question_id", "embedding").collect()
    matrix = np.array([c.embedding for c in chunks], dtype=np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    assert set(got) == {q.question_id for q in asked}
    for q in asked:
        v = np.array(q.embedding, dtype=np.float64)
        sims = np.round(matrix @ v / np.linalg.norm(v), 9)
        best = sorted((-s, c.note_id, c.chunk_index) for s, c in zip(sims, chunks))[:5]
        assert got[q.question_id] == [b[1:] for b in best], q.question_id


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["risk_tier", "count", "avg_sofa", "max_sofa"] and df.count() > 0
