"""Vector search against NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.functions import vectors as vx
from wardlight.operators import cells, kernels, search

SCHEMA = "note_id bigint, chunk_index int, ICUSTAY_ID bigint, chunk_text string, embedding array<float>"


def make_chunks(seed=0, n=400, dim=16, copies=150):
    """Random vectors, many exact copies of one vector, one zero and one missing vector."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).astype(np.float32)
    v[:copies] = v[0]
    v[n - 1] = 0
    rows = [(i // 2, i % 2, i % 7, f"text {i}", v[i].tolist()) for i in range(n)]
    return [*rows, (10_000, 0, 1, "none", None)]


def brute(rows, q, k, stays=None):
    q = np.asarray(q, dtype=np.float64)
    scored = []
    for note, index, stay, _, v in rows:
        if v is None or (stays is not None and stay not in stays):
            continue
        v = np.asarray(v, dtype=np.float64)
        if np.linalg.norm(v) == 0:
            continue
        s = float(v @ q / np.linalg.norm(v) / np.linalg.norm(q))
        scored.append((-round(s, 9), note, index))
    return [(n, i, -s) for s, n, i in sorted(scored)[:k]]


def test_one_question(spark):
    rows = make_chunks()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    q = rows[0][4]
    literal = F.array(*[F.lit(x) for x in q])
    got = [(r.note_id, r.chunk_index) for r in search.top_k_chunks(df, literal, 20).collect()]
    assert got == [(n, i) for n, i, _ in brute(rows, q, 20)]
    got = [(r.note_id, r.chunk_index) for r in search.top_k_chunks(df, literal, 5, stays=[2, 3]).collect()]
    assert got == [(n, i) for n, i, _ in brute(rows, q, 5, {2, 3})]
    assert search.top_k_chunks(df, literal, 500, stays=[]).count() == 400


@pytest.mark.parametrize("per_block, per_slice", [(1024, 20_000), (3, 90)])
def test_many_questions(spark, monkeypatch, per_block, per_slice):
    monkeypatch.setattr(cells, "QUESTIONS_PER_BLOCK", per_block)
    monkeypatch.setattr(cells, "CHUNKS_PER_SLICE", per_slice)
    monkeypatch.setattr(kernels, "ROWS_AT_ONCE", per_slice // 2)
    rows = make_chunks(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    rng = np.random.default_rng(9)
    asked = [(f"q{j}", rng.normal(size=16).tolist(), int(j + 1)) for j in range(8)] + [("same", rows[0][4], 12)]
    qs = spark.createDataFrame(asked, "question_id string, embedding array<double>, k int")
    got: dict[str, list] = {}
    for r in search.top_k_batch(df, qs).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append((r.note_id, r.chunk_index, r.cosine_similarity))
        assert r.chunk_text and r.rank == len(got[r.question_id])
    for q, v, k in asked:
        want = brute(rows, v, k)
        assert [g[:2] for g in got[q]] == [w[:2] for w in want], q
        assert [g[2] for g in got[q]] == pytest.approx([w[2] for w in want], abs=1e-8)


def test_questions_limited_to_stays(spark):
    rows = make_chunks(2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    q = rows[5][4]
    qs = spark.createDataFrame([(1, q), (2, q), (3, q)], "question_id int, embedding array<float>")
    allowed = spark.createDataFrame([(1, 2), (1, 3), (2, 6)], "question_id int, ICUSTAY_ID bigint")
    got: dict[int, list] = {}
    for r in search.top_k_batch(df, qs, k=9, allowed=allowed).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append((r.note_id, r.chunk_index))
    assert got == {
        1: [w[:2] for w in brute(rows, q, 9, {2, 3})],
        2: [w[:2] for w in brute(rows, q, 9, {6})],
    }


def test_thousands_of_questions_on_one_heavy_stay(spark):
    rows = [(note, index, 1 if i % 10 else 2, text, v) for i, (note, index, _, text, v) in enumerate(make_chunks(4))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    vectors = {j: np.random.default_rng(j).normal(size=16).tolist() for j in range(5000)}
    qs = spark.createDataFrame(list(vectors.items()), "question_id int, embedding array<double>")
    allowed = qs.select("question_id", F.when(F.col("question_id") % 50 == 0, 2).otherwise(1).cast("long").alias("ICUSTAY_ID"))
    got: dict[int, list] = {}
    for r in search.top_k_batch(df, qs, k=2, allowed=allowed).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append((r.note_id, r.chunk_index))
    assert len(got) == 5000
    for j in range(0, 5000, 25):
        assert got[j] == [w[:2] for w in brute(rows, vectors[j], 2, {1 if j % 50 else 2})], j


@pytest.mark.parametrize("limited", [False, True])
def test_faulty_questions_are_errors(spark, limited):
    df = spark.createDataFrame(make_chunks(n=10, copies=2), SCHEMA)
    allowed = spark.createDataFrame([(1, i) for i in range(7)], "question_id int, ICUSTAY_ID bigint") if limited else None
    good = [1.0] * 16
    for rows, says in ([(1, good), (1, good)], "repeats"), ([(1, good[:4])], "differ in length"):
        qs = spark.createDataFrame(rows, "question_id int, embedding array<double>")
        with pytest.raises(Exception, match=says):
            search.top_k_batch(df, qs, k=3, allowed=allowed).collect()


def test_no_questions(spark):
    df = spark.createDataFrame(make_chunks(n=10, copies=2), SCHEMA)
    qs = spark.createDataFrame([], "question_id int, embedding array<float>")
    assert search.top_k_batch(df, qs, k=3).count() == 0


def test_no_pairwise_join_in_the_plans(spark):
    df = spark.createDataFrame(make_chunks(n=10, copies=2), SCHEMA)
    qs = spark.createDataFrame([(1, make_chunks()[0][4])], "question_id int, embedding array<float>")
    for made in (search.top_k_batch(df, qs, k=3), search.top_k_chunks(df, F.array(*[F.lit(1.0)] * 16), 3)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "TakeOrderedAndProject" in plan


def test_recall_of_approximate_search(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 24))
    v = (centres[rng.integers(0, 10, 600)] + rng.normal(scale=0.2, size=(600, 24))).astype(np.float32)
    rows = [(i, 0, i % 7, "t", v[i].tolist()) for i in range(600)]
    model, unit = search.lsh_index(spark.createDataFrame(rows, SCHEMA))
    found = 0
    for j in range(3):
        got = search.approx_top_k(model, unit, rows[j][4], 10).collect()
        want = {w[0]: w[2] for w in brute(rows, rows[j][4], 10)}
        found += len({r.note_id for r in got} & set(want))
        for r in got:
            if r.note_id in want:
                assert r.cosine_similarity == pytest.approx(want[r.note_id], abs=1e-6)
    assert found >= 24


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    row = df.select(
        vx.norm(F.col("a")).alias("n"),
        vx.l2_normalise(F.col("a")).alias("u"),
        vx.l2_normalise(F.col("z")).alias("uz"),
        vx.cosine(F.col("a"), F.col("a")).alias("c"),
        vx.cosine(F.col("a"), F.col("z")).alias("cz"),
        vx.to_text(F.col("a")).alias("t"),
    ).first()
    assert (row.n, row.u, row.uz, row.c, row.cz) == (5.0, [0.6, 0.8], [None, None], 1.0, None)
    assert row.t == "[3.00000000,4.00000000]"


def clustered(n=4000, dim=24, groups=30, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, dim))
    v = (middle[rng.integers(0, groups, n)] + rng.normal(scale=0.15, size=(n, dim))).astype(np.float32)
    return [(i, 0, i % 7, "t", v[i].tolist()) for i in range(n)]


def test_vector_text_rounds_the_exact_value(spark):
    """Ties at the ninth place go to the even digit, as in printf; all other numbers to the nearer one."""
    numbers = [k / 512 for k in (1, 3, -53, 511)] + [0.1, -0.0, -1e-12, 33554434.0, 1e30, None]
    df = spark.createDataFrame([(1, numbers), (2, []), (3, None)], "id int, v array<float>")
    for kind in ("float", "double"):
        got = {r.id: r.t for r in df.select("id", vx.to_text(F.col("v").cast(f"array<{kind}>")).alias("t")).collect()}
        exact = [None if x is None else float(np.float32(x)) for x in numbers]
        assert got == {1: "[" + ",".join("null" if x is None else f"{x:.8f}" for x in exact) + "]", 2: "[]", 3: None}
    assert got[1].startswith("[0.00195312,0.00585938,-0.10351562,0.99804688,")


def test_cells_find_nine_of_ten_and_read_few_folders(spark, tmp_path):
    rows = clustered()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    index = cells.build_cells(df, str(tmp_path / "cells"), sample=1000)
    assert len(index.centres) == 63 and index.counts.sum() == len(rows)
    assert sorted(r.note_id for r in index.vectors.select("note_id").collect()) == list(range(len(rows)))
    asked = spark.createDataFrame([(j, rows[j * 97][4]) for j in range(20)], "question_id int, embedding array<float>")
    stored = cells.open_cells(spark, str(tmp_path / "cells"))
    got = search.top_k_near(df, asked, stored, k=10, probes=6).collect()
    found = {j: {r.note_id for r in got if r.question_id == j} for j in range(20)}
    best = {j: {w[0] for w in brute(rows, rows[j * 97][4], 10)} for j in range(20)}
    assert sum(len(found[j] & best[j]) for j in range(20)) >= 0.9 * 200
    one = cells.approx_top_k(stored, asked.filter("question_id = 3").withColumn("k", F.lit(10)), probes=2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan or "cell#" in plan.split("PartitionFilters: [")[1][:60]


def test_exact_search_leaves_out_cells_by_their_bound(spark, tmp_path):
    rows = clustered(seed=8)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    index = cells.build_cells(df, str(tmp_path / "cells"))
    asked = [(j, rows[j * 31][4], j % 4 + 1) for j in range(40)] + [(99, [0.0] * 24, 3)]
    qs = spark.createDataFrame(asked, "question_id int, embedding array<float>, k int")
    got: dict[int, list] = {}
    for r in search.top_k_batch(df, qs, index=index).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append(r.note_id)
    assert got == {j: [w[0] for w in brute(rows, v, k)] for j, v, k in asked[:40]}
    unit = kernels.unit_rows(np.array([v for _, v, _ in asked[:40]]))
    bounds = cells.closest_possible(unit, index.centres, index.least)
    kth = np.array([brute(rows, v, k)[-1][2] for _, v, k in asked[:40]])
    sent = ((bounds >= kth[:, None]) * index.counts).sum()
    assert sent < 0.2 * len(rows) * 40  # pairs of question and chunk that are compared, of all pairs
    vectors = np.array([r[4] for r in rows])
    at = {r.note_id: r.cell for r in index.vectors.select("note_id", "cell").collect()}
    of = np.array([at[r[0]] for r in rows])
    sims = unit @ kernels.unit_rows(vectors).T
    assert all((sims[:, of == c].max(axis=1) <= bounds[:, c]).all() for c in np.unique(of))


def test_open_cells_get_no_copies_of_vectors(spark, tmp_path, monkeypatch):
    """With all cells open to all questions, what the second pass writes are a few rows per question."""
    rng = np.random.default_rng(4)
    rows = [(i, 0, 1, "t", v.tolist()) for i, v in enumerate(rng.normal(size=(2000, 48)).astype(np.float32))]
    rows += [(i, 0, 1, "t", rows[7][4]) for i in range(2000, 2300)]  # many copies of one vector
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    index = cells.build_cells(df, str(tmp_path / "cells"))
    asked = [(j, rng.normal(size=48).tolist(), 3) for j in range(60)] + [(60, rows[7][4], 3)]
    qs = spark.createDataFrame(asked, "question_id int, embedding array<double>, k int")
    monkeypatch.setattr(cells, "BLOCK_BYTES", 8 * 48 * 20, raising=False)
    sent = []

    def counted(index, questions, plain=cells._best_in_cells):
        sent.append(questions.count())
        return plain(index, questions)

    monkeypatch.setattr(cells, "_best_in_cells", counted)
    got: dict[int, list] = {}
    for r in search.top_k_batch(df, qs, index=index).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append(r.note_id)
    assert got == {j: [w[0] for w in brute(rows, v, k)] for j, v, k in asked}
    assert sum(sent) <= 61 * cells.FIRST_PROBES


def test_cells_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([(1, 0, 1, "t", None), (2, 0, 1, "t", [0.0, 0.0])], SCHEMA)
    index = cells.build_cells(none, str(tmp_path / "cells"))
    qs = spark.createDataFrame([(1, [1.0, 2.0])], "question_id int, embedding array<float>")
    assert search.top_k_batch(none, qs, k=3, index=index).count() == 0
    assert search.top_k_near(none, qs, index, k=3).count() == 0
    mixed = spark.createDataFrame([(1, 0, 1, "t", [0.0, 0.0]), (2, 0, 1, "t", [1.0, 1.0]), (3, 0, 1, "t", None)], SCHEMA)
    assert [r.note_id for r in search.top_k_batch(mixed, qs, k=3).collect()] == [2]
    assert search.top_k_batch(none.limit(0), qs, k=3).count() == 0
