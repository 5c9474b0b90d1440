"""Exact percentiles against NumPy, through the sketch path as well."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.operators.quantiles import exact_percentiles

PROBS = {"p0": 0.0, "q1": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def check(spark, data, **kw):
    rows = [(g, float(v)) for g, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", PROBS, **kw).collect()}
    assert set(got) == set(data)
    for g, vs in data.items():
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12), (g, name)


def data(seed):
    rng = np.random.default_rng(seed)
    return {
        "spread": rng.normal(size=6000),
        "one": [3.5],
        "two": [1.0, 2.0],
        "constant": [7.0] * 500,
        "tied": rng.integers(0, 5, size=4000).astype(float),
        "tail": np.concatenate([rng.uniform(size=3000), [1e12, -1e12]]),
    }


def test_groups_of_several_sizes(spark):
    check(spark, data(1))


@pytest.mark.parametrize("n", [1, 2, 3, 9, 10, 11, 50, 99, 100, 101, 1000, 1001, 9999, 10001])
def test_a_bracket_holds_both_ranks_whatever_the_size(spark, n):
    check(spark, {"g": np.random.default_rng(n).normal(size=n)})


def test_brackets_of_a_coarse_sketch(spark):
    check(spark, data(2), accuracy=2000)


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "g string, v double")
    rows = exact_percentiles(df, ["g"], "v", {"m": 0.5}).collect()
    assert [(r.g, r.m) for r in rows] == [("a", 2.0)]


def test_nan_is_left_out(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 11)] + [("a", float("nan"))], "g string, v double")
    assert exact_percentiles(df, ["g"], "v", {"p95": 0.95}).collect()[0].p95 == pytest.approx(9.55)


@pytest.mark.parametrize("shape", ["even", "copies", "far apart", "tiny steps", "infinite"])
def test_one_group_holds_all_values(spark, shape):
    """Most values equal, very uneven or very close: the result is that of sorting."""
    rng = np.random.default_rng(5)
    v = {
        "even": rng.uniform(-8e307, 8e307, 30_000) * 2,
        "copies": np.where(rng.random(30_000) < 0.9, 7.0, rng.normal(size=30_000)),
        "far apart": np.exp(rng.normal(scale=150, size=30_000)),
        "tiny steps": 1.7e9 + rng.integers(0, 1000, 30_000) * 1e-6,
        "infinite": np.append(rng.normal(size=29_998), [np.inf, -np.inf]),
    }[shape]
    df = spark.createDataFrame([("g", float(x)) for x in v], "g string, v double").repartition(4)
    probs = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.999}
    got = exact_percentiles(df, ["g"], "v", probs).first()
    ordered = np.sort(v)
    for name, p in probs.items():
        at = p * (len(v) - 1)
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(v) - 1)]
        assert got[name] == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12)


def test_values_are_counted_in_ranges_before_they_are_ordered(spark):
    """The last pass sees the values of a range only, not those of the group."""
    df = spark.range(200_000, numPartitions=4).select(F.lit("g").alias("g"), F.rand(3).alias("v"))
    made = exact_percentiles(df, ["g"], "v", {"m": 0.5})
    made.collect()
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert len(windows) == 2 and all("windowspecdefinition(_part" in w or "windowspecdefinition(g" in w for w in windows)
    assert sum("_v" in w for w in windows) == 1 and all("_part" in w for w in windows)
