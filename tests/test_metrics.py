"""Usage, cost and latency reports."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.operators import metrics

NOW = dt.datetime(2024, 1, 2)


def rows(spark, n=400):
    rng = np.random.default_rng(0)
    lat = rng.gamma(2.0, 4000.0, size=n)
    data = [
        (i, "claude" if i % 3 else "openai", "gpt-4o", float(lat[i]), 100 + i, 10, 110 + i, 0.001 * i, NOW - dt.timedelta(minutes=5 * i))
        for i in range(n)
    ]
    return spark.createDataFrame(
        data,
        "query_id int, provider string, model string, latency_ms double, tokens_in bigint, tokens_out bigint, "
        "tokens_used bigint, estimated_cost_usd double, queried_at timestamp",
    )


@pytest.mark.parametrize("model, cost", [("claude-opus-4-6", 90.0), ("gpt-4o", 20.0), ("claude-sonnet-4-6", 18.0), ("gpt-4o-mini", 0.75), ("?", 20.0), (None, 20.0)])
def test_cost_of_a_million_tokens_each_way(spark, model, cost):
    m = F.lit(1_000_000)
    got = spark.range(1).select(metrics.request_cost(F.lit(model).cast("string"), m, m).alias("c")).first().c
    assert got == pytest.approx(cost)


def test_usage_of_the_last_day(spark):
    df = rows(spark)
    got = {r.provider: r for r in metrics.usage_summary(df, F.lit(NOW)).collect()}
    local = [r for r in df.collect() if r.queried_at >= NOW - dt.timedelta(hours=24)]
    for p in ("claude", "openai"):
        mine = [r for r in local if r.provider == p]
        lat = [r.latency_ms for r in mine]
        assert got[p].total_queries == len(mine)
        assert got[p].p95_latency_ms == pytest.approx(np.quantile(lat, 0.95))
        assert got[p].avg_latency_ms == pytest.approx(np.mean(lat))
        assert got[p].total_tokens == sum(r.tokens_used for r in mine)
    view = {r.provider: r.query_count for r in metrics.cost_view(df, F.lit(NOW)).collect()}
    assert view == {p: got[p].total_queries for p in got}


def histogram_quantile(q, counts, total):
    bounds = metrics.LATENCY_BOUNDS
    rank = q * total
    for i, b in enumerate(bounds):
        if counts[i] >= rank:
            low, before = (bounds[i - 1], counts[i - 1]) if i else (0.0, 0)
            return low + (b - low) * (rank - before) / (counts[i] - before)
    return bounds[-1]


@pytest.mark.parametrize("latencies", [[0.1], [0.1, 0.4, 3, 3, 7], [100, 200], [0.2, 70], [5.0, 5.0]])
@pytest.mark.parametrize("q", [0.5, 0.95, 0.99])
def test_bucket_quantile(spark, latencies, q):
    df = spark.createDataFrame([("p", float(v), NOW) for v in latencies], "provider string, s double, queried_at timestamp")
    got = metrics.latency_quantiles(df, F.col("s"), {"x": q}).first().x
    counts = [sum(v <= b for v in latencies) for b in metrics.LATENCY_BOUNDS]
    assert got == pytest.approx(histogram_quantile(q, counts, len(latencies)))


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([("p", v) for v in (0.5, 0.6, 10.0, 99.0)], "provider string, s double")
    got = {r.le: r.cumulative_count for r in metrics.latency_histogram(df, F.col("s")).collect()}
    assert got == {"0.5": 1, "1.0": 2, "2.0": 2, "5.0": 2, "10.0": 3, "20.0": 3, "30.0": 3, "60.0": 3, "+Inf": 4}


def test_rates(spark):
    df = rows(spark, 24)
    assert metrics.query_rate(df).agg(F.sum("queries")).first()[0] == 24
    assert all(r.per_second == pytest.approx(r.queries / 60) for r in metrics.query_rate(df).collect())
    tokens = metrics.token_rate(df).groupBy("token_type").agg(F.sum("tokens").alias("t")).collect()
    assert {r.token_type: r.t for r in tokens} == {"input": sum(100 + i for i in range(24)), "output": 240}
    cost = metrics.cost_rate(df).collect()
    assert all(r.usd_per_hour == pytest.approx(3600 * r.usd_per_second) for r in cost)


@pytest.mark.parametrize("value, status", [(4.9, "green"), (5.0, "yellow"), (15.0, "red")])
def test_status(spark, value, status):
    assert spark.range(1).select(metrics.panel_status(F.lit(value), "active_alerts").alias("s")).first().s == status


def test_summary_document(spark):
    tiers = spark.createDataFrame([("low", 2), ("high", 5)], "risk_tier string, patient_count bigint")
    pending = spark.createDataFrame([(3,)], "pending bigint")
    row = metrics.summary_document(metrics.usage_summary(rows(spark), F.lit(NOW)), tiers, pending).first()
    assert [u.provider for u in row.llm_usage_last_24h] == ["claude", "openai"]
    assert [t.risk_tier for t in row.sepsis_alerts_by_tier] == ["high", "low"]
    assert row.embedding_queue_pending == 3


def test_sums_of_money_do_not_depend_on_the_order(spark):
    """Many small costs beside a few large ones: plain doubles are off at the eighth place, in each order by another amount."""
    costs = [1e7 + 0.1] + [0.00429 + i % 7 * 1e-8 for i in range(20_000)]
    want = float(sum(Decimal(repr(c)) for c in costs))
    assert abs(reduce(add, costs) - want) > 1e-8
    for order, parts in (("id", 1), ("-id", 3), ("xxhash64(id)", 8)):
        df = spark.createDataFrame(list(enumerate(costs)), "id long, c double").repartitionByRange(parts, F.expr(order))
        got = df.sortWithinPartitions(F.expr(order)).agg(metrics.exact_sum(F.col("c")).alias("s"), metrics.exact_mean(F.col("c")).alias("m"))
        assert got.first() == (want, want / len(costs))
    odd = spark.createDataFrame([(1, 1.0), (1, float("inf")), (2, 1e30), (2, 1e30), (3, None)], "g int, c double")
    got = {r.g: r.s for r in odd.groupBy("g").agg(metrics.exact_sum(F.col("c")).alias("s")).collect()}
    assert got == {1: float("inf"), 2: 2e30, 3: None}
