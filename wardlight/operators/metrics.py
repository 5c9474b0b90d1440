"""Usage, cost and latency reports over one row per answered question.

Columns used: query_id, provider, model, latency_ms, tokens_in, tokens_out,
tokens_used, estimated_cost_usd, queried_at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions.times import within_last
from wardlight.operators.quantiles import exact_percentiles

# USD per million input and output tokens, and for other models.
PRICES: dict[str, tuple[float, float]] = {
    "claude-opus-4-6": (15.0, 75.0),
    "claude-sonnet-4-6": (3.0, 15.0),
    "gpt-4o": (5.0, 15.0),
    "gpt-4o-mini": (0.15, 0.6),
}
OTHER_PRICE = (5.0, 15.0)

# Upper bounds of the latency buckets in seconds.
LATENCY_BOUNDS = (0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 30.0, 60.0)

# Yellow and red limits of the panels.
PANEL_LIMITS = {
    "p95_latency_seconds": (5.0, 15.0),
    "cost_usd_24h": (1.0, 5.0),
    "active_alerts": (5.0, 15.0),
}


def request_cost(
    model: Column,
    tokens_in: Column,
    tokens_out: Column,
    prices: dict[str, tuple[float, float]] | None = None,
    other: tuple[float, float] = OTHER_PRICE,
) -> Column:
    """Cost in USD; the price table is a constant map, so nothing is joined."""
    prices = PRICES if prices is None else prices

    def rate(side: int) -> Column:
        pairs = [F.lit(x) for m, p in prices.items() for x in (m, float(p[side]))]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), model), F.lit(other[side]))

    return (tokens_in * rate(0) + tokens_out * rate(1)) / F.lit(1_000_000.0)


def exact_sum(amount: Column) -> Column:
    """Sum of doubles that does not depend on their order: added as decimals of 18 places.

    Where a value or the sum has no such decimal (not finite, or 1e20 and more), doubles are added.
    """
    exact = amount.try_cast("decimal(38,18)")
    total = F.when(F.count(exact) == F.count(amount), F.try_sum(exact).cast("double"))
    return F.coalesce(total, F.sum(amount))


def exact_mean(amount: Column) -> Column:
    return F.try_divide(exact_sum(amount), F.count(amount))


def usage_summary(metrics: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Per provider over the last hours: count, mean and p95 latency, tokens, cost."""
    recent = metrics.filter(within_last(F.col("queried_at"), as_of, hours))
    totals = recent.groupBy("provider").agg(
        F.count(F.lit(1)).alias("total_queries"),
        exact_mean(F.col("latency_ms")).alias("avg_latency_ms"),
        F.sum("tokens_used").alias("total_tokens"),
        exact_sum(F.col("estimated_cost_usd")).alias("total_cost_usd"),
    )
    p95 = exact_percentiles(recent, ["provider"], "latency_ms", {"p95_latency_ms": 0.95})
    return totals.join(p95, "provider", "left")


def cost_view(metrics: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    return (
        metrics.filter(within_last(F.col("queried_at"), as_of, hours))
        .groupBy("provider")
        .agg(
            F.count(F.lit(1)).alias("query_count"),
            exact_mean(F.col("latency_ms")).alias("avg_latency_ms"),
            F.sum("tokens_used").alias("total_tokens"),
            exact_sum(F.col("estimated_cost_usd")).alias("total_cost_usd"),
        )
    )


def tier_counts(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("risk_tier")
        .agg(F.count(F.lit(1)).alias("patient_count"))
        .orderBy(F.col("patient_count").desc(), "risk_tier")
    )


def summary_document(usage: DataFrame, tiers: DataFrame, pending: DataFrame) -> DataFrame:
    """One row: usage per provider, alerts per tier and the queue length.

    All three inputs are aggregates with a row per provider, per tier and in all.
    """
    lists = [
        usage.agg(F.sort_array(F.collect_list(F.struct("provider", *[c for c in usage.columns if c != "provider"]))).alias("llm_usage_last_24h")),
        tiers.agg(F.sort_array(F.collect_list(F.struct("patient_count", "risk_tier")), asc=False).alias("sepsis_alerts_by_tier")),
        pending.select(F.col("pending").alias("embedding_queue_pending")),
    ]
    return lists[2].select(lists[0].scalar().alias("llm_usage_last_24h"), lists[1].scalar().alias("sepsis_alerts_by_tier"), "embedding_queue_pending")


def _bucket_counts(latency_s: Column, bounds: Sequence[float]) -> list[Column]:
    """Cumulative count per bound, and of everything, in one pass."""
    return [
        F.count_if(latency_s <= F.lit(float(b))).alias(f"_le{i}") for i, b in enumerate(bounds)
    ] + [F.count(latency_s).alias("_all")]


def _bound_label(bound: float | None) -> str:
    return "+Inf" if bound is None else str(float(bound))


def latency_histogram(
    metrics: DataFrame,
    latency_s: Column,
    keys: Sequence[str] = ("provider",),
    bounds: Sequence[float] = LATENCY_BOUNDS,
) -> DataFrame:
    """``(keys, le, cumulative_count)`` with a last bucket ``+Inf``."""
    wide = metrics.groupBy(*keys).agg(*_bucket_counts(latency_s, bounds))
    cells = [
        F.struct(F.lit(_bound_label(b)).alias("le"), F.col(f"_le{i}").alias("cumulative_count"))
        for i, b in enumerate(bounds)
    ] + [F.struct(F.lit(_bound_label(None)).alias("le"), F.col("_all").alias("cumulative_count"))]
    return wide.select(*keys, F.inline(F.array(*cells)))


def bucket_quantile(q: float, counts: Column, total: Column, bounds: Sequence[float]) -> Column:
    """Quantile from cumulative bucket counts, linear inside the bucket of rank q*N.

    The first bucket starts at 0; a rank beyond the last bound gives that bound.
    """
    upper = F.array(*[F.lit(float(b)) for b in bounds])
    rank = F.lit(q) * total
    out = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = F.lit(float(bounds[i - 1])) if i else F.lit(0.0)
        before = counts[i - 1] if i else F.lit(0)
        inside = low + (upper[i] - low) * F.try_divide(rank - before, counts[i] - before)
        out = F.when(counts[i] >= rank, F.coalesce(inside, upper[i])).otherwise(out)
    return F.when(total > 0, out)


def latency_quantiles(
    metrics: DataFrame,
    latency_s: Column,
    quantiles: dict[str, float],
    window: str = "5 minutes",
    bounds: Sequence[float] = LATENCY_BOUNDS,
) -> DataFrame:
    """Bucket quantiles per time window and provider."""
    wide = metrics.groupBy(F.window("queried_at", window)["start"].alias("window_start"), "provider").agg(
        *_bucket_counts(latency_s, bounds)
    )
    counts = F.array(*[F.col(f"_le{i}") for i in range(len(bounds))])
    return wide.withColumn("_counts", counts).select(
        "window_start",
        "provider",
        *[bucket_quantile(q, F.col("_counts"), F.col("_all"), bounds).alias(n) for n, q in quantiles.items()],
    )


def query_rate(metrics: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Queries per second per window and provider."""
    return (
        metrics.groupBy(
            F.window("queried_at", f"{window_seconds} seconds")["start"].alias("window_start"), "provider"
        )
        .agg(F.count(F.lit(1)).alias("queries"))
        .withColumn("per_second", F.col("queries") / F.lit(float(window_seconds)))
    )


def query_counter(metrics: DataFrame) -> DataFrame:
    """Totals per provider; the tier label of the counter is always ``all``."""
    return metrics.groupBy("provider").agg(
        F.lit("all").alias("risk_tier"),
        F.count(F.lit(1)).alias("queries_total"),
        F.sum(F.col("tokens_in") + F.col("tokens_out")).alias("tokens_total"),
        exact_sum(F.col("estimated_cost_usd")).alias("cost_usd_total"),
    )


def token_counter(metrics: DataFrame) -> DataFrame:
    """Tokens per provider and type."""
    sums = metrics.groupBy("provider").agg(F.sum("tokens_in").alias("input"), F.sum("tokens_out").alias("output"))
    return sums.unpivot("provider", ["input", "output"], "token_type", "tokens_total")


def token_rate(metrics: DataFrame, window_seconds: int = 300) -> DataFrame:
    """Tokens per second per window, provider and direction."""
    sums = metrics.groupBy(
        F.window("queried_at", f"{window_seconds} seconds")["start"].alias("window_start"), "provider"
    ).agg(F.sum("tokens_in").alias("_in"), F.sum("tokens_out").alias("_out"))
    cells = F.array(
        F.struct(F.lit("input").alias("token_type"), F.col("_in").alias("tokens")),
        F.struct(F.lit("output").alias("token_type"), F.col("_out").alias("tokens")),
    )
    return sums.select("window_start", "provider", F.inline(cells)).withColumn(
        "per_second", F.col("tokens") / F.lit(float(window_seconds))
    )


def cost_rate(metrics: DataFrame, window_seconds: int = 3600) -> DataFrame:
    """USD per second and per hour, per window and provider."""
    return (
        metrics.groupBy(
            F.window("queried_at", f"{window_seconds} seconds")["start"].alias("window_start"), "provider"
        )
        .agg(exact_sum(F.col("estimated_cost_usd")).alias("cost_usd"))
        .withColumns(
            {
                "usd_per_second": F.col("cost_usd") / F.lit(float(window_seconds)),
                "usd_per_hour": F.col("cost_usd") * F.lit(3600.0 / window_seconds),
            }
        )
    )


def panel_status(value: Column, panel: str) -> Column:
    yellow, red = PANEL_LIMITS[panel]
    return F.when(value >= red, "red").when(value >= yellow, "yellow").otherwise("green")


def panel(df: DataFrame, name: str, label: str, value: str) -> DataFrame:
    """``(panel, label, value, status)`` rows of one panel."""
    v = F.col(value).cast("double")
    return df.select(
        F.lit(name).alias("panel"),
        F.col(label).alias("label"),
        v.alias("value"),
        panel_status(v, name).alias("status"),
    )
