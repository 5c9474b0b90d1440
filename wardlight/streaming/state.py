"""Streams that keep state per key: trailing windows and latest versions."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wardlight.operators.cleaning import MIN_NOTE_CHARS, not_flagged, valid_vitals

LOOK_BACK = 24  # hours of a window
BLOCK = 168  # window ends that one state holds
WINDOW_KEYS = ("ICUSTAY_ID", "vital_name", "window_end")
# Parts of a version group that keep a state each, so that one group is not one task.
VERSION_PARTS = 16

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, as state per key requires."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class TrailingWorst(StatefulProcessor):
    """Hourly sums of one stay, vital and week of window ends; gives out the windows that change.

    The state holds a total and a count per clock hour, 191 hours at most. A batch of readings is
    added up per hour, and a window is given out when its least hourly mean is new or another one.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.hours = handle.getValueState("hours", "at array<int>, totals array<double>, counts array<bigint>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        stay, vital, block = key
        first = block * BLOCK - LOOK_BACK  # the first hour that a window of this block looks at
        totals, counts = np.zeros(BLOCK + LOOK_BACK - 1), np.zeros(BLOCK + LOOK_BACK - 1, np.int64)
        if self.hours.exists():
            at, known_totals, known_counts = self.hours.get()
            totals[at], counts[at] = known_totals, known_counts
        before = _least_means(totals, counts)
        for frame in rows:
            place = frame["hour"].to_numpy() - first
            np.add.at(totals, place, frame["value"].to_numpy())
            np.add.at(counts, place, 1)
        held = np.flatnonzero(counts)
        self.hours.update((held.tolist(), totals[held].tolist(), counts[held].tolist()))
        worst = _least_means(totals, counts)
        changed = np.flatnonzero((worst != before) & np.isfinite(worst))
        yield pd.DataFrame(
            {
                "ICUSTAY_ID": [stay] * len(changed),
                "vital_name": pd.Series([vital] * len(changed), dtype=object),
                "end_hour": block * BLOCK + changed,
                "worst": worst[changed],
            }
        )

    def close(self) -> None:
        pass


def _least_means(totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Least hourly mean per window, infinite for windows without a reading."""
    means = np.divide(totals, counts, out=np.full(len(totals), np.inf), where=counts > 0)
    return np.lib.stride_tricks.sliding_window_view(means, LOOK_BACK).min(axis=1)


def trailing_worst_changes(chart: DataFrame) -> DataFrame:
    """A stream of ``(ICUSTAY_ID, vital_name, window_end, worst)``: each window as often as it changes.

    A reading belongs to the 24 windows that end in the hours after it, so to one or two weeks of
    window ends. A long stay is one state per week, and its weeks are worked on side by side.
    """
    hour = F.floor(F.unix_micros(F.col("CHARTTIME").cast("timestamp")) / F.lit(3_600_000_000))
    readings = (
        valid_vitals(chart)
        .filter(F.col("CHARTTIME").isNotNull() & ~F.isnan("VALUENUM"))
        .withColumn("hour", hour)
        .select(
            "ICUSTAY_ID",
            "vital_name",
            F.explode(
                F.array_distinct(F.array(*(F.floor((F.col("hour") + n) / BLOCK) for n in (1, LOOK_BACK))))
            ).alias("block"),
            "hour",
            F.col("VALUENUM").cast("double").alias("value"),
        )
    )
    out = T.StructType(
        [
            T.StructField("ICUSTAY_ID", chart.schema["ICUSTAY_ID"].dataType),
            T.StructField("vital_name", T.StringType()),
            T.StructField("end_hour", T.LongType()),
            T.StructField("worst", T.DoubleType()),
        ]
    )
    changes = readings.groupBy("ICUSTAY_ID", "vital_name", "block").transformWithStateInPandas(
        TrailingWorst(), out, "Update", "None"
    )
    end = F.timestamp_seconds(F.col("end_hour") * 3600)
    return changes.select("ICUSTAY_ID", "vital_name", end.alias("window_end"), "worst")


class LatestVersion(StatefulProcessor):
    """The greatest ``_order`` of a group so far; a row is given out when it is the latest of its batch and all before."""

    def __init__(self, order: str):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", self.order)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        best, place = None, tuple(self.latest.get()) if self.latest.exists() else None
        for row in rows:
            stored, tie = row["_stored"], row["_tie"]
            # latest store time first, none last; then the least tie-break, none last
            if place is None or _comes_before((stored, tie), place):
                best, place = row, (stored, tie)
        if best is not None:
            self.latest.update(place)
            yield best

    def close(self) -> None:
        pass


def _comes_before(a: tuple, b: tuple) -> bool:
    if a[0] != b[0]:
        return a[0] is not None and (b[0] is None or a[0] > b[0])
    return a[1] is not None and (b[1] is None or a[1] < b[1])


def latest_version_changes(notes: DataFrame, tie_break: str) -> DataFrame:
    """A stream of notes, each given out when it is the latest version so far of its group's part.

    The state is the store time and tie-break of the latest version, so no batch reads an earlier
    one. A group with very many versions has several parts, each with a latest version of its own;
    the latest of these is the group's.
    """
    usable = notes.filter(not_flagged(F.col("ISERROR")) & (F.length("TEXT") > MIN_NOTE_CHARS))
    tie = T.StructType([T.StructField("_stored", T.LongType()), T.StructField("_tie", notes.schema[tie_break].dataType)])
    keyed = usable.select(
        "*",
        F.unix_micros(F.col("STORETIME").cast("timestamp")).alias("_stored"),
        F.col(tie_break).alias("_tie"),
        F.pmod(F.xxhash64(tie_break), F.lit(VERSION_PARTS)).cast("int").alias("_part"),
    )
    group = ("SUBJECT_ID", "HADM_ID", "CATEGORY", "CHARTTIME", "_part")
    changes = keyed.groupBy(*group).transformWithState(
        LatestVersion(tie.simpleString()[len("struct<") : -1].replace(":", " ")), keyed.schema, "Update", "None"
    )
    return changes.select(*notes.columns)


def started(spark: SparkSession, start: Callable[[], Any]) -> None:
    """Start a query with its state on disk and wait for its end."""
    with state_on_disk(spark):
        query = start()
    query.awaitTermination()
