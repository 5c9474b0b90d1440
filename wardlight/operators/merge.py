"""Keyed upsert, insert-if-absent and queue bookkeeping on plain tables.

Each function returns the new content of the table; the caller writes it to a new
path. Updates are reduced to one row per key first, so the joins have no heavy key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUEUE_BATCH = 50


def one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (), last: bool = True) -> DataFrame:
    """The last (or first) row of every key by the ``order`` columns, then by all others.

    The rank is only compared with 1, so Spark keeps one row per key and input task
    before the shuffle. Without ``order`` the choice among repeated keys is the same in
    every run, but it is the row with the greatest (or least) values, not the one given
    last: name an order where keys may repeat.
    """
    by = [*order, *(c for c in rows.columns if c not in keys and c not in order)]
    ranked = [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_first() for c in by]
    first = Window.partitionBy(*keys).orderBy(*(ranked or [F.lit(1)]))
    return rows.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")


def merge_by_key(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys whole; on a known key replace ``update_columns`` only.

    The result has the target's columns. A matched NULL in ``updates`` replaces the
    old value. Rows of the target without an update stay as they are. When ``updates``
    repeats a key, the last of its rows by ``order`` counts, as if applied in turn.
    """
    updates = one_per_key(updates, keys, order)
    rest = [c for c in target.columns if c not in keys]
    replaced = set(rest if update_columns is None else update_columns)
    old = target.select(*keys, F.struct(*rest).alias("_old"))
    new = updates.select(
        *keys, F.struct(*[c for c in rest if c in updates.columns]).alias("_new")
    )
    given = set(updates.columns)

    def value(c: str) -> Column:
        before = F.col("_old")[c]
        if c not in given:
            return before
        after = F.col("_new")[c]
        takes_new = F.col("_old").isNull()
        if c in replaced:
            takes_new = takes_new | F.col("_new").isNotNull()
        return F.when(takes_new, after).otherwise(before)

    return (
        old.join(new, list(keys), "full")
        .select(*keys, *[value(c).alias(c) for c in rest])
        .select(*target.columns)
    )


def insert_absent(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Append the rows whose key the target does not have; change nothing else.

    Of rows that repeat a new key the first by ``order`` is taken.
    """
    rows = one_per_key(rows, keys, order, last=False)
    return target.unionByName(rows.join(target.select(*keys), list(keys), "left_anti"))


def replace_children(
    target: DataFrame, rows: DataFrame, parents: DataFrame, parent_key: str
) -> DataFrame:
    """Drop every row of the given parents, then add ``rows``.

    Unlike an upsert by (parent, position) this leaves no rows behind when a parent
    now has fewer children.
    """
    kept = target.join(parents.select(parent_key).distinct(), parent_key, "left_anti")
    return kept.unionByName(rows)


def pending(queue: DataFrame) -> DataFrame:
    return queue.filter(F.col("embedded_at").isNull())


def pending_count(queue: DataFrame) -> DataFrame:
    return pending(queue).agg(F.count(F.lit(1)).alias("pending"))


def pending_batch(queue: DataFrame, size: int = QUEUE_BATCH) -> DataFrame:
    """The newest pending notes; undated ones come first."""
    return pending(queue).orderBy(F.col("charttime").desc_nulls_first(), "queue_id").limit(size)


def mark_done(queue: DataFrame, done: DataFrame, at: Column) -> DataFrame:
    """Set ``embedded_at`` on the queue rows listed in ``done`` (column queue_id)."""
    hit = done.select("queue_id").distinct().withColumn("_done", F.lit(True))
    return (
        queue.join(hit, "queue_id", "left")
        .withColumn("embedded_at", F.when(F.col("_done"), at).otherwise(F.col("embedded_at")))
        .drop("_done")
    )


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def not_embedded(notes: DataFrame, done: DataFrame, key: str = "note_id") -> DataFrame:
    """Notes whose key and content were not recorded as embedded.

    ``done`` holds ``(key, content_hash)`` for every processed note, also for those
    that gave no chunk, so such notes are not read again.
    """
    hashed = notes.withColumn("content_hash", content_hash(F.col("TEXT")))
    return hashed.join(done.select(key, "content_hash"), [key, "content_hash"], "left_anti")
