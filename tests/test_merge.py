"""Keyed upsert, insert-if-absent, queue and incremental selection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wardlight.operators import merge


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_replaces_listed_columns_and_inserts_whole_rows(spark):
    target = spark.createDataFrame([(1, "a", 10, "x"), (2, "b", 20, "y")], "id int, v string, n int, made string")
    updates = spark.createDataFrame([(2, None, 21, "new"), (3, "c", 30, "new")], "id int, v string, n int, made string")
    got = merge.merge_by_key(target, updates, ["id"], ["v", "n"])
    assert rows(got) == [(1, "a", 10, "x"), (2, None, 21, "y"), (3, "c", 30, "new")]
    assert got.columns == target.columns


def test_merge_twice_changes_nothing_more(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "h int, i int, v string")
    updates = spark.createDataFrame([(1, 2, "B"), (2, 1, "C")], "h int, i int, v string")
    once = merge.merge_by_key(target, updates, ["h", "i"])
    assert rows(merge.merge_by_key(once, updates, ["h", "i"])) == rows(once) == [(1, 1, "a"), (1, 2, "B"), (2, 1, "C")]


def test_merge_into_empty_and_with_missing_columns(spark):
    target = spark.createDataFrame([], "id int, v string, extra string")
    updates = spark.createDataFrame([(1, "a")], "id int, v string")
    assert rows(merge.merge_by_key(target, updates, ["id"])) == [(1, "a", None)]


def test_insert_absent_keeps_the_first(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "new")], "id int, v string")
    assert rows(merge.insert_absent(target, new, ["id"])) == [(1, "old"), (2, "new")]


def test_replace_children_leaves_no_tail(spark):
    target = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (2, 0), (3, 0)], "note_id int, chunk_index int")
    fresh = spark.createDataFrame([(1, 0)], "note_id int, chunk_index int")
    parents = spark.createDataFrame([(1,), (3,)], "note_id int")
    assert rows(merge.replace_children(target, fresh, parents, "note_id")) == [(1, 0), (2, 0)]


def queue(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    return spark.createDataFrame(
        [(1, day(1), None), (2, None, None), (3, day(3), None), (4, day(3), day(9)), (5, day(3), None)],
        "queue_id int, charttime timestamp, embedded_at timestamp",
    )


def test_pending_batch_order(spark):
    assert [r.queue_id for r in merge.pending_batch(queue(spark), 3).collect()] == [2, 3, 5]
    assert merge.pending_count(queue(spark)).first().pending == 4


def test_mark_done(spark):
    done = spark.createDataFrame([(1,), (1,), (3,)], "queue_id int")
    now = F.lit(dt.datetime(2024, 2, 1))
    got = merge.mark_done(queue(spark), done, now)
    assert {r.queue_id for r in merge.pending(got).collect()} == {2, 5}
    assert got.count() == 5
    assert got.filter("queue_id = 4").first().embedded_at == dt.datetime(2024, 1, 9)


def test_not_embedded_sees_new_and_changed_notes(spark):
    notes = spark.createDataFrame([(1, "same"), (2, "new text"), (3, "never seen")], "note_id int, TEXT string")
    done = spark.createDataFrame([(1, "same"), (2, "old text")], "note_id int, t string").select(
        "note_id", merge.content_hash(F.col("t")).alias("content_hash")
    )
    assert {r.note_id for r in merge.not_embedded(notes, done).collect()} == {2, 3}


def test_repeated_keys_in_updates(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k int, v string, at int")
    rows = spark.createDataFrame([(1, "y", 2), (1, "z", 1), (2, "b", 1), (2, "c", 2)], "k int, v string, at int")
    merged = merge.merge_by_key(target, rows, ["k"], order=["at"])
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "y", 2), (2, "c", 2)]
    added = merge.insert_absent(target, rows, ["k"], order=["at"])
    assert sorted(tuple(r) for r in added.collect()) == [(1, "a", 0), (2, "b", 1)]
