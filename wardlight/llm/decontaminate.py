"""Benchmark decontamination: Wu-Manber search for the word windows of test items.

A text is lower-cased (A-Z only) and cut into words. The windows of an item are its runs of ``size``
consecutive words; an item of fewer words, but not none, is one window. A document's words inside
any occurrence of a window are hit.

The symbols of the search are words. For the windows of one range of lengths, the shift table tells
for each block of two words how far the end of a window may lie behind it; blocks that no window
holds, and words that no item holds, let the search pass over nearly a whole window at once. Where
the shift is 0, the last four words select a bucket of windows, and each of these is compared with
the document word by word (as packed word numbers). Equal windows of several items are one window.

The items are cut into pieces of at most ``PIECE`` windows and dealt by hash into blocks of about
``BLOCK_WINDOWS`` windows; a worker holds the tables of one block at a time, and only blocks, which
are bounded, go through the driver. Documents are read once per block. Nothing is shuffled with one
block; with more, the hits of further blocks are joined to their texts by digest.

Defined cases: NULL and empty texts have no words, as documents and as items. Repeated documents
give equal rows; repeated item rows count once, and an item_id with several texts has the windows of
all of them. Windows of items without an id hit words but name no item. Other columns of the
documents stay as they are; those named as an output are replaced. Empty tables give no rows, or no
hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import cut_lineage, each_text, small_batches, whole_text

SIZE = 10
PIECE = 2_048
BLOCK_WINDOWS = 500_000
#: Words of a block of the shift table, and of the suffix that selects a bucket.
BLOCK, SUFFIX = 2, 4
MIX = 0x9E3779B1
OUTPUTS = ("n_words", "spans", "items")
FOUND = "struct<n_words: long, spans: array<struct<first: long, last: long>>, items: array<string>>"

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_AS_WORDS = bytes(b if b in _WORD_BYTES else ord(" ") for b in bytes(range(256)).lower())


def words_of(text: str) -> list[bytes]:
    """Lower-cased words in UTF-8; all bytes of other characters than ASCII belong to words."""
    return text.encode("utf-8", "surrogatepass").translate(_AS_WORDS).split()


def _length_class(words: int, size: int) -> int:
    """Least length among the windows that are searched together."""
    return size if words == size else 1 << (words.bit_length() - 1)


def _folded(ids: np.ndarray, columns: range, mask: int) -> np.ndarray:
    key = np.zeros(len(ids), np.uint64)
    for j in columns:
        key = key * np.uint64(MIX) + ids[:, j].astype(np.uint64)
    return (key & np.uint64(mask)).astype(np.int64)


class _Class:
    """Shift table and buckets for windows of at least ``least`` and below twice as many words."""

    def __init__(self, least: int, windows: np.ndarray, lengths: np.ndarray, items: np.ndarray):
        whole = np.ascontiguousarray(np.column_stack([windows, lengths]).astype(np.int32))
        rows, each = np.unique(whole.view(f"V{whole.shape[1] * 4}").ravel(), return_inverse=True)
        rows = rows.view(np.int32).reshape(len(rows), -1)
        named = np.unique(np.column_stack([each.ravel(), items]), axis=0)  # a window's items, each once
        self.least, self.block, self.suffix = least, min(BLOCK, least), min(SUFFIX, least)
        self.lengths = rows[:, -1].tolist()
        self.words = [r[: 4 * n] for r, n in zip(map(bytes, rows), self.lengths)]
        self.items = named[:, 1].astype(np.int32)
        self.item_starts = np.searchsorted(named[:, 0], np.arange(len(rows) + 1)).tolist()
        self.mask = (1 << (len(rows).bit_length() + 4)) - 1
        shift = np.full(self.mask + 1, least - self.block + 1, np.uint8 if least < 255 else np.int32)
        for j in range(least - self.block + 1):  # later blocks have smaller shifts and come last
            shift[_folded(rows, range(j, j + self.block), self.mask)] = least - self.block - j
        key = _folded(rows, range(least - self.suffix, least), self.mask)
        self.order = np.argsort(key, kind="stable").astype(np.int32)
        self.shift = shift
        self.buckets = np.searchsorted(key[self.order], np.arange(self.mask + 2)).astype(np.int32)

    def search(self, ids: list[int], packed: bytes) -> Iterator[tuple[int, int]]:
        """Start and number of every window that occurs; 0 is a word of no item."""
        least, mask, pairs = self.least, self.mask, self.block > 1
        shifts, buckets = memoryview(self.shift), memoryview(self.buckets)  # read fastest from Python
        i, n = least - 1, len(ids)
        while i < n:
            word = ids[i]
            if not word:
                i += least
                continue
            step = shifts[(ids[i - 1] * MIX + word) & mask if pairs else word & mask]
            if step:
                i += step
                continue
            key, start = 0, i - least + 1
            for word in ids[i - self.suffix + 1 : i + 1]:
                key = key * MIX + word
            key &= mask
            for w in self.order[buckets[key] : buckets[key + 1]].tolist():
                if packed[4 * start : 4 * (start + self.lengths[w])] == self.words[w]:
                    yield start, w
            i += 1


class Block:
    """Search tables of the windows of some pieces of items."""

    def __init__(self, pieces: list[tuple[str | None, bytes]], size: int):
        self.names = sorted({name for name, _ in pieces if name is not None})
        number = {name: i for i, name in enumerate(self.names)} | {None: -1}
        self.vocabulary: dict[bytes, int] = {}
        classes: dict[int, list] = {}
        for name, piece in pieces:
            words = piece.split()
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
            ids = np.array([self.vocabulary[w] for w in words], np.int32)
            n = min(size, len(ids))
            least = _length_class(n, size)
            wide = size if least == size else min(2 * least - 1, size)
            rows = np.lib.stride_tricks.sliding_window_view(ids, n)
            padded = np.pad(rows, ((0, 0), (0, wide - n)))
            classes.setdefault(least, []).append((padded, np.full(len(rows), n), np.full(len(rows), number[name])))
        self.classes = [_Class(least, *map(np.concatenate, zip(*parts))) for least, parts in sorted(classes.items())]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Runs of hit words (first, last) and the ids of the items whose windows occur."""
        ids = list(map(self.vocabulary.get, words, repeat(0)))
        packed, hit, items = np.array(ids, np.int32).tobytes(), bytearray(len(ids)), set()
        for c in self.classes:
            seen = set()
            for start, w in c.search(ids, packed):
                hit[start : start + c.lengths[w]] = b"\1" * c.lengths[w]
                seen.add(w)
            for w in seen:
                items.update(c.items[c.item_starts[w] : c.item_starts[w + 1]].tolist())
        return _runs(hit) if items else [], [self.names[i] for i in sorted(items) if i >= 0]


def _runs(hit: bytearray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + hit + b"\0", np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def pieces_of(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``(item_id, piece, n_windows)``: the words of items, in pieces of at most ``PIECE`` windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch["item_id"].to_pylist(), each_text(batch["text"])):
                words = words_of(text)
                starts = range(0, max(1, len(words) - size + 1), PIECE) if words else ()
                parts = [words[i : i + PIECE + size - 1] for i in starts]
                windows = [max(1, len(p) - size + 1) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(parts), pa.string()),
                        pa.array([b" ".join(p) for p in parts], pa.binary()),
                        pa.array(windows, pa.int64()),
                    ],
                    ["item_id", "piece", "n_windows"],
                )

    small_batches(benchmark.sparkSession)
    rows = benchmark.select(F.col("item_id").cast("string"), whole_text().alias("text"))
    return rows.mapInArrow(cut, "item_id string, piece binary, n_windows long").distinct()


def scan(text: Column, block: Broadcast) -> Column:
    """Words, hit runs and items of a text, for the windows of one block."""

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = block.value
        for texts in batches:
            counts, spans, items = [], [], []
            for t in each_text(texts):
                words = words_of(t)
                runs, names = tables.search(words)
                counts.append(len(words))
                spans.append([{"first": a, "last": b} for a, b in runs])
                items.append(names)
            span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            columns = [pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))]
            yield pa.StructArray.from_arrays(columns, ["n_words", "spans", "items"])

    return found(text)


def joined_runs(lists: Column) -> Column:
    """Runs of several blocks, those that meet or overlap as one."""

    @F.arrow_udf("array<struct<first: long, last: long>>")
    def joined(lists: pa.Array) -> pa.Array:
        out = []
        for runs in lists.to_pylist():
            kept: list[dict] = []
            for r in sorted(runs or (), key=lambda r: (r["first"], r["last"])):
                if kept and r["first"] <= kept[-1]["last"] + 1:
                    kept[-1]["last"] = max(kept[-1]["last"], r["last"])
                else:
                    kept.append(dict(r))
            out.append(kept)
        return pa.array(out, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))

    return joined(lists)


def blocks_of(benchmark: DataFrame, size: int = SIZE, block_windows: int = BLOCK_WINDOWS) -> list[Broadcast]:
    """Search tables of all items, in blocks of about so many windows; at least one block."""
    spark = benchmark.sparkSession
    pieces = cut_lineage(pieces_of(benchmark, size))
    windows = pieces.agg(F.sum("n_windows")).first()[0] or 0
    n = max(1, -(-windows // block_windows))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "piece"), F.lit(n)))
    out = []
    for i in range(n):
        rows = dealt.filter(F.col("block") == i).select("item_id", "piece").toArrow()  # about block_windows windows
        block = Block(list(zip(rows["item_id"].to_pylist(), rows["piece"].to_pylist())), size)
        out.append(spark.sparkContext.broadcast(block))
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """All rows and columns of ``docs`` with n_words, spans (runs of hit words: first, last) and items."""
    small_batches(docs.sparkSession)
    blocks = blocks_of(benchmark, size, block_windows)
    kept = [c for c in docs.columns if c.lower() not in OUTPUTS]
    found = docs.select(*kept, scan(whole_text(), blocks[0]).alias("__found"))
    if len(blocks) > 1:
        digest = F.sha2(F.encode(whole_text(), "UTF-8"), 256)
        hits = None
        for block in blocks[1:]:
            one = docs.select(digest.alias("__text"), scan(whole_text(), block).alias("f"))
            one = one.filter(F.size("f.spans") > 0).groupBy("__text").agg(F.first("f").alias("f"))
            hits = one if hits is None else hits.unionByName(one)
        more = hits.groupBy("__text").agg(  # a row per block at most
            F.flatten(F.collect_list("f.spans")).alias("__spans"), F.flatten(F.collect_list("f.items")).alias("__items")
        )
        joined = found.withColumn("__text", digest).join(more, "__text", "left")
        spans = F.concat("__found.spans", F.coalesce("__spans", F.array()))
        items = F.array_distinct(F.concat("__found.items", F.coalesce("__items", F.array())))
        return joined.select(
            *kept, F.col("__found.n_words").alias("n_words"), joined_runs(spans).alias("spans"), items.alias("items")
        )
    return found.select(*kept, *(F.col(f"__found.{c}").alias(c) for c in OUTPUTS))


def hit_words(spans: Column) -> Column:
    """How many words lie in runs."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Documents without any window of an item, with their own columns."""
    marked = contamination(docs.select(F.struct("*").alias("__row"), whole_text().alias("text")), benchmark, size)
    return marked.filter(F.size("spans") == 0).select("__row.*")
