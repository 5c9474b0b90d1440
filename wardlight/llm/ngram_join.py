"""N-gram Jaccard join over count vectors, with an R-tree per block and exact verification.

A document is the set of its distinct word shingles (``size`` words; two sets link at a Jaccard
likeness of ``percent`` or more; 3 words and 90 by default). Shingles are hashed into groups, and the
numbers of shingles per group make the document a point. The sum of coordinate minima of two
points bounds their overlap from above; so does the sum of minima with the upper corner of an
R-tree box. Pairs whose bound falls short of the overlap that the threshold needs are left out;
the others are verified on the sets themselves.

To bring points together that may link, the space is tiled. Sizes are cut into bands so that
linked sets lie in one band or in two neighbouring ones. In a band, two linked sets differ in at
most D shingles, so of more than D parts of the coordinates that a set fills at least one is
equal in both. A document goes, for each filled part, to the tile of the points with exactly its
coordinates there (a hash of the part's counts is the tile's key); the rare set that fills no more
than D parts goes to the tiles of its empty parts as well. So no linked pair is missed.

Tiles with the same members count once. In each tile an R-tree finds the pairs whose bound allows
a link; they chain documents to candidate groups. Longer documents have more coordinates there: with
few of them the bound holds for any two long documents, which would chain all of these to one group. A
point that was reached is not looked for again, so a tight cluster is found by its first point. A tile
of many points is cut into blocks, and each pair of blocks is searched.

Each group is then verified on the sets themselves. First every member is compared with the group's
centre (its least node), the members dealt over many tasks; in a group of near copies most of them
link there. Those that do not are the open ones: they are cut into blocks, all members into blocks as
well, and each pair of such blocks is searched with R-trees and verified. Two members that link to the
centre need no comparison, so no connection is lost, and a group of near copies costs little more
than one comparison per member. Only links that connect something are given out. Equal sets are one
point (a class): a task gives out the tiles of a set once, so copies cost little.

Defined cases: A-Z is lower-cased; words are what ASCII white space separates. With fewer
words than a shingle has, the whole sequence is one shingle. NULL, empty and blank texts have the empty set and
link with nothing, each its own component. Rows that share an id are separate rows; a component
takes its least id, NULL ids only where there is no other. An empty table gives an empty result.
Sets are kept as 64-bit shingle hashes. Other columns play no part in the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import cut_lineage, slices, small_batches, texts_of, whole_text
from wardlight.llm.components import components

WORDS = 3
PERCENT = 90
SPARE = 1.3  # parts of a tile space per difference allowed, so that few sets have too few filled parts
GROUPS = 64  # coordinates of the points of short sets, and of those in the search of open members
PER_GROUP = 8  # shingles per coordinate in the points of longer sets, at most
BOX = 16  # children of an R-tree box
MATRIX = 2**19  # coordinates that are compared at once, all points with all, in place of an R-tree
BLOCK_SHINGLES = 500_000  # shingles of a block, about
STAR_ROWS = 1_000  # members of a group that one task compares with its centre, about
BLOCK_BYTES = 4_000_000  # of points of a block, about
TEXT_BYTES = 500_000  # texts whose words are hashed at once, about
LANES = 8  # words of up to so many 8 bytes are hashed together, longer ones one by one
NODES_KEPT = 150_000

_U = np.uint64
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], _U)


def mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> _U(shift))) * _U(factor)
    return x ^ (x >> _U(31))


SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
LANE_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the place of the first word of each text and of the end."""
    data = b"\n".join([*texts, b"\n" * 8]).lower()  # each text ends with white space, and 8 bytes can be read anywhere
    inside = ~SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    lanes = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    left = ends - starts
    found = left.astype(_U) * FACTORS[0]
    at, who = starts, slice(None)
    for _ in range(LANES):
        found[who] = mix(found[who] * FACTORS[1] + (lanes[at] & LANE_MASKS[np.minimum(left[who], 8)]))
        left[who] -= 8
        who = np.flatnonzero(left > 0)
        at = ends[who] - left[who]
    for i in who.tolist():
        found[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return found, np.searchsorted(starts, begins)


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    total = np.full(max(0, len(h) - size + 1), size, _U)
    for i in range(size):
        total = mix(total + h[i : i + len(total)] * FACTORS[i % len(FACTORS)])
    return total


def distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def shingle_sets(texts: list[str], size: int = WORDS) -> list[np.ndarray]:
    """Distinct shingle hashes of whole texts, in order. Words of about TEXT_BYTES are hashed at once."""
    data, sets = [t.encode() for t in texts], []
    blocks = np.cumsum([len(t) for t in data]) // TEXT_BYTES
    for start, end in pairwise([0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(data)]):
        words, firsts = word_hashes(data[start:end])
        runs = shingles(words, size)
        for a, b in pairwise(firsts.tolist()):
            few = b - a < size
            sets.append(distinct(shingles(words[a:b], b - a) if few and b > a else runs[a : max(a, b - size + 1)]))
    return sets


def shingle_set(text: str, size: int = WORDS) -> np.ndarray:
    """Distinct shingle hashes of a whole text, in order."""
    return shingle_sets([text], size)[0]


_STARTS: dict[int, np.ndarray] = {}


def band_starts(percent: int) -> np.ndarray:
    """Band k holds sizes from this on, up to the start of band k + 1.

    A band spans two steps of the threshold, so a set links within its band or, if it is in the
    lower half of it, with the band below.
    """
    if percent not in _STARTS:
        step = (100 / percent) ** 2
        _STARTS[percent] = step ** np.arange(1 + int(44 / np.log(step)))
    return _STARTS[percent]


def tile_keys(h: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the tiles of a set: in its own band and, as the larger one, in the band below."""
    out, starts = [], band_starts(percent)
    own = int(np.searchsorted(starts, len(h), side="right")) - 1
    counted = np.concatenate([np.zeros(1, _U), np.cumsum(mix((h & _U(0xFFFFF)) + _U(1)))])
    below = own > 0 and len(h) * percent <= 100 * starts[own] + 1e-6
    for band in (own, own - 1) if below else (own,):
        differ = int(starts[band + 1] * (100 - percent) / percent + 1e-6)
        if not differ:
            continue  # sets of this band link only when equal
        parts = int(SPARE * differ) + 3
        place = ((h >> _U(32)) * _U(parts)) >> _U(32)
        ends = np.searchsorted(place, np.arange(parts + 1, dtype=_U))
        sums = counted[ends[1:]] - counted[ends[:-1]]
        name = (_U(band) << _U(40)) + np.arange(parts, dtype=_U)
        filled = ends[1:] > ends[:-1]
        if filled.sum() > differ:
            sums, name = sums[filled], name[filled]
        out.append(mix(sums + mix(name)))
    return np.concatenate(out) if out else np.zeros(0, _U)


def set_name(h: np.ndarray) -> np.ndarray:
    return mix(np.array([h.sum(dtype=_U) ^ _U(len(h) * 0x9E3779B1)], _U))


POINTS = "id long, mark long, n long, node long, fine binary"


def points(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, mark, text) to size and name of the set; the mark is passed on."""
    for batch in slices(batches):
        sets = shingle_sets(texts_of(batch["text"]), size)
        names = np.concatenate([set_name(h) for h in sets]).view(np.int64)
        columns = [batch["id"], batch["mark"], pa.array([len(h) for h in sets], pa.int64()), pa.array(names)]
        columns.append(pa.array([packed_counts(h, fine_groups(len(h))) for h in sets], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "n", "node", "fine"])


def tiles(size: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to rows of (tile, node). A set met before in this task is not given out again."""
    seen: set[int] = set()
    for batch in slices(batches):
        keys, nodes = [np.zeros(0, _U)], [np.zeros(0, _U)]
        for h in shingle_sets(texts_of(batch["text"]), size):
            name = int(set_name(h)[0])
            if len(h) and name not in seen:
                if len(seen) >= NODES_KEPT:
                    seen.clear()
                seen.add(name)
                keys.append(tile_keys(h, percent))
                nodes.append(np.full(len(keys[-1]), name, _U))
        flat = {"tile": np.concatenate(keys).view(np.int64), "node": np.concatenate(nodes).view(np.int64)}
        yield pa.RecordBatch.from_pydict(flat)


def shared_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (tile, node), sorted by tile, to the members of tiles with two nodes or more.

    A tile is named by its members, so tiles with the same members become the same.
    """
    t, v = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def members(t: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        v = v[np.lexsort((v, t))]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
        t, v = t[new], v[new]
        begins = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(begins, len(t)))
        name = mix(np.add.reduceat(mix(v.view(_U)), begins) + sizes.astype(_U)) if len(t) else np.zeros(0, _U)
        several = np.repeat(sizes > 1, sizes)
        return pa.RecordBatch.from_pydict({"tile": np.repeat(name, sizes)[several].view(np.int64), "node": v[several]})

    for batch in batches:
        t = np.concatenate([t, batch["tile"].to_numpy()])
        v = np.concatenate([v, batch["node"].to_numpy()])
        if len(t):
            whole = int(np.searchsorted(t, t[-1]))  # the last tile may go on
            yield members(t[:whole], v[:whole])
            t, v = t[whole:], v[whole:]
    yield members(t, v)


def fine_groups(n: int) -> int:
    """A power of two that leaves at most PER_GROUP shingles per group on average."""
    return max(GROUPS, 1 << max(0, -(-n // PER_GROUP) - 1).bit_length())


def packed_counts(h: np.ndarray, groups: int) -> bytes:
    """Counts per group in a byte each, rounded up to a power of two of which the first byte tells."""
    counts = np.bincount((h & _U(groups - 1)).astype(np.int64), minlength=groups)
    power = max(0, int(counts.max()).bit_length() - 8)
    power += int(-(-int(counts.max()) >> power) > 255)
    return bytes([power]) + (-(-counts >> power)).astype(np.uint8).tobytes()


def unpacked_counts(packed: list[bytes]) -> np.ndarray:
    """Points of the least number of groups among them; finer ones are added up to it."""
    groups = min(len(p) for p in packed) - 1
    rows = np.empty((len(packed), groups), np.int32)
    for row, p in zip(rows, packed):
        counts = np.frombuffer(p, np.uint8, offset=1)
        if p[0]:
            counts = counts.astype(np.int32) << p[0]
        row[:] = counts if len(counts) == groups else counts.reshape(-1, groups).sum(0)
    return rows


def summed_minima(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.minimum(one, other).sum(-1, dtype=one.dtype).astype(np.int64)


def bound_edges(nodes: list[int], sizes: list[int], packed: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Edges that connect all nodes of which chains of bounds allow a link.

    Points of each fineness are compared among themselves and with finer ones of sizes that can
    still link, so a short document never makes the points of long ones coarse.
    """
    groups, size, found = np.array([len(p) for p in packed]), np.array(sizes, np.int64), []
    for level in np.unique(groups):
        own = groups == level
        at = np.flatnonzero(own | ((groups > level) & (size * percent <= 100 * size[own].max())))
        found += edges_at_level(*([x[i] for i in at] for x in (nodes, sizes, packed)), percent)
    return found


def edges_at_level(nodes: list[int], sizes: list[int], packed: list[bytes], percent: int) -> list[tuple[int, int]]:
    """As ``bound_edges``, with all points brought to the coarsest fineness among them."""
    if len(nodes) < 2:
        return []
    vectors, size = unpacked_counts(packed), np.array(sizes, np.int64)
    if len(nodes) == 2:
        bound, (x, y) = int(np.minimum(vectors[0], vectors[1]).sum()), sorted(sizes)
        fits = bound * (100 + percent) >= percent * (x + y) and x * 100 >= y * percent
        return [(nodes[0], nodes[1])] if fits else []
    return [(nodes[i], nodes[j]) for i, j in spanning(vectors, size, percent)]


def spanning(vectors: np.ndarray, sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs that connect all points which chains of bounds connect. A point that was reached is not sought again."""
    if len(sizes) ** 2 * vectors.shape[1] <= MATRIX:
        return spanning_few(vectors, sizes, percent)
    open_, left, found = np.ones(len(sizes), bool), len(sizes), []
    tree, held = CountTree(vectors, sizes), np.arange(len(sizes))
    for start in range(len(sizes)):
        todo = [start] if open_[start] else []
        left -= len(todo)
        open_[todo] = False
        while todo and left:
            i = todo.pop()
            if 2 * left <= len(held):  # those reached leave the tree
                held = np.flatnonzero(open_)
                tree = CountTree(vectors[held], sizes[held])
            near = held[tree.near(vectors[i], int(sizes[i]), percent)]
            near = near[open_[near]]
            open_[near] = False
            left -= len(near)
            todo += near.tolist()
            found += [(i, j) for j in near.tolist()]
    return found


def spanning_few(vectors: np.ndarray, sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """As ``spanning``, by the bounds of all pairs."""
    fits = summed_minima(vectors[:, None], vectors) * (100 + percent) >= percent * (sizes[:, None] + sizes)
    fits &= (sizes[:, None] * percent <= sizes * 100) & (sizes * percent <= sizes[:, None] * 100)
    np.fill_diagonal(fits, False)
    if not fits.any():
        return []
    near, open_, found = [np.flatnonzero(row).tolist() for row in fits], [True] * len(sizes), []
    for start in range(len(sizes)):
        todo = [start] if open_[start] else []
        open_[start] = False
        while todo:
            i = todo.pop()
            for j in near[i]:
                if open_[j]:
                    open_[j] = False
                    todo.append(j)
                    found.append((i, j))
    return found


def links_by_bound(keys: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (``keys`` key columns, node, n, points), sorted by key, to edges within each key."""
    key, rows = None, []

    def edges() -> list[tuple[int, int]]:
        return bound_edges(*zip(*rows), percent) if rows else []

    for batch in batches:
        out = []
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[:keys] != key:
                out += edges()
                key, rows = row[:keys], []
            rows.append(row[keys:])
        yield as_edges(out)
    yield as_edges(edges())


def as_edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    return pa.RecordBatch.from_pydict({"a": a, "b": b})


class CountTree:
    """A packed R-tree over count vectors: boxes of BOX, levels from the leaves up."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        half = vectors[:, : vectors.shape[1] // 2].sum(1)
        self.order = np.lexsort((half, sizes))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        self.levels = [(self.vectors, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > BOX:
            upper, least, most = self.levels[-1]
            starts = np.arange(0, len(upper), BOX)
            self.levels.append(
                (np.maximum.reduceat(upper, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts))
            )

    def near(self, vector: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Places of the points whose bound allows the threshold."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, least, most = (x[at] for x in self.levels[depth])
            bound = summed_minima(upper, vector)
            # intersection >= percent / (100 + percent) of both sizes, and sizes within percent
            keep = bound * (100 + percent) >= percent * (size + least)
            keep &= (least * percent <= size * 100) & (most * 100 >= size * percent)
            at = at[keep]
            if depth:
                at = (at[:, None] * BOX + np.arange(BOX)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def counts_of(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([np.bincount((h & _U(GROUPS - 1)).astype(np.int64), minlength=GROUPS) for h in sets]).reshape(-1, GROUPS)


def join_blocks(one: list[np.ndarray], other: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (i, j) between ``one`` and ``other`` that connect all sets which chains of such links connect."""
    sides = [one, other]
    vectors = [counts_of(sets) for sets in sides]
    sizes = [np.array([len(h) for h in sets], np.int64) for sets in sides]
    trees = [CountTree(v, n) for v, n in zip(vectors, sizes)]
    open_ = [np.ones(len(sets), bool) for sets in sides]
    links = []
    for start in range(len(one)):
        todo = [(0, start)] if open_[0][start] else []
        open_[0][start] = False
        while todo:
            side, i = todo.pop()
            across, h = 1 - side, sides[side][i]
            if not open_[across].any():
                continue
            near = trees[across].near(vectors[side][i], len(h), percent)
            for j in near[open_[across][near]].tolist():
                if linked(h, sides[across][j], percent):
                    open_[across][j] = False
                    todo.append((across, j))
                    links.append((j, i) if side else (i, j))
    return links


def star(size: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (grp, node, n, text) with the centre of each group first to (grp, node, n, near).

    ``near`` tells whether a member links to the centre. A row whose text has another set than its
    node is passed over.
    """
    grp, centre = None, np.zeros(0, _U)
    for batch in slices(batches):
        out = []
        sets = shingle_sets(texts_of(batch["text"]), size)
        for g, node, n, h in zip(*(batch[c].to_pylist() for c in ("grp", "node", "n")), sets):
            if int(set_name(h).view(np.int64)[0]) != node:
                continue
            if node == g:
                grp, centre = g, h
            out.append((g, node, n, g == grp and linked(centre, h, percent)))
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["grp", "node", "n", "near"])


def search(size: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (grp, low, high, side, node, text), sorted, to links between the open members and all.

    Texts are shuffled as they are, as they compress and hashes do not. A row whose text has another
    set than its node is passed over.
    """
    key, members = None, []

    def answer() -> pa.RecordBatch:
        one, two = ([m for m in members if m[0] == side] for side in (0, 1))
        found = join_blocks([m[2] for m in one], [m[2] for m in two], percent) if one and two else []
        return as_edges([(one[i][1], two[j][1]) for i, j in found])

    for batch in slices(batches):
        sets = shingle_sets(texts_of(batch["text"]), size)
        for grp, low, high, side, node, h in zip(*(batch[c].to_pylist() for c in ("grp", "low", "high", "side", "node")), sets):
            if (grp, low, high) != key:
                if members:
                    yield answer()
                key, members = (grp, low, high), []
            if int(set_name(h).view(np.int64)[0]) == node:
                members.append((side, node, h))
    if members:
        yield answer()


def in_blocks(tiles: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of tiles (``grp``) with size, point, block and number of blocks, of about BLOCK_BYTES each."""
    points = classes.select("node", "n", "fine", F.octet_length("fine").alias("bytes"))
    large = (  # a row for each BLOCK_BYTES of points at most
        tiles.join(points.select("node", "bytes"), "node")
        .groupBy("grp")
        .agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
        .filter("blocks > 1")
    )
    blocks = F.coalesce("blocks", F.lit(1))
    return (
        tiles.join(points.drop("bytes"), "node")
        .join(F.broadcast(large), "grp", "left")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )


def by_blocks(members: DataFrame) -> DataFrame:
    """Every member goes to each pair of blocks of its tile that its own block is in."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (
        members.select("*", other)
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .repartition("grp", "low", "high")
        .sortWithinPartitions("grp", "low", "high", "block", "node")
    )


def verified(
    groups: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, size: int, percent: int
) -> DataFrame:
    """Links (a, b) that connect what linked sets of each candidate group (node, grp) connect.

    A group's centre is the member with the node ``grp``, which every group has.
    """
    members = groups.join(classes.select("node", "n", "least"), "node")
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.xxhash64(whole_text()).alias("__mark"), whole_text().alias("text"))
    same_row = F.col("__id").eqNullSafe(F.col("least.id")) & (F.col("__mark") == F.col("least.mark"))
    asked = (  # equal rows give one text
        texts.join(members, same_row).select("grp", "node", "n", "text").dropDuplicates(["grp", "node"])
    )
    parts = members.groupBy("grp").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("parts"))
    is_centre = F.col("node") == F.col("grp")
    part = F.when(is_centre, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    )
    spread = (
        asked.join(parts, "grp")
        .withColumn("part", F.explode(part))
        .repartition("grp", "part")
        .sortWithinPartitions("grp", "part", ~is_centre)
        .select("grp", "node", "n", "text")
    )
    starred = cut_lineage(spread.mapInArrow(partial(star, size, percent), "grp long, node long, n long, near boolean"))
    rest = starred.filter(~F.col("near")).select("grp", "node", "n")
    shingles = lambda df, name: df.groupBy("grp").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias(name))
    blocks = shingles(rest, "lows").join(shingles(members, "highs"), "grp")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    within = asked.join(blocks, "grp")
    every = within.select("grp", each("lows").alias("low"), block("highs").alias("high"), F.lit(1).alias("side"), "node", "text")
    opened = within.join(rest.select("grp", "node"), ["grp", "node"]).select(
        "grp", block("lows").alias("low"), each("highs").alias("high"), F.lit(0).alias("side"), "node", "text"
    )
    paired = opened.union(every).repartition("grp", "low", "high").sortWithinPartitions("grp", "low", "high", "side", "node")
    crossed = paired.mapInArrow(partial(search, size, percent), "a long, b long")
    return starred.filter("near").select(F.col("grp").alias("a"), F.col("node").alias("b")).union(crossed)


def classes_with_components(
    rows: DataFrame, docs: DataFrame, id_col: str, size: int, percent: int
) -> DataFrame:
    """Per class of equal sets: ``node``, ``root`` of its component and ``component_id``."""
    classes = cut_lineage(
        rows.filter("n > 0")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("least"),
            F.first("n").alias("n"),
            F.first("fine").alias("fine"),
        )
    )
    placed = docs.select(whole_text().alias("text")).mapInArrow(partial(tiles, size, percent), "tile long, node long")
    shared = cut_lineage(
        placed.repartition("tile")
        .sortWithinPartitions("tile")  # by one number, which Spark sorts by its digits
        .mapInArrow(shared_tiles, "tile long, node long")
        .distinct()
        .withColumnRenamed("tile", "grp")
    )
    sought = by_blocks(in_blocks(shared, classes)).select("grp", "low", "high", "node", "n", "fine")
    edges = sought.mapInArrow(partial(links_by_bound, 3, percent), "a long, b long")
    links = verified(cut_lineage(components(edges).withColumnRenamed("root", "grp")), classes, docs, id_col, size, percent)
    found = components(links).withColumnRenamed("node", "__node")
    rooted = classes.join(found, F.col("node") == F.col("__node"), "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least.id").alias("component_id"))
    return cut_lineage(rooted.join(least, "root").select("node", "root", "component_id"))


def marked(docs: DataFrame, id_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    text = whole_text()
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def join_documents(
    docs: DataFrame, id_col: str = "doc_id", size: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row: ``id``, ``n_shingles`` and ``component_id``, the least id that links reach."""
    rows = cut_lineage(marked(docs, id_col).mapInArrow(partial(points, size), POINTS))
    found = classes_with_components(rows, docs, id_col, size, percent)
    some = rows.filter("n > 0").select("id", "n", "node").join(found, "node")
    none = rows.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.select("id", "n", "component_id").union(none).withColumnRenamed("n", "n_shingles")


def keep_first(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component stays, the one with the least id; all columns are kept.

    Of rows with equal id and text one stays. Documents without words all stay, but for such rows.
    """
    rows = cut_lineage(marked(docs, "doc_id").mapInArrow(partial(points, size), POINTS))
    found = classes_with_components(rows, docs, "doc_id", size, percent).select("node", "root")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("r")
    some = rows.filter("n > 0").join(found, "node").groupBy("root").agg(least).select("r.id", "r.mark")
    none = rows.filter("n = 0").select("id", "mark")
    key = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), "mark")
    keep = cut_lineage(some.union(none).select(key.alias("__key")))
    own = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")), F.xxhash64(whole_text()))
    return docs.withColumn("__key", own).join(keep, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
