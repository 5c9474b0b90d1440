"""Secret scan: pattern findings, and a character network over every other candidate.

Three patterns give the base findings (assignments, access keys, long hex runs). Candidates are
the values of base findings, labelled positive, and every run of ``LEAST`` or more key characters
outside base findings, labelled negative. A convolutional network in numpy reads each candidate
with its surroundings: characters become vectors, filters of width 5 run over them; the maxima and
means over the value and the maxima over the text before and after go through one hidden layer. In
half of the training rows the surroundings are those of some negative, so that a value counts by
its own characters and not only by a key word before it. Its scores are calibrated (logistic, on
candidates of other texts, in both surroundings), and the threshold is the largest that keeps the
wanted recall on the positives held out, each by the lower of its two scores. A candidate
outside all base findings that reaches it becomes a span of kind ``model``.

Training uses a bounded sample (``SAMPLE`` candidates of each label by hash order, on the
driver) and the first ``VALUE`` characters of a value. The threshold comes from all positives of the
texts held out, whole values, by a histogram of their scores in steps of ``STEP`` of the logit, so
at most one step below the exact place. Finding and scoring cover all texts and candidates. Filters run once over a text, not
once per candidate. A value longer than ``VALUE`` is scored in pieces and the largest score counts.

Defined cases: NULL counts as empty; a text without findings has counts 0 and an empty span list.
Repeated rows get equal results. With no positives or no negatives in either part of the sample
there is no network and only base spans are given. An empty table gives an empty result. Other
columns are not passed on.

Texts are read once for the sample and once for the result, those held out once more for the
threshold; only the sample is stored in between.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm.common import ROWS_PER_SLICE, cut_lineage, small_batches, texts_of, whole_text

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of hex digits is matched whole
KEY = re.compile(r"[A-Za-z0-9+/_=-]")

LEAST = 6  # key characters of a candidate
SAMPLE = 3_000  # candidates per label for training and calibration together
BUCKETS = 64  # in which the samples of all tasks are reduced first
RECALL = 0.98
BEFORE, VALUE, AFTER = 24, 48, 8  # characters read before, in a piece of, and after a value
CODES, DIM, REACH, FILTERS, HIDDEN = 98, 12, 5, 24, 16
GAP = BEFORE + REACH  # empty places around a text
STEP, LIMIT = 0.01, 30.0  # of calibrated logits
CHUNK = 16_384  # characters whose filters are held at once

FOUND = pa.struct(
    [(c, pa.int64()) for c in ("n_assign", "n_access", "n_hex")] + [(c, pa.string()) for c in ("base", "spans")]
)
FOUND_SQL = "struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base: string, spans: string>"
SAMPLED = "label int, fold int, place long, before string, value string, after string"


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, value start) of the base findings, in order."""
    found = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                found.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                found.append((m.start(), 1, m.end(), m.start()))
    for m in HEX.finditer(text):
        found.append((m.start(), 2, m.end(), m.start()))
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def coded(text: str) -> np.ndarray:
    """Characters as small numbers: 0 for none, 1-95 printable ASCII, 96 control, 97 any other."""
    return CODE_OF[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 127)]


CODE_OF = np.array([0, *[96] * 31, *range(1, 96), 97], np.uint8)
KEY_CODES = np.isin(np.arange(CODES), [CODE_OF[ord(c)] for c in map(chr, range(127)) if KEY.match(c)])


@dataclass
class Candidates:
    """Some texts in one row of codes, GAP empty places around each; spans count in this row."""

    flat: np.ndarray
    text_starts: np.ndarray
    bases: list[list[tuple[int, int, int, int]]]  # base findings per text, counted in the text
    starts: np.ndarray  # negatives, in order
    ends: np.ndarray

    @staticmethod
    def of(texts: list[str], negatives: bool = True) -> Candidates:
        gap = "\0" * GAP
        flat = coded(gap + gap.join(texts) + gap)
        lengths = np.array([len(t) for t in texts], np.int64)
        text_starts = GAP + np.cumsum(lengths + GAP) - lengths - GAP
        bases = [base_spans(t) for t in texts]
        none = np.zeros(0, np.int64)
        if not negatives:
            return Candidates(flat, text_starts, bases, none, none)
        turns = np.flatnonzero(np.diff(KEY_CODES[flat].view(np.int8))) + 1  # a run starts and ends in turn
        starts, ends = turns[::2], turns[1::2]
        long = ends - starts >= LEAST
        starts, ends = starts[long], ends[long]
        if any(bases):
            found = np.zeros(len(flat) + 1, np.int64)
            for at, base in zip(text_starts.tolist(), bases):
                for s, _, e, _ in base:
                    found[at + s + 1 : at + e + 1] = 1
            found = np.cumsum(found)
            free = found[ends] == found[starts]
            starts, ends = starts[free], ends[free]
        return Candidates(flat, text_starts, bases, starts, ends)

    def positives(self) -> tuple[np.ndarray, np.ndarray]:
        """Values of base findings; a value that two patterns find counts once."""
        spans = [(at + v, at + e) for at, base in zip(self.text_starts.tolist(), self.bases) for v, e in sorted({(v, e) for _, _, e, v in base})]
        both = np.array(spans, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def pieces(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans in pieces of at most VALUE places (the last one full), and the span of each piece."""
    counts = np.maximum(-(-(ends - starts) // VALUE), 1)
    of = np.repeat(np.arange(len(starts)), counts)
    k = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    a = np.minimum(starts[of] + k * VALUE, np.maximum(ends[of] - VALUE, starts[of]))
    return a, np.minimum(a + VALUE, ends[of]), of


@dataclass
class CharNet:
    """Vectors, convolution, pooling over value and surroundings, one hidden layer; then calibration."""

    weights: list[np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0  # above any probability: adds nothing
    around: list[tuple[str, str]] | None = None  # surroundings of negatives held out; None: not trained

    @staticmethod
    def fresh(rng: np.random.Generator) -> CharNet:
        def draw(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        embed = rng.standard_normal((CODES, DIM)).astype(np.float32) * np.float32(0.5)
        zeros = np.zeros
        return CharNet(
            [embed, draw(REACH * DIM, FILTERS), zeros(FILTERS, np.float32), draw(4 * FILTERS, HIDDEN),
             zeros(HIDDEN, np.float32), draw(HIDDEN, 1), zeros(1, np.float32)]
        )

    def tables(self) -> list[np.ndarray]:
        """What a pair of codes, or the last one, adds to the filters: in place of products per place."""
        embed, kernel, bias = self.weights[:3]
        each = [embed @ kernel[k * DIM : (k + 1) * DIM] for k in range(REACH)]
        pairs = [(each[k][:, None] + each[k + 1]).reshape(CODES * CODES, -1) for k in range(0, REACH - 1, 2)]
        return [*pairs, each[-1] + bias]

    def filtered(self, flat: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Filters at each place, over REACH codes from there on."""
        places, codes = len(flat) - REACH + 1, flat.astype(np.intp)
        pairs = codes[:-1] * CODES + codes[1:]
        conv = tables[-1].take(codes[REACH - 1 :], axis=0)
        for k, table in enumerate(tables[:-1]):
            conv += table.take(pairs[2 * k : 2 * k + places], axis=0)
        return np.maximum(conv, 0, out=conv)

    def forward(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, tables: list[np.ndarray] | None = None) -> tuple[np.ndarray, tuple]:
        """Logits of values of at most VALUE places at some spans of codes.

        Maxima and sums of 1, 2, 4, .. places are taken of the whole row, and those of a value are
        put together from them.
        """
        _, _, _, w1, b1, w2, b2 = self.weights
        conv = self.filtered(flat, tables or self.tables())
        a, b = starts - REACH // 2, ends - REACH // 2  # filters centred in the value
        top, total = np.zeros((2, len(a), FILTERS), conv.dtype)
        at, sizes, maxima, sums = a.copy(), b - a, conv, conv
        before = after = top
        for bit in range(VALUE.bit_length()):
            n = 1 << bit
            if n > 1:
                maxima = np.maximum(maxima[: -n // 2], maxima[n // 2 :])
                sums = sums[: -n // 2] + sums[n // 2 :]
            if n == AFTER:
                after = maxima.take(b, axis=0)
            if 2 * n > BEFORE >= n:
                before = np.maximum(maxima.take(a - BEFORE, axis=0), maxima.take(a - n, axis=0))
            has = np.flatnonzero(sizes & n)
            top[has] = np.maximum(top[has], maxima.take(at[has], axis=0))
            total[has] += sums.take(at[has], axis=0)
            at[has] += n
        pooled = np.concatenate([top, total / sizes[:, None].astype(np.float32), before, after], axis=1)
        hidden = np.maximum(pooled @ w1 + b1, 0)
        return (hidden @ w2 + b2)[:, 0], (flat, a, b, conv, pooled, hidden)

    def gradients(self, kept: tuple, d_logit: np.ndarray) -> list[np.ndarray]:
        embed, kernel, _, w1, _, w2, _ = self.weights
        flat, a, b, conv, pooled, hidden = kept
        d_hidden = d_logit[:, None] @ w2.T * (hidden > 0)
        d_top, d_mean, d_before, d_after = np.split(d_hidden @ w1.T, 4, axis=1)
        d_conv = np.zeros_like(conv)
        sizes = b - a
        of = np.repeat(np.arange(len(a)), sizes)
        at = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + a[of]
        largest = conv[at] == pooled[of, :FILTERS]
        shared = np.add.reduceat(largest, np.cumsum(sizes) - sizes, dtype=np.float32)
        d_conv[at] = d_mean[of] / sizes[of, None].astype(np.float32) + largest * (d_top / shared)[of]
        for x, n, d in ((a - BEFORE, BEFORE, d_before), (b, AFTER, d_after)):
            top = x[:, None] + conv[x[:, None] + np.arange(n)].argmax(axis=1)
            d_conv[top, np.arange(FILTERS)] += d
        d_conv *= conv > 0
        places = len(conv)
        cols = np.concatenate([embed[flat[k : k + places]] for k in range(REACH)], axis=1)
        d_cols = d_conv @ kernel.T
        d_embed = np.zeros_like(embed)
        for k in range(REACH):
            np.add.at(d_embed, flat[k : k + places], d_cols[:, k * DIM : (k + 1) * DIM])
        return [
            d_embed, cols.T @ d_conv, d_conv.sum(0), pooled.T @ d_hidden,
            d_hidden.sum(0), hidden.T @ d_logit[:, None], d_logit.sum(keepdims=True),
        ]

    def fit(self, rows: list[tuple[str, str, str]], y: np.ndarray, around: list[tuple[str, str]], rng: np.random.Generator, epochs: int = 6, least_steps: int = 400, size: int = 64) -> None:
        """Adam on the logistic loss, both labels weighing the same in all."""
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(max(epochs, -(-least_steps * size // len(rows)))):
            order = rng.permutation(len(rows))
            for begin in range(0, len(rows), size):
                picked = order[begin : begin + size]
                other = rng.integers(-len(around), len(around), len(picked))  # its own surroundings below 0
                batch = [rows[i] if k < 0 else (around[k][0], rows[i][1], around[k][1]) for i, k in zip(picked, other)]
                logit, kept = self.forward(*laid_out(batch))
                gap = (1 / (1 + np.exp(-logit)) - y[picked]) * weight[picked] / len(picked)
                step += 1
                for w, g, m, v in zip(self.weights, self.gradients(kept, gap.astype(np.float32)), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= 3e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def logits(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Logits of spans, in order of their starts; the largest of a span's pieces counts."""
        a, b, of = pieces(starts, ends)
        out, tables = np.zeros(len(a)), self.tables()
        i = 0
        while i < len(a):
            j = max(int(np.searchsorted(a, a[i] + CHUNK)), i + 1)
            low = a[i] - GAP
            out[i:j] = self.forward(flat[low : b[i:j].max() + AFTER + REACH], a[i:j] - low, b[i:j] - low, tables)[0]
            i = j
        return np.maximum.reduceat(out, np.searchsorted(of, np.arange(len(starts)))) if len(a) else out

    def calibrate(self, logits: np.ndarray, y: np.ndarray) -> None:
        """Logistic curve by Newton steps."""
        a, b = 1.0, 0.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
            r = p * (1 - p) + 1e-9
            g = np.array([((p - y) * logits).sum() + 1e-3 * a, (p - y).sum()])
            h = np.array([[(r * logits**2).sum() + 1e-3, (r * logits).sum()], [(r * logits).sum(), r.sum()]])
            move = np.linalg.solve(h + 1e-6 * np.eye(2), g)
            a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
        self.scale, self.shift = float(a), float(b)

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return np.clip(self.scale * logits + self.shift, -LIMIT, LIMIT)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.calibrated(logits)))


def laid_out(rows: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of single candidates one after the other, each with its surroundings, and their spans."""
    width = GAP + AFTER + REACH
    texts = [b.rjust(GAP, "\0")[-GAP:] + v + a.ljust(AFTER + REACH, "\0")[: AFTER + REACH] for b, v, a in rows]
    sizes = np.array([len(v) for _, v, _ in rows], np.int64)
    starts = np.cumsum(sizes + width) - sizes - width + GAP
    return coded("".join(texts)), starts, starts + sizes


def train(rows: list, seed: int = 7) -> CharNet:
    """A network from labelled candidates: rows of label, fold, before, value, after."""
    rng = np.random.default_rng(seed)
    net = CharNet.fresh(rng)
    part = {held: [r for r in rows if (r.fold == 0) == held] for held in (False, True)}
    labels = {held: np.array([r.label for r in part[held]], np.float32) for held in part}
    if any(len(set(y.tolist())) < 2 for y in labels.values()):
        return net
    shown = {held: [(r.before, r.value, r.after) for r in part[held]] for held in part}
    around = {held: [(r.before, r.after) for r in part[held] if r.label == 0] for held in part}
    net.fit(shown[False], labels[False], around[False], rng)
    moved = rng.integers(0, len(around[True]), len(shown[True]))
    both = shown[True] + [(around[True][k][0], value, around[True][k][1]) for k, (_, value, _) in zip(moved, shown[True])]
    net.calibrate(net.logits(*laid_out(both)), np.tile(labels[True], 2))
    net.around = around[True]
    return net


def mixed(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of a row's key and a place in its text."""
    x = keys.astype(np.uint64) ^ (places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).astype(np.int64)


def sample_candidates(texts: DataFrame, size: int = SAMPLE) -> list:
    """At most ``size`` candidates of each label, first by hash; a fourth is held out, by text.

    A task gives out no more than ``size`` rows of a label.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple]] = {0: [], 1: []}
        bound = {0: 2**63 - 1, 1: 2**63 - 1}
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(begin, ROWS_PER_SLICE)
                rows = texts_of(part["text"])
                keys = part["key"].to_numpy(zero_copy_only=False)
                folds = part["fold"].to_pylist()
                c = Candidates.of(rows)
                for label, (starts, ends) in ((0, (c.starts, c.ends)), (1, c.positives())):
                    of = np.searchsorted(c.text_starts, starts, side="right") - 1
                    order = mixed(keys[of], starts - c.text_starts[of])
                    for i in np.flatnonzero(order <= bound[label]).tolist():
                        text, s = rows[of[i]], int(starts[i] - c.text_starts[of[i]])
                        e = s + min(int(ends[i] - starts[i]), VALUE)
                        shown = (text[max(0, s - GAP) : s], text[s:e], text[e : e + AFTER + REACH])
                        kept[label].append((int(order[i]), label, folds[of[i]], *shown))
                    if len(kept[label]) > 2 * size:
                        kept[label] = sorted(kept[label])[:size]
                        bound[label] = kept[label][-1][0]
        picked = [r for label in kept for r in sorted(kept[label])[:size]]
        columns = list(zip(*picked)) or [()] * 6
        kinds = (pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 3)
        arrays = dict(zip(("place", "label", "fold", "before", "value", "after"), (pa.array(x, k) for x, k in zip(columns, kinds))))
        yield pa.RecordBatch.from_pydict({name.split()[0]: arrays[name.split()[0]] for name in SAMPLED.split(", ")})

    # The first rows of each label: of some buckets at first, then of these, so that neither a task nor
    # the driver takes what all tasks give out.
    rows = cut_lineage(texts.mapInArrow(pick, SAMPLED)).withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(BUCKETS)))
    for keys in (["label", "bucket"], ["label"]):
        first = Window.partitionBy(*keys).orderBy("place", "before", "value", "after", "fold")
        rows = rows.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= size)
    ordered = rows.orderBy(F.col("label").desc(), "at").select("label", "fold", "before", "value", "after")
    return ordered.collect()  # at most ``size`` rows of each label


def held_out_steps(held: DataFrame, net: CharNet) -> dict[int, int]:
    """Positives of the texts held out per step of their calibrated logit, the lower of both surroundings."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(int(2 * LIMIT / STEP) + 1, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(begin, ROWS_PER_SLICE)
                rows = texts_of(part["text"])
                c = Candidates.of(rows, negatives=False)
                starts, ends = c.positives()
                if len(starts):
                    of = np.searchsorted(c.text_starts, starts, side="right") - 1
                    starts, ends = starts - c.text_starts[of], ends - c.text_starts[of]
                    keys = part["key"].to_numpy(zero_copy_only=False)[of]
                    other = mixed(keys, starts) % len(net.around)
                    spans = list(zip(of.tolist(), starts.tolist(), ends.tolist()))
                    own = [(rows[i][max(0, s - GAP) : s], rows[i][s:e], rows[i][e : e + AFTER + REACH]) for i, s, e in spans]
                    moved = [(net.around[k][0], value, net.around[k][1]) for k, (_, value, _) in zip(other, own)]
                    lower = np.minimum(net.logits(*laid_out(own)), net.logits(*laid_out(moved)))
                    seen += np.bincount(((net.calibrated(lower) + LIMIT) / STEP).astype(np.int64), minlength=len(seen))
        steps = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"step": steps, "n": seen[steps]})

    counted = held.mapInArrow(count, "step long, n long").groupBy("step").agg(F.sum("n").alias("n"))
    return {r["step"]: r["n"] for r in counted.collect()}


def threshold_of(steps: dict[int, int], recall: float = RECALL) -> float:
    """The largest lower edge of a step that keeps the recall."""
    missed, allowed = 0, (1 - recall) * sum(steps.values())
    for step in sorted(steps):
        missed += steps[step]
        if missed > allowed:
            return float(1 / (1 + np.exp(LIMIT - step * STEP + 1e-9)))
    return 2.0


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None) -> DataFrame:
    """Per row: ``id``, n_assign, n_access, n_hex, base (span list) and spans (all)."""
    small_batches(docs.sparkSession)
    source = whole_text() if text is None else text
    read = docs.select(F.col(id_col).alias("id"), source.alias("text"))
    keyed = read.select(
        "text",
        F.xxhash64("id", "text").alias("key"),
        F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(4)).cast("int").alias("fold"),
    )
    net = train(sample_candidates(keyed))
    if net.around:
        net.threshold = threshold_of(held_out_steps(keyed.filter("fold = 0"), net))

    @F.arrow_udf(FOUND_SQL)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [r for i in range(0, len(texts), ROWS_PER_SLICE) for r in found(texts_of(texts.slice(i, ROWS_PER_SLICE)), net)]
            yield pa.array(out, FOUND)

    return read.select("id", find("text").alias("r")).select("id", "r.*")


def found(texts: list[str], net: CharNet) -> list[dict]:
    """Counts and span lists of some texts."""
    scored = net.threshold <= 1
    c = Candidates.of(texts, negatives=scored)
    more: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if scored:
        over = net.probability(net.logits(c.flat, c.starts, c.ends)) >= net.threshold
        starts, ends = c.starts[over], c.ends[over]
        of = np.searchsorted(c.text_starts, starts, side="right") - 1
        for row, s, e in zip(of.tolist(), (starts - c.text_starts[of]).tolist(), (ends - c.text_starts[of]).tolist()):
            more[row].append((s, 3, e))
    out = []
    for base, model in zip(c.bases, more):
        kinds, spans = [k for _, k, _, _ in base], [(s, k, e) for s, k, e, _ in base]
        out.append(
            {"n_assign": kinds.count(0), "n_access": kinds.count(1), "n_hex": kinds.count(2), "base": joined(spans), "spans": joined(spans + model)}
        )
    return out
