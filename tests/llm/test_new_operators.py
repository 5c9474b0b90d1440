"""Decontamination, fill-in-the-middle and importance resampling against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.llm import decontaminate, fill_middle, importance

DOCS = "doc_id long, text string, lang string, n long, items int"
ODD = [
    (1, "The cat, sat ON the mat", "en", 1, 1),
    (1, "The cat, sat ON the mat", "en", 1, 1),
    (2, None, None, None, None),
    (3, "", "en", 0, 0),
    (4, " \n\t", None, 0, 0),
    (None, "only two", "de", 2, 2),
    (None, "a <S> mark and more text", "de", 2, 2),
    (7, "é🙂 ÄB " * 3000 + "z" * 5000, "fr", 9, 1),
]
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(text, size):
    w = words(text)
    n = min(size, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def contamination_by_loops(text, items, size):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        for win in windows(item, size):
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= {name} - {None}
    return len(w), hit, found


@pytest.mark.parametrize("size, block_windows", [(10, 500_000), (4, 500_000), (4, 60), (1, 500_000)])
def test_contamination_equals_loops(spark, size, block_windows, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    rng = random.Random(size + block_windows)
    text = lambda n: " ".join(rng.choice("abcdefgh") * rng.choice([1, 1, 2]) for _ in range(n))
    items = [(str(i), text(rng.choice([1, 2, 3, 5, 9, 10, 11, 30]))) for i in range(20)]
    items += [items[3], ("20", items[3][1]), ("3", text(12)), (None, text(4)), ("21", None), ("22", ",;"), ("23", "Å ÄB")]
    rows = [(i, text(rng.choice([0, 1, 5, 40])) + ", " + (rng.choice(items)[1] or "") if i % 2 else text(30)) for i in range(60) if i != 9]
    rows += [(9, None), (60, "x"), (61, "x Å äb Å Äb"), (61, "x Å äb Å Äb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string").repartition(3)
    blocks = decontaminate.blocks_of(benchmark, size, block_windows)
    assert (len(blocks) > 2) == (block_windows == 60)
    got = decontaminate.contamination(docs, benchmark, size, block_windows).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    assert any(r.spans for r in got)
    for r in got:
        n, hit, found = contamination_by_loops(r.text, items, size)
        assert r.n_words == n and sorted(r["items"]) == sorted(found)
        assert [i for s in r.spans for i in range(s.first, s.last + 1)] == sorted(hit)
        assert all(a.last + 1 < b.first for a, b in zip(r.spans, r.spans[1:]))
    kept = decontaminate.clean(docs, benchmark, size)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not contamination_by_loops(t, items, size)[1] for _, t in rows)


def test_contamination_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    benchmark = spark.createDataFrame([(5, "sat on THE", 1), (6, None, 2)], "item_id long, text string, n_words int")
    got = decontaminate.contamination(docs, benchmark).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 1, 2, 3, 4, 7]
    assert [(r.n_words, r["items"]) for r in got[2:6]] == [(6, ["5"]), (6, ["5"]), (0, []), (0, [])]
    assert [(s.first, s.last) for s in got[2].spans] == [(2, 4)] and got[2].n == 1 and got[2].lang == "en"
    assert decontaminate.contamination(docs.limit(0), benchmark).count() == 0
    clear = decontaminate.contamination(docs, benchmark.limit(0)).collect()
    assert len(clear) == len(ODD) and not any(r.spans or r["items"] for r in clear)


def test_equal_suffixes_and_words_of_every_item(spark):
    """Many windows with the same last words, and a text that holds one of them everywhere."""
    items = [(i, f"{i} x x x x") for i in range(300)]
    docs = spark.createDataFrame([(0, "x " * 500 + "7 x x x x"), (1, "7 x x x")], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    first, second = decontaminate.contamination(docs, benchmark, 5).orderBy("doc_id").collect()
    assert first["items"] == ["7"] and [(s.first, s.last) for s in first.spans] == [(500, 504)] and not second.spans


def units_by_loops(text):
    ends, i = [], 0
    while i < len(text):
        m = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+").match(text, i)
        i = m.end()
        ends.append(i)
    return ends


def test_units_equal_loops():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("ab \n\t\x0b\x1c\x85 é🙂") for _ in range(rng.choice([0, 1, 3, 30])))
        assert fill_middle.unit_ends(text) == units_by_loops(text)
    assert len(fill_middle.unit_ends("word " * 400_000)) == 400_001
    assert len(fill_middle.unit_ends(" " * 3_000_000)) == 1


def test_fill_middle_equals_loops(spark):
    rows = [*ODD, *((i, f"w{i} some\n more  text {i} é🙂 end ", "en", 1, 1) for i in range(100, 400))]
    docs = spark.createDataFrame(rows, DOCS)
    made = fill_middle.transform(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    assert made.columns == ["doc_id", "text", "lang", "items", *fill_middle.OUTPUTS, "back"]
    got = made.collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        text = r.text or ""
        digest = hashlib.sha256(f"42:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
        ends = [0, *units_by_loops(text)]
        a, b = sorted((ends[h[0] % len(ends)], ends[h[1] % len(ends)]))
        pre, mid, suf = text[:a], text[a:b], text[b:]
        form = "plain" if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
        forms = {"plain": text, "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}
        assert (r.n, r.form, r.output, r.back) == (len(ends) - 1, form, forms[form], text)
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else (a, b - a))
    assert fill_middle.transform(docs.limit(0)).count() == 0
    assert fill_middle.transform(docs, rate=0).filter("form <> 'plain'").count() == 0


def test_crcs_of_substrings_equal_library():
    rng = random.Random(2)
    texts = ["", "one", ",", "Two words", "é🙂 A-b " + "q" * 3000 + " x " + "r" * 70_000 + " y z"]
    texts += [" ".join(rng.choice("abc") * rng.choice([1, 5, 255, 256, 257]) for _ in range(30)) for _ in range(20)]
    for low, high in ((1, 1), (1, 3), (2, 4)):
        crcs, counts, n_words = importance.ngram_crcs(texts, low, high)
        assert n_words.tolist() == [len(words(t)) for t in texts]
        assert counts.tolist() == [sum(max(0, len(words(t)) - n + 1) for n in range(low, high + 1)) for t in texts]
        at = 0
        for text, n in zip(texts, counts):
            w = words(text)
            expected = [crc32(" ".join(w[i : i + k]).encode()) for k in range(low, high + 1) for i in range(len(w) - k + 1)]
            assert sorted(crcs[at : at + n].tolist()) == sorted(expected)
            at += n


def ranks_by_loops(docs, target, high, percent):
    buckets = lambda t: [
        crc32(" ".join(w[i : i + k]).encode()) % 100 for w in [words(t)] for k in range(1, high + 1) for i in range(len(w) - k + 1)
    ]
    s, t = (np.bincount([b for x in texts for b in buckets(x)] or [0], minlength=100) * bool(any(map(words, texts))) for texts in (docs and [d[1] for d in docs], target))
    total, wanted = float(s.sum() + 100), float(t.sum() + 100)
    gain = [math.floor(1000 * math.log((int(t[b]) + 1) * total / ((int(s[b]) + 1) * wanted))) for b in range(100)]
    out = []
    for i, text in docs:
        own = [gain[b] for b in buckets(text)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"9:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= 3))
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return [(*r[:4], k) for k, r in enumerate(fit[: percent * len(fit) // 100], 1)], out


@pytest.mark.parametrize("high, percent", [(1, 10), (3, 50), (1, 100), (1, 0)])
def test_resampling_equals_loops(spark, high, percent):
    rng = random.Random(high)
    docs = [(i % 150 if i % 7 else None, " ".join(str(rng.randrange(40)) for _ in range(rng.choice([0, 2, 5, 50])))) for i in range(200)]
    docs += [(500, None), (501, "x y z"), (501, "x y z"), (501, "x y z")] + [(600, "same row again")] * 60
    target = ["1 2 3 4 5", None, "7 8 9", "1 2 3"]
    frame = spark.createDataFrame([(*d, "en", 5) for d in docs], "doc_id long, text string, lang string, rank int").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(frame, wanted, 1, high, 100, "9", 3, percent).collect()
    drawn, everything = ranks_by_loops(docs, target, high, percent)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    rows = sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key)
    assert rows == sorted((r[:4] for r in everything), key=key)
    in_order = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in in_order] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in in_order] == [(r[3], r[0]) for r in drawn]


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    none = docs.limit(0)
    assert importance.resample(none, docs).count() == 0
    got = importance.resample(docs, none, least_words=1, percent=100).collect()
    assert len(got) == len(ODD)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 1 + sum(bool(words(t)) for _, t, *_ in ODD)))
