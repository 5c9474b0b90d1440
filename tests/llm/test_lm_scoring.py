"""Stupid backoff against loops: orders, blocks, odd rows, repeated rows and empty tables."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from wardlight.llm import lm_scoring


def tokens(text):
    return (text or "").encode().lower().split()


def grams(words, k):
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def scores_by_loops(rows, order, first_word):
    total = Counter()
    for _, text in rows:
        words = tokens(text)
        total.update(g for k in range(1, order + 1) for g in grams(words, k))
        total[()] += len(words)
    out = []
    for i, text in rows:
        words = tokens(text)
        own = Counter(g for k in range(1, order + 1) for g in grams(words, k))
        own[()] = len(words)
        scored, backed, log_sum = 0, 0, 0.0
        for at in range(0 if first_word else 1, len(words)):
            back = 0
            for k in range(min(order, at + 1), 0, -1):
                gram = tuple(words[at - k + 1 : at + 1])
                count, context = total[gram] - own[gram], total[gram[:-1]] - own[gram[:-1]]
                if count > 0 or k == 1:
                    least = 1 if k == 1 else 0.5
                    log_sum += back * math.log(0.4) + math.log(max(count, 0.5)) - math.log(max(context, least))
                    break
                back += 1
            scored, backed = scored + 1, backed + (back > 0)
        out.append((i, len(words), scored, backed, round(log_sum, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order, first_word, block_bytes", [(2, False, 8 << 20), (2, False, 300), (3, True, 700), (1, True, 500), (4, False, 900)])
def test_scores_equal_loops(spark, order, first_word, block_bytes):
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choice("aa A b bb c dé 🙂".split()) for _ in range(rng.randrange(12)))) for i in range(120)]
    rows += [(1, "a  b\tc"), (1, "a  b\tc"), (None, "a b c"), (None, "x"), (500, None), (501, ""), (502, " \n ")]
    rows += [(503, "rare words only here"), (504, "b b a\x1fb"), (505, "long " * 4000)]
    docs = spark.createDataFrame([(i, t, "en", 7, None) for i, t in rows], "doc_id long, text string, id string, block int, part int")
    got = lm_scoring.score(docs, order=order, first_word=first_word, block_bytes=block_bytes).collect()
    seen = [(r.id, r.n_words, r.n_scored, r.n_backed_off, round(r.log_score, 6)) for r in got]
    for mine, other in zip(sorted(seen, key=repr), scores_by_loops(rows, order, first_word), strict=True):
        assert mine[:4] == other[:4] and mine[4] == pytest.approx(other[4], abs=1e-5)
    for r in got:
        assert r.mean_log_score == (pytest.approx(r.log_score / r.n_scored) if r.n_scored else None)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert lm_scoring.score(docs).collect() == []


def test_packed_counts():
    counts = np.array([0, 1, 255, 256, 70_000, 2**40])
    assert lm_scoring.unpacked(lm_scoring.packed(counts)).tolist() == counts.tolist()


def test_an_n_gram_of_every_document_is_one_row_a_block():
    """What a block sends grows with its distinct n-grams, not with its documents."""
    block = lm_scoring.Block(iter([b"the same line"] * 1000), 2)
    keys, counts = block.distinct()
    assert len(keys) == 6 and sorted(counts.tolist()) == [1000] * 5 + [3000]
