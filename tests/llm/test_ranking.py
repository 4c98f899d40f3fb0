"""Ranked search against scores of every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from stockflow.llm import ranking

ITEMS = "item_id long, text string, place int, score long, doc_id long, rank int, term string"


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, "t") for i, t in items], ITEMS).repartition(2)


def terms_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in counts:
            m = 50 + (50 * c.total() * n_docs) // n_terms if n_terms else 0
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return sorted(map(str, out))


def result(df):
    return sorted(str(tuple(r)) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def corpus(seed, n, words=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 4))) for _ in range(words)]
    pick = lambda m: " ".join(rng.choice(vocab[: rng.randint(2, words)]) for _ in range(m))
    docs = [(i, pick(rng.randint(0, 30))) for i in rng.sample(range(10_000), n)]
    items = [(i, pick(rng.randint(0, 12))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("block", [5, 64, 1 << 16])
@pytest.mark.parametrize("k", [1, 3, 50])
def test_equals_plain(spark, block, k):
    docs, items = corpus(k, 150)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(ranking.ranked(frame, items_of(spark, items), k=k, block=block)) == plain(docs, items, k)


def test_accumulators_stop_and_scores_stay_exact():
    """With few places the common terms make no accumulators, and the best are those of full scores."""
    rng = np.random.default_rng(2)
    for trial in range(60):
        n, terms, k = int(rng.integers(1, 80)), 12, int(rng.integers(1, 6))
        held = rng.random((n, terms)) < np.linspace(0.03, 0.95, terms)
        rows, found = np.nonzero(held)
        counts = rng.integers(1, 5, rows.size)
        weights = np.linspace(4000, 40, terms).astype(np.int64)
        length = np.bincount(rows, counts, n).astype(np.int64)
        postings = ranking.Postings(length, rows, found, counts, weights, n, max(1, int(length.sum())))
        asked = np.sort(rng.choice(terms + 3, size=8, replace=False))  # some that no document holds
        full = np.zeros(n, np.int64)
        np.add.at(full, postings.rows, postings.adds * np.isin(np.repeat(postings.terms, postings.end - postings.start), asked))
        best, scores = postings.best(asked, k, 0)
        want = sorted(full[full > 0].tolist(), reverse=True)[:k]
        assert sorted(scores.tolist(), reverse=True)[: len(want)] == want and (full[best] == scores).all()
        if want:  # all ties of the last place are there, also with a known reach
            assert set(np.flatnonzero(full >= want[-1])) <= set(best.tolist())
            again, _ = postings.best(asked, k, want[-1])
            assert set(np.flatnonzero(full >= want[-1])) <= set(again.tolist())


def test_blocks_of_items(spark):
    docs, items = corpus(8, 60)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(ranking.ranked(frame, items_of(spark, items), k=4, asked=40)) == plain(docs, items, 4)


def test_odd_rows(spark, rows, docs, odd):
    passages = [t for _, t in rows if t and len(t) < 900]
    items = [(i, t) for i, t in enumerate(passages)] + [(900, None), (901, ""), (902, "zzzz unknown"), (None, "one two"), (None, "words")]
    items += [(3, passages[5]), (3, passages[5])]  # rows of one item
    assert result(ranking.ranked(docs, items_of(spark, items))) == plain(rows, items, 50)
    pairs = [(r.doc_id, r.text) for r in odd.collect()]  # repeated rows and ids that are null
    assert result(ranking.ranked(odd, items_of(spark, items), k=6)) == plain(pairs, items, 6)


def test_empty_tables(spark, docs, nothing):
    items = items_of(spark, [(1, "one two")])
    columns = ["item_id", "rank", "doc_id", "score"]
    for d, i in ((nothing, items), (docs, items.limit(0)), (nothing, items.limit(0)), (docs, items_of(spark, [(1, None)]))):
        got = ranking.ranked(d, i)
        assert got.collect() == [] and got.columns == columns


def test_very_long_text():
    text = "Word " * 1_000_000 + "x" * 300_000 + " end."
    assert ranking.term_counts(text) == {"word": 1_000_000, "x" * 300_000: 1, "end": 1}
