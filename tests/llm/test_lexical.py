"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from gridloom.llm import lexical

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, length = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c, n in held:
            score = 0
            for t in terms(text):
                if c[t]:
                    m = 100 - 75 + (75 * n * n_docs) // length
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return out


def shown(rows):
    return sorted(map(str, map(tuple, rows)))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(12)
    vocabulary = ["the", "of", "and"] * 40 + [f"w{k}" for k in range(30)] * 4 + [f"rare{k}" for k in range(200)]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice((1, 3, 20, 80))))) for i in range(400)]
    items = [(i, " ".join(docs[r.randrange(400)][1].split()[:12])) for i in range(25)]
    docs += [(900 + i, docs[7][1]) for i in range(30)] + [(7, docs[7][1]), (7, docs[8][1])]  # copies tie
    docs += [(None, docs[7][1]), (950, None), (951, ""), (952, " ,.; "), (953, "ÄÖ ä ß_the THE\0the İ"), (954, "the " * 50000), (955, "x" * 200000)]
    items += [(100, None), (101, ""), (102, "nothing known"), (103, "the the the"), (104, "THE of, W1 rare5"), (None, "rare7 rare8"), (5, "rare9"), (5, "rare9"), (106, "Ä ä İ"), (107, docs[7][1])]
    return docs, items


@pytest.mark.parametrize(("shard", "block", "k"), [(2_000_000, 200_000, 10), (300, 200_000, 10), (1, 40, 3), (3000, 60, 1)])
def test_search(spark, corpus, monkeypatch, shard, block, k):
    docs, items = corpus
    monkeypatch.setattr(lexical, "SHARD", shard)
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as score", "'x' as key", "2 as n").repartition(3)
    found = lexical.search(d, spark.createDataFrame(items, ITEMS).selectExpr("*", "0 as q"), k=k, block=block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert shown(found.collect()) == shown(brute(docs, items, k))


def test_stops_early_and_stays_exact(corpus):
    """One shard, called directly: fewer groups than there are suffice for some items, and scores are whole."""
    import numpy as np

    r = random.Random(3)
    n_terms, rows = 60, []
    for _ in range(3000):
        rows.append(Counter(r.choices(range(n_terms), weights=[1 / (t + 1) for t in range(n_terms)], k=r.choice((5, 30)))))
    sizes = np.array([len(c) for c in rows])
    flat_terms, tfs = (np.array([x for c in rows for x in f(c)], np.int64) for f in (dict.keys, dict.values))
    n = np.array([sum(c.values()) for c in rows])
    shard = lexical.Shard(n, sizes, flat_terms, tfs, n_terms, 3000, int(n.sum()))
    completed = []
    plain = shard.completed
    shard.completed = lambda docs, weight: completed.append(len(docs)) or plain(docs, weight)
    for at in range(0, n_terms - 6, 3):
        own = np.arange(at, at + 6)
        weights = np.array([10_000, 40, 30, 20, 10, 0])
        every = np.zeros(n_terms, np.int64)
        every[own] = weights
        found, scores = shard.best(own, weights, every, 5)
        exact = plain(np.arange(3000), every)
        want = sorted(exact[exact > 0], reverse=True)[:5]
        assert sorted(scores, reverse=True)[:5] == want and all(exact[d] == s for d, s in zip(found, scores, strict=True))
        assert set(np.flatnonzero(exact >= max(want[-1], 1))) <= set(found)
    assert completed and min(completed) < 3000


def test_empty_tables(spark, corpus):
    docs, items = (spark.createDataFrame(x[:5], s) for x, s in zip(corpus, (DOCS, ITEMS), strict=True))
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.limit(0), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
