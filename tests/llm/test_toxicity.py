"""Positive-unlabelled toxicity scores: the risk by plain loops, held-out accuracy, odd inputs."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import toxicity

SCHEMA = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"
CLEAN = [a + b for a in ("ver", "men", "tion", "ou", "re", "la") for b in ("ta", "so", "lin", "ka", "du", "per", "no")]
BAD = ["grobian", "ekelding", "lump", "schuft"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 8 == 0
        words = [r.choice(CLEAN) + r.choice(("", r.choice(CLEAN))) for _ in range(r.choice((12, 40, 150)))]
        if toxic:
            for _ in range(1 + len(words) // 20):
                words[r.randrange(len(words))] = r.choice(BAD).upper() + r.choice(("", "!", "e"))
        rows.append((i, " ".join(words)))
        if i % 3 < 2:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, corpus):
    rows, labels = corpus
    found = {r.doc_id: r for r in toxicity.score_toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(found) == len(rows)
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in found.items())
    fresh = [i for i in found if held(i)]
    assert sum(found[i].predicted == (i % 8 == 0) for i in fresh) >= 0.97 * len(fresh)


def test_labels_of_held_out_rows_are_not_read(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    one, two = (sorted(map(tuple, toxicity.score_toxicity(docs, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, turned))
    assert one == two


def test_unlabelled_sample_holds_toxic_rows_as_often_as_the_table(spark, corpus):
    """A small bound on the unlabelled rows beside all toxic ones: with these added to it, all scores sank and ranked nothing."""
    rows, labels = corpus
    found = toxicity.score_toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS), unlabelled=240).collect()
    fresh = [r for r in found if held(r.doc_id)]
    assert sum(r.predicted == (r.doc_id % 8 == 0) for r in fresh) >= 0.97 * len(fresh)


@pytest.mark.parametrize("convex", [True, False])
def test_risk_by_plain_loops(convex):
    r = np.random.default_rng(3)
    dense = lambda n: (r.random((n, 5)) < 0.5) * r.random((n, 5))
    p, u = dense(7), dense(20)
    sparse = lambda m: toxicity.Rows([(np.flatnonzero(x), x[np.flatnonzero(x)]) for x in m], 5)
    theta, pi = r.normal(size=6), 0.3

    def parts(theta):
        f = lambda x: sum(a * b for a, b in zip(x, theta, strict=False)) + theta[5]
        loss = (lambda z: math.log(1 + math.exp(-z))) if convex else (lambda z: 1 / (1 + math.exp(z)))
        mean = lambda rows, sign: sum(loss(sign * f(x)) for x in rows) / len(rows)
        return pi * mean(p, 1), mean(u, -1) - pi * mean(p, -1)

    positive, negative, g_positive, g_negative = toxicity.risk(theta, sparse(p), sparse(u), pi, convex)
    assert (positive, negative) == pytest.approx(parts(theta))
    for k in range(6):
        step = np.eye(6)[k] * 1e-6
        high, low = parts(theta + step), parts(theta - step)
        assert (g_positive[k], g_negative[k]) == pytest.approx([(a - b) / 2e-6 for a, b in zip(high, low, strict=True)], abs=1e-6)


def test_fit_keeps_the_negative_risk_up():
    """Unlabelled text that looks like the positives would drive a plain estimator below zero."""
    r = np.random.default_rng(4)
    rows = lambda n, on: toxicity.Rows([(np.array([k % 40]), np.ones(1)) for k in (range(n) if on else r.integers(0, 40, n))], 40)
    pos, unl = rows(40, True), rows(60, False)
    theta = toxicity.fit(pos, unl, 0.7)
    assert toxicity.risk(theta, pos, unl, 0.7)[1] > -0.02


def test_scores_by_plain_evaluation(spark, corpus):
    rows, labels = corpus
    model = toxicity.train(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS), features=50)
    odd = [(None, None), (1, ""), (2, "  \n\t"), (3, "Lump " * 30000), (3, "lump"), (4, "x" * 300000), (5, "ÄLump ünï 12 lump_ schuft\0schuft"), (5, "ÄLump ünï 12 lump_ schuft\0schuft")]
    every = odd + rows[:100]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in toxicity.score(spark.createDataFrame(every, SCHEMA + "").withColumn("score", F.lit("clash")), model).collect())
    want = []
    for i, t in every:
        words = toxicity.WORD.findall((t or "").lower())
        f = model.bias
        for feature, w in zip(model.features, model.weights, strict=True):
            n = sum(toxicity.word_features(x).count(feature) for x in words) if len(words) < 20000 else words.count("lump") * toxicity.word_features("lump").count(feature)
            f += w * min(n * 50 / (len(words) + 20), 3.0)
        want.append((i is None, i or 0, round(1 / (1 + math.exp(-max(-30.0, min(30.0, f)))), 6)))
    assert [x[:2] for x in got] == [x[:2] for x in sorted(want)]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in sorted(want)], abs=2e-6)


def test_without_anything_to_learn_from(spark, corpus):
    docs = spark.createDataFrame(corpus[0][:20], SCHEMA)
    for labels in ([], [(i, 1, 0) for i in range(20)], [(i, None, None) for i in range(20)]):
        found = toxicity.score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(found) == 20 and all(r.score == 0 and r.predicted == 0 for r in found)
    assert toxicity.score_toxicity(docs.limit(0), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 0
