"""Toxicity scores by non-negative positive-unlabelled learning.

Known examples are documents confirmed toxic; everything else is unlabelled, not clean. A
linear model is fitted in numpy with the class-prior-corrected risk of the sigmoid loss

    R(f) = pi * E_P[l(f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)])

where pi is the share of toxic documents. Where the part in max() falls below zero, the step
climbs that part instead, so that the model cannot win by overfitting the positives.

A text's features are its lower-cased words (runs of letters) and what words begin with, of
3 to 7 letters, counted per ``PER`` words, so that the length of a text is no signal by
itself. They are hashed to ``DIM`` numbers; the ``features`` kept are those that toxic
documents hold most unlike the others. Language, source, id and labels are never inputs.

What is learned from: rows whose crc32 of the id, as text, is not divisible by ``HELD``. Of
these up to about ``positives`` toxic rows, and ``unlabelled`` rows of any kind, are drawn by a hash of the id: the
documented bounds of the sample that is fitted on; its feature counts are summed by Spark,
and only the kept features of its rows, some tens of numbers each, reach the driver. Every document
is scored, whole, where it lies: no text is shuffled for it.

pi is the toxic share of the labelled rows learned from unless ``prior`` is given; E_U is over the rows drawn
evenly, so that toxic ones stand among them as often as in the table, however many of them were drawn as positives.

Nulls: a null text is empty, a null id counts as the empty text (which is held out), a null
label is no label. A document with several labels is toxic if one says so. Texts without a known feature, empty
ones among them, get the score of the intercept. Without toxic rows to learn from all scores are 0. Repeated rows
are scored alike; rows that share an id are judged each by its text. Very long texts cost in proportion, features in
bounded space. Equal ranks of features are settled by their number. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

HELD = 5
DIM = 1 << 20
FROM, UPTO = 3, 7
PER, LEAST, MOST = 50, 20, 3.0
SCALE = 1 << 30
WORD = re.compile(r"[^\W\d_]+")
#: Words kept with their features: at most so many, none longer than so many letters, so the cache stays under some 100 MB.
KEPT_WORDS, KEPT_LETTERS = 200_000, 40


def is_held(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD == 0


def word_features(word: str) -> list[int]:
    """Numbers of a word's features: itself, and its beginnings that are shorter than it."""
    parts = [word, *("^" + word[:k] for k in range(FROM, UPTO + 1) if len(word) > k)]
    return [xxhash.xxh32_intdigest(x.encode("utf-8", "replace")) & (DIM - 1) for x in parts]


class Counter:
    """Counts of the features of texts; with ``slots`` (feature to place), of those only."""

    def __init__(self, slots: dict[int, int] | None = None):
        self.slots, self.cache = slots, {}

    def _of(self, word: str) -> list[int]:
        found = self.cache.get(word)
        if found is None:
            found = word_features(word)
            if self.slots is not None:
                found = [self.slots[f] for f in found if f in self.slots]
            if len(word) <= KEPT_LETTERS:
                if len(self.cache) >= KEPT_WORDS:
                    self.cache.clear()
                self.cache[word] = found
        return found

    def __call__(self, text: str | None) -> tuple[int, dict[int, int]]:
        """The number of words, and how often each feature stands in the text."""
        seen: dict[int, int] = {}
        n = 0
        for m in WORD.finditer((text or "").lower()):
            n += 1
            for f in self._of(m[0]):
                seen[f] = seen.get(f, 0) + 1
        return n, seen


def rates(counts: np.ndarray, n: int) -> np.ndarray:
    return np.minimum(counts * (PER / (n + LEAST)), MOST)


@dataclass
class Model:
    """``features[k]`` has weight ``weights[k]``; without positives ``bias`` is None."""

    features: list[int]
    weights: np.ndarray
    bias: float | None
    prior: float


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Sparse rows: row ``at[j]`` has ``value[j]`` in column ``col[j]``."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.n, self.width = len(rows), width
        self.at = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
        self.col = np.concatenate([c for c, _ in rows]) if rows else np.zeros(0, np.int64)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, w[self.col] * self.value, self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.col, g[self.at] * self.value, self.width), g.sum())


def risk(theta: np.ndarray, pos: Rows, unl: Rows, pi: float, convex: bool = False) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The positive and the negative part of the risk and their gradients, by sigmoid or (``convex``) logistic loss; ``theta`` ends with the intercept."""
    f, g = (rows.dot(theta[:-1]) + theta[-1] for rows in (pos, unl))
    p, u = sigmoid(f), sigmoid(g)
    if convex:
        negative = np.logaddexp(0, g).mean() - pi * np.logaddexp(0, f).mean()
        return pi * np.logaddexp(0, -f).mean(), negative, pos.back(-pi * (1 - p) / pos.n), unl.back(u / unl.n) - pos.back(pi * p / pos.n)
    up, uu = p * (1 - p) / pos.n, u * (1 - u) / unl.n
    return pi * (1 - p).mean(), u.mean() - pi * p.mean(), pos.back(-pi * up), unl.back(uu) - pos.back(pi * up)


def fit(pos: Rows, unl: Rows, pi: float, warm: int = 100, steps: int = 300, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights and intercept that lower the non-negative risk, by full-batch Adam steps.

    The first ``warm`` steps take the logistic loss, which is convex and does not flatten where all scores are low.
    """
    theta = np.zeros(pos.width + 1)
    theta[-1] = -1.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    shrink = np.append(np.full(pos.width, decay), 0.0)
    for t in range(1, steps + 1):
        _, negative, g_pos, g_neg = risk(theta, pos, unl, pi, convex=t <= warm)
        g = (g_pos + g_neg if negative >= 0 else -g_neg) + shrink * theta
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return theta


def toxic_labels(labels: DataFrame) -> DataFrame:
    """(id, toxic) of the labelled rows to learn from."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held(F.col("doc_id")))
    return known.groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))


def _draw(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("draw"), doc_id.cast("string")), F.lit(SCALE))


def sample(docs: DataFrame, known: DataFrame, positives: int, unlabelled: int) -> DataFrame:
    """(key, positive, even, text): about ``positives`` toxic and ``unlabelled`` rows of those to learn from; the latter, drawn evenly from all, are ``even``."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).where(~is_held(F.col("doc_id")))
    share = lambda bound, n: F.lit(int(min(1.0, bound / max(n, 1)) * SCALE))
    toxic = known.where("toxic = 1").select("id")
    toxic = toxic.where(_draw(F.col("id")) < share(positives, toxic.count()))  # bounded, so it may be broadcast
    marked = rows.join(F.broadcast(toxic), F.col("doc_id") == F.col("id"), "left").withColumn("positive", F.col("id").isNotNull())
    even = F.coalesce(_draw(F.col("doc_id")) < share(unlabelled, rows.select("doc_id").count()), F.lit(False))
    drawn = marked.withColumn("even", even).where(F.col("positive") | F.col("even"))
    return stored(drawn.select(F.xxhash64("doc_id", "text").alias("key"), "positive", "even", "text"), "tox-sample")


def feature_counts(drawn: DataFrame) -> DataFrame:
    """(feature, p, u): in how many toxic and other rows of the sample each feature stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, held = Counter(), np.zeros((2, DIM), np.int64)
        for batch in batches:
            for positive, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen = count(text.as_py())[1]
                held[0 if positive else 1, np.fromiter(seen, np.int64, len(seen))] += 1
        some = np.flatnonzero(held.any(axis=0))
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(held[0, part]), pa.array(held[1, part])], names=["feature", "p", "u"])

    partial = drawn.select("positive", "text").mapInArrow(run, "feature long, p long, u long")
    return partial.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def sample_rows(drawn: DataFrame, slots: dict[int, int]) -> DataFrame:
    """(key, positive, even, n, slots, counts) of each row of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(slots)
        for batch in batches:
            found = [count(x.as_py()) for x in batch.column(3)]
            lists = [pa.array([list(f(seen)) for _, seen in found], pa.list_(pa.int64())) for f in (dict.keys, dict.values)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([n for n, _ in found], pa.int64()), *lists], names=["key", "positive", "even", "n", "slots", "counts"])

    return drawn.mapInArrow(run, "key long, positive boolean, even boolean, n long, slots array<long>, counts array<long>")


def train(docs: DataFrame, labels: DataFrame, positives: int = 8000, unlabelled: int = 24000, features: int = 1000, least: int = 3, prior: float | None = None) -> Model:
    known = stored(toxic_labels(labels), "tox-labels")
    n_known, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    pi = prior if prior is not None else n_toxic / max(n_known, 1)
    drawn = sample(docs, known, positives, unlabelled)
    sizes = {r.positive: r.n for r in drawn.groupBy("positive").agg(F.count("*").alias("n")).collect()}  # two rows
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_unl or not 0 < pi < 1:
        return Model([], np.zeros(0), None, pi)
    p, u = F.col("p") / n_pos, (F.col("p") + F.col("u")) / (n_pos + n_unl)
    unlike = (p - u) / F.sqrt(u * (1 - u) / n_pos + 1 / n_pos**2)
    picked = feature_counts(drawn).where(F.col("p") >= least).select("feature", F.round(unlike, 9).alias("z")).orderBy(F.desc("z"), "feature").limit(features)
    kept = [r.feature for r in picked.collect()]  # at most ``features`` numbers
    found = sample_rows(drawn, {f: k for k, f in enumerate(kept)}).toPandas().sort_values("key", kind="stable")
    vectors = [(np.asarray(s, np.int64), rates(np.asarray(c, np.float64), n)) for n, s, c in zip(found["n"], found["slots"], found["counts"], strict=True)]
    pos, unl = (Rows([v for v, marked in zip(vectors, found[c], strict=True) if marked], len(kept)) for c in ("positive", "even"))
    theta = fit(pos, unl, pi)  # unlabelled text holds toxic text too
    return Model(kept, theta[:-1], float(theta[-1]), pi)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, rounded to six places) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    slots, weights, bias = {f: k for k, f in enumerate(model.features)}, model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(slots)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for k, text in enumerate(batch.column(1) if bias is not None else ()):
                n, seen = count(text.as_py())
                order = sorted(seen)  # one order of summing, so that equal texts score alike
                out[k] = weights[order] @ rates(np.array([seen[f] for f in order], np.float64), n) + bias if order else bias
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(sigmoid(out), 6) if bias is not None else out)], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5 on) of every row."""
    scored = score(docs, train(docs, labels, **options))
    return scored.select("doc_id", is_held(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
