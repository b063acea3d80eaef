"""Ranked lexical search, score-at-a-time over impact-ordered postings.

Terms are runs of ASCII letters and digits and of any characters beyond ASCII, A-Z lower-cased. With N documents that
have terms, L terms in all, n terms in a document, tf of one of them and df documents that hold it, a posting's impact is
the integer (10**9 * tf) div (1000 * tf + 8 * m), m = 25 + (75 * n * N) div L, and an item's score of a document is the sum over
its terms, repeats included, of floor(1000 * ln((2 * N + 2) / (2 * df + 1))) times impact.

Documents are read once for a block of items: tasks count the block's terms and write one row a document with them,
an index that holds no text. N, L and df are sums over it. Then each task takes its rows in shards of at most ``SHARD``
postings and orders a shard's postings by term and impact, in groups of one exact impact. An item takes the groups of its
terms in descending contribution, a level at a time. What the next group of each term could add, summed, bounds what any
document may still gain. The item stops only when the k-th best sum so far exceeds that bound, so that no document that was
not met can enter, nor tie; all documents whose sum and the bound together reach the k-th are completed from the
shard's rows to their exact scores. The best k of every shard meet in one ranking an item, of which Spark sends at most k a task.

Common terms, copies and long documents are spread with the documents, so no term or key gathers in one task. Items go in
blocks of about ``BLOCK`` (item, term) pairs, which bound what is broadcast and collected; more items mean more blocks.

Nulls: a null text has no terms, a null item text no results; null ids are ids, ranked after others of equal score. Rows
that share an id are documents, or items, of their own; equal items are one. Equal scores go by ascending doc_id. Terms that stand in
all documents may weigh 0; documents of score 0 are not ranked. Very long texts are counted whole. Empty tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

SHARD, BLOCK = 2_000_000, 200_000
#: A level takes all groups that contribute at least this share of the largest one left.
LEVEL = 0.6
#: Separators become blanks and capitals small letters; bytes of characters beyond ASCII stay.
PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(PLAIN).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(key, item_id, term, q): how often each distinct item has each of its terms; ``term`` is UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(terms_of(x.as_py())) for x in batch.column(1).cast(pa.binary())]
            at = pa.array(np.repeat(np.arange(len(counts)), [len(c) for c in counts]))
            term, q = pa.array([t for c in counts for t in c], pa.binary()), pa.array([n for c in counts for n in c.values()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), term, q], names=["key", "term", "q"])

    return items.select("key", "text").mapInArrow(run, "key long, term binary, q long")


def index(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs): each document's length, and which of ``terms``, by number, it holds how often."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for batch in batches:
            n, keys, values = [], [], []
            for x in batch.column(1).cast(pa.binary()):
                found = terms_of(x.as_py())
                tf = Counter(map(slots.get, found))
                tf.pop(None, None)
                n.append(len(found))
                keys.append(list(tf))
                values.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


class Shard:
    """Documents with their postings, by document and by (term, exact impact)."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_terms: int, docs: int, length: int):
        m = 25 + (75 * n * docs) // length
        self.size, self.of_term = len(n), terms
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        doc = np.repeat(np.arange(len(n)), sizes)
        self.worth = (10**9 * tfs) // (1000 * tfs + 8 * m[doc])
        order = np.lexsort((-self.worth, terms))
        self.doc, impact, term = doc[order], self.worth[order], terms[order]
        new = np.ones(len(order), bool)
        new[1:] = (term[1:] != term[:-1]) | (impact[1:] != impact[:-1])
        at = np.flatnonzero(new)
        self.impact, self.begin = impact[at], np.append(at, len(order))  # of each group
        self.groups = np.searchsorted(term[at], np.arange(n_terms + 1))  # of each term

    def completed(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Whole scores of ``docs``, none of which is without postings."""
        sizes = self.start[docs + 1] - self.start[docs]
        first = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(first - self.start[docs], sizes)
        return np.add.reduceat(weight[self.of_term[at]] * self.worth[at], first)

    def best(self, terms: np.ndarray, weights: np.ndarray, every: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, the ``k`` best and all that tie with them among them, and their scores; ``every`` has ``weights`` at ``terms``, else 0."""
        at, end = self.groups[terms], self.groups[terms + 1]
        some = (end > at) & (weights > 0)
        at, end, weights = at[some], end[some], weights[some]
        last, total = end - 1, np.zeros(self.size, np.int64)
        while True:
            left = np.where(at < end, weights * self.impact[np.minimum(at, last)], 0)
            bound = left.sum()
            if bound == 0:
                found = np.flatnonzero(total)
                return found, total[found]
            kth = np.partition(total, -k)[-k] if self.size >= k else 0
            if kth > bound:
                found = np.flatnonzero(total + bound >= kth)
                return found, self.completed(found, every)
            level = max(int(left.max() * LEVEL), 1)
            for j in np.flatnonzero(left >= level):
                upto = at[j] + np.searchsorted(-self.impact[at[j] : end[j]], -(-(-level // weights[j])), side="right")
                places = slice(self.begin[at[j]], self.begin[upto])
                total[self.doc[places]] += weights[j] * np.repeat(self.impact[at[j] : upto], np.diff(self.begin[at[j] : upto + 1]))  # a document stands once a term
                at[j] = upto


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, 4096):
            part = batch.slice(first, 4096)
            held.append(part)
            size += len(pc.list_flatten(part.column(2))) + part.num_rows
            if size >= SHARD:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _block(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(key, doc_id, score): of every shard the best ``k`` documents for each item of ``wanted`` (key, term, q), which are few enough to collect."""
    rows = wanted.collect()
    terms = sorted({bytes(r.term) for r in rows})
    slot = {t: i for i, t in enumerate(terms)}
    indexed = stored(index(docs, terms), "search-index")
    n_docs, length = indexed.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for r in indexed.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # at most the block's terms
        df[r.term] = r.df
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    items: dict[int, list[tuple[int, int]]] = {}
    for r in rows:
        items.setdefault(r.key, []).append((slot[bytes(r.term)], r.q))
    asked = []
    for key, found in sorted(items.items()):
        own = np.array(sorted(found), np.int64)
        asked.append((key, own[:, 0], own[:, 1] * weight[own[:, 0]]))
    shared = docs.sparkSession.sparkContext.broadcast(asked)
    n_terms, kind = len(terms), docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _shards(batches):
            held = table.filter(pc.greater(pc.list_value_length(table["terms"]), 0)).combine_chunks()
            if held.num_rows == 0:
                continue
            flat = lambda name: pc.list_flatten(held[name]).to_numpy().astype(np.int64)  # noqa: E731, B023
            sizes = pc.list_value_length(held["terms"]).to_numpy().astype(np.int64)
            shard = Shard(held["n"].to_numpy(), sizes, flat("terms"), flat("tfs"), n_terms, n_docs, length)
            every = np.zeros(n_terms, np.int64)
            for key, own, weights in shared.value:
                every[own] = weights
                found, scores = shard.best(own, weights, every, k)
                every[own] = 0
                if len(scores) > k:
                    least = np.partition(scores, -k)[-k]
                    found, scores = found[scores >= least], scores[scores >= least]
                if len(found):
                    met = pa.table({"doc_id": held["doc_id"].take(pa.array(found)), "score": scores})
                    met = met.take(pc.sort_indices(met, [("score", "descending"), ("doc_id", "ascending")])[:k])
                    yield from met.add_column(0, "key", pa.array(np.full(met.num_rows, key))).combine_chunks().to_batches()

    return indexed.mapInArrow(run, f"key long, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents for each of ``items`` (item_id, text)."""
    own = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    own = stored(own.withColumn("key", F.monotonically_increasing_id()), "search-items")
    wanted = stored(item_terms(own), "search-terms")
    blocks = -(-wanted.count() // block)
    part = F.pmod(F.xxhash64("key"), F.lit(max(blocks, 1)))
    found = [_block(docs, wanted.where(part == b), k) for b in range(blocks)]
    if not found:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return own.where("false").select("item_id", F.lit(0).alias("rank"), F.expr(f"cast(null as {kind})").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    best = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = stored(reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "search-ranked")
    return ranked.join(own.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")
