"""Substring dedup on a sparse de Bruijn graph of word k-mers.

A window is ``size`` consecutive words; a word goes if a window that covers it has the
word sequence of a window that starts anywhere else. In every window the k-mer with the
smallest hash is its anchor, so equal windows have equal anchors at equal places, and a
window whose anchor occurs once is not repeated. Anchors are the nodes of the graph, and
the words from an anchor to the next one are the edges.

1. Anchors that occur twice or more, by hash (pre-aggregated per document).
2. Of documents with such anchors: the edges before and after each occurrence. An anchor
   with one distinct edge on either side does not branch. The flags reach the documents
   through joins, and each run of edges over nonbranching anchors compacts to one path,
   which then occurs as often as its inner anchors do.
3. Source coordinates give the words of each path, and of each candidate window that is
   not inside a long path. Paths and windows are hashed over all their words, twice, with
   word hashes and bases that are independent of each other; what occurs twice or more by
   both hashes (128 bits) is removed.

Texts go through numpy in groups of some 512 KB: words are cut and hashed in the bytes of the group, never one by one.
Per-document lists hold only hashes that the document itself has. Nulls: a null text has
no words; a null id is kept. Repeated rows are occurrences elsewhere, so both lose their
windows. Windows that tie
(equal ones) are all removed, whichever row or place they stand at. Very long texts are taken whole: a
document is one row in a task, and a group of its own where it is longer than one. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import brief_shuffles, stored
from .hashing import Spans, Texts

K = 12
EDGE = 0  # stands for the start or the end of a document
AT_ONCE = 1 << 20  # places that go into the lower bits of a k-mer's hash; the same for all texts, so that equal windows have equal anchors
GROUP_BYTES = 1 << 19  # texts that numpy takes at once


def _anchors(kmers: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` k-mers the place of the smallest by its upper bits, the leftmost of equals."""
    found = [np.zeros(0, np.int64)]
    for lo in range(0, len(kmers) - width + 1, AT_ONCE - width):
        part = kmers[lo : lo + AT_ONCE - 1]
        value, have = part & ~np.uint64(AT_ONCE - 1) | np.arange(len(part), dtype=np.uint64), 1
        while have < width:
            step = min(have, width - have)
            value = np.minimum(value[: len(value) - step], value[step:])
            have += step
        found.append((value & np.uint64(AT_ONCE - 1)).astype(np.int64) + lo)
    return np.concatenate(found)


class _Docs(Texts):
    """Words, k-mers, anchors and edges of some texts. No window reaches into another text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int):
        super().__init__(data, offsets)
        self.n, self.size = len(self.starts), size
        self.spans = Spans(self.hashes())
        self.kmers = self.spans.all_of(K)
        of_window = _anchors(self.kmers, size - K + 1)
        ends = np.repeat(self.first[1:], np.diff(self.first))
        self.windows = np.flatnonzero(ends[: len(of_window)] - np.arange(len(of_window)) >= size)
        of_window = of_window[self.windows]
        new = np.diff(of_window, prepend=-1) > 0
        self.at = of_window[new]
        self.of_window = np.cumsum(new) - 1
        self.h = self.kmers[self.at]
        self.first_at = np.searchsorted(self.at, self.first)

    def again(self) -> Spans:
        """Spans by word hashes and a base that are independent of the first ones."""
        return Spans(self.hashes(other=True), 0xD6E8FEB86659FD93)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the words from the anchor before to the end of each anchor, and from each to the end of the next."""
        between = np.zeros(len(self.at) + 1, np.uint64)
        if len(self.at):
            between[1:-1] = self.spans.of(self.at[:-1], self.at[1:] + K)
        between[self.first_at] = EDGE
        return between[:-1], between[1:]

    def sequences(self, repeated: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the long paths and of the open windows.

        Paths are the runs of edges joined by anchors that do not branch. Open windows have a repeated anchor that is not
        an inner anchor inside a long path (those lie in that path wherever they occur).
        """
        inner = np.isin(self.h, plain)
        some = self.first_at[1:] > self.first_at[:-1]
        inner[self.first_at[:-1][some]] = inner[self.first_at[1:][some] - 1] = False
        cut = np.flatnonzero(~inner)
        begin, end = cut[:-1], cut[1:]
        has = end - begin > 1
        starts, ends = self.at[begin[has]], self.at[end[has]] + K
        long = ends - starts >= self.size
        starts, ends = starts[long], ends[long]
        inside = np.cumsum(np.bincount(starts, minlength=self.n + 1) - np.bincount(ends - self.size + 1, minlength=self.n + 1)) > 0
        w = self.windows[np.isin(self.h, repeated)[self.of_window] & ~(inner[self.of_window] & inside[self.windows])]
        return np.concatenate([starts, w]), np.concatenate([ends, w + self.size])

    def digests(self, texts: list[memoryview]) -> list[str]:
        return [hashlib.sha256(x).hexdigest() for x in texts]

    def each(self, marks: np.ndarray) -> np.ndarray:
        """How many words of each text are marked."""
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(marks)])[self.first]
        return upto[1:] - upto[:-1]


def _groups(text: pa.Array, size: int) -> Iterator[tuple[slice, _Docs]]:
    """The texts (null: empty) in groups of some ``GROUP_BYTES``, a longer text alone."""
    text = pc.fill_null(text.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8) if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(text):
        hi = max(int(np.searchsorted(offsets, offsets[lo] + GROUP_BYTES, "right")) - 1, lo + 1)
        yield slice(lo, hi), _Docs(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], size)
        lo = hi


def _kind(docs: DataFrame) -> str:
    return docs.select("doc_id").schema[0].dataType.simpleString()


def _lists(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.uint64, copy=False).view(np.int64)))


def _values(lists: pa.Array, of: slice) -> np.ndarray:
    """What stands in the lists of a group; a hash means the same in each of its documents."""
    return np.asarray(lists[of].flatten()).astype(np.int64, copy=False).view(np.uint64)


def _counted(doc: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the distinct values of each document, and how often it has them (2 for more)."""
    order = np.lexsort((*values, doc))
    new = np.ones(len(order), bool)
    new[1:] = np.any([np.diff(v[order]) != 0 for v in (doc, *values)], axis=0)
    at = np.flatnonzero(new)
    return order[at], np.minimum(np.diff(at, append=len(order)), 2)


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key, n_words, sha, and the distinct anchors with how often the document has each (2 for more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, group in _groups(batch.column(2), size):
                of = batch.slice(rows.start, rows.stop - rows.start)
                doc = np.repeat(np.arange(len(of)), np.diff(group.first_at))
                own, often = _counted(doc, group.h)
                bounds = np.searchsorted(doc[own], np.arange(len(of) + 1))
                sha = group.digests(group.joined(np.ones(group.n, bool)))
                yield pa.RecordBatch.from_arrays([of.column(0), of.column(1), pa.array(np.diff(group.first), pa.int64()), pa.array(sha), _lists(group.h[own], bounds), _lists(often, bounds)], names=["doc_id", "key", "n_words", "sha", "anchors", "often"])

    return docs.mapInArrow(run, f"doc_id {_kind(docs)}, key long, n_words long, sha string, anchors array<long>, often array<long>")


def _sides(held: DataFrame, size: int) -> DataFrame:
    """For the repeated anchors of each document: the least and greatest edge before and after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros((3, 0), np.uint64)]
            for of, group in _groups(batch.column(0), size):
                own = np.isin(group.h, _values(batch.column(1), of))
                out.append(np.stack([x[own] for x in (group.h, *group.edges())]))
            rows = np.concatenate(out, axis=1)
            rows = rows[:, np.argsort(rows[0], kind="stable")]
            at = np.flatnonzero(np.diff(rows[0], prepend=rows[0][:1] + np.uint64(1))) if rows.shape[1] else np.zeros(0, int)
            cols = [rows[0][at]] + [f.reduceat(rows[r], at) if len(at) else rows[r] for r in (1, 2) for f in (np.minimum, np.maximum)]
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], names=["h", "b0", "b1", "a0", "a1"])

    parts = held.select("text", "repeated").mapInArrow(run, "h long, b0 long, b1 long, a0 long, a1 long")
    return parts.groupBy("h").agg(*[F.min(c).alias(f"{c}_min") for c in ("b0", "b1", "a0", "a1")], *[F.max(c).alias(f"{c}_max") for c in ("b0", "b1", "a0", "a1")])


def _sequences(held: DataFrame, size: int) -> DataFrame:
    """key and the two hashes of each path and open window, with how often the document has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, group in _groups(batch.column(0), size):
                s, e = group.sequences(_values(batch.column(2), of), _values(batch.column(3), of))
                x, y = group.spans.of(s, e), group.again().of(s, e)
                doc = np.searchsorted(group.first, s, "right") - 1
                at, often = _counted(doc, y, x)
                yield pa.RecordBatch.from_arrays([batch.column(1)[of].take(pa.array(doc[at])), pa.array(x[at].view(np.int64)), pa.array(y[at].view(np.int64)), pa.array(often.astype(np.int32))], names=["key", "x", "y", "c"])

    return held.select("text", "key", "repeated", "plain").mapInArrow(run, "key long, x long, y long, c int")


def _cut(held: DataFrame, size: int, texts: bool) -> DataFrame:
    """doc_id, key, n_removed, kept_sha and, where asked for, kept (the words that stay) of each candidate document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, group in _groups(batch.column(2), size):
                repeated, plain, twice, both = (_values(batch.column(k), of) for k in (3, 4, 5, 6))
                s, e = group.sequences(repeated, plain)
                hit = np.flatnonzero(np.isin(group.spans.of(s, e), twice))
                hit = hit[np.isin(group.again().of(s[hit], e[hit]), both)]
                depth = np.bincount(s[hit], minlength=group.n + 1) - np.bincount(e[hit], minlength=group.n + 1)
                gone = np.cumsum(depth)[:-1] > 0
                kept = group.joined(~gone)
                cols = {"doc_id": batch.column(0)[of], "key": batch.column(1)[of], "n_removed": pa.array(group.each(gone), pa.int64()), "kept_sha": pa.array(group.digests(kept))}
                if texts:
                    cols["kept"] = pa.array([bytes(x) for x in kept], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(cols)

    return held.select("doc_id", "key", "text", "repeated", "plain", "found.x", "found.y").mapInArrow(run, f"doc_id {_kind(held)}, key long, n_removed long, kept_sha string" + ", kept string" * texts)


def _with_list(docs: DataFrame, rows: DataFrame, column: str, name: str, how: str) -> DataFrame:
    """Adds to each document the list of its hashes in ``rows`` (key, column)."""
    lists = rows.groupBy("key").agg(F.collect_list(column).alias(name))
    return docs.join(lists, "key", how)


def repeated_spans(docs: DataFrame, size: int = 35, texts: bool = True) -> tuple[DataFrame, DataFrame]:
    """(base, cut): base has doc_id, key, n_words and sha of every row; cut has n_removed, kept_sha and, with ``texts``, kept of each document that may lose words."""
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string").alias("text"))
    base = stored(_scan(keyed, size), "span-base")
    own = base.select("key", F.explode(F.arrays_zip(F.col("anchors").alias("h"), F.col("often").alias("c"))).alias("x")).select("key", "x.h", "x.c")
    twice = stored(own.groupBy("h").agg(F.sum("c").alias("c")).where("c > 1").select("h"), "span-anchors")
    mine = stored(own.select("key", "h").join(twice, "h"), "span-own").dropDuplicates()
    held = stored(_with_list(keyed, mine, "h", "repeated", "inner"), "span-held")
    sides = _sides(held, size)
    alike = [F.col(f"{c}0_min") == F.col(f"{c}1_max") for c in "ba"] + [F.col(f"{c}0_min") != EDGE for c in "ba"]
    same = [F.col(f"{c}{k}_min") == F.col(f"{c}{k}_max") for c in "ba" for k in "01"] + [F.col(f"{c}0_min") == F.col(f"{c}1_min") for c in "ba"]
    plain = stored(sides.where(reduce(lambda a, b: a & b, alike + same)).select("h"), "span-plain")
    held = stored(_with_list(held, mine.join(plain, "h"), "h", "plain", "left"), "span-graph")
    seen = stored(_sequences(held, size), "span-sequences")
    counted = stored(seen.groupBy("x", "y").agg(F.sum("c").alias("c")).where("c > 1").select("x", "y"), "span-counted")
    found = seen.join(counted, ["x", "y"]).select("key", F.struct("x", "y").alias("xy"))
    return base.select("doc_id", "key", "n_words", "sha"), _cut(_with_list(held, found, "xy", "found", "inner"), size, texts)


def cut_repeats(docs: DataFrame, size: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    with brief_shuffles(docs.sparkSession):
        base, cut = repeated_spans(docs, size, texts=False)
        cut = stored(cut.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n_removed", "kept_sha").dropDuplicates(["_id", "_key"]), "span-cut")
    joined = base.join(cut, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha", "sha").alias("kept_sha256"))
