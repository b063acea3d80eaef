"""MinHash near-dedup with exact links.

A document is its set of distinct ``k``-word shingles (all its words as one shingle if
it has fewer). Two documents are linked if 100 * intersection >= percent * union of
their sets, decided on the full sets.

Sets that are equal become one class first. Class representatives get candidate keys:
one-permutation MinHash with optimal densification (an empty bin takes the value of the
first filled bin in a sequence hashed from its own number), cut into bands. Sets of up
to ``SMALL`` shingles have too few filled bins for that and get keys that the pigeonhole
principle makes nearly certain: a partition of the hash range into more parts than two
linked sets may differ in, or, for the very small, the set without each one shingle.
In each bucket only star edges to one hub are candidates: the member whose buckets are
largest in sum, which in a family of copies is the text they derive from. A member x that
is not linked to its hub can still be linked to another member y. Linked sets differ in
at most t = r * (|x| + |y|) hashes, r = (100 - percent) / (100 + percent); x differs from
the hub in more than that allows, so the two differences from the hub, of dx and dy
hashes, share at least (dx + dy - t) / 2 > 0 of them, and the first they share, in
any order that is the same for both, stands within the first (dx - dy + t) / 2 + 1 of x's
and (dy - dx + t) / 2 + 1 of y's. So each comparison also gives all differences, and
members that share one for the same hub form second buckets, with stars that serve to
settle most of them: buckets of one component, or without a member unlinked to the hub,
are done. Differences of no open bucket come first in the order, then the others from the
rarest on; a member with more differences of its own than t thus meets nobody. In the open
buckets every two members of different components that pass these bounds are compared, so
that no link within a bucket is lost. All but that last step is linear in the members; it
grows with the pairs of a family that share rare differences and are still unlinked.

Components come from minimum labels with pointer jumping over stored tables; no links or
labels reach the driver.

Shingles are compared by 64-bit hashes, and only within a pair of sets or a bucket; equal
sets meet by 128 bits of all their hashes.

Nulls: a null or empty text has an empty set and no links, and is its own component; a
null id takes no part in links. Rows that share an id but not their set are nodes of their
own, with the component of their own links; rows that repeat an id and a text are one
document and stay or go together. Of members of equal weight the smaller node is
the hub. Very long texts give sets in proportion, one at a time. An empty table gives an empty result. Extra columns of
any name are passed on by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import packed, short_batches, stored, stored_by, unpacked
from .hashing import M1, M2, M3, mix, word_hashes

BINS, ROWS = 80, 4
SMALL = 128
#: About how many members of a hub one task compares with it, and how many rows Python takes at a time.
SPOKES, BATCH_ROWS = 512, 1000


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a UTF-8 text."""
    h = word_hashes(text.lower().split())  # on bytes both are ASCII only
    if len(h) == 0:
        return h
    size = min(k, len(h))
    total = np.zeros(len(h) - size + 1, np.uint64)
    for j in range(size):
        total = (total + h[j : len(h) - size + 1 + j]) * M1
        total ^= total >> np.uint64(31)
    return np.unique(mix(total + np.uint64(size)))


@lru_cache(maxsize=4)
def _ladder(percent: int) -> list[tuple[int, int, int]]:
    """Size classes (from, to, parts): no link spans more than two."""
    out, low = [], 1
    while low <= SMALL:
        high = max(low, min(SMALL, int(low * 100 / percent)))
        out.append((low, high, (100 - percent) * high // percent + 3))
        low = high + 1
    return out


@lru_cache(maxsize=1)
def _detours() -> np.ndarray:
    """For each bin the bins to look at, in turn, while it is empty."""
    i, t = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(1, 64 * BINS + 1, dtype=np.uint64), indexing="ij")
    return ((mix(i * M1 + t * M2) >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)


def signature(s: np.ndarray) -> np.ndarray:
    """One permutation: the smallest hash in each bin of the hash range, densified."""
    edges = np.searchsorted(((s >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32), np.arange(BINS + 1, dtype=np.uint64))
    filled = edges[1:] > edges[:-1]
    out = np.zeros(BINS, np.uint64)
    out[filled] = s[edges[:-1][filled]]
    empty = np.flatnonzero(~filled)
    if len(empty):
        paths = _detours()[empty]
        out[empty] = out[paths[np.arange(len(empty)), np.argmax(filled[paths], axis=1)]]
    return out


def candidate_keys(s: np.ndarray, percent: int) -> np.ndarray:
    n, keys = len(s), []
    smallest = -(-percent * n // 100)
    if (100 - percent) * smallest // percent == 1 or (n - 1 >= 1 and (100 - percent) * (n - 1) // percent == 1):
        whole = s.sum(dtype=np.uint64)
        keys.append(mix(np.concatenate([[whole], whole - s]) * M2 + np.uint64(1)))
    for c, (low, high, parts) in enumerate(_ladder(percent)):
        if high < smallest or low > n or parts < 5:
            continue
        part = ((s >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(np.diff(part, prepend=-1))
        sums = np.add.reduceat(s, at)
        keys.append(mix(sums * M3 + part[at].astype(np.uint64) * M1 + np.uint64(1000 + c)))
    if n > SMALL:
        rows = signature(s).reshape(-1, ROWS)
        band = np.arange(len(rows), dtype=np.uint64) * M3
        for j in range(ROWS):
            band = mix(band * M1 + rows[:, j])
        keys.append(band)
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(text).alias("key"), text.alias("text"))


def _id_type(docs: DataFrame) -> str:
    return docs.select("doc_id").schema[0].dataType.simpleString()


def _digests(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
    return pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, key (of the text), n, s and s2 (128 bits of the set) and keys for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py() or b"", k) for x in batch.column(2).cast(pa.binary())]
            keys = [candidate_keys(s, percent).view(np.int64) for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), *_digests(sets), lists], names=["doc_id", "key", "n", "s", "s2", "keys"])

    return _narrow(docs).mapInArrow(run, f"doc_id {_id_type(docs)}, key long, n long, s long, s2 long, keys array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, s (of the set's 128 bits) and set (hashes as bytes) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x.as_py() or b"", k) for x in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), _digests(sets)[0], pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "s", "set"])

    return _narrow(docs).mapInArrow(run, f"doc_id {_id_type(docs)}, s long, set binary")


def place(node: str) -> Column:
    """What the sets are bucketed by."""
    return F.xxhash64(F.col(node))


def _equal(a: pa.Array, b: pa.Array) -> pa.Array:
    return reduce(pc.and_, [pc.equal(x, y) for x, y in zip(a.flatten(), b.flatten(), strict=True)]) if pa.types.is_struct(a.type) else pc.equal(a, b)


def compared(pairs: DataFrame, sets: DataFrame, percent: int, listed: bool = False) -> DataFrame:
    """``pairs`` (m, h) with linked, decided on the full sets, n and d (sizes of m's set and of the difference), and unlike, the differences if ``listed``.

    ``sets`` (place, node, set) is bucketed by the place of its node, so only pairs go to where sets are; that a set is the node's own and not one of the same place
    is seen when it is read. The set of h goes first and those of its m follow as a stream, so no row holds two sets and a task holds one of h. The m of one h
    are dealt over tasks of about ``SPOKES``, so a hub of many spokes is no hot key.
    """
    kind = pairs.schema["m"].dataType.simpleString()
    names = ["m", "h", "linked", "n", "d", "unlike"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            m, node = batch.column(0), batch.column(4)
            own = _equal(m, node).to_pylist()
            at, linked, n, d, unlike = [], [], [], [], []
            for k, (first, v) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3), strict=True)):
                if not own[k]:
                    continue
                p = np.frombuffer(v.as_py(), np.uint64)
                if first:
                    hub = p
                    continue
                alone = np.setxor1d(p, hub, assume_unique=True)
                both = (len(p) + len(hub) - len(alone)) // 2
                at.append(k)
                linked.append(100 * both >= percent * (both + len(alone)))
                n.append(len(p))
                d.append(len(alone))
                unlike.append((alone if listed else alone[:0]).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, unlike)]), pa.int32()), pa.array(np.concatenate(unlike) if unlike else np.zeros(0, np.int64)))
            took = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([m.take(took), batch.column(1).take(took), pa.array(linked, pa.bool_()), pa.array(n, pa.int64()), pa.array(d, pa.int64()), lists], names=names)

    stars = pairs.groupBy("h").agg(F.ceil(F.count("*") / SPOKES).alias("parts"))
    dealt = pairs.join(stars, "h").select("m", "h", F.pmod(F.xxhash64("m"), F.col("parts")).alias("salt"))
    spokes = dealt.withColumn("place", place("m")).join(sets, "place").select("m", "h", "salt", F.lit(False).alias("first"), "set", "node")
    hubs = stars.select(F.col("h").alias("m"), "h", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"))
    hubs = hubs.withColumn("place", place("h")).join(sets, "place").select("m", "h", "salt", F.lit(True).alias("first"), "set", "node")
    streamed = hubs.unionByName(spokes).repartition("h", "salt").sortWithinPartitions("h", "salt", F.desc("first"))
    return streamed.select("m", "h", "first", "set", "node").mapInArrow(run, f"m {kind}, h {kind}, linked boolean, n long, d long, unlike array<long>")


def shared_differences(at: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Places (h, key, pos, m, n, d, c) of ``at`` in the second buckets that ``links`` have not settled, up to the last that can matter, with the buckets' least loose and tied members."""
    labels = components(links).select(F.col("node").alias("m"), "label")
    named = at.join(labels, "m", "left").withColumn("c", F.coalesce("label", "m"))
    places = named.select("h", "m", "n", "d", "c", "linked", F.explode("unlike").alias("key"))
    heads = places.groupBy("h", "key").agg(F.min(F.when(~F.col("linked"), F.col("m"))).alias("loose"), F.min(F.when(F.col("linked"), F.col("m"))).alias("tied"), F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("f"))
    heads = heads.where("low <> high AND loose IS NOT NULL").select(F.col("h").alias("_h"), F.col("key").alias("_key"), "loose", "tied", "f")
    live = places.join(heads, (F.col("h") == F.col("_h")) & (F.col("key") == F.col("_key"))).drop("_h", "_key")
    own = Window.partitionBy("h", "m")
    placed = live.withColumn("pos", F.col("d") - F.count("*").over(own) + F.row_number().over(own.orderBy("f", "key")) - 1)
    most = (100 - percent) * (F.col("n") + F.col("n") * (100 / percent)) / (100 + percent)
    return stored(placed.where(F.col("pos") <= most), "near-met")


def all_links(star: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join all linked members of the buckets of ``star`` (m, h)."""
    ends = lambda x: x.where("linked").select(F.col("m").alias("a"), F.col("h").alias("b"))
    ordered = lambda x: stored(x.select(F.greatest("m", "h").alias("m"), F.least("m", "h").alias("h")).distinct(), "near-second")
    at = stored(compared(star, sets, percent, listed=True), "near-compared")
    met = shared_differences(at, ends(at), percent)
    to_loose = met.where("m <> loose").select("m", F.col("loose").alias("h"))
    to_tied = met.where("NOT linked AND tied IS NOT NULL").select("m", F.col("tied").alias("h"))
    second = ordered(to_loose.unionByName(to_tied))
    links = stored(ends(at).unionByName(ends(compared(second, sets, percent))), "near-links")
    met = shared_differences(at, links, percent).select("h", "key", "pos", "m", "n", "d", "c")
    other = met.select(*[F.col(x).alias(f"_{x}") for x in met.columns])
    t = (100 - percent) * (F.col("n") + F.col("_n"))  # times 100 + percent, as are the sides below
    within = lambda pos, more: (100 + percent) * (2 * F.col(pos) - more) <= t
    gap = F.col("d") - F.col("_d")
    meet = (F.col("h") == F.col("_h")) & (F.col("key") == F.col("_key")) & (F.col("m") > F.col("_m")) & (F.col("c") != F.col("_c")) & near(F.col("n"), F.col("_n"), percent)
    pairs = met.join(other, meet & within("pos", gap) & within("_pos", -gap)).select("m", F.col("_m").alias("h")).distinct()
    rest = stored(pairs.join(second, ["m", "h"], "left_anti"), "near-rest")
    return links.unionByName(stored(ends(compared(rest, sets, percent)), "near-links"))


def near(p: Column, q: Column, percent: int) -> Column:
    """Whether sets of these sizes can be linked."""
    return 100 * F.least(p, q) >= percent * F.greatest(p, q)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``links`` (a, b) can reach."""
    both = stored(links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "near-both")
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "near-labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("l")), "other").groupBy("node").agg(F.min("l").alias("l"))
        lower = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        nxt = stored(lower.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "near-labels")
        changed = not nxt.where(F.col("old") != F.col("label")).isEmpty()
        labels = nxt.select("node", "label")
        if not changed:
            return labels


def linked_rows(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, key, n_shingles, component_id and own (whether the row is its component's smallest node) of every row."""
    with short_batches(docs.sparkSession, BATCH_ROWS):
        return _linked_rows(docs, k, percent)


def _linked_rows(docs: DataFrame, k: int, percent: int) -> DataFrame:
    sigs = stored(signatures(docs, k, percent), "near-signatures")
    # a node is a set under the smallest id that has it; s tells sets under one id apart
    node = F.struct(F.min("doc_id").alias("id"), F.first("s").alias("s"))
    classes = stored(sigs.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("s", "s2").agg(node.alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys")), "near-classes")
    places = classes.select("rep", "n", F.explode("keys").alias("key"))
    sizes = places.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(places.join(sizes, "key"), "near-members")
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "rep").groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("rep"), F.col("n"))).alias("hub"))
    star = members.join(hubs, "key").where(F.col("rep") != F.col("hub.rep")).select(F.col("rep").alias("m"), F.col("hub.rep").alias("h")).distinct()
    involved = stored(members.select(F.col("rep.id").alias("doc_id")).distinct(), "near-involved")
    sets = shingle_sets(docs.select("doc_id", "text").join(involved, "doc_id", "left_semi"), k).groupBy("doc_id", "s").agg(F.first("set").alias("set"))
    placed = sets.select(F.struct(F.col("doc_id").alias("id"), "s").alias("node"), "set").withColumn("place", place("node"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = stored_by(placed.repartition(buckets, "place"), "place", "near-sets")  # dealt as the buckets are: one file each
    labels = components(all_links(stored(star, "near-star"), sets, percent))
    named = classes.select("s", "s2", "rep").join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").select("s", "s2", F.coalesce("label", "rep").alias("label"))
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    joined = sigs.select("doc_id", "key", "n", "s", "s2").join(stored(named, "near-named"), ["s", "s2"], "left")
    own = ~linked | ((F.col("label.id") == F.col("doc_id")) & (F.col("label.s") == F.col("s")))
    return joined.select("doc_id", "key", F.col("n").alias("n_shingles"), F.when(linked, F.col("label.id")).otherwise(F.col("doc_id")).alias("component_id"), own.alias("own"))


def link_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest linked doc_id) of every row."""
    return linked_rows(docs, k, percent).select("doc_id", "n_shingles", "component_id")


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of ``docs`` for each component: that of the smallest doc_id (of several sets under it, one). Rows without an id stay."""
    out = stored(linked_rows(docs, k, percent).where(~F.col("own")).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct(), "near-out")
    rows = packed(docs, doc_id=F.col("doc_id"), key=F.xxhash64(F.col("text").cast("string")))
    return unpacked(rows.join(out, (F.col("doc_id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left_anti"), docs)
