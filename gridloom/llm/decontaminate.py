"""Benchmark decontamination: a hash set of test n-grams against all training windows.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. A window is ``size``
consecutive words of an item; an item of fewer words is one window. The 64-bit hashes of
the test windows are the only thing that may be broadcast, and only while they are
``SET_BYTES`` or less together: the windows of the texts pass by them inside the scan, no
text is shuffled, and the few that stay carry their words, which are compared with those of
the test windows. A larger set is joined with the hashes of the texts' windows, shuffled by
hash; the words of what it leaves come from the documents concerned. The results are equal.

Item lists are kept apart from the windows and joined with a document's distinct windows.

Nulls: a null text has no words, on either side; a window of a null item id is hit, but no
item is reported for it. Every input row gives one row; repeated rows, and rows that share
an id but not their text, get the results of their own text. Windows
of several items count for each of them, items are listed in the order of their ids. Very long texts are scanned
whole. An empty table on either side
gives unhit documents or no rows. Extra columns of any name are kept by ``decontaminate``
and not read by ``find_hits``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, stored, unpacked

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing.
RAW = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The largest hash set that is broadcast, at 16 bytes an entry.
SET_BYTES = 64 << 20
ROW = ["doc_id", "key"]


def item_words(text: Column) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, BREAK), "")


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.lit("doc"), text)


def _windows(n: int | Column) -> Column:
    """Each run of n words of ``ws``, joined by blanks, which no word contains."""
    starts = F.slice("ws", 1, F.greatest(F.size("ws") - (n - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.array_join(F.slice("ws", i + 1, n), " "))


def benchmark_windows(benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(n, h, window, wid), each distinct window once, and (wid, item)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    items = items.withColumn("n", F.least(F.lit(size), F.size("ws")))
    every = stored(items.select("item", "n", F.explode(_windows(F.col("n"))).alias("window")).distinct(), "bench-items")
    windows = stored(every.select("n", "window").distinct().select("n", F.xxhash64("window").alias("h"), "window", F.monotonically_increasing_id().alias("wid")), "bench-windows")
    return windows, stored(every.where("item IS NOT NULL").join(windows, ["n", "window"]).select("wid", "item"), "bench-of-items")


def _passing(scan: DataFrame, hashes: DataFrame, n: int) -> DataFrame:
    """(doc_id, key, pos, window) of the windows whose hash is in the broadcast set."""
    rows = scan.select(*ROW, F.posexplode(_windows(n)).alias("pos", "window"))
    return rows.join(F.broadcast(hashes), F.xxhash64("window") == F.col("h"), "left_semi")


def _shuffled(scan: DataFrame, hashes: DataFrame, n: int) -> DataFrame:
    """The same for a set of any size; the words come from the documents that have a hash of the set."""
    rows = scan.select(*ROW, F.posexplode(F.transform(_windows(n), lambda w: F.xxhash64(w))).alias("pos", "h"))
    places = stored(rows.join(hashes.hint("merge"), "h", "left_semi").groupBy(*ROW).agg(F.collect_set("pos").alias("at")), "bench-places")
    places = places.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "at")
    found = scan.join(places, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    return found.dropDuplicates(ROW).select(*ROW, F.explode(F.transform("at", lambda p: F.struct(p.alias("pos"), F.array_join(F.slice("ws", p + 1, n), " ").alias("window")))).alias("x")).select(*ROW, "x.*")


def find_hits(docs: DataFrame, benchmark: DataFrame, size: int = 10, set_bytes: int = SET_BYTES) -> DataFrame:
    """doc_id, key (of the text), n_words, n_hit, items (sorted ids with occurring windows) and hit (word positions) of every row."""
    windows, of_items = benchmark_windows(benchmark, size)
    per_length = {r.n: r.c for r in windows.groupBy("n").agg(F.countDistinct("h").alias("c")).collect()}  # at most ``size`` rows
    scan = docs.select("doc_id", text_key(F.col("text")).alias("key"), item_words(F.col("text")).alias("ws"))
    base = scan.select(*ROW, F.size("ws").alias("n_words"))
    passing = _passing if 16 * sum(per_length.values()) <= set_bytes else _shuffled
    parts = [passing(scan, windows.where(F.col("n") == n).select("h").distinct(), n).withColumn("n", F.lit(n)) for n in sorted(per_length)]
    none = {"hit": F.expr("cast(array() as array<int>)"), "items": F.expr("cast(array() as array<string>)")}
    if not parts:
        return base.withColumns({"n_hit": F.lit(0), **none})
    verified = stored(reduce(DataFrame.unionByName, parts).join(windows, ["n", "window"]).select(*ROW, "pos", "n", "wid").distinct(), "bench-hits")
    hit = verified.groupBy(*ROW).agg(F.flatten(F.collect_set(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1))).alias("hit"))
    items = verified.select(*ROW, "wid").distinct().join(of_items, "wid").groupBy(*ROW).agg(F.array_sort(F.collect_set("item")).alias("items"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["key"] == b["key"])
    hit = hit.select(*ROW, F.array_sort(F.array_distinct("hit")).alias("hit"))
    per_row = stored(hit.join(items, same(hit, items), "left").select(hit["doc_id"].alias("_id"), hit["key"].alias("_key"), "hit", "items"), "bench-rows")
    joined = base.join(per_row, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").drop("_id", "_key")
    return joined.withColumns({c: F.coalesce(c, x) for c, x in none.items()}).withColumn("n_hit", F.size("hit"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, drop_share: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages.

    A document of which hits cover more than ``drop_share`` goes; in others the hit words
    (with what follows each up to the next word) are cut from the text.
    """
    hits = find_hits(docs, benchmark, size).where("n_hit > 0").dropDuplicates(ROW)
    hits = stored(hits.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "hit", (F.col("n_hit") > drop_share * F.col("n_words")).alias("out")), "bench-cut")
    rows = packed(docs, doc_id=F.col("doc_id"), key=text_key(F.col("text")))
    found = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").where("NOT coalesce(out, false)")
    text = F.col("row.text").cast("string")
    pieces = F.split(text, f"(?<=[^{RAW}])(?=[{RAW}])|(?<=[{RAW}])(?=[^{RAW}])", -1)
    # Runs of word and other characters alternate: run 2k + lead is word k, the run after it what follows it.
    lead = F.when(text.rlike(f"^[{RAW}]"), 1).otherwise(0)
    # hit is sorted: ranges of consecutive positions begin where position - 1 is missing
    first = F.filter("hit", lambda p, i: (i == 0) | (F.get(F.col("hit"), i - 1) != p - 1))
    last = F.filter("hit", lambda p, i: F.coalesce(F.get(F.col("hit"), i + 1) != p + 1, F.lit(True)))
    found = found.withColumns({"runs": F.when(F.col("hit").isNotNull(), pieces), "from": F.transform(first, lambda p: p * 2 + lead), "upto": F.transform(last, lambda p: p * 2 + lead + 2)})
    starts, ends = F.concat(F.array(F.lit(0)), F.col("upto")), F.concat(F.col("from"), F.array(F.size("runs")))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice("runs", a + 1, F.greatest(b - a, F.lit(0)))))
    return unpacked(found, docs, text=F.when(F.col("hit").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "")))
