"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is over characters as they stand (any script, case kept), with n-grams of up
to ``ORDER`` of them, by language. Its tables are keyed by (lang, n-gram), grow with the
trusted text and stay sharded:

1. Rows are dealt to blocks of bounded rows and bytes, which are written in buckets, so that
   no text is shuffled afterwards. Each block gives its distinct n-grams, with how often
   they stand in its training rows.
2. Sums over blocks are the counts. Continuation counts, discounts and context totals are
   aggregates of them, and the n-grams that occur anywhere get their probabilities by
   joins with those tables, from the shortest to the longest.
3. Joined with each block's n-grams, the probabilities return to the blocks, where every
   document gets two perplexities: that of the whole text, and that of its worst
   ``WINDOW`` characters in a row, which a few strange words in a long text do not leave.

Documents are kept unless either lies outside quantiles of the language's trusted
documents, by length band. The upper quantiles come from ``1 / HELD`` of the trusted
documents, chosen by hash, which the counts don't contain; the lower one from all of them,
since counted documents surprise less. Trusted rows are those of ``labels`` with quality 1
and toxic 0.

Surprises are rounded to millionths of a nat and summed as integers, so results don't
depend on the order of rows. A value that equals a limit is inside it.

Nulls: a null text is empty; a null language is a language of its own; null labels and
null ids are not trusted. Documents under ``min_chars``, and all documents of a language
with fewer than ``MIN_LANG`` held-out trusted ones, are kept with what perplexity they
have (null without a model). Very long texts are
scored whole, in slices; they stand in blocks of fewer rows. Repeated rows are scored alike; repeated trusted rows
count as often as they stand there, a document with several labels once. An empty table
gives an empty result. Extra columns of any name are passed on by ``filter_quality`` and
not read by ``classify``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, stored, stored_by

#: Orders of 4, 5, 6 and 8 catch the same labelled documents; the tables grow about threefold with each.
ORDER, WINDOW = 4, 8
#: A block has at most 2 ** BLOCK_ROWS_LOG2 rows of up to BLOCK_ROW_BYTES; rows of up to twice the bytes have blocks of half the rows, and so on, so no block is above 512 MB (or one row).
BLOCK_ROWS_LOG2, BLOCK_ROW_BYTES = 14, 32 << 10
#: One in so many trusted documents is held out for the limits.
HELD = 4
#: Held-out trusted documents that a length band, and a language, need for limits of their own.
MIN_BAND, MIN_LANG = 20, 8
LOW, HIGH, HIGH_WORST = 0.0005, 0.985, 0.975
NO_LANG = "?"
SLICE_CHARS = 1 << 20
NATS = 1_000_000
PAD = "\0"


def blocked(docs: DataFrame, whole_rows: bool) -> DataFrame:
    """(block, at, row): the rows of ``docs``, or the three columns that are read, in blocks."""
    rows = docs if whole_rows else docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.octet_length(F.col("row.text").cast("string")), F.lit(0))
    wide = F.least(F.greatest(F.ceil(F.log2(size / BLOCK_ROW_BYTES)), F.lit(0)), F.lit(BLOCK_ROWS_LOG2)).cast("int")  # null for an empty text
    dealt = packed(rows, at=F.monotonically_increasing_id()).withColumn("_wide", F.coalesce(wide, F.lit(0)))
    # the row's number without as many low bits as rows of its width share a block, and the width in the top bits
    block = F.expr(f"shiftleft(cast(_wide AS bigint), 58) + shiftright(at, {BLOCK_ROWS_LOG2} - _wide)")
    return stored_by(dealt.withColumn("block", block).select("row", "at", "block"), "block", "lm-blocks")


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def roles(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """(block, at, held) of the trusted rows; held rows are for the limits, the others for the counts."""
    ids = blocks.select("block", "at", F.col("row.doc_id").alias("doc_id"))
    held = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(HELD)) == 0
    return stored(ids.join(trusted_ids(labels), "doc_id").select("block", "at", held.alias("held")), "lm-roles")


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= SLICE_CHARS or k == len(texts) - 1:
            yield first, texts[first : k + 1]
            first, held = k + 1, 0


def _grams(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The n-gram that ends at each character of the texts, as UTF-32 bytes, and the number of characters up to the end of each text."""
    pad = PAD * (ORDER - 1)
    codes = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le", "replace"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    place = np.arange(ends[-1]) + np.repeat(np.arange(len(texts)) * (ORDER - 1), size)
    flat = np.lib.stride_tricks.sliding_window_view(codes, ORDER)[place]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * ORDER), len(place), [None, pa.py_buffer(np.ascontiguousarray(flat))]), ends


def _spelt(grams: pa.Array) -> list[str]:
    whole = b"".join(grams.to_pylist()).decode("utf-32-le", "replace")
    return [whole[i : i + ORDER] for i in range(0, len(whole), ORDER)]


def _texts(rows: pa.StructArray) -> tuple[list[str], list[str]]:
    return [NO_LANG if x is None else x for x in rows.field("lang").cast(pa.string()).to_pylist()], [x or "" for x in rows.field("text").cast(pa.string()).to_pylist()]


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def block_grams(blocks: DataFrame, trusted: DataFrame) -> DataFrame:
    """(block, lang, g, c): the distinct n-grams of each block, and how often training rows have them."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"block": pa.array([], pa.int64()), "lang": pa.array([], pa.string()), "g": pa.array([], pa.string()), "c": pa.array([], pa.int64())})
        if left.num_rows == 0:
            return empty
        langs, texts = _texts(_one(left.column("row")))
        training = set(right.filter(pc.invert(right.column("held"))).column("at").to_pylist())
        groups: dict[tuple[str, bool], list[str]] = {}
        for lang, text, at in zip(langs, texts, left.column("at").to_pylist(), strict=True):
            if text:
                groups.setdefault((lang, at in training), []).append(text)
        out = [empty.select(["lang", "g", "c"])]
        for (lang, trained), own in groups.items():
            parts = []
            for _, part in _slices(own):
                seen = _grams(part)[0].value_counts()
                c = seen.field("counts") if trained else pa.array(np.zeros(len(seen), np.int64))
                parts.append(pa.table({"g": seen.field("values").cast(pa.binary()), "c": c}))
            total = pa.concat_tables(parts).group_by("g").aggregate([("c", "sum")])
            spelt = _spelt(_one(total.column("g")))
            out.append(pa.table({"lang": pa.array([lang] * len(spelt), pa.string()), "g": pa.array(spelt, pa.string()), "c": _one(total.column("c_sum"))}))
        rows = pa.concat_tables(out).group_by(["lang", "g"]).aggregate([("c", "sum")])
        block = pa.array(np.full(rows.num_rows, left.column("block")[0].as_py(), np.int64))
        return pa.table({"block": block, "lang": _one(rows.column("lang")), "g": _one(rows.column("g")), "c": _one(rows.column("c_sum"))})

    left = blocks.select("block", "at", F.struct("row.lang", "row.text").alias("row"))
    return left.groupBy("block").cogroup(trusted.groupBy("block")).applyInArrow(count, "block long, lang string, g string, c long")


def kneser_ney(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``counts`` (lang, g, c): (lang, n, g, alpha), the discounted share of each n-gram in its context, and (lang, n, ctx, gamma), the weight that contexts leave to shorter n-grams.

    The context of single characters is empty; what it leaves is shared evenly by the
    language's characters and one that stands for all others. Where many n-grams recur, the
    discounts can come out as zero; a context that would leave nothing then has the usual half
    counts taken off, so that every n-gram has a probability.
    """
    levels, at = [], counts.select("lang", "g", "c").withColumn("n", F.lit(ORDER))
    levels.append(at)
    for n in range(ORDER - 1, 0, -1):  # a shorter n-gram counts the distinct characters that stand before it
        at = at.groupBy("lang", F.substring("g", 2, n).alias("g")).agg(F.count("*").alias("c")).withColumn("n", F.lit(n))
        levels.append(at)
    grams = stored(reduce(DataFrame.unionByName, levels).withColumn("ctx", F.substring("g", F.lit(1), F.col("n") - 1)), "lm-grams")
    ones = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in range(1, 5)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    usual = lambda k: F.when((F.col(f"n{k}") > 0) & (F.col("n1") > 0), F.greatest(F.lit(0.0), F.least(F.lit(float(k)), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")))).otherwise(k * 0.5)
    cuts = stored(grams.groupBy("lang", "n").agg(*ones).select("lang", "n", *[usual(k).alias(f"d{k}") for k in (1, 2, 3)]), "lm-discounts")
    many = [F.sum((F.col("c") == k).cast("long")).alias(f"m{k}") for k in (1, 2)] + [F.sum((F.col("c") > 2).cast("long")).alias("m3")]
    totals = stored(grams.groupBy("lang", "n", "ctx").agg(F.sum("c").alias("total"), *many), "lm-contexts").join(cuts, ["lang", "n"])
    taken = F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")
    totals = totals.withColumn("_none", taken <= 0)
    totals = totals.select("lang", "n", "ctx", "total", "m1", "m2", "m3", *[F.when(F.col("_none"), k * 0.5).otherwise(F.col(f"d{k}")).alias(f"d{k}") for k in (1, 2, 3)])
    gamma = taken / F.col("total")
    cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    alpha = F.greatest(F.lit(0.0), F.col("c") - cut) / F.col("total")
    alphas = grams.join(totals, ["lang", "n", "ctx"]).select("lang", "n", "g", alpha.alias("alpha"))
    symbols = F.when(F.col("n") == 1, F.col("m1") + F.col("m2") + F.col("m3") + 1)
    return stored(alphas, "lm-alphas"), stored(totals.select("lang", "n", "ctx", gamma.alias("gamma"), symbols.alias("symbols")), "lm-gammas")


def probabilities(wanted: DataFrame, alphas: DataFrame, gammas: DataFrame) -> DataFrame:
    """(lang, g, p) for each distinct (lang, g) of ``wanted`` whose language has a model."""
    share = lambda n: alphas.where(F.col("n") == n).select("lang", "g", "alpha")
    rest = lambda n: gammas.where(F.col("n") == n).select("lang", "ctx", "gamma")
    suffix = lambda n: F.substring("g", ORDER - n + 1, n)
    seen = F.coalesce("alpha", F.lit(0.0))
    start = gammas.where(F.col("n") == 1).select("lang", (F.col("gamma") / F.col("symbols")).alias("even"))
    p = wanted.select("lang", suffix(1).alias("g")).distinct().join(start, "lang").join(share(1), ["lang", "g"], "left").select("lang", "g", (seen + F.col("even")).alias("p"))
    for n in range(2, ORDER + 1):
        own = wanted.select("lang", suffix(n).alias("g")).distinct().withColumns({"ctx": F.substring("g", 1, n - 1), "tail": F.substring("g", 2, n - 1)})
        lower = stored(p, f"lm-p{n - 1}").select("lang", F.col("g").alias("tail"), F.col("p").alias("lower"))
        joined = own.join(lower, ["lang", "tail"]).join(rest(n), ["lang", "ctx"], "left").join(share(n), ["lang", "g"], "left")
        p = joined.select("lang", "g", (seen + F.coalesce("gamma", F.lit(1.0)) * F.col("lower")).alias("p"))
    return stored(p, f"lm-p{ORDER}")


def surprises(blocks: DataFrame, trusted: DataFrame) -> DataFrame:
    """(block, lang, g, s): the surprise of each block's n-grams in millionths of a nat."""
    grams = stored(block_grams(blocks, trusted), "lm-block-grams")
    totals = stored(grams.groupBy("lang", "g").agg(F.sum("c").alias("c")), "lm-counts")
    p = probabilities(totals, *kneser_ney(totals.where("c > 0")))
    s = F.round(-F.log("p") * NATS).cast("long")
    return grams.select("block", "lang", "g").join(p.select("lang", "g", s.alias("s")), ["lang", "g"])


def _measure(texts: list[str], grams: pa.Array, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The summed surprise of each text, and the largest of ``WINDOW`` characters in a row (of all, in a shorter text)."""
    whole, worst = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for first, part in _slices(texts):
        keys, ends = _grams(part)
        upto = np.concatenate([[0], np.cumsum(s[pc.index_in(keys, value_set=grams).to_numpy()])])
        for k, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True), first):
            w = min(WINDOW, b - a)
            whole[k] = upto[b] - upto[a]
            worst[k] = (upto[a + w : b + 1] - upto[a : b + 1 - w]).max()
    return whole, worst


def score(blocks: DataFrame, s: DataFrame) -> DataFrame:
    """(block, at, doc_id, lang, n_symbols, perplexity, worst) of every row."""
    kind = blocks.select("row.doc_id").schema[0].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = _one(left.column("row")) if left.num_rows else pa.array([], left.schema.field("row").type)
        langs, texts = _texts(rows)
        n = np.array([len(t) for t in texts], np.int64)
        whole, worst, known = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n), bool)
        names = np.array(langs, object)
        for lang in set(langs):
            own = right.filter(pc.equal(right.column("lang"), lang))
            at = np.flatnonzero((names == lang) & (n > 0))
            if own.num_rows == 0 or len(at) == 0:
                continue
            flat = np.frombuffer("".join(own.column("g").to_pylist()).encode("utf-32-le"), np.uint8)
            grams = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * ORDER), own.num_rows, [None, pa.py_buffer(flat)])
            whole[at], worst[at] = _measure([texts[k] for k in at], grams, own.column("s").to_numpy())
            known[at] = True
        size = np.maximum(n, 1)
        mean = lambda x, k: pa.array(np.where(known, np.exp(x / k / NATS), 0.0), mask=~known)
        return pa.table({"block": left.column("block"), "at": left.column("at"), "doc_id": rows.field("doc_id"), "lang": rows.field("lang").cast(pa.string()),
                         "n_symbols": pa.array(n), "perplexity": mean(whole, size), "worst": mean(worst, np.minimum(size, WINDOW))})

    left = blocks.select("block", "at", F.struct("row.doc_id", "row.lang", "row.text").alias("row"))
    return left.groupBy("block").cogroup(s.groupBy("block")).applyInArrow(run, f"block long, at long, doc_id {kind}, lang string, n_symbols long, perplexity double, worst double")


def band(n_symbols: Column) -> Column:
    return F.least(F.floor(F.log2(F.greatest(n_symbols, F.lit(1)))), F.lit(12)).cast("int")


def limits(scored: DataFrame, trusted: DataFrame, low: float, high: float, high_worst: float) -> DataFrame:
    """(lang, band, least, most, most_worst): what the trusted documents allow; band -1 is the whole language's."""
    own = scored.select("block", "at", "lang", "n_symbols", "perplexity", "worst").join(trusted, ["block", "at"]).where(F.col("perplexity").isNotNull())
    both = own.withColumn("band", F.explode(F.array(band(F.col("n_symbols")), F.lit(-1))))
    cut = lambda c, q: F.percentile_approx(c, q, 10000)
    held = lambda c: F.when(F.col("held"), F.col(c))
    rows = both.groupBy("lang", "band").agg(
        cut("perplexity", low).alias("least"), cut(held("perplexity"), high).alias("most"), cut(held("worst"), high_worst).alias("most_worst"), F.count(held("perplexity")).alias("n"))
    return rows.where(F.col("n") >= F.when(F.col("band") < 0, MIN_LANG).otherwise(MIN_BAND)).drop("n")


def judged(blocks: DataFrame, labels: DataFrame, low: float, high: float, high_worst: float, min_chars: int) -> DataFrame:
    """The scores with least, most, most_worst and kept."""
    trusted = roles(blocks, labels)
    scored = stored(score(blocks, surprises(blocks, trusted)), "lm-scores")
    cuts = stored(limits(scored, trusted, low, high, high_worst), "lm-limits")
    names = ("least", "most", "most_worst")
    side = lambda k, where: cuts.where(where).select(F.col("lang").alias(f"_l{k}"), F.col("band").alias(f"_b{k}"), *[F.col(c).alias(f"_{c}{k}") for c in names])
    own, whole = side(1, F.col("band") >= 0), side(2, F.col("band") < 0)
    joined = scored.join(own, F.col("lang").eqNullSafe(F.col("_l1")) & (band(F.col("n_symbols")) == F.col("_b1")), "left").join(whole, F.col("lang").eqNullSafe(F.col("_l2")), "left")
    joined = joined.select(*scored.columns, *[F.coalesce(f"_{c}1", f"_{c}2").alias(c) for c in names])
    inside = F.col("perplexity").between(F.col("least"), F.col("most")) & (F.col("worst") <= F.col("most_worst"))
    return joined.withColumn("kept", (F.col("n_symbols") < min_chars) | F.coalesce(inside, F.lit(True)))


def classify(docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH, high_worst: float = HIGH_WORST, min_chars: int = 40) -> DataFrame:
    """doc_id, lang, n_symbols, both perplexities, their limits and kept for every row."""
    return judged(blocked(docs, False), labels, low, high, high_worst, min_chars).drop("block", "at")


def filter_quality(docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH, high_worst: float = HIGH_WORST, min_chars: int = 40) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; the rejected places come to the blocks by a join on what they are bucketed by, so no text is shuffled."""
    blocks = blocked(docs, True)
    gone = judged(blocks, labels, low, high, high_worst, min_chars).where(~F.col("kept"))
    gone = stored(gone.groupBy("block").agg(F.collect_list("at").alias("_gone")), "lm-rejected")  # at most a block's rows each
    return blocks.join(gone, "block", "left").where(~F.coalesce(F.array_contains("_gone", F.col("at")), F.lit(False))).select("row.*")
