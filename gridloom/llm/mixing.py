"""Mixing sources to target weights.

Sizes are word counts. Each source's target is its weighted share of the mix, held
at ``max_repeat`` times the source (the excess is reshared by weight). The repetition
rate is target / source size: a document is emitted floor(rate) times, plus one
Bernoulli copy with the fraction as its probability. The draw is seeded by a hash of
the document's id, so reruns agree.

The draw's uniform number is 12 bits of the hash (a bin) and 40 more. The fraction is
turned into a bin and a probability inside that bin by the words that lie in the
source's bins, so that the words taken come near the target even where a few very long
documents hold much of a source. Bins are summed per (source, bin): a source with a
third of all rows spreads over 4,096 keys.

Nulls: a null text has size 0, a null source is a source of its own and comes last, a
row without an id draws by its text. Rows that share an id share their draw, whether
their texts are equal or not. Very long texts count whole. Equal caps are filled in the order of their sources; the draw
decides ties of documents. Sources of size 0 have target 0. An empty table gives an empty
result. Extra columns of any name are passed on by ``mix`` and not read by ``plan_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import scans
from .common import SPACE, packed, stored, unpacked

SEED = "mix-1"
BINS_HEX, FINE_HEX = 3, 10


def _sized(rows: DataFrame, seed: str) -> DataFrame:
    """``rows`` with what is read of their column ``row``: source, size and the hashed draw."""
    parts = F.split(F.coalesce(F.col("row.text").cast("string"), F.lit("")), SPACE)
    # split leaves one empty string at each end that starts or ends with a separator
    edge = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("row.doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col("row.text").cast("string"), F.lit("")))))))
    return rows.withColumns({
        "source": F.col("row.source"),
        "size": (F.size(parts) - edge).cast("long"),
        "_bin": F.conv(F.substring(digest, 1, BINS_HEX), 16, 10).cast("int"),
        "_fine": F.conv(F.substring(digest, 1 + BINS_HEX, FINE_HEX), 16, 10).cast("double") / float(16**FINE_HEX),
    })


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_repeat: float) -> DataFrame:
    """One row per source of ``sizes`` (source, source_size): its target in words.

    Water filling: ordered by cap / weight, the level that the sources from k on would
    share is (total - caps before k) / (weights from k on); the largest of these is the
    level at which resharing ends.
    """
    order = ["_none", "source"]
    named = scans.numbered(sizes.withColumn("_none", F.col("source").isNull()), order, "_rank")
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = named.withColumn("_w", pick).withColumn("_fill", F.lit(float(max_repeat)) * F.col("source_size") / F.col("_w"))
    sums = scans.summed_before(ranked, ["_fill", *order], {"_sizes": F.col("source_size"), "_ws": F.col("_w")})
    total, weight = sums.agg(F.sum("source_size"), F.sum("_w")).first()  # two numbers
    left = F.lit(float(share)) * F.lit(total or 0) - F.lit(float(max_repeat)) * F.col("_sizes")
    level = sums.agg(F.max(left / (F.lit(weight or 0) - F.col("_ws")))).first()[0]  # one number
    cap = F.lit(float(max_repeat)) * F.col("source_size")
    return ranked.select("source", "source_size", F.least(cap, F.lit(level).cast("double") * F.col("_w")).alias("target"))


def _planned(rows: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_repeat: float = 2.0, seed: str = SEED) -> DataFrame:
    """``rows`` (row) with source, size, source_size, target, copies and taken."""
    sized = _sized(rows, seed)
    bins = stored(sized.groupBy("source", "_bin").agg(F.sum("size").alias("_words")), "mix-bins")
    targets = source_targets(bins.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, max_repeat)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("_base", F.floor(rate)).withColumn("_need", F.col("target") - F.col("_base") * F.col("source_size"))
    upto = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        bins.withColumn("_before", F.coalesce(F.sum("_words").over(upto), F.lit(0)))
        .join(targets.select(F.col("source").alias("_s"), "_need"), F.col("source").eqNullSafe(F.col("_s")))
        .where((F.col("_words") > 0) & (F.col("_before") <= F.col("_need")) & (F.col("_need") < F.col("_before") + F.col("_words")))
        .select(F.col("source").alias("_s"), F.col("_bin").alias("_edge"), ((F.col("_need") - F.col("_before")) / F.col("_words")).alias("_p"))
    )
    per_source = stored(
        targets.join(edges, F.col("source").eqNullSafe(F.col("_s")), "left")
        .select(F.col("source").alias("_s"), "source_size", "target", "_base", F.coalesce("_edge", F.lit(-1)).alias("_edge"), F.coalesce("_p", F.lit(0.0)).alias("_p")),
        "mix-sources",
    )
    extra = ((F.col("_bin") < F.col("_edge")) | ((F.col("_bin") == F.col("_edge")) & (F.col("_fine") < F.col("_p")))).cast("long")
    return (
        sized.join(per_source, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("copies", F.col("_base").cast("long") + extra)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_s", "_bin", "_fine", "_base", "_edge", "_p")
    )


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (= copies * size) of every row."""
    planned = _planned(packed(docs.select("doc_id", "text", "source")), **options)
    return planned.select("row.doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row of ``docs`` repeated ``copies`` times."""
    planned = _planned(packed(docs), **options).where("copies > 0")
    return unpacked(planned.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), docs)
