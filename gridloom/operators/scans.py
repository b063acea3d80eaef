"""Scans along an order, in two levels: over parts of the sorted table, then across the parts.

A window over a document puts the document into one task. Here rows are sorted across tasks by range, each task's share of
a document is a part, and what a part has to hand on (a count, a last value) is one row; so a
document of any length is scanned by many tasks, and only as many rows as there are tasks meet in one place. The sorted table is
stored, so that both levels see the same parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import stored

PART = "_part"
#: Rows a part has, about; a fixed number of parts would grow with the table.
PART_ROWS = 500_000
#: Up to which number Spark ranks rows before it shuffles them (its ``windowGroupLimitThreshold``).
MOST_RANKED = 1000


def parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``keys`` across tasks, with the number of the task in ``_part``; stored."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // PART_ROWS))
    return stored(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(PART, F.spark_partition_id()), "parts")


def _by_part(sorted_: DataFrame, *keys: str) -> DataFrame:
    """Rows for a window over ``keys`` and the part: as many tasks as parts, as the session's number of tasks would get ever larger shares."""
    n = sorted_.agg(F.max(PART)).first()[0] or 0
    return sorted_.repartition(max(int(sorted_.sparkSession.conf.get("spark.sql.shuffle.partitions")), n + 1), *keys, PART)


def _doc(df: DataFrame, name: str) -> DataFrame:
    return df.withColumnsRenamed({name: "_doc", PART: "_p"})


def _before(df: DataFrame, doc: str, values: Column, name: str) -> DataFrame:
    """(_doc, _p, name): the sum of ``values`` over the parts of the document before each."""
    each = df.groupBy(doc, PART).agg(F.sum(values).alias("_v"))
    earlier = Window.partitionBy(doc).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    return _doc(each.select(doc, PART, F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias(name)), doc)


def _same(doc: str) -> Column:
    return F.col(doc).eqNullSafe(F.col("_doc")) & (F.col(PART) == F.col("_p"))


def numbered(df: DataFrame, order: Sequence[str], name: str = "n") -> DataFrame:
    """``df`` with the place of each row, from 1, in the whole table sorted by ``order``."""
    sorted_ = parts(df.withColumn("_all", F.lit(0)), order)
    within = Window.partitionBy(PART).orderBy(*order)
    before = _before(sorted_, "_all", F.lit(1), "_before")
    placed = _by_part(sorted_).withColumn(name, F.row_number().over(within)).join(before, _same("_all"))
    return placed.withColumn(name, F.col(name) + F.col("_before")).select(*df.columns, name)


def summed_before(df: DataFrame, order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """``df`` with, under each name, the sum of the value over all rows of the table before the row in ``order``; 0 before the first."""
    sorted_ = parts(df.withColumn("_all", F.lit(0)), order)
    within = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = _by_part(sorted_).withColumns({name: F.coalesce(F.sum(value).over(within), F.lit(0)) for name, value in values.items()})
    for k, (name, value) in enumerate(values.items()):
        out = out.join(_before(sorted_, "_all", value, f"_more{k}").withColumnsRenamed({"_doc": f"_d{k}", "_p": f"_p{k}"}), (F.col("_all") == F.col(f"_d{k}")) & (F.col(PART) == F.col(f"_p{k}")))
    return out.select(*df.columns, *[(F.col(name) + F.col(f"_more{k}")).alias(name) for k, name in enumerate(values)])


def carry_forward(df: DataFrame, doc: str, order: Sequence[str], value: Column, default: str | None = "(root)", name: str = "carried") -> DataFrame:
    """The last non-null ``value`` so far in the document; ``default`` before the first."""
    sorted_ = parts(df.withColumn("_value", value), [doc, *order])
    within = Window.partitionBy(doc, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = sorted_.where("_value IS NOT NULL").groupBy(doc, PART).agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    every = sorted_.select(doc, PART).distinct().join(_doc(held, doc), _same(doc), "left").select(doc, PART, "_last")
    earlier = Window.partitionBy(doc).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    brought = _doc(every.select(doc, PART, F.last_value("_last", ignoreNulls=True).over(earlier).alias("_brought")), doc)
    found = F.coalesce(F.last_value("_value", ignoreNulls=True).over(within), F.col("_brought"), *([] if default is None else [F.lit(default)]))
    return _by_part(sorted_, doc).join(brought, _same(doc)).withColumn(name, found).select(*df.columns, name)


def prefix_first(df: DataFrame, doc: str, order: Sequence[str], eligible: Column, value: Column, limit: int, name: str = "first_seen") -> DataFrame:
    """Per row, the first non-null value among the document's first ``limit`` eligible rows up to it."""
    rows = df.withColumn("_value", value)
    if limit <= MOST_RANKED:  # the first rows of each task are ranked before any is shuffled
        ranked = rows.where(eligible).withColumn("_n", F.row_number().over(Window.partitionBy(doc).orderBy(*order))).where(F.col("_n") <= limit)
        kept = ranked.where("_value IS NOT NULL")
    else:
        some = F.when(eligible, 1).otherwise(0)
        rows = parts(rows.withColumn("_some", some), [doc, *order])
        within = Window.partitionBy(doc, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = _by_part(rows, doc).withColumn("_n", F.sum("_some").over(within)).join(_before(rows, doc, F.col("_some"), "_before"), _same(doc))
        kept = counted.where((F.col("_some") == 1) & (F.col("_n") + F.col("_before") <= limit) & F.col("_value").isNotNull())
    first = kept.groupBy(doc).agg(F.min(F.struct(*order)).alias("_from"), F.min_by("_value", F.struct(*order)).alias("_first")).withColumnRenamed(doc, "_doc")
    first = stored(first, "firsts")  # a row a document: known to be small, it comes to the rows, which else meet by document
    joined = rows.join(first, F.col(doc).eqNullSafe(F.col("_doc")), "left")
    return joined.withColumn(name, F.when(F.struct(*order) >= F.col("_from"), F.col("_first"))).select(*df.columns, name)
