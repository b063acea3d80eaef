"""Shared pieces of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from ..sources.scratch import TABLE, delete, new_folder, noted, scratch_root, stored_by  # noqa: F401  (stored_by for the operators)

#: What separates words: ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    This cuts the lineage, so a lost executor costs one read rather than the whole
    plan, and it gives the optimizer the true size: joins with the result broadcast
    it only while it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stores what ``make`` returns and deletes the tables that were stored on the way, also where it fails.

    The list of those tables belongs to the thread, so queries on several threads of a driver leave each other's alone.
    """
    on_the_way: list[str] = []
    token = noted.set(on_the_way)
    try:
        result = make()
        path = f"{scratch_root(spark)}/gridloom/{label}-{uuid.uuid4().hex}"
        result.write.option("compression", "zstd").parquet(path)
    finally:
        noted.reset(token)
        for old in on_the_way:
            if old.startswith(TABLE):
                spark.sql(f"DROP TABLE IF EXISTS {old.removeprefix(TABLE)}")
            else:
                delete(spark, old)
    if (outer := noted.get()) is not None:
        outer.append(path)
    return spark.read.schema(result.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, Python gets at most ``rows`` rows at a time from plans made in it; for rows that are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a table that is stored takes its shuffle files along when it is done; else they stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """``df`` as one struct column ``row`` beside the columns ``more``, so that no name of ``df`` can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(name) for name, c in more.items()])


def unpacked(df: DataFrame, like: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``like`` out of ``row``, those named in ``changed`` replaced."""
    return df.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in like.columns])


def running(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each entry what ``combine`` makes of ``zero`` and the entries before it; the last entry of the result takes in all.

    Built within blocks of about the root of the length and then across them, as arrays
    are copied when they grow.
    """
    n = F.size(values)
    step = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, step), lambda s: F.slice(values, s + 1, step))).otherwise(F.slice(F.array(values), 1, 0))

    def run(items: Column) -> Column:
        start = F.struct(zero.alias("upto"), F.slice(F.array(zero), 1, 0).alias("out"))
        return F.aggregate(items, start, lambda acc, x: F.struct(combine(acc["upto"], x).alias("upto"), F.concat(acc["out"], F.array(acc["upto"])).alias("out")))

    def join(inner: Column) -> Column:
        across = run(F.transform(inner, lambda x: x["upto"]))
        return let(across, lambda a: F.concat(F.flatten(F.zip_with(inner, a["out"], lambda x, b: F.transform(x["out"], lambda y: combine(b, y)))), F.array(a["upto"])))

    return let(F.transform(blocks, run), join)


CHUNK = 4096


def chunks(text: Column) -> Column:
    """A text in pieces of ``CHUNK`` characters, out of which ``between`` cuts without scanning from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to before ``end`` of a text in ``chunks``."""
    first = F.floor(start / CHUNK).cast("int")
    last = F.floor((end - 1) / CHUNK).cast("int")
    part = lambda k: F.substring(F.get(pieces, k), F.greatest(start - k * CHUNK, F.lit(0)) + 1, F.least(end - k * CHUNK, F.lit(CHUNK)) - F.greatest(start - k * CHUNK, F.lit(0)))
    return F.when(end > start, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise("")
