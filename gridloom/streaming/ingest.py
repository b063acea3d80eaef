"""Streaming ingest: page artifacts as they arrive, upserted by (file_name, page_no)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


#: A page's own version is kept under another name, as the batch's number is the table's.
OWN = {"version": "page_version"}
KNOWN = "version long, digest long"


def fresh_pages(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Of a stream of page versions (file_name, page_no, version, seen_at and the page's columns) the rows that change a page.

    Each page's last version and the digest of its content are kept as state. A row passes if its version is above that
    and its content another; so repeats, and versions that come after a later one, change nothing. Of several versions in one
    batch the last passes. A page's state is let go ``delay`` after it was last seen, by the watermark, which also drops
    rows that come later than that; so the state is bounded by the pages of that span.
    """
    content = [c for c in stream.columns if c not in ("file_name", "page_no", "version", "seen_at")]
    marked = stream.withWatermark("seen_at", delay).withColumn("_digest", F.xxhash64(*content))
    span = int(1000 * seconds_of(delay))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, seen = None, 0
        for rows in batches:
            seen = max(seen, int(rows["seen_at"].max().timestamp() * 1000))
            last = rows.sort_values(["version", "_digest"], kind="stable").iloc[[-1]]
            if best is None or (int(last["version"].iloc[0]), int(last["_digest"].iloc[0])) > (int(best["version"].iloc[0]), int(best["_digest"].iloc[0])):
                best = last
        version, digest = int(best["version"].iloc[0]), int(best["_digest"].iloc[0])
        known = state.get if state.exists else None
        if known is None or version > known[0]:
            state.update((version, digest))
            if known is None or digest != known[1]:
                yield best.drop(columns="_digest")
        state.setTimeoutTimestamp(max(seen, state.getCurrentWatermarkMs()) + span)

    return marked.groupBy("file_name", "page_no").applyInPandasWithState(step, stream.schema, KNOWN, "append", GroupStateTimeout.EventTimeTimeout)


def seconds_of(delay: str) -> float:
    return pd.Timedelta(delay).total_seconds()


def upsert_pages(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, buckets: int = 64, delay: str | None = None) -> StreamingQuery:
    """Reads new JSON files and keeps the latest version of each page: the last to come, or with ``delay`` the last by its own version (see ``fresh_pages``).

    Each batch is written as one version partition, so a batch that runs again replaces
    itself; ``latest_pages`` resolves versions on read.
    """

    def write(batch: DataFrame, version: int) -> None:
        marked = batch.withColumn("bucket", F.pmod(F.xxhash64("file_name"), F.lit(buckets)))
        marked.withColumnsRenamed(OWN).write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/version={version}")

    stream = spark.readStream.schema(schema).json(source)
    if delay is not None:
        stream = fresh_pages(stream, delay)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_pages(spark: SparkSession, target: str) -> DataFrame:
    """Of each page the rows of its last version."""
    rows = spark.read.parquet(target)
    last = rows.groupBy("file_name", "page_no").agg(F.max("version").alias("version"))
    return rows.join(last, ["file_name", "page_no", "version"], "left_semi").drop("version", "bucket").withColumnsRenamed({v: k for k, v in OWN.items()})


def compact_pages(spark: SparkSession, target: str, compacted: str) -> DataFrame:
    """Writes the latest pages to a new target as its version 0, so that reads need not look at all versions; later versions are then written there."""
    rows = latest_pages(spark, target).withColumnsRenamed(OWN).withColumn("bucket", F.pmod(F.xxhash64("file_name"), F.lit(64)))
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{compacted}/version=0")
    return latest_pages(spark, compacted)
