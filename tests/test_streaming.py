"""Streams of page versions: repeats, disorder and late rows give the batch's result."""

import json
import random

import pytest

from gridloom.streaming import ingest

SCHEMA = "file_name string, page_no int, version long, seen_at timestamp, text string"


def fed(spark, tmp_path, batches, delay="10 minutes"):
    """The latest pages after each batch is written and read, and the rows that every batch put out."""
    source = tmp_path / "in"
    source.mkdir()
    schema = spark.createDataFrame([], SCHEMA).schema
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for k, rows in enumerate(batches):
        (source / f"{k}.json").write_text("".join(json.dumps(dict(zip(("file_name", "page_no", "version", "seen_at", "text"), r, strict=True))) + chr(10) for r in rows))
        ingest.upsert_pages(spark, str(source), schema, target, checkpoint, buckets=2, delay=delay).awaitTermination()
    written = spark.read.parquet(target)
    return {(r.file_name, r.page_no): (r.version, r.text) for r in ingest.latest_pages(spark, target).collect()}, written.count()


def at(minute):
    return f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z"


def test_disorder_and_repeats(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    r = random.Random(4)
    rows = [("d", p, v, at(v + p % 3), f"text {v // 2} of {p}") for p in range(6) for v in range(1, 7)]
    sent = rows + r.sample(rows, 12)
    r.shuffle(sent)
    got, n = fed(spark, tmp_path, [sent[k : k + 16] for k in range(0, len(sent), 16)], "2 hours")
    assert got == {("d", p): (6, f"text 3 of {p}") for p in range(6)}
    assert n < len(rows)  # versions that change nothing are not written
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_late_rows_and_bounded_state(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    batches = [[("a", 1, 2, at(0), "two")], [("b", 1, 1, at(200), "far ahead")], [("a", 1, 1, at(1), "late one"), ("a", 1, 3, at(201), "three")], [("a", 1, 3, at(202), "three")]]
    got, n = fed(spark, tmp_path, batches)
    assert got == {("a", 1): (3, "three"), ("b", 1): (1, "far ahead")} and n == 3
    spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.mark.parametrize(("delay", "seconds"), [("1 hour", 3600), ("10 minutes", 600)])
def test_delays(delay, seconds):
    assert ingest.seconds_of(delay) == seconds
