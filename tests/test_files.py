"""Files written and read by executors, and scans over parts."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators import pages, scans
from gridloom.sources import artifacts, files, sinks


def below(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names if not f.endswith(".crc"))


def test_sink_writes_from_tasks(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.range(3000).select(F.format_string("d%d/page_%03d.txt", F.col("id") % 7, F.col("id")).alias("name"), F.col("id").cast("string").alias("content"), F.lit(1).alias("more"))
    files.write_files(rows.repartition(13), root)
    assert len(below(root)) == 3000 and (tmp_path / "out/d3/page_010.txt").read_text() == "10"
    assert not [x for x in os.listdir(root) if x.startswith(".staging")]
    files.write_files(spark.createDataFrame([("d3/page_010.txt", "new"), ("x", None)], "name string, content string"), f"file://{root}")
    assert len(below(root)) == 3001 and (tmp_path / "out/d3/page_010.txt").read_text() == "new" and (tmp_path / "out/x").read_text() == ""
    files.write_files(rows.limit(2), root, overwrite=True)
    assert len(below(root)) == 2
    files.write_files(rows.limit(0), root)
    assert len(below(root)) == 2


@pytest.mark.parametrize("name", ["../x", "/x", "a//b", "", None, "a/./b"])
def test_names_stay_below_the_folder(spark, tmp_path, name):
    with pytest.raises(Exception, match="below the folder"):
        files.write_files(spark.createDataFrame([("ok", "1"), (name, "2")], "name string, content string"), str(tmp_path / "out"))
    assert below(tmp_path) == []


def test_a_failed_or_repeated_attempt_leaves_nothing(tmp_path, monkeypatch):
    import pyarrow as pa

    class Task:
        number = 0

        def partitionId(self):
            return 0

        def taskAttemptId(self):
            Task.number += 1
            return Task.number

    monkeypatch.setattr(files.TaskContext, "get", lambda: Task())
    writer = files.Writer(str(tmp_path / "out"), False)
    batch = lambda *names: pa.RecordBatch.from_arrays([pa.array(names), pa.array([n * 3 for n in names])], names=["name", "content"])

    def dies():
        yield batch("a", "b")
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    first, second = writer.write(iter([batch("a", "d/c")])), writer.write(iter([batch("a", "d/c")]))  # a speculative twin
    assert first.folder != second.folder
    writer.commit([second, None])
    assert below(tmp_path / "out") == ["a", "d/c"] and (tmp_path / "out/a").read_text() == "aaa"
    writer = files.Writer(str(tmp_path / "out"), True)
    writer.write(iter([batch("z")]))
    writer.abort([])
    assert below(tmp_path / "out") == ["a", "d/c"]


def test_names_of_pages():
    said = {n: (x.page_no, x.kind, x.ordinal) for n in ("page_003_vl_02.html", "page-012.png", "page_001_text.json", "notes.txt", "page_x.md", "page_004_vl.md") for x in [files.named(n)]}
    assert said == {"page_003_vl_02.html": (3, "_vl.html", 2), "page-012.png": (12, ".png", 0), "page_001_text.json": (1, "_text.json", 0), "notes.txt": (0, "notes.txt", 0), "page_x.md": (0, "page_x.md", 0), "page_004_vl.md": (4, "_vl.md", 0)}


@pytest.fixture
def tree(tmp_path):
    for doc in ("甲 区", "b+c", "d%20e", "empty", "other"):
        (tmp_path / doc).mkdir()
    for doc in ("甲 区", "b+c", "d%20e"):
        for no in range(1, 6):
            for end in ("_vl.json", "_vl.html", "_vl.md", ".png"):
                (tmp_path / doc / f"page_{no:03d}{end}").write_text(f"{doc} {no} {end}")
    (tmp_path / "other/notes.txt").write_text("x")
    (tmp_path / "loose.txt").write_text("x")
    return tmp_path


def test_only_wanted_files_are_opened(tree, monkeypatch):
    opened = []
    monkeypatch.setattr(files.ArtifactReader, "load", lambda self, path: opened.append(path) or b"")
    reader = files.ArtifactReader(str(tree), files.Wanted(names=["b+c"], pages=[3], kinds=["_vl.html"]), True, 1, 16)
    found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["file_name"], r["page_no"], r["kind"]) for r in found] == [("b+c", 3, "_vl.html")] and len(opened) == 1
    listed = files.ArtifactReader(str(tree), files.Wanted(), False, 3, 2)
    assert len(listed.partitions()) == 9
    assert len([r for p in listed.partitions() for b in listed.read(p) for r in b.to_pylist() if r["kind"]]) == 61 and len(opened) == 1
    assert sorted(n.page_no for p in listed.partitions() if "b+c" in p.names and p.part == 1 for d, n, _ in listed.files(p) if d == "b+c") == [1] * 4 + [4] * 4


def test_scans_of_one_relation_do_not_share_what_they_want(spark, tree):
    every = files.artifact_files(spark, str(tree))
    one, two = (files.artifact_files(spark, f"file://{tree}", files.Wanted(names=[n], kinds=["_vl.md"])) for n in ("b+c", "甲 区"))
    counts = one.unionByName(two).unionByName(every).groupBy("file_name").count()
    assert {r.file_name: r["count"] for r in counts.collect()} == {"b+c": 25, "甲 区": 25, "d%20e": 20, "empty": 1, "other": 1}
    assert every.where("page_no = 3 AND kind = '_vl.md'").count() == 3 and every.count() == 62


def test_artifacts(spark, tree):
    assert sorted(r.file_name for r in artifacts.folders(spark, str(tree)).collect()) == sorted(["甲 区", "b+c", "d%20e", "empty", "other"])
    assert [r.file_name for r in artifacts.folders(spark, str(tree), ["emp", "zz"]).collect()] == ["empty"]
    assert artifacts.page_artifacts(spark, str(tree)).groupBy("extension").count().orderBy("extension").collect() == [("html", 15), ("json", 15), ("md", 15)]
    assert [(r.page_no, r.content) for r in artifacts.text_artifacts(spark, str(tree), "md", files.Wanted(names=["d%20e"], first=4)).orderBy("page_no").collect()] == [(4, "d%20e 4 _vl.md"), (5, "d%20e 5 _vl.md")]
    assert sorted((r.file_name, r.page_no) for r in artifacts.page_images(spark, str(tree), start=2, end=4, max_pages=1).collect()) == [("b+c", 2), ("d%20e", 2), ("甲 区", 2)]
    with pytest.raises(Exception, match="missing"):
        artifacts.folders(spark, str(tree / "missing")).collect()


def test_a_file_that_cannot_be_read_is_a_row(spark, tree):
    (tree / "b+c/page_009_vl.md").symlink_to(tree / "b+c/page_001_vl.md")
    rows = files.artifact_files(spark, str(tree), files.Wanted(names=["b+c"], kinds=["_vl.md"])).collect()
    assert len(rows) == 6 and all(r.error is None for r in rows)
    reader = files.ArtifactReader(str(tree), files.Wanted(names=["b+c"], kinds=["_vl.md"]), True, 1, 16)
    reader.load = lambda path: (_ for _ in ()).throw(OSError("gone"))
    assert {r["error"] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()} == {"OSError: gone"}


def test_pretty_records(spark, tmp_path):
    kind = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("价", T.StringType()), T.StructField("rows", T.ArrayType(T.StructType([T.StructField("n", T.LongType())])))])
    made = sinks.record_files(spark.createDataFrame([("d", "é\n", [(1,), (None,)]), ("e", None, [])], kind))
    files.write_files(made, str(tmp_path))
    assert (tmp_path / "d/business_extract.json").read_text() == json.dumps({"file_name": "d", "价": "é\n", "rows": [{"n": 1}, {"n": None}]}, ensure_ascii=False, indent=2)
    records, errors = artifacts.business_records(spark, str(tmp_path))
    assert sorted(r.folder for r in records.collect()) == ["d", "e"] and errors.count() == 0


def test_script_is_one_file_in_order(spark, tmp_path):
    targets = spark.createDataFrame([("b", 2), ("a'x", 3), ("b", 1), ("b", 10)], "file_name string, page_no int")
    sinks.write_script(targets, str(tmp_path / "s"))
    names = [x for x in below(tmp_path / "s") if x.endswith(".txt")]
    text = (tmp_path / "s" / names[0]).read_text()
    assert len(names) == 1 and text.split("\n")[:5] == ["#!/usr/bin/env bash", "set -eo pipefail", "", """echo '### 1/2 a'"'"'x pages=3'""", """extract --file 'a'"'"'x' --page 3"""]
    assert "extract --file 'b' --page 1,2,10" in text


def test_run_report(spark, tmp_path):
    pages_ = spark.createDataFrame([("b", 2, 0, 5), ("a", 1, None, 1), ("b", 1, 0, 2)], "file_name string, page_no int, table_index int, rows long")
    records = spark.createDataFrame([("b", [1, 2], ("p",)), ("c", [], (None,))], "file_name string, labor_rows array<int>, document_info struct<consultation_project_name:string>")
    counts = spark.createDataFrame([("a", [1], 1, 1, 0.5), ("b", [1, 2], 2, 2, 1.239), ("c", [], 0, 0, None)], "file_name string, page_numbers array<int>, vl_page_count int, page_text_count int, elapsed_seconds double")
    made = sinks.reports(pages_, records, counts)
    sinks.write_run_report(made, str(tmp_path / "r"))
    name = next(x for x in below(tmp_path / "r") if x.endswith(".txt"))
    got = json.loads((tmp_path / "r" / name).read_text())
    assert [(r["file_name"], r["processed_pages"], r["labor_rows"], r["elapsed_seconds"], [p["page_no"] for p in r["pages"]]) for r in got] == [("a", 1, 0, 0.5, [1]), ("b", 2, 2, 1.24, [1, 2]), ("c", 0, 0, None, [])]
    assert sorted(r.name for r in sinks.report_files(made).collect()) == [f"{x}_vl_llm_extract_summary.json" for x in "abc"]
    assert sorted(r.name for r in sinks.report_files(made, partial=True).collect()) == ["a_vl_llm_extract_page_001_partial_summary.json", "b_vl_llm_extract_pages_001_002_partial_summary.json", "c_vl_llm_extract_pages_none_partial_summary.json"]


@pytest.fixture(scope="module")
def long_document(spark):
    r = random.Random(1)
    rows = [("huge", i, r.choice((None, None, None, f"v{i}"))) for i in range(5000)] + [(d, i, r.choice((None, f"w{i}"))) for d in ("a", "z", None) for i in range(3)]
    return spark.createDataFrame(rows, "doc string, page int, v string").repartition(5)


def test_scans_equal_windows(spark, long_document):
    spark.conf.set("spark.sql.shuffle.partitions", 23)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        df = long_document
        shown = lambda x: sorted(map(str, x.select("doc", "page", "out").collect()))
        assert scans.parts(df, ["doc", "page"]).select(scans.PART).distinct().count() > 10
        assert shown(scans.carry_forward(df, "doc", ["page"], F.col("v"), name="out")) == shown(pages.carry_forward(df, "doc", ["page"], F.col("v"), name="out"))
        for limit in (1, 7, 2000):
            args = ("doc", ["page"], F.col("page") % 3 == 0, F.when(F.col("page") > 4000, F.col("v")), limit)
            assert shown(scans.prefix_first(df, *args, name="out")) == shown(pages.prefix_first(df, *args, name="out"))
        numbers = [r.n for r in scans.numbered(df, ["doc", "page"]).orderBy("doc", "page").collect()]
        assert numbers == list(range(1, 5010))
        sums = scans.summed_before(df, ["doc", "page"], {"pages": F.col("page"), "ones": F.lit(1)}).orderBy("doc", "page").collect()
        total = 0
        for k, r in enumerate(sums):
            assert (r.pages, r.ones) == (total, k)
            total += r.page
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def test_a_pack_reads_as_the_files_would(spark, tree, tmp_path_factory):
    """a file and a folder for each small record filled the disk."""
    tmp_path = tmp_path_factory.mktemp("pack")
    single = files.artifact_files(spark, str(tree)).where("kind IS NOT NULL")
    files.pack_files(single.select(F.concat("file_name", F.lit("/"), F.substring_index("path", "/", -1)).alias("name"), "content").repartition(3), str(tmp_path / "p"))
    for wanted in (files.Wanted(), files.Wanted(kinds=["_vl.md"]), files.Wanted(names=["b+c"], first=1, last=3), files.Wanted(pages=[2]), files.Wanted(containing=["b"])):
        shown = lambda df: sorted(tuple(r) for r in df.select("file_name", F.coalesce("page_no", F.lit(0)), "kind", "ordinal", "content").collect())
        want = shown(files.artifact_files(spark, str(tree), wanted).where("kind IS NOT NULL"))
        assert want and shown(files.packed_files(spark, str(tmp_path / "p"), wanted)) == want
    files.write_files(files.packed_files(spark, str(tmp_path / "p")).select(F.col("path").alias("name"), "content"), str(tmp_path / "out"))
    assert below(tmp_path / "out") == [f for f in below(tree) if "/" in f]


def test_records_of_a_query_are_packed(spark):
    from gridloom.plans import artifacts as plans
    from gridloom.sources import scratch

    noted = []
    token = scratch.noted.set(noted)
    try:
        n = plans.record_files(spark, "/root/testdata/sf0.001").count()
    finally:
        scratch.noted.reset(token)
    assert n > 100 and sum(len(below(f)) for f in noted) < 50


@pytest.mark.parametrize("limit", [3, 1001])
def test_the_first_of_a_long_document_takes_no_shuffle_of_it(spark, limit):
    """the rows were shuffled by document and part, and a task's share grew with the table."""
    rows = spark.range(5000).select((F.col("id") % 2).alias("doc"), "id", (F.col("id") % 3 == 0).alias("some"), F.when(F.col("id") % 5 == 4, F.col("id")).alias("value"))
    found = scans.prefix_first(rows, "doc", ["id"], F.col("some"), F.col("value"), limit)
    got = {r.id: r.first_seen for r in found.collect()}
    first = {0: 24, 1: 9} if limit > 4 else {1: 9}
    assert got == {i: first.get(i % 2) if i >= first.get(i % 2, 1 << 30) else None for i in range(5000)}
    if limit == 3:
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_parts_grow_in_number_and_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(scans, "PART_ROWS", 100)
    rows = spark.range(2000).select(F.lit(1).alias("doc"), "id", F.when(F.col("id") % 7 == 0, F.col("id")).alias("value"))
    made = scans.parts(rows, ["doc", "id"])
    assert made.groupBy(scans.PART).count().agg(F.max("count")).first()[0] < 300
    assert all(r.carried == r.id // 7 * 7 for r in scans.carry_forward(rows, "doc", ["id"], F.col("value"), None).collect())
