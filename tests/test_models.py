"""Engines kept by workers, the reply store, and drawn boxes."""

import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import model, replies, sequences
from gridloom.sources import engines, overlay


def test_one_engine_a_worker_and_settings(spark, tmp_path):
    log = str(tmp_path / "made")

    def make(settings):
        with open(log, "a") as f:
            f.write(f"{os.getpid()} {settings.device}\n")

        def read(image):
            if image == b"bad":
                raise ValueError("cannot read")
            return {"text": image.decode(), "device": settings.device}

        return read

    images = spark.range(40).select(F.col("id").cast("string").alias("file_name"), F.lit(1).alias("page_no"), F.when(F.col("id") == 7, "bad").otherwise(F.col("id").cast("string")).cast("binary").alias("image")).repartition(20)
    for device in ("gpu", "cpu", "gpu"):
        rows = engines.recognise(images, make, engines.PageSettings(device=device), "struct<text:string,device:string>").collect()
        assert {(r.result and r.result.device) for r in rows} == {device, None} and [r.error for r in rows if r.error] == ["ValueError: cannot read"]
        assert all(r.result.text == r.file_name for r in rows if r.result) and all(r.elapsed_seconds >= 0 for r in rows)
    made = open(log).read().split("\n")[:-1]
    assert len(made) == len(set(made)) and {x.split()[1] for x in made} == {"gpu", "cpu"}  # sixty tasks, one a worker and key


def test_engines_are_let_go(monkeypatch):
    monkeypatch.setattr(engines, "_engines", type(engines._engines)())
    made = []
    make = lambda s: made.append(s.model) or s.model
    for name in ("a", "b", "c", "d", "a", "e", "a", "b"):
        assert engines.engine(make, engines.ModelSettings(name)) == name
    assert made == ["a", "b", "c", "d", "e", "b"]


def test_settings_from_the_environment(monkeypatch):
    for k, v in {"PIPELINE_VERSION": "v2", "USE_LAYOUT_DETECTION": "no", "USE_QUEUES": " ", "MAX_NEW_TOKENS": "99", "DEVICE": " gpu:1 "}.items():
        monkeypatch.setenv(f"GRIDLOOM_VL_{k}", v)
    assert engines.from_environment(engines.PageSettings, "GRIDLOOM_VL") == engines.PageSettings("v2", False, None, "gpu:1", None, None, 99)
    assert engines.from_environment(engines.ScreenSettings, "GRIDLOOM_NONE") == engines.ScreenSettings()


def test_store_asks_only_what_it_does_not_know(spark, tmp_path):
    log = str(tmp_path / "asked")

    def make(settings):
        def ask(prompts):
            with open(log, "a") as f:
                f.write("|".join(prompts) + "\n")
            if any("bad" in p for p in prompts):
                raise RuntimeError("out of memory")
            return [f"{settings.model}:{p}" for p in prompts]

        return ask

    asked = spark.createDataFrame([(i, p) for i, p in enumerate(["one", "two", "two", "bad", "x" * 500, None, "three" * 10])], "i int, prompt string")
    store, settings = replies.ReplyStore(spark, str(tmp_path / "store")), engines.ModelSettings("m")
    said = lambda s, **kw: {r.i: r.reply for r in replies.StoredBackend(store, s, make, budget=100, **kw).answered(asked).collect()}
    first = said(settings, tries=2)
    assert first == {0: "m:one", 1: "m:two", 2: "m:two", 3: None, 4: "m:" + "x" * 500, 5: "m:", 6: "m:" + "three" * 10}
    lines = open(log).read().split("\n")[:-1]
    assert sum(x.split("|").count("two") for x in lines) <= 2 and all(len(x.replace("|", "")) <= 100 or "|" not in x for x in lines)
    before = len(lines)
    assert said(settings, tries=2) == first and len(open(log).read().split("\n")) - 1 == before  # nothing is asked again
    failed = store.replies().where("reply IS NULL").collect()
    assert [(r.error, r.tries) for r in failed] == [("RuntimeError: out of memory", 2)]
    said(settings, tries=4)  # one with tries left is
    assert open(log).read().split("\n")[before:-1] == ["bad"] * 4
    assert said(engines.ModelSettings("other"), tries=1)[0] == "other:one"  # other settings, other replies
    replies.record(store, spark.createDataFrame([("bad", "known")], "prompt string, reply string"), settings)
    assert said(settings)[3] == "known"
    only = replies.StoredBackend(replies.ReplyStore(spark, str(tmp_path / "none")), settings)
    assert {r.reply for r in only.answered(asked).collect()} == {None}


def test_batches_keep_to_their_budget():
    r = random.Random(2)
    prompts = [(str(i), "x" * r.randrange(60)) for i in range(200)]
    parts = list(replies.batches_of(prompts, 100))
    assert [p for part in parts for p in part] == prompts and all(sum(len(p) for _, p in part) <= 100 for part in parts)
    assert list(replies.batches_of([("a", "x" * 500), ("b", "")], 100)) == [[("a", "x" * 500)], [("b", "")]] and list(replies.batches_of([], 5)) == []


def test_call_backend_keeps_nothing(spark):
    asked = spark.createDataFrame([("a",), ("b",)], "prompt string")
    assert sorted(r.reply for r in model.CallBackend(lambda s: lambda prompts: [p.upper() for p in prompts]).answered(asked).collect()) == ["A", "B"]


def test_chunks_lose_white_space_only(spark):
    df = spark.createDataFrame([(["0100", " 11 ", "2", ""],)], "l array<string>")
    assert df.select(sequences.chunk_lines(F.col("l"), 5).alias("r")).first().r == ["0100", "11", "2"]


def filtered(pixels, kinds):
    """A PNG whose lines use the given filters."""
    h, w, n = pixels.shape
    lines, above = [], np.zeros(w * n, np.int64)
    for y in range(h):
        line = pixels[y].reshape(-1).astype(np.int64)
        left = np.concatenate([np.zeros(n, np.int64), line[:-n]])
        corner = np.concatenate([np.zeros(n, np.int64), above[:-n]])
        p = left + above - corner
        paeth = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
        kind = kinds[y % len(kinds)]
        lines.append(bytes([kind]) + ((line - [0, left, above, (left + above) // 2, paeth][kind]) % 256).astype(np.uint8).tobytes())
        above = line
    part = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    colour = {1: 0, 2: 4, 3: 2, 4: 6}[n]
    data = zlib.compress(b"".join(lines))
    return overlay.SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + part(b"IDAT", data[:10]) + part(b"IDAT", data[10:]) + part(b"IEND", b"")


@pytest.mark.parametrize("samples", [1, 2, 3, 4])
def test_images_round_trip(samples):
    pixels = np.random.default_rng(samples).integers(0, 256, (11, 7, samples), np.uint8)
    read = overlay.decode(filtered(pixels, [0, 1, 2, 3, 4]))
    want = np.repeat(pixels[:, :, :1], 3, axis=2) if samples < 3 else pixels[:, :, :3]
    assert (read == want).all() and (overlay.decode(overlay.encode(read)) == want).all()


def test_boxes_by_distance():
    """Every pixel within one of an edge is coloured, no other; boxes may leave the image."""
    r = random.Random(4)
    for _ in range(20):
        box = [[r.uniform(-5, 30), r.uniform(-5, 25)] for _ in range(r.choice((4, 5)))]
        image, n = overlay.drawn(overlay.encode(np.zeros((20, 25, 3), np.uint8)), [{"bbox": box, "score": 0.5}, {"bbox": box[:3]}, {"bbox": None}, {"bbox": [[1, None]] * 4}], labels=False)
        got = (overlay.decode(image) == overlay.BOX).all(axis=2)
        ends = [[int(v) for v in p] for p in box]

        def near(x, y):
            for (ax, ay), (bx, by) in zip(ends, ends[1:] + ends[:1], strict=True):
                size = (bx - ax) ** 2 + (by - ay) ** 2
                t = min(1, max(0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / size)) if size else 0
                if (x - ax - t * (bx - ax)) ** 2 + (y - ay - t * (by - ay)) ** 2 <= 1 + 1e-9:
                    return True
            return False

        assert n == 1 and sum(got[y, x] != near(x, y) for y in range(20) for x in range(25)) == 0


def test_labels_and_bad_images(spark):
    page = overlay.encode(np.full((40, 60, 3), 255, np.uint8))
    box = [[10.0, 25.0], [30.0, 25.0], [30.0, 35.0], [10.0, 35.0]]
    rows = [("a", 1, page, [("t", 0.987, box)]), ("b", 2, b"\xff\xd8jpeg", [("t", 0.5, box)]), ("c", 3, None, None), ("d", 4, page[:-20], []), ("e", 5, page, None)]
    df = spark.createDataFrame(rows, "file_name string, page_no int, image binary, items array<struct<text:string,score:double,bbox:array<array<double>>>>")
    found = {r.file_name: r for r in overlay.overlays(df).collect()}
    assert [found[k].boxes for k in "abcde"] == [1, None, None, None, 0] and all((found[k].error is None) == (k in "ae") for k in found)
    pixels = overlay.decode(found["a"].image)
    red = (pixels == overlay.LABEL).all(axis=2)
    assert red[:20].sum() == 4 * sum(bin(b).count("1") for c in "0.987" for b in overlay.DIGITS[c]) and not red[20:].any()
    assert [(r.name, r.content == found[r.name[0]].image) for r in overlay.overlay_files(overlay.overlays(df)).orderBy("name").collect()] == [("a/page_001_boxes.png", True), ("e/page_005_boxes.png", True)]


def test_rows_are_rendered_once_for_chunks(spark):
    """every row was rendered twice, and its cells searched for what they don't hold."""

    from gridloom.operators import model

    made = spark.createDataFrame([([["序号", "a"], *[[str(k), f' é"{k}\r\n\n\n\nx' + "y" * 600] for k in range(1, 8)]],), ([],)], "grid array<array<string>>")
    cut = made.select(model.table_chunks(F.col("grid"), "labor_table", 1000).alias("c"))
    assert cut._jdf.queryExecution().analyzed().toString().count("cell_truncated") == 1
    whole, none = (r.c for r in cut.collect())
    assert [(c.chunk_index, c.data_rows, c.source_row_start, c.grid[0][0], c.grid[1][0]) for c in whole] == [(1, 3, 2, "序号", "1"), (2, 3, 5, "序号", "4"), (3, 1, 8, "序号", "7")]
    assert [(c.grid, c.data_rows, c.source_row_start) for c in none] == [([], 0, 1)]
    text = made.select(model.table_text(F.col("grid"), "labor_table", limit=9000).alias("t")).first().t
    assert text.split("\n")[4] == 'row_002: col_001="1" | col_002="é\\"1\\n\\nx' + "y" * (500 - 8) + '...[cell_truncated]"'


def test_dear_rows_are_dealt_to_all_cores(spark):
    """a short file was one task, and an unfiltered image was read line by line."""
    from gridloom.plans import tables

    for name in ("normalise_sub_item", "box_overlay"):
        made = tables.QUERIES[name](spark, "/root/testdata/sf0.001")
        if name == "normalise_sub_item":
            assert "RoundRobinPartitioning(12)" in made._jdf.queryExecution().executedPlan().toString()
    image = np.arange(5 * 4 * 3, dtype=np.uint8).reshape(5, 4, 3)
    kept, overlay._line = overlay._line, None
    try:
        assert (overlay.decode(overlay.encode(image)) == image).all()
    finally:
        overlay._line = kept


def test_grids_are_objects_a_slice_at_a_time(spark, monkeypatch):
    """a whole batch of tables was Python objects at once."""
    from gridloom.operators import extract

    assert extract.SLICE <= 256
    made = spark.range(700, numPartitions=1).select("id", F.array(F.array(F.lit("序号"), F.lit("费用名称"), F.lit("金额")), F.array(F.lit("1"), F.concat(F.lit("f"), "id"), F.lit("3元"))).alias("g"))
    got = made.select("id", extract.extract(F.when(F.col("id") != 5, F.col("g")), "unit_project_fee_table").alias("x")).collect()
    assert all([(x.seq, x.fee_name, x.amount, x.remark) for x in r.x] == ([] if r.id == 5 else [("1", f"f{r.id}", "3", "元")]) for r in got)
