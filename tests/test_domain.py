"""Goldens of the document-table operators."""

import json

import pytest
from pyspark.sql import functions as F

from gridloom import rules
from gridloom.functions import settings
from gridloom.functions import text as T
from gridloom.operators import audit, classify, docinfo, extract, gates, grids, model, pages, repair, sections, sequences, upsert
from gridloom.plans import extraction
from gridloom.sources import artifacts, excel, sinks
from gridloom.streaming import ingest


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (T.clean_amount, "¥-1,234.50元", "1234.50"), (lambda c: T.clean_amount(c, keep_sign=True), "-1,234.5", "-1234.5"),
        (T.is_valid_seq, "1", True), (T.is_valid_seq, "1.1", True), (T.is_valid_seq, "1.", False), (T.is_valid_seq, "一", False), (T.is_valid_seq, None, False),
        (T.top_level_seq, "2 措施项目费", "2"), (T.top_level_seq, "2.1", ""), (T.top_level_seq, "12", ""), (T.top_level_seq, "8", ""), (T.top_level_seq, "3", "3"),
        (lambda c: T.split_amount(c)[0], "1,234.5元", "1234.5"), (lambda c: T.split_amount(c)[1], "1,234.5元", "元"),
        (lambda c: F.concat_ws("|", *T.split_amount(c)), "-5元", "5|-元"), (lambda c: F.concat_ws("|", *T.split_amount(c)), "12.元", "12.|元"), (lambda c: F.concat_ws("|", *T.split_amount(c)), "a,b 1,000 c,", "1000|ab  c"), (lambda c: F.concat_ws("|", *T.split_amount(c)), " no, ", "|no,"), (lambda c: F.concat_ws("|", *T.split_amount(c, keep_sign=True)), "-5元", "-5|元"),
        (docinfo.project_name, "某某小区\n咨询项目全称：及其附属工程", "某某小区及其附属工程"), (docinfo.project_name, "咨询项目全称：工程造价咨询报告书\n甲区", "甲区"), (docinfo.project_name, "甲\n乙小区\n咨询项目全称：\n委托单位：x", "乙小区"), (docinfo.project_name, "目录\n咨询项目全称：及其他", "及其他"), (docinfo.project_name, "none", None),
        (T.normalize_unit, "$ m^{2} $", "m2"), (T.date_iso, "二〇二四年十二月三日", "2024-12-03"), (T.date_iso, "2024.3.5", "2024-03-05"), (T.date_iso, "none", ""), (T.date_iso, "二〇二四年十月二十日", "2024-10-20"),
        (T.collapse_phrase, "甲区甲区", "甲区"), (T.collapse_phrase, "22", "2"), (T.collapse_phrase, "甲区", "甲区"), (lambda c: T.collapse_phrase(c, strict=True), "22", "22"),
        (T.strip, "\n a 　", "a"), (T.compact, "a　b c", "abc"), (T.is_project_code, "010902001001", True), (T.page_number, "x/page_007_vl.json", 7), (T.page_number, "none", None),
        (lambda c: classify.clean_name(c, F.lit("X.pdf")), "某小区3幢-101室", "X-3幢-101"), (classify.building_id, "见3号楼", "3号楼"),
    ],
)
def test_scalars(spark, f, value, expected):
    assert one(spark, value, f) == expected


def test_page_suffix(spark):
    assert [one(spark, v, T.page_suffix, "array<int>") for v in ([7], [9, 1], [])] == ["page_007", "pages_001_009", "pages_none"]


def test_html_spans():
    html = "<table><tr><td rowspan=2>A</td><td>B</td><td rowspan=2>C</td></tr><tr><td>D</td></tr></table>"
    assert grids.html_tables(html) == [[["A", "B", "C", ""], ["A", "", "C", "D"]]]
    assert grids.html_tables(html, strict=True) == [[["A", "B", "C"], ["A", "D", "C"]]]
    assert grids.html_tables("<table><tr><td colspan=2>X</td></tr><tr><td>a&amp;</td><td>b<br>c</td></tr></table>") == [[["X", "X"], ["a&", "b\nc"]]]
    assert grids.html_tables("<table><tr><td rowspan='x'>1</td><td>2") == []
    assert grids.html_tables(None) == []


def test_markdown():
    assert grids.markdown_tables("|a|b|\n|--|:--:|\n|1 \\| x|2|\n") == [[["a", "b"], ["1 | x", "2"]]]
    assert grids.markdown_tables("| only | one |") == [] and grids.markdown_tables(None) == []


def test_grids_in_spark(spark):
    df = spark.createDataFrame([("<TABLE><tr><td>1</td></tr></table>",), ("none",), (None,)], "h string")
    assert [r.g for r in df.select(grids.html_grids(F.col("h")).alias("g")).collect()] == [[[["1"]]], [], []]


def test_gate(spark):
    policy = lambda t: one(spark, t, lambda c: gates.target_decision(c)["policy"])
    assert policy("分部分项工程清单与计价表 施工工艺") == "skip_blacklist_priority"
    assert policy("分部分项工程 清单 计价") == "whitelist_priority"
    assert policy("项目编码 项目名称 综合单价") == "target_structure_priority"
    assert policy("") == "skip_non_target_table"


def test_reading_order(spark):
    box = lambda x, y: [[x, y], [x + 2, y], [x + 2, y + 2], [x, y + 2]]
    items = [{"text": "c", "bbox": box(5.0, 9.0)}, {"text": "b", "bbox": box(9.0, 1.0)}, {"text": "a", "bbox": box(1.0, 1.0)}, {"text": "z", "bbox": None}]
    df = spark.createDataFrame([(items,)], "items array<struct<text:string,bbox:array<array<double>>>>")
    assert df.select(pages.reading_order(F.col("items")).alias("r")).first().r == ["z", "a", "b", "c"]


def test_page_filter_and_parse(spark):
    df = spark.createDataFrame([("d", i) for i in range(1, 11)], "d string, p int")
    assert [r.p for r in pages.page_select(df, "d", "p", [2, 4, 6, 8], start=3, max_pages=2).orderBy("p").collect()] == [4, 6]
    assert pages.parse_page_list("3, 1，3") == [1, 3]
    with pytest.raises(ValueError):
        pages.parse_page_list("0")


def test_carry_forward(spark):
    rows = [("f", i, 0, ["sub_item_project_table"], n) for i, n in enumerate(["", "A", "", "B", ""])]
    df = spark.createDataFrame(rows, "file_name string, page_no int, table_index int, types array<string>, name string")
    got = classify.assign_sub_projects(df).orderBy("page_no").collect()
    assert [r.sub_project for r in got] == ["(root)", "A", "A", "B", "B"]


def test_table_types(spark):
    def types(text, grid):
        df = spark.createDataFrame([(text, grid)], "t string, g array<array<string>>")
        return df.select(classify.table_types(F.col("t"), classify.row_texts(F.col("g"))).alias("r")).first().r

    assert types("", [["项目编码", "项目名称"], ["综合单价", "x"]]) == [classify.SUB_ITEM]
    assert types("", [["主要工日一览表", ""]]) == [classify.LABOR]
    assert types("", [["费用名称", "计算公式"]]) == [classify.UNIT_FEE]
    assert types("工程量确认单", [["名称", "维修内容"]]) == [classify.QUANTITY]
    assert types("anything", []) == []


GRID = [["序号", "项目编码", "项目名称", "计量单位", "工程量", "综合单价", "合价"], ["1", "010902001001", "屋面", "m2", "2", "10.5", "21"], ["", "", "本页小计", "", "", "", "21"], ["2", "010902001002", "墙面", "m2", "3", "5", "15"]]


def test_sub_item_rule():
    rows = extract.extract_rows(GRID, "sub_item_project_table")
    assert [(r["seq"], r["project_code"], r["unit_price"], r["row_index"]) for r in rows] == [("1", "010902001001", "10.5", "1"), ("2", "010902001002", "5", "3")]
    fee = extract.extract_rows([["序号", "费用名称", "计算公式", "金额"], ["1", "人工", "a", "1,000.5元"], ["1.1", "x", "", "2"]], "unit_project_fee_table")
    assert [(r["seq"], r["amount"], r["remark"]) for r in fee] == [("1", "1000.5", "元")]
    assert extract.extract_rows([["nothing"]], "labor_table") == [] and extract.extract_rows([], "sub_item_project_table") == []
    for kind in extract.TABLES:
        assert isinstance(extract.extract_rows(GRID, kind), list)


def test_lenient_json(spark):
    assert extract.lenient_json('```json\n[{"a":1,}]\n```') == [{"a": 1}]
    assert extract.lenient_json('x {"a": "b"} y') == [{"a": "b"}] and extract.lenient_json("nothing") is None
    assert one(spark, '[{"工程量(m2)": 3, "seq": 0}]', lambda c: sequences.aliased(F.get(extract.parse_replies(c), F.lit(0)), "quantity")) == "3"


def test_repair(spark):
    fields = extract.fields_of("sub_item_project_table")
    base = dict.fromkeys(fields, "")
    made = [base | {"seq": "1", "project_code": "010902001001", "project_name": "屋面", "quantity": "2", "total_price": "21"}, base | {"project_name": "合计"}, base | {"seq": "序号", "project_name": "墙面", "quantity": "3", "total_price": "15"}]
    names = ["table_id", "idx", *fields]
    schema = "table_id string, idx int, " + ", ".join(f"{f} string" for f in fields)
    grids_ = spark.createDataFrame([("t", GRID)], "table_id string, grid array<array<string>>")
    rows = spark.createDataFrame([("t", i, *[r[f] for f in fields]) for i, r in enumerate(made)], schema)
    rule = spark.createDataFrame([("t", i, *[r.get(f, "") for f in fields]) for i, r in enumerate(extract.extract_rows(GRID, "sub_item_project_table"))], schema)
    got = {r.project_name: (r.seq, r.unit_price) for r in repair.repair(rows, rule, grids_).select(*names).collect()}
    assert got == {"屋面": ("1", "10.5"), "墙面": ("2", "5")}
    bare = repair.repair(rows, rule.limit(0), grids_).collect()
    assert {r.project_name: r.unit_price for r in bare} == {"屋面": "10.5", "墙面": "5"}


def test_misaligned_and_empty(spark):
    row = ("f", 5, "1", "s", "1", "010902001001", "n", "", "m", "1", "010902001001", "10", "5", "")
    schema = "file_name string, page_no int, pos string, sub_project_id string, seq string, project_code string, project_name string, project_description string, unit string, quantity string, unit_price string, total_price string, labor_cost string, machinery_cost string"
    df = spark.createDataFrame([row], schema)
    got = audit.misaligned_pages(df).first()
    assert got.hit_rows == 1 and set(got.reasons.split("、")) == {"unit_price像项目编码", "疑似金额列整体右移"}
    lost = spark.createDataFrame([("f", 5, "1", "s", "", "", "x", *[""] * 7), ("f", 5, "2", "s", "1", "", "", *[""] * 7)], schema)
    got = audit.empty_after_filter(lost).first()
    assert (got.raw_rows, got.kept_rows, got.reasons) == (2, 0, "缺少name:1、缺少seq:1")


def test_bag_difference_and_upsert(spark):
    raw = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3)], "k string, o int")
    assert sorted(r.o for r in upsert.bag_difference(raw, raw.where("o = 1"), ["k"], ["o"]).collect()) == [2, 3]
    old = spark.createDataFrame([("f", p, "old") for p in (1, 2, 3)], "file_name string, page_no int, v string")
    new = spark.createDataFrame([("f", 2, "new"), ("f", 9, "stray")], "file_name string, page_no int, v string")
    at = old.where("page_no = 2")
    once = upsert.page_upsert(old, new, at, ["file_name", "page_no"])
    again = upsert.page_upsert(once, new, at, ["file_name", "page_no"])
    assert sorted((r.page_no, r.v) for r in once.collect()) == [(1, "old"), (2, "new"), (3, "old")] == sorted((r.page_no, r.v) for r in again.collect())


def test_document_info(spark):
    text = "咨询项目全称：某小区改造\n工程\n二、其他\n咨询报告日期：\n二〇二四年十二月三日\n一、工程概况\n（一）改造内容：屋面翻新\n（二）其他"
    assert one(spark, text, docinfo.project_name) == "某小区改造工程"
    assert one(spark, text, docinfo.report_date) == "2024-12-03"
    assert one(spark, text, docinfo.renovation_text) == "屋面翻新"


def test_chunks(spark):
    df = spark.createDataFrame([(["aaaa", "bbbb", "cc", "d" * 30],)], "l array<string>")
    assert df.select(sequences.chunk_lines(F.col("l"), 10).alias("r")).first().r == ["aaaa\nbbbb", "cc", "d" * 30]


def test_sources_sinks_and_extraction(spark, tmp_path):
    (tmp_path / "texts/doc").mkdir(parents=True)
    (tmp_path / "vl/doc").mkdir(parents=True)
    html = "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in GRID) + "</table>"
    for no, name in ((1, "3幢"), (2, "")):
        (tmp_path / f"texts/doc/page_{no:03d}_text.json").write_text(json.dumps({"page_no": no, "text": f"工程名称：某小区{name}" if name else "x"}, ensure_ascii=False))
        (tmp_path / f"vl/doc/page_{no:03d}_vl.html").write_text(html)
    (tmp_path / "texts/doc/page_003_text.json").write_text("{bad")
    texts = artifacts.page_texts(spark, str(tmp_path / "texts"))
    shown = artifacts.text_artifacts(spark, str(tmp_path / "vl"), "html")
    empty = spark.createDataFrame([], "file_name string, page_no int, ordinal int, content string")
    record = extraction.run(texts.where("text <> ''"), shown, empty, "2024-01-01").collect()
    assert len(record) == 1 and record[0].total_pages == 2
    assert [(s.sub_project_id, [r.unit_price for r in s.sub_item_project_rows]) for s in record[0].sub_projects] == [("doc-3幢", ["10.5", "5", "10.5", "5"])]
    reply = json.dumps([{"序号": "1", "project_code": "010902001001", "项目名称": "屋面", "工程量": "2", "合价": "21"}, {"project_name": "本页小计", "合价": "21"}, {"seq": "2", "project_code": "010902001002", "project_name": "墙面", "unit_price": "￥6"}], ensure_ascii=False)
    asked = extraction.run(texts.where("text <> ''"), shown, empty, "2024-01-01", backend=model.CallBackend(lambda settings: lambda prompts: [reply for _ in prompts])).collect()
    # the first price comes from the rules' row, the second is the model's own
    assert [[(r.seq, r.unit_price) for r in s.sub_item_project_rows] for s in asked[0].sub_projects] == [[("1", "10.5"), ("2", "6")] * 2]
    assert asked[0].construction_processes == []
    assert one(spark, '{"a":[{"block_content":"p\\"q"},{"text":"r"},{"text":"r"}]}', artifacts.json_texts) == 'p"q\n\nr'
    targets = spark.createDataFrame([("it's", 3), ("it's", 1)], "file_name string, page_no int")
    assert sinks.rerun_commands(targets).first().value.endswith("--page 1,3")
    sinks.write_tsv(targets, str(tmp_path / "t.tsv"), one_file=True)
    assert sorted(r.page_no for r in artifacts.page_targets(spark, str(tmp_path / "t.tsv")).collect()) == [1, 3]


def test_streaming_upsert(spark, tmp_path):
    schema = spark.createDataFrame([], "file_name string, page_no int, text string").schema
    source = tmp_path / "in"
    source.mkdir()
    for k, text in enumerate(("old", "new")):
        (source / f"{k}.json").write_text(json.dumps({"file_name": "f", "page_no": 1, "text": text}))
        ingest.upsert_pages(spark, str(source), schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r.text for r in ingest.latest_pages(spark, str(tmp_path / "out")).collect()] == ["new"]


def read_section(spark, pages):
    rows = sections.construction_processes(spark.createDataFrame([("d", *p) for p in pages], "file_name string, page_no int, text string")).collect()
    return rows[0] if rows else None


@pytest.mark.parametrize(
    ("pages", "expected"),
    [
        ([(1, "施工工艺\n先清理基层再涂刷")], "施工工艺\n先清理基层再涂刷"),
        ([(1, "施工工艺......3")], None),  # an entry of a table of contents is no heading
        ([(1, "目录\n施工工艺\n某某某某某某某")], None),
        ([(1, "4、施工工艺\n5、现场踏勘记录表\n某某某某某某某")], None),
        ([(1, "施工工艺\n短")], None),
        ([(2, "1. 第二页的步骤"), (1, "三、施工工艺：\n先清理基层，")], "三、施工工艺：\n先清理基层，\n1. 第二页的步骤"),
        ([(1, "施工工艺\n先清理基层再涂刷。"), (2, "普通的一句话")], "施工工艺\n先清理基层再涂刷。"),
        ([(1, "施工工艺\n先清理基层再涂刷"), (2, ""), (3, "四、其他")], "施工工艺\n先清理基层再涂刷"),
        ([(1, "施工工艺\n先清理基层再涂刷\n建设单位：某某\n后文")], "施工工艺\n先清理基层再涂刷"),
        ([(1, None), (2, "")], None),
    ],
)
def test_construction_section(spark, pages, expected):
    found = read_section(spark, pages)
    assert (found and found["content"]) == expected


def test_section_images(spark):
    found = read_section(spark, [(3, "施工工艺\n![a](b.png)\n<img src='c.jpg'>\ndata:image/png;base64,xx\n先清理基层再涂刷")])
    assert [(i["type"], i["target"], i["page_no"], i["line_no"]) for i in found["image_refs"]] == [("markdown_image", "b.png", 3, 2), ("html_image", "c.jpg", 3, 3), ("embedded_image", "", 3, 4)]


def test_workbook_reads_back(spark, tmp_path):
    rows = [["a & <b>", "", "x\ny"], ["二", "c" * 100, ""]]
    content = excel.workbook(["h1", "h2", "h3"], rows)
    assert list(excel.read_sheet(content)) == [["h1", "h2", "h3"], *rows]
    assert [excel.column_name(k) for k in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    df = spark.createDataFrame([(f"f{i:02d}", str(i)) for i in range(25)], "file_name string, v string")
    files = excel.excel_files(df, ["file_name", "v"], rows_per_file=10).collect()
    read = [r for f in files for r in list(excel.read_sheet(bytes(f.content)))[1:]]
    assert len({f.name for f in files}) == len(files) >= 3 and sorted(read) == [[f"f{i:02d}", str(i)] for i in range(25)]
    assert [list(excel.read_sheet(bytes(f.content))) for f in excel.excel_files(df.limit(0), ["file_name", "v"]).collect()] == [[["file_name", "v"]]]


@pytest.mark.parametrize(("value", "expected"), [("十", 10), ("十二", 12), ("二十", 20), ("九十九", 99), ("两", 2), ("二〇", 20), ("7", 7), ("1十", None), ("十十", 10), ("", None), ("甲", None)])
def test_chinese_int(spark, value, expected):
    assert one(spark, value, T.chinese_int) == expected


def test_paths_of_lists_are_resolved(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# note\n\na/./b.pdf\na//b.pdf\nc/../d.pdf\n../e.pdf\n")
    known = spark.createDataFrame([("./a/b.pdf",), ("../e.pdf",)], "path string")
    found, missing = artifacts.resolve_list(spark, known, ["z.pdf", "a/b.pdf"], str(tmp_path / "list.txt"))
    assert [r.path for r in found.collect()] == ["a/b.pdf", "../e.pdf"] and [r.path for r in missing.collect()] == ["z.pdf", "d.pdf"]


def test_versions_compact(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([("f", 1, v)], "file_name string, page_no int, text string")
    for version in (0, 1):
        rows(f"v{version}").selectExpr("*", "3 AS bucket").write.partitionBy("bucket").parquet(str(tmp_path / f"t/version={version}"))
    assert [r.text for r in ingest.compact_pages(spark, str(tmp_path / "t"), str(tmp_path / "c")).collect()] == ["v1"]


def test_settings(monkeypatch):
    for value, expected in (("Yes", True), (" on ", True), ("0", False), ("", None)):
        monkeypatch.setenv("GRIDLOOM_TEST", value)
        assert settings.flag("GRIDLOOM_TEST") is expected
    assert settings.flag("GRIDLOOM_UNSET", True) is True and settings.integer("GRIDLOOM_UNSET") is None
    monkeypatch.setenv("GRIDLOOM_TEST", " 7 ")
    assert settings.integer("GRIDLOOM_TEST") == 7


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("工程名称：甲区\n标段：一\n3幢\n序号\n5幢", "甲区-3幢"),
        ("0.9876\t工程名称：甲区-\n12室", "甲区-12室"),
        ("工程名称：甲区及\n乙区\n项目编码", "甲区及乙区"),
        ("工程名称：\n序号\n工程名称：丙区", "丙区"),
        ("工程名称：甲区\n普通说明", "甲区"),
        ("无标签 见 7号楼", "7号楼"),
        ("", "丁区-1"),
    ],
)
def test_label_name(spark, text, expected):
    grid = F.array(F.array(F.lit("表"), F.lit("")), F.array(F.lit("工程名称：丁区-"), F.lit("1")))
    assert one(spark, text, lambda c: classify.label_name(c, grid)) == expected


def fold_section(pages):
    """The section by one pass over all lines, kept apart from the operator."""
    import re

    key = lambda x: re.sub(r"\s+", "", x)
    ends = lambda x: key(x) in rules.OTHER_TITLES or key(x).startswith(rules.SECTION_ENDS)
    kept, last, state = [], None, "before"
    for no, text in sorted(pages):
        lines = [x.strip() for x in text.split("\n")]
        contents = any(key(x) in ("目录", "咨询报告书目录") for x in [x for x in lines if x][:5]) or sum(key(x) in rules.OTHER_TITLES for x in lines) >= 3
        top = [x for x in lines if x][:5]
        if state == "in" and top:
            other = re.match(r"[一二三四五六七八九十]+[、.．](?!施工工艺)|[（(][一二三四五六七八九十\d]+[）)]", top[0]) or re.search(r"[第共]\s*\d+\s*页", top[0])
            item = lambda x: not ends(x) and re.search(r"^(?:\d+|[一二三四五六七八九十]+)[、.．)]|^[^：:]{1,30}[：:]$|\d+\s*(?:m2|m²|㎡|m|米|台班|遍)", x)
            heading = re.fullmatch(r"(?:[一二三四五六七八九十]+[、.．]\s*|\d+[、.．]?\s*)?施工工艺\s*[：:]?", top[0])
            if contents or ends(top[0]) or other or not (heading or any(map(item, top)) or last[-1] in "，,、：（(【；;" or last[-1] not in "。.!！?？；;"):
                break
        for x in lines:
            if state == "before":
                if not contents and re.fullmatch(r"(?:[一二三四五六七八九十]+[、.．]\s*|\d+[、.．]?\s*)?施工工艺\s*[：:]?", x):
                    state, kept = "in", [x]
            elif state == "in" and ends(x):
                state = "done"
            elif state == "in" and x:
                kept.append(x)
        last = next((x for x in reversed(lines) if x), last)
        if state == "done":
            break
    return "\n".join(kept) if any(len(key(x)) >= 6 for x in kept[1:]) else None


def test_sections_against_a_fold(spark):
    import random

    r = random.Random(6)
    parts = ["施工工艺", "三、施工工艺：", "普通的一句话。", "先清理基层再涂刷", "1、第一步先清理", "二、其他", "建设单位：某某", "目录", "", "（一）甲", "施工方案", "共 3 页", "刷2遍,", "工程量确认单", "现场踏勘记录表", "甲："]
    documents = {f"d{i}": [(no, "\n".join(r.choices(parts, weights=[6, 3, 6, 6, 4, 1, 1, 1, 3, 1, 1, 1, 3, 1, 1, 2], k=r.randrange(7)))) for no in range(1, r.choice((2, 4)))] for i in range(400)}
    df = spark.createDataFrame([(d, no, t) for d, ps in documents.items() for no, t in ps], "file_name string, page_no int, text string")
    got = {x.file_name: x.content for x in sections.construction_processes(df).collect()}
    assert got == {d: found for d, ps in documents.items() if (found := fold_section(ps)) is not None} and len(got) > 100


def test_plain_html_is_read_as_by_the_parser():
    """Plain HTML takes the short way, whatever is odd the parser's; both find the same cells."""
    import random

    def parsed(html):
        reader = grids._Reader()
        reader.feed(html)
        return [grids.lay_out(t) for t in reader.found if t]

    r = random.Random(2)
    plain = ["<table>", "</table>", "<TR>", "</tr>", "<td>", "</td>", "<th colspan='2'>", "</th>", "<td rowspan=2>", "<br/>", "<td/>", "a", " b  c\n", "&lt;", "&#65;", "\u3000"]
    odd = ["&x", "<", "<!-- c -->", "<script>", "</td x>", "<td colspan>", '<td colspan="&#50;">', "<div"]
    short = 0
    for k in range(3000):
        html = "<table><tr>" + "".join(r.choice(odd) if k % 2 and r.random() < 0.05 else r.choice(plain) for _ in range(r.randint(1, 25))) + "</tr></table>"
        short += grids._read_plain(html) is not None
        assert grids.html_tables(html) == parsed(html), html
    assert short > 1500


def test_argmax_needs_few_suppliers(spark):
    """Of suppliers that only their balance tells apart, those that can come first for some customer: with the same winners, far fewer pairs."""
    import random

    from gridloom.plans import driver

    r = random.Random(4)
    suppliers = [(k, k % 2, r.choice((None, float(r.randint(0, 50)), r.random() * 50))) for k in range(400)]
    kept = driver._foremost(spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int, s_acctbal double")).collect()
    assert len(kept) < 150

    def best(rows, balance):
        points = lambda x: 5 * (x[0] % 5 == 3) + 2 * (balance is not None and x[2] is not None and balance > x[2])
        return min((-points(x), x[0]) for x in rows if x[1] == 1)

    assert all(best(suppliers, b) == best([tuple(k) for k in kept], b) for b in (None, -1.0, 0.0, 10.0, 25.0, 50.0, 99.0))


def test_repair_broadcasts_no_table(spark):
    from gridloom.operators import repair

    row = spark.createDataFrame([("t", 1, "1", "B1", "", "", "m", "3.5", "", "", "")], "table_id string, idx int, seq string, project_code string, project_name string, project_description string, unit string, quantity string, unit_price string, total_price string, remark string")
    grid = spark.createDataFrame([("t", [["-", "B1", "79"]])], "table_id string, grid array<array<string>>")
    made = repair.repair(row, row.where("false"), grid)
    made.collect()
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()


def test_lost_pages_take_one_shuffle(spark):
    """every row was shuffled with its fields, and its page's counts once more."""
    from gridloom.plans import driver

    found = driver.empty_after_filter(spark, "/root/testdata/sf0.001")
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
