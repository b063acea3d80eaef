"""The command line over a small tree."""

import json

import pytest

from gridloom import __main__ as command
from gridloom.sources import excel


def page(tmp_path, doc, no, building, rows):
    for part in ("page_texts", "vl"):
        (tmp_path / part / doc).mkdir(parents=True, exist_ok=True)
    (tmp_path / f"page_texts/{doc}/page_{no:03d}_text.json").write_text(json.dumps({"page_no": no, "text": f"工程名称：某小区{building}"}, ensure_ascii=False))
    cells = [["序号", "项目编码", "项目名称", "计量单位", "工程量", "综合单价", "合价"], *rows]
    (tmp_path / f"vl/{doc}/page_{no:03d}_vl.html").write_text("<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in cells) + "</table>")


def prices(out, doc):
    record = json.loads((out / "business_json_vl_llm" / doc / "business_extract.json").read_text())
    return {(s["sub_project_id"], r["page_no"], r["unit_price"]) for s in record["sub_projects"] for r in s["sub_item_project_rows"]}


@pytest.fixture
def root(tmp_path):
    row = lambda k, price: [str(k), f"01090200100{k}", "屋面", "m2", "2", price, "21"]
    page(tmp_path, "a", 1, "1幢", [row(1, "5")])
    page(tmp_path, "a", 2, "2幢", [row(2, "6")])
    page(tmp_path, "b", 1, "1幢", [row(1, "010902001001")])
    return tmp_path


def test_commands(spark, root, tmp_path):
    out = tmp_path / "out"
    command.main(["extract", str(root), str(out)])
    assert prices(out, "a") == {("a-1幢", 1, "5"), ("a-2幢", 2, "6")} and prices(out, "b") == {("b-1幢", 1, "010902001001")}
    page(root, "a", 2, "2幢", [["2", "010902001002", "屋面", "m2", "2", "7", "21"]])
    command.main(["extract", str(root), str(out), "--file", "a", "--page", "2"])
    assert prices(out, "a") == {("a-1幢", 1, "5"), ("a-2幢", 2, "7")} and prices(out, "b") == {("b-1幢", 1, "010902001001")}
    reports = sorted(p.name for p in (out / "reports").glob("*.json"))
    assert reports == ["a_vl_llm_extract_page_002_partial_summary.json", "a_vl_llm_extract_summary.json", "b_vl_llm_extract_summary.json"]
    command.main(["misaligned", str(out), str(tmp_path / "bad")])
    found = "".join(p.read_text() for p in (tmp_path / "bad").glob("*.csv")).split("\n")
    assert found[0].split("\t")[:2] == ["file_name", "page_no"] and [x.split("\t")[:2] for x in found[1:] if x] == [["b", "1"]]
    command.main(["rerun", str(tmp_path / "again"), *map(str, (tmp_path / "bad").glob("*.csv"))])
    script = "".join(p.read_text() for p in (tmp_path / "again").glob("*.txt"))
    assert "python -m gridloom extract --file 'b' --page 1" in script
    command.main(["export", str(out), str(tmp_path / "books")])
    rows = [r for p in (tmp_path / "books").glob("*.xlsx") for r in list(excel.read_sheet(p.read_bytes()))[1:]]
    assert sorted((r[0], r[3]) for r in rows) == [("a", "a-1幢"), ("a", "a-2幢"), ("b", "b-1幢")]
    command.main(["check", str(out), str(tmp_path / "issues")])
    assert "file_name" in "".join(p.read_text() for p in (tmp_path / "issues").glob("*.csv"))
    command.main(["extract", str(root), str(out), "--skip-existing"])
    assert prices(out, "a") == {("a-1幢", 1, "5"), ("a-2幢", 2, "7")}


def test_bad_page_list(spark, root, tmp_path):
    with pytest.raises(ValueError, match="positive"):
        command.main(["extract", str(root), str(tmp_path / "o"), "--page", "0"])
