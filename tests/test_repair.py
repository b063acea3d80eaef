"""Grid rows found by postings against comparing every row with every grid row."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import repair
from gridloom.sources import scratch

ROW = "table_id string, idx int, seq string, project_code string, project_name string, quantity string, total_price string"


def digits(text):
    return "".join(c for c in text or "" if c in "0123456789.")


def brute(rows, grids):
    out = {}
    for table, idx, seq, code, name, quantity, total in rows:
        best, found = 0, None
        seq, code, name = (seq or "").strip(), (code or "").strip(), "".join((name or "").split())
        quantity, total = digits(quantity), digits(total)
        for k, row in enumerate(grids.get(table, [])):
            cells = [(c or "").strip() for c in row]
            amounts = [digits(c) for c in cells]
            score = 3 * bool(seq and seq in cells) + 5 * bool(code and code in cells) + 3 * bool(name and name in "".join("".join(cells).split())) + 2 * bool(quantity and quantity in amounts) + 3 * bool(total and total in amounts)
            if score > best:
                best, found = score, (score, k, cells)
        if best >= 5:
            out[table, idx] = found
    return out


@pytest.mark.parametrize("seed", range(4))
def test_best_grid_rows(spark, seed):
    r = random.Random(seed)
    word = lambda: r.choice(("挖 土方", "砌墙", "土", "墙 面", "", None, "3"))
    amount = lambda: r.choice(("1", "2", "3", "1.5", "", "￥3", "12,0", None))
    code = lambda: r.choice(("", "", None, f"01{r.randrange(4)}"))
    grids = {f"t{t}": [[r.choice(("1", "2", " 3 ", "")), code(), word(), amount(), amount()][: r.choice((5, 5, 3))] for _ in range(r.choice((1, 8, 25)))] for t in range(8)}
    rows = [(f"t{t}", i, r.choice(("1", "2", "3", "", None)), code(), word(), amount(), amount()) for t in range(9) for i in range(30)]
    found = repair.best_grid_rows(spark.createDataFrame(rows, ROW), repair.grid_lines(spark.createDataFrame(list(grids.items()), "table_id string, grid array<array<string>>")))
    assert {(x.table_id, x.idx): (x.score, x.row_no, x.cells) for x in found.collect()} == brute(rows, grids)


def test_small_tables_stay_where_they_are(spark):
    """Both sides in buckets of the table: small tables are scored without moving a row; tables on either side of the bound agree with brute force."""
    n = repair.FEW
    grids = {f"t{t}": [[str(i), f"c{i % 5}", f"name{i % 3}", str(i % 7), str(i % 4)] for i in range(size)] for t, size in enumerate((1, n - 1, n, n + 1, 3 * n))}
    rows = [(f"t{t}", i, str(i) if i % 2 else "", f"c{i % 6}" if i % 3 == 0 else None, f"name{i % 4}", str(i % 9), str(i % 5)) for t in range(6) for i in range(40)]
    asked = scratch.stored_by(spark.createDataFrame(rows, ROW), "table_id", "asked")
    shown = scratch.stored_by(spark.createDataFrame(list(grids.items()), "table_id string, grid array<array<string>>"), "table_id", "shown")
    found = repair.best_grid_rows(asked, repair.grid_lines(shown))
    assert {(x.table_id, x.idx): (x.score, x.row_no, x.cells) for x in found.collect()} == brute(rows, grids)
    few = repair.best_grid_rows(asked, repair.grid_lines(shown.where(F.size("grid") <= n)))
    assert few.count() and "Exchange" not in few._jdf.queryExecution().executedPlan().toString()


def test_one_huge_table(spark):
    """20,000 rows with one quantity and twenty names, which are worth the points together; postings stay in proportion."""
    n = 20_000
    grid = spark.range(1).select(F.lit("t").alias("table_id"), F.expr(f"transform(sequence(0, {n - 1}), i -> array(concat('s', i), concat('name', i % 20), '7', concat('9', i)))").alias("grid"))
    lines = repair.grid_lines(grid)
    rows = spark.range(n).selectExpr("'t' AS table_id", "cast(id AS int) AS idx", "if(id % 2 = 0, concat('s', id), '') AS seq", "'' AS project_code", "concat('name', id % 20) AS project_name", "'7' AS quantity", "if(id % 4 = 1, concat('9', id), '') AS total_price")
    found = repair.best_grid_rows(rows, lines)
    wrong = found.where("row_no <> CASE WHEN idx % 2 = 0 OR idx % 4 = 1 THEN idx ELSE idx % 20 END OR score <> CASE WHEN idx % 2 = 0 OR idx % 4 = 1 THEN 8 ELSE 5 END")
    assert found.count() == n and wrong.count() == 0
    assert repair.postings(lines).count() <= 8 * n


def test_page_tables_parse_once(spark):
    """Simple HTML is split where it is, other HTML is parsed once, not anew for the filter of the rows; both give the parser's grids."""
    from gridloom.operators import classify, grids
    from gridloom.plans import extraction

    cells = lambda *rows: "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    texts = [cells(["a", " b　", ""], ["c > d"]), cells(["a  b"]), cells(["a&amp;b"], []), "<table></table>", "<table><tr></tr></table>", "x", "", None, cells([""]), cells(["a\nb"]), cells(["a"]) * 2, "<TABLE><tr><td colspan=2>a</td></tr></TABLE>", "<table><tr><th>a</td><td>b</th></tr></table>"]
    html = spark.createDataFrame([("f", i, 0, t) for i, t in enumerate(texts)], "file_name string, page_no int, ordinal int, content string")
    got = {r.page_no: r.g for r in html.select("page_no", grids.html_grids(html["content"]).alias("g")).collect()}
    assert got == {i: grids.html_tables(t) for i, t in enumerate(texts)}
    made = extraction.page_tables(html, html.select("file_name", "page_no", "content").limit(0))
    assert [(r.page_no, r.table_index, r.grid) for r in made.orderBy("page_no", "table_index").collect()] == [(i, k, g) for i, t in enumerate(texts) for k, g in enumerate(grids.html_tables(t))]
    shown = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert shown(made).count("ArrowEvalPython") + shown(made).count("run(") <= 2
    typed = made.select(classify.table_types(made["grid"][0][0], classify.row_texts(made["grid"])).alias("t"))
    assert shown(typed).count("transform(grid") <= 2


def test_json_layout():
    import json

    from gridloom.sources.sinks import _indented

    for value in ({}, [], {"a": [], "b": {}}, {"a": {"b": [1, 2.5, -1e300, True, None, ' "\\\n\x01é']}, 'é"': "屋"}, [[[]], [{}]], 1e16, 10**20):
        assert _indented(json.loads(json.dumps(value))) == json.dumps(value, ensure_ascii=False, indent=2)


def test_sql_table_functions_in_batches(spark):
    """The table functions keep their rows and run over Arrow batches, not by calls for each row."""
    from gridloom import sql

    sql.register(spark)
    spark.createDataFrame([(1, "<table><tr><td>序号</td><td>名称</td></tr><tr><td>1</td><td>a &amp; b</td></tr></table>"), (2, "x"), (3, None)], "k int, c string").createOrReplaceTempView("html_texts")
    made = spark.sql("SELECT t.k, g.table_index, x.idx, x.seq, x.name_spec, x.row_index, x.tax FROM html_texts t, LATERAL html_table(t.c) g, LATERAL extract_rows(array(array('序号', '机械', '名称', '合价'), array(g.grid[1][0], 'm', g.grid[1][1])), 'machine_table') x")
    assert [tuple(r) for r in made.collect()] == [(1, 0, 0, "1", "m", "1", None)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "UDTF" not in plan
