"""Queries that build tables, page texts and model replies from the driver's tables and run the extraction operators on them.

The grid of an order or a nation is made in its type's layout, so that the expected rows follow from the source columns alone.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T
from ..operators import audit, classify, docinfo, extract, gates, grids, model, repair, replies, sections, upsert
from ..sources import engines, overlay, scratch, sinks
from . import extraction
from .driver import QUERIES, SQL, _t, query  # noqa: F401  (one registry)


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _spread(df: DataFrame) -> DataFrame:
    """Small rows with dear work ahead, dealt evenly to all cores: a short file is one task."""
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism)


def _row(*cells: Column | str) -> Column:
    return F.array(*[c if isinstance(c, Column) else F.lit(c) for c in cells])


def _orders(spark, sf_dir, cells: list[Column], head: list[Column]) -> DataFrame:
    """One grid per order: ``head`` rows, then a row of ``cells`` per line in line order."""
    # the columns move, not the cells made of them; the grouping finds its rows where they are
    lines = _t(spark, sf_dir, "lineitem").repartition("l_orderkey").withColumns({"line": _s("l_linenumber"), "part": _s("l_partkey"), "qty": _s(F.col("l_quantity").cast("int")), "supp": _s("l_suppkey"), "price": _s(F.col("l_extendedprice").cast("long"))})
    listed = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.array(*cells).alias("cells")))).alias("r"))
    return listed.select("l_orderkey", F.concat(F.array(*head), F.transform("r", lambda r: r["cells"])).alias("grid"))


def _extracted(spark, sf_dir, kind: str, cells: list[Column], head: list[Column], fields: list[str]) -> DataFrame:
    rows = _orders(spark, sf_dir, cells, head).select("l_orderkey", F.explode(extract.extract(F.col("grid"), kind)).alias("x"))
    return rows.select("l_orderkey", *[f"x.{f}" for f in fields])


LINES = """
l AS (SELECT l_orderkey, l_linenumber::VARCHAR AS line, l_partkey::VARCHAR AS part, l_quantity::INT::VARCHAR AS qty, l_suppkey::VARCHAR AS supp, trunc(l_extendedprice)::BIGINT::VARCHAR AS price,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)::VARCHAR AS pos FROM lineitem)"""


@query("extract_sub_items", f"WITH {LINES} SELECT l_orderkey, line AS seq, '01' || lpad(part, 7, '0') AS project_code, 'item ' || part AS project_name, qty AS quantity, price AS unit_price, supp AS labor_cost, pos AS row_index FROM l")
def extract_sub_items(spark, sf_dir):
    head = [_row("序号", "项目编码", "项目名称", "计量单位", "工程量", "综合单价", "合价", "人工费")]
    cells = [F.col("line"), F.concat(F.lit("01"), F.lpad("part", 7, "0")), F.concat(F.lit("item "), "part"), F.lit("m2"), F.col("qty"), F.col("price"), F.lit("9"), F.col("supp")]
    return _extracted(spark, sf_dir, "sub_item_project_table", cells, head, ["seq", "project_code", "project_name", "quantity", "unit_price", "labor_cost", "row_index"])


@query("extract_split_header", f"WITH {LINES} SELECT l_orderkey, line AS seq, part AS project_name, price AS unit_price, qty AS total_price, (pos::INT + 1)::VARCHAR AS row_index FROM l")
def extract_split_header(spark, sf_dir):
    head = [_row("表", "", "", ""), _row("序号", "项目名称", "", ""), _row("", "", "综合单价", "合价")]
    rows = _extracted(spark, sf_dir, "sub_item_project_table", [F.col("line"), F.col("part"), F.col("price"), F.col("qty")], head, ["seq", "project_name", "unit_price", "total_price", "row_index"])
    return rows.where(rows["seq"] != "")


@query("extract_unit_fees", f"WITH {LINES} SELECT l_orderkey, line AS seq, 'fee ' || part AS fee_name, 'a*' || qty AS formula, price AS amount, '元' AS remark FROM l")
def extract_unit_fees(spark, sf_dir):
    head = [_row("序号", "费用名称", "计算公式", "金额（元）", "备注")]
    cells = [F.concat("line", F.when(F.col("line") == "9", ".1").otherwise("")), F.concat(F.lit("fee "), "part"), F.concat(F.lit("a*"), "qty"), F.concat(F.regexp_replace("price", r"(?<=\d)(?=(?:\d{3})+$)", ","), F.lit("元")), F.lit("")]
    return _extracted(spark, sf_dir, "unit_project_fee_table", cells, head, ["seq", "fee_name", "formula", "amount", "remark"])


@query("extract_specialty_fees", f"WITH {LINES} SELECT l_orderkey, line AS seq, part AS project_name, price AS amount, qty AS provisional_estimate, supp AS tax FROM l")
def extract_specialty_fees(spark, sf_dir):
    head = [_row("专业工程费用表", "", "", "", ""), _row("序号", "工程名称", "金额", "暂估价", "税金")]
    return _extracted(spark, sf_dir, "specialty_fee_table", [F.col(c) for c in ("line", "part", "price", "qty", "supp")], head, ["seq", "project_name", "amount", "provisional_estimate", "tax"])


@query("extract_labor", f"WITH {LINES} SELECT l_orderkey, line AS seq, CASE WHEN qty::INT % 2 = 0 THEN part ELSE qty END AS name, qty AS quantity, price AS unit_price FROM l")
def extract_labor(spark, sf_dir):
    even = F.col("l_quantity").cast("int") % 2 == 0
    cells = [F.col("line"), F.when(even, "").otherwise(F.col("supp")), F.when(even, F.col("part")).otherwise(""), F.col("qty"), F.col("price"), F.lit("1")]
    head = [_row("工日一览", "", "", "", "", ""), _row("序号", "工日", "名称", "数量", "单价", "合价")]
    return _extracted(spark, sf_dir, "labor_table", cells, head, ["seq", "name", "quantity", "unit_price"])


@query("extract_materials", f"WITH {LINES} SELECT l_orderkey, line AS seq, 'bolt ' || part AS name_spec, 'kg' AS unit, qty AS quantity, price AS unit_price FROM l")
def extract_materials(spark, sf_dir):
    head = [_row("序号", "材料名称", "单位", "数量", "单价", "", "合价")]
    odd = F.col("l_suppkey") % 2 == 1
    cells = [F.col("line"), F.concat(F.lit("bolt "), "part"), F.lit("kg"), F.col("qty"), F.when(odd, "").otherwise(F.col("price")), F.when(odd, F.col("price")).otherwise(""), F.lit("5")]
    return _extracted(spark, sf_dir, "material_table", cells, head, ["seq", "name_spec", "unit", "quantity", "unit_price"])


@query("extract_machines", f"WITH {LINES} SELECT l_orderkey, line AS seq, 'crane ' || part AS name_spec, qty AS quantity, price AS total_price FROM l")
def extract_machines(spark, sf_dir):
    head = [_row("机械台班", "", "", ""), _row("序号", "机械名称", "数量", "合价")]
    return _extracted(spark, sf_dir, "machine_table", [F.col("line"), F.concat(F.lit("crane "), "part"), F.col("qty"), F.col("price")], head, ["seq", "name_spec", "quantity", "total_price"])


@query("extract_quantities", f"WITH {LINES} SELECT l_orderkey, line AS seq, part AS name, 'mend' AS repair_content, qty AS quantity FROM l WHERE supp::BIGINT % 3 > 0")
def extract_quantities(spark, sf_dir):
    head = [_row("工程量确认单", "", "", ""), _row("序号", "名称", "维修内容", "工程量")]
    seq = F.when(F.col("l_suppkey") % 3 > 0, F.col("line")).otherwise("total")
    return _extracted(spark, sf_dir, "quantity_confirm_table", [seq, F.col("part"), F.lit("mend"), F.col("qty")], head, ["seq", "name", "repair_content", "quantity"])


@query("merge_table_pages", f"""
WITH {LINES} SELECT l_orderkey, part, row_number() OVER (PARTITION BY l_orderkey ORDER BY pos::INT)::INT AS row_index FROM l WHERE supp::BIGINT % 5 > 1""")
def merge_table_pages(spark, sf_dir):
    k = F.col("l_suppkey") % 5
    rows = _orders(spark, sf_dir, [_s(k), F.col("part"), F.col("line")], [_row("h", "h", "h")]).select("l_orderkey", F.posexplode("grid").alias("pos", "c")).where("pos > 0")
    kind, part = F.col("c")[0], F.col("c")[1]
    made = rows.select("l_orderkey", "pos", F.col("c")[2].cast("int").alias("page_no"), part.alias("part"), F.when(kind == "0", " ").otherwise("1").alias("seq"), F.when(kind == "0", "").when(kind == "1", "项目 编码").otherwise("c").alias("project_code"), F.when(kind == "0", "").otherwise("n").alias("project_name"))
    return upsert.merge_table_pages(made, "l_orderkey").select("l_orderkey", "part", "row_index")


def _html(cells: Column) -> Column:
    return F.concat(F.lit("<p>x</p><TABLE class='t'>"), F.array_join(F.transform(cells, lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))), ""), F.lit("</tr>"))), ""), F.lit("</table><table><tr><th colspan='2'>sum<br/>&amp;</th></tr></table>"))


@query("html_grid", f"""
WITH {LINES}, c AS (SELECT l_orderkey, unnest([0, 0, 0, 1, 1]) AS t, unnest([pos::INT - 1, pos::INT - 1, pos::INT - 1, 0, 0]) AS r, unnest([0, 1, 2, 0, 1]) AS k, unnest(['p ' || part, qty || ' < ' || supp, '', 'sum' || chr(10) || '&', 'sum' || chr(10) || '&']) AS cell FROM l)
SELECT DISTINCT l_orderkey, t AS table_index, r AS row_no, k AS col_no, cell FROM c""")
def html_grid(spark, sf_dir):
    made = _orders(spark, sf_dir, [F.concat(F.lit(" p  "), "part"), F.concat("qty", F.lit(" &lt;\n"), "supp"), F.lit("")], [_row("h", "h", "h")]).select("l_orderkey", _html(F.transform(F.slice("grid", 2, 99), lambda r: F.transform(r, lambda c: F.replace(c, F.lit("\n"), F.lit(" "))))).alias("h"))
    found = made.select("l_orderkey", F.posexplode(grids.html_grids(F.col("h"))).alias("table_index", "g")).select("l_orderkey", "table_index", F.posexplode("g").alias("row_no", "r"))
    return found.select("l_orderkey", "table_index", "row_no", F.posexplode("r").alias("col_no", "cell"))


@query("html_spans", """
SELECT n_nationkey, unnest([0, 0, 0, 0, 1, 1, 1, 1]) AS row_no, unnest([0, 1, 2, 3, 0, 1, 2, 3]) AS col_no, unnest([n_name, 'B', 'C', '', n_name, '', 'C', 'D']) AS cell FROM nation""")
def html_spans(spark, sf_dir):
    html = F.concat(F.lit("<table><tr><td rowspan=2>"), "n_name", F.lit("</td><td>B</td><td rowspan=2>C</td></tr><tr><td>D</td></tr></table>"))
    grid = F.get(grids.html_grids(F.col("h")), F.lit(0))
    return _t(spark, sf_dir, "nation").select("n_nationkey", html.alias("h")).select("n_nationkey", F.posexplode(grid).alias("row_no", "r")).select("n_nationkey", "row_no", F.posexplode("r").alias("col_no", "cell"))


@query("md_grid", f"""
WITH {LINES}, c AS (SELECT l_orderkey, unnest([0, pos::INT, pos::INT, 0]) AS r, unnest([0, 0, 1, 1]) AS k, unnest(['a|b', 'p ' || part, qty, 'c']) AS cell FROM l)
SELECT DISTINCT l_orderkey, 0 AS table_index, r AS row_no, k AS col_no, cell FROM c""")
def md_grid(spark, sf_dir):
    lines = F.transform(F.slice("grid", 2, 99), lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |")))
    text = F.concat(F.lit("intro\n| a\\|b | c |\n|:--|---|\n"), F.array_join(lines, "\n"), F.lit("\n|  | |\n\n| alone | row |\n"))
    made = _orders(spark, sf_dir, [F.concat(F.lit("p   "), "part"), F.col("qty")], [_row("h", "h")]).select("l_orderkey", text.alias("t"))
    found = made.select("l_orderkey", F.posexplode(grids.markdown_grids(F.col("t"))).alias("table_index", "g")).select("l_orderkey", "table_index", F.posexplode("g").alias("row_no", "r"))
    return found.select("l_orderkey", "table_index", "row_no", F.posexplode("r").alias("col_no", "cell"))


@query("classify_page", """
SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'quantity_resource_subtable_labor' WHEN 1 THEN 'quantity_resource_subtable_material_equipment' WHEN 2 THEN 'quantity_resource_subtable_machine'
  WHEN 3 THEN 'sub_item_project_table' WHEN 4 THEN 'quantity_confirmation_form' WHEN 5 THEN 'unit_project_fee_table' WHEN 6 THEN 'specialty_fee_table' ELSE '' END AS types FROM part""")
def classify_page(spark, sf_dir):
    titles = ["主要工日一览表", "主要 材料和工程设备一览表", "主要机械台班一览表", "分部分项工程清单与计价表", "工程量确认单", "单位（专业）工程招标控制价费用表", "专业工程费用表", "现场照片"]
    title = F.get(F.array(*[F.lit(t) for t in titles]), F.col("p_size") % 8)
    grid = F.array(F.array(title, F.lit("")), F.array(_s("p_partkey"), F.col("p_name")))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(classify.table_types(F.col("p_name"), classify.row_texts(grid)), ",").alias("types"))


@query("classify_headers", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'sub_item_project_table' WHEN 1 THEN 'unit_project_fee_table' WHEN 2 THEN 'quantity_resource_subtable_labor' ELSE 'specialty_fee_table' END AS types FROM part""")
def classify_headers(spark, sf_dir):
    heads = [_row("项目编码", "项目名称", "综合单价"), _row("费用名称", "计算公式", ""), _row("工日", "名称", "单价"), _row("工程名称", "金额", "暂估价")]
    grid = F.array(F.array(F.lit(""), F.lit(""), F.lit("")), F.get(F.array(*heads), F.col("p_size") % 4), F.array(F.col("p_name"), F.lit("1"), F.lit("2")))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(classify.table_types(F.lit(""), classify.row_texts(grid)), ",").alias("types"))


@query("backend_types", """
SELECT o_orderkey, unnest([0, 1])::INT AS pos, unnest([['labor_table', 'material_table', 'machine_table', 'quantity_confirm_table', 'unit_project_fee_table'][left(o_orderpriority, 1)::INT], CASE o_orderstatus WHEN 'P' THEN NULL ELSE 'sub_item_project_table' END]) AS backend_type,
  unnest([false, o_orderstatus <> 'P']) AS enabled FROM orders""")
def backend_types(spark, sf_dir):
    """The types found on a page, each as the backend names it and whether it is asked for."""
    kinds = F.array(*map(F.lit, (classify.LABOR, classify.MATERIAL, classify.MACHINE, classify.QUANTITY, classify.UNIT_FEE)))
    types = F.array(F.element_at(kinds, F.left("o_orderpriority", F.lit(1)).cast("int")), F.when(F.col("o_orderstatus") == "P", "unheard_of").otherwise(classify.SUB_ITEM))
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.posexplode(classify.backend_types(types)).alias("pos", "t")).select("o_orderkey", "pos", "t.backend_type", "t.enabled")


@query("building_id", "SELECT c_custkey, (c_custkey % 90 + 1) || CASE WHEN c_nationkey % 2 = 0 THEN '号楼' ELSE '幢' END AS id FROM customer")
def building_id(spark, sf_dir):
    shown = F.concat(F.lit("见 "), _s(F.col("c_custkey") % 90 + 1), F.when(F.col("c_nationkey") % 2 == 0, "号楼").otherwise("幢"), F.lit(" 及 7单元"))
    return _t(spark, sf_dir, "customer").select("c_custkey", classify.building_id(shown).alias("id"))


@query("sub_project_name", """
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Root-' || b || '幢-' || r WHEN 1 THEN 'Root-' || b || '幢' WHEN 2 THEN c_name WHEN 3 THEN c_name WHEN 4 THEN '' ELSE 'Root-' || b || '号楼-' || r END AS name
FROM (SELECT *, (c_custkey % 30 + 1)::VARCHAR AS b, (101 + c_nationkey)::VARCHAR AS r FROM customer)""")
def sub_project_name(spark, sf_dir):
    b, r, name = _s(F.col("c_custkey") % 30 + 1), _s(F.col("c_nationkey") + 101), F.col("c_name")
    c = F.concat
    shown = [c(F.lit("单位（专业）工程名称：甲区 "), b, F.lit("幢-"), r, F.lit("室 标段：一")), c(F.lit("<b>乙区"), b, F.lit("厘</b>第1页共2页")), c(F.lit("x工程名称："), name, F.lit("-1-2-3-4-X5 序号 费用名称")), c(name, name), F.lit("标段：二"), c(F.lit("丙-"), b, F.lit("号楼 "), r, F.lit("户-"))]
    value = F.get(F.array(*shown), (F.col("c_custkey") % 6).cast("int"))
    return _t(spark, sf_dir, "customer").select("c_custkey", classify.clean_name(value, F.lit("2024.1.2Root3幢结算报告书.pdf")).alias("name"))


@query("document_root", "SELECT c_custkey, c_name || '区' AS root FROM customer")
def document_root(spark, sf_dir):
    value = F.concat(F.lit("24-01-02"), "c_name", F.lit("区"), F.when(F.col("c_nationkey") % 2 == 0, "审核报告书").otherwise("- 5号楼东"))
    return _t(spark, sf_dir, "customer").select("c_custkey", classify.document_root(value).alias("root"))


@query("label_name", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_name || '-' || (c_nationkey + 1) || '幢' WHEN 2 THEN (c_nationkey + 1) || '幢' ELSE c_name END AS name FROM customer""")
def label_name(spark, sf_dir):
    b = F.concat(_s(F.col("c_nationkey") + 1), F.lit("幢"))
    texts = [F.concat(F.lit("a\n工程名称："), "c_name", F.lit("\n序号\n")), F.concat(F.lit("工程名称："), "c_name", F.lit("\n"), b, F.lit("\n项目编码")), F.concat(F.lit("see "), b), F.lit("none")]
    grid = F.array(F.array(F.concat(F.lit("工程名称："), F.replace("c_name", F.lit(" "), F.lit("")), F.lit("标段：")), F.lit("")))
    return _t(spark, sf_dir, "customer").select("c_custkey", classify.label_name(F.get(F.array(*texts), (F.col("c_custkey") % 4).cast("int")), grid).alias("name"))


@query("incomplete_name", "SELECT n_nationkey, n_nationkey % 3 <> 0 AS incomplete FROM nation")
def incomplete_name(spark, sf_dir):
    ending = F.get(F.array(F.lit(""), F.lit("、"), F.lit("及其")), F.col("n_nationkey").cast("int") % 3)
    return _t(spark, sf_dir, "nation").select("n_nationkey", classify.is_incomplete(F.concat("n_name", ending)).alias("incomplete"))


@query("consultation_name", """
SELECT c_custkey, CASE c_nationkey % 10 WHEN 1 THEN c_name || 'part two' WHEN 2 THEN c_name || '及其附属部分' WHEN 5 THEN c_name || '改造工程' WHEN 7 THEN c_name || 'x y' WHEN 8 THEN NULL WHEN 9 THEN '' ELSE c_name END AS name FROM customer""")
def consultation_name(spark, sf_dir):
    """Names on and below the label, before it, after a title, in repeated pieces, with runs of blanks; no label, no name."""
    label, name = F.lit("咨询项目全称："), F.col("c_name")
    spaced = F.concat(F.left(name, F.lit(4)), F.lit(" "), F.substring(name, 5, 100))
    lines = lambda *parts: F.concat_ws("\n", F.lit("cover"), *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    texts = [
        lines(F.concat(label, name), "委托单位：x", "more"), lines(F.concat(label, name), " part two __", "（一）概况", "more"), lines(name, F.concat(label, F.lit("及其附属部分")), "二、其他"),
        lines(name, label, "日期：x"), lines(label, "工程造价咨询报告书", name, "目录"), lines(name, F.concat(F.lit(" 咨询项全程 :"), F.lit("改造工程")), "工程名称：y"),
        lines(name, "工程造价咨询报告", label, "委托单位：x"), lines(F.concat(label, name), spaced, "x \t y", name, "编制人"), lines(name), lines("目录", "审核报告", label, "__", "一、概况", name),
    ]
    return _t(spark, sf_dir, "customer").select("c_custkey", docinfo.project_name(F.get(F.array(*texts), (F.col("c_nationkey") % 10).cast("int"))).alias("name"))


@query("report_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def report_date(spark, sf_dir):
    d, c = F.col("o_orderdate"), F.concat
    shown = c(F.year(d), F.lit("年"), F.month(d), F.lit("月"), F.dayofmonth(d), F.lit("日"))
    texts = [c(F.lit("咨询报告日期："), shown), c(F.lit("咨询报告日期\n\nx\n"), shown), c(shown, F.lit("\nunder\n咨询报告日期：none")), c(F.lit("咨询报告日期：\n目录\n1\n2\n3\n4\n咨询报告日期: "), F.concat_ws("/", F.year(d), F.month(d), F.dayofmonth(d)))]
    return _t(spark, sf_dir, "orders").select("o_orderkey", docinfo.report_date(F.get(F.array(*texts), (F.col("o_orderkey") % 4).cast("int"))).alias("day"))


@query("chinese_numbers", "SELECT o_orderkey, (o_orderkey % 99 + 1)::INT AS n FROM orders")
def chinese_numbers(spark, sf_dir):
    n = (F.col("o_orderkey") % 99 + 1).cast("int")
    digit = lambda k: F.get(F.array(*[F.lit(x) for x in "〇一二三四五六七八九"]), k.cast("int"))
    tens, ones = F.floor(n / 10), n % 10
    spelt = F.when(n < 10, digit(n)).otherwise(F.concat(F.when(tens > 1, digit(tens)).otherwise(""), F.lit("十"), F.when(ones > 0, digit(ones)).otherwise("")))
    return _t(spark, sf_dir, "orders").select("o_orderkey", T.chinese_int(F.when(F.col("o_orderkey") % 5 == 0, _s(n)).otherwise(spelt)).alias("n"))


@query("renovation_text", "SELECT c_custkey, CASE WHEN c_nationkey % 3 > 0 THEN c_name || chr(10) || 'two' END AS content FROM customer")
def renovation_text(spark, sf_dir):
    text = F.concat(F.lit("一、工程概况\n"), F.when(F.col("c_nationkey") % 3 > 0, "（一）改造内容：").otherwise("（一）其他\n"), F.lit(" "), "c_name", F.lit("\ntwo\n（二）范围\nrest"))
    return _t(spark, sf_dir, "customer").select("c_custkey", docinfo.renovation_text(text).alias("content"))


@query("construction_section", """
SELECT 'c' || c_custkey AS file_name, 2 AS page_no, CASE c_custkey % 4 WHEN 0 THEN '施工工艺' || chr(10) || c_name || '，' || chr(10) || 'third page goes on' WHEN 1 THEN '一、施工工艺：' || chr(10) || c_name || '。' ELSE '施工工艺' || chr(10) || c_name END AS content, CASE WHEN c_custkey % 4 = 3 THEN 1 ELSE 0 END AS n_images
FROM customer""")
def construction_section(spark, sf_dir):
    k, name, c = (F.col("c_custkey") % 4).cast("int"), F.col("c_name"), F.concat
    first = F.lit("目录\n1、施工工艺\n2、现场踏勘记录表")
    second = [c(F.lit("x\n## 施工工艺\n"), name, F.lit("，")), c(F.lit("一、施工工艺：\n"), name, F.lit("。")), c(F.lit("施工工艺\n"), name, F.lit("\n\n电话：1\nafter")), c(F.lit("施工工艺\n![a](b.png)\n"), name, F.lit("\n工程量确认单"))]
    third = [F.lit("third page goes on"), F.lit("二、其他"), F.lit("1. step"), F.lit("1. step")]
    made = _t(spark, sf_dir, "customer").select(c(F.lit("c"), _s("c_custkey")).alias("file_name"), F.posexplode(F.array(first, F.get(F.array(*second), k), F.get(F.array(*third), k))).alias("p", "text"))
    return sections.construction_processes(made.select("file_name", (F.col("p") + 1).alias("page_no"), "text")).select("file_name", "page_no", "content", F.size("image_refs").alias("n_images"))


@query("compact_text", "SELECT p_partkey, replace(p_name, ' ', '') AS t, length(replace(p_name, ' ', '')) > 0 AS filled FROM part")
def compact_text(spark, sf_dir):
    spaced = F.concat(F.lit(" \u3000"), F.replace("p_name", F.lit(" "), F.lit("\t\u3000 ")), F.lit("\n"))
    return _t(spark, sf_dir, "part").select("p_partkey", T.compact(spaced).alias("t"), (~T.is_blank(spaced)).alias("filled"))


@query("top_level_seq", "SELECT p_partkey, CASE WHEN p_size <= 7 THEN p_size::VARCHAR ELSE '' END AS seq FROM part")
def top_level_seq(spark, sf_dir):
    shown = F.concat(F.lit(" "), _s("p_size"), F.when(F.col("p_size") <= 7, " 其中").otherwise(".1"))
    return _t(spark, sf_dir, "part").select("p_partkey", T.top_level_seq(shown).alias("seq"))


@query("split_amount", """
SELECT c_custkey, CASE c_nationkey % 6 WHEN 0 THEN printf('%.2f', abs(c_acctbal) * 1000) WHEN 2 THEN c_custkey || '.' WHEN 3 THEN '' ELSE c_custkey::VARCHAR END AS amount,
  CASE c_nationkey % 6 WHEN 0 THEN 'about  元x' WHEN 1 THEN '-元' WHEN 2 THEN '元' WHEN 3 THEN 'none, at all' WHEN 4 THEN '' ELSE 'to 7 元' END AS remark,
  CASE c_nationkey % 6 WHEN 0 THEN printf('%.2f', abs(c_acctbal) * 1000) WHEN 1 THEN '-' || c_custkey WHEN 2 THEN c_custkey || '.' WHEN 3 THEN '' ELSE c_custkey::VARCHAR END AS signed, CASE c_nationkey % 6 WHEN 1 THEN '元' END AS signed_rest FROM customer""")
def split_amount(spark, sf_dir):
    key, c = F.col("c_custkey"), F.concat
    texts = [c(F.lit(" about "), F.format_number(F.abs("c_acctbal") * 1000, 2), F.lit(" 元,x")), c(F.lit("-"), key, F.lit("元")), c(key, F.lit(".元")), F.lit("none, at all "), c(F.lit("　"), key), c(key, F.lit(" to 7 元"))]
    text = F.get(F.array(*texts), (F.col("c_nationkey") % 6).cast("int"))
    (amount, remark), (signed, rest) = T.split_amount(text), T.split_amount(text, keep_sign=True)
    return _t(spark, sf_dir, "customer").select("c_custkey", amount.alias("amount"), remark.alias("remark"), signed.alias("signed"), F.when(F.col("c_nationkey") % 6 == 1, rest).alias("signed_rest"))


@query("lenient_json", """
SELECT n_nationkey, CASE n_nationkey % 4 WHEN 3 THEN 'none' ELSE n_name END AS name, CASE WHEN n_nationkey % 4 = 2 THEN 'C:\\x' WHEN n_nationkey % 4 = 3 THEN '' ELSE '1' END AS seq FROM nation""".replace("\\\\", "\\"))
def lenient_json(spark, sf_dir):
    c, name = F.concat, F.col("n_name")
    replies = [c(F.lit('text [{"name": "'), name, F.lit('", "seq": 1}] end')), c(F.lit('```json\n{"name": "'), name, F.lit('", "seq": "1",}\n```')), c(F.lit('[{"name": "'), name, F.lit('", "seq": "C:\\x"}]')), F.lit("[{broken")]
    row = F.get(extract.parse_replies(F.col("r")), F.lit(0))
    made = _t(spark, sf_dir, "nation").select("n_nationkey", F.get(F.array(*replies), (F.col("n_nationkey") % 4).cast("int")).alias("r"))
    return made.select("n_nationkey", F.coalesce(row["name"], F.lit("none")).alias("name"), F.coalesce(row["seq"], F.lit("")).alias("seq"))


def _normalised(kind: str, given: Callable[[Column, Column], dict[str, Column]], wanted: dict[str, str], name: str) -> None:
    columns = ", ".join(f"{sql} AS {f}" for f, sql in wanted.items())

    @query(name, f"SELECT c_custkey, {columns} FROM customer")
    def run(spark, sf_dir):
        made = given(F.col("c_name"), F.format_string("￥%.2f元", F.abs("c_acctbal")))
        row = F.create_map(*[x for k, v in made.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))])
        customers = _spread(_t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"))
        return customers.select("c_custkey", model.normalised(row, kind).alias("r")).select("c_custkey", *[f"r.{f}" for f in wanted])


_AMOUNT_SQL = "printf('%.2f', abs(c_acctbal))"
_normalised("unit_project_fee_table", lambda name, amount: {"序号": "1", "费用名称": F.concat(F.lit("分部分项工程费"), name), "formula": "$\\sum$ (a \\times 5\\%)", "金额(元)": amount}, {"seq": "'1'", "fee_name": "'分部分项工程费' || c_name", "formula": "'Σ(a×5%)'", "amount": _AMOUNT_SQL, "remark": "''"}, "normalise_unit_fee")
_normalised("sub_item_project_table", lambda name, amount: {"seq": "2", "project_code": "010902001001", "项目名称": name, "计量单位": "m2", "其中工程量": "0", "综合单价（元）": amount, "人工费": "7元"}, {"seq": "'2'", "project_code": "'010902001001'", "project_name": "c_name", "unit": "'m2'", "quantity": "''", "unit_price": _AMOUNT_SQL, "total_price": "''", "labor_cost": "'7元'"}, "normalise_sub_item")
_normalised("labor_table", lambda name, amount: {"序号": "1", "name": name, "单位": "工日", "数量": "3", "单价": amount}, {"seq": "'1'", "name": "c_name", "unit": "'工日'", "quantity": "'3'", "unit_price": _AMOUNT_SQL, "total_price": "''"}, "normalise_labor")
_normalised("material_table", lambda name, amount: {"材料名称规格": name, "合价(元)": amount}, {"seq": "''", "name_spec": "c_name", "unit_price": "''", "total_price": _AMOUNT_SQL}, "normalise_material")
_normalised("machine_table", lambda name, amount: {"名称": name, "unit_price": amount}, {"name_spec": "c_name", "unit_price": _AMOUNT_SQL, "remark": "''"}, "normalise_machine")
_normalised("quantity_confirm_table", lambda name, amount: {"name": name, "修缮内容": "roof", "预估工程量": "5 m", "formula": "1*5"}, {"name": "c_name", "repair_content": "'roof'", "quantity": "'5 m'", "formula": "'1*5'"}, "normalise_quantity")
_normalised("specialty_fee_table", lambda name, amount: {"名称": name, "金额": amount, "安全文明施工费": "1,5", "规费": "2元", "税": "3"}, {"project_name": "c_name", "amount": _AMOUNT_SQL, "safety_civilization_fee": "'15'", "regulatory_fee": "'2'", "tax": "'3'"}, "normalise_specialty_fee")


@query("json_cell", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN '[{\"name\":\"' || n_name || '\"}]' ELSE '' END AS cell FROM nation")
def json_cell(spark, sf_dir):
    rows = F.array(F.struct(F.col("n_name").alias("name")))
    return _t(spark, sf_dir, "nation").select("n_nationkey", T.json_cell(F.when(F.col("n_nationkey") % 2 == 0, rows).otherwise(F.slice(rows, 1, 0))).alias("cell"))


@query("row_key", "SELECT n_nationkey, '{\"a\":\"' || n_name || '\",\"unit\":\"m2\"}' AS key FROM nation")
def row_key(spark, sf_dir):
    row = F.struct(F.lit(" $ m^{2} $ ").alias("unit"), F.col("n_name").alias("a"))
    return _t(spark, sf_dir, "nation").select("n_nationkey", T.row_key(row, ["unit", "a"]).alias("key"))


@query("issue_labels", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'JSON读取失败:' || n_name WHEN 1 THEN '存在空行' ELSE 'other' END AS label FROM nation")
def issue_labels(spark, sf_dir):
    codes = F.array(F.concat(F.lit("json_error:"), "n_name"), F.lit("has_empty_rows"), F.lit("other"))
    return _t(spark, sf_dir, "nation").select("n_nationkey", T.issue_label(F.get(codes, (F.col("n_nationkey") % 3).cast("int")), rules.ISSUES).alias("label"))


@query("target_gate", """
SELECT p_partkey, p_size % 5 IN (1, 3) AS should_run, CASE p_size % 5 WHEN 0 THEN 'skip_blacklist_priority' WHEN 1 THEN 'whitelist_priority' WHEN 2 THEN 'skip_blacklist_priority' WHEN 3 THEN 'target_structure_priority' ELSE 'skip_non_target_table' END AS policy FROM part""")
def target_gate(spark, sf_dir):
    texts = ["工程量 确认单 x", "分部分项工程清单与计价表", "分部分项工程清单与计价表 施工工艺", "项目 编码 项目名称 综合单价", "photo"]
    shown = F.concat("p_name", F.lit("\n"), F.get(F.array(*[F.lit(t) for t in texts]), F.col("p_size") % 5))
    decided = _t(spark, sf_dir, "part").select("p_partkey", gates.target_decision(shown).alias("d"))
    return decided.select("p_partkey", "d.should_run", "d.policy")


@query("table_gate", f"""
WITH {LINES}, g AS (SELECT l_orderkey, count(*) AS n FROM l GROUP BY l_orderkey)
SELECT l_orderkey, (8 + 2 * n)::INT AS items, (5 + n >= 8 OR 8 + 2 * n >= 8) AS is_table_like, (3 + CASE WHEN n >= 8 THEN 2 WHEN n >= 4 THEN 1 ELSE 0 END + 2 + 3 + CASE WHEN 8 + 2 * n >= 25 THEN 2 WHEN 8 + 2 * n >= 15 THEN 1 ELSE 0 END)::INT AS score FROM g""")
def table_gate(spark, sf_dir):
    item = lambda text, x, y: F.struct(text.alias("text"), F.array(F.array(x, y)).alias("bbox"))
    head = F.array(*[item(F.lit(t), F.lit(float(100 * k)), F.lit(0.0)) for k, t in enumerate(("序号", "项目编码", "项目名称", "综合单价", "合价", " ", "a", "b", "c"))])
    rows = _orders(spark, sf_dir, [F.col("qty"), F.concat(F.lit("long name of the part "), "part")], [_row("h", "h")]).withColumn("r", F.slice("grid", 2, 99))
    cells = F.flatten(F.transform("r", lambda r, i: F.array(item(r[0], F.lit(0.0), (i + 1) * 40.0), item(r[1], F.lit(400.0), (i + 1) * 40.0))))
    made = rows.select("l_orderkey", F.concat(head, cells).alias("parts"))
    texts = gates.item_texts(F.col("parts"))
    x, y = (F.transform("parts", _centre(k)) for k in (0, 1))
    scored = made.select("l_orderkey", F.size(texts).alias("items"), gates.table_score(texts, F.size(texts), gates.buckets(x, gates.BUCKET_X), F.greatest(gates.buckets(y, gates.BUCKET_Y), F.lit(4)), ("项目编码", "综合单价"), ()).alias("s"))
    return scored.select("l_orderkey", "items", "s.is_table_like", "s.score")


def _centre(k: int):
    return lambda i: i["bbox"][0][k]


@query("gate_conjunction", "SELECT n_nationkey, n_nationkey % 5 = 0 OR (n_nationkey % 2 = 0 AND n_nationkey % 3 <> 0) AS goes_on FROM nation")
def gate_conjunction(spark, sf_dir):
    k = F.col("n_nationkey")
    target = F.when(k % 3 == 0, False)
    return _t(spark, sf_dir, "nation").select("n_nationkey", gates.gate(k % 2 == 0, target, k % 5 == 0).alias("goes_on"))


@query("gate_summary", """
SELECT o_custkey::VARCHAR AS file_name, count(*) AS pages, count(*) FILTER (o_totalprice > 200000) AS target_pages, count(*) FILTER (o_orderstatus = 'F') AS vl_pages, count(*) FILTER (o_orderstatus = 'P') AS failed_pages, grouping(o_custkey)::INT AS is_total FROM orders GROUP BY ROLLUP (o_custkey)""")
def gate_summary(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select(_s("o_custkey").alias("file_name"), F.col("o_orderkey").alias("page_no"), (F.col("o_totalprice") > 200000).alias("target"), (F.col("o_orderstatus") == "F").alias("vl"), F.when(F.col("o_orderstatus") == "P", "error").alias("error"))
    return gates.document_summary(rows).select("file_name", "pages", "target_pages", "vl_pages", "failed_pages", "is_total")


@query("best_grid_row", f"""
WITH {LINES}, g AS (SELECT l_orderkey, pos::INT AS k, [line, part, qty, price] AS cells FROM l),
s AS (SELECT r.l_orderkey, r.pos::INT AS idx, g.k, g.cells, 3 * list_contains(g.cells, r.line)::INT + 3 * contains(array_to_string(g.cells, ''), left(r.part, 3))::INT + 2 * list_contains(g.cells, r.qty)::INT + 3 * list_contains(g.cells, r.supp)::INT AS score
  FROM l r JOIN g ON r.l_orderkey = g.l_orderkey)
SELECT l_orderkey, idx, score, k AS row_no, array_to_string(cells, '|') AS cells FROM s WHERE score >= 5 QUALIFY row_number() OVER (PARTITION BY l_orderkey, idx ORDER BY score DESC, k) = 1""")
def best_grid_row(spark, sf_dir):
    """Every line of an order against the order's grid: numbers, beginnings of names, quantities and totals that often fit other lines too."""
    made = _orders(spark, sf_dir, [F.col("line"), F.col("part"), F.col("qty"), F.col("price"), F.col("supp")], [_row("no", "code", "qty", "total", "supp")])
    made = scratch.stored_by(made.withColumnRenamed("l_orderkey", "table_id"), "table_id", "orders")
    shown = made.select("table_id", F.transform("grid", lambda r: F.slice(r, 1, 4)).alias("grid"))
    lines = made.select("table_id", F.posexplode("grid").alias("idx", "r")).where("idx > 0")
    rows = lines.select("table_id", "idx", F.col("r")[0].alias("seq"), F.lit("").alias("project_code"), F.left(F.col("r")[1], F.lit(3)).alias("project_name"), F.col("r")[2].alias("quantity"), F.col("r")[4].alias("total_price"))
    found = repair.best_grid_rows(rows, repair.grid_lines(shown))
    return found.select(F.col("table_id").alias("l_orderkey"), "idx", "score", "row_no", F.array_join("cells", "|").alias("cells"))


@query("price_recovery", f"""
WITH {LINES} SELECT l_orderkey, line AS seq, CASE WHEN line = '7' THEN '11.5' ELSE ['77', '78', '79', '80'][line::INT % 4 + 1] END AS unit_price FROM l""")
def price_recovery(spark, sf_dir):
    """Every line of an order: the price left of the total, in its own column, left of the total's column, right of the quantity, or (line 7) from the rules' row."""
    way = F.col("line").cast("int") % 4
    code = F.concat(F.lit("B"), "line")
    cells = [F.lit("-"), code, F.when(way == 2, "79").otherwise("x"), F.lit("3.5"), F.when(way == 0, "77").when(way == 1, "78").otherwise("-"), F.when(way == 0, "990").when(way == 3, "80").otherwise("-"), F.col("line")]
    made = _orders(spark, sf_dir, cells, [_row("序号", "项目编码", "项目名称", "工程量", "综合单价", "合价")])
    made = scratch.stored(made.withColumn("table_id", _s("l_orderkey")), "orders")
    lines = made.select("table_id", F.posexplode("grid").alias("idx", "r")).where("idx > 0")
    blank, line = F.lit(""), F.col("r")[6]
    rows = lines.select(
        "table_id", "idx", line.alias("seq"), F.col("r")[1].alias("project_code"), blank.alias("project_name"), blank.alias("project_description"), F.lit("m").alias("unit"), F.lit("3.5").alias("quantity"), blank.alias("unit_price"),
        F.when(F.col("r")[5] == "990", "990").otherwise("").alias("total_price"), blank.alias("remark"))
    ruled = rows.where("seq = '7'").dropDuplicates(["table_id"]).withColumn("unit_price", F.lit("11.5"))
    shown = made.select("table_id", F.transform("grid", lambda r: F.slice(r, 1, 6)).alias("grid"))
    return repair.repair(rows, ruled, shown).select(F.col("table_id").cast("long").alias("l_orderkey"), "seq", "unit_price")


@query("row_admission", f"""
WITH {LINES} SELECT l_orderkey, pos, CASE WHEN supp::BIGINT % 2 = 0 THEN '' ELSE qty END AS provisional_estimate FROM l WHERE supp::BIGINT % 3 > 0 OR price::BIGINT % 2 = 0""")
def row_admission(spark, sf_dir):
    odd, blank = F.col("l_suppkey") % 2 == 1, F.lit("")
    made = _orders(spark, sf_dir, [F.when(F.col("l_suppkey") % 3 > 0, "010902001001").otherwise("甲幢"), F.when(F.col("price").cast("long") % 2 == 0, "m").otherwise(""), F.when(odd, "x").otherwise(F.col("qty")), F.col("qty")], [_row("", "", "", "")])
    rows = made.select("l_orderkey", F.posexplode("grid").alias("p", "c")).where("p > 0")
    c = F.col("c")
    flat = rows.select("l_orderkey", _s("p").alias("pos"), c[0].alias("project_code"), c[1].alias("unit"), c[2].alias("labor_cost"), c[3].alias("provisional_estimate"), *[blank.alias(n) for n in ("project_description", "quantity", "unit_price", "total_price")])
    return repair.admit(flat).select("l_orderkey", "pos", "provisional_estimate")


@query("unit_fee_dedupe", "SELECT l_orderkey, l_returnflag AS seq, l_linestatus AS fee_name, min(l_linenumber)::INT AS idx FROM lineitem GROUP BY ALL")
def unit_fee_dedupe(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("seq"), F.col("l_linestatus").alias("fee_name"), F.lit("5").alias("amount"), F.col("l_linenumber").cast("int").alias("idx"))
    return repair.distinct_fees(rows, ["l_orderkey"], ["idx"]).select("l_orderkey", "seq", "fee_name", "idx")


@query("rekey_sub_projects", """
SELECT n_regionkey, 'sub' AS part, n_name AS id, NULL::BIGINT AS n FROM (SELECT DISTINCT n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN 'EVEN' ELSE n_name END AS n_name FROM nation)
UNION ALL SELECT n_regionkey, 'row', CASE WHEN n_nationkey % 2 = 0 THEN 'EVEN' ELSE n_name END, count(*) FROM nation GROUP BY ALL""")
def rekey_sub_projects(spark, sf_dir):
    file, key = _s("n_regionkey").alias("file_name"), F.col("n_nationkey")
    old = F.when(key % 2 == 0, F.concat(F.lit("工程名称：EVEN 第"), _s(key), F.lit("页"))).otherwise(F.concat("n_name", F.lit(" ")))
    nations = _t(spark, sf_dir, "nation")
    subs = nations.select(file, old.alias("sub_project_id"), key.alias("ord"))
    rows = nations.select(file, old.alias("sub_id"), F.when(key % 3 == 0, "").otherwise(old).alias("sub_project_id"))
    merged, moved = upsert.rekey_sub_projects(subs, rows, classify.clean_name(F.col("value"), F.lit("")))
    counted = moved.groupBy("file_name", "sub_project_id").agg(F.count("*").alias("n"))
    both = merged.select("file_name", F.lit("sub").alias("part"), F.col("sub_project_id").alias("id"), F.lit(None).cast("long").alias("n")).unionByName(counted.select("file_name", F.lit("row").alias("part"), F.col("sub_project_id").alias("id"), "n"))
    return both.select(F.col("file_name").cast("long").alias("n_regionkey"), "part", "id", "n")


@query("partial_run_merge", """
SELECT o_orderkey, o_orderstatus AS status, 'old' AS run FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, o_orderstatus, 'new' FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def partial_run_merge(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("file_name"), F.col("o_orderkey").alias("page_no"), "o_totalprice")
    merged = upsert.merge_project_rows(orders.withColumn("run", F.lit("old")), orders.where("file_name = 'F' AND o_totalprice > 100000").withColumn("run", F.lit("new")), orders.where("file_name = 'F'"))
    return merged.select(F.col("page_no").alias("o_orderkey"), F.col("file_name").alias("status"), "run")


@query("partial_run", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_custkey % 2 > 0 WHEN 'P' THEN true ELSE o_custkey % 3 > 0 END AS partial FROM orders")
def partial_run(spark, sf_dir):
    status, cust = F.col("o_orderstatus"), F.col("o_custkey")
    none = F.lit(None).cast("int")
    selected = F.when((status == "F") & (cust % 2 > 0), F.array(cust)).when(status == "F", F.slice(F.array(cust), 1, 0))
    return _t(spark, sf_dir, "orders").select("o_orderkey", upsert.partial_runs(selected, F.when(status == "P", 2).otherwise(none), F.when(status == "F", 0).otherwise(none), F.when(status == "O", cust % 3)).alias("partial"))


@query("merge_sub_projects", """
SELECT n_regionkey, n_name AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'new' ELSE 'old' END AS name, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey % 3 = 0, n_nationkey) - 1)::INT AS ord FROM nation WHERE n_nationkey % 3 <> 0 OR n_nationkey % 2 = 0""")
def merge_sub_projects(spark, sf_dir):
    base = _t(spark, sf_dir, "nation").select(_s("n_regionkey").alias("file_name"), F.col("n_name").alias("sub_project_id"), F.lit("").alias("parent_project"), F.col("n_nationkey").alias("ord"))
    side = lambda cond, name: base.where(cond).withColumn("sub_project_name", F.lit(name))
    merged = upsert.merge_sub_projects(side("ord % 3 <> 0", "old"), side("ord % 2 = 0", "new"))
    return merged.select(F.col("file_name").cast("long").alias("n_regionkey"), F.col("sub_project_id").alias("id"), F.col("sub_project_name").alias("name"), "ord")


@query("document_info_merge", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'old' END AS a, 'kept' AS b FROM nation")
def document_info_merge(spark, sf_dir):
    old = F.struct(F.lit("old").alias("a"), F.lit("kept").alias("b"))
    new = F.struct(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(" ").alias("a"), F.lit("").alias("b"))
    return _t(spark, sf_dir, "nation").select("n_nationkey", upsert.merge_document_info(old, new, ("a", "b")).alias("m")).select("n_nationkey", "m.a", "m.b")


@query("lift_quantities", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'top' ELSE 'nested' END AS name FROM nation")
def lift_quantities(spark, sf_dir):
    rows = _t(spark, sf_dir, "nation").select("n_nationkey", F.lit("s").alias("sub_project_id"))
    return upsert.lift_quantities(rows.where("n_nationkey % 2 = 0").withColumn("name", F.lit("top")), rows.where("n_nationkey % 2 = 1").withColumns({"name": F.lit("nested"), "sub_project_name": F.lit("n")}))


@query("prompt_text", fr"""
WITH {LINES}, r AS (SELECT l_orderkey, pos::INT AS k, printf('row_%03d: col_001="%s" | col_002="%s"', pos::INT + 1, part, '\"' || qty || '\nz') AS line FROM l)
SELECT l_orderkey, 'row_001: col_001="a" | col_002=""' || chr(10) || string_agg(line, chr(10) ORDER BY k) AS rows FROM r GROUP BY l_orderkey""")
def prompt_text(spark, sf_dir):
    made = _orders(spark, sf_dir, [F.col("part"), F.concat(F.lit(' "'), "qty", F.lit("\nz "))], [_row("a")])
    return made.select("l_orderkey", F.regexp_replace(model.table_text(F.col("grid"), "labor_table"), r"(?s)\A.*?\n(?=row_001)", "").alias("rows"))


@query("row_chunking", f"""
WITH {LINES}, s AS (SELECT l_orderkey, count(*)::INT AS n FROM l GROUP BY l_orderkey)
SELECT l_orderkey, unnest(range(1, CASE WHEN n <= 1 THEN 2 ELSE n + 1 END))::INT AS chunk_index, 1 AS data_rows, 1 + unnest(range(1, CASE WHEN n <= 1 THEN 2 ELSE n + 1 END))::INT AS source_row_start FROM s""")
def row_chunking(spark, sf_dir):
    made = _orders(spark, sf_dir, [F.col("line"), F.repeat(F.lit("x"), F.lit(490)), F.repeat(F.lit("y"), F.lit(490)), F.repeat(F.lit("z"), F.lit(490))], [_row("序号", "a", "b", "c")])
    chunks = made.select("l_orderkey", F.explode(model.table_chunks(F.col("grid"), "labor_table", 1000)).alias("c"))
    return chunks.select("l_orderkey", "c.chunk_index", "c.data_rows", "c.source_row_start")


@query("greedy_chunk", """
WITH RECURSIVE t AS (SELECT conv_id, text, length(text) + 1 AS own, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
c AS (SELECT conv_id, k, 0 AS chunk, own AS size, text FROM t WHERE k = 1
  UNION ALL SELECT t.conv_id, t.k, CASE WHEN c.size + t.own > 300 THEN c.chunk + 1 ELSE c.chunk END, CASE WHEN c.size + t.own > 300 THEN t.own ELSE c.size + t.own END, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k = c.k + 1)
SELECT conv_id, chunk, md5(trim(string_agg(text, chr(10) ORDER BY k))) AS digest FROM c GROUP BY conv_id, chunk""")
def greedy_chunk(spark, sf_dir):
    from ..operators.sequences import chunk_lines

    turns = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return turns.select("conv_id", F.posexplode(chunk_lines(F.col("t.text"), 300)).alias("chunk", "c")).select("conv_id", "chunk", F.md5("c").alias("digest"))


def _recorded(spark: SparkSession, given: DataFrame, settings: engines.ModelSettings) -> replies.StoredBackend:
    """A backend that answers from a table of recorded replies and asks nobody."""
    store = replies.ReplyStore(spark, scratch.new_folder(spark, "replies"))
    replies.record(store, given, settings)
    return replies.StoredBackend(store, settings)


def _told(rows: Column) -> Column:
    """A reply as models give it: a fenced JSON list."""
    return F.concat(F.lit("```json\n"), F.to_json(rows), F.lit("\n```"))


@query("model_extraction", f"WITH {LINES} SELECT l_orderkey, (line)::VARCHAR AS seq, 'p' || part AS name_spec FROM l")
def model_extraction(spark, sf_dir):
    """Orders as tables too long for one prompt; the replies to their chunks are rows of a table, the last one under another key."""
    tables = _orders(spark, sf_dir, [F.col("line"), F.concat(F.lit("p"), "part"), F.repeat(F.lit("x"), F.lit(490))], [_row("序号", "名称", "备注")])
    asked = model.prompts(tables.withColumn("_grid", F.col("grid")), "machine_table", 3500)
    rows = F.transform(F.slice("_grid", F.col("source_row_start") + F.when(F.col("source_row_start") > 1, 0).otherwise(1), F.col("data_rows")), lambda r: F.struct(F.get(r, F.lit(0)).alias("序号"), F.get(r, F.lit(1)).alias("名称")))
    backend = _recorded(spark, asked.select("prompt", _told(rows).alias("reply")), engines.ModelSettings("recorded"))
    return model.extract_tables(tables, "machine_table", backend, limit=3500).select("l_orderkey", "seq", "name_spec")


@query("recorded_extraction", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'n' || o_custkey END AS name FROM orders")
def recorded_extraction(spark, sf_dir):
    """Orders without a recorded reply keep a null; what is asked for twice is stored once."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", F.array(F.array(F.lit("名称")), F.array(_s("o_custkey"), "o_orderstatus")).alias("grid"))
    asked = model.prompts(orders, "labor_table")
    known = asked.where("o_orderstatus <> 'P'").select("prompt", F.concat(F.lit('[{"name": "n'), "o_custkey", F.lit('"},]')).alias("reply"))
    found = _recorded(spark, known, engines.ModelSettings("recorded", max_tokens=64)).answered(asked)
    return found.select("o_orderkey", F.get(extract.parse_replies(F.col("reply")), F.lit(0))["name"].alias("name"))


@query("process_cleaning", "SELECT o_orderkey::VARCHAR AS file_name, CASE WHEN o_totalprice > 200000 THEN upper(o_orderpriority) ELSE o_orderpriority || o_orderkey END AS cleaned_content, (o_totalprice > 200000)::INT AS n_items FROM orders")
def process_cleaning(spark, sf_dir):
    rich = F.col("o_totalprice") > 200000
    made = _t(spark, sf_dir, "orders").select(_s("o_orderkey").alias("file_name"), F.concat("o_orderpriority", _s("o_orderkey")).alias("content"), F.when(rich, F.upper("o_orderpriority")).alias("mended"))
    item = F.struct(F.lit("t").alias("target"), F.lit("s").alias("section"), F.array(F.lit("a")).alias("steps"))
    reply = F.when(F.col("mended").isNull(), "no").otherwise(F.to_json(F.struct(F.col("mended").alias("cleaned_content"), F.array(item).alias("structured_items"))))
    backend = _recorded(spark, made.select(model.process_prompt(F.col("content")).alias("prompt"), reply.alias("reply")), engines.ModelSettings("recorded"))
    return model.cleaned_processes(made.drop("mended"), backend).select("file_name", "cleaned_content", F.size("structured_items").alias("n_items"))


def _blank_page(sizes: pd.DataFrame) -> pd.Series:
    import numpy as np

    made = {(w, h): overlay.encode(np.full((h, w, 3), 255, np.uint8)) if w > 0 else b"no image" for w, h in set(zip(sizes["w"], sizes["h"], strict=True))}
    return pd.Series([made[size] for size in zip(sizes["w"], sizes["h"], strict=True)])


def _measure(settings: engines.PageSettings):
    """A recogniser of drawn boxes: the image's size and its pixels in the boxes' colour."""

    def read(image: bytes) -> dict:
        pixels = overlay.decode(image)
        return {"width": pixels.shape[1], "height": pixels.shape[0], "green": int((pixels == overlay.BOX).all(axis=2).sum())}

    return read


@query("box_overlay", """
WITH o AS (SELECT o_orderkey, o_orderstatus, 6 + length(o_orderpriority) AS w, 6 + length(o_orderstatus || o_custkey) AS h FROM orders)
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 40 END::INT AS width, CASE WHEN o_orderstatus <> 'P' THEN 30 END::INT AS height, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 0 ELSE 6 * w + 6 * h - 4 END::INT AS green,
  CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 0 ELSE 1 END::INT AS boxes, CASE WHEN o_orderstatus = 'P' THEN 'ValueError: no PNG image' END AS error FROM o""")
def box_overlay(spark, sf_dir):
    """A page an order: a box of sizes from its columns is drawn, then measured by a recogniser kept in the worker; one status has no image, one a box of three corners."""
    w, h = (F.lit(6) + F.length("o_orderpriority")).cast("double"), (F.lit(6) + F.length(F.concat("o_orderstatus", _s("o_custkey")))).cast("double")
    at = lambda x, y: F.array(F.lit(5.0) + x, F.lit(5.0) + y)
    none = F.lit(0.0)
    box = F.array(at(none, none), at(w, none), at(w, h), at(none, h))
    item = F.struct(F.lit("t").alias("text"), F.lit(0.5).alias("score"), F.when(F.col("o_orderstatus") == "F", F.slice(box, 1, 3)).otherwise(box).alias("bbox"))
    wide = F.when(F.col("o_orderstatus") == "P", 0).otherwise(40)
    blank = F.pandas_udf(_blank_page, "binary")
    orders = _spread(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey"))
    pages = orders.select(_s("o_orderkey").alias("file_name"), F.lit(1).alias("page_no"), blank(F.struct(wide.alias("w"), F.lit(30).alias("h"))).alias("image"), F.array(item).alias("items"))
    made = scratch.stored(overlay.overlays(pages, labels=False), "overlays")  # drawn once, read for the images and for the counts
    seen = engines.recognise(made.where("error IS NULL"), _measure, engines.PageSettings(device="cpu"), "struct<width:int,height:int,green:int>")
    joined = made.select("file_name", "boxes", "error").join(seen.select("file_name", "result"), "file_name", "left")
    return joined.select(F.col("file_name").cast("long").alias("o_orderkey"), "result.width", "result.height", "result.green", "boxes", "error")


#: Orders as documents: a page a line number, its lines a table; the first two pages are of one building, the others of another.
BOOKED = """p AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
b AS (SELECT l_orderkey, CASE WHEN l_linenumber <= 2 THEN 'o' || l_orderkey || '-1幢' ELSE 'o' || l_orderkey || '-2幢' END AS sub_project_id, l_linenumber::VARCHAR AS seq, '0109' || lpad(l_partkey::VARCHAR, 7, '0') AS project_code, l_suppkey::VARCHAR AS unit_price FROM lineitem)"""


def _booked(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(texts, html) of the orders."""
    lines = _t(spark, sf_dir, "lineitem").select(F.concat(F.lit("o"), _s("l_orderkey")).alias("file_name"), F.col("l_linenumber").cast("int").alias("page_no"), _s("l_linenumber").alias("seq"), F.concat(F.lit("0109"), F.lpad(_s("l_partkey"), 7, "0")).alias("code"), _s("l_suppkey").alias("price"), _s(F.col("l_quantity").cast("int")).alias("qty"))
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), *[cell(F.col(c) if isinstance(c, str) else c) for c in ("seq", "code", F.lit("屋面"), F.lit("m2"), "qty", "price", F.lit("999999999"))], F.lit("</tr>"))
    head = F.lit("<table><tr>" + "".join(f"<td>{h}</td>" for h in ("序号", "项目编码", "项目名称", "计量单位", "工程量", "综合单价", "合价")) + "</tr>")
    html = lines.groupBy("file_name", "page_no").agg(F.concat(head, F.array_join(F.array_sort(F.collect_list(row)), ""), F.lit("</table>")).alias("content")).withColumn("ordinal", F.lit(0))
    texts = lines.select("file_name", "page_no").distinct().withColumn("text", F.concat(F.lit("工程名称：某小区"), F.when(F.col("page_no") <= 2, "1幢").otherwise("2幢")))
    return texts, html


def _flat(files: DataFrame) -> DataFrame:
    """The rows of records that were written as JSON."""
    kind = "file_name string, total_pages int, sub_projects array<struct<sub_project_id:string,sub_item_project_rows:array<struct<seq:string,project_code:string,unit_price:string,page_no:int>>>>"
    read = files.select(F.from_json(F.decode("content", "UTF-8"), kind).alias("r"))
    subs = read.select(F.substring("r.file_name", 2, 99).cast("long").alias("l_orderkey"), F.col("r.total_pages").cast("long").alias("total_pages"), F.explode("r.sub_projects").alias("s"))
    return subs.select("l_orderkey", "total_pages", "s.sub_project_id", F.explode("s.sub_item_project_rows").alias("x")).select("l_orderkey", "total_pages", "sub_project_id", "x.seq", "x.project_code", "x.unit_price")


@query("business_json", f"WITH {BOOKED} SELECT b.*, n.total_pages FROM b JOIN (SELECT l_orderkey, count(*) AS total_pages FROM p GROUP BY l_orderkey) n USING (l_orderkey)")
def business_json(spark, sf_dir):
    """Pages to nested records to pretty JSON, and back."""
    texts, html = _booked(spark, sf_dir)
    none = html.select("file_name", "page_no", "ordinal", "content").limit(0)
    return _flat(scratch.stored(sinks.record_files(extraction.run(texts, html, none, "2024-01-01")), "files"))


@query("business_merge", f"""
WITH {BOOKED}, n AS (SELECT l_orderkey, count(*) AS total_pages FROM p GROUP BY l_orderkey)
SELECT b.l_orderkey, total_pages, sub_project_id, seq, project_code, CASE WHEN seq IN ('2', '3') THEN '7' ELSE unit_price END AS unit_price FROM b JOIN n USING (l_orderkey)""")
def business_merge(spark, sf_dir):
    """A second run over pages 2 and 3, with another price, merged into the records of the first by page."""
    texts, html = _booked(spark, sf_dir)
    none = html.select("file_name", "page_no", "ordinal", "content").limit(0)
    first = scratch.stored(extraction.run(texts, html, none, "2024-01-01"), "first-run")
    again = html.where("page_no IN (2, 3)").withColumn("content", F.regexp_replace("content", "<td>[0-9]+</td><td>999999999", "<td>7</td><td>999999999"))
    second = scratch.stored(extraction.run(texts.where("page_no IN (2, 3)"), again, none, "2024-01-02"), "second-run")
    run = texts.where("page_no IN (2, 3)").groupBy("file_name").agg(F.collect_list("page_no").alias("page_numbers"))
    merged = upsert.merge_records(first, second, run, [], ["sub_item_project_rows"], ["consultation_project_name", "consultation_date", "renovation_content"])
    return _flat(scratch.stored(sinks.record_files(merged), "files"))


@query("cleaning_details", """
SELECT l_orderkey, l_linenumber, string_agg(reason, '、' ORDER BY k) AS reasons FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, unnest([1, 2]) AS k, unnest([CASE WHEN l_returnflag = 'R' THEN '缺少seq' END, CASE WHEN l_partkey % 17 = 0 THEN '缺少name' END]) AS reason FROM lineitem)
WHERE reason IS NOT NULL GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice""")
def cleaning_details(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", "").otherwise("1").alias("seq"), F.when(F.col("l_partkey") % 17 == 0, " ").otherwise("n").alias("project_name"))
    return audit.removed_rows(rows).select("l_orderkey", "l_linenumber", "reasons")

