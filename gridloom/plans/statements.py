"""Queries written in Spark SQL alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import sql
from .driver import QUERIES, SQL, query  # noqa: F401  (one registry)


def _said(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    sql.register(spark)
    for name in ("lineitem", "orders", "customer"):
        if f"{{{name}}}" in text:
            text = text.replace(f"{{{name}}}", f"parquet.`{sf_dir}/{name}.parquet`")
    return spark.sql(text)


@query("sql_html_rows", """
SELECT l_orderkey, l_linenumber::VARCHAR AS seq, '0109' || lpad(l_partkey::VARCHAR, 7, '0') AS project_code, l_quantity::INT::VARCHAR AS quantity, l_suppkey::VARCHAR AS unit_price FROM lineitem WHERE l_returnflag <> 'R'""")
def sql_html_rows(spark, sf_dir):
    """HTML of every order through two table functions; subtotal rows go by a scalar one."""
    return _said(spark, sf_dir, """
WITH cells AS (
  SELECT l_orderkey, concat('<tr><td>', l_linenumber, '</td><td>0109', lpad(l_partkey, 7, '0'), '</td><td>', if(l_returnflag = 'R', '本页小计', '屋面'), '</td><td>', int(l_quantity), '</td><td>', l_suppkey, '</td><td>9</td></tr>') AS cell FROM {lineitem}),
html AS (SELECT l_orderkey, concat('<table><tr><td>序号</td><td>项目编码</td><td>项目名称</td><td>工程量</td><td>综合单价</td><td>合价</td></tr>', array_join(array_sort(collect_list(cell)), ''), '</table>') AS content FROM cells GROUP BY l_orderkey)
SELECT l_orderkey, x.seq, x.project_code, x.quantity, x.unit_price
FROM html, LATERAL html_table(html.content) g, LATERAL extract_rows(g.grid, 'sub_item_project_table') x WHERE NOT is_subtotal(x.project_name)""")


@query("sql_chunks", """
WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, (k + 1)::INT AS chunk_index, (2 + 3 * k)::INT AS first_row, (1 + least(3, n - 3 * k))::INT AS n_rows FROM (SELECT l_orderkey, n, unnest(range((n + 2) // 3)) AS k FROM n)""")
def sql_chunks(spark, sf_dir):
    """Markdown of every order, parsed and cut into pieces of three rows under the header."""
    return _said(spark, sf_dir, """
WITH md AS (SELECT l_orderkey, concat('| a | b |\\n|---|---|\\n', array_join(array_sort(collect_list(concat('| ', l_linenumber, ' | ', l_partkey, '.', l_suppkey, ' |'))), '\\n'), '\\n') AS content FROM {lineitem} GROUP BY l_orderkey)
SELECT l_orderkey, c.chunk_index, c.first_row, size(c.grid) AS n_rows FROM md, LATERAL md_table(md.content) g, LATERAL table_chunks(g.grid, 1, 3) c""")


@query("sql_scalars", """
SELECT c_custkey, c_name AS stripped, replace(c_name, ' ', '') AS compacted, abs(round(c_acctbal))::BIGINT::VARCHAR AS amount, true AS is_price, c_nationkey % 2 = 0 AS is_seq, c_nationkey % 3 = 0 AS is_code, 'm2' AS unit, c_nationkey::INT AS page, '20' || c_nationkey AS digits FROM customer""")
def sql_scalars(spark, sf_dir):
    return _said(spark, sf_dir, """
SELECT c_custkey, strip_text(concat('\\t　', c_name, ' \\n')) AS stripped, compact_text(concat(c_name, '　 ')) AS compacted, clean_amount(concat('￥', format_number(abs(round(c_acctbal)), 0), '元')) AS amount,
  is_amount(concat('￥ ', format_number(abs(c_acctbal), 2))) AS is_price, is_valid_seq(if(c_nationkey % 2 = 0, ' 1.2 ', '1.')) AS is_seq, is_project_code(if(c_nationkey % 3 = 0, '010902001001', c_custkey)) AS is_code,
  normalize_unit(' $ m^{2} $ ') AS unit, page_number(concat('x/page_', lpad(c_nationkey, 3, '0'), '_vl.md')) AS page, cjk_digits(concat('二〇', c_nationkey)) AS digits
FROM {customer}""")
