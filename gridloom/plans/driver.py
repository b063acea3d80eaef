"""The domain's operators on the driver's tables, each with its DuckDB SQL.

Orders stand for documents and line numbers for pages; ``sub_items`` dresses line items
as sub-item rows, so that the audit operators run unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators import audit, gates, pages, sequences, upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sub_items(lineitem: DataFrame) -> DataFrame:
    """Line items as sub-item rows of a document."""
    code, price = F.format_string("%09d", "l_partkey"), F.col("l_extendedprice").cast("long").cast("string")
    return lineitem.select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("file_name"), F.col("l_linenumber").alias("page_no"),
        F.format_string("%03d-%09d-%09d-%012d-%s", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long"), F.concat("l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").cast("string"))).alias("pos"),
        F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string"), F.when(F.col("l_partkey") % 97 == 0, "-X1-2-3").otherwise("")).alias("sub_project_id"),
        F.when(F.col("l_returnflag") == "R", "").otherwise(F.col("l_linenumber").cast("string")).alias("seq"),
        F.when(F.col("l_partkey") % 13 == 0, "").otherwise(code).alias("project_code"),
        F.when(F.col("l_partkey") % 17 == 0, "").when(F.col("l_partkey") % 19 == 0, "小计").otherwise(F.concat(F.lit("item "), F.col("l_partkey").cast("string"))).alias("project_name"),
        F.when(F.col("l_linestatus") == "O", "$ m^{2} $").otherwise(" k g ").alias("unit"), F.lit("").alias("project_description"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.when(F.col("l_suppkey") % 7 == 0, code).otherwise(price).alias("unit_price"),
        F.when(F.col("l_linenumber") == 7, code).otherwise(price).alias("total_price"),
        F.when(F.col("l_returnflag") == "N", "n/a").otherwise("12.5").alias("labor_cost"), F.lit("3").alias("machinery_cost"),
    )


SUB_ITEMS = """
items AS (SELECT 'o' || l_orderkey AS file_name, l_linenumber AS page_no,
  printf('%03d-%09d-%09d-%012d-%s', l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * 100)::BIGINT, l_returnflag || l_linestatus || l_quantity::INT) AS pos,
  's' || (l_suppkey % 5) || CASE WHEN l_partkey % 97 = 0 THEN '-X1-2-3' ELSE '' END AS sub_project_id,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE l_linenumber::VARCHAR END AS seq,
  CASE WHEN l_partkey % 13 = 0 THEN '' ELSE printf('%09d', l_partkey) END AS project_code,
  CASE WHEN l_partkey % 17 = 0 THEN '' WHEN l_partkey % 19 = 0 THEN '小计' ELSE 'item ' || l_partkey END AS project_name,
  CASE WHEN l_linestatus = 'O' THEN 'm2' ELSE 'kg' END AS unit_clean, CASE WHEN l_linestatus = 'O' THEN '$ m^{2} $' ELSE 'k g' END AS unit_shown,
  l_quantity::INT::VARCHAR AS quantity,
  CASE WHEN l_suppkey % 7 = 0 THEN printf('%09d', l_partkey) ELSE trunc(l_extendedprice)::BIGINT::VARCHAR END AS unit_price,
  CASE WHEN l_linenumber = 7 THEN printf('%09d', l_partkey) ELSE trunc(l_extendedprice)::BIGINT::VARCHAR END AS total_price,
  CASE WHEN l_returnflag = 'N' THEN 'n/a' ELSE '12.5' END AS labor_cost, '3' AS machinery_cost FROM lineitem)
"""


@query("page_select", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_linenumber IN (2, 3, 4, 6) AND l_linenumber >= 3 AND l_linenumber <= 6
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) <= 2""")
def page_select(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return pages.page_select(rows, "l_orderkey", "l_linenumber", [2, 3, 4, 6], 3, 6, 2, ("l_partkey", "l_suppkey", "l_extendedprice"))


@query("page_name_parse", """
SELECT printf('page_%03d', l_linenumber * 300) AS page_name, (l_linenumber * 300)::INT AS page_no, count(*) AS n FROM lineitem GROUP BY ALL""")
def page_name_parse(spark, sf_dir):
    named = _t(spark, sf_dir, "lineitem").select(T.page_name(F.col("l_linenumber") * 300).alias("page_name"))
    return named.withColumn("page_no", T.page_number(F.col("page_name"))).groupBy("page_name", "page_no").agg(F.count("*").alias("n"))


@query("outer_pages", """
SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS has_left, b.k IS NOT NULL AS has_right
FROM (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P') a FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linenumber > 2) b ON a.k = b.k""")
def outer_pages(spark, sf_dir):
    left = _t(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"))
    return pages.outer_pages(left, _t(spark, sf_dir, "lineitem").where("l_linenumber > 2").select(F.col("l_orderkey").alias("k")), ["k"])


@query("skip_existing", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 3)")
def skip_existing(spark, sf_dir):
    done = _t(spark, sf_dir, "lineitem").where("l_linenumber <= 3").select(F.col("l_orderkey").alias("o_orderkey"))
    return pages.skip_existing(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, ["o_orderkey"])


@query("reading_order", """
SELECT l_orderkey, string_agg(l_partkey::VARCHAR, chr(10) ORDER BY l_quantity + 1, l_extendedprice, l_partkey::VARCHAR) AS text FROM lineitem GROUP BY l_orderkey""")
def reading_order(spark, sf_dir):
    corner = lambda dy: F.array(F.col("l_extendedprice"), F.col("l_quantity") + dy)
    item = F.struct(F.col("l_partkey").cast("string").alias("text"), F.array(corner(0), corner(2)).alias("bbox"))
    grouped = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("items"))
    return grouped.select("l_orderkey", F.array_join(pages.reading_order(F.col("items")), "\n").alias("text"))


GATE_LISTS = ([("skip", ("License",)), ("skip", ("token", "="))], [("target", ("version",)), ("target", ("Public", "License"))], [("shape", ("of", "the", "and"))])


@query("gate_decision", r"""
WITH c AS (SELECT doc_id, regexp_replace(replace(replace(text, '（', '('), '）', ')'), '[\s\x{3000}\x{00A0}:：,，、.。;；\-—_/\\|()\[\]【】]+', '', 'g') AS t FROM documents),
h AS (SELECT doc_id, contains(t, 'License') OR (contains(t, 'token') AND contains(t, '=')) AS b, contains(t, 'version') OR (contains(t, 'Public') AND contains(t, 'License')) AS w,
  contains(t, 'of') AND contains(t, 'the') AND contains(t, 'and') AS s FROM c)
SELECT doc_id, NOT b AND (w OR s) AS should_run,
  CASE WHEN b THEN 'skip_blacklist_priority' WHEN w THEN 'whitelist_priority' WHEN s THEN 'target_structure_priority' ELSE 'skip_non_target_table' END AS policy,
  CASE WHEN b THEN 'blacklist_hits=skip' WHEN w THEN 'whitelist_hits=target' WHEN s THEN 'structure_hits=shape' ELSE 'no_target_table_header' END AS reason FROM h""")
def gate_decision(spark, sf_dir):
    decided = _t(spark, sf_dir, "documents").select("doc_id", gates.target_decision(F.col("text"), *GATE_LISTS).alias("d"))
    return decided.select("doc_id", "d.should_run", "d.policy", "d.reason")


@query("gate_score", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, text FROM documents),
f AS (SELECT doc_id, contains(ws_text, 'the')::INT + contains(ws_text, 'License')::INT + contains(ws_text, '@')::INT AS n_key, contains(ws_text, 'Version')::INT AS n_strong, contains(ws_text, 'token') AS col, len(ws) AS n,
  len(list_filter(ws, lambda x: regexp_full_match(x, '[￥¥]?[-+]?[0-9][0-9,]*(\.[0-9]+)?%?'))) AS numeric, len(list_filter(ws, lambda x: length(x) <= 8)) AS short FROM (SELECT *, array_to_string(ws, chr(10)) AS ws_text FROM w)),
r AS (SELECT *, CASE WHEN n > 0 THEN short / n ELSE 0 END AS ratio, CASE WHEN n_key >= 2 THEN 3 WHEN n_key = 1 THEN 1 ELSE 0 END + CASE WHEN numeric >= 8 THEN 2 WHEN numeric >= 4 THEN 1 ELSE 0 END + CASE WHEN n >= 25 THEN 2 WHEN n >= 15 THEN 1 ELSE 0 END + CASE WHEN col THEN 2 ELSE 0 END AS score FROM f)
SELECT doc_id, score::INT AS score, numeric::INT AS numeric_count, short::INT AS short_text_count,
  (n_strong > 0 AND short >= 12 AND ratio >= 0.5) OR (numeric >= 6 AND short >= 12 AND ratio >= 0.5) OR (score >= 7 AND ratio >= 0.45) AS is_table_like FROM r""")
def gate_score(spark, sf_dir):
    texts = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    docs = _t(spark, sf_dir, "documents").select("doc_id", texts.alias("ws"))
    scored = docs.select("doc_id", gates.table_score(F.col("ws"), F.size("ws"), F.lit(4), F.lit(6), ("the", "License", "@"), ("Version",), ("token",), (("none", ("\x00",)),)).alias("s"))
    return scored.select("doc_id", "s.score", "s.numeric_count", "s.short_text_count", "s.is_table_like")


@query("layout_buckets", """
SELECT l_orderkey, count(DISTINCT floor(l_extendedprice / 90)) AS x_buckets, count(DISTINCT floor(l_quantity / 32)) AS y_buckets FROM lineitem GROUP BY l_orderkey""")
def layout_buckets(spark, sf_dir):
    grouped = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_extendedprice").alias("x"), F.collect_list("l_quantity").alias("y"))
    return grouped.select("l_orderkey", gates.buckets(F.col("x"), gates.BUCKET_X).cast("long").alias("x_buckets"), gates.buckets(F.col("y"), gates.BUCKET_Y).cast("long").alias("y_buckets"))


@query("carry_forward", """
SELECT conv_id, turn, coalesce(last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '(root)') AS carried FROM conversations""")
def carry_forward(spark, sf_dir):
    turns = _t(spark, sf_dir, "conversations")
    return pages.carry_forward(turns, "conv_id", ["turn"], F.when(F.col("role") == "user", F.md5("text"))).select("conv_id", "turn", "carried")


@query("prefix_first", """
WITH n AS (SELECT *, sum((event_type = 'click')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM events)
SELECT event_id, user_id, first_value(CASE WHEN event_type = 'click' AND k <= 3 AND value > 50 THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_seen FROM n""")
def prefix_first(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    return pages.prefix_first(events, "user_id", ["ts", "event_id"], F.col("event_type") == "click", F.when(F.col("value") > 50, F.col("event_id")), 3).select("event_id", "user_id", "first_seen")


@query("keep_first_dedupe", """
SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""")
def keep_first_dedupe(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return pages.keep_first(rows, ["l_orderkey", "l_returnflag"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).drop("l_suppkey")


def _foremost(suppliers: DataFrame) -> DataFrame:
    """The suppliers that can be some customer's first of the best: of one nation and remainder, customers tell apart only balances below
    their own from the others, so a supplier with a smaller key at no larger and at no smaller balance is never the first."""
    group = Window.partitionBy("s_nationkey", F.col("s_suppkey") % 5, F.isnull("s_acctbal"))
    first = [F.min("s_suppkey").over(group.orderBy(way)) for way in (F.asc("s_acctbal"), F.desc("s_acctbal"))]
    return suppliers.select("*", F.greatest(*first).alias("_first")).where("s_suppkey <= _first").drop("_first")


@query("argmax_row", """
WITH p AS (SELECT c_custkey, s_suppkey, (c_nationkey = s_nationkey)::INT * 3 + (c_custkey % 5 = s_suppkey % 5)::INT * 5 + (c_acctbal > s_acctbal)::INT * 2 AS score FROM customer JOIN supplier ON c_nationkey = s_nationkey)
SELECT c_custkey, s_suppkey, score FROM p WHERE score >= 5 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, s_suppkey) = 1""")
def argmax_row(spark, sf_dir):
    pairs = _t(spark, sf_dir, "customer").join(_foremost(_t(spark, sf_dir, "supplier")), F.col("c_nationkey") == F.col("s_nationkey"))
    point = lambda c, n: F.when(c, n).otherwise(0)
    score = point(F.col("c_nationkey") == F.col("s_nationkey"), 3) + point(F.col("c_custkey") % 5 == F.col("s_suppkey") % 5, 5) + point(F.col("c_acctbal") > F.col("s_acctbal"), 2)
    return upsert.argmax_row(pairs, ["c_custkey"], score, F.col("s_suppkey"), 5).select("c_custkey", "s_suppkey", "score")


@query("code_lookup_join", """
WITH a AS (SELECT l_orderkey, l_linenumber, arg_max(l_partkey, row(l_extendedprice, l_partkey, l_suppkey)) AS v FROM lineitem WHERE l_quantity > 40 GROUP BY ALL),
b AS (SELECT l_orderkey, arg_max(l_partkey, row(l_extendedprice, l_partkey, l_suppkey)) AS v FROM lineitem WHERE l_quantity > 10 GROUP BY ALL),
k AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT k.l_orderkey, k.l_linenumber, coalesce(a.v, b.v) AS found FROM k LEFT JOIN a USING (l_orderkey, l_linenumber) LEFT JOIN b USING (l_orderkey)""")
def code_lookup_join(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    order = ["l_extendedprice", "l_partkey", "l_suppkey"]
    steps = [(rows.where("l_quantity > 40"), ["l_orderkey", "l_linenumber"], "l_partkey", order), (rows.where("l_quantity > 10"), ["l_orderkey"], "l_partkey", order)]
    return upsert.code_lookup(rows.select("l_orderkey", "l_linenumber").distinct(), *steps)


@query("page_upsert", """
WITH cur AS (SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT' UNION ALL SELECT * FROM cur""")
def page_upsert(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    current = orders.where("o_orderstatus = 'F'").select(*cols).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return upsert.page_upsert(orders.select(*cols), current, orders.where("o_orderpriority = '1-URGENT'"), ["o_orderkey"])


REPAIR = """
original AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag <> 'R'), repair AS (SELECT l_orderkey, l_linenumber, l_partkey + 1 AS l_partkey FROM lineitem WHERE l_linestatus = 'O'),
targets AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45),
st AS (SELECT l_orderkey, count(*) AS pages, CASE WHEN l_orderkey NOT IN (SELECT l_orderkey FROM original) THEN 'missing_original' WHEN l_orderkey NOT IN (SELECT l_orderkey FROM repair) THEN 'missing_repair' ELSE 'ok' END AS status FROM targets GROUP BY l_orderkey)
"""


def _repair(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_partkey"]
    original, repair = rows.where("l_returnflag <> 'R'").select(*cols), rows.where("l_linestatus = 'O'").select(*cols).withColumn("l_partkey", F.col("l_partkey") + 1)
    return upsert.repair_merge(original, repair, rows.where("l_quantity > 45"), "l_orderkey", "l_linenumber")


@query("repair_merge", "WITH" + REPAIR + """
SELECT st.l_orderkey, pages, status, CASE WHEN status = 'ok' THEN (SELECT count(*) FROM original o JOIN targets t USING (l_orderkey, l_linenumber) WHERE o.l_orderkey = st.l_orderkey) ELSE 0 END AS removed_rows,
  CASE WHEN status = 'ok' THEN (SELECT count(*) FROM repair r JOIN targets t USING (l_orderkey, l_linenumber) WHERE r.l_orderkey = st.l_orderkey) ELSE 0 END AS inserted_rows FROM st""")
def repair_merge(spark, sf_dir):
    return _repair(spark, sf_dir)[1]


@query("repair_rows", "WITH" + REPAIR + """, ok AS (SELECT t.* FROM targets t JOIN st USING (l_orderkey) WHERE status = 'ok')
SELECT o.* FROM original o ANTI JOIN ok USING (l_orderkey, l_linenumber) UNION ALL SELECT r.* FROM repair r SEMI JOIN ok USING (l_orderkey, l_linenumber)""")
def repair_rows(spark, sf_dir):
    return _repair(spark, sf_dir)[0]


@query("bag_difference", """
WITH k AS (SELECT l_partkey, l_returnflag, count(*) AS c FROM lineitem WHERE l_linenumber > 3 GROUP BY ALL),
r AS (SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_suppkey) AS n FROM lineitem)
SELECT r.l_partkey, r.l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM r LEFT JOIN k USING (l_partkey, l_returnflag) WHERE n > coalesce(c, 0)""")
def bag_difference(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey")
    return upsert.bag_difference(rows, rows.where("l_linenumber > 3"), ["l_partkey", "l_returnflag"], ["l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey"]).drop("l_suppkey")


@query("rekey_merge", r"""
SELECT regexp_replace(c_name, '[0-9]$', '') AS c_name, count(*) AS n, min(c_custkey) AS first_key, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY 1""")
def rekey_merge(spark, sf_dir):
    return upsert.rekey_merge(_t(spark, sf_dir, "customer"), "c_name", F.regexp_replace("c_name", r"[0-9]\z", ""), {
        "n": F.count("*"), "first_key": F.min("c_custkey"), "segments": F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",")})


@query("misaligned_pages", "WITH" + SUB_ITEMS + r"""
, f AS (SELECT *, unit_price <> '' AND (unit_price = project_code OR regexp_full_match(unit_price, '\d{9,15}')) AS shifted,
  list_filter([CASE WHEN NOT regexp_full_match(quantity, '\d+(\.\d+)?') THEN 'quantity' END, CASE WHEN NOT regexp_full_match(unit_price, '\d+(\.\d+)?') THEN 'unit_price' END, CASE WHEN NOT regexp_full_match(total_price, '\d+(\.\d+)?') THEN 'total_price' END,
    CASE WHEN NOT regexp_full_match(labor_cost, '\d+(\.\d+)?') THEN 'labor_cost' END, CASE WHEN NOT regexp_full_match(machinery_cost, '\d+(\.\d+)?') THEN 'machinery_cost' END], lambda x: x IS NOT NULL) AS bad FROM items),
r AS (SELECT *, list_filter([CASE WHEN shifted THEN 'unit_price像项目编码' END, CASE WHEN shifted AND regexp_full_match(total_price, '\d+(\.\d+)?') AND regexp_full_match(labor_cost, '\d+(\.\d+)?') THEN '疑似金额列整体右移' END,
  CASE WHEN regexp_full_match(total_price, '\d{9,15}') OR regexp_full_match(labor_cost, '\d{9,15}') THEN '金额列出现项目编码' END,
  CASE WHEN seq <> '' AND project_name <> '' AND project_code <> '' AND len(bad) > 0 THEN '数值列非金额:' || array_to_string(bad, ',') END], lambda x: x IS NOT NULL) AS reasons,
  trim(array_to_string([seq, project_code, project_name, unit_shown, quantity, unit_price, total_price, labor_cost, machinery_cost], ' | '), ' |') AS p FROM f)
SELECT file_name, page_no, count(*) AS hit_rows, array_to_string(list_sort(list_distinct(flatten(list(reasons)))), '、') AS reasons, arg_min(p, pos) AS sample FROM r WHERE len(reasons) > 0 GROUP BY file_name, page_no""")
def misaligned_pages(spark, sf_dir):
    return audit.misaligned_pages(sub_items(_t(spark, sf_dir, "lineitem")))


@query("empty_after_filter", "WITH" + SUB_ITEMS + r"""
, r AS (SELECT *, seq <> '' AND project_name <> '' AS kept, CASE WHEN seq = '' AND project_name = '' THEN '缺少seq、缺少name' WHEN seq = '' THEN '缺少seq' WHEN project_name = '' THEN '缺少name' ELSE '其他' END AS reason,
  trim(array_to_string([seq, project_code, project_name, '', unit_shown, quantity, unit_price, total_price], ' | '), ' |') AS p FROM items),
g AS (SELECT file_name, page_no, reason, count(*) AS n, count(*) FILTER (kept) AS k, min((pos, p)) AS f FROM r GROUP BY ALL)
SELECT file_name, page_no, sum(n)::BIGINT AS raw_rows, sum(k)::BIGINT AS kept_rows, string_agg(reason || ':' || n, '、' ORDER BY reason || ':' || n) AS reasons, min(f)[2] AS sample FROM g GROUP BY file_name, page_no HAVING sum(k) = 0""")
def empty_after_filter(spark, sf_dir):
    return audit.empty_after_filter(sub_items(_t(spark, sf_dir, "lineitem")))


@query("result_check", "WITH" + SUB_ITEMS + r"""
, c AS (SELECT file_name, count(*) AS total_rows, count(*) FILTER (seq <> '' AND project_name <> '') AS effective_rows, 0::BIGINT AS empty_rows, count(*) FILTER (seq = '') AS rows_without_seq FROM items GROUP BY ALL),
rep AS (SELECT 'o' || o_orderkey AS file_name, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS model_pages, CASE WHEN o_orderstatus = 'F' THEN o_custkey % 3 ELSE 0 END AS model_rows FROM orders WHERE o_orderpriority <> '5-LOW'),
j AS (SELECT f.file_name, coalesce(total_rows, 0) AS total_rows, coalesce(effective_rows, 0) AS effective_rows, coalesce(empty_rows, 0) AS empty_rows, coalesce(rows_without_seq, 0) AS rows_without_seq,
  coalesce(model_pages, 0)::BIGINT AS model_pages, coalesce(model_rows, 0)::BIGINT AS model_rows, rep.file_name IS NOT NULL AS ok FROM (SELECT 'o' || o_orderkey AS file_name FROM orders) f LEFT JOIN c USING (file_name) LEFT JOIN rep ON rep.file_name = f.file_name),
i AS (SELECT *, array_to_string(list_filter([CASE WHEN total_rows = 0 THEN '没有分部分项清单行' END, CASE WHEN effective_rows = 0 THEN '没有有效明细行' END, CASE WHEN rows_without_seq > 0 THEN '存在缺少序号的行' END,
  CASE WHEN NOT ok THEN '缺少提取报告' WHEN model_pages = 0 THEN '报告中没有Qwen提取页' WHEN model_rows = 0 THEN '报告中Qwen提取行数为0' END], lambda x: x IS NOT NULL), '，') AS issues FROM j)
SELECT file_name, issues, total_rows, effective_rows, empty_rows, rows_without_seq, model_pages, model_rows, CASE WHEN ok THEN '正常' ELSE '缺少提取报告' END AS report_status FROM i WHERE issues <> ''""")
def result_check(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").withColumn("file_name", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")))
    tag = F.when(F.col("o_orderstatus") == "F", F.lit(audit.rules.MODEL_ROWS)).otherwise("rules_pipeline_no_table")
    report = orders.where("o_orderpriority <> '5-LOW'").select("file_name", F.lit(1).alias("page_no"), tag.alias("extractor"), (F.col("o_custkey") % 3).alias("rows"))
    return audit.result_check(orders, sub_items(_t(spark, sf_dir, "lineitem")), report)


@query("export_rows", "WITH" + SUB_ITEMS + r"""
, k AS (SELECT * FROM items WHERE seq <> '' AND project_name <> ''),
d AS (SELECT DISTINCT file_name, sub_project_id FROM items)
SELECT d.file_name, d.sub_project_id, count(k.pos) AS n_rows,
  count(*) FILTER (k.project_code = '' OR k.unit_price = k.project_code OR regexp_full_match(k.unit_price, '\d{9,15}') OR contains(k.project_name, '小计') OR regexp_matches(k.project_code || ' ' || k.project_name || ' ' || k.sub_project_id, '-X\d+(-\d+){2,}')) AS n_warned,
  coalesce(string_agg(k.seq || '/' || k.unit_clean, ',' ORDER BY k.pos), '') AS units FROM d LEFT JOIN k ON d.file_name = k.file_name AND d.sub_project_id = k.sub_project_id GROUP BY ALL""")
def export_rows(spark, sf_dir):
    rows = sub_items(_t(spark, sf_dir, "lineitem"))
    out = audit.export_rows(rows.select("file_name", "sub_project_id").distinct(), rows)
    cells = F.from_json("sub_item_project_rows", "array<struct<seq:string,unit:string>>")
    warned = F.from_json("sub_item_project_warnings", "array<struct<row_index:int>>")
    none = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    return out.select("file_name", "sub_project_id", none(cells).alias("n_rows"), none(warned).alias("n_warned"), F.coalesce(F.array_join(F.transform(cells, lambda r: F.concat_ws("/", r["seq"], r["unit"])), ","), F.lit("")).alias("units"))


@query("cleaning_summary", "WITH" + SUB_ITEMS + r"""
, w AS (SELECT *, project_code = '' OR unit_price = project_code OR regexp_full_match(unit_price, '\d{9,15}') OR contains(project_name, '小计') OR regexp_matches(project_code || ' ' || project_name || ' ' || sub_project_id, '-X\d+(-\d+){2,}') AS warned, NOT (seq <> '' AND project_name <> '') AS gone FROM items)
SELECT file_name, count(*) AS raw_rows, count(*) FILTER (warned) AS warned_rows, count(*) FILTER (gone) AS removed_rows, count(*) FILTER (gone AND seq = '') AS removed_no_seq, count(*) FILTER (gone AND project_name = '') AS removed_no_name, count(*) FILTER (NOT gone) AS kept_rows FROM w GROUP BY file_name""")
def cleaning_summary(spark, sf_dir):
    rows = sub_items(_t(spark, sf_dir, "lineitem"))
    return audit.cleaning_summary(rows, rows.where(~audit.is_exported()))


@query("rerun_list", "SELECT 'o' || l_orderkey AS file_name, string_agg(DISTINCT l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) AS pages FROM lineitem WHERE l_quantity > 30 GROUP BY ALL")
def rerun_list(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").where("l_quantity > 30")
    return audit.rerun_list(rows.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("file_name"), F.col("l_linenumber").cast("string").alias("page_no")))


@query("label_histogram", "SELECT user_id, event_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY user_id)::BIGINT AS total FROM events GROUP BY user_id, event_type")
def label_histogram(spark, sf_dir):
    return sequences.label_histogram(_t(spark, sf_dir, "events"), "user_id", "event_type").select("user_id", F.explode("histogram").alias("event_type", "n"), "total")


@query("date_norm", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def date_norm(spark, sf_dir):
    day = F.col("o_orderdate")
    chinese = F.translate(F.date_format(day, "yyyy"), "0123456789", "〇一二三四五六七八九")
    spelt = lambda n: F.element_at(F.array(*[F.lit(("" if k < 10 else "十" if k < 20 else "一二三"[k // 10 - 1] + "十") + " 一二三四五六七八九"[k % 10].strip()) for k in range(1, 32)]), n)
    shown = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("签于 "), chinese, F.lit("年"), spelt(F.month(day)), F.lit("月"), spelt(F.dayofmonth(day)), F.lit("日"))).otherwise(F.concat_ws(".", F.year(day), F.month(day), F.dayofmonth(day)))
    return _t(spark, sf_dir, "orders").select("o_orderkey", T.date_iso(shown).alias("iso"))


@query("amount_clean", r"""
SELECT c_custkey, regexp_replace('¥' || printf('%.2f', c_acctbal) || '元', '[^0-9.]', '', 'g') AS amount, regexp_full_match(printf('%.2f', c_acctbal), '\d+(\.\d+)?') AS is_amount FROM customer""")
def amount_clean(spark, sf_dir):
    shown = F.format_string("%.2f", "c_acctbal")
    return _t(spark, sf_dir, "customer").select("c_custkey", T.clean_amount(F.concat(F.lit("¥"), shown, F.lit("元"))).alias("amount"), T.is_amount(shown).alias("is_amount"))


@query("unit_norm", "SELECT DISTINCT regexp_replace(p_type, '\\s', '', 'g') || 'm2' AS unit FROM part")
def unit_norm(spark, sf_dir):
    return _t(spark, sf_dir, "part").select(T.normalize_unit(F.concat(F.lit(" "), F.col("p_type"), F.lit(" $ m^{2} $"))).alias("unit")).distinct()


@query("phrase_collapse", """
WITH t AS (SELECT p_partkey, repeat(p_type, 1 + p_size % 3) AS s FROM part)
SELECT p_partkey, coalesce(left(s, list_filter(range(1, length(s)::INT // 2 + 1), lambda n: length(s) % n = 0 AND repeat(left(s, n::INT), (length(s) // n)::INT) = s)[1]::INT), s) AS phrase FROM t""")
def phrase_collapse(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", T.collapse_phrase(F.expr("repeat(p_type, 1 + p_size % 3)")).alias("phrase"))


@query("alias_normalise", """
SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN event_type END, CASE WHEN event_id % 3 = 1 THEN user_id::VARCHAR END, '') AS quantity FROM events""")
def alias_normalise(spark, sf_dir):
    row = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("quantity"), F.col("event_type"))).when(F.col("event_id") % 3 == 1, F.create_map(F.lit("其中工程量(m2)"), F.col("user_id").cast("string"))).otherwise(F.create_map(F.lit("备注"), F.lit("x")))
    return _t(spark, sf_dir, "events").select("event_id", sequences.aliased(row, "quantity").alias("quantity"))


@query("bundle", """
SELECT r_name, count(n_nationkey) AS file_count, coalesce(string_agg(n_name, '|' ORDER BY n_name), '') AS files FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name""")
def bundle(spark, sf_dir):
    joined = _t(spark, sf_dir, "region").join(_t(spark, sf_dir, "nation"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return sequences.bundle(joined, ["r_name"], "n_name", ["n_nationkey"]).select("r_name", "file_count", F.array_join(F.transform("files", lambda f: f["n_name"]), "|").alias("files"))


@query("page_summaries", """
WITH p AS (SELECT conv_id, turn, text FROM conversations), t AS (SELECT conv_id, turn, role, length(text) AS rows FROM conversations WHERE role <> 'user')
SELECT 'c' || p.conv_id AS file_name, p.turn::INT AS page_no, CASE WHEN t.turn IS NULL THEN NULL ELSE 0 END AS table_index, t.role AS table_type, CASE WHEN t.turn IS NOT NULL AND t.rows > 80 THEN t.rows ELSE 0 END::BIGINT AS rows,
  CASE WHEN t.turn IS NULL THEN CASE WHEN trim(p.text) = '' THEN 'empty' ELSE 'rules_pipeline_no_table' END WHEN t.rows > 80 THEN 'rules_pipeline_qwen_fields' ELSE 'disabled_by_config' END AS extractor
FROM p LEFT JOIN t USING (conv_id, turn)""")
def page_summaries(spark, sf_dir):
    turns = _t(spark, sf_dir, "conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("file_name"), F.col("turn").cast("int").alias("page_no"), "text", "role")
    size = F.length("text").cast("long")
    tables = turns.where("role <> 'user'").select("file_name", "page_no", F.lit(0).alias("table_index"), F.col("role").alias("table_type"), (size > 80).alias("enabled"), F.lit(True).alias("matched"), size.alias("rows"))
    return audit.page_summaries(turns, tables)
