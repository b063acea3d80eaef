"""Quality queries over sub-item rows: shifted columns, lost pages, result checks, exports.

``rows`` has file_name, page_no, pos (orders the rows of a file), sub_project_id and the
string fields of a sub-item row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import is_amount, is_blank, is_project_code, is_valid_seq, let, normalize_unit, preview, strip

NUMERIC = ("quantity", "unit_price", "total_price", "labor_cost", "machinery_cost")
SHORT = ("seq", "project_code", "project_name", "unit", *NUMERIC)
LONG = ("seq", "project_code", "project_name", "project_description", "unit", "quantity", "unit_price", "total_price")


def _present(*items: Column) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def misaligned_reasons() -> Column:
    """Why a row looks as if its columns had shifted; empty if it does not."""
    price, code = strip(F.col("unit_price")), strip(F.col("project_code"))
    shifted = (price != "") & ((price == code) | is_project_code(F.col("unit_price")))
    named = ~is_blank(F.col("seq")) & ~is_blank(F.col("project_name")) & (code != "")
    bad = _present(*[F.when((F.coalesce(F.col(k), F.lit("")) != "") & ~is_amount(F.col(k)), F.lit(k)) for k in NUMERIC])

    def told(x: Column) -> Column:
        return _present(
            F.when(x["shifted"], "unit_price像项目编码"),
            F.when(x["shifted"] & is_amount(F.col("total_price")) & is_amount(F.col("labor_cost")), "疑似金额列整体右移"),
            F.when(is_project_code(F.col("total_price")) | is_project_code(F.col("labor_cost")) | is_project_code(F.col("machinery_cost")), "金额列出现项目编码"),
            F.when(F.size(x["bad"]) > 0, F.concat(F.lit("数值列非金额:"), F.array_join(x["bad"], ","))),
        )

    return let(F.struct(shifted.alias("shifted"), F.when(named, bad).otherwise(F.slice(bad, 1, 0)).alias("bad")), told)


def misaligned_pages(rows: DataFrame) -> DataFrame:
    """(file_name, page_no, hit_rows, reasons, sample) of pages with such rows."""
    hits = rows.select("file_name", "page_no", "pos", *SHORT, F.posexplode(misaligned_reasons()).alias("_k", "_r"))  # a row without reasons goes
    return hits.groupBy("file_name", "page_no").agg(
        F.count_if(F.col("_k") == 0).alias("hit_rows"),
        F.array_join(F.array_sort(F.collect_set("_r")), "、").alias("reasons"),
        F.min_by(F.struct(*SHORT), "pos").alias("_first"),
    ).select("file_name", "page_no", "hit_rows", "reasons", preview(*[F.col(f"_first.{c}") for c in SHORT]).alias("sample"))


def is_exported() -> Column:
    return is_valid_seq(F.col("seq")) & ~is_blank(F.col("project_name"))


def loss_reason(sep: str = "、") -> Column:
    missing = F.concat_ws(sep, F.when(~is_valid_seq(F.col("seq")), "缺少seq"), F.when(is_blank(F.col("project_name")), "缺少name"))
    return F.when(missing == "", "其他").otherwise(missing)


def empty_after_filter(rows: DataFrame) -> DataFrame:
    """Pages with rows of which the export keeps none, and a histogram of the reasons."""
    told = ["缺少seq、缺少name", "缺少seq", "缺少name", "其他"]
    lost = F.when(~is_exported(), F.struct("pos", *LONG))  # rows that are kept need not be carried: with one of them the page goes
    pages = rows.where("page_no > 0").withColumn("reason", loss_reason()).groupBy("file_name", "page_no").agg(
        F.count("*").alias("raw_rows"), F.count_if(is_exported()).alias("kept_rows"), *[F.count_if(F.col("reason") == t).alias(f"n{k}") for k, t in enumerate(told)], F.min(lost).alias("first"))
    listed = F.array_sort(_present(*[F.when(F.col(f"n{k}") > 0, F.concat(F.lit(f"{t}:"), F.col(f"n{k}").cast("string"))) for k, t in enumerate(told)]))
    return (
        pages.where("kept_rows = 0")
        .select("file_name", "page_no", "raw_rows", "kept_rows", F.array_join(listed, "、").alias("reasons"), preview(*[F.col(f"first.{c}") for c in LONG]).alias("sample"))
    )


def result_check(files: DataFrame, rows: DataFrame, report_pages: DataFrame) -> DataFrame:
    """Files with issues: row counts, what their extraction report says, and the issue labels.

    ``files`` has file_name; ``report_pages`` has file_name, page_no, extractor and rows, one
    row per entry, and a row with null page_no for a report without entries.
    """
    empty = reduce(lambda a, b: a & b, [is_blank(F.col(c)) for c in rules.SUB_ITEM_FIELDS if c in rows.columns])
    effective = is_valid_seq(F.col("seq")) & ~is_blank(F.col("project_name"))
    counts = rows.groupBy("file_name").agg(
        F.count("*").alias("total_rows"), F.count_if(effective).alias("effective_rows"), F.count_if(empty).alias("empty_rows"),
        F.count_if(~empty & ~is_valid_seq(F.col("seq"))).alias("rows_without_seq"),
    )
    model = F.col("extractor") == rules.MODEL_ROWS
    report = report_pages.groupBy("file_name").agg(
        F.count_distinct(F.when(model, F.col("page_no"))).alias("model_pages"), F.coalesce(F.sum(F.when(model, F.col("rows"))), F.lit(0)).alias("model_rows"), F.lit("ok").alias("report_status")
    )
    numbers = ["total_rows", "effective_rows", "empty_rows", "rows_without_seq", "model_pages", "model_rows"]
    joined = files.select("file_name").join(counts, "file_name", "left").join(report, "file_name", "left").fillna(0, numbers).fillna("missing_report", ["report_status"])
    label = lambda k: F.lit(rules.ISSUES[k])
    ok = F.col("report_status") == "ok"
    issues = _present(
        F.when(F.col("total_rows") == 0, label("no_sub_item_rows")), F.when(F.col("effective_rows") == 0, label("no_effective_sub_item_rows")),
        F.when(F.col("empty_rows") > 0, label("has_empty_rows")), F.when(F.col("rows_without_seq") > 0, label("has_rows_without_seq")),
        F.when(~ok, label("missing_report")).when(F.col("model_pages") == 0, label("no_qwen_pages_in_report")).when(F.col("model_rows") == 0, label("qwen_rows_0_in_report")),
    )
    return joined.withColumn("issues", F.array_join(issues, "，")).where("issues <> ''").select("file_name", "issues", *numbers, F.when(ok, "正常").otherwise(label("missing_report")).alias("report_status"))


def quality_warnings() -> Column:
    code, name, price = (strip(F.col(c)) for c in ("project_code", "project_name", "unit_price"))
    combined = F.concat_ws(" ", code, name, strip(F.col("sub_project_id")))
    return _present(
        F.when(code == "", "缺少code"),
        F.when((price != "") & ((price == code) | price.rlike(r"(?U)\A\d{9,15}\z")), "疑似金额列错位"),
        F.when(reduce(lambda a, b: a | b, [F.contains(name, F.lit(x)) for x in rules.SUBTOTALS]), "疑似小计/合计"),
        F.when(combined.rlike(r"(?U)-X\d+(?:-\d+){2,}"), "疑似坐标乱码"),
    )


def export_rows(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per (file, sub-project): document columns, exported rows as JSON, their warnings as JSON.

    ``documents`` has file_name, sub_project_id and any document columns.
    """
    kept = rows.where(is_exported()).withColumns({"unit": normalize_unit(F.col("unit")), "_w": quality_warnings()})
    fields = [c for c in rules.SUB_ITEM_FIELDS if c in rows.columns]
    listed = kept.groupBy("file_name", "sub_project_id").agg(F.array_sort(F.collect_list(F.struct("pos", *fields, "_w"))).alias("_rows"))
    row_json = F.to_json(F.transform("_rows", lambda r: F.struct(*[r[f].alias(f) for f in fields])))
    warned = F.filter(F.transform("_rows", lambda r, i: F.struct(i.alias("row_index"), r["seq"].alias("seq"), r["project_code"].alias("project_code"), r["project_name"].alias("project_name"), r["_w"].alias("warnings"))), lambda r: F.size(r["warnings"]) > 0)
    joined = documents.join(listed, ["file_name", "sub_project_id"], "left")
    return joined.withColumns({
        "sub_item_project_rows": F.when(F.size("_rows") > 0, row_json).otherwise(""), "sub_item_project_warnings": F.coalesce(let(warned, lambda w: F.when(F.size(w) > 0, F.to_json(w))), F.lit(""))
    }).drop("_rows")


def cleaning_summary(raw: DataFrame, removed: DataFrame) -> DataFrame:
    """Per file: raw, removed and kept rows, removals by reason, rows with warnings."""
    total = raw.groupBy("file_name").agg(F.count("*").alias("raw_rows"), F.count_if(F.size(quality_warnings()) > 0).alias("warned_rows"))
    gone = removed.groupBy("file_name").agg(
        F.count("*").alias("removed_rows"), F.count_if(~is_valid_seq(F.col("seq"))).alias("removed_no_seq"), F.count_if(is_blank(F.col("project_name"))).alias("removed_no_name"))
    joined = total.join(gone, "file_name", "left").fillna(0)
    return joined.withColumn("kept_rows", F.col("raw_rows") - F.col("removed_rows"))


def rerun_list(pages: DataFrame) -> DataFrame:
    """Per file its distinct positive pages, sorted and comma-joined."""
    good = pages.withColumn("page_no", F.col("page_no").try_cast("int")).where("page_no > 0")
    return good.groupBy("file_name").agg(F.array_join(F.array_sort(F.collect_set("page_no")).cast("array<string>"), ",").alias("pages"))


def page_summaries(pages: DataFrame, tables: DataFrame) -> DataFrame:
    """One line per page and table with its extractor tag.

    ``pages`` has file_name, page_no, text; ``tables`` file_name, page_no, table_index, table_type, enabled, matched, rows.
    """
    bare = pages.join(tables.select("file_name", "page_no").distinct(), ["file_name", "page_no"], "left_anti")
    none = bare.select("file_name", "page_no", F.lit(None).cast("int").alias("table_index"), F.lit(None).cast("string").alias("table_type"), F.lit(0).cast("long").alias("rows"), F.when(is_blank(F.col("text")), "empty").otherwise("rules_pipeline_no_table").alias("extractor"))
    tag = F.when(~F.col("matched"), "unmatched_table").when(~F.col("enabled"), "disabled_by_config").otherwise(rules.MODEL_ROWS)
    return none.unionByName(tables.select("file_name", "page_no", "table_index", "table_type", F.when(F.col("enabled") & F.col("matched"), F.col("rows")).otherwise(0).cast("long").alias("rows"), tag.alias("extractor")))


def removed_rows(rows: DataFrame) -> DataFrame:
    """The rows that the export drops, each with its reasons and a preview of the fields it has."""
    shown = [F.col(c) for c in LONG if c in rows.columns]
    return rows.where(~is_exported()).withColumns({"reasons": loss_reason(), "preview": preview(*shown)})
