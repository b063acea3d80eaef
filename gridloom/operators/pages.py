"""Selecting, aligning and ordering pages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import let, strip


def parse_page_list(text: str) -> list[int]:
    """Comma lists, full-width commas too, to sorted distinct positive page numbers."""
    numbers = [x.strip() for x in text.replace("，", ",").split(",") if x.strip()]
    if any(not x.isdigit() or int(x) <= 0 for x in numbers):
        raise ValueError(f"page numbers are positive integers: {text!r}")
    return sorted({int(x) for x in numbers})


def page_list(text: Column) -> Column:
    """The same of a column, as an array; null for what is no list of positive numbers, empty for a blank one."""
    parts = F.filter(F.transform(F.split(F.translate(F.coalesce(text, F.lit("")), "，", ","), ","), lambda x: strip(x)), lambda x: x != "")
    good = lambda xs: F.forall(xs, lambda x: x.rlike(r"\A0*[1-9][0-9]*\z"))
    return let(parts, lambda xs: F.when(good(xs), F.array_sort(F.array_distinct(F.transform(xs, lambda x: x.cast("int"))))))


def page_select(df: DataFrame, doc: str, page: str, selected: Iterable[int] | None = None, start: int | None = None, end: int | None = None, max_pages: int | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Selected pages, from start to end, then the first ``max_pages`` of each document."""
    if selected is not None:
        df = df.where(F.col(page).isin([int(x) for x in selected]))
    if start is not None:
        df = df.where(F.col(page) >= start)
    if end is not None:
        df = df.where(F.col(page) <= end)
    if max_pages is None:
        return df
    by = Window.partitionBy(doc).orderBy(page, *ties)
    return df.withColumn("_rank", F.row_number().over(by)).where(F.col("_rank") <= max_pages).drop("_rank")


def outer_pages(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of either side with has_left and has_right."""
    a = left.select(*keys).distinct().withColumn("has_left", F.lit(True))
    b = right.select(*keys).distinct().withColumn("has_right", F.lit(True))
    return a.join(b, list(keys), "full_outer").fillna(False, ["has_left", "has_right"])


def skip_existing(df: DataFrame, done: DataFrame, keys: Sequence[str], overwrite: bool = False) -> DataFrame:
    """Rows whose key is not done yet."""
    return df if overwrite else df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def carry_forward(df: DataFrame, doc: str, order: Sequence[str], value: Column, default: str | None = "(root)", name: str = "carried") -> DataFrame:
    """The last non-null value so far in the document."""
    upto = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last_value(value, ignoreNulls=True).over(upto)
    return df.withColumn(name, last if default is None else F.coalesce(last, F.lit(default)))


def prefix_first(df: DataFrame, doc: str, order: Sequence[str], eligible: Column, value: Column, limit: int, name: str = "first_seen") -> DataFrame:
    """Per row, the first non-null value among the document's first ``limit`` eligible rows up to it."""
    upto = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = df.withColumn("_n", F.sum(F.when(eligible, 1).otherwise(0)).over(upto))
    kept = F.when(eligible & (F.col("_n") <= limit), value)
    return counted.withColumn(name, F.first_value(kept, ignoreNulls=True).over(upto)).drop("_n")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key by ``order``."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by)).where("_rank = 1").drop("_rank")


def reading_order(items: Column) -> Column:
    """Texts of (text, bbox) items by vertical centre, then horizontal, then text; no box counts as (0, 0)."""
    mean = lambda box, k: F.when(F.size(box) > 0, F.aggregate(box, F.lit(0.0), lambda a, p: a + p[k]) / F.size(box)).otherwise(0.0)
    placed = F.transform(items, lambda i: F.struct(F.coalesce(mean(i["bbox"], 1), F.lit(0.0)).alias("y"), F.coalesce(mean(i["bbox"], 0), F.lit(0.0)).alias("x"), i["text"].alias("text")))
    return F.transform(F.array_sort(placed), lambda p: p["text"])


def prefer_text(markdown: Column, html: Column, json: Column, order: str = "auto") -> Column:
    """Page text from the preferred artifact that has any; ``all`` labels and joins them."""
    from ..functions.text import first_text, is_blank

    if order == "all":
        part = lambda name, c: F.when(~is_blank(c), F.concat(F.lit(f"[{name}]\n"), c))
        return F.concat_ws("\n\n", part("markdown", markdown), part("html", html), part("json", json))
    orders = {"auto": (markdown, json, html), "md": (markdown, json, html), "html": (html, markdown, json), "json": (json, markdown, html)}
    return first_text(*orders[order])


def prefer_tables(html: Column, markdown: Column, order: str = "auto") -> Column:
    """Grids from the preferred artifact; ``all`` takes both."""
    if order == "all":
        return F.concat(html, markdown)
    first, second = (html, markdown) if order in ("auto", "html") else (markdown, html)
    return F.when(F.size(first) > 0, first).otherwise(second)


def rule_text(screen: Column, page: Column) -> Column:
    """The text that rules see: the screen text and the page's own, one below the other where both exist and differ."""
    a, b = F.coalesce(screen, F.lit("")), F.coalesce(page, F.lit(""))
    return F.when((a != "") & (a != b), F.concat(a, F.lit("\n"), b)).otherwise(b)
