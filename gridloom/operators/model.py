"""Extraction by a language model: prompt, call, parse, normalise.

A backend is any object with ``answered(asked)``, which adds the replies to rows with a prompt;
the operators take it as an argument. ``StoredBackend`` (in ``replies``) asks what a table of replies doesn't answer, ``CallBackend`` asks
each time. Prompts and replies are columns, so that keeping them is a projection and not a debug mode.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import rules
from ..functions.text import clean_amount, is_blank, let, strip
from ..sources import engines
from .extract import lenient_json, parse_replies
from .sequences import aliased, chunk_lines

TEXT_LIMIT, PROCESS_LIMIT = 12000, 9000
CELL, LONG_CELL = 500, 1200
SYSTEM = "Map the recognised table text to the named JSON fields. Add and correct nothing. Empty columns keep their place. Answer with JSON only; a missing field is an empty string."


class Backend(Protocol):
    def answered(self, asked: DataFrame) -> DataFrame:
        """``asked`` with the reply to each prompt."""


class CallBackend:
    """Replies of ``make(settings)(prompts)``; the model is made once a worker and settings (see ``engines``), and nothing is kept of what it says."""

    def __init__(self, make: Callable[[object], Callable[[list[str]], Iterable[str]]], settings: object | None = None):
        self.make, self.settings = make, settings or engines.ModelSettings()

    def answered(self, asked: DataFrame) -> DataFrame:
        make, settings, at = self.make, self.settings, asked.columns.index("prompt")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                replies = pa.array(list(engines.engine(make, settings)([p or "" for p in batch.column(at).to_pylist()])), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, replies], names=[*batch.schema.names, "reply"])

        return asked.mapInArrow(run, StructType([*asked.schema.fields, StructField("reply", StringType())]))


def cell_text(cell: Column, limit: int) -> Column:
    """A cell in one line with escaped quotes, cut at ``limit`` characters with a mark."""
    has = lambda t, c: F.contains(t, F.lit(c))  # noqa: E731  a search is far cheaper than a replacement that finds nothing
    one = lambda t: F.replace(F.regexp_replace(F.replace(t, F.lit("\r"), F.lit("\n")), "\n{3,}", "\n\n"), F.lit("\n"), F.lit("\\n"))
    lined = lambda t: F.when(has(t, "\n") | has(t, "\r"), one(t)).otherwise(t)
    cut = lambda t: F.when((F.octet_length(t) > limit) & (F.length(t) > limit), F.concat(F.left(t, F.lit(limit)), F.lit("...[cell_truncated]"))).otherwise(t)  # noqa: E731  no text has more characters than bytes
    return let(let(let(strip(cell), lined), cut), lambda t: F.when(has(t, '"'), F.replace(t, F.lit('"'), F.lit('\\"'))).otherwise(t))


def three_digits(n: Column) -> Column:
    """A positive number with zeros up to three digits."""
    return let(n.cast("string"), lambda t: F.when(F.length(t) < 3, F.lpad(t, 3, "0")).otherwise(t))


def rendered_rows(grid: Column, kind: str) -> Column:
    """A line per row with numbered columns; short rows are filled up to the widest."""
    limit = LONG_CELL if kind in rules.LONG_CELLS else CELL
    width = F.greatest(F.coalesce(F.array_max(F.transform(grid, F.size)), F.lit(1)), F.lit(1))
    heads = lambda w: F.transform(F.sequence(F.lit(1), w), lambda j: F.concat(F.lit("col_"), three_digits(j), F.lit('="')))
    columns = lambda row, hs: F.transform(hs, lambda h, j: F.concat(h, cell_text(F.coalesce(F.get(row, j), F.lit("")), limit), F.lit('"')))
    return let(heads(width), lambda hs: F.transform(grid, lambda row, i: F.concat(F.lit("row_"), three_digits(i + 1), F.lit(": "), F.array_join(columns(row, hs), " | "))))


def starts_top_level(cell: Column) -> Column:
    return strip(cell).rlike(r"\A[1-7](?:\z|[^0-9.])")


def table_text(grid: Column, kind: str, source: Column | None = None, limit: int = TEXT_LIMIT, rows: Column | None = None) -> Column:
    """What a model is shown of a table: its size, hints for its type and its rows (``rendered_rows``, or ``rows`` where they are known), as many as fit, with a mark before the first that doesn't."""
    rows = rendered_rows(grid, kind) if rows is None else rows
    head = [F.lit("TABLE_GRID_FOR_EXTRACTION"), F.concat(F.lit("source="), source if source is not None else F.lit("")), F.concat(F.lit("row_count="), F.size(grid).cast("string"))]
    hints = F.array(*head)
    if kind == "unit_project_fee_table":
        tops = lambda rs: F.filter(rs, lambda r, i: starts_top_level(F.get(F.get(grid, i), F.lit(0))))
        hints = F.concat(hints, let(tops(rows), lambda t: F.when(F.size(t) > 0, F.concat(F.array(F.lit("TOP_LEVEL_CANDIDATE_ROWS_FOR_UNIT_FEE")), t)).otherwise(F.slice(t, 1, 0))))
    elif kind == "sub_item_project_table":
        hints = F.concat(hints, F.array(F.lit("SUB_ITEM_AMOUNT_COLUMN_GUIDE: " + ", ".join(rules.FIELDS[kind][6:11]))))
    budget = max(limit, 1000)

    def fit(x: Column) -> Column:
        start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("n"), F.lit(False).alias("full"))
        step = lambda a, line: let(a["full"] | (a["used"] + F.length(line) + 1 > budget), lambda full: F.struct(F.when(full, a["used"]).otherwise(a["used"] + F.length(line) + 1).alias("used"), F.when(full, a["n"]).otherwise(a["n"] + 1).alias("n"), full.alias("full")))
        return F.aggregate(F.concat(x["h"], x["r"]), start, step)

    def shown(x: Column, a: Column) -> Column:
        mark = F.format_string("...[table_truncated_before_row_%03d]", F.greatest(a["n"] - F.size(x["h"]), F.lit(0)) + 1)
        kept = F.slice(F.concat(x["h"], x["r"]), 1, a["n"])
        return F.array_join(F.when(a["full"] & (a["used"] + F.length(mark) + 1 <= budget), F.concat(kept, F.array(mark))).otherwise(kept), "\n")

    whole = let(F.struct(hints.alias("h"), rows.alias("r")), lambda x: let(fit(x), lambda a: shown(x, a)))
    return F.when(F.size(grid) > 0, whole).otherwise("")


def is_data_row(row: Column, kind: str) -> Column:
    first = strip(F.coalesce(F.get(row, F.lit(0)), F.lit("")))
    if kind == "unit_project_fee_table":
        return starts_top_level(first)
    coded = F.concat_ws(" ", row).rlike(r"\b[0-9]{9,15}\b") if kind == "sub_item_project_table" else F.lit(False)
    return first.rlike(r"\A[0-9]+\z") | coded


def header_rows(grid: Column, kind: str) -> Column:
    """How many rows come before the first data row, at least one and at most the type's usual number."""
    most = F.least(F.lit(rules.HEADER_ROWS.get(kind, 3)), F.size(grid))
    first = F.array_position(F.transform(grid, lambda r: F.coalesce(is_data_row(r, kind), F.lit(False))), True).cast("int") - 1
    return let(first, lambda at: F.when(at >= 0, F.greatest(F.least(at, most), F.lit(1))).otherwise(most))


def table_chunks(grid: Column, kind: str, limit: int = TEXT_LIMIT) -> Column:
    """(grid, chunk_index, data_rows, source_row_start) of a table: itself where it fits, else its header rows with as many data rows as fit; source_row_start counts from 1."""
    room = max(limit - 1400, 2000)

    def ends(head: Column, rows: Column) -> Column:
        """How many rows come before each chunk and after the last one; numbers only, as the grid would be copied at each step."""
        sizes = F.transform(F.slice(rows, head + 1, F.greatest(F.size(grid) - head, F.lit(0))), lambda r: F.length(r) + 1)
        start = F.struct(F.lit(0).alias("used"), F.expr("cast(array() as array<int>)").alias("cuts"), F.lit(0).alias("i"))
        step = lambda a, n: let((a["used"] > 0) & (a["used"] + n > room), lambda full: F.struct(F.when(full, n).otherwise(a["used"] + n).alias("used"), F.when(full, F.concat(a["cuts"], F.array(a["i"]))).otherwise(a["cuts"]).alias("cuts"), (a["i"] + 1).alias("i")))
        return F.aggregate(sizes, start, step, lambda a: F.transform(F.concat(F.array(F.lit(0)), a["cuts"], F.array(a["i"])), lambda n: n + head))

    def bounds(rows: Column) -> Column:
        none = F.array(F.lit(0), F.size(grid))
        cutting = let(header_rows(grid, kind), lambda head: F.when(F.size(grid) > head, ends(head, rows)).otherwise(none))
        return F.when(F.contains(table_text(grid, kind, limit=limit, rows=rows), F.lit("...[table_truncated_before_row_")), cutting).otherwise(none)

    def part(start: Column, end: Column, head: Column, k: Column) -> Column:
        return F.struct(F.concat(F.slice(grid, F.lit(1), head), F.slice(grid, start + 1, end - start)).alias("grid"), (k + 1).alias("chunk_index"), (end - start).alias("data_rows"), (start + 1).alias("source_row_start"))

    # the first bound is the number of header rows that each chunk repeats, none for a whole table
    found = let(rendered_rows(grid, kind), bounds)
    pairs = let(found, lambda e: F.transform(F.slice(e, 1, F.size(e) - 1), lambda b, k: F.struct(b.alias("b"), F.get(e, k + 1).alias("e"), F.get(e, F.lit(0)).alias("head"))))
    return F.transform(pairs, lambda p, k: part(p["b"], p["e"], p["head"], k))


def prompt(text: Column, kind: str) -> Column:
    """The request for a table's rows, made from its type's fields."""
    fields = ", ".join(f'"{f}"' for f in rules.FIELDS[kind])
    extra = {
        "unit_project_fee_table": " Only rows whose number is 1 to 7 without a dot; split a merged number and name.",
        "sub_item_project_table": " Skip headings, building rows and totals; a line without code, unit, quantity and amount goes on with the description above it.",
    }.get(kind, " Skip headings and totals.")
    amounts = f" Digits and dots only in {', '.join(rules.AMOUNTS[kind])}." if rules.AMOUNTS[kind] else ""
    return F.concat(F.lit(f"{SYSTEM}\nTable type: {kind}. A JSON list of objects with the keys {fields}.{extra}{amounts}\n"), text)


def normalised(row: Column, kind: str) -> Column:
    """A struct of the type's fields from a string map with aliases; zero and null are blank, amounts keep digits and dots, formulas lose their markup."""
    blank_zero = lambda v: F.when(v.isin("0", "0.0"), "").otherwise(v)
    value = {f: let(aliased(row, f), blank_zero) for f in rules.FIELDS[kind]}
    value |= {f: clean_amount(value[f]) for f in rules.AMOUNTS[kind]}
    if kind == "unit_project_fee_table":
        summed = F.replace(F.regexp_replace(value["formula"], r"\$?\s*\\sum\s*\$?", "Σ"), F.lit("∑"), F.lit("Σ"))
        formula = F.when(F.contains(value["fee_name"], F.lit("分部分项工程费")), summed).otherwise(value["formula"])
        for found, put in ((r"\times", "×"), (r"\%", "%"), ("$", "")):
            formula = F.replace(formula, F.lit(found), F.lit(put))
        value["formula"] = F.regexp_replace(formula, r"(?U)\s+", "")
    return F.struct(*[v.alias(f) for f, v in value.items()])


def prompts(tables: DataFrame, kind: str, limit: int = TEXT_LIMIT) -> DataFrame:
    """What a model is asked about ``tables`` (grid and any columns): those columns, chunk_index, data_rows, source_row_start and prompt, a row a chunk."""
    named = [c for c in tables.columns if c != "grid"]
    cut = tables.select(*named, F.explode(table_chunks(F.col("grid"), kind, limit)).alias("c"))
    told = F.when((F.col("c.chunk_index") > 1) | (F.col("c.source_row_start") > 1), F.concat(F.format_string("TABLE_CHUNK_INFO chunk_index=%d data_rows=%d source_row_start=%d\n", "c.chunk_index", "c.data_rows", "c.source_row_start"))).otherwise("")
    return cut.where(F.size("c.grid") > 0).select(*named, F.col("c.chunk_index").alias("chunk_index"), F.col("c.data_rows").alias("data_rows"), F.col("c.source_row_start").alias("source_row_start"), prompt(F.concat(told, table_text(F.col("c.grid"), kind, limit=limit)), kind).alias("prompt"))


def extract_tables(tables: DataFrame, kind: str, backend: Backend, limit: int = TEXT_LIMIT, keep: bool = False) -> DataFrame:
    """The normalised rows that ``backend`` finds in ``tables`` (grid and any columns): those columns, chunk_index, idx and the fields; with ``keep`` prompt and reply too."""
    named = [c for c in tables.columns if c != "grid"]
    asked = prompts(tables, kind, limit).drop("data_rows", "source_row_start")
    rows = backend.answered(asked).select(*named, "chunk_index", *(["prompt", "reply"] if keep else []), F.posexplode(parse_replies(F.col("reply"))).alias("idx", "row"))
    return rows.withColumn("row", normalised(F.col("row"), kind)).select(*[c for c in rows.columns if c != "row"], "row.*")


def process_prompt(text: Column) -> Column:
    """The request to mend a construction-process section."""
    return F.concat(F.lit('Mend this construction-process text: join broken lines, drop seals, signatures and images, keep sub-headings, numbered steps, quantities and places. A JSON object with "cleaned_content" and "structured_items", a list of {"target", "section", "steps"}.\n'), text)


def cleaned_processes(sections: DataFrame, backend: Backend, limit: int = PROCESS_LIMIT) -> DataFrame:
    """``sections`` (file_name, content and more) with cleaned_content and structured_items; a chunk without a usable reply stays as it is."""
    item = "array<struct<target:string,section:string,steps:array<string>>>"

    def parsed(replies: pd.Series) -> pd.Series:
        import json

        def first(text):
            bare = (text or "").strip().removeprefix("```json").removeprefix("```").removesuffix("```")
            try:  # an object may hold lists, so it is tried whole first
                rows = [json.loads(bare)]
            except ValueError:
                rows = lenient_json(text) or []
            found = rows[0][0] if rows and isinstance(rows[0], list) and rows[0] else rows[0] if rows else None
            return json.dumps(found, ensure_ascii=False) if isinstance(found, dict) else None

        return replies.map(first)

    parsed.__annotations__ = {"replies": pd.Series, "return": pd.Series}
    asked = sections.select("file_name", F.posexplode(chunk_lines(F.split("content", "\n"), limit)).alias("k", "chunk")).withColumn("prompt", process_prompt(F.col("chunk")))
    found = backend.answered(asked).withColumn("o", F.from_json(F.pandas_udf(parsed, "string")(F.col("reply")), f"cleaned_content string, structured_items {item}"))
    text = F.when(is_blank(F.col("o.cleaned_content")), F.col("chunk")).otherwise(strip(F.col("o.cleaned_content")))
    parts = found.groupBy("file_name").agg(F.array_sort(F.collect_list(F.struct("k", text.alias("t"), F.coalesce("o.structured_items", F.expr(f"cast(array() as {item})")).alias("i")))).alias("p"))
    mended = parts.select("file_name", strip(F.array_join(F.transform("p", lambda x: x["t"]), "\n")).alias("cleaned_content"), F.flatten(F.transform("p", lambda x: x["i"])).alias("structured_items"))
    return sections.drop("cleaned_content", "structured_items").join(mended, "file_name", "left").withColumn("cleaned_content", F.coalesce("cleaned_content", F.lit("")))


__all__ = ["Backend", "CallBackend", "cleaned_processes", "extract_tables", "normalised", "table_chunks", "table_text"]
