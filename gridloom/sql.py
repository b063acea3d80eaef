"""The library in Spark SQL: table functions for lateral joins and scalar functions, registered for a session.

``register(spark)`` once; then for instance

    SELECT t.page_no, x.seq, x.project_name
    FROM pages t, LATERAL html_table(t.content) g, LATERAL extract_rows(g.grid, 'sub_item_project_table') x
"""

from __future__ import annotations

from collections.abc import Iterator
from inspect import signature as signature_of

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from . import rules
from .functions.text import ASCII_DIGITS, CJK_DIGITS, WHITE
from .operators import extract, grids

GRID = "array<array<string>>"
#: The fields of all table types, in the order they first come.
FIELDS = list(dict.fromkeys(f for kind in extract.TABLES for f in extract.fields_of(kind)))


@udtf(returnType=f"table_index int, grid {GRID}")
class MdTable:
    """The tables of a Markdown text."""

    def eval(self, content: str) -> Iterator[tuple]:
        yield from enumerate(grids.markdown_tables(content))


def html_grids(texts: pa.Array, strict: pa.Array) -> pa.Array:
    """The tables of HTML texts, spans laid out."""
    return pa.array([grids.html_tables(t, strict=bool(s)) for t, s in zip(texts.to_pylist(), strict.to_pylist(), strict=True)], pa.list_(pa.list_(pa.list_(pa.string()))))


def grid_rows(tables: pa.Array, kinds: pa.Array) -> pa.Array:
    """The rows that the rules find in grids of table types; fields of other types are null."""
    names = kinds.to_pylist()
    for kind in set(names) - extract.TABLES.keys():
        raise ValueError(f"no table type {kind!r}; there are {', '.join(extract.TABLES)}")
    return extract.listed_rows(tables, names, FIELDS, None)


@udtf(returnType=f"chunk_index int, first_row int, grid {GRID}")
class TableChunks:
    """A grid in pieces of at most ``rows`` rows below its first ``head`` rows, which every piece repeats."""

    def eval(self, grid: list, head: int, rows: int) -> Iterator[tuple]:
        grid, head, rows = grid or [], max(head, 0), max(rows, 1)
        body = grid[head:]
        for k, at in enumerate(range(0, max(len(body), 1), rows), 1):
            yield k, head + at + 1, [*grid[:head], *body[at : at + rows]]


TABLE_FUNCTIONS = {"md_table": MdTable, "table_chunks": TableChunks}
#: Functions of Arrow batches, and what they return; table functions in SQL unfold it, where one in Python would be called, and paid for, row by row.
BATCHED = {"gridloom_html_grids": (html_grids, grids.GRIDS), "gridloom_grid_rows": (grid_rows, "array<struct<" + ", ".join(f"{f}: string" for f in FIELDS) + ">>")}
#: name(parameters), the table and the query that gives it.
UNFOLDED = (
    ("html_table(content STRING, strict BOOLEAN DEFAULT false)", f"table_index INT, grid {GRID}", "SELECT pos, col FROM posexplode(gridloom_html_grids(html_table.content, html_table.strict))"),
    (f"extract_rows(grid {GRID}, kind STRING)", "idx INT, " + ", ".join(f"{f} STRING" for f in FIELDS), "SELECT pos, col.* FROM posexplode(gridloom_grid_rows(extract_rows.grid, extract_rows.kind))"),
)


def _quoted(text: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" if not c.isascii() or not c.isprintable() else c for c in text).replace("'", "\\'") + "'"


#: name(parameters), what it returns and its body.
SCALARS = (
    ("strip_text(t STRING)", "STRING", f"btrim(coalesce(t, ''), {_quoted(WHITE)})"),
    ("compact_text(t STRING)", "STRING", r"regexp_replace(coalesce(t, ''), '(?U)\\s+', '')"),
    ("clean_amount(t STRING)", "STRING", "regexp_replace(coalesce(t, ''), '[^0-9.]', '')"),
    ("is_amount(t STRING)", "BOOLEAN", r"coalesce(t, '') rlike '(?U)\\A[￥¥,\\s]*+(?:\\d[￥¥,\\s]*+)++(?:\\.[￥¥,\\s]*+(?:\\d[￥¥,\\s]*+)++)?\\z'"),
    ("is_valid_seq(t STRING)", "BOOLEAN", r"coalesce(t, '') rlike '(?U)\\A\\s*+\\d++(?:\\.\\d++)?\\s*+\\z'"),
    ("is_project_code(t STRING)", "BOOLEAN", r"coalesce(t, '') rlike '(?U)\\A\\s*+\\d{9,15}\\s*+\\z'"),
    ("normalize_unit(t STRING)", "STRING", r"regexp_replace(regexp_replace(btrim(coalesce(t, '')), '(?U)\\$\\s*m\\^\\{?2\\}?\\s*\\$', 'm2'), '(?U)\\s+', '')"),
    ("page_number(t STRING)", "INT", r"try_cast(regexp_extract(t, 'page[_-](\\d+)', 1) AS INT)"),
    ("cjk_digits(t STRING)", "STRING", f"translate(coalesce(t, ''), {_quoted(CJK_DIGITS)}, '{ASCII_DIGITS}')"),
    ("is_subtotal(t STRING)", "BOOLEAN", "coalesce(" + " OR ".join(f"contains(t, '{x}')" for x in rules.SUBTOTALS) + ", false)"),
)


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session; scalar ones are SQL, which the optimizer sees through."""
    for name, function in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, function)
    for name, (function, kind) in BATCHED.items():
        function.__annotations__ = {**dict.fromkeys(signature_of(function).parameters, pa.Array), "return": pa.Array}  # types, not their names
        spark.udf.register(name, F.arrow_udf(function, kind))
    for signature, columns, body in UNFOLDED:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")
    for signature, kind, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
