"""Workbooks without a library: SpreadsheetML parts in a zip, written and read by the standard library.

A sheet holds 1,048,576 rows, so a longer table becomes several workbooks, each made whole in one task.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
SHEET, SHEET_ROWS = "by_sub_project", 1_048_576
WIDE = ("consultation_project_name", "renovation_content", "sub_item_project_rows", "sub_item_project_warnings")
WIDTH, WIDE_WIDTH = 28, 42
_FORBIDDEN = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def column_name(k: int) -> str:
    """A, B, ..., Z, AA, ... of 0, 1, ..."""
    name = ""
    k += 1
    while k:
        k, rest = divmod(k - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell(at: str, value: str, style: int) -> str:
    return f'<c r="{at}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{escape(_FORBIDDEN.sub("", value))}</t></is></c>'


def workbook(headers: Sequence[str], rows: Iterable[Sequence[str | None]], sheet: str = SHEET) -> bytes:
    """A workbook of one sheet: bold centred headers, wrapped cells, wide text columns, first row frozen, filter on."""
    lines, n = [], 0
    for n, row in enumerate([headers, *rows], 1):  # noqa: B007
        style = 1 if n == 1 else 2
        lines.append(f'<row r="{n}">' + "".join(_cell(f"{column_name(k)}{n}", v or "", style) for k, v in enumerate(row)) + "</row>")
    area = f"A1:{column_name(len(headers) - 1)}{n}"
    cols = "".join(f'<col min="{k}" max="{k}" width="{WIDE_WIDTH if h in WIDE else WIDTH}" customWidth="1"/>' for k, h in enumerate(headers, 1))
    view = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
    start = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    fonts = '<fonts count="2"><font><sz val="11"/><name val="Calibri"/></font><font><b/><sz val="11"/><name val="Calibri"/></font></fonts>'
    plain = '<fills count="1"><fill><patternFill patternType="none"/></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    styles = '<cellXfs count="3"><xf/><xf fontId="1" applyFont="1" applyAlignment="1"><alignment horizontal="center" vertical="center" wrapText="1"/></xf><xf applyAlignment="1"><alignment vertical="top" wrapText="1"/></xf></cellXfs>'
    office = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'{start}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{office}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{office}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{office}.styles+xml"/></Types>',
        "_rels/.rels": f'{start}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/_rels/workbook.xml.rels": f'{start}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{RELS}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{RELS}/styles" Target="styles.xml"/></Relationships>',
        "xl/workbook.xml": f'{start}<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/styles.xml": f'{start}<styleSheet xmlns="{MAIN}">{fonts}{plain}{styles}</styleSheet>',
        "xl/worksheets/sheet1.xml": f'{start}<worksheet xmlns="{MAIN}">{view}<cols>{cols}</cols><sheetData>{"".join(lines)}</sheetData><autoFilter ref="{area}"/></worksheet>',
    }
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), text.encode())
    return held.getvalue()


def read_sheet(content: bytes) -> Iterator[list[str]]:
    """The rows of a workbook's first sheet as texts, blanks filled in."""
    tag = lambda name: f"{{{MAIN}}}{name}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in item.iter(tag("t"))) for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(tag("si"))]
        first = min((n for n in z.namelist() if n.startswith("xl/worksheets/")), key=lambda n: (len(n), n))
        for row in ElementTree.fromstring(z.read(first)).iter(tag("row")):
            cells: dict[int, str] = {}
            for k, c in enumerate(row.iter(tag("c"))):
                letters = re.match(r"[A-Z]+", c.get("r") or "")
                at = sum((ord(x) - 64) * 26**p for p, x in enumerate(reversed(letters[0]))) - 1 if letters else k
                value = c.find(tag("v"))
                text = "".join(t.text or "" for t in c.iter(tag("t"))) if value is None else value.text or ""
                cells[at] = shared[int(text)] if c.get("t") == "s" else text
            yield [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]


def excel_files(rows: DataFrame, columns: Sequence[str] = rules.EXPORT_COLUMNS, order: Sequence[str] = ("file_name",), rows_per_file: int = SHEET_ROWS - 1) -> DataFrame:
    """(name, content): workbooks of ``rows``, sorted, at most ``rows_per_file`` rows each; a table without rows gives one with headers only."""
    files = -(-rows.count() // rows_per_file)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    keys = [F.col(c).alias(f"_o{k}") for k, c in enumerate(order)]
    names, sort, each = list(columns), [(f"_o{k}", "ascending") for k in range(len(order))], rows_per_file

    def books(table: pa.Table, group: int) -> pa.RecordBatch:
        held = list(zip(*(c.to_pylist() for c in table.sort_by(sort).select(names).columns), strict=True))
        parts = [held[i : i + each] for i in range(0, len(held), each)] or [[]]
        made = [(f"{group:05d}-{k:03d}.xlsx", workbook(names, p)) for k, p in enumerate(parts)]
        return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made]), pa.array([m[1] for m in made], pa.binary())], names=["name", "content"])

    if files == 0:
        return rows.sparkSession.createDataFrame([("00000-000.xlsx", bytearray(workbook(names, [])))], "name string, content binary")
    ranged = rows.repartitionByRange(files, *order).select(F.spark_partition_id().alias("_p"), *texts, *keys)
    return ranged.groupBy("_p").applyInArrow(lambda table: pa.Table.from_batches([books(table, table.column("_p")[0].as_py())]), "name string, content binary")


def excel_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, row): every sub-item row, as JSON, of the export workbooks under ``path``; bad cells are skipped, a sheet without the two columns gives an error row (file_name null)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        for batch in batches:
            names, found, errors = [], [], []
            for where, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sheet = read_sheet(content)
                head = [h.strip() for h in next(sheet, [])]
                if not {"file_name", "sub_item_project_rows"} <= set(head):
                    names.append(None), found.append(None), errors.append(f"{where}: no file_name and sub_item_project_rows")
                    continue
                at = head.index("file_name"), head.index("sub_item_project_rows")
                for row in sheet:
                    name, cell = (row[k].strip() if k < len(row) else "" for k in at)
                    try:
                        listed = json.loads(cell) if name and cell else []
                    except ValueError:
                        continue
                    for x in listed if isinstance(listed, list) else []:
                        if isinstance(x, dict):
                            names.append(name), found.append(json.dumps(x, ensure_ascii=False)), errors.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string()), pa.array(errors, pa.string())], names=["file_name", "row", "error"])

    return raw.mapInArrow(read, "file_name string, row string, error string")
