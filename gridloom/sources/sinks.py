"""What is written: tables as part files, and rows (name, content) that ``files.write_files`` makes files of. Nothing is gathered on the driver."""

from __future__ import annotations

import json
from collections.abc import Sequence
from json.encoder import encode_basestring

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import page_name, page_suffix
from ..operators import scans
from ..operators.sequences import block_summary, harvest_html

SCRIPT_HEAD = ("#!/usr/bin/env bash", "set -eo pipefail", "")


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None, one_file: bool = False) -> None:
    """Tab-separated with a header; ``one_file`` is for lists that people read."""
    df = df.select(*columns) if columns else df
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="")


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, in a folder per value of ``by`` if given."""
    (df.write.partitionBy(by) if by else df.write).mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_ocr_lines(pages: DataFrame, path: str) -> None:
    """A text line per item: score to four places, a tab, the text."""
    items = pages.select(F.explode("items").alias("i"))
    items.select(F.format_string("%.4f\t%s", "i.score", "i.text").alias("value")).write.mode("overwrite").text(path)


def rerun_commands(targets: DataFrame, command: str = "extract") -> DataFrame:
    """A work list: one shell-quoted command per file with its sorted pages."""
    quoted = F.concat(F.lit("'"), F.regexp_replace("file_name", "'", "'\"'\"'"), F.lit("'"))
    grouped = targets.groupBy("file_name").agg(F.array_join(F.array_sort(F.collect_set("page_no")).cast("array<string>"), ",").alias("pages"))
    return grouped.select("file_name", "pages", F.concat_ws(" ", F.lit(command), F.lit("--file"), quoted, F.lit("--page"), "pages").alias("value"))


def rerun_script(targets: DataFrame, command: str = "extract") -> DataFrame:
    """(ord, line) of a shell script with one command per file of a work list, sorted; it ends at the first failure."""
    rows = scans.numbered(rerun_commands(targets, command), ["file_name"], "k")
    every = rows.agg(F.count("*").alias("n"))
    told = F.format_string("echo '### %d/%d %s pages=%s'", "k", "n", F.regexp_replace("file_name", "'", "'\"'\"'"), "pages")
    lines = F.array(F.struct((F.col("k") * 3).alias("ord"), told.alias("line")), F.struct((F.col("k") * 3 + 1).alias("ord"), F.col("value").alias("line")), F.struct((F.col("k") * 3 + 2).alias("ord"), F.lit("").alias("line")))
    head = targets.sparkSession.range(3).select(F.col("id").alias("ord"), F.element_at(F.array(*map(F.lit, SCRIPT_HEAD)), (F.col("id") + 1).cast("int")).alias("line"))
    return head.unionByName(rows.join(every).select(F.explode(lines).alias("x")).select("x.ord", "x.line"))


def write_script(targets: DataFrame, path: str, command: str = "extract") -> None:
    """The script as one text file in the folder ``path``: one task writes the lines as they come, sorted."""
    rerun_script(targets, command).orderBy("ord").coalesce(1).select("line").write.mode("overwrite").text(path)


def bundled(df: DataFrame, source: str, payload: Column) -> DataFrame:
    """(source_json, payload): a bundle's entries as rows, payloads as JSON; one that is no object is wrapped as data."""
    text = F.to_json(payload) if isinstance(df.select(payload).schema[0].dataType, StructType) else F.to_json(F.struct(payload.alias("data")))
    return df.select(F.col(source).alias("source_json"), text.alias("payload"))


def write_bundle(df: DataFrame, source: str, payload: Column, path: str, generated_at: str) -> int:
    """Entries as JSON lines, sorted by source within files that follow one another, beside a manifest of their number; raises where there is none."""
    entries = bundled(df, source, payload).sort("source_json")
    count = df.count()
    if count == 0:
        raise ValueError("nothing to bundle")
    entries.write.mode("overwrite").json(f"{path}/files")
    manifest = df.sparkSession.range(1).select(F.lit(count).alias("file_count"), F.lit(generated_at).alias("generated_at"))
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return count


def page_text_files(texts: DataFrame) -> DataFrame:
    """(name, content) of each page's text (file_name, page_no, image_path, engine, lines): a text file and a JSON file."""
    text = F.array_join("lines", "\n")
    payload = F.struct("image_path", "page_no", "engine", F.size("lines").alias("line_count"), "lines", text.alias("text"))
    stem = F.concat(F.col("file_name"), F.lit("/"), page_name(F.col("page_no")))
    files = F.array(F.struct(F.concat(stem, F.lit("_text.txt")).alias("name"), text.alias("t")), F.struct(F.concat(stem, F.lit("_text.json")).alias("name"), F.to_json(payload, {"ignoreNullFields": "false"}).alias("t")))
    return texts.select(F.explode(files).alias("f")).select("f.name", F.encode("f.t", "UTF-8").alias("content"))


def ocr_files(pages: DataFrame) -> DataFrame:
    """(name, content) of each page's recognition (file_name, page_no, items and more): a JSON file and scored lines."""
    stem = F.concat(F.col("file_name"), F.lit("/"), page_name(F.col("page_no")))
    lines = F.array_join(F.transform("items", lambda i: F.format_string("%.4f\t%s", i["score"], i["text"])), "\n")
    payload = F.to_json(F.struct(*[c for c in pages.columns if c != "file_name"]), {"ignoreNullFields": "false"})
    files = F.array(F.struct(F.concat(stem, F.lit("_rapid_ocr.json")).alias("name"), payload.alias("t")), F.struct(F.concat(stem, F.lit("_rapid_ocr.txt")).alias("name"), lines.alias("t")))
    return pages.select(F.explode(files).alias("f")).select("f.name", F.encode("f.t", "UTF-8").alias("content"))


def vl_files(pages: DataFrame) -> DataFrame:
    """(name, content) of each page's vision-language result (file_name, page_no, image_path, markdown, html, blocks): JSON with its summary, Markdown if any, an HTML file per value."""
    stem = F.concat(F.col("file_name"), F.lit("/"), page_name(F.col("page_no")), F.lit("_vl"))
    html = harvest_html(F.col("html"), F.col("blocks"))
    markdown = F.trim(F.array_join(F.filter("markdown", lambda m: F.trim(m) != ""), "\n\n"))
    labels = F.aggregate("blocks", F.expr("cast(map() as map<string,bigint>)"), lambda m, b: F.map_concat(F.map_filter(m, lambda k, v: k != b["block_label"]), F.create_map(b["block_label"], F.coalesce(F.try_element_at(m, b["block_label"]), F.lit(0).cast("long")) + 1)))
    counts = block_summary(F.col("blocks"))
    summary = F.struct(counts["block_count"].alias("block_count"), counts["table_blocks"].alias("table_blocks"), labels.alias("label_counts"), (markdown != "").alias("has_markdown"), F.size(html).alias("html_files"), F.lit(False).alias("generated_preview_html"))
    payload = F.to_json(F.struct("image_path", "page_no", summary.alias("summary"), F.array(F.struct(F.col("blocks").alias("parsing_res_list"))).alias("results")), {"ignoreNullFields": "false"})
    file = lambda ending, t: F.struct(F.concat(stem, ending).alias("name"), t.alias("t"))
    numbered = F.transform(html, lambda h, i: file(F.when(i == 0, ".html").otherwise(F.format_string("_%02d.html", i + 1)), h))
    none = F.slice(numbered, 1, 0)
    files = F.concat(F.array(file(F.lit(".json"), payload)), F.when(markdown != "", F.array(file(F.lit(".md"), markdown))).otherwise(none), numbered)
    return pages.select(F.explode(files).alias("f")).select("f.name", F.encode("f.t", "UTF-8").alias("content"))


def debug_files(asked: DataFrame, label: str) -> DataFrame:
    """(name, content): numbered prompt and reply files of rows (ord, prompt, reply)."""
    safe = "".join(c if c.isascii() and (c.isalnum() or c in "_-") else "_" for c in label).strip("_") or "llm"
    file = lambda n, kind, t: F.struct(F.format_string(f"%04d_{safe}_{kind}.txt", n).alias("name"), t.alias("t"))
    files = F.array(file(F.col("ord") * 2 + 1, "prompt", F.col("prompt")), file(F.col("ord") * 2 + 2, "response", F.trim("reply")))
    return asked.select(F.explode(files).alias("f")).select("f.name", F.encode(F.coalesce("f.t", F.lit("")), "UTF-8").alias("content"))


def _indented(value: object, gap: str = "\n") -> str:
    """What ``json.dumps`` gives of a value read from JSON with ``indent=2`` and ``ensure_ascii=False``, in a fraction of its time."""
    if isinstance(value, str):
        return encode_basestring(value)
    if isinstance(value, dict) and value:
        inner = gap + "  "
        return "{" + ",".join([f"{inner}{encode_basestring(k)}: {_indented(v, inner)}" for k, v in value.items()]) + gap + "}"
    if isinstance(value, list) and value:
        inner = gap + "  "
        return "[" + ",".join([inner + _indented(v, inner) for v in value]) + gap + "]"
    return "null" if value is None else json.dumps(value)


def pretty(text: Column) -> Column:
    """JSON laid out over lines, two blanks a level, characters as they are; null for what is no JSON."""

    def laid_out(x: str | None) -> str | None:
        try:
            return None if x is None else _indented(json.loads(x))
        except ValueError:
            return None

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(laid_out)

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(text)


def record_files(records: DataFrame, file: str = "business_extract.json") -> DataFrame:
    """(name, content): each record (file_name and more) as a pretty JSON file in its document's folder, nulls included."""
    payload = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    return records.select(F.concat("file_name", F.lit(f"/{file}")).alias("name"), F.encode(pretty(payload), "UTF-8").alias("content"))


#: Lists of a record that a report counts.
COUNTED = ("sub_projects", "specialty_fee_rows", "quantity_confirm_rows", "labor_rows", "material_rows", "machine_rows", "construction_processes")


def reports(pages: DataFrame, records: DataFrame, counts: DataFrame, partial: bool = False) -> DataFrame:
    """The extraction report of each document of ``counts``, one row each.

    ``pages`` has the page summaries (file_name, page_no, table_index, rows and more), ``records`` the records as they are
    stored, ``counts`` what the run saw: file_name, page_numbers, vl_page_count, page_text_count and elapsed_seconds.
    """
    fields = F.struct(*[c for c in pages.columns if c != "file_name"])
    entry = F.struct("page_no", F.coalesce("table_index", F.lit(-1)).alias("_t"), fields.alias("p"))
    grouped = pages.groupBy("file_name").agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    size = lambda c: F.coalesce(F.size(c), F.lit(0)) if c in records.columns else F.lit(0)
    kept = records.select("file_name", *[F.greatest(size(c), F.lit(0)).alias(c) for c in COUNTED], F.col("document_info"))
    joined = counts.join(kept, "file_name", "left").join(grouped, "file_name", "left")
    return joined.select(
        "file_name", F.size("page_numbers").alias("processed_pages"), F.lit(partial).alias("partial_update"), "vl_page_count", "page_text_count",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTED], "document_info", F.round("elapsed_seconds", 2).alias("elapsed_seconds"), F.transform("_e", lambda x: x["p"]).alias("pages"), "page_numbers",
    )


def report_files(made: DataFrame, partial: bool = False) -> DataFrame:
    """(name, content): a pretty JSON file for each of ``reports``; that of a partial run names its pages."""
    fields = [c for c in made.columns if c != "page_numbers"]
    suffix = F.concat(F.lit("_"), page_suffix(F.col("page_numbers")), F.lit("_partial")) if partial else F.lit("")
    name = F.concat(F.col("file_name"), F.lit("_vl_llm_extract"), suffix, F.lit("_summary.json"))
    return made.select(name.alias("name"), F.encode(pretty(_report_json(fields)), "UTF-8").alias("content"))


def _report_json(fields: Sequence[str]) -> Column:
    shown = {"pages": F.coalesce("pages", F.expr("array()")), "document_info": F.col("document_info")}
    return F.to_json(F.struct(*[shown.get(c, F.col(c)).alias(c) for c in fields]), {"ignoreNullFields": "false"})


def run_report(made: DataFrame) -> DataFrame:
    """(ord, value): all reports of a run as the lines of one JSON list, by document; ``ord`` sorts them."""
    fields = [c for c in made.columns if c != "page_numbers"]
    rows = scans.numbered(made.select("file_name", _report_json(fields).alias("json")), ["file_name"], "k")
    ends = made.sparkSession.range(2).select((F.col("id") * F.lit(1 << 62)).alias("ord"), F.when(F.col("id") == 0, "[").otherwise("]").alias("value"))
    return ends.unionByName(rows.select(F.col("k").cast("long").alias("ord"), F.concat(F.when(F.col("k") > 1, ",").otherwise(""), "json").alias("value")))


def write_run_report(made: DataFrame, path: str) -> None:
    """The list of a run's reports as one file in the folder ``path``: one task writes the lines as they come."""
    run_report(made).orderBy("ord").coalesce(1).select("value").write.mode("overwrite").text(path)
