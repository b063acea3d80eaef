"""Readers of page artifacts and business records: one row per file or page, bad files aside, never an exception per file."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import rules, schemas
from ..functions.text import page_number, strip
from ..operators.pages import page_select
from . import scratch
from .files import Wanted, artifact_files

#: Names of the folder of business records, of the one that may hold it with the reports, and of a document's record.
BUSINESS, OUTPUT, BUSINESS_FILE = "business_json_vl_llm", "extraction_output", "business_extract.json"


def _path() -> Column:
    """The path of the file a row was read from, as it is spelt on disk."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)/*$", 1), r"(?<=.)\.[^.]*$", "")


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def documents(spark: SparkSession, root: str, pattern: str = "*.[pP][dD][fF]") -> DataFrame:
    """(file_name, path, length) of the document files right under ``root``; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root).select(_stem(F.col("path")).alias("file_name"), "path", "length")


def _resolved(path: Column) -> Column:
    """A path without doubled slashes, ``.`` steps and ``x/..`` detours, at any depth: one fold over its steps."""
    none = F.expr("cast(array() as array<string>)")
    rooted = path.startswith("/")

    def step(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        back = F.when(F.size(done) == 0, F.when(rooted, done).otherwise(F.array(s))).when(last == "..", F.concat(done, F.array(s))).otherwise(F.slice(done, 1, F.size(done) - 1))
        return F.when((s == "") | (s == "."), done).when(s == "..", back).otherwise(F.concat(done, F.array(s)))

    return F.concat(F.when(rooted, "/").otherwise(""), F.array_join(F.aggregate(F.split(path, "/"), none, step), "/"))


def resolve_list(spark: SparkSession, known: DataFrame, files: Sequence[str] = (), list_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(found, missing) of the wanted paths (ord, path), resolved, each once in the order given; blank and # lines of the list file, read whole, are skipped."""
    wanted = spark.createDataFrame([(i, f) for i, f in enumerate(files)], "ord long, path string")
    if list_path:
        lines = spark.read.text(list_path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("k", "path"))
        lines = lines.select((F.col("k") + len(files)).cast("long").alias("ord"), F.trim("path").alias("path"))
        wanted = wanted.unionByName(lines.where((F.col("path") != "") & ~F.col("path").startswith("#")))
    first = wanted.select("ord", _resolved(F.col("path")).alias("path")).groupBy("path").agg(F.min("ord").alias("ord"))
    have = known.select(_resolved(F.col("path")).alias("path")).distinct()
    return first.join(have, "path", "left_semi").select("ord", "path").orderBy("ord"), first.join(have, "path", "left_anti").select("ord", "path").orderBy("ord")


def json_pages(spark: SparkSession, root: str, schema: T.StructType, suffix: str, wanted: Wanted | None = None) -> DataFrame:
    """One row per readable ``page_NNN<suffix>.json`` of the document folders under ``root``: file_name, page_no (its own, else the name's, above 0), path and the payload.

    ``wanted`` goes by the pages of the names.
    """
    raw = artifact_files(spark, root, replace(wanted or Wanted(), kinds=[f"{suffix}.json"])).select("file_name", F.col("page_no").alias("named"), "path", F.decode("content", "UTF-8").alias("value"))
    parsed = raw.where(F.try_parse_json("value").isNotNull()).withColumn("p", F.from_json("value", schema))
    no = F.coalesce(F.when(F.col("p.page_no") > 0, F.col("p.page_no")), F.col("named")) if "page_no" in schema.fieldNames() else F.col("named")
    pages = parsed.where("p is not null").select("file_name", no.alias("page_no"), "path", "p").where("page_no > 0")
    last = Window.partitionBy("file_name", "page_no").orderBy(F.desc("path"))
    return pages.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def page_texts(spark: SparkSession, root: str, wanted: Wanted | None = None) -> DataFrame:
    """file_name, page_no, text; the text is the lines where it is blank."""
    pages = json_pages(spark, root, schemas.PAGE_TEXT, "_text", wanted)
    return pages.select("file_name", "page_no", F.when(F.trim(F.coalesce("p.text", F.lit(""))) != "", F.col("p.text")).otherwise(F.array_join(F.coalesce("p.lines", F.array()), "\n")).alias("text"))


def ocr_pages(spark: SparkSession, root: str, wanted: Wanted | None = None) -> DataFrame:
    return json_pages(spark, root, schemas.OCR_PAGE, "_rapid_ocr", wanted).select("file_name", "page_no", "p.items", "p.engine", "p.elapsed_seconds")


def page_artifacts(spark: SparkSession, root: str, wanted: Wanted | None = None) -> DataFrame:
    """file_name, page_no, extension, ordinal (0, then 2, 3, ... of numbered files) and content of all ``page_NNN_vl[_KK]`` JSON, HTML and Markdown files, in one scan."""
    found = artifact_files(spark, root, replace(wanted or Wanted(), kinds=["_vl.json", "_vl.html", "_vl.md"])).where("page_no > 0 AND content IS NOT NULL")
    return found.select("file_name", "page_no", F.regexp_extract("kind", r"[^.]+$", 0).alias("extension"), "ordinal", strip(F.decode("content", "UTF-8")).alias("content"))


def text_artifacts(spark: SparkSession, root: str, extension: str, wanted: Wanted | None = None) -> DataFrame:
    """The same of one extension; files of others are not opened."""
    found = artifact_files(spark, root, replace(wanted or Wanted(), kinds=[f"_vl.{extension}"])).where("page_no > 0 AND content IS NOT NULL")
    return found.select("file_name", "page_no", "ordinal", strip(F.decode("content", "UTF-8")).alias("content"))


#: A string of JSON, and the string values of content keys: inside a string every quote is escaped, so a key in bare quotes before a colon is a key.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
CONTENT = rf'(?<!\\)"(?:{"|".join(rules.CONTENT_KEYS)})"\s*+:\s*+({STRING})'


def json_texts(payload: Column) -> Column:
    """Distinct text values of a JSON payload's content keys at any depth, in the order of the text, joined by blank lines; blank for bad JSON.

    Without Python, and not by way of VARIANT, which sorts the keys of objects. Of a key that stands twice in one object both values count.
    """
    values = F.from_json(F.concat(F.lit("["), F.array_join(F.regexp_extract_all(payload, F.lit(CONTENT), F.lit(1)), ","), F.lit("]")), "array<string>")
    shown = F.array_join(F.array_distinct(F.filter(F.transform(values, lambda v: strip(v)), lambda v: v != "")), "\n\n")
    return F.when(F.try_parse_json(payload).isNotNull(), shown).otherwise("")


def business_root(spark: SparkSession, root: str, business: str = BUSINESS, output: str = OUTPUT) -> str:
    """The folder of the business records: ``root`` if it is one, else one of its usual subfolders, else ``root``; ``business`` and ``output`` name those."""
    root = root.rstrip("/")
    nested = [f"{root}/{business}", f"{root}/{output}/{business}"]
    return root if root.rsplit("/", 1)[-1] == business else next((p for p in nested if scratch.exists(spark, p)), root)


def reports_root(spark: SparkSession, business: str, given: str | None = None, output: str = OUTPUT) -> str | None:
    """The folder of the extraction reports: ``given``, else the first of the usual places beside the business records; None where it is missing."""
    above = business.rstrip("/").rsplit("/", 1)[0]
    usual = [f"{above}/reports", f"{above.rsplit('/', 1)[0]}/reports", f"{above}/{output}/reports"]
    return next((p for p in ([given] if given else usual) if scratch.exists(spark, p)), None)


def resolved_roots(starts: DataFrame, existing: DataFrame, business: str = BUSINESS, output: str = OUTPUT) -> DataFrame:
    """``starts`` (start) with business and reports, the folders that ``business_root`` and ``reports_root`` give, by a table of existing folders (path) instead of looking."""
    have = existing.select(F.regexp_replace("path", "/+$", "").alias("path")).distinct()

    def first(rows: DataFrame, candidates: Column, name: str) -> DataFrame:
        tried = rows.select("_id", F.posexplode(candidates).alias("_k", "path")).join(have, "path")
        return rows.join(tried.groupBy("_id").agg(F.min_by("path", "_k").alias(name)), "_id", "left")

    root = F.regexp_replace("start", "/+$", "")
    above = lambda c: F.regexp_replace(c, "/[^/]*$", "")
    rows = starts.select("start").distinct().withColumn("_id", F.col("start"))
    nested = first(rows, F.array(F.concat(root, F.lit(f"/{business}")), F.concat(root, F.lit(f"/{output}/{business}"))), "_found")
    is_one = F.regexp_extract(root, "[^/]*$", 0) == business
    found = nested.withColumn("business", F.when(is_one, root).otherwise(F.coalesce("_found", root)))
    up = above(F.col("business"))
    placed = first(found, F.array(F.concat(up, F.lit("/reports")), F.concat(above(up), F.lit("/reports")), F.concat(up, F.lit(f"/{output}/reports"))), "reports")
    return placed.select("start", "business", "reports")


def folders(spark: SparkSession, root: str, names: Sequence[str] = ()) -> DataFrame:
    """(file_name) of the document folders right under ``root``, with or without files; with ``names``, of those that contain one. A missing root raises."""
    return artifact_files(spark, root, Wanted(containing=list(names), pages=[]), contents=False).select("file_name").distinct()


def page_images(spark: SparkSession, root: str, selected: Sequence[int] | None = None, start: int | None = None, end: int | None = None, max_pages: int | None = None, extension: str = "png") -> DataFrame:
    """(file_name, page_no, path) of page images below ``root``, within the page limits; contents are not read."""
    wanted = Wanted(pages=selected and list(selected), first=max(1, start or 1), last=end or None, kinds=[f".{extension}"])
    named = artifact_files(spark, root, wanted, contents=False).where("page_no > 0").select("file_name", "page_no", "path")
    return page_select(named, "file_name", "page_no", selected, start, end, max_pages, ("path",))


def business_records(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(records, errors): every business_extract.json of the folders under ``root`` (any JSON file below it where there is none), and the paths whose JSON is no object."""
    preferred = artifact_files(spark, root, Wanted(kinds=[BUSINESS_FILE])).where("kind IS NOT NULL").select(F.col("path").alias("json_path"), F.decode("content", "UTF-8").alias("value"))
    if artifact_files(spark, root, Wanted(kinds=[BUSINESS_FILE]), contents=False).where("kind IS NOT NULL").isEmpty():
        raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root, wholetext=True)
        preferred = raw.select(_path().alias("json_path"), "value")
    parsed = preferred.select("json_path", F.trim("value").alias("value"))
    ok = F.col("value").startswith("{") & F.try_parse_json("value").isNotNull()
    records = parsed.where(ok).select(_folder(F.col("json_path")).alias("folder"), "json_path", F.from_json("value", schemas.PROJECT).alias("p"))
    return records, parsed.where(~ok).select("json_path", F.lit("json_error").alias("status"))


def sub_item_rows(records: DataFrame) -> DataFrame:
    """file_name, sp_index, row_index, pos, sub_project_id (or its name) and the fields of every sub-item row."""
    name = F.coalesce(F.when(F.trim("p.file_name") != "", F.col("p.file_name")), F.col("folder"))
    subs = records.select(name.alias("file_name"), "json_path", F.posexplode("p.sub_projects").alias("sp_index", "sp"))
    rows = subs.select("file_name", "json_path", "sp_index", F.coalesce(F.when(F.col("sp.sub_project_id") != "", F.col("sp.sub_project_id")), F.col("sp.sub_project_name"), F.lit("")).alias("sub_project_id"), F.posexplode("sp.sub_item_project_rows").alias("row_index", "row"))
    fields = [f"row.{f.name}" for f in schemas.SUB_ITEM.fields if f.name not in ("sub_project_id", "row_index")]
    return rows.select("file_name", "json_path", "sp_index", "row_index", F.format_string("%06d-%09d", "sp_index", "row_index").alias("pos"), "sub_project_id", *fields)


def report_pages(spark: SparkSession, root: str) -> DataFrame:
    """file_name, page_no, extractor and rows of each entry of the extraction reports; one empty entry for a report without pages."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*_vl_llm_extract_summary.json").text(root, wholetext=True)
    name = F.regexp_replace(F.regexp_extract(_path(), r"([^/]+)$", 1), "_vl_llm_extract_summary\\.json$", "")
    return raw.select(name.alias("file_name"), F.explode_outer(F.from_json("value", schemas.REPORT)["pages"]).alias("e")).select("file_name", "e.page_no", "e.extractor", "e.rows")


def page_targets(spark: SparkSession, *paths: str) -> DataFrame:
    """Distinct (file_name, page_no) of tab-separated lists; rows without a positive page go."""
    raw = spark.read.csv(list(paths), sep="\t", header=True)
    return raw.select("file_name", F.col("page_no").try_cast("int").alias("page_no")).where("page_no > 0").distinct()


def render_pages(docs: DataFrame, dpi: int = 180, start: int | None = None, end: int | None = None, selected: Sequence[int] | None = None) -> DataFrame:
    """Page images of documents (file_name, content), by an optional rendering library; pages out of range are ignored, a failure gives an error row."""

    def render(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for name, content in zip(batch.file_name, batch.content, strict=True):
                try:
                    import fitz

                    with fitz.open(stream=bytes(content), filetype="pdf") as pdf:
                        for no in range(max(1, start or 1), min(len(pdf), end or len(pdf)) + 1):
                            if not selected or no in selected:
                                out.append((name, no, pdf[no - 1].get_pixmap(dpi=dpi).tobytes("png"), None))
                except Exception as e:  # noqa: BLE001  one bad document must not end the job
                    out.append((name, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["file_name", "page_no", "image", "error"])

    return docs.select("file_name", "content").mapInPandas(render, "file_name string, page_no int, image binary, error string")
