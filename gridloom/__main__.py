"""The pipeline from the command line: ``python -m gridloom <command> ...`` (or ``spark-submit``).

extract      page texts and page artifacts under a root to business records and reports; a run over some pages is merged into earlier records
check        documents whose records or reports have issues
misaligned   pages whose amount columns look shifted
empty        pages of which the export keeps no row
rerun        a script that repeats the extraction of listed pages
export       the records as workbooks
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import settings
from .operators import audit, pages, upsert
from .plans import extraction
from .sources import artifacts, excel, files, scratch, sinks

PREFIX = "GRIDLOOM"
INFO = ("consultation_project_name", "consultation_date", "renovation_content")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gridloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, *roots: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        for root in roots:
            command.add_argument(root)
        return command

    run = add("extract", "root", "out")
    run.add_argument("--file", action="append", default=[], help="only documents whose name contains this; may be repeated")
    run.add_argument("--page", help="page numbers, by commas")
    run.add_argument("--start-page", type=int)
    run.add_argument("--end-page", type=int)
    run.add_argument("--max-pages", type=int, help="of each document")
    run.add_argument("--prefer-source", choices=("auto", "html", "md", "json", "all"), default=settings.text(f"{PREFIX}_PREFER_SOURCE") or "auto")
    run.add_argument("--created-at", default=settings.text(f"{PREFIX}_CREATED_AT") or "", help="stamped on new records; equal stamps give equal ids")
    run.add_argument("--skip-existing", action="store_true", help="leave documents alone that have a record")
    add("check", "root", "out").add_argument("--reports")
    add("misaligned", "root", "out")
    add("empty", "root", "out")
    rerun = add("rerun", "out")
    rerun.add_argument("lists", nargs="+", help="tab-separated lists with file_name and page_no")
    rerun.add_argument("--run", default="python -m gridloom extract", help="the command that a line of the script begins with")
    add("export", "root", "out").add_argument("--rows-per-file", type=int, default=excel.SHEET_ROWS - 1)
    return parser


def _rows(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    records, _ = artifacts.business_records(spark, artifacts.business_root(spark, root))
    return records, artifacts.sub_item_rows(records)


def _existing(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """Records of earlier runs, in the layout of ``like``."""
    found = files.artifact_files(spark, folder, files.Wanted(kinds=[artifacts.BUSINESS_FILE])).where("content IS NOT NULL")
    return found.select(F.from_json(F.decode("content", "UTF-8"), like.schema).alias("r")).where("r.file_name IS NOT NULL").select("r.*")


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    selected = pages.parse_page_list(args.page) if args.page else None
    wanted = files.Wanted(containing=args.file, pages=selected, first=args.start_page or 0, last=args.end_page)
    texts = artifacts.page_texts(spark, f"{args.root}/page_texts", wanted)
    found = artifacts.page_artifacts(spark, f"{args.root}/vl", wanted)
    of = lambda extension: found.where(F.col("extension") == extension).drop("extension")
    folder = f"{args.out}/{artifacts.BUSINESS}"
    if args.skip_existing and scratch.exists(spark, folder):
        done = files.artifact_files(spark, folder, files.Wanted(kinds=[artifacts.BUSINESS_FILE]), contents=False).where("kind IS NOT NULL").select("file_name")
        texts = pages.skip_existing(texts, done, ["file_name"])
    texts = scratch.stored(pages.page_select(texts, "file_name", "page_no", max_pages=args.max_pages), "texts")
    current = scratch.stored(extraction.run(texts, of("html"), of("md"), args.created_at, args.prefer_source), "records")
    run = texts.groupBy("file_name").agg(F.array_sort(F.collect_set("page_no")).alias("page_numbers"))
    partial = upsert.is_partial_run(selected, args.start_page, args.end_page, args.max_pages)
    kept = current
    if partial and scratch.exists(spark, folder):
        earlier = scratch.stored(_existing(spark, folder, current).join(current.select("file_name"), "file_name", "left_semi"), "earlier")
        lists = [*extraction.OTHER_LISTS, "construction_processes"]
        kept = scratch.stored(upsert.merge_records(earlier, current, run, lists, ["unit_project_fee_rows", "sub_item_project_rows"], INFO), "merged")
    files.write_files(sinks.record_files(kept, artifacts.BUSINESS_FILE), folder)
    rows = current.select("file_name", F.explode_outer("sub_projects").alias("s")).select("file_name", F.explode("s.sub_item_project_rows").alias("r"))
    summaries = rows.groupBy("file_name", F.col("r.page_no").alias("page_no")).agg(F.count("*").alias("rows")).withColumns({"table_index": F.lit(None).cast("int"), "extractor": F.lit("rules")})
    seen = found.select("file_name", "page_no").distinct().groupBy("file_name").agg(F.count("*").cast("int").alias("vl_page_count"))
    counts = run.join(seen, "file_name", "left").select("file_name", "page_numbers", F.coalesce("vl_page_count", F.lit(0)).alias("vl_page_count"), F.size("page_numbers").alias("page_text_count"), F.lit(None).cast("double").alias("elapsed_seconds"))
    made = scratch.stored(sinks.reports(summaries, kept, counts, partial), "reports")
    files.write_files(sinks.report_files(made, partial), f"{args.out}/reports")
    sinks.write_run_report(made, f"{args.out}/reports/all_vl_llm_extract{'_partial' if partial else ''}_summary")


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    records, rows = _rows(spark, args.root)
    root = artifacts.reports_root(spark, artifacts.business_root(spark, args.root), args.reports)
    none = spark.createDataFrame([], "file_name string, page_no int, extractor string, rows long")
    names = records.select(F.coalesce(F.col("p.file_name"), F.col("folder")).alias("file_name")).distinct()
    sinks.write_tsv(audit.result_check(names, rows, artifacts.report_pages(spark, root) if root else none), args.out, one_file=True)


def misaligned(spark: SparkSession, args: argparse.Namespace) -> None:
    sinks.write_tsv(audit.misaligned_pages(_rows(spark, args.root)[1]), args.out, one_file=True)


def empty(spark: SparkSession, args: argparse.Namespace) -> None:
    sinks.write_tsv(audit.empty_after_filter(_rows(spark, args.root)[1]), args.out, one_file=True)


def rerun(spark: SparkSession, args: argparse.Namespace) -> None:
    sinks.write_script(artifacts.page_targets(spark, *args.lists), args.out, args.run)


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    records, rows = _rows(spark, args.root)
    info = lambda field: F.coalesce(F.get_json_object("j", f"$.{field}"), F.lit(""))
    named = records.select(F.coalesce(F.col("p.file_name"), F.col("folder")).alias("file_name"), F.to_json("p.document_info").alias("j"), F.explode_outer("p.sub_projects").alias("s"))
    documents = named.select(
        "file_name", F.coalesce("s.sub_project_id", F.lit("")).alias("sub_project_id"), info("consultation_project_name").alias("consultation_project_name"), info("consultation_date").alias("consultation_time"),
        F.coalesce("s.sub_project_name", F.lit("")).alias("location"), info("renovation_content").alias("renovation_content"))
    books = excel.excel_files(audit.export_rows(documents, rows), order=("file_name", "sub_project_id"), rows_per_file=args.rows_per_file)
    files.write_files(books, args.out)


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"gridloom {args.command}").getOrCreate()
    {"extract": extract, "check": check, "misaligned": misaligned, "empty": empty, "rerun": rerun, "export": export}[args.command](spark, args)


if __name__ == "__main__":
    main()
