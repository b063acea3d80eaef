"""Replacing pages, merging repairs, re-keying and bag difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import let


def page_upsert(existing: DataFrame, current: DataFrame, pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows outside ``pages``, then the current rows inside them."""
    at = pages.select(*keys).distinct()
    return existing.join(at, list(keys), "left_anti").unionByName(current.join(at, list(keys), "left_semi"), allowMissingColumns=True)


def repair_merge(original: DataFrame, repair: DataFrame, targets: DataFrame, doc: str, page: str) -> tuple[DataFrame, DataFrame]:
    """(rows, summary): target pages replaced, and per target document its status and counts.

    A document without originals is missing_original, one without repairs missing_repair;
    a target page of a repaired document is emptied even if its repair has no rows.
    """
    at = targets.select(doc, page).distinct()
    has_repair = repair.select(doc).distinct()
    usable = at.join(has_repair, doc, "left_semi").join(original.select(doc).distinct(), doc, "left_semi")
    rows = page_upsert(original, repair, usable, [doc, page])
    count = lambda df, name: df.join(at, [doc, page], "left_semi").groupBy(doc).agg(F.count("*").alias(name))
    summary = (
        at.groupBy(doc).agg(F.count("*").alias("pages"))
        .join(original.select(doc).distinct().withColumn("_o", F.lit(True)), doc, "left")
        .join(has_repair.withColumn("_r", F.lit(True)), doc, "left")
        .join(count(original, "removed_rows"), doc, "left").join(count(repair, "inserted_rows"), doc, "left")
        .withColumn("status", F.when(F.col("_o").isNull(), "missing_original").when(F.col("_r").isNull(), "missing_repair").otherwise("ok"))
    )
    zero = lambda c: F.when(F.col("status") == "ok", F.coalesce(c, F.lit(0))).otherwise(0)
    return rows, summary.select(doc, "pages", "status", zero(F.col("removed_rows")).alias("removed_rows"), zero(F.col("inserted_rows")).alias("inserted_rows"))


def bag_difference(raw: DataFrame, kept: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """Rows of ``raw`` beyond as many of their key as ``kept`` has; the first by ``order`` are the kept ones."""
    have = kept.groupBy(*key).agg(F.count("*").alias("_have"))
    at = raw.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}")) for k in key]
    joined = at.alias("r").join(have.alias("h"), same, "left")
    return joined.where(F.col("_rank") > F.coalesce("_have", F.lit(0))).select("r.*").drop("_rank")


def rekey_merge(df: DataFrame, old: str, new: Column, collect: dict[str, Column]) -> DataFrame:
    """Groups whose cleaned ids are equal become one, with the given aggregates."""
    return df.withColumn(old, new).groupBy(old).agg(*[c.alias(name) for name, c in collect.items()])


def code_lookup(rows: DataFrame, *steps: tuple[DataFrame, Sequence[str], str, Sequence], name: str = "found") -> DataFrame:
    """The first step that knows a row gives its value.

    Each step is (table, keys, value column, order): of rows with equal keys the last by ``order`` wins.
    """
    for k, (table, keys, value, order) in enumerate(steps):
        last = table.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(f"_v{k}"))
        rows = rows.join(last, list(keys), "left")
    found = [f"_v{k}" for k in range(len(steps))]
    return rows.withColumn(name, F.coalesce(*found)).drop(*found)


def argmax_row(pairs: DataFrame, group: Sequence[str], score: Column, order: Column, least: int) -> DataFrame:
    """The best-scored pair of each group, the first of equals, if it reaches ``least``."""
    names = pairs.columns
    best = pairs.withColumn("_s", score).groupBy(*group).agg(F.max_by(F.struct(*names), F.struct(F.col("_s"), -order)).alias("_b"), F.max("_s").alias("score"))
    return best.where(F.col("score") >= least).select("_b.*", "score")


def merge_document_info(old: Column, new: Column, fields: Sequence[str]) -> Column:
    """New values where they are not blank, else the old ones."""
    return F.struct(*[F.coalesce(F.when(F.trim(new[f]) != "", new[f]), old[f]).alias(f) for f in fields])


def _outside(rows: Column, pages: Column) -> Column:
    return F.filter(F.coalesce(rows, F.array()), lambda r: F.coalesce(~F.array_contains(pages, r["page_no"]), F.lit(True)))


def _sub_key(sub: Column) -> Column:
    return F.coalesce(F.nullif(sub["sub_project_id"], F.lit("")), sub["sub_project_name"], F.lit(""))


def merge_records(existing: DataFrame, current: DataFrame, pages: DataFrame, lists: Sequence[str], sub_lists: Sequence[str], info: Sequence[str]) -> DataFrame:
    """Nested records after a partial run, one row a document.

    Of a document in both, its ``lists`` and those of its sub-projects (``sub_lists``) lose their rows of the run's ``pages`` (file_name,
    page_numbers) and get the current ones; sub-projects go by id, else name: existing ones keep their place and take the
    current name, new ones follow. ``document_info`` takes current values that are not blank, doc_id, created_at and total_pages stay. Documents of
    one side are that side's.
    """
    old, new = existing.select("file_name", F.struct(*existing.columns).alias("o")), current.select("file_name", F.struct(*existing.columns).alias("n"))
    both = old.join(new, "file_name", "full_outer").join(pages.select("file_name", F.col("page_numbers").alias("p")), "file_name", "left").withColumn("p", F.coalesce("p", F.expr("cast(array() as array<int>)")))
    o, n, p = F.col("o"), F.col("n"), F.col("p")

    def joined(s: Column) -> Column:
        c = F.get(F.filter(n["sub_projects"], lambda x: _sub_key(x) == _sub_key(s)), F.lit(0))
        out = let(c, lambda c: F.struct(*[
            (F.concat(_outside(s[f], p), F.coalesce(c[f], F.array())) if f in sub_lists else F.coalesce(F.nullif(c[f], F.lit("")), s[f]) if f in ("sub_project_name", "parent_project") else s[f]).alias(f) for f in fields]))
        return out

    fields = existing.schema["sub_projects"].dataType.elementType.fieldNames()
    fresh = F.filter(F.coalesce(n["sub_projects"], F.array()), lambda c: (_sub_key(c) != "") & ~F.exists(F.coalesce(o["sub_projects"], F.array()), lambda s: _sub_key(s) == _sub_key(c)))
    merged = {f: F.concat(_outside(o[f], p), F.coalesce(n[f], F.array())) for f in lists}
    merged |= {"sub_projects": F.concat(F.transform(F.coalesce(o["sub_projects"], F.array()), joined), fresh), "document_info": merge_document_info(o["document_info"], n["document_info"], info)}
    merged |= {f: F.coalesce(o[f], n[f]) for f in ("doc_id", "created_at", "total_pages") if f in existing.columns}
    pick = lambda f: F.when(n.isNull(), o[f]).when(o.isNull(), n[f]).otherwise(merged.get(f, n[f]))
    return both.select(*[pick(f).alias(f) for f in existing.columns])


def merge_project_rows(existing: DataFrame, current: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of one kind after a partial run: of each document the existing ones outside its run's ``pages`` (file_name, page_no), then all current ones."""
    return existing.join(pages.select("file_name", "page_no").distinct(), ["file_name", "page_no"], "left_anti").unionByName(current, allowMissingColumns=True)


def merge_sub_projects(existing: DataFrame, current: DataFrame) -> DataFrame:
    """Sub-projects (file_name, sub_project_id, sub_project_name, parent_project, ord) of both runs, by id, else name; the current names win, existing ones keep their place and new ones follow."""
    key = F.coalesce(F.when(F.col("sub_project_id") != "", F.col("sub_project_id")), F.col("sub_project_name"), F.lit("")).alias("id")
    side = lambda df, now: df.select("file_name", key, "sub_project_name", "parent_project", "ord", F.lit(now).alias("now"))
    both = side(existing, 0).unionByName(side(current, 1).where("id <> ''"))
    last = F.max_by(F.struct("sub_project_name", "parent_project"), F.struct("now", "ord"))
    merged = both.groupBy("file_name", "id").agg(last.alias("v"), F.min(F.struct("now", "ord")).alias("place"))
    at = F.row_number().over(Window.partitionBy("file_name").orderBy("place")) - 1
    return merged.select("file_name", F.col("id").alias("sub_project_id"), "v.sub_project_name", "v.parent_project", at.alias("ord"))


def rekey_sub_projects(subs: DataFrame, rows: DataFrame, cleaned: Column) -> tuple[DataFrame, DataFrame]:
    """(subs, rows) under cleaned ids: sub-projects whose ids become equal are one, and rows follow.

    ``cleaned`` makes a clean id of ``value`` (with file_name and what else ``subs`` and ``rows`` have).
    A blank cleaned id leaves the old one, or "_default". A row's own id is cleaned; where that is
    an old id of its document it goes on to that id's new one, and blank it is the sub-project's.
    ``subs`` has file_name, sub_project_id and ord; ``rows`` file_name, sub_id (the sub-project they stand in) and sub_project_id.
    """
    new = F.coalesce(F.nullif(cleaned, F.lit("")), F.nullif(F.col("value"), F.lit("")), F.lit("_default"))
    mapped = subs.withColumn("value", F.coalesce("sub_project_id", F.lit(""))).withColumn("new_id", new)
    ids = mapped.groupBy("file_name", F.col("value").alias("old_id")).agg(F.min_by("new_id", "ord").alias("new_id"))
    at = F.row_number().over(Window.partitionBy("file_name").orderBy("first")) - 1
    merged = mapped.groupBy("file_name", "new_id").agg(F.min("ord").alias("first")).select("file_name", F.col("new_id").alias("sub_project_id"), F.when(F.col("new_id") == "_default", "").otherwise(F.col("new_id")).alias("sub_project_name"), at.alias("ord"))
    home = ids.select("file_name", F.col("old_id").alias("sub_id"), F.col("new_id").alias("home"))
    own = rows.join(home, ["file_name", "sub_id"], "left").withColumn("value", F.coalesce("sub_project_id", F.lit("")))
    own = own.withColumn("own", F.coalesce(F.nullif(F.when(F.col("value") != "", cleaned), F.lit("")), F.col("home"))).drop("value")
    on = ids.select("file_name", F.col("old_id").alias("own"), F.col("new_id").alias("further"))
    followed = own.join(on, ["file_name", "own"], "left")
    target = F.when(F.col("own") == F.col("home"), F.col("home")).otherwise(F.coalesce("further", "own"))
    return merged, followed.withColumn("sub_project_id", target).select("home", *rows.columns).withColumn("sub_id", F.col("home")).drop("home")


def lift_quantities(top: DataFrame, nested: DataFrame) -> DataFrame:
    """Quantity rows of a document: its own, then those that older records keep in sub-projects, without sub-project columns."""
    bare = lambda df: df.drop("sub_project_id", "sub_project_name")
    return bare(top).unionByName(bare(nested), allowMissingColumns=True)


def merge_table_pages(rows: DataFrame, doc: str = "file_name", order: Sequence[str] = ("page_no", "pos")) -> DataFrame:
    """One table of a document's pages: blank and repeated header rows go, and row_index counts on from page to page."""
    from .. import rules
    from ..functions.text import compact, is_blank

    blank = is_blank(F.col("project_name")) & is_blank(F.col("project_code")) & is_blank(F.col("seq"))
    header = compact(F.col("project_name")).isin(*rules.HEADER_CELLS["project_name"]) | compact(F.col("project_code")).isin(*rules.HEADER_CELLS["project_code"])
    kept = rows.where(~blank & ~header)
    return kept.withColumn("row_index", F.row_number().over(Window.partitionBy(doc).orderBy(*order)))


def is_partial_run(selected: Sequence[int] | None = None, start: int | None = None, end: int | None = None, max_pages: int | None = None) -> bool:
    """Whether any page limit is set."""
    return bool(selected) or any((x or 0) > 0 for x in (start, end, max_pages))


def partial_runs(selected: Column, start: Column, end: Column, max_pages: Column) -> Column:
    """The same of columns: runs as rows."""
    some = lambda c: F.coalesce(c > 0, F.lit(False))
    return some(F.size(selected)) | some(start) | some(end) | some(max_pages)
