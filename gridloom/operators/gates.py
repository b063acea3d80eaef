"""Page gates: which pages go on to the costly recognition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import gate_compact, let, strip

NUMERIC_CELL = r"\A[￥¥]?\s*[-+]?[0-9][0-9,]*(?:\.[0-9]+)?%?\z"
BUCKET_X, BUCKET_Y = 90, 32


def _all(text: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(text, F.lit(p)) for p in parts])


def pattern_hits(compact: Column, patterns: Sequence[tuple[str, Sequence[str]]], squeeze: bool = True) -> Column:
    """Sorted distinct names of the patterns of which all parts occur."""
    part = lambda p: "".join(ch for ch in p.replace("（", "").replace("）", "") if not ch.isspace()) if squeeze else p
    found = [F.when(_all(compact, [part(p) for p in parts]), F.lit(name)) for name, parts in patterns]
    return F.array_sort(F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull())))


def target_decision(text: Column, skip=None, titles=None, structures=None) -> Column:
    """Struct (should_run, policy, reason, whitelist_hits, structure_hits, blacklist_hits): skip titles beat target titles beat column structures."""
    skip = [(t, (t,)) for t in rules.SKIP_TITLES] + list(rules.SKIP_PATTERNS) if skip is None else skip
    titles = [(t, (t,)) for t in rules.TARGET_TITLES] + list(rules.TARGET_PATTERNS) if titles is None else titles
    structures = rules.STRUCTURES if structures is None else structures
    hits = lambda t: F.struct(*[pattern_hits(t, p).alias(name) for name, p in (("black", skip), ("white", titles), ("shape", structures))])
    return let(let(gate_compact(text), hits), _decision)


def _decision(hits: Column) -> Column:
    black, white, shape = (hits[k] for k in ("black", "white", "shape"))
    named = lambda label, found: F.concat(F.lit(f"{label}="), F.array_join(found, ","))
    policy = F.when(F.size(black) > 0, "blacklist").when(F.size(white) > 0, "whitelist").when(F.size(shape) > 0, "structure")
    full = F.when(policy == "blacklist", "skip_blacklist_priority").when(policy == "whitelist", "whitelist_priority").when(policy == "structure", "target_structure_priority").otherwise("skip_non_target_table")
    reason = F.when(policy == "blacklist", named("blacklist_hits", black)).when(policy == "whitelist", named("whitelist_hits", white)).when(policy == "structure", named("structure_hits", shape)).otherwise("no_target_table_header")
    return F.struct(F.coalesce(policy != "blacklist", F.lit(False)).alias("should_run"), full.alias("policy"), reason.alias("reason"), white.alias("whitelist_hits"), shape.alias("structure_hits"), black.alias("blacklist_hits"))


def table_score(texts: Column, n_items: Column, x_buckets: Column, y_buckets: Column, keywords: Sequence[str], strong: Sequence[str], strong_columns: Sequence[str] = rules.STRONG_COLUMNS, structures=None) -> Column:
    """Struct with is_table_like, score and its parts, from trimmed non-blank item texts and layout buckets."""
    structures = rules.STRUCTURES if structures is None else structures
    hit = lambda text, names: F.size(pattern_hits(text, [(k, (k,)) for k in names], squeeze=False))
    shaped = lambda text: F.size(pattern_hits(text, structures)) > 0

    def seen(text: Column) -> Column:
        column = reduce(lambda a, b: a | b, [F.contains(text, F.lit(k)) for k in strong_columns])
        return F.struct(hit(text, keywords).alias("key"), hit(text, strong).alias("strong"), let(gate_compact(text), shaped).alias("shaped"), column.alias("column"))

    def counted(ts: Column) -> Column:
        numeric = F.size(F.filter(ts, lambda t: F.replace(t, F.lit(" "), F.lit("")).rlike(NUMERIC_CELL)))
        short = F.size(F.filter(ts, lambda t: F.length(t) <= 8))
        return F.struct(let(F.array_join(ts, "\n"), seen).alias("has"), numeric.alias("numeric"), short.alias("short"), F.size(ts).alias("n"))

    def judged(x: Column) -> Column:
        has, numeric, short = x["has"], x["numeric"], x["short"]
        ratio = F.when(x["n"] > 0, short / x["n"]).otherwise(0.0)
        score = (
            F.when(has["key"] >= 2, 3).when(has["key"] == 1, 1).otherwise(0) + F.when(numeric >= 8, 2).when(numeric >= 4, 1).otherwise(0)
            + F.when((n_items >= 25) & (x_buckets >= 4) & (y_buckets >= 6), 2).when((n_items >= 15) & (x_buckets >= 3) & (y_buckets >= 4), 1).otherwise(0)
            + F.when(has["column"], 2).otherwise(0) + F.when(has["shaped"], 3).otherwise(0)
        )
        dense = (short >= 12) & (ratio >= 0.5)
        like = (has["shaped"] & (n_items >= 8)) | ((has["strong"] > 0) & dense) | ((numeric >= 6) & dense) | ((score >= 7) & (ratio >= 0.45))
        return F.struct(like.alias("is_table_like"), score.alias("score"), numeric.alias("numeric_count"), short.alias("short_text_count"), F.round(ratio, 4).alias("short_text_ratio"))

    return let(let(texts, counted), judged)


def buckets(centres: Column, size: int) -> Column:
    """How many distinct buckets of ``size`` the positions fall into."""
    return F.size(F.array_distinct(F.transform(centres, lambda v: F.floor(v / size))))


def item_texts(items: Column) -> Column:
    return F.filter(F.transform(items, lambda i: strip(i["text"])), lambda t: t != "")


def gate(is_table: Column, is_target: Column, failed: Column) -> Column:
    """Both gates must agree; a failed gate lets the page through."""
    return F.when(failed, True).otherwise(F.coalesce(is_table, F.lit(True)) & F.coalesce(is_target, F.lit(True)))


def document_summary(pages: DataFrame) -> DataFrame:
    """Per document, and over all (is_total 1): pages, those of the target, those sent on, failed ones with processed, and the page lists.

    ``pages`` has file_name, page_no, target, vl and error (null without one).
    """
    listed = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("page_no"))))
    total = F.grouping("file_name")
    rows = pages.rollup("file_name").agg(
        F.count("*").alias("pages"), F.count_if("target").alias("target_pages"), F.count_if("vl").alias("vl_pages"), F.count_if(F.col("error").isNotNull()).alias("failed_pages"), total.cast("int").alias("is_total"))
    lists = pages.groupBy("file_name").agg(listed(F.col("target")).alias("target_page_list"), listed(F.col("vl")).alias("vl_page_list"))
    return rows.join(lists, "file_name", "left").withColumn("processed", F.col("failed_pages") == 0)
