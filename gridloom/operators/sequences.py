"""Order-dependent and nesting helpers: chunks, histograms, aliases, bundles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import strip


def chunk_lines(lines: Column, limit: int) -> Column:
    """Greedy chunks of whole lines of at most ``limit`` characters, line ends counted; a longer line is a chunk. Blank chunks go."""
    none = F.expr("cast(array() as array<string>)")
    state = F.struct(none.alias("done"), none.alias("open"), F.lit(0).alias("size"))

    def step(acc: Column, line: Column) -> Column:
        own = F.length(line) + 1
        full = (F.size(acc["open"]) > 0) & (acc["size"] + own > limit)
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(F.array_join(acc["open"], "\n")))).otherwise(acc["done"]).alias("done"),
            F.when(full, F.array(line)).otherwise(F.concat(acc["open"], F.array(line))).alias("open"),
            F.when(full, own).otherwise(acc["size"] + own).alias("size"),
        )

    whole = F.aggregate(lines, state, step, lambda acc: F.concat(acc["done"], F.array(F.array_join(acc["open"], "\n"))))
    return F.filter(F.transform(whole, lambda c: strip(c)), lambda c: c != "")


def label_histogram(df: DataFrame, key: str, label: str) -> DataFrame:
    """Per key a map of label counts, and their sum."""
    counts = df.groupBy(key, label).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("histogram"), F.sum("n").alias("total"))


def aliased(row: Column, field: str) -> Column:
    """A field of a string map: its own key, else the first alias that is part of a key; blank else."""
    own = F.try_element_at(row, F.lit(field))
    keys = [F.get(F.filter(F.map_keys(row), _holds(a)), F.lit(0)) for a in rules.ALIASES.get(field, ())]
    return F.coalesce(own, *[F.try_element_at(row, k) for k in keys], F.lit(""))


def _holds(alias: str):
    return lambda key: F.contains(key, F.lit(alias))


def bundle(df: DataFrame, keys: Sequence[str], source: str, payload: Sequence[str]) -> DataFrame:
    """file_count and files, sorted by source, of each group."""
    entry = F.when(F.col(source).isNotNull(), F.struct(source, *payload))
    return df.groupBy(*keys).agg(F.count(source).alias("file_count"), F.array_sort(F.collect_list(entry)).alias("files"))


def block_summary(blocks: Column) -> Column:
    """Struct of block_count and table_blocks of (block_label, block_content) blocks."""
    is_table = lambda b: (b["block_label"] == "table") | F.contains(F.lower(b["block_content"]), F.lit("<table"))
    return F.struct(F.size(blocks).alias("block_count"), F.size(F.filter(blocks, is_table)).alias("table_blocks"))


def harvest_html(html: Column, blocks: Column) -> Column:
    """HTML values, then block contents that hold a table; each once, in order."""
    held = F.filter(F.transform(blocks, lambda b: b["block_content"]), lambda c: F.contains(F.lower(c), F.lit("<table")))
    return F.array_distinct(F.filter(F.concat(html, held), lambda c: c.isNotNull() & (F.trim(c) != "")))
