"""Quality rules by distribution divergence.

Each document's character-class histogram and common-word histogram are compared with
those of its language, by Jensen-Shannon distance (base 2, so 0 to 1). The common words
are the language's ``TOP`` most frequent ones over all its documents (runs of letters,
lower-cased); the language's histograms are the summed counts of its trusted documents
(quality 1, not toxic) that pass the base rules, or of all that pass them where none is
trusted. Sums of whole numbers make the references the same on every run. Documents too
short for a stable histogram are not judged by that distance. Base rules: too few words,
or too large a share of words in 3-word windows that the text repeats.

Nulls: a null text has no words; a null language is a language of its own. A distance at
its threshold is kept; a language none of whose documents passes the base rules is not
judged by distance. Equally frequent words are ordered by themselves. Very long texts are
read whole. Every row gives
one row; repeated rows count as often as they stand there; an empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, words

#: Common words of a language.
TOP = 12
#: Parts that each language's words are ranked in first, so that no task ranks all of them.
PARTS = 64
#: What each class removes from a text; a character is in the first class that has it.
CLASSES = ((r"\p{Ll}+", "lower"), (r"[\x20\x09-\x0D]+", "space"), (r"\p{Lu}+", "upper"), (r"[.,;:!?'\"()-]+", "stop"), (r"[0-9]+", "digit"))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _read(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def letter_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def common_words(docs: DataFrame) -> DataFrame:
    """(lang, common): the most frequent words of each language, by frequency, then by themselves."""
    counts = _read(docs).select("lang", F.explode(letter_words(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("c"))
    order = [F.desc("c"), F.asc("word")]
    parted = counts.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(PARTS)))
    some = parted.withColumn("k", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("k") <= TOP)
    best = some.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("k") <= TOP)
    return best.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "word"))).alias("common")).select("lang", F.col("common.word").alias("common"))


def base_features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text and the five base numbers."""
    ws = docs.withColumn("ws", words(F.col("text")))
    hashes = F.transform(F.slice("ws", 1, F.greatest(F.size("ws") - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(F.col("ws"), i + 1), F.get(F.col("ws"), i + 2)))
    ws = ws.withColumn("_h", hashes)
    places = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ws = ws.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), places))
    same = lambda x, k: (F.get(F.col("_s"), k)["h"] == x["h"]) & (k >= 0)
    twice = F.filter("_s", lambda x, k: F.coalesce((k > 0) & same(x, F.greatest(k - 1, F.lit(0))), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False)))
    ws = ws.withColumn("_p", F.array_sort(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("_p"), k + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return ws.withColumn("_l", lines).select(
        *docs.columns,
        F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def features(docs: DataFrame, min_words: int = 50, max_repeat_share: float = 0.5) -> DataFrame:
    """Base numbers, base_failed, and each document's two histograms as counts, the rest last."""
    common = stored(common_words(docs), "quality-common").withColumnRenamed("lang", "_lang")
    base = base_features(_read(docs).join(common, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang"))
    left = F.col("text")
    for k, (pattern, _) in enumerate(CLASSES):
        base = base.withColumn("_rest", F.regexp_replace(left, pattern, ""))
        base = base.withColumn(f"_c{k}", (F.length(left) - F.length("_rest")).cast("long")).withColumn("_left", F.col("_rest"))
        left = F.col("_left")
    chars = F.array(*[F.col(f"_c{k}") for k in range(len(CLASSES))], F.length("_left").cast("long"))
    base = base.withColumn("_lw", letter_words(F.col("text"))).withColumn("_found", F.filter("_lw", lambda w: F.array_contains(F.col("common"), w)))
    tally = F.concat(F.transform("common", lambda c: F.size(F.filter("_found", lambda w: w == c)).cast("long")), F.array((F.size("_lw") - F.size("_found")).cast("long")))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 100 * max_repeat_share * F.col("n_words"))
    return base.select("doc_id", "lang", *BASE, failed.alias("base_failed"), chars.alias("chars"), tally.alias("tally"))


def references(seen: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(_lang, _chars, _tally): the summed histograms of each language's reference documents."""
    passing = seen.where(~F.col("base_failed"))
    if labels is not None:
        good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id").distinct().withColumn("good", F.lit(1))
        passing = passing.join(good, "doc_id", "left")
    else:
        passing = passing.withColumn("good", F.lit(None).cast("int"))
    sums = lambda c, n: F.array(*[F.sum(F.get(F.col(c), F.lit(k))) for k in range(n)])
    each = passing.groupBy("lang", F.coalesce("good", F.lit(0)).alias("good")).agg(sums("chars", len(CLASSES) + 1).alias("chars"), sums("tally", TOP + 1).alias("tally"))
    whole = lambda c: F.filter(c, lambda x: x.isNotNull())  # noqa: E731 (a language of few words has fewer common ones)
    best = each.groupBy("lang").agg(F.max_by(F.struct("chars", "tally"), "good").alias("best"))
    return best.select(F.col("lang").alias("_lang"), F.col("best.chars").alias("_chars"), whole(F.col("best.tally")).alias("_tally"))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares; null if either is null."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.when(terms.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2)))


def judge(docs: DataFrame, labels: DataFrame | None = None, min_words: int = 50, max_repeat_share: float = 0.5, max_char_distance: float = 0.2, max_word_distance: float = 0.24, char_guard: int = 200, word_guard: int = 100) -> DataFrame:
    """doc_id, lang, the base numbers, base_failed, both distances and kept. ``char_guard`` is in characters of words, ``word_guard`` in words."""
    seen = stored(features(docs, min_words, max_repeat_share), "quality-features")
    joined = seen.join(stored(references(seen, labels), "quality-norms"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    judged = joined.withColumns({"char_distance": _distance(_shares(F.col("chars")), _shares(F.col("_chars"))), "word_distance": _distance(_shares(F.col("tally")), _shares(F.col("_tally")))})
    beyond = lambda c, most, size, guard: (F.col(size) >= guard) & (F.coalesce(F.col(c), F.lit(0.0)) > most)
    far = beyond("char_distance", max_char_distance, "word_chars", char_guard) | beyond("word_distance", max_word_distance, "n_words", word_guard)
    return judged.select("doc_id", "lang", *BASE, "base_failed", "char_distance", "word_distance", (~F.col("base_failed") & ~far).alias("kept"))
