"""Line dedup by a deletion-neighbourhood join.

Lines (``\\n``-split) are compared by their words, lower-cased. A line is dropped if an
equal line, or one within one word edit (a word inserted, deleted or replaced), stands
earlier: in a smaller doc_id, or higher up in the same document. Lines under
``exact_words`` words always stay; edits count from ``near_words`` words on (2 at least;
8, where one edit leaves 7/8 of the words, by default).

Equal lines meet by two 64-bit hashes, so only first occurrences go on. Two lines within
one edit share their first or their last words (the edit cannot touch both ends), and all
words outside one quarter of the line; lines that share neither with another line drop out
in these two steps, which are exact. The others emit the deletion neighbourhood: the line,
and the line without each one word, as hashed keys (a sequence's hash is the exclusive or
of its words' hashes with their places, so leaving out a word takes two running sums;
these are built by blocks, in n ** 1.5 steps for a line of n words). Lines that lack the
same place's word and are otherwise equal differ by a replacement; a line equal to another
without a word differs by an insertion. Each key keeps its earliest line only, so that no
pairs within a group arise, and the edit distance of each (line, earlier line) is verified
on the words.

A row is known by its doc_id and a digest of its text. Rows that share a doc_id but not
their text are ordered by that digest and lose only their own lines; rows that repeat both
count as one place, and all of them keep or lose a line alike. Nulls: a null text has one
empty line and stays null; a null id sorts first. An empty table gives an empty result.
Extra columns of any name are passed on by ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, packed, running, stored, unpacked

LINE, ROW = ["lh", "l2"], ["doc_id", "dk"]


def line_words(line: Column) -> Column:
    """Lower-cased words; lines whose only white space are spaces, nearly all, are split without a pattern."""
    low = F.lower(line)
    return F.array_remove(F.when(line.rlike(r"[\x09-\x0D]"), F.split(low, SPACE)).otherwise(F.split(low, " ")), "")


def text_key(text: Column) -> Column:
    """60 bits of the text's MD5; they tell rows of the same doc_id apart."""
    return F.conv(F.substring(F.md5(F.coalesce(text.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _line_hashes(ws: Column) -> list[Column]:
    return [F.xxhash64(ws).alias("lh"), F.xxhash64(F.lit("line"), ws).alias("l2")]


def _ends(ws: str, n: Column, near_words: int) -> Column:
    """Hashed heads and tails; a length class's ends are at most half of its shortest line, and both classes meet at a boundary."""
    def pair(q: int) -> list[Column]:
        return [F.xxhash64(F.lit(f"head{q}"), F.slice(ws, 1, q)), F.xxhash64(F.lit(f"tail{q}"), F.slice(ws, F.greatest(n - (q - 1), F.lit(1)), F.lit(q)))]

    none = F.expr("cast(array() as array<bigint>)")
    classes = [(q, top) for q, top in ((1, 4), (2, 8), (4, 16), (8, 32), (16, 1 << 30)) if top > near_words]
    return F.concat(*[F.when(n.between(2 * q, top), F.array(*pair(q))).otherwise(none) for q, top in classes])


def _lines(docs: DataFrame, near_words: int) -> DataFrame:
    lines = docs.select(*ROW, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    # words as a generated column: a filter on their number does not split the lines once more
    lines = lines.select(*ROW, "pos", F.explode_outer(F.array(line_words(F.col("line")))).alias("ws")).withColumn("n", F.size("ws"))
    return lines.select(*ROW, "pos", "n", *_line_hashes(F.col("ws")), F.when(F.col("n") >= near_words, _ends("ws", F.col("n"), near_words)).alias("ends"))


def _quarters(hs: str) -> Column:
    """Hashes of a line's words outside each quarter; counted from both ends, and for the length of a line with one word less too."""
    n = F.size(hs)
    keys = []
    for m in (n, n - 1):
        for j in range(4):
            before, after = F.floor(m * j / 4).cast("int"), (m - F.floor(m * (j + 1) / 4)).cast("int")
            keys.append(F.xxhash64(m, F.lit(j), F.slice(hs, F.lit(1), before), F.slice(hs, n - after + 1, after)))
    return F.array(*keys)


def _placed(hs: str, shift: int) -> Column:
    return F.transform(hs, lambda h, i: F.xxhash64(h, i - shift))


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _neighbourhood(hashed: DataFrame) -> DataFrame:
    """(line, held, cut) for each word of a line (line, hs): the line without it, its place held open or closed."""
    df = hashed.withColumns({"_a": _placed("hs", 0), "_b": _placed("hs", 1)}).withColumns({"_x": _xor(F.col("_a")), "_y": _xor(F.col("_b"))})
    df = df.withColumn("_ab", F.zip_with("_a", "_b", lambda a, b: a.bitwiseXOR(b))).withColumn("_d", running(F.col("_ab"), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x)))
    n = F.size("hs")
    keys = F.transform("_a", lambda a, i: F.struct(
        F.xxhash64(n, i, F.col("_x").bitwiseXOR(a)).alias("held"),
        F.xxhash64(n - 1, F.col("_y").bitwiseXOR(F.get(F.col("_d"), i)).bitwiseXOR(F.get(F.col("_b"), i))).alias("cut")))
    return df.select("line", F.explode(keys).alias("v")).select("line", "v.held", "v.cut")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are one edit apart."""
    short, long = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    unlike = F.zip_with(short, long, lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(unlike, True).cast("int")  # 1-based place of the first difference
    gap = F.size(long) - F.size(short)
    rest = F.slice(long, at + 1, F.size(long)) == F.when(gap == 0, F.slice(short, at + 1, F.size(long))).otherwise(F.slice(short, at, F.size(long)))
    return F.when(gap > 1, False).otherwise((at > 0) & rest)


def _of_several(ends: DataFrame) -> DataFrame:
    """The ends that two lines or more have; plain numbers are aggregated by hash, structs would be sorted."""
    extremes = [f(c).alias(f"{c}_{k}") for c in LINE for k, f in ((0, F.min), (1, F.max))]
    return ends.groupBy("end").agg(*extremes).where("lh_0 != lh_1 OR l2_0 != l2_1").select("end")


def later_lines(docs: DataFrame, exact_words: int = 3, near_words: int = 8) -> DataFrame:
    """(doc_id, dk, removed): for each row that loses lines, their sorted positions; dk is the row's ``text_key``."""
    if near_words < 2:
        raise ValueError("near_words is 2 at least: any two lines of one word are one edit apart")
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("dk", text_key(F.col("text")))
    lines = stored(_lines(docs, near_words).where(F.col("n") >= exact_words), "line-all")
    place = F.struct(*ROW, "pos")
    firsts = stored(lines.groupBy(*LINE).agg(F.min(place).alias("first"), F.first("ends").alias("ends"), F.count("*").alias("c")), "line-firsts")
    ends = firsts.where("ends is not null").select(*LINE, "first", F.explode("ends").alias("end"))
    shared = _of_several(ends)
    close = stored(ends.join(shared, "end").select(*LINE, "first").distinct(), "line-close")

    # the words of the lines that may have a neighbour
    wanted = close.groupBy(F.col("first.doc_id").alias("_id"), F.col("first.dk").alias("_dk")).agg(F.collect_set(F.struct("first.pos", *LINE)).alias("at"))
    text = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("dk") == F.col("_dk")))
    cut = text.withColumn("all", F.split("text", "\n", -1)).select(*ROW, F.explode(F.transform("at", lambda p: F.struct(p["pos"].alias("pos"), p["lh"].alias("lh"), p["l2"].alias("l2"), F.get(F.col("all"), p["pos"]).alias("line")))).alias("x"))
    spelt = stored(cut.select(*ROW, "x.pos", "x.lh", "x.l2", line_words(F.col("x.line")).alias("ws")).dropDuplicates(LINE), "line-words")
    quarters = spelt.select(*LINE, F.transform("ws", lambda w: F.xxhash64(w)).alias("hs"))
    # the array first: within the generator its long code would not be compiled
    quarters = stored(quarters.select(*LINE, _quarters("hs").alias("ends")).select(*LINE, F.explode_outer("ends").alias("end")), "line-quarters")
    near_by = stored(quarters.join(_of_several(quarters), "end").select(*LINE).distinct(), "line-agree")
    # numbers that rise with the place stand for the lines from here on: plain numbers are aggregated by hash
    ranked = spelt.join(near_by, LINE, "left_semi").orderBy(*ROW, "pos").select(F.monotonically_increasing_id().alias("line"), *LINE, "ws")
    words = stored(ranked, "line-near")
    hashed = words.select("line", F.transform("ws", lambda w: F.xxhash64(w)).alias("hs"))
    variants = stored(_neighbourhood(hashed), "line-variants")
    earliest = variants.groupBy("held").agg(F.min("line").alias("keeper"), F.count("*").alias("c")).where("c > 1").select("held", "keeper")
    replaced = variants.join(earliest, "held").where("line > keeper").select("line", "keeper")
    whole = hashed.select(F.col("line").alias("self"), F.xxhash64(F.size("hs"), _xor(_placed("hs", 0))).alias("cut"))
    inserted = variants.join(whole, "cut").select(F.greatest("line", "self").alias("line"), F.least("line", "self").alias("keeper"))
    pairs = replaced.unionByName(inserted).distinct()
    near = (
        pairs.join(words.withColumnRenamed("ws", "mine"), "line")
        .join(words.select(F.col("line").alias("keeper"), F.col("ws").alias("theirs")), "keeper")
        .where(_one_edit(F.col("mine"), F.col("theirs"))).select(*LINE).distinct().withColumn("near", F.lit(True))
    )
    marks = firsts.where("c > 1").select(*LINE, "first").join(near, LINE, "full_outer").select(*LINE, "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.select(*ROW, "pos", *LINE).join(stored(marks, "line-marks"), LINE).where(F.col("near") | (place != F.col("first")))
    return gone.groupBy(*ROW).agg(F.array_sort(F.collect_set("pos")).alias("removed"))


def with_removed(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Adds removed, an array of positions, to rows that have doc_id and dk."""
    gone = stored(gone, "line-gone").select(F.col("doc_id").alias("_id"), F.col("dk").alias("_dk"), "removed")
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("dk") == F.col("_dk")), "left").drop("_id", "_dk")
    return joined.withColumn("removed", F.coalesce("removed", F.expr("cast(array() as array<int>)")))


def mark_lines(docs: DataFrame, exact_words: int = 3, near_words: int = 8) -> DataFrame:
    """doc_id, n_lines and removed, the positions of the lines that stand earlier elsewhere, of every row."""
    n_lines = F.size(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)).cast("long")
    rows = docs.select("doc_id", n_lines.alias("n_lines"), text_key(F.col("text")).alias("dk"))
    return with_removed(rows, later_lines(docs, exact_words, near_words)).drop("dk")


def dedup_lines(docs: DataFrame, exact_words: int = 3, near_words: int = 8) -> DataFrame:
    """``docs`` without those lines.

    A document that loses lines and has no line of ``exact_words`` words left goes.
    """
    rows = packed(docs, doc_id=F.col("doc_id"), dk=text_key(F.col("text")))
    marked = with_removed(rows, later_lines(docs, exact_words, near_words)).withColumn("all", F.split(F.col("row.text").cast("string"), "\n", -1))
    # between two removed positions the lines stay: join the slices, which is linear in the lines
    bounds = F.concat(F.array(F.lit(-1)), F.col("removed"), F.array(F.size("all")))
    kept = F.flatten(F.transform(F.slice(bounds, 1, F.size("removed") + 1), lambda p, i: F.slice("all", p + 2, F.get(bounds, i + 1) - p - 1)))
    left = marked.withColumn("kept", F.when(F.size("removed") > 0, kept))
    whole = F.size("removed") == 0
    some = F.exists("kept", lambda x: F.size(line_words(x)) >= exact_words)
    return unpacked(left.where(whole | some), docs, text=F.when(whole, F.col("row.text")).otherwise(F.array_join("kept", "\n")))
