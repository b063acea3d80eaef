"""Scalar functions on text columns. Null counts as blank unless stated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that stand for digits.
CJK_DIGITS, ASCII_DIGITS = "〇零○Oo一二两三四五六七八九", "000001223456789"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


#: Every white space character, the ideographic space included.
WHITE = "".join(chr(c) for c in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def strip(c: Column) -> Column:
    """Trims every kind of white space."""
    return F.btrim(_text(c), F.lit(WHITE))


def compact(c: Column) -> Column:
    return F.regexp_replace(_text(c), r"(?U)\s+", "")


def gate_compact(c: Column) -> Column:
    """Without white space and the punctuation that recognition tends to lose."""
    return F.regexp_replace(F.translate(_text(c), "（）", "()"), r"(?U)[\s:：,，、.。;；\-—_/\\|()\[\]【】]+", "")


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def clean_amount(c: Column, keep_sign: bool = False) -> Column:
    """Digits and dots; ``keep_sign`` also keeps a leading minus."""
    bare = F.regexp_replace(_text(c), "[^0-9.]", "")
    return F.when(strip(c).rlike(r"\A[￥¥]?\s*-") & (bare != ""), F.concat(F.lit("-"), bare)).otherwise(bare) if keep_sign else bare


def is_amount(c: Column) -> Column:
    """A number, whatever currency signs, commas and white space stand among its digits."""
    return _text(c).rlike(r"(?U)\A[￥¥,\s]*+(?:\d[￥¥,\s]*+)++(?:\.[￥¥,\s]*+(?:\d[￥¥,\s]*+)++)?\z")


def is_valid_seq(c: Column) -> Column:
    return _text(c).rlike(r"(?U)\A\s*+\d++(?:\.\d++)?\s*+\z")


def is_project_code(c: Column) -> Column:
    return _text(c).rlike(r"(?U)\A\s*+\d{9,15}\s*+\z")


def normalize_unit(c: Column) -> Column:
    return compact(F.regexp_replace(strip(c), r"(?U)\$\s*m\^\{?2\}?\s*\$", "m2"))


def top_level_seq(c: Column) -> Column:
    """A leading 1 to 7 that no dot or digit follows; blank else."""
    return F.regexp_extract(strip(c), r"\A([1-7])(?![.．0-9])", 1)


def split_amount(c: Column, keep_sign: bool = False) -> tuple[Column, Column]:
    """The first number, and the trimmed text without it, of a text without its commas; blank and the text as it was where it has no number.

    A minus before the number stays in the rest; ``keep_sign`` makes it part of the number.
    """
    number = r"-?[0-9]+\.?[0-9]*" if keep_sign else r"[0-9]+\.?[0-9]*"

    def parts(t: Column) -> Column:
        plain = F.replace(t, F.lit(","), F.lit(""))
        rest = strip(F.regexp_replace(plain, rf"(?s)\A(.*?)(?:{number})(.*)\z", "$1$2"))
        return let(F.regexp_extract(plain, number, 0), lambda n: F.struct(n.alias("amount"), F.when(n == "", t).otherwise(rest).alias("rest")))

    found = let(strip(c), parts)
    return found["amount"], found["rest"]


def chinese_int(c: Column) -> Column:
    """A number in Arabic digits, or in Chinese ones up to 99 or digit by digit; null else."""
    digit = lambda d, blank: F.when(d == "", blank).otherwise(d.try_cast("int"))

    def mixed(plain: Column) -> Column:
        ten = F.instr(plain, "十")
        tens, ones = F.left(plain, ten - 1), F.substring(plain, ten + 1, F.length(plain))
        return F.when(plain.rlike(r"\A[0-9]?十[0-9]?\z"), digit(tens, F.lit(1)) * 10 + digit(ones, F.lit(0))).when(plain.rlike(r"\A十.\z"), 10)

    def parsed(t: Column) -> Column:
        spelt = let(F.translate(t, CJK_DIGITS, ASCII_DIGITS), lambda plain: F.coalesce(F.when(plain.rlike(r"\A[0-9]+\z"), plain.try_cast("int")), mixed(plain)))
        return F.when(t.rlike(r"\A[0-9]+\z"), t.try_cast("int")).when(~t.rlike("[0-9]"), spelt)

    return let(compact(c), parsed)


def date_iso(c: Column) -> Column:
    """The first date of the years 1900 to 2099 in Arabic digits, else the first in Chinese numerals, as YYYY-MM-DD; blank without one."""
    digit = f"[{CJK_DIGITS.replace('两', '')}]"
    arabic, chinese = r"((?:19|20)[0-9]{2})[年./-]([0-9]{1,2})[月./-]([0-9]{1,2})", f"({digit}{{4}})年([十{CJK_DIGITS}]{{1,3}})月([十{CJK_DIGITS}]{{1,3}})日"
    #: the parts of the first match as an array of three, null without one
    parts = lambda t, pattern: F.split(F.regexp_replace(F.regexp_substr(t, F.lit(pattern)), pattern, "$1 $2 $3"), " ")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    plain = lambda p: F.concat_ws("-", p[0], two(p[1]), two(p[2]))

    def spelt(p: Column) -> Column:
        number = F.struct(chinese_int(p[1]).alias("m"), chinese_int(p[2]).alias("d"))
        return let(number, lambda n: F.when((n["m"] > 0) & (n["d"] > 0), F.concat_ws("-", F.translate(p[0], CJK_DIGITS, ASCII_DIGITS), two(n["m"]), two(n["d"]))).otherwise(""))

    found = lambda t, pattern, shown: let(parts(t, pattern), lambda p: F.when(p.isNotNull(), shown(p)))
    return let(compact(c), lambda t: F.coalesce(found(t, arabic, plain), found(t, chinese, spelt), F.lit("")))


def collapse_phrase(c: Column, strict: bool = False) -> Column:
    """A text that is one phrase repeated becomes that phrase; ``strict`` leaves plain numbers alone."""
    once = F.regexp_replace(_text(c), r"(?s)\A(.+?)\1+\z", "$1")
    return F.when(_text(c).rlike(r"\A[0-9]+\z"), _text(c)).otherwise(once) if strict else once


def page_number(path: Column) -> Column:
    """The number in page_NNN or page-NNN; null without one."""
    return F.regexp_extract(path, r"page[_-](\d+)", 1).try_cast("int")


def page_name(no: Column) -> Column:
    return F.format_string("page_%03d", no)


def page_suffix(pages: Column) -> Column:
    """page_007, pages_001_009 or pages_none of an array of page numbers."""
    low, high = F.array_min(pages), F.array_max(pages)
    return F.when(F.size(pages) <= 0, "pages_none").when(low == high, page_name(low)).otherwise(F.format_string("pages_%03d_%03d", low, high))


def preview(*cols: Column) -> Column:
    """Trimmed values joined by bars, without bars at the ends."""
    return F.regexp_replace(F.concat_ws(" | ", *[strip(c) for c in cols]), r"\A[ |]+|[ |]+\z", "")


def first_text(*cols: Column) -> Column:
    """The first that is not blank; blank else."""
    return F.coalesce(*[F.when(~is_blank(c), c) for c in cols], F.lit(""))


def json_cell(c: Column) -> Column:
    return F.when(F.size(c) > 0, F.to_json(c)).otherwise("")


def row_key(row: Column, fields: list[str]) -> Column:
    """Equal for rows whose fields are equal once the unit is normalised: JSON with sorted keys."""
    value = lambda f: normalize_unit(row[f]) if f == "unit" else row[f]
    return F.to_json(F.struct(*[value(f).alias(f) for f in sorted(fields)]), {"ignoreNullFields": "false"})


def issue_label(code: Column, labels: dict[str, str]) -> Column:
    """The label of an issue; an error's code carries its message after a colon, and so does the label."""
    known = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    kind, message = F.regexp_extract(code, r"(?s)\A(json_error|report_error):(.*)\z", 1), F.regexp_extract(code, r"(?s)\A(json_error|report_error):(.*)\z", 2)
    return F.when(kind != "", F.concat(F.try_element_at(known, kind), F.lit(":"), message)).otherwise(F.coalesce(F.try_element_at(known, code), code))
