"""Rule backend: typed rows from grids, by rule tables; replies of a model backend.

``extract`` runs one Arrow-batched function per table type. A rule names its header
alternatives, its columns with their words, and what is particular to the type.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules

Grid = list[list[str]]
Row = dict[str, str]
#: Tables of a batch that are Python objects at a time.
SLICE = 256


def squeeze(text: str) -> str:
    return "".join((text or "").split())


def header_row(grid: Grid, alternatives: Sequence[Sequence[str]]) -> int:
    """The first row that has all words of an alternative, alone, with the next one, or (the first four) with the next two; -1 without one."""
    text = [squeeze("".join(r)) for r in grid]
    spans = (lambda: text, lambda: [text[i] + text[i + 1] for i in range(len(text) - 1)], lambda: ["".join(text[i : i + 3]) for i in range(min(4, len(text) - 2))])
    for words in alternatives:
        for candidates in spans:
            for i, t in enumerate(candidates()):
                if all([w in t for w in words]):
                    return i
    return -1


def column_map(cells: Sequence[str], columns: Sequence[tuple[str, Sequence[str]]], share: bool) -> dict[str, int]:
    """Each column takes the free position with most of its words, the leftmost of equals; with ``share`` those left over may take a used one."""
    text = [squeeze(c) for c in cells]
    whole = "\0".join(text)
    known = [w for w in _words(tuple(columns)) if w in whole]  # most columns have no word in most headers
    return dict(_mapped(tuple([tuple([w for w in known if w in t]) for t in text]), tuple(columns), share))


@lru_cache(64)
def _words(columns: tuple[tuple[str, tuple[str, ...]], ...]) -> list[str]:
    return list(dict.fromkeys(w for _, words in columns for w in words))


@lru_cache(4096)
def _mapped(held: tuple[tuple[str, ...], ...], columns: tuple[tuple[str, tuple[str, ...]], ...], share: bool) -> dict[str, int]:
    """``column_map`` by the words that each position holds; tables of one layout hold the same."""
    found: dict[str, int] = {}

    def best(words: Sequence[str], barred: set[int]) -> int:
        score = [-1 if i in barred else sum([w in t for w in words]) for i, t in enumerate(held)]
        top = max(score, default=0)
        return score.index(top) if top > 0 else -1

    for again in (False, True) if share else (False,):
        for name, words in columns:
            if name not in found and (at := best(words, set() if again else set(found.values()))) >= 0:
                found[name] = at
    return found


@dataclass(frozen=True)
class TableRule:
    headers: Sequence[Sequence[str]]
    columns: Sequence[tuple[str, Sequence[str]]]
    merged: bool = False  # map columns on the first five rows together
    finish: Callable[[Row, list[str], dict[str, int]], Row | None] = lambda row, cells, at: row
    refine: Callable[[Grid, int, dict[str, int]], int] = lambda grid, head, at: head


def _neighbour(cells: list[str], at: int | None, reach: int = 2) -> str:
    places = [at + side * k for k in range(1, reach + 1) for side in (1, -1)] if at is not None else []
    return next((cells[p] for p in places if 0 <= p < len(cells) and cells[p]), "")


def _top_seq(text: str) -> str:
    m = re.match(r"([1-7])(?![.\d])", text.strip())
    return m[1] if m else ""


def split_amount(text: str) -> tuple[str, str]:
    """The first number of a text without commas, and the text without it (``functions.text.split_amount`` for the cells of a row)."""
    plain = text.replace(",", "")
    number = re.search(r"[0-9]+\.?[0-9]*", plain)
    return (number[0], (plain[: number.start()] + plain[number.end() :]).strip()) if number else ("", text.strip())


def _unit_fee(row: Row, cells: list[str], at: dict[str, int]) -> Row | None:
    filled = [c for c in cells if c]
    top = _top_seq(row["seq"] or filled[0])
    if not top:
        return None
    merged = re.fullmatch(r"[1-7](?:\s*其中)?\s*(.+)", row["seq"]) if not row["fee_name"] else None
    name = row["fee_name"] or (merged[1].strip() if merged else "") or (filled[1] if len(filled) > 1 else "")
    number, rest = split_amount(row["amount"])
    return row | {"seq": _top_seq(row["seq"]), "fee_name": name, "amount": number or row["amount"], "remark": " ".join(x for x in (row["remark"], rest) if x)}


def _sub_item(row: Row, cells: list[str], at: dict[str, int]) -> Row | None:
    first = next(c for c in cells if c)
    return row if row["seq"] or re.match(r"\d", first) else None


def _late_columns(grid: Grid, head: int, at: dict[str, int]) -> int:
    """Price and labour columns of split headers, and a code column told by its values."""
    if not at.keys() & {"unit_price", "total_price"}:
        top = [[squeeze(c) for c in r] for r in grid[:5]]
        for cells in top:
            for pos, c in enumerate(cells):
                if "综合单价" in "".join(cells):
                    name = "unit_price" if "综合" in c and "单价" in c else "total_price" if "合价" in c else None
                    at.setdefault(name, pos) if name else None
                if "人工费" in "".join(cells):
                    name = "labor_cost" if "人工费" in c else "machinery_cost" if "机械费" in c else "provisional_estimate" if "暂估" in c else None
                    at.setdefault(name, pos) if name else None
    for cells in grid[head + 1 : head + 4]:
        if "project_code" in at:
            break
        codes = [p for p, c in enumerate(cells) if re.match(r"\d{2,}-\d+-\d+$|\d{9,}", squeeze(c))]
        if codes and len(cells) > 1:
            at["project_code"] = codes[0]
            if codes[0] + 1 < len(cells) and cells[codes[0] + 1].strip():
                at.setdefault("project_name", codes[0] + 1)
    return head


def _named(field: str) -> Callable[[Row, list[str], dict[str, int]], Row]:
    return lambda row, cells, at: row | {field: row[field] or _neighbour(cells, at.get(field))}


def _material(row: Row, cells: list[str], at: dict[str, int]) -> Row:
    row = _named("name_spec")(row, cells, at)
    nxt = cells[at["unit_price"] + 1 : at["unit_price"] + 3] if "unit_price" in at else []
    price = row["unit_price"] or next((c for c in nxt if re.fullmatch(r"[-+]?\d[\d,]*(\.\d+)?", c)), "")
    return row | {"unit_price": price}


def _second_header(grid: Grid, head: int, at: dict[str, int]) -> int:
    return next((i for i in range(head + 1, min(head + 3, len(grid))) if "序号" in squeeze("".join(grid[i]))), head)


_PRICED = (("unit", ("单位",)), ("quantity", ("数量",)), ("unit_price", ("单价",)), ("total_price", ("合价",)), ("remark", ("备注",)))
#: The headers and column words of each table type.
TABLES = {
    "unit_project_fee_table": TableRule((("费用名称", "计算公式"), ("费用名称", "金额")), (("seq", ("序号",)), ("fee_name", ("费用名称",)), ("formula", ("计算公式",)), ("amount", ("金额",)), ("remark", ("备注",))), finish=_unit_fee),
    "sub_item_project_table": TableRule(rules.SUB_ITEM_HEADERS, rules.SUB_ITEM_COLUMNS, merged=True, finish=_sub_item, refine=_late_columns),
    "specialty_fee_table": TableRule((("工程名称", "金额", "暂估价"), ("工程名称", "金额", "安全文明"), ("工程名称", "金额")), (("seq", ("序号",)), ("project_name", ("工程名称",)), ("amount", ("金额",)), ("provisional_estimate", ("暂估价", "暂估")), ("safety_civilization_fee", ("安全文明",)), ("regulatory_fee", ("规费",)), ("tax", ("税金",)), ("remark", ("备注",)))),
    "labor_table": TableRule((("工日", "名称", "合价"), ("工日", "名称", "单价"), ("工日", "名称")), (("seq", ("序号",)), ("name", ("名称", "类别", "工日名称")), *_PRICED), finish=_named("name")),
    "material_table": TableRule((("材料", "名称", "合价"), ("材料", "名称", "单价"), ("材料", "规格", "合价"), ("材料", "名称"), ("名称", "规格", "型号", "单位"), ("名称", "规格", "合价"), ("序号", "名称", "合价")), (("seq", ("序号",)), ("name_spec", ("名称", "规格", "型号")), *_PRICED), finish=_material),
    "machine_table": TableRule((("机械", "名称", "合价"), ("机械", "名称", "单价"), ("台班", "名称", "合价"), ("台班", "名称", "单价"), ("机械", "名称"), ("台班", "名称")), (("seq", ("序号",)), ("name_spec", ("名称", "规格", "型号", "机械")), *_PRICED)),
    "quantity_confirm_table": TableRule((("工程量", "确认"), ("名称", "维修内容", "工程量"), ("名称", "工程量"), ("序号", "名称", "单位")), (("seq", ("序号",)), ("name", ("名称", "项目名称")), ("repair_content", ("维修内容",)), ("unit", ("单位",)), ("formula", ("计算式", "计算公式")), ("quantity", ("工程量",)), ("remark", ("备注",))), finish=lambda row, cells, at: row if re.match(r"\d", row["seq"] or next(c for c in cells if c)) else None, refine=_second_header),
}


def extract_rows(grid: Grid, kind: str) -> list[Row]:
    """The typed rows of a grid, with row_index (from the header on, skipped rows counted) and raw_text."""
    rule = TABLES[kind]
    head = header_row(grid, rule.headers)
    if head < 0:
        return []
    if rule.refine is _second_header:
        head = rule.refine(grid, head, {})
    top = [" ".join(r[i] if i < len(r) else "" for r in grid[:5]) for i in range(max(map(len, grid[:5])))] if rule.merged else grid[head]
    at = column_map(top, rule.columns, share=rule.merged)
    if rule.merged:
        rule.refine(grid, head, at)
    out = []
    for index, cells in enumerate(([c.strip() for c in r] for r in grid[head + 1 :]), 1):
        if not any(cells):
            continue
        row = {name: cells[at[name]] if at.get(name, len(cells)) < len(cells) else "" for name, _ in rule.columns}
        done = rule.finish(row, cells, at)
        if done is not None:
            out.append(done | {"row_index": str(index), "raw_text": " ".join(c for c in cells if c)})
    return out


def fields_of(kind: str) -> list[str]:
    return [name for name, _ in TABLES[kind].columns] + ["row_index", "raw_text"]


def _list(values: pa.Array) -> list:
    """``to_pylist`` of strings or whole numbers, by way of an array of objects: several times faster."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _grids(grids: pa.Array) -> list[Grid]:
    """Grids as lists, by way of one list of all their cells; nulls are blank or empty."""
    cells, rows, starts = [c or "" for c in _list(grids.flatten().flatten())], [], [0]
    for n in _list(pc.fill_null(pc.list_value_length(grids.flatten()), 0)):
        rows.append(cells[starts[-1] : starts[-1] + n])
        starts.append(starts[-1] + n)
    out, at = [], 0
    for n in _list(pc.fill_null(pc.list_value_length(grids), 0)):
        out.append(rows[at : at + n])
        at += n
    return out


def listed_rows(grids: pa.Array, kinds: Iterable[str], names: Sequence[str], missing: str | None) -> pa.Array:
    """The rows of each grid of its kind as a list of structs of ``names``; ``missing`` stands for fields that a row doesn't have."""
    offsets, columns, kinds = [0], [[] for _ in names], iter(kinds)
    for k in range(0, len(grids), SLICE):
        for grid, kind in zip(_grids(grids.slice(k, SLICE)), kinds):  # noqa: B905  a kind may be repeated without end
            found = extract_rows(grid, kind)
            for name, column in zip(names, columns, strict=True):
                column.extend([r.get(name, missing) for r in found])
            offsets.append(offsets[-1] + len(found))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], names=list(names)))


def extract(grid: Column, kind: str) -> Column:
    """Array of structs of the type's fields, all strings."""
    names = fields_of(kind)

    def run(grids: pa.Array) -> pa.Array:
        return listed_rows(grids, repeat(kind), names, "")

    run.__annotations__ = {"grids": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>")(grid)


def lenient_json(reply: str | None) -> list | None:
    """The rows in a model's reply: the outermost list, else the object as one row; fences, trailing commas and bad escapes are mended once."""
    text = (reply or "").strip()
    for left, right in ("[]", "{}"):
        a, b = text.find(left), text.rfind(right)
        if 0 <= a < b:
            text = text[a : b + 1] if left == "[" else f"[{text[a : b + 1]}]"
            break
    mended = re.sub(r'\\(?!["\\/bfnrtu])', r"\\\\", re.sub(r",\s*([}\]])", r"\1", re.sub(r"```(?:json)?\s*", "", text)))
    for candidate in (text, mended):
        try:
            return json.loads(candidate)
        except ValueError:
            continue
    return None


def parse_replies(reply: Column) -> Column:
    """Rows of string maps of each reply; null where it has none."""

    def run(texts: pd.Series) -> pd.Series:
        def rows(t):
            found = lenient_json(t)
            return None if found is None else [{str(k): "" if not v else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for k, v in r.items()} for r in found if isinstance(r, dict)]

        return texts.map(lambda t: None if (r := rows(t)) is None else json.dumps(r, ensure_ascii=False))

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.from_json(F.pandas_udf(run, "string")(reply), "array<map<string,string>>")


class RuleBackend:
    """Extraction without a model."""

    def rows(self, grid: Column, kind: str) -> Column:
        return extract(grid, kind)
