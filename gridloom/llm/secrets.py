"""Secret scans: one automaton for all rules, one pass over the bytes.

All rule patterns are compiled together by subset construction and minimised into
transition arrays. A pass over the bytes of a batch gives the rules that end at each
byte; a rule's own automaton, run backwards from where its run of ends stops, gives the
leftmost start, and the pattern itself confirms the span and its minimum lengths.
Matches of a rule are leftmost, longest and do not overlap; a match that fails its
lengths is dropped whole. Letters are ASCII. Offsets are code points, end exclusive.

Nulls: a null text is empty. Very long texts are scanned whole, in lanes. Spans that begin
together all stay, in the order of their rules. Every input row gives one row, repeated rows included; an
empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .automaton import FENCE, Automaton, compile_rules, run


@dataclass(frozen=True)
class Rule:
    """scan is what the automaton looks for; least the shortest match, least_group the shortest last group."""

    kind: str
    pattern: str
    least: int = 0
    least_group: int = 0
    scan: str | None = None


BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least_group=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16, scan=r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
    Rule("payment", r"[rs]k_(live|test)_[A-Za-z0-9]+", least=24),
    Rule("maps", r"AIza[A-Za-z0-9_-]+", least=39),
)
RULES = BASE_RULES + MORE_RULES
#: Bytes that one pass holds; a longer document is still taken whole.
PASS_BYTES = 4 << 20


@lru_cache(maxsize=4)
def _compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton], list[re.Pattern]]:
    scans = [r.scan or r.pattern for r in rules]
    return compile_rules(scans), [compile_rules([s], anchored=True, backwards=True) for s in scans], [re.compile(r.pattern.encode()) for r in rules]


def _start(auto: Automaton, data: bytes, end: int, low: int) -> int:
    """The smallest start >= low of a match that ends before ``end``; -1 if there is none."""
    state, found = auto.start, -1
    for i in range(end - 1, low - 1, -1):
        state = int(auto.next[state, auto.class_of[data[i]]])
        if auto.accepts[state]:
            found = i
        elif state == auto.next[state, auto.class_of[FENCE]]:  # nothing can follow
            break
    return found


def find_secrets(texts: list[bytes], rules: tuple[Rule, ...] = RULES, compiled: tuple | None = None) -> list[list[tuple[str, int, int]]]:
    """The spans of each UTF-8 text, by start, then by rule order."""
    forward, backward, exact = compiled or _compiled(rules)
    data = bytes([FENCE]).join(texts)
    accepts = forward.accepts[run(forward, np.frombuffer(data, np.uint8))]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    out: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
    hit = np.flatnonzero(accepts)
    for r, rule in enumerate(rules):
        at = hit[(accepts[hit] >> r) & 1 == 1]
        ends = at[np.flatnonzero(np.diff(at, append=len(data) + 9) != 1)] + 1
        last = 0
        for end, k in zip(ends.tolist(), (np.searchsorted(begins, ends, "left") - 1).tolist(), strict=True):
            low = max(last, int(begins[k]))
            start = _start(backward[r], data, end, low)
            if start < 0:
                continue
            last = end
            m = exact[r].fullmatch(data, start, end)
            if m and end - start >= rule.least and (not rule.least_group or m.end(m.lastindex) - m.start(m.lastindex) >= rule.least_group):
                out[k].append((start - int(begins[k]), r, rule.kind, end - int(begins[k])))
    result = []
    for text, found in zip(texts, out, strict=True):
        spans, chars, upto = [], 0, 0
        found.sort()
        for start, _, kind, end in found:
            chars += len(text[upto:start].decode("utf-8", "replace"))
            upto = start
            spans.append((kind, chars, chars + end - start))
        result.append(spans)
    return result


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``id_col`` and ``spans``, an array of (kind, start, end), for each row."""
    kinds = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = f"`{id_col}` {kinds.schema[0].dataType.simpleString()}, spans array<struct<kind:string,start:int,end:int>>"

    # compiled once, on the driver; the arrays depend on the rules only
    shared = docs.sparkSession.sparkContext.broadcast(_compiled(rules))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
            rows, group, held = [], [], 0
            for t in texts:
                group.append(t)
                held += len(t) + 1
                if held >= PASS_BYTES:
                    rows += find_secrets(group, rules, shared.value)
                    group, held = [], 0
            if group:
                rows += find_secrets(group, rules, shared.value)
            spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in rows], span)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=[id_col, "spans"])

    return kinds.mapInArrow(scan, schema)


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))
