"""Conversation structure repair: the cheapest edits that make the turns of a conversation alternate.

A conversation's rows, by turn (nulls first), then role, then digest of the text, are to have the role initials
``(s?(ua)+)?``. A row may be kept (K, free), given the role user or assistant (R, 3) or deleted (D, 4), and an empty user or
assistant row may be inserted anywhere (I, 3). Blank rows and rows whose role and text were seen before in the
conversation must be deleted; a row that stays though it ends in mid-sentence costs 3 more. Of the cheapest sequences of
edits the least by their letters is taken, the audit.

The edits are a shortest path through (rows done, role of the last row put out). Costs are small integers, so the distances
to the end come from Dial's bucket queue: nodes wait in a ring of buckets by distance, which has one bucket for each
cost that two waiting nodes may differ by. Then a walk from the start takes the first letter whose arc is tight, that is, whose cost is what
the distance falls by. Given the letters so far the state is known, so there is one such walk.

How it is spread: rows become runs, one for each (conversation, turn, role, digest) with its count, without text, and the first run of
each (conversation, role, digest) is found by an aggregate and a join on all four keys, on which no key is hot. Runs are sorted across
tasks by range, so a task holds many whole conversations and at most two that go on elsewhere. Whole ones are settled there. Of the others each piece gives
its 4 x 4 distances between states; those of a conversation, no more pieces than tasks, give the distances to the end
at each piece's end; pieces then walk from each of the four states, and the walks that meet are chained. So the edits of a conversation of
any length are found by many tasks. Rows that must be deleted are counted, not walked over.

Writing out the repaired rows in order, or hashing them, passes over the text once, sorted by conversation, as a stream: a
conversation's rows follow one another through one task, which keeps its letters (a byte a row) and no rows.

Nulls: a null role or text is one blank; a null turn comes first and is no gap; a null conversation is one of its own. A
role other than those of initial s, u or a can't be kept. Equal rows of one turn are one after the other; all but the first are duplicates.
A text of any length is read whole. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or re-roled row, by the state before; and the role of the row put out on reaching a state.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("", "system", "user", "assistant")
#: Cost and letters of the inserted rows that end a conversation in each state.
END = (0, 6, 3, 0)
TAIL = ("", "II", "I", "")
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
#: A row's code: its initial (s, u, a, other), plus CUT_CODE if it ends in mid-sentence.
CUT_CODE, OTHER = 4, 3
FAR = 1 << 60


def _kept(code: int, state: int) -> int | None:
    """The state after keeping a row."""
    initial = code & 3
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == OTHER or (USER, ASSISTANT)[initial - 1] != NEXT[state]:
        return None
    return NEXT[state]


def _arcs(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of what may be done with a row, by letter."""
    more = CUT if code & CUT_CODE else 0
    kept = _kept(code, state)
    keep = [] if kept is None else [("K", more, kept)]
    return [("D", DELETE, state), *keep, ("R", REROLE + more, NEXT[state])]


ARCS = [[_arcs(code, state) for state in range(4)] for code in range(8)]
#: (state before, cost) of the arcs into a state: over a row, and by an insertion.
INTO = [[[(p, cost) for p in range(4) for _, cost, q in ARCS[code][p] if q == state] for state in range(4)] for code in range(8)]
INSERTED = [[p for p in range(4) if NEXT[p] == state] for state in range(4)]
LARGEST = max(cost for code in ARCS for state in code for _, cost, _ in state)


def distances(codes: bytes, ends: tuple[int, ...]) -> list[int]:
    """Of node ``4 * i + state``, before row i, the least cost to the end, where reaching ``state`` costs ``ends[state]`` more: Dial's algorithm, backwards."""
    n = len(codes)
    found = [FAR] * (4 * n + 4)
    some = [e for e in ends if e < FAR]
    at, width = min(some), max(some) - min(some) + LARGEST + 1
    ring: list[list[int]] = [[] for _ in range(width)]
    for state, e in enumerate(ends):
        if e < FAR:
            found[4 * n + state] = e
            ring[e % width].append(4 * n + state)
    waiting = len(some)
    while waiting:
        bucket = ring[at % width]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if found[node] != at:
                continue  # it was reached more cheaply
            i, state = divmod(node, 4)
            before = [(4 * i + p, INSERT) for p in INSERTED[state]] if i < n else []
            if i:
                before += [(4 * i - 4 + p, cost) for p, cost in INTO[codes[i - 1]][state]]
            for other, cost in before:
                if at + cost < found[other]:
                    found[other] = at + cost
                    ring[(at + cost) % width].append(other)
                    waiting += 1
        at += 1
    return found


def walk(codes: bytes, found: list[int], state: int) -> tuple[list[str], int]:
    """The least letters along tight arcs from ``state``: for each row those before it and its own; and the state at the end."""
    out = []
    for i, code in enumerate(codes):
        letters = ""
        while True:
            left = found[4 * i + state]
            arcs = ARCS[code][state]
            if arcs[0][1] + found[4 * i + 4 + arcs[0][2]] == left:
                letter, after = "D", arcs[0][2]
            elif INSERT + found[4 * i + NEXT[state]] == left:
                letters, state = letters + "I", NEXT[state]
                continue
            else:
                letter, after = next((x, q) for x, cost, q in arcs[1:] if cost + found[4 * i + 4 + q] == left)
            out.append(letters + letter)
            state = after
            break
    return out, state


@lru_cache(maxsize=65536)
def _short(codes: bytes) -> tuple[int, list[str], str]:
    found = distances(codes, END)
    letters, state = walk(codes, found, START)
    return found[START], letters, TAIL[state]


def whole(codes: bytes) -> tuple[int, list[str], str]:
    """Cost, letters by row and letters at the end for a whole conversation."""
    return _short(codes) if len(codes) <= 64 else _short.__wrapped__(codes)


def spelt(letters: list[str], before: list[int], after: int, tail: str) -> str:
    """The audit of a piece with the rows that must be deleted, ``before[i]`` before row i and ``after`` at the end."""
    return "".join("D" * b + x for b, x in zip(before, letters, strict=True)) + "D" * after + tail


SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (1 or 2) of the rows left by the faults that a row's crc32 picks."""
    spelled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(spelled("text"), "[.!?]", "")).otherwise(spelled("text"))
    role = F.when(fault == 4, "user").otherwise(spelled("role"))
    return conversations.where(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(fault == 3, 2).otherwise(1).cast("long").alias("copies"))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def runs(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, count, code, blank and first (of its role and text in the conversation) of each run of ``rows`` (conv_id, turn, role, text, copies)."""
    ended = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER) + F.when(ended.isin(".", "!", "?"), 0).otherwise(CUT_CODE)
    lean = rows.select("conv_id", "turn", "role", digest(F.col("text")).alias("digest"), "copies", code.alias("code"), (~F.col("text").rlike(WORD)).alias("blank"))
    found = stored(lean.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("count"), F.first("code").alias("code"), F.first("blank").alias("blank")), "talk-runs")
    firsts = found.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn"))).alias("least"))
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("least.turn").alias("_turn"), F.col("role").alias("_role"), F.col("digest").alias("_digest"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    return stored(found.join(firsts, same, "left").withColumn("first", F.col("_role").isNotNull()).drop("_conv", "_turn", "_role", "_digest"), "talk-flagged")


def faults(flagged: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate and truncated of each conversation of ``runs``."""
    live = ~F.col("blank") & F.col("first")
    counts = {
        "blank": F.sum(F.when(F.col("blank"), F.col("count")).otherwise(0)),
        "duplicate": F.sum(F.when(F.col("blank"), 0).otherwise(F.col("count") - F.col("first").cast("long"))),
        "truncated": F.sum((live & (F.col("code") >= CUT_CODE)).cast("long")),
    }
    turns = flagged.groupBy("conv_id", "turn").agg(*[c.alias(k) for k, c in counts.items()])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    return turns.groupBy("conv_id").agg(gaps.cast("long").alias("gaps"), *[F.sum(k).alias(k) for k in counts])


class _Piece:
    """The runs of one conversation that one task holds, as they come."""

    def __init__(self, conv: object):
        self.conv, self.codes, self.before, self.after, self.illegal, self.first, self.last = conv, bytearray(), [], 0, 0, None, None

    def add(self, code: int, count: int, live: bool) -> None:
        initial = code & 3
        if self.first is None:
            self.first = initial
        else:
            self.illegal += not legal(self.last, initial)
        self.illegal += count - 1
        self.last = initial
        if live:
            self.codes.append(code)
            self.before.append(self.after)
            self.after = count - 1
        else:
            self.after += count


def legal(a: int, b: int) -> bool:
    """Whether initial b (s, u, a, other) may follow a."""
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def pieces(flagged: DataFrame) -> DataFrame:
    """One row for each conversation and task.

    conv_id, piece (number of the task), edge (whether it may go on elsewhere), illegal and, of an edge, first and last (initials),
    codes, before, after and matrix (the distances from each state to each state); of others cost and edits.
    """
    kind = flagged.schema["conv_id"].dataType.simpleString()
    conv_type = pa.null()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, current, began = TaskContext.get().partitionId(), [], None, True

        def shown(p: _Piece, edge: bool) -> tuple:
            codes = bytes(p.codes)
            live = sum(p.before) + p.after
            if edge:
                each = [distances(codes, tuple(0 if q == end else FAR for q in range(4))) for end in range(4)]
                return p.conv, number, True, p.illegal, p.first, p.last, codes, p.before, p.after, [each[q][p_] for p_ in range(4) for q in range(4)], None, None
            cost, letters, tail = whole(codes)
            return p.conv, number, False, p.illegal, None, None, None, None, None, None, cost + DELETE * live, spelt(letters, p.before, p.after, tail)

        schema = pa.schema([("conv_id", conv_type), ("piece", pa.int64()), ("edge", pa.bool_()), ("illegal", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("codes", pa.binary()), ("before", pa.list_(pa.int64())), ("after", pa.int64()), ("matrix", pa.list_(pa.int64())), ("cost", pa.int64()), ("edits", pa.string())])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            schema = schema.set(0, batch.schema.field(0))
            for conv, code, count, live in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or conv != current.conv:
                    if current is not None:
                        held.append(shown(current, began))
                        began = False
                    current = _Piece(conv)
                    if len(held) >= 4096:
                        yield batch_of(held)
                        held = []
                current.add(code, count, live)
        if current is not None:
            yield batch_of([*held, shown(current, True)])

    ordered = flagged.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "role", "digest").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    lean = ordered.select("conv_id", F.col("code").cast("int"), "count", (~F.col("blank") & F.col("first")).alias("live"))
    return stored(lean.mapInArrow(run, f"conv_id {kind}, piece long, edge boolean, illegal long, first int, last int, codes binary, before array<long>, after long, matrix array<long>, cost long, edits string"), "talk-pieces")


def _by_conversation(rows: DataFrame, schema: str, make: Callable[[list[dict]], list[dict]]) -> DataFrame:
    """What ``make`` gives of each conversation's pieces in order, of which there are no more than tasks."""

    def run(table: pa.Table) -> pa.Table:
        made = make(sorted(table.drop_columns("conv_id").to_pylist(), key=lambda r: r["piece"]))
        out = pa.table({k: pa.array([m[k] for m in made]) for k in made[0]})
        return out.add_column(0, table.schema.field("conv_id"), pa.chunked_array([table["conv_id"].combine_chunks().take(pa.array([0] * len(made)))]))

    return rows.groupBy("conv_id").applyInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {schema}")


def _ends(found: list[dict]) -> list[dict]:
    """Of each piece the distances from its end; of the first one the whole cost, and the transitions between pieces that are not legal."""
    out, ends = [], list(END)
    for k in range(len(found) - 1, -1, -1):
        out.append({"piece": found[k]["piece"], "ends": ends, "last": k == len(found) - 1, "cost": 0, "illegal": 0})
        matrix = found[k]["matrix"]
        ends = [min(min(matrix[4 * p + q] + ends[q] for q in range(4)), FAR) for p in range(4)]
    out[-1]["cost"] = ends[START]
    out[-1]["illegal"] = sum(not legal(a["last_role"], b["first_role"]) for a, b in zip(found, found[1:], strict=False))
    return out


def _starts(found: list[dict]) -> list[dict]:
    out, state = [], START
    for r in found:
        out.append({"piece": r["piece"], "start": state})
        state = r["states"][state]
    return out


def _walked(rows: DataFrame) -> DataFrame:
    """Adds states (at the end) and walks of each piece, by the state at its start."""
    names = ["conv_id", "piece", "states", "walks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states, walks = [], []
            for codes, before, after, ends, last in zip(*(batch.column(k).to_pylist() for k in range(2, 7)), strict=True):
                found = distances(codes, tuple(ends))
                each = [walk(codes, found, p) if found[p] < FAR else (None, p) for p in range(4)]
                states.append([q for _, q in each])
                walks.append(["" if letters is None else spelt(letters, before, after, TAIL[q] if last else "") for letters, q in each])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(states, pa.list_(pa.int32())), pa.array(walks, pa.list_(pa.string()))], names=names)

    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.select("conv_id", "piece", "codes", "before", "after", "ends", "last").mapInArrow(run, f"conv_id {kind}, piece long, states array<int>, walks array<string>")


def _same_piece(other: DataFrame) -> tuple[DataFrame, Column]:
    return other.withColumnsRenamed({"conv_id": "_conv", "piece": "_piece"}), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))


def plan(flagged: DataFrame) -> DataFrame:
    """conv_id, piece, illegal, cost and edits; a conversation's audit is its edits by piece, its cost and illegal are sums."""
    found = pieces(flagged)
    edges = found.where("edge").select("conv_id", "piece", "illegal", "first", "last", "codes", "before", "after", "matrix")
    named = edges.select("conv_id", "piece", "matrix", F.col("first").alias("first_role"), F.col("last").alias("last_role"))
    ends, same = _same_piece(stored(_by_conversation(named, "piece long, ends array<long>, last boolean, cost long, illegal long", _ends), "talk-ends").withColumnRenamed("illegal", "between"))
    known = stored(edges.drop("last").join(ends, same), "talk-known")
    walked = stored(_walked(known), "talk-walked")
    starts, same = _same_piece(stored(_by_conversation(walked.select("conv_id", "piece", "states"), "piece long, start long", _starts), "talk-starts"))
    begun = walked.join(starts, same).select("conv_id", "piece", F.get("walks", F.col("start")).alias("edits"))
    costs, same = _same_piece(known.select("conv_id", "piece", (F.col("illegal") + F.col("between")).alias("illegal"), (F.col("cost") + DELETE * (F.aggregate("before", F.lit(0).cast("long"), lambda a, b: a + b) + F.col("after"))).alias("cost")))
    across = begun.join(costs, same).select("conv_id", "piece", "illegal", "cost", "edits")
    return stored(found.where("NOT edge").select("conv_id", "piece", "illegal", "cost", "edits").unionByName(across), "talk-plan")


def _in_order(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """conv_id, edits, role, text, copies: of each conversation the edits by piece (the other columns null), then the rows, in order."""
    none = lambda kind: F.lit(None).cast(kind)
    turn = rows.schema["turn"].dataType.simpleString()
    edits = planned.select("conv_id", F.lit(0).alias("tag"), "piece", none(turn).alias("turn"), none("string").alias("role"), none("binary").alias("digest"), none("string").alias("text"), none("long").alias("copies"), "edits")
    texts = rows.select("conv_id", F.lit(1).alias("tag"), none("long").alias("piece"), "turn", "role", digest(F.col("text")).alias("digest"), "text", "copies", none("string").alias("edits"))
    order = ["conv_id", "tag", "piece", F.asc_nulls_first("turn"), "role", "digest"]
    return edits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "edits", "role", "text", "copies")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, int, pa.RecordBatch, str, str | None, str | None]]:
    """(new conversation, place and batch of its id, edits, role, text) of every row put out; of a new conversation first one without role."""
    conv, begun, letters, at, state = None, False, [], 0, START

    def put(k: int, batch: pa.RecordBatch, upto: int) -> Iterator[tuple]:
        nonlocal at, state
        while at < upto:
            state = NEXT[state]
            yield False, k, batch, "", ROLES[state], ""
            at += 1

    last = None
    for batch in batches:
        for k, (c, edits, role, text, copies) in enumerate(zip(*(x.to_pylist() for x in batch.columns), strict=True)):
            if edits is not None:
                if not begun or c != conv:
                    if begun:
                        yield from put(*last, len(letters[0]))
                    conv, begun, letters, at, state = c, True, [""], 0, START
                    yield True, k, batch, "", None, None
                letters[0] += edits
                yield False, k, batch, edits, None, None
            else:
                for _ in range(copies):
                    upto = at
                    while letters[0][upto] == "I":
                        upto += 1
                    yield from put(k, batch, upto)
                    letter = letters[0][at]
                    at += 1
                    if letter == "R":
                        state = NEXT[state]
                        yield False, k, batch, "", ROLES[state], text
                    elif letter == "K":
                        state = SYSTEM if role[:1] == "s" else NEXT[state]
                        yield False, k, batch, "", role, text
            last = k, batch
    if begun:
        yield from put(*last, len(letters[0]))


def repaired_digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 (of the repaired ``role:text``, joined by newlines) of each conversation with rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, audit, sha, empty = [], [], hashlib.sha256(), True

        def shown() -> pa.RecordBatch:
            ids = pa.concat_arrays([i for i, _, _ in out])
            return pa.RecordBatch.from_arrays([ids, pa.array([a for _, a, _ in out], pa.string()), pa.array([h for _, _, h in out], pa.string())], names=["conv_id", "audit", "repaired_sha256"])

        conv = None
        for new, k, batch, edits, role, text in _edited(batches):
            if new:
                if conv is not None:
                    out.append((conv, "".join(audit), sha.hexdigest()))
                    if len(out) >= 4096:
                        yield shown()
                        out = []
                conv, audit, sha, empty = batch.column(0).slice(k, 1), [], hashlib.sha256(), True
            elif role is None:
                audit.append(edits)
            else:
                sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "replace"))
                empty = False
        if conv is not None:
            out.append((conv, "".join(audit), sha.hexdigest()))
            yield shown()

    return _in_order(rows, planned).mapInArrow(run, f"conv_id {kind}, audit string, repaired_sha256 string")


def repaired_rows(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role and text of the repaired conversations."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, position = [], 0, 0

        def shown() -> pa.RecordBatch:
            ids, at, roles, texts = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array(at, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=["conv_id", "position", "role", "text"])

        for new, k, batch, _, role, text in _edited(batches):
            if new:
                position = 0
            elif role is not None:
                held.append((batch.column(0).slice(k, 1), position, role, text))
                position += 1
                size += len(text)
                if len(held) >= 4096 or size >= 1 << 24:
                    yield shown()
                    held, size = [], 0
        if held:
            yield shown()

    return _in_order(rows, planned).mapInArrow(run, f"conv_id {kind}, position long, role string, text string")


def audit(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every conversation of ``conversations``, whose rows, as they are to be repaired, are ``rows``."""
    flagged = runs(rows)
    planned = plan(flagged)
    sums = planned.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    out = conversations.select("conv_id").distinct()
    for part in (faults(flagged), sums, repaired_digests(rows, planned)):
        right = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(right, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    none = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], *[F.coalesce(c, x).alias(c) for c, x in none.items()])
