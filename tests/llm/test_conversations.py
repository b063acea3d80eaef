"""Conversation repair against dynamic programming over whole edit strings."""

import hashlib
import random
import re
import zlib

import pytest

from gridloom.llm import conversations as talk

SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        spell = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{spell(conv)}:{spell(turn)}".encode()) % 20
        role, text = spell(role), spell(text)
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def brute(rows, originals):
    """One tuple for each conversation of ``originals`` (ids), ``rows`` being what is left of them."""
    out = []
    for conv in set(originals):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        # state: the role put out last; all (cost, letters, text) compared whole
        after = lambda q: "a" if q == "u" else "u"

        def inserted(best):
            for _ in range(3):
                for q, (cost, letters, said) in list(best.items()):
                    new = (cost + 3, letters + "I", said + [("user" if after(q) == "u" else "assistant") + ":"])
                    if after(q) not in best or new < best[after(q)]:
                        best[after(q)] = new
            return best

        best = {"": (0, "", [])}
        for (_, _, role, text), fault in zip(own, faults, strict=True):
            nxt = {}

            def put(q, entry, nxt=nxt):
                if q not in nxt or entry < nxt[q]:
                    nxt[q] = entry

            for q, (cost, letters, said) in inserted(best).items():
                put(q, (cost + 4, letters + "D", said))
                if fault in "t":
                    more = 3 * (fault == "t")
                    put(after(q), (cost + 3 + more, letters + "R", said + [("user" if after(q) == "u" else "assistant") + ":" + text]))
                    if role[:1] == after(q) or (role[:1] == "s" and q == ""):
                        put(role[:1], (cost + more, letters + "K", said + [f"{role}:{text}"]))
            best = nxt
        cost, letters, said = min(v for q, v in inserted(best).items() if q in ("", "a"))
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, letters, digest))
    return out


def shown(rows):
    return sorted(map(str, map(tuple, rows)))


def made(r, conv, n):
    rows = []
    for turn in range(n):
        role = r.choice(("system", "user", "user", "assistant", "assistant", "tool", "", "agent", "s", None)) if r.random() < 0.5 else ("user", "assistant")[turn % 2]
        text = r.choice(("Fine.", "Why?", "no end", "", " \n", None, "Done! ", "ä?\n", "a.b", f"text {r.random()}.", f"open {r.random()}"))
        rows.append((conv, None if r.random() < 0.03 else turn + r.choice((0, 0, 0, 1)), role, text))
    return rows


@pytest.fixture(scope="module")
def rows():
    r = random.Random(13)
    out = [x for conv in range(150) for x in made(r, conv, r.choice((0, 1, 2, 4, 9)))]
    out += made(r, 1000, 700) + made(r, None, 6)  # one conversation over many tasks
    out += [(2000, t, "user", "Same?") for t in range(300)] + [(2001, 0, "assistant", "Same again.")] * 250
    out += [(3000, 0, "system", "x" * 200000), (3000, 1, "user", "y" * 100000 + "!"), (3001, None, "user", "a."), (3001, None, "assistant", "b.")]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("tasks", [1, 4, 40])
def test_audit(spark, rows, tasks):
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", tasks < 40)
    try:
        df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as piece", "'x' as edits", "0 as cost", "2 as code")
        got = talk.audit(df, talk.damaged(df)).collect()
        assert shown(got) == shown(brute(damage(rows), [x[0] for x in rows]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def test_repaired_rows_keep_the_grammar(spark, rows):
    left = talk.damaged(spark.createDataFrame(rows, SCHEMA))
    planned = talk.plan(talk.runs(left))
    said = {}
    for c, p, role, text in sorted(map(tuple, talk.repaired_rows(left, planned).collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        said.setdefault(c, []).append((p, role, text))
    digests = {r.conv_id: r.repaired_sha256 for r in talk.repaired_digests(left, planned).collect()}
    for conv, put in said.items():
        assert [p for p, _, _ in put] == list(range(len(put)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in put))
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in put).encode()).hexdigest() == digests[conv]


def test_bucket_queue_against_relaxation():
    r = random.Random(1)
    for _ in range(300):
        codes = bytes(r.randrange(8) for _ in range(r.randrange(9)))
        ends = r.choice((talk.END, (0, talk.FAR, talk.FAR, talk.FAR), (7, 3, 9, 0), (talk.FAR, 2, 0, 1)))
        found = talk.distances(codes, ends)
        want = [talk.FAR] * (4 * len(codes)) + list(ends)
        for _ in range(4 * len(codes) + 4):
            for i, code in enumerate(codes):
                for q in range(4):
                    options = [cost + want[4 * i + 4 + z] for _, cost, z in talk.ARCS[code][q]] + [talk.INSERT + want[4 * i + talk.NEXT[q]]]
                    want[4 * i + q] = min(want[4 * i + q], min(options))
        assert [min(x, talk.FAR) for x in found] == [min(x, talk.FAR) for x in want]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert talk.audit(none, talk.damaged(none)).count() == 0
    gone = spark.createDataFrame([(1, t, "user", "a") for t in range(200) if zlib.crc32(f"1:{t}".encode()) % 20 == 0], SCHEMA)
    assert [tuple(x) for x in talk.audit(gone, talk.damaged(gone)).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
