"""The pipeline on a small corpus, stage by stage."""

import collections
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from gridloom.llm import lm_quality, queries

from .test_operators import KneserNey, prose, shingles


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    r = random.Random(1)
    rows = [(i, "\n".join(prose(r, 40) for _ in range(4)), "en", f"s{i % 3}") for i in range(60)]
    item = " ".join(f"word{k}" for k in range(20))
    rows[5] = (5, rows[5][1] + "\n" + item, "en", "s0")
    rows.append((70, rows[7][1], "en", "s1"))
    rows.append((80, "".join(r.choice("%#&*zqx") for _ in range(500)), "en", "s1"))
    rows.append((81, None, None, None))
    spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_stages(spark, corpus):
    import corpus_pipeline

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        kept[name] = {r.doc_id for r in rows}
        assert docs.columns == columns
        if name == "benchmark_decontamination":
            assert "word7" not in next(r.text for r in rows if r.doc_id == 5)
    assert 80 not in kept["quality_classifier"] and set(range(50)) <= kept["quality_classifier"]
    assert 70 not in kept["line_dedup"] and kept["minhash_near_dedup"] <= kept["line_dedup"]
    again = corpus_pipeline.run(spark, corpus)
    assert sorted(r.doc_id for r in again.collect()) == sorted(r.doc_id for r in rows)


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(queries.queries()) <= names and "pipeline" in names and set(entry.oracle_sql()) <= names


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_quality(rows, trusted, held):
    out = []
    for lang in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == lang]
        texts = [r[1] for r in own if r[0] in trusted and r[0] not in held and r[1]]
        scores = {}
        if texts:
            model = KneserNey(texts, lm_quality.ORDER)
            for r in own:
                if r[1]:
                    padded = "\0" * (lm_quality.ORDER - 1) + r[1]
                    s = [round(-math.log(model.p(padded[i : i + lm_quality.ORDER])) * 1e6) for i in range(len(r[1]))]
                    w = min(lm_quality.WINDOW, len(s))
                    scores[r] = sum(s) / len(s), max(sum(s[i : i + w]) for i in range(len(s) - w + 1)) / w
        at = lambda xs, q: sorted(xs)[max(0, math.ceil(q * len(xs)) - 1)]
        judges = [scores[r] for r in own if r[0] in held and r in scores]
        if len(judges) < lm_quality.MIN_LANG:
            out += own
            continue
        least = at([scores[r][0] for r in own if r[0] in trusted and r in scores], lm_quality.LOW)
        most, worst = at([x for x, _ in judges], lm_quality.HIGH), at([x for _, x in judges], lm_quality.HIGH_WORST)
        out += [r for r in own if r not in scores or len(r[1]) < 40 or (least <= scores[r][0] <= most and scores[r][1] <= worst)]
    return sorted(out, key=lambda r: r[0])


def by_lines(rows):
    def one(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    first, out = {}, []
    lines = [(i, p, tuple(words(line.lower()))) for i, t, *_ in rows for p, line in enumerate((t or "").split("\n"))]
    for i, p, w in lines:
        if len(w) >= 3:
            first.setdefault(w, (i, p))
    near = {a for a in first if len(a) >= 8 for b in first if len(b) >= 8 and first[b] < first[a] and abs(len(a) - len(b)) <= 1 and one(a, b)}
    gone = {(i, p) for i, p, w in lines if len(w) >= 3 and (w in near or first[w] != (i, p))}
    for r in rows:
        split = (r[1] or "").split("\n")
        left = [x for p, x in enumerate(split) if (r[0], p) not in gone]
        if len(left) == len(split):
            out.append(r)
        elif any(len(words(x)) >= 3 for x in left):
            out.append((r[0], "\n".join(left), *r[2:]))
    return out


def by_shingles(rows):
    sets = [shingles(r[1], 5) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if x == old else x for x in root]
    return [r for k, r in enumerate(rows) if root[k] == k]


def by_benchmark(rows, items):
    wins = set()
    for body in items:
        g = plain_words(body)
        n = min(10, len(g))
        wins |= {tuple(g[k : k + n]) for k in range(len(g) - n + 1)} if n else set()
    out = []
    for r in rows:
        w = plain_words(r[1])
        hit = {j for win in wins for k in range(len(w) - len(win) + 1) if tuple(w[k : k + len(win)]) == win for j in range(k, k + len(win))}
        if len(hit) <= 0.5 * len(w):
            out.append((r, [x for j, x in enumerate(w) if j not in hit], len(hit)))
    return out


def by_weight(sized):
    """Copies of each (doc_id, source, size)."""
    total = collections.Counter()
    for _, source, n in sized:
        total[source] += n
    names = sorted(total, key=lambda x: (x is None, x or ""))
    left, share, target = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(total.values()), {}
    while left:
        level = share / sum(left.values())
        over = [s for s in left if 2 * total[s] < level * left[s]]
        for s in over or list(left):
            target[s] = 2 * total[s] if over else level * left[s]
            share -= target[s]
            del left[s]
    copies = collections.Counter()
    for s in names:
        own = []
        for i, source, n in sized:
            if source == s:
                digest = hashlib.md5(f"mix-1:{i}".encode()).hexdigest()
                own.append((int(digest[:3], 16), int(digest[3:13], 16) / 16.0**10, i, n))
        base = target[s] // total[s] if total[s] else 0
        need, before = target[s] - base * total[s], 0
        edge, p = -1, 0.0
        for b in sorted({x[0] for x in own}):
            inside = sum(x[3] for x in own if x[0] == b)
            if inside and before <= need < before + inside:
                edge, p = b, (need - before) / inside
            before += inside
        for b, fine, i, _ in own:
            copies[i] += int(base) + (b < edge or (b == edge and fine < p))
    return copies


def test_pipeline_against_brute_force(spark, corpus):
    import corpus_pipeline

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    rows = sorted((r.doc_id, r.text, r.lang, r.source) for r in docs.collect())
    held = {x.doc_id for x in docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(lm_quality.HELD)) == 0).collect()} & set(range(50))
    items = [r.text for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    kept = by_benchmark(by_shingles(by_lines(by_quality(rows, set(range(50)), held))), items)
    got = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, corpus).collect():
        got[r.doc_id].append(r.text)
    mixed = [(r[0], r[3], len(words(r[1])) - hits) for r, _, hits in kept]
    copies = by_weight(mixed)
    assert {i: len(t) for i, t in got.items()} == {i: n for i, n in copies.items() if n}
    left = {r[0]: w for r, w, _ in kept}
    assert all(plain_words(t) == left[i] for i, texts in got.items() for t in texts)
    assert len(kept) < len(rows) and any(hits for *_, hits in kept)


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, row string, at string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.count() == 0 and done.columns[-2:] == ["row", "at"]


def test_pipeline_leaves_no_scratch_tables(spark, corpus):
    import os

    import corpus_pipeline

    folder = spark.conf.get("spark.checkpoint.dir") + "/gridloom"
    before = set(os.listdir(folder))
    corpus_pipeline.run(spark, corpus)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert left <= {*(f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES), "mix-bins", "mix-sources"}
