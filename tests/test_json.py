"""Texts of nested JSON against a recursive walk."""

import json
import random

from pyspark.sql import functions as F

from gridloom import rules
from gridloom.sources import artifacts


def walk(node):
    if isinstance(node, dict):
        for key, value in node.items():
            if key in rules.CONTENT_KEYS and isinstance(value, str):
                if value.strip():
                    yield value.strip()
            else:
                yield from walk(value)
    elif isinstance(node, list):
        for value in node:
            yield from walk(value)


def made(r, depth):
    if depth == 0 or r.random() < 0.2:
        return r.choice(["plain", 'a "quoted" text: \\"text\\": "x"', "line\nbreak\ttab", "", "  ", "\\\\", '"', "价 😀", 1, None, True, 1.5, "same"])
    if r.random() < 0.5:
        return [made(r, depth - 1) for _ in range(r.randrange(4))]
    keys = r.sample(["z", "text", "block_content", "a", "markdown_texts", "te xt", "text2", 'q"text'], r.randrange(1, 5))
    return {k: made(r, depth - 1) for k in keys}


def test_texts_of_nested_json(spark):
    r = random.Random(8)
    payloads = [json.dumps(made(r, r.choice((1, 3, 6))), ensure_ascii=r.random() < 0.5, indent=r.choice((None, 1))) for _ in range(400)]
    deep = {"text": "bottom"}
    for k in range(12):
        deep = {"text": f"level {k}", "list": [deep, {"block_content": f"beside {k}"}]}
    payloads += [json.dumps(deep), "{bad", "", None, json.dumps({"text": "x" * 200000 + "\n" * 20000 + "y"}), '{"text" :\n "spaced"}', "[]"]
    rows = spark.createDataFrame(list(enumerate(payloads)), "i int, p string")
    got = {x.i: x.t for x in rows.select("i", artifacts.json_texts(F.col("p")).alias("t")).collect()}

    def want(p):
        try:
            return "\n\n".join(dict.fromkeys(walk(json.loads(p or ""))))
        except ValueError:
            return ""

    assert got == {i: want(p) for i, p in enumerate(payloads)}
    assert "PythonEval" not in rows.select(artifacts.json_texts(F.col("p")))._jdf.queryExecution().toString()
