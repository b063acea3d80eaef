"""Personal data: candidate spans, boosted trees, calibrated thresholds. All native.

Base spans come from fixed patterns with their checks and always stand. High-recall
generators propose further, overlapping spans (national phone numbers, identity and
account numbers, spelt-out addresses, long numbers); format and context features of each
go through boosted trees, written as one sum of CASE expressions, and a span is selected
where its score passes its kind's threshold. Proposals that overlap a base span are
dropped, and so are those inside another selected one.

The trees are fitted on the driver, once a process, to ``TRAIN_ROWS`` labelled candidates
that ``training_rows`` writes from templates with a fixed seed. Labels follow what a value
is, not the features: a card number stays one when a digit is wrong, a part number isn't an
identity number. Context words come in four languages; the half that sets the
thresholds uses words for contexts that are in no feature list beside those that are. A
threshold is the lowest that reaches ``PRECISION`` there, and a kind that never does selects
nothing. An account number of 15 to 34 characters whose check digits hold (modulo 97) is
selected whatever its score.

Positions come from splitting a text at the same pattern that finds the matches: the
pieces before a match add up to its start. Offsets are code points, end exclusive. Sums,
overlaps and cuts run over sorted spans in blocks, so that a text of n spans takes n ** 1.5
steps at most.

Nulls: a null text is empty for ``find_pii`` and stays null in ``redact``. Of selected spans that
are equal the first kind stays; those that only overlap both stay. Very long texts are read whole (in n ** 1.5 steps over their spans). Every row gives
one row, repeated rows included; an empty table an empty result. Extra columns of any name
are passed on by ``redact`` and not read else.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from .common import between, chunks, packed, running, unpacked

#: Possessive forms of the base patterns: nothing follows them, so they match the same.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE = {
    "local_phone": r"(?<![0-9+])\(?[0-9]{2,5}\)?[\x20./-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
    "identity": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?|(?:\x20?[A-Z0-9]{4}){2}\x20?[A-Z0-9]{3}|[A-Z0-9]{11,30})(?![A-Za-z0-9])",
    "spelt_email": r"[A-Za-z0-9._-]++\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z0-9-]++)++",
    "long_number": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){8,18}(?![0-9])",
}
#: Beginnings of words before a span that speak for or against it, in English, German, French and Spanish.
CONTEXT = {
    "call": ("phone", "tel", "call", "mobile", "fax", "handy", "rufnummer", "anruf", "tél", "appel", "portable", "llam", "móvil"),
    "person": ("ssn", "social", "passport", "identity", "license", "ausweis", "pass", "sozialvers", "identité", "passeport", "identidad", "pasaporte", "dni"),
    "bank": ("iban", "account", "bank", "card", "transfer", "konto", "karte", "überweis", "compte", "carte", "virement", "cuenta", "tarjeta"),
    "mail": ("mail", "contact", "write", "reach", "kontakt", "schreib", "écri", "courriel", "correo", "escrib"),
    "thing": ("version", "order", "isbn", "page", "part", "invoice", "serial", "total", "item", "lot", "bestell", "artikel", "seite", "rechnung", "commande", "facture", "série", "pedido", "factura", "página"),
}
#: Words for the same contexts that no feature knows.
UNKNOWN = {
    "call": ("dial", "ring", "sms", "erreichbar", "joindre", "marcar"),
    "person": ("id", "citizen", "bürger", "assuré", "ciudadano"),
    "bank": ("pay to", "deposit", "zahlung", "payer", "abonar"),
    "mail": ("ask", "reply", "antwort", "répondre", "responder"),
    "thing": ("model", "build", "ticket", "modell", "modèle", "modelo"),
}
ENDINGS = ("com", "org", "net", "edu", "de", "fr", "es", "uk", "eu", "info")
FEATURES = ("digits", "letters", "length", "marks", "brackets", "luhn", "check97", "ending", *CONTEXT, "money", *MORE)
TRAIN_ROWS, SEED, PRECISION = 8000, 11, 0.9


def _spans(lengths: str, values: str, pieces: str) -> Column:
    """(start, end, value, before, after) of each match; ``lengths`` holds what each match and the piece before it measure together."""
    starts = running(F.col(lengths), F.lit(0), lambda a, x: a + x)
    return let(starts, lambda at: F.transform(values, lambda v, i: F.struct(
        (F.get(at, i + 1) - F.length(v)).alias("start"), F.get(at, i + 1).alias("end"), v.alias("value"),
        F.right(F.get(F.col(pieces), i), F.lit(30)).alias("before"), F.left(F.get(F.col(pieces), i + 1), F.lit(6)).alias("after"))))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(False)


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        short = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda x: F.when(F.length(short(x)) <= 3, short(x).cast("int") <= 255).otherwise(False))
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _check97(value: Column) -> Column:
    """Whether an account number's check digits hold: country and check digits moved to the end, letters as 10 to 35, modulo 97."""
    whole = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.filter(F.split(F.concat(F.substring(whole, 5, 40), F.substring(whole, 1, 4)), ""), lambda c: c != "")
    rest = F.aggregate(turned, F.lit(0), lambda a, c: F.when(c >= "A", a * 100 + F.ascii(c) - 55).otherwise(a * 10 + F.ascii(c) - 48) % 97)
    return F.when(value.rlike(r"\A[A-Z]{2}[0-9]{2}[A-Z0-9\x20]+\z") & F.length(whole).between(15, 34), rest == 1).otherwise(False)


def features(span: Column) -> Column:
    """The numbers that the trees see, in the order of ``FEATURES``."""
    value, before, after = span["value"], F.lower(span["before"]), span["after"]
    strip = lambda keep: F.length(F.regexp_replace(value, f"[^{keep}]", "")).cast("double")
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return F.array(
        strip("0-9"), strip("A-Za-z"), F.length(value).cast("double"), F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")).cast("double"), flag(value.rlike(r"\A\(")),
        flag(_luhn(_digits(value))), flag(_check97(value)), flag(F.lower(value).rlike(r"[^a-z](?:" + "|".join(ENDINGS) + r")\z")),
        *[flag(before.rlike(r"(?:\A|[^\p{L}])(?:" + "|".join(ws) + ")")) for ws in CONTEXT.values()],
        flag(before.rlike(r"[$€£#]\s?$") | after.rlike(r"^\s?(%|€|kg|km|mm)")), *[flag(span["kind"] == k) for k in MORE],
    )


def _account(r: random.Random, right: bool) -> str:
    """An account number of a real national length, with check digits that hold or not, in groups or without."""
    country, size = r.choice((("DE", 22), ("GB", 22), ("FR", 27), ("IT", 27), ("ES", 24), ("NL", 18), ("CH", 21), ("NO", 15), ("BE", 16), ("AT", 20)))
    own = "".join(r.choice("0123456789") for _ in range(size - 4))
    rest = 98 - int("".join(str(int(c, 36)) for c in own + country + "00")) % 97
    whole = f"{country}{rest if right else (rest + r.randint(1, 90)) % 97:02d}{own}"
    return " ".join(whole[i : i + 4] for i in range(0, size, 4)) if r.random() < 0.5 else whole


def training_rows(rows: int = TRAIN_ROWS, seed: int = SEED) -> list[dict]:
    """Labelled candidates from templates: kind, value, before, after, y and held (for thresholds, with contexts that features don't know among them)."""
    r = random.Random(seed)
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    syllables = "th an ing er on der die en ge ve le la que ion de el os ado con un und in of to".split()
    prose = lambda: " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(4))
    groups = lambda d: " ".join(d[i : i + 4] for i in range(0, len(d), 4))
    right = {"local_phone": ("call",), "identity": ("person",), "account": ("bank",), "spelt_email": ("mail",), "long_number": ("bank", "person", "call")}
    out = []
    for k in range(rows):
        kind, held = r.choice(list(MORE)), k % 2
        thing, told = r.random() < 0.25, r.random() < 0.4
        y = not thing
        if kind == "local_phone":
            value, plain = r.choice(((f"({num(3)}) {num(3)}-{num(4)}", 1), (f"{num(3)}-{num(3)}-{num(4)}", 1), (f"{num(4)} {num(3)}{num(4)}", 0), (f"{num(3)} {num(4)}", 0), (f"{num(2)}.{num(4)}{num(4)}", 0)))
            y = y and (told or plain == 1)
        elif kind == "identity":
            value = f"{num(3)}-{num(2)}-{num(4)}"
        elif kind == "account":
            valid = r.random() < 0.7
            value = _account(r, valid)
            y = valid or (told and not thing)
        elif kind == "spelt_email":
            good = r.random() < 0.7
            value = r.choice(("ann.lee", "info", "j.k", "bob", "office")) + r.choice((" [at] ", "(at)", " (AT) ")) + r.choice(("mail", "site", "firma")) + r.choice((".", " [dot] ", "(dot)")) + r.choice(ENDINGS)
            value, y = (value, True) if good else (r.choice(("look (at) this.one", "meet [at] noon.then", "point (at) it.all")), False)
        else:
            size = r.choice((9, 10, 11, 12, 13, 14, 15, 16, 16, 16, 16, 19))
            value = num(size) if size < 13 or r.random() < 0.6 else groups(num(size))
            y = y and (told or size >= 15)
        lists = UNKNOWN if held and r.random() < 0.15 else CONTEXT
        word = r.choice(lists["thing"]) if thing else r.choice(lists[r.choice(right[kind])]) if told else ""
        before = f"{prose()} {word}{r.choice((' ', ': ', ' no. ')) if word else ' '}" + ("$" if not y and kind == "long_number" and r.random() < 0.1 else "")
        out.append({"kind": kind, "value": value, "before": before[-30:], "after": r.choice((" and ", ". The", ", the", "\n", "### ")), "y": int(y), "held": held})
    return out


def _boost(x: np.ndarray, y: np.ndarray, rounds: int = 30, rate: float = 0.3) -> list[tuple]:
    """Trees of depth two under logistic loss: (feature, cut, (feature, cut, low, high), (feature, cut, low, high))."""
    score, trees = np.zeros(len(y)), []
    cuts = [(f, c) for f in range(x.shape[1]) for c in np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 10)))]
    right = np.stack([x[:, f] > c for f, c in cuts])

    def split(own: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float, float]:
        gr, hr = right[:, own] @ g[own], right[:, own] @ h[own]
        gl, hl = g[own].sum() - gr, h[own].sum() - hr
        best = int(np.argmax(gl**2 / (hl + 1) + gr**2 / (hr + 1)))
        return best, gl[best] / (hl[best] + 1), gr[best] / (hr[best] + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        top, _, _ = split(np.ones(len(y), bool), g, h)
        sides = []
        for own in (~right[top], right[top]):
            s, low, high = split(own, g, h)
            sides.append((*cuts[s], float(rate * low), float(rate * high)))
            score += np.where(own, np.where(right[s], rate * high, rate * low), 0)
        trees.append((*cuts[top], *sides))
    return trees


def _value(trees: list[tuple], x: np.ndarray) -> np.ndarray:
    leaf = lambda t: np.where(x[:, t[0]] > t[1], t[3], t[2])
    return sum(np.where(x[:, f] > c, leaf(high), leaf(low)) for f, c, low, high in trees)


_fitted: tuple[list[tuple], dict[str, float]] | None = None


def featured(spark: SparkSession, rows: list[dict]) -> list:
    """The rows with x, their features by the same expressions as those of the texts, in the order given."""
    kind = "array<struct<kind:string,value:string,before:string,after:string,y:int,held:int>>"
    table = spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(rows)), kind)).alias("i", "s"))
    return sorted(table.select("i", "s.*", features(F.col("s")).alias("x")).collect(), key=lambda r: r.i)


def fit(spark: SparkSession) -> tuple[list[tuple], dict[str, float]]:
    """The trees and each kind's threshold; constants decide them, so they are fitted once a process."""
    global _fitted
    if _fitted is None:
        got = featured(spark, training_rows())
        x, y, kinds = np.array([r.x for r in got]), np.array([r.y for r in got], float), np.array([r.kind for r in got])
        held = np.array([r.held for r in got]) == 1
        trees = _boost(x[~held], y[~held])
        score, cut = _value(trees, x), {}
        for k in MORE:
            own = held & (kinds == k)
            order = np.argsort(-score[own], kind="stable")
            s, right = score[own][order], np.cumsum(y[own][order])
            ok = (right >= PRECISION * np.arange(1, len(s) + 1)) & np.append(s[1:] < s[:-1], True)
            cut[k] = float(s[np.flatnonzero(ok)[-1]]) if ok.any() else float("inf")
        _fitted = trees, cut
    return _fitted


def _tree_column(trees: list[tuple], x: Column) -> Column:
    leaf = lambda t: F.when(F.get(x, F.lit(t[0])) > float(t[1]), t[3]).otherwise(t[2])
    parts = [F.when(F.get(x, F.lit(f)) > float(c), leaf(high)).otherwise(leaf(low)) for f, c, low, high in trees]
    while len(parts) > 1:
        parts = [reduce(lambda a, b: a + b, parts[i : i + 4]) for i in range(0, len(parts), 4)]
    return parts[0]


def selected(span: Column, trees: list[tuple], cut: dict[str, float]) -> Column:
    """Whether a candidate (kind, value, before, after) is personal data."""
    # scores are sums in another order than numpy's, so a threshold, which is a score, gets a little room
    score = let(features(span), lambda x: _tree_column(trees, x)) + 1e-9
    least = reduce(lambda acc, k: F.when(span["kind"] == k, cut[k]).otherwise(acc), MORE, F.lit(float("inf")))
    return ((span["kind"] == "account") & _check97(span["value"])) | (score >= least)


def _plain(kind: Column, s: Column) -> Column:
    return F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def _entry(proposed: bool, s: Column, kind: Column, rank: int, value: Column, before: Column, after: Column) -> Column:
    return F.struct(s["start"].alias("start"), F.lit(proposed).alias("proposed"), s["end"].alias("end"), F.lit(rank).alias("rank"), kind.alias("kind"), value.alias("value"), before.alias("before"), after.alias("after"))


def _proposed(kind: str, rank: int) -> Callable[[Column], Column]:
    return lambda s: _entry(True, s, F.lit(kind), rank, s["value"], s["before"], s["after"])


def _free(every: Column) -> Column:
    """The candidates of ``every`` (start, proposed, end, ...; sorted) that overlap no base span."""
    ends = F.transform(every, lambda s: F.when(s["proposed"], -1).otherwise(s["end"]))
    starts = F.transform(F.reverse(every), lambda s: F.when(s["proposed"], 1 << 30).otherwise(s["start"]))
    before, after = running(ends, F.lit(-1), F.greatest), running(starts, F.lit(1 << 30), F.least)
    both = F.struct(before.alias("b"), after.alias("a"), F.size(every).alias("n"))
    return let(both, lambda x: F.filter(every, lambda s, i: s["proposed"] & (F.get(x["b"], i) <= s["start"]) & (F.get(x["a"], x["n"] - 1 - i) >= s["end"])))


def _with_spans(df: DataFrame) -> DataFrame:
    """Adds base_spans (by kind, then start) and more_spans (likewise) to rows with a text ``t``."""
    trees, cut = fit(df.sparkSession)
    digit = F.col("t").rlike("[0-9]")
    wanted = {"email": F.contains("t", F.lit("@")), "phone": F.contains("t", F.lit("+")), "spelt_email": F.col("t").rlike(r"(?i)[(\[]at[)\]]"), "ip": F.col("t").rlike(r"[0-9]\.[0-9]")}
    named, kinds = df.columns, [*BASE, *MORE]
    for k, pattern in (BASE | MORE).items():
        ok = wanted.get(k, digit)
        df = df.withColumns({f"v_{k}": F.when(ok, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))), f"p_{k}": F.when(ok, F.split("t", pattern, -1))})
    df = df.withColumns({f"l_{k}": F.zip_with(f"v_{k}", F.slice(f"p_{k}", 1, F.size(f"v_{k}")), lambda v, p: F.length(v) + F.length(p)) for k in kinds})
    df = df.select(*named, *[_spans(f"l_{k}", f"v_{k}", f"p_{k}").alias(f"s_{k}") for k in kinds])
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    checked = lambda k: F.transform(F.filter(f"s_{k}", lambda s: _passes(k, s["value"])), lambda s: _plain(F.lit(k), s))
    df = df.withColumn("base_spans", F.concat(*[F.coalesce(checked(k), none) for k in BASE]))
    base = F.transform("base_spans", lambda s: _entry(False, s, s["kind"], 0, F.lit(""), F.lit(""), F.lit("")))
    proposed = [F.coalesce(F.transform(f"s_{k}", _proposed(k, i)), F.slice(base, 1, 0)) for i, k in enumerate(MORE)]
    df = df.withColumn("more", F.concat(*proposed)).withColumn("every", F.when(F.size("more") > 0, F.array_sort(F.concat(base, F.col("more")))))
    chosen = F.filter(_free(F.col("every")), lambda s: selected(s, trees, cut))
    df = df.withColumn("chosen", F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["rank"].alias("rank"), s["kind"].alias("kind")))))
    upto = running(F.transform("chosen", lambda s: -s["minus_end"]), F.lit(0), F.greatest)
    outer = let(upto, lambda u: F.filter("chosen", lambda s, i: F.get(u, i) < -s["minus_end"]))
    ranked = F.array_sort(F.transform(outer, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), (-s["minus_end"]).alias("end"), s["kind"].alias("kind"))))
    return df.select(*named, "base_spans", F.coalesce(F.transform(ranked, lambda s: _plain(s["kind"], s)), none).alias("more_spans"))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, base_spans and more_spans, arrays of (kind, start, end) by kind, then start, of every row."""
    return _with_spans(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))).drop("t")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each selected span replaced by its kind in angle brackets; spans that overlap go together, under the first one's kind."""
    found = _with_spans(packed(docs, t=F.coalesce(F.col("text").cast("string"), F.lit(""))))
    found = found.withColumn("spans", F.array_sort(F.transform(F.concat("base_spans", "more_spans"), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind")))))
    found = found.withColumn("ends", F.transform("spans", lambda s: -s["minus_end"]))
    found = found.withColumn("upto", running(F.col("ends"), F.lit(0), F.greatest))  # the furthest end before each span, and of all
    found = found.withColumn("heads", F.filter(F.transform("spans", lambda s, i: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), i.alias("i"))), lambda h: (h["i"] == 0) | (h["start"] >= F.get(F.col("upto"), h["i"]))))
    pieces = found.withColumn("c", chunks(F.col("t")))
    kept = F.transform("heads", lambda h: F.concat(between(F.col("c"), F.when(h["i"] == 0, 0).otherwise(F.get(F.col("upto"), h["i"])), h["start"]), F.lit("<"), h["kind"], F.lit(">")))
    text = F.concat(F.array_join(kept, ""), between(F.col("c"), F.element_at("upto", -1), F.length("t")))
    return unpacked(pieces, docs, text=F.when(F.size("spans") > 0, text).otherwise(F.col("row.text")))
