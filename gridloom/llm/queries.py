"""The registered ``opN_*`` queries over the whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, lexical, line_dedup, lm_quality, mixing, near_dup, pii, quality_rules, secrets, substring_dedup, tokens, toxicity
from .common import settled, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = settled(spark, lambda: line_dedup.mark_lines(table(spark, sf_dir, "documents")), "op1")
    return marked.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


OP1_SQL = r"""
WITH split AS (SELECT doc_id, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS dk, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, dk, pos, regexp_extract_all(lower(ls[pos + 1]), '[^\x20\x09-\x0D]+') AS ws FROM (SELECT DISTINCT doc_id, dk, ls, unnest(range(0, len(ls))) AS pos FROM split)),
firsts AS (SELECT ws, min((doc_id, dk, pos)) AS place FROM l WHERE len(ws) >= 3 GROUP BY ws),
v AS (SELECT ws, place, i, list_concat(list_slice(ws, 1, i - 1), list_slice(ws, i + 1, len(ws))) AS cut FROM (SELECT ws, place, unnest(range(1, len(ws) + 1)) AS i FROM firsts WHERE len(ws) >= 8)),
held AS (SELECT cut, i, min(place) AS keeper FROM v GROUP BY cut, i HAVING count(*) > 1),
near AS (
  SELECT v.ws FROM v JOIN held USING (cut, i) WHERE v.place > held.keeper
  UNION SELECT CASE WHEN v.place > f.place THEN v.ws ELSE f.ws END FROM v JOIN firsts f ON v.cut = f.ws WHERE len(f.ws) >= 8),
gone AS (SELECT DISTINCT l.doc_id, l.dk, l.pos FROM l JOIN firsts f USING (ws) LEFT JOIN (SELECT DISTINCT ws, 1 AS is_near FROM near) n USING (ws)
  WHERE len(l.ws) >= 3 AND (is_near = 1 OR (l.doc_id, l.dk, l.pos) <> f.place)),
per AS (SELECT doc_id, dk, count(*) AS n, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS removed FROM gone GROUP BY doc_id, dk)
SELECT split.doc_id, len(ls)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM split LEFT JOIN per ON split.doc_id IS NOT DISTINCT FROM per.doc_id AND split.dk = per.dk
"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = settled(spark, lambda: mixing.plan_mix(table(spark, sf_dir, "documents")), "op2")
    return planned.select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 3))::INTEGER AS bin,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 4, 10))::BIGINT::DOUBLE / 1099511627776.0 AS fine
  FROM documents),
bins AS (SELECT source, bin, sum(size)::BIGINT AS words FROM sized GROUP BY ALL),
sizes AS (SELECT source, sum(words)::BIGINT AS source_size FROM bins GROUP BY ALL),
ranked AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w FROM sizes),
filled AS (SELECT *, 2.0::DOUBLE * source_size / w AS fill FROM ranked),
levels AS (SELECT *,
    (1.5::DOUBLE * sum(source_size) OVER ()
      - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM filled),
targets AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, max(level) OVER () * w) AS target FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS base FROM targets),
needs AS (SELECT *, target - base * source_size AS need FROM rates),
runs AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before FROM bins),
edges AS (SELECT r.source, r.bin AS edge, (n.need - r.before) / r.words AS p FROM runs r JOIN needs n ON r.source IS NOT DISTINCT FROM n.source
  WHERE r.words > 0 AND r.before <= n.need AND n.need < r.before + r.words)
SELECT s.doc_id, s.size, n.source_size, n.target,
  ((n.base + (s.bin < coalesce(e.edge, -1) OR (s.bin = coalesce(e.edge, -1) AND s.fine < coalesce(e.p, 0)))::INT) * s.size)::BIGINT AS taken
FROM sized s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source LEFT JOIN edges e ON s.source IS NOT DISTINCT FROM e.source
"""


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]
    counts = [F.size(secrets.of_kinds(F.col("spans"), [k])).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(secrets.spans_text(secrets.of_kinds(F.col("spans"), base)), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans"))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = settled(spark, lambda: near_dup.link_components(table(spark, sf_dir, "documents"), k=3, percent=85), "op4")
    return linked.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(list_slice(ws, i, i + 2), ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 2) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary="word_bpe_49k.json")
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op6_lm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = settled(spark, lambda: lm_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "op6")
    return judged.select("doc_id", "lang", "n_symbols", "perplexity", "worst", "least", "most", "most_worst", "kept")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, lambda: substring_dedup.cut_repeats(table(spark, sf_dir, "documents"), size=35), "op7")


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT rid, i, md5(array_to_string(list_slice(ws, i, i + 34), ' ')) AS h FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM w JOIN twice USING (h)),
spots AS (SELECT rid, list(p) AS ps FROM gone GROUP BY rid),
kept AS (SELECT d.rid, string_agg(word, ' ' ORDER BY d.p) AS text FROM (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d) d LEFT JOIN gone g ON d.rid = g.rid AND d.p = g.p WHERE g.p IS NULL GROUP BY d.rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN spots USING (rid) LEFT JOIN kept USING (rid)
"""


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [F.size(pii.of_kind(F.col("base_spans"), k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    every = F.concat("base_spans", "more_spans")
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(F.col("base_spans")), 256).alias("base_sha256"), pii.spans_text(every).alias("spans"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = settled(spark, lambda: decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10), "op9")
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bn AS (SELECT item, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
w AS (SELECT DISTINCT item, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS win FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM bn)),
found AS (SELECT rid, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS win
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)),
hits AS (SELECT rid, found.n, i, item FROM found JOIN w USING (n, win)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = settled(spark, lambda: quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "op10")
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
tri AS (SELECT rid, i, list_slice(ws, i, i + 2) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
rep AS (SELECT rid, i FROM tri QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rw AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
ln AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
b AS (SELECT d.rid, doc_id, lang, t, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars, (len(t) - len(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
  coalesce(ln.n, 0)::BIGINT AS n_dup_lines, coalesce(rw.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN rw USING (rid) LEFT JOIN ln USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  regexp_replace(t, '\p{Ll}+', '', 'g') AS r1, regexp_replace(r1, '[\x20\x09-\x0D]+', '', 'g') AS r2, regexp_replace(r2, '\p{Lu}+', '', 'g') AS r3, regexp_replace(r3, '[.,;:!?''"()-]+', '', 'g') AS r4, regexp_replace(r4, '[0-9]+', '', 'g') AS r5 FROM b),
lw AS (SELECT rid, lang, unnest(regexp_extract_all(lower(t), '\p{L}+')) AS w FROM d),
top AS (SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS k FROM lw GROUP BY lang, w QUALIFY k <= 12),
slots AS (SELECT f.rid, top.k, top.w FROM f JOIN top ON f.lang IS NOT DISTINCT FROM top.lang),
hits AS (SELECT lw.rid, top.k, count(*) AS c FROM lw JOIN top ON lw.lang IS NOT DISTINCT FROM top.lang AND lw.w = top.w GROUP BY ALL),
total AS (SELECT rid, count(*) AS n FROM lw GROUP BY rid),
hist AS (
  SELECT rid, 'c' AS kind, unnest(range(1, 7)) AS k, unnest([len(t) - len(r1), len(r1) - len(r2), len(r2) - len(r3), len(r3) - len(r4), len(r4) - len(r5), len(r5)]) AS c FROM f
  UNION ALL SELECT rid, 'w', k, coalesce(hits.c, 0) FROM slots LEFT JOIN hits USING (rid, k)
  UNION ALL SELECT f.rid, 'w', 99, coalesce(total.n, 0) - coalesce((SELECT sum(c) FROM hits WHERE hits.rid = f.rid), 0) FROM f LEFT JOIN total USING (rid) WHERE f.rid IN (SELECT rid FROM slots)),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND toxic = 0),
cand AS (SELECT rid, lang, (doc_id IN (SELECT doc_id FROM good))::INT AS g FROM f WHERE NOT base_failed),
best AS (SELECT lang, max(g) AS g FROM cand GROUP BY lang),
ref AS (SELECT cand.lang, kind, k, sum(c) AS c FROM cand JOIN best ON cand.lang IS NOT DISTINCT FROM best.lang AND cand.g = best.g JOIN hist USING (rid) GROUP BY ALL),
q AS (SELECT lang, kind, k, c / sum(c) OVER (PARTITION BY lang, kind) AS q FROM ref),
p AS (SELECT hist.rid, lang, kind, k, CASE WHEN sum(c) OVER (PARTITION BY hist.rid, kind) > 0 THEN c / sum(c) OVER (PARTITION BY hist.rid, kind) END AS p FROM hist JOIN f USING (rid)),
js AS (SELECT rid, p.kind, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS dist
  FROM p JOIN q ON p.lang IS NOT DISTINCT FROM q.lang AND p.kind = q.kind AND p.k = q.k WHERE p IS NOT NULL GROUP BY rid, p.kind),
wide AS (SELECT rid, max(dist) FILTER (kind = 'c') AS cd, max(dist) FILTER (kind = 'w') AS wd FROM js GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (word_chars >= 200 AND coalesce(cd, 0) > 0.2) AND NOT (n_words >= 100 AND coalesce(wd, 0) > 0.24) AS kept
FROM f LEFT JOIN wide USING (rid)
"""


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, lambda: toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "op11")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, lambda: lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10), "op12")


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS docs, sum(len(ts))::BIGINT AS length FROM d),
q AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT iid, term, count(*)::BIGINT AS q FROM (SELECT iid, unnest(ts) AS term FROM q) GROUP BY ALL),
post AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM post, s GROUP BY term),
worth AS (SELECT rid, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(ts)::BIGINT * docs) // length)) AS impact FROM post JOIN d USING (rid), s),
scores AS (SELECT iid, rid, sum(q * w * impact)::BIGINT AS score FROM asked JOIN w USING (term) JOIN worth USING (term) GROUP BY iid, rid HAVING score > 0),
ranked AS (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores JOIN d USING (rid))
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN q USING (iid) WHERE rank <= 10
"""


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return settled(spark, lambda: conversations.audit(rows, conversations.damaged(rows)), "op13")


OP13_SQL = r"""
WITH RECURSIVE bits AS (SELECT i, 0 AS k, i AS v FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
spelled AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
hashed AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(s, ''), lambda c: ascii(c)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault FROM spelled, tab),
hit AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM hit JOIN convs ON hit.conv_id IS NOT DISTINCT FROM convs.conv_id),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS bad FROM placed),
counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (bad) AS illegal FROM judged GROUP BY c),
jumps(q, letters, r) AS (VALUES (0, '', 0), (0, 'I', 2), (0, 'II', 3), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (2, '', 2), (2, 'I', 3), (3, '', 3), (3, 'I', 2)),
acts(r, role, act, price, z) AS (VALUES (0, '', 'D', 4, 0), (1, '', 'D', 4, 1), (2, '', 'D', 4, 2), (3, '', 'D', 4, 3), (0, '', 'R', 3, 2), (1, '', 'R', 3, 2), (2, '', 'R', 3, 3), (3, '', 'R', 3, 2),
  (0, 's', 'K', 0, 1), (0, 'u', 'K', 0, 2), (1, 'u', 'K', 0, 2), (3, 'u', 'K', 0, 2), (2, 'a', 'K', 0, 3)),
best AS (
  SELECT c, 0 AS i, 0 AS q, {'cost': 0::BIGINT, 'audit': ''} AS p FROM convs
  UNION ALL
  SELECT b.c, b.i + 1, acts.z, min({'cost': b.p.cost + 3 * len(jumps.letters) + acts.price + CASE WHEN act <> 'D' AND fault = 't' THEN 3 ELSE 0 END, 'audit': b.p.audit || jumps.letters || act})
  FROM best b JOIN judged j ON j.c = b.c AND j.i = b.i + 1 JOIN jumps ON jumps.q = b.q JOIN acts ON acts.r = jumps.r AND (acts.role = '' OR acts.role = left(j.role, 1)) WHERE act = 'D' OR fault NOT IN ('b', 'd')
  GROUP BY b.c, b.i, acts.z),
size AS (SELECT convs.c, coalesce(max(judged.i), 0) AS n FROM convs LEFT JOIN judged USING (c) GROUP BY convs.c),
done AS (SELECT c, min({'cost': p.cost + [0, 6, 3, 0][q + 1], 'audit': p.audit || ['', 'II', 'I', ''][q + 1]}) AS p FROM best JOIN size USING (c) WHERE i = n GROUP BY c),
letters AS (SELECT c, pos, p.audit[pos] AS x FROM (SELECT c, p, unnest(range(1, len(p.audit) + 1)) AS pos FROM done)),
spots AS (SELECT c, pos, x, count(*) FILTER (x <> 'I') OVER w AS i, count(*) FILTER (x <> 'D') OVER w AS o FROM letters WINDOW w AS (PARTITION BY c ORDER BY pos)),
said AS (SELECT s.c, pos, x, o, CASE WHEN x = 'I' THEN '' ELSE j.role END AS role, CASE WHEN x = 'I' THEN '' ELSE j.text END AS text FROM spots s LEFT JOIN judged j ON s.c = j.c AND s.i = j.i WHERE x <> 'D'),
heads AS (SELECT c, (x = 'K' AND left(role, 1) = 's')::INT AS head FROM said WHERE o = 1),
repaired AS (SELECT c, string_agg(CASE WHEN x = 'K' THEN role WHEN (o - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS text FROM said JOIN heads USING (c) GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  done.p.cost::BIGINT AS cost, done.p.audit AS audit, sha256(coalesce(repaired.text, '')) AS repaired_sha256
FROM convs JOIN done USING (c) LEFT JOIN counts USING (c) LEFT JOIN repaired USING (c)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_mixing": op2_mixing,
        "op3_secrets": op3_secrets,
        "op4_near_dup": op4_near_dup,
        "op5_tokens": op5_tokens,
        "op6_lm_quality": op6_lm_quality,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_pii": op8_pii,
        "op9_decontaminate": op9_decontaminate,
        "op10_quality_rules": op10_quality_rules,
        "op11_toxicity": op11_toxicity,
        "op12_lexical": op12_lexical,
        "op13_conversations": op13_conversations,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op2_mixing": OP2_SQL, "op4_near_dup": OP4_SQL, "op7_substring_dedup": OP7_SQL, "op9_decontaminate": OP9_SQL, "op10_quality_rules": OP10_SQL, "op12_lexical": OP12_SQL, "op13_conversations": OP13_SQL}
