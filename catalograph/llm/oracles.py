"""SQL twins of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from catalograph.llm import quality, sharding

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
word AS (SELECT doc_id, p, ws[p] AS w FROM docs, unnest(range(1, len(ws) + 1)) t(p)),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM docs, unnest(range(1, len(ws) - 11)) t(i)),
owner AS (SELECT g, min(doc_id) AS o FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN owner USING (g), unnest(range(0, 13)) t(k) WHERE o < doc_id),
rest AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS kept FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN rest USING (doc_id)
"""

MIX_SOURCES = f"""
WITH docs AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS key FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 2.0::DOUBLE * source_size AS cap FROM src),
filling AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS f FROM weighed),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER earlier, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0)) AS level
  FROM filling WINDOW earlier AS (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
target AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, f) FROM levels WHERE level < cap / w) * w, cap)) AS target FROM levels),
queue AS (
  SELECT doc_id, d.source, size, source_size, target, key, sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs d JOIN target t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, coalesce((upto + r * source_size) / nullif(target, 0), 0) AS finish FROM queue, unnest([0, 1]) x(r) WHERE r = 0 OR size > 0),
merged AS (
  SELECT *, sum(size) OVER (ORDER BY finish, coalesce(source, ''), source IS NULL, key, size, r ROWS UNBOUNDED PRECEDING) AS spent FROM copies)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(sum(CASE WHEN spent <= 1.5 * (SELECT sum(size) FROM docs) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM merged GROUP BY doc_id
"""

EXACT_TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS vector
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_sum([a[1] * a[2] for a in list_zip(q.vector, c.vector)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.vector) = len(c.vector) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def sharding_sql(limit: int) -> str:
    return f"""
WITH docs AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
         lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, {sharding.BITS // 4}) AS BIGINT)), {sharding.BITS}, '0') AS bits FROM documents),
cell AS (SELECT *, substr(bits, 1, depth) AS shard FROM docs, unnest(range(0, 33)) t(depth)),
sums AS (SELECT depth, shard, sum(n_bytes) AS shard_bytes, count(*) AS n FROM cell GROUP BY ALL),
fits AS (SELECT doc_id, min(depth) AS depth FROM cell JOIN sums USING (depth, shard) WHERE shard_bytes <= {limit} OR n = 1 GROUP BY doc_id)
SELECT doc_id, n_bytes, shard, CAST(depth AS INTEGER) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_bytes > {limit} AS oversized
FROM cell JOIN fits USING (doc_id, depth) JOIN sums USING (depth, shard)
"""


def quality_sql(risk: quality.Risk = quality.Risk()) -> str:
    rules = ", ".join(f"{{'rule': {k}, 'score': coalesce(CAST({score.replace(' / ', ' AS DOUBLE) / nullif(')}, 0), 0)}}" for k, (_, score, _) in enumerate(risk.grid))
    steps = ", ".join(f"({k}, {step}, {cut!r})" for k, (_, _, grid) in enumerate(risk.grid) for step, cut in enumerate(grid))
    bands = " + ".join(f"CAST(n_words >= {b} AS INTEGER)" for b in quality.BANDS)
    p, error = risk.risk, risk.error / (len(quality.BANDS) + 1)
    spaces = r"'[\x20\x09-\x0D]'"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
line AS (SELECT doc_id, [l for l in string_split(text, chr(10)) if regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS ls FROM docs),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM docs, unnest(range(1, len(ws) - 1)) t(i)),
twice AS (SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1),
again AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win JOIN twice USING (doc_id, g), unnest([0, 1, 2]) t(k) GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, {spaces}, '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM docs JOIN line USING (doc_id) LEFT JOIN again USING (doc_id)),
scored AS (
  SELECT *, row_number() OVER () AS row, {bands} AS stratum, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [{rules}] AS scores FROM counted),
known AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) IS NOT NULL),
told AS (SELECT row, stratum, good > 0 AS good, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) >= '8' AS held, s.rule AS rule, s.score AS score
         FROM scored JOIN known USING (doc_id), unnest(scores) t(s) WHERE NOT base_failed),
grid AS (SELECT * FROM (VALUES {steps}) t(rule, step, cutoff)),
tested AS (
  SELECT stratum, rule, step, cutoff, count(*) FILTER (NOT held AND NOT good AND score > cutoff) AS junk,
         count(*) FILTER (NOT held AND good AND score > cutoff) AS lost
  FROM told JOIN grid USING (rule) GROUP BY ALL),
useful AS (SELECT * FROM (SELECT *, lag(junk, 1, 0) OVER (PARTITION BY stratum, rule ORDER BY step) AS earlier FROM tested) x WHERE junk > earlier),
added AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY lost, step, junk DESC, rule) AS m FROM useful),
lost AS (
  SELECT h.row, h.stratum, min(a.m) AS place
  FROM told h LEFT JOIN added a ON a.stratum = h.stratum AND a.rule = h.rule AND h.score > a.cutoff WHERE held AND good GROUP BY ALL),
reached AS (
  SELECT a.stratum, a.m, a.rule, a.cutoff, count(*) AS n, count(*) FILTER (l.place <= a.m) AS k
  FROM added a JOIN lost l USING (stratum) GROUP BY ALL),
certified AS (
  SELECT *, list_sum([exp(lgamma(n + 1) - CASE WHEN j = 0 THEN 0 ELSE lgamma(j + 1) END - CASE WHEN j = n THEN 0 ELSE lgamma(n - j + 1) END
         + j * ln({p!r}) + (n - j) * ln(1 - {p!r})) for j in range(0, k + 1)]) <= {error!r} AS good FROM reached),
chain AS (SELECT *, bool_and(good) OVER (PARTITION BY stratum ORDER BY m) AS passed FROM certified),
broken AS (SELECT DISTINCT d.row FROM scored d, unnest(d.scores) t(s), chain b
           WHERE b.passed AND b.stratum = d.stratum AND b.rule = s.rule AND s.score > b.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND row NOT IN (SELECT row FROM broken) AS kept
FROM scored
"""


HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS vector FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum([x[1] * x[2] for x in list_zip(a.vector, c.vector)]) AS BIGINT) AS score
  FROM v a JOIN v c ON a.row <> c.row AND len(a.vector) = len(c.vector) WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM scored WHERE same),
negative AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positive p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
  WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 10
"""
