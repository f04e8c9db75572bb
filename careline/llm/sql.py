"""DuckDB SQL for the queries that SQL can express."""

from careline.llm.quality import ALPHA, DELTA, LADDERS

#: Bytes of text in a shard of the query, small enough that every test table is split.
SHARD_BYTES = 1 << 20

_BARE = r"regexp_replace({}, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, u.pos, u.line, {_LOWER.format(_BARE.format('u.line'))} AS k
  FROM documents, LATERAL (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos) u),
s AS (SELECT k, min(doc_id) AS first FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT l.*, s.k IS NOT NULL AND l.doc_id <> s.first AS gone FROM l LEFT JOIN s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_LADDER_ROWS = ", ".join(f"('{rule}', {i}, {step})" for rule, steps in LADDERS.items() for i, step in enumerate(steps))

QUALITY_RULES = rf"""
WITH w AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
wins AS (SELECT doc_id, u.i, array_to_string(w[u.i:u.i + 7], ' ') AS g FROM w, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i) u),
rep AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS j FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM wins) WHERE c > 1)
  GROUP BY doc_id),
c AS MATERIALIZED (
  SELECT w.doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
m AS MATERIALIZED (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats,
    CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS long_words
  FROM c),
ladder(rule, i, cutoff) AS (VALUES {_LADDER_ROWS}),
tall AS (SELECT doc_id, stratum, base_failed, rule, value FROM m UNPIVOT (value FOR rule IN (symbols, dup_lines, repeats, long_words))),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
tests AS (
  SELECT stratum, rule, i, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS k
  FROM tall JOIN good USING (doc_id) JOIN ladder USING (rule) WHERE NOT base_failed GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN k > n * {ALPHA / len(LADDERS)} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j:
    exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({ALPHA / len(LADDERS)}) + (n - j) * ln(1 - {ALPHA / len(LADDERS)})))) END AS p
  FROM tests),
passed AS (
  SELECT stratum, rule, cutoff FROM tails t WHERE NOT EXISTS (
    SELECT 1 FROM tails f WHERE f.stratum = t.stratum AND f.rule = t.rule AND f.i <= t.i
      AND f.p > {DELTA} / (SELECT count(DISTINCT (stratum, rule)) FROM tails))),
cuts AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM passed GROUP BY ALL),
bad AS (SELECT DISTINCT doc_id FROM tall JOIN cuts USING (stratum, rule) WHERE value > cutoff)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM m LEFT JOIN bad USING (doc_id)
"""

DECONTAMINATION = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
wins AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[u.i:u.i + 12], ' ') AS g
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 12, least(len(w), 1)) + 1)) AS i) u),
sizes AS (SELECT DISTINCT n FROM wins),
occ AS MATERIALIZED (
  SELECT p.doc_id, p.i, wins.n, wins.item_id FROM (
    SELECT doc_id, n, u.i, array_to_string(w[u.i:u.i + n - 1], ' ') AS g
    FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) u) p JOIN wins USING (n, g)),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

CHAT_FORMAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, u.turn, u.role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) u(turn, role)),
s AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS NOT DISTINCT FROM role AS same,
    length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS n,
    length(replace(replace(replace(role, '%', '%25'), '<', '%3C'), chr(10), '%0A')) AS r
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE WHEN same THEN length('<|im_next|>') ELSE r + length('<|im_start|>' || chr(10) || '<|im_end|>' || chr(10)) END)
       AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

SUBSTRING_DEDUP = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS MATERIALIZED (
  SELECT doc_id, u.i, array_to_string(w[u.i:u.i + 19], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 18)) AS i) u),
late AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM wins) WHERE n > 1),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM late),
kept AS (
  SELECT t.doc_id, count(*) FILTER (gone.j IS NOT NULL) AS n, string_agg(t.word, ' ' ORDER BY t.j) FILTER (gone.j IS NULL) AS s
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d) t LEFT JOIN gone USING (doc_id, j) GROUP BY t.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

def sharding(limit: int) -> str:
    """Buckets are the shortest prefixes that fit; for tables in which no two rows share 40 bits of hash."""
    return f"""
WITH r AS MATERIALIZED (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS bytes,
    lpad(bin(('0x' || left(md5(coalesce(doc_id::VARCHAR, '')), 15))::BIGINT), 60, '0') AS bits FROM documents),
p AS (SELECT doc_id, bytes, d.d AS depth, left(bits, d.d) AS shard FROM r, (SELECT unnest(range(0, 41)) AS d) d),
s AS MATERIALIZED (SELECT shard, sum(bytes) AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY shard),
f AS (SELECT p.*, s.shard_bytes, s.shard_rows, row_number() OVER (PARTITION BY doc_id ORDER BY p.depth) AS n FROM p JOIN s USING (shard) WHERE shard_bytes <= {limit} OR shard_rows = 1)
SELECT doc_id, bytes, shard, CAST(depth AS INTEGER) AS depth, CAST(0 AS BIGINT) AS part, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows FROM f WHERE n = 1
"""


FILTER_AUDIT = rf"""
WITH w AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
d AS MATERIALIZED (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f
  FROM w LEFT JOIN l USING (doc_id)),
m AS MATERIALIZED (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY ALL),
x AS (SELECT unnest(range(1, 6)) AS i),
o AS MATERIALIZED (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (
  SELECT part, array_to_string(list_transform(o, lambda k: 'ABCDE'[k]), '') AS filter_order, x.i AS step, o[x.i] AS own, n, good, toxic,
    f[o[x.i]] AS fails, list_contains(list_transform(o[:x.i - 1], lambda k: f[k]), true) AS earlier, len(list_filter(f, lambda b: b)) AS n_fails
  FROM m, o, x),
r AS MATERIALIZED (
  SELECT part, filter_order, step, own, sum(n) FILTER (NOT fails AND NOT earlier) AS kept, sum(n) FILTER (fails AND NOT earlier) AS removed,
    sum(n) FILTER (fails AND earlier) AS redundant, sum(n) FILTER (fails AND n_fails = 1) AS unique_fails,
    sum(good) FILTER (fails AND NOT earlier) AS good_lost, sum(toxic) FILTER (fails AND NOT earlier) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, {', '.join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in
  ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""


_SHARE = "1 + (1000000000::HUGEINT * ({n} + 1)) // ({total} + v)"
_FAR = "((p - q) * (p - q)) // q"

SOURCE_DIVERGENCE = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS MATERIALIZED (
  SELECT lang, source, i, unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL) USING (lang, source) LEFT JOIN v USING (lang)),
p AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, {_SHARE.format(n='coalesce(n, 0)', total='total')} AS p
  FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
q AS (
  SELECT lang, term, {_SHARE.format(n='s', total='total')} AS q FROM (SELECT lang, term, sum(n) AS s FROM n GROUP BY ALL)
  JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS total FROM n GROUP BY lang) USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source AS sa, b.source AS sb, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS f
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) x ON x.lang = a.lang AND sa = a.source AND sb = b.source),
terms AS (SELECT lang, source, term AS item, {_FAR} AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM r)
WHERE part = 'pair' OR rank <= 200
"""


ORACLES: dict[str, str] = {"op12_source_divergence": SOURCE_DIVERGENCE, "op11_filter_audit": FILTER_AUDIT, "op2_quality_rules": QUALITY_RULES, "op8_sharding": sharding(SHARD_BYTES), "op3_decontamination": DECONTAMINATION, "op4_chat_format": CHAT_FORMAT, "op7_substring_dedup": SUBSTRING_DEDUP, "op10_line_dedup": LINE_DEDUP}
