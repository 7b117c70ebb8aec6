"""DuckDB SQL of the corpus queries that SQL can express.

op1, op3, op5-op8, op12 and op13 have none (64-bit seeded hashes, trained trees, turn-wise
table filling, BPE merges, threshold retrieval, keyed Feistel rounds and eigenvectors);
tests/llm holds them against brute force."""

from __future__ import annotations

from ingestry.llm.license_rules import BASE_PHRASES, BASE_WEIGHT, rules

OP2 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, encode(coalesce(text, '')) AS raw FROM documents),
p AS (SELECT doc_id, raw, unnest(range(0, greatest(length(h) // 2 - 399, 0))) AS i FROM d),
s AS (SELECT doc_id, i, md5(array_slice(raw, i + 1, i + 400)) AS m FROM p),
c AS (SELECT m FROM s GROUP BY m HAVING count(*) > 1),
hit AS (SELECT doc_id, i, i > 400 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS apart FROM s SEMI JOIN c USING (m)),
run AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM
  (SELECT *, count(*) FILTER (apart) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM hit) GROUP BY doc_id, k),
piece AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since, b FROM run),
kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || substring(any_value(h), 2 * max(b) + 1) AS k,
    sum(b - a) AS n_removed, count(*) AS n_spans FROM piece JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w),
g AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM p),
twice AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM g JOIN twice USING (doc_id, g), (VALUES (0), (1), (2)) v(o) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM d),
judged AS (
  SELECT *, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
    regexp_matches(x, '[^\x20\x09-\x0D]') AS has_word,
    length(regexp_replace(x, '[^#*$%&<>!?=~^_{}\\\[\]]', '', 'g')) AS noise,
    length(regexp_replace(x, '[^|»·]', '', 'g')) AS bars
  FROM l),
lines AS (
  SELECT doc_id, count(*) FILTER (has_word) - count(DISTINCT x) FILTER (has_word) AS n_dup,
    coalesce(sum(strlen(x)) FILTER (NOT fails), 0) + greatest(count(*) FILTER (NOT fails) - 1, 0) AS kept_bytes
  FROM (SELECT *, 2 * noise > words OR (bars >= 3 AND 4 * bars >= words) OR (words <= 20 AND regexp_matches(x, '{boilerplate}')) AS fails FROM judged)
  GROUP BY doc_id),
m AS (
  SELECT w.doc_id, w.t, len(w.w) AS n_words, coalesce(length(array_to_string(w.w, '')), 0) AS word_chars,
    length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, lines.n_dup AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, lines.kept_bytes
  FROM w JOIN lines USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * kept_bytes >= strlen(t) AS kept
FROM m
"""

OP4 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
every AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS pos FROM d),
l AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM every WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l),
b AS (SELECT *, upto - n AS before FROM c),
w AS (
  SELECT doc_id, min(pos) OVER f AS first, max(pos) OVER f AS last, sum(n) OVER f AS words, list(line) OVER f AS ls FROM b
  WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT doc_id, min(pos) OVER f, max(pos) OVER f, sum(n) OVER f, list(line) OVER f FROM b
  WINDOW f AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
g AS (SELECT doc_id, first, last, ls FROM w WHERE words >= 50),
e AS (SELECT ls, min(doc_id) AS d0, arg_min(first, (doc_id, first)) AS f0 FROM g GROUP BY ls),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM g JOIN e USING (ls) WHERE doc_id != d0 OR first != f0),
runs AS (SELECT doc_id, count(DISTINCT pos - k) AS n_runs, count(*) AS n_removed FROM
  (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM gone) GROUP BY doc_id),
kept AS (
  SELECT every.doc_id, string_agg(line, chr(10) ORDER BY every.pos) FILTER (gone.pos IS NULL) AS text, count(*) AS n
  FROM every LEFT JOIN gone ON every.doc_id = gone.doc_id AND every.pos = gone.pos GROUP BY every.doc_id)
SELECT d.doc_id, CASE WHEN t = '' THEN 0 ELSE kept.n END AS n_lines, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_runs, 0) AS n_runs, coalesce(kept.text, '') AS text
FROM d JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)
"""

OP11 = r"""
WITH RECURSIVE crc(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM crc WHERE k = 8),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS said FROM conversations),
hashed AS (
  SELECT raw.* EXCLUDE said, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(said) + 1), lambda i: ascii(said[i])::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d FROM raw, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN d = 0 THEN [] WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed),
placed AS (
  SELECT *, row_number() OVER c AS i, left(role, 1) AS x,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS z
  FROM damaged WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faulty AS (
  SELECT *, CASE WHEN z = '' THEN 'b' WHEN again THEN 'd' WHEN z NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f,
    lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x AS step FROM placed),
letter(s, x, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
put(s, t, said) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
ins(s, t, n, said) AS (
  SELECT s, s, 0, []::VARCHAR[] FROM put UNION ALL SELECT s, t, 1, [said || ':'] FROM put UNION ALL
  SELECT a.s, b.t, 2, [a.said || ':', b.said || ':'] FROM put a JOIN put b ON b.s = a.t),
act AS (
  SELECT conv_id, i, s, s AS t, 3 AS c, 'D' AS e, []::VARCHAR[] AS said FROM faulty, put UNION ALL
  SELECT conv_id, i, s, t, 2 + (f = 't')::INT, 'R', [said || ':' || text] FROM faulty, put WHERE f NOT IN ('b', 'd') UNION ALL
  SELECT conv_id, i, s, t, (f = 't')::INT, 'K', [role || ':' || text] FROM faulty JOIN letter USING (x) WHERE f NOT IN ('b', 'd')),
way(conv_id, i, s, c, a, said) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, 0, '', []::VARCHAR[] FROM conversations UNION ALL
  SELECT conv_id, i, t, best.c, best.a, best.said FROM (
    SELECT way.conv_id, act.i, act.t, min({'c': way.c + 2 * ins.n + act.c, 'a': way.a || repeat('I', ins.n) || act.e,
      'said': way.said || ins.said || act.said}) AS best
    FROM way JOIN ins ON ins.s = way.s JOIN act ON act.conv_id IS NOT DISTINCT FROM way.conv_id AND act.i = way.i + 1 AND act.s = ins.t
    GROUP BY ALL)),
done AS (
  SELECT way.conv_id, min({'c': way.c + 2 * ins.n, 'a': way.a || repeat('I', ins.n), 'said': way.said || ins.said}) AS best
  FROM way JOIN ins ON ins.s = way.s LEFT JOIN (SELECT conv_id, count(*) AS n FROM faulty GROUP BY 1) k
    ON k.conv_id IS NOT DISTINCT FROM way.conv_id
  WHERE ins.t IN (0, 3) AND way.i = coalesce(k.n, 0) GROUP BY 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank,
    count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
    count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY 1)
SELECT done.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.a AS audit,
  sha256(array_to_string(best.said, chr(10))) AS repaired_sha256
FROM done LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM done.conv_id
"""


def op10() -> str:
    table = ",\n".join(f"({r['o']}, '{r['l']}', '{r['k']}', '{r['p']}', {r['c']}::DOUBLE)" for r in rules())
    base = "\nUNION ALL\n".join(
        f"SELECT doc_id, '{label}' AS l, i - 1 AS i FROM p WHERE "
        + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase))
        for label, phrase in BASE_PHRASES
    )
    return rf"""
WITH rules(o, l, k, p, c) AS (VALUES {table}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
base AS ({base}),
t AS (SELECT doc_id, ' ' || array_to_string(w, '  ') || ' ' AS t FROM d WHERE len(w) > 0),
h AS (SELECT doc_id, o, l, c, regexp_extract_all(t, p) AS m, regexp_split_to_array(t, p) AS s FROM t JOIN rules ON contains(t, k)),
x AS (SELECT doc_id, o, l, c, unnest(m) AS m, unnest(s[:len(m)]) AS s, generate_subscripts(m, 1) AS i FROM h WHERE len(m) > 0),
spans AS (SELECT doc_id, o, l, c, e - length(m) AS b, e FROM
  (SELECT *, sum(length(s) + length(m)) OVER (PARTITION BY doc_id, o ORDER BY i) AS e FROM x)),
kept AS (SELECT * FROM spans z WHERE NOT EXISTS (SELECT 1 FROM spans y WHERE y.doc_id = z.doc_id AND y.b <= z.b AND y.e >= z.e
  AND (y.b < z.b OR y.e > z.e OR y.o < z.o))),
bl AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT l, ',' ORDER BY l) AS base_labels FROM base GROUP BY doc_id),
ml AS (SELECT doc_id, string_agg(DISTINCT l, ',' ORDER BY l) AS labels FROM (SELECT doc_id, l FROM kept UNION SELECT doc_id, l FROM base) GROUP BY doc_id),
sc AS (SELECT doc_id, max(c) AS score FROM (SELECT doc_id, c FROM kept UNION ALL SELECT doc_id, {BASE_WEIGHT}::DOUBLE FROM base) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0::DOUBLE) AS score
FROM d LEFT JOIN bl USING (doc_id) LEFT JOIN ml USING (doc_id) LEFT JOIN sc USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    from ingestry.llm.quality_rules import BOILERPLATE

    return {
        "op2_suffix_array_dedup": OP2,
        "op4_line_dedup": OP4,
        "op9_quality_rules": OP9.replace("{boilerplate}", BOILERPLATE),
        "op10_license_scan": op10(),
        "op11_conversation_repair": OP11,
    }
