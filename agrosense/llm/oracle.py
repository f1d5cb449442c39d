"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

from agrosense.llm.licenses import MIN_DICE, TEMPLATES

WORDS_4 = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS_4.format('text')}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_4.format('text')} AS w FROM benchmark),
win AS (
  SELECT item, least(len(w), 10) AS n,
         unnest(list_transform(range(0, len(w) - least(len(w), 10) + 1),
                               lambda i: array_to_string(w[i + 1 : i + least(len(w), 10)], ' '))) AS s
  FROM b WHERE len(w) > 0),
dw AS (
  SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS p0, w
  FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (
  SELECT dw.doc_id, dw.p0, dw.n, win.item
  FROM dw JOIN win ON dw.n = win.n AND array_to_string(dw.w[dw.p0 + 1 : dw.p0 + dw.n], ' ') = win.s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(p0, p0 + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit,
       coalesce(its.n_items, 0) AS n_items, sha256(coalesce(its.items, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(1) || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, (ARRAY[5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]
              ::DOUBLE AS weight FROM s0),
s2 AS (SELECT *, CAST(3 * source_size AS DOUBLE) AS cap, 3 * source_size / weight AS cap_level,
              CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s1),
s3 AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap_level, source IS NULL, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
              / sum(weight) OVER (ORDER BY cap_level, source IS NULL, source
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level FROM s2),
s4 AS (SELECT *, (SELECT own_level FROM s3 WHERE cap_level >= own_level
                  ORDER BY cap_level, own_level LIMIT 1) AS level FROM s3),
s5 AS (SELECT source, source_size, least(cap, level * weight) AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END
              AS passes FROM s5),
s7 AS (SELECT *, target - passes * source_size AS rest FROM s6),
g AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, size, doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(size) OVER (PARTITION BY source ORDER BY h) AS upto FROM d)
SELECT g.doc_id, g.size, s7.source_size, s7.target,
       CAST(g.size * (s7.passes + CASE WHEN g.upto < s7.rest OR 2 * g.before + g.size <= 2 * s7.rest
            THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM g JOIN s7 ON g.source IS NOT DISTINCT FROM s7.source"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex,
             min(page_id) OVER (PARTITION BY html) AS first_id FROM p),
d AS (SELECT *, list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (CAST('0x' || substr(hex,
          CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) % 32 AS BIGINT), 1)) AS digits FROM h)
SELECT page_id, payload_bytes, array_to_string(digits, '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""

GRAMS = ("list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])")
NORMAL = ("list_filter(string_split_regex(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda x: x <> '')")
VALUES = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in TEMPLATES)

OP9 = f"""
WITH t0 AS (SELECT license, {NORMAL.format('text')} AS w FROM (VALUES {VALUES}) v(license, text)),
t AS (SELECT license, {GRAMS} AS g FROM t0),
u0 AS (SELECT doc_id, unnest(list_distinct(string_split(text, chr(10))
              || string_split_regex(text, '\n[ \t]*\n') || [text])) AS u FROM documents),
u1 AS (SELECT doc_id, {NORMAL.format('u')} AS w FROM u0),
u AS (SELECT doc_id, {GRAMS} AS g FROM u1 WHERE len(w) >= 2),
m AS (SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) AS dice
      FROM u, t WHERE len(u.g) <= 3 * len(t.g)),
b AS (SELECT doc_id, license, max(dice) AS dice FROM m WHERE dice >= {MIN_DICE} GROUP BY ALL),
r AS (SELECT doc_id, arg_min(license, (-dice, license)) AS license, max(dice) AS dice,
             string_agg(license, ',' ORDER BY license) AS licenses FROM b GROUP BY doc_id)
SELECT doc_id, license, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN r USING (doc_id)"""

SETS_3 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) END AS g FROM d),
n AS MATERIALIZED (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
e AS MATERIALIZED (SELECT s.doc_id, unnest(g) AS g FROM s)"""

OP11 = f"""WITH RECURSIVE {SETS_3.strip().removeprefix('WITH ')},
x AS MATERIALIZED (SELECT e.doc_id, e.g, n.n FROM e JOIN n USING (doc_id)),
link AS MATERIALIZED (
  SELECT a.doc_id AS p, b.doc_id AS q FROM x a JOIN x b
    ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways AS MATERIALIZED (SELECT p, q FROM link UNION ALL SELECT q, p FROM link),
reach(doc_id, node) AS (
  SELECT DISTINCT p, p FROM both_ways
  UNION
  SELECT r.doc_id, b.q FROM reach r JOIN both_ways b ON b.p = r.node)
SELECT n.doc_id, n.n AS n_shingles, coalesce(c.component_id, n.doc_id) AS component_id
FROM n LEFT JOIN (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)"""

OP12 = r"""
WITH p AS MATERIALIZED (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS MATERIALIZED (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
            FROM w, (VALUES (1), (2), (3), (4)) v(k) WHERE len(ws) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS MATERIALIZED (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
cut AS MATERIALIZED (
  SELECT c.lang, c.phrase, c.a, j, lf.f AS l, rf.f AS r,
         CAST(2000000::HUGEINT * c.a // (lf.f + rf.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f lf ON lf.lang = c.lang AND lf.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f rf ON rf.lang = c.lang AND rf.phrase = array_to_string(c.w[j + 1:], ' ')),
best AS MATERIALIZED (SELECT lang, phrase, a, min(score) AS score, arg_min(l, (score, j)) AS l, arg_min(r, (score, j)) AS r
         FROM cut GROUP BY lang, phrase, a),
inner_of AS MATERIALIZED (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) v(m) WHERE m < k)
  GROUP BY ALL),
kept AS MATERIALIZED (SELECT best.* FROM best LEFT JOIN inner_of USING (lang, phrase)
         WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN t USING (lang)
QUALIFY rank <= 2000"""

ORACLE_SQL = {"op4_decontaminate": OP4, "op5_mix_sources": OP5,
              "op6_warc_revisits": OP6, "op9_license_scan": OP9,
              "op11_jaccard_join": OP11, "op12_collocations": OP12}
