"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from cartwheel.llm import jaccard_join, mixing, spelling, vector_codes

WORD = "[^\\x20\\x09-\\x0D]+"


def _vector_codes(parts=vector_codes.PARTS, entries=vector_codes.ENTRIES, rounds=vector_codes.ROUNDS, width=8) -> str:
    """Rounds unrolled; every part is ``width`` columns."""
    columns = [f"v{i}" for i in range(width)]
    cut = ", ".join(f"CAST(floor({vector_codes.SCALE} * CAST(embedding[{width} * part + {i + 1}] AS DOUBLE)) AS BIGINT) AS v{i}" for i in range(width))
    apart = " + ".join(f"(x.{c} - b.{c}) * (x.{c} - b.{c})" for c in columns)
    steps = [f"""
kept AS MATERIALIZED (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (SELECT vec_id, label, place, part, {cut} FROM kept, range({parts}) AS r(part)),
book0 AS MATERIALIZED (SELECT part, place AS k, {', '.join(columns)} FROM x WHERE place < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (SELECT x.vec_id, x.part, min(({apart}) * {entries} + b.k) AS best
  FROM x JOIN book{r} b ON x.part = b.part GROUP BY ALL)""")
        if r < rounds:
            means = ", ".join(f"floor(sum(x.{c}) / count(*)) AS {c}" for c in columns)
            merged = ", ".join(f"CAST(coalesce(m.{c}, b.{c}) AS BIGINT) AS {c}" for c in columns)
            steps.append(f"""
book{r + 1} AS MATERIALIZED (SELECT b.part, b.k, {merged} FROM book{r} b LEFT JOIN
  (SELECT n.part, n.best % {entries} AS k, {means} FROM near{r} n JOIN x ON x.vec_id = n.vec_id AND x.part = n.part GROUP BY ALL) m
  ON m.part = b.part AND m.k = b.k)""")
    row = " || ',' || ".join(columns)
    return f"""WITH {','.join(steps)},
coded AS (SELECT n.vec_id, string_agg(printf('%02x', n.best % {entries}), '' ORDER BY part) AS code, CAST(sum(n.best // {entries}) AS BIGINT) AS error
  FROM near{rounds} n GROUP BY n.vec_id)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg({row}, ',' ORDER BY part, k)) FROM book{rounds}) AS codebooks_sha256, k.label
FROM coded c JOIN kept k ON k.vec_id = c.vec_id"""


_MIXING = f"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
  FROM documents),
weighed AS MATERIALIZED (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, {mixing.MAX_EPOCHS} * sum(size) AS stop,
    {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT 0 AS i, (SELECT sum(source_size) FROM weighed) AS rest, (SELECT sum(weight) FROM weighed) AS open_weight
  UNION ALL
  SELECT any_value(i) + 1, (SELECT sum(source_size) FROM weighed) - coalesce(sum(stop) FILTER (weight * rest > stop * open_weight), 0),
    sum(weight) FILTER (weight * rest <= stop * open_weight)
  FROM levels, weighed GROUP BY i HAVING any_value(i) < 60),
level AS (SELECT rest, open_weight FROM levels WHERE i = 60),
shares AS (
  SELECT source, source_size, CASE WHEN weight * rest > stop * open_weight THEN CAST(stop AS DOUBLE)
    ELSE weight * CAST(rest AS DOUBLE) / CAST(open_weight AS DOUBLE) END AS target FROM weighed, level),
wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM shares),
wanted AS (
  SELECT *, greatest(0, CAST(round(target) AS BIGINT) - whole * source_size) AS open_words FROM wholes),
placed AS (
  SELECT s.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS until,
    sum(size) OVER (PARTITION BY source, hash) AS together, count(*) OVER (PARTITION BY source, hash) AS copies FROM sized s),
parts AS (
  SELECT p.doc_id, p.source, p.size, w.source_size, w.target, w.whole, CAST(CASE WHEN until <= open_words THEN p.size
    WHEN until - together >= open_words THEN 0 ELSE least(p.size, (open_words - (until - together)) // copies) END AS BIGINT) AS part
  FROM placed p JOIN wanted w ON p.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target, CAST(size * whole + part AS BIGINT) AS taken, source, CAST(whole AS BIGINT) AS whole, part FROM parts
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SUBSTRINGS = f"""
WITH worded AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(list_slice(words, i, i + 49), ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM worded WHERE len(words) >= 50 AND doc_id IS NOT NULL)),
firsts AS (SELECT h, min(doc_id) AS lo FROM windows GROUP BY h),
gone AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS w FROM windows JOIN firsts USING (h) WHERE lo < doc_id),
edges AS (
  SELECT doc_id, count(*) AS n_removed, list(w) AS ws, count(*) FILTER (before IS NULL OR w - before > 1) AS n_spans
  FROM (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY w) AS before FROM gone) GROUP BY doc_id),
kept AS (
  SELECT g.doc_id, string_agg(g.word, ' ' ORDER BY g.w) AS text
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS w FROM worded) g
  ANTI JOIN gone USING (doc_id, w) GROUP BY g.doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(e.n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256, CAST(coalesce(e.n_spans, 0) AS BIGINT) AS n_spans
FROM worded d LEFT JOIN edges e ON e.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

#: Candidates share one of the rarest shingles that a link can't do without.
_JACCARD = f"""
WITH RECURSIVE worded AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS words FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(words, i, i + {jaccard_join.WORDS - 1}), ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {jaccard_join.WORDS - 1}, 1) + 1)) AS i FROM worded WHERE len(words) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n, md5(string_agg(h, '' ORDER BY h)) AS class FROM shingles GROUP BY doc_id),
classes AS MATERIALIZED (SELECT class, min(doc_id) AS rep, any_value(n) AS n FROM sizes GROUP BY class),
placed AS MATERIALIZED (
  SELECT c.rep, c.n, s.h, row_number() OVER (PARTITION BY c.rep ORDER BY f.df, s.h) AS place
  FROM shingles s JOIN classes c ON c.rep = s.doc_id
  JOIN (SELECT h, count(*) AS df FROM shingles GROUP BY h) f ON f.h = s.h),
heads AS MATERIALIZED (SELECT rep, n, h FROM placed WHERE place <= n - ({jaccard_join.PERCENT} * n + 99) // 100 + 1),
candidates AS MATERIALIZED (
  SELECT DISTINCT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb FROM heads a JOIN heads b ON a.h = b.h AND a.rep < b.rep
  WHERE 100 * least(a.n, b.n) >= {jaccard_join.PERCENT} * greatest(a.n, b.n)),
linked AS MATERIALIZED (
  SELECT c.a, c.b FROM candidates c JOIN shingles x ON x.doc_id = c.a JOIN shingles y ON y.doc_id = c.b AND y.h = x.h
  GROUP BY c.a, c.b, c.na, c.nb HAVING 100 * count(*) >= {jaccard_join.PERCENT} * (c.na + c.nb - count(*))),
both_ways AS MATERIALIZED (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached(a, b) AS (SELECT rep, rep FROM classes UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON e.a = r.b),
components AS (SELECT a AS rep, min(b) AS component FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(m.component, d.doc_id) AS component_id
FROM worded d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN classes c ON c.class = s.class LEFT JOIN components m ON m.rep = c.rep
"""

#: crc32 byte by byte over the usual table of 256 remainders; all code points are below 256 here.
_SPELLING = f"""
WITH RECURSIVE remainders AS MATERIALIZED (
  SELECT list(list_reduce([i] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)),
runs AS MATERIALIZED (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
coded AS (
  SELECT run, n, flatten(list_transform(string_split(named, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END)) AS bytes FROM runs),
summed AS (
  SELECT run, n, xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(bytes, lambda b: CAST(b AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM coded, remainders),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {spelling.MISSPELT} = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
      ELSE run END AS word, n FROM summed)
  GROUP BY word HAVING length(word) >= {spelling.SHORTEST} AND sum(n) >= {spelling.FEWEST}),
skipped AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n FROM skipped a JOIN skipped b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM skipped s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word, s.n FROM skipped s JOIN words w ON w.word = s.rest),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= {spelling.RATIO} * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= {spelling.RATIO} * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chains(word, last, step) AS (
  SELECT word, word, 0 FROM forms UNION ALL SELECT c.word, f.form, c.step + 1 FROM chains c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(last, step) AS root FROM chains GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word
"""

ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": _SUBSTRINGS,
    "op8_jaccard_join": _JACCARD,
    "op11_vector_codes": _vector_codes(),
    "op12_spelling_variants": _SPELLING,
    "op13_source_mixing": _MIXING,
}
