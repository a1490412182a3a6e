"""DuckDB statements for the queries that SQL can express on whole tables."""

SQL: dict[str, str] = {}

# words are the runs of bytes other than blank and \\t to \\r; only A to Z are lower-cased
SQL["op2_minhash_neardup"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS t FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
         ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS v FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.v = b.v AND a.doc_id < b.doc_id
   AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(d, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d),
m AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.c AS component_id, m.c = s.doc_id AS kept
FROM s JOIN m ON m.d = s.doc_id
"""

# the beta prior of each rule by moments over all hosts, as in the operator's docstring
_PRIOR = """p{r} AS (
  SELECT mean, CASE WHEN v > 0 THEN greatest(mean * (1 - mean) / v - 1, 0.0) ELSE 1e9 END AS strength FROM (
    SELECT mean, CASE WHEN n - nn / n > 0 THEN (ff - n * mean * mean - (k - 1) * mean * (1 - mean)) / (n - nn / n)
                 ELSE 0.0 END AS v FROM (
      SELECT count(*) AS k, CAST(sum(n) AS DOUBLE) AS n, CAST(sum({r}) AS DOUBLE) / sum(n) AS mean,
             sum(CAST(n AS DOUBLE) * n) AS nn, sum(CAST({r} AS DOUBLE) * {r} / n) AS ff FROM h)))"""

SQL["op9_host_rules"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
gs AS (SELECT rid, list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) AS gs
       FROM w WHERE len(w) >= 8),
g AS (SELECT rid, unnest(gs) AS g, generate_subscripts(gs, 1) AS i FROM gs),
rp AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
c AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS n FROM rp) GROUP BY rid),
s AS (
  SELECT d.rid, d.doc_id, d.host, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(coalesce(length(array_to_string(w.w, '')), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l.l) - len(list_distinct(l.l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 20 AS ts, 100 * n_repeat_words > 30 * n_words AS rep FROM s),
h AS (SELECT host, count(*) AS n, CAST(sum(CAST(ts AS INT)) AS BIGINT) AS ts, CAST(sum(CAST(rep AS INT)) AS BIGINT) AS rep
      FROM b WHERE host IS NOT NULL GROUP BY host),
""" + ",\n".join(_PRIOR.format(r=r) for r in ("ts", "rep")) + """,
r AS (SELECT host, greatest((h.ts + pts.mean * pts.strength) / (h.n + pts.strength),
                            (h.rep + prep.mean * prep.strength) / (h.n + prep.strength)) AS rate FROM h, pts, prep)
SELECT b.doc_id, b.host, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words,
  b.ts OR b.rep AS base_failed, round(r.rate, 9) AS host_rate,
  NOT (b.ts OR b.rep) AND NOT coalesce(r.rate > 0.5, false) AS kept
FROM b LEFT JOIN r ON r.host = b.host
"""

# crc32 byte by byte over a table of 256 entries; the repair goes back from each conversation's last row,
# with the best cost and audit of each grammar state: nothing yet, after s, after u, after a
SQL["op11_structure_repair"] = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM (SELECT unnest(range(256)) AS i))),
src AS (SELECT row_number() OVER () AS rid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (SELECT s.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1),
    lambda i: CAST(ascii(k[i]) AS BIGINT))), lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
  FROM src s, crc_table),
damaged AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN ''
    WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(2) c(n) WHERE n < CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
  count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
  regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS last, left(role, 1) AS i,
  lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS after FROM placed),
faulty AS (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate'
  WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
step(conv_id, pos, v0, v1, v2, v3) AS (
  SELECT conv_id, max(n) + 1, {'c': 0, 'a': '', 'o': []::STRUCT(k BIGINT, r VARCHAR)[]},
    {'c': 4, 'a': 'II', 'o': [{'k': 0, 'r': 'user'}, {'k': 0, 'r': 'assistant'}]}, {'c': 2, 'a': 'I', 'o': [{'k': 0, 'r': 'assistant'}]},
    {'c': 0, 'a': '', 'o': []::STRUCT(k BIGINT, r VARCHAR)[]} FROM faulty GROUP BY conv_id
  UNION ALL
  SELECT conv_id, pos,
    least(e0, {'c': e2.c + 2, 'a': 'I' || e2.a, 'o': list_prepend({'k': 0, 'r': 'user'}, e2.o)},
      {'c': e3.c + 4, 'a': 'II' || e3.a, 'o': list_concat([{'k': 0, 'r': 'user'}, {'k': 0, 'r': 'assistant'}], e3.o)}),
    least(e1, {'c': e2.c + 2, 'a': 'I' || e2.a, 'o': list_prepend({'k': 0, 'r': 'user'}, e2.o)},
      {'c': e3.c + 4, 'a': 'II' || e3.a, 'o': list_concat([{'k': 0, 'r': 'user'}, {'k': 0, 'r': 'assistant'}], e3.o)}),
    least(e2, {'c': e3.c + 2, 'a': 'I' || e3.a, 'o': list_prepend({'k': 0, 'r': 'assistant'}, e3.o)}),
    least(e3, {'c': e2.c + 2, 'a': 'I' || e2.a, 'o': list_prepend({'k': 0, 'r': 'user'}, e2.o)})
  FROM (
    SELECT f.conv_id, f.pos,
      least({'c': s.v0.c + 3, 'a': 'D' || s.v0.a, 'o': s.v0.o},
        CASE WHEN stay THEN {'c': s.v2.c + 2 + cut, 'a': 'R' || s.v2.a, 'o': list_prepend({'k': f.pos, 'r': 'user'}, s.v2.o)} END,
        CASE WHEN stay AND f.i = 's' THEN {'c': s.v1.c + cut, 'a': 'K' || s.v1.a, 'o': list_prepend({'k': f.pos, 'r': f.role}, s.v1.o)} END,
        CASE WHEN stay AND f.i = 'u' THEN {'c': s.v2.c + cut, 'a': 'K' || s.v2.a, 'o': list_prepend({'k': f.pos, 'r': f.role}, s.v2.o)} END) AS e0,
      least({'c': s.v1.c + 3, 'a': 'D' || s.v1.a, 'o': s.v1.o},
        CASE WHEN stay THEN {'c': s.v2.c + 2 + cut, 'a': 'R' || s.v2.a, 'o': list_prepend({'k': f.pos, 'r': 'user'}, s.v2.o)} END,
        CASE WHEN stay AND f.i = 'u' THEN {'c': s.v2.c + cut, 'a': 'K' || s.v2.a, 'o': list_prepend({'k': f.pos, 'r': f.role}, s.v2.o)} END) AS e1,
      least({'c': s.v2.c + 3, 'a': 'D' || s.v2.a, 'o': s.v2.o},
        CASE WHEN stay THEN {'c': s.v3.c + 2 + cut, 'a': 'R' || s.v3.a, 'o': list_prepend({'k': f.pos, 'r': 'assistant'}, s.v3.o)} END,
        CASE WHEN stay AND f.i = 'a' THEN {'c': s.v3.c + cut, 'a': 'K' || s.v3.a, 'o': list_prepend({'k': f.pos, 'r': f.role}, s.v3.o)} END) AS e2,
      least({'c': s.v3.c + 3, 'a': 'D' || s.v3.a, 'o': s.v3.o},
        CASE WHEN stay THEN {'c': s.v2.c + 2 + cut, 'a': 'R' || s.v2.a, 'o': list_prepend({'k': f.pos, 'r': 'user'}, s.v2.o)} END,
        CASE WHEN stay AND f.i = 'u' THEN {'c': s.v2.c + cut, 'a': 'K' || s.v2.a, 'o': list_prepend({'k': f.pos, 'r': f.role}, s.v2.o)} END) AS e3
    FROM step s JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS stay, CAST(fault = 'truncated' AS INT) AS cut FROM faulty) f
      ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.pos = s.pos - 1)),
best AS (SELECT conv_id, v0.c AS cost, v0.a AS audit, v0.o AS o FROM step WHERE pos = 1),
out_rows AS (SELECT conv_id, unnest(o) AS o, generate_subscripts(o, 1) AS place FROM best),
texts AS (SELECT r.conv_id, string_agg(r.o.r || ':' || coalesce(f.text, ''), chr(10) ORDER BY r.place) AS t FROM out_rows r
  LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.o.k GROUP BY r.conv_id),
stats AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (after IS NOT NULL AND i || after NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id)
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
  coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
  coalesce(b.audit, '') AS audit, sha256(coalesce(t.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""

# targets in closed form; sample sizes from the longest class to the shortest; Pareto ranks within a class
SQL["op12_pareto_mixing"] = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [1, 2, 3][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INT)] AS w FROM d GROUP BY source),
total AS (SELECT CAST(sum(source_size) AS HUGEINT) AS t FROM s),
-- a source is held at its most if the others' share would pass it once all that fill up earlier are held at theirs
held AS (SELECT a.source, a.source_size, a.w,
    3 * CAST(a.source_size AS HUGEINT) * sum(CASE WHEN b.source_size * a.w >= a.source_size * b.w THEN b.w ELSE 0 END)
      < a.w * (any_value(t) - sum(CASE WHEN b.source_size * a.w < a.source_size * b.w THEN 3 * b.source_size ELSE 0 END)) AS capped
  FROM s a, s b, total GROUP BY a.source, a.source_size, a.w),
fair AS (SELECT CAST(any_value(t) - coalesce(sum(3 * source_size) FILTER (capped), 0) AS DOUBLE) AS share,
    CAST(sum(w) FILTER (NOT capped) AS DOUBLE) AS per FROM held, total),
target AS (SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE) ELSE w * share / per END AS target
  FROM held, fair),
copies AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS k FROM target),
r AS (SELECT d.*, t.source_size, t.target, CAST(floor(t.k) AS BIGINT) AS whole, t.k - floor(t.k) AS rest,
    length(bin(size)) * 16 + CAST('0b' || substr(bin(size), 1, 4) AS INT) AS class,
    (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || digest), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM d JOIN copies t ON t.source IS NOT DISTINCT FROM d.source),
c AS (SELECT source, class, count(*) AS n, CAST(sum(size) AS DOUBLE) AS words, any_value(rest) AS rest,
    row_number() OVER (PARTITION BY source ORDER BY class DESC) AS i FROM r WHERE size > 0 AND rest > 0 GROUP BY source, class),
walk(source, i, carry, chosen) AS (
  SELECT DISTINCT source, CAST(0 AS BIGINT), 0.0::DOUBLE, CAST(0 AS BIGINT) FROM c
  UNION ALL
  SELECT source, i, want - x * (words / n), x FROM (
    SELECT c.source, c.i, c.n, c.words, c.rest * c.words + w.carry AS want,
      CAST(least(greatest(floor((c.rest * c.words + w.carry) / (c.words / c.n) + 0.5), 0), c.n) AS BIGINT) AS x
    FROM walk w JOIN c ON c.source IS NOT DISTINCT FROM w.source AND c.i = w.i + 1)),
picked AS (SELECT c.source, c.class, c.n, w.chosen FROM c JOIN walk w ON w.source IS NOT DISTINCT FROM c.source AND w.i = c.i),
ranked AS (SELECT r.*, p.n, p.chosen, row_number() OVER (PARTITION BY r.source, r.class ORDER BY
    (u / (1 - u)) / ((p.chosen / p.n) / (1 - p.chosen / p.n)), doc_id NULLS FIRST, digest) AS rank
  FROM r LEFT JOIN picked p ON p.source IS NOT DISTINCT FROM r.source AND p.class = r.class AND r.size > 0)
SELECT doc_id, source, size, source_size, target, x AS copies, x * size AS taken FROM (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE whole + CASE WHEN chosen = n THEN 1
    WHEN chosen > 0 AND rank <= chosen THEN 1 ELSE 0 END END AS x FROM ranked)
"""

SQL["op13_source_divergence"] = """
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
x AS (SELECT rid, lang, source, unnest(t) AS term FROM d),
kept AS (SELECT lang, term FROM x GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM x JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
total AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + v.v) AS p
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN total t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v.v)) AS q
  FROM c JOIN v USING (lang) GROUP BY lang, term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT p.lang, p.source, o.source AS item, sum((p.p - o.p) * (p.p - o.p) // o.p) AS value
    FROM p JOIN p o ON p.lang = o.lang AND p.term = o.term AND p.source <> o.source GROUP BY ALL) f
  ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT p.lang, p.source, p.term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term
  QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 200)
"""
