"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

LINES = """
WITH l AS (
  SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents
), lines AS (
  SELECT doc_id, text, i, string_split(text, chr(10))[i + 1] AS line FROM l
), worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), win AS (
  SELECT a.doc_id, a.k, a.line AS x, b.line AS y, c.line AS z
  FROM worded a
  JOIN worded b ON a.doc_id = b.doc_id AND b.k = a.k + 1
  JOIN worded c ON a.doc_id = c.doc_id AND c.k = a.k + 2
), later AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, k) AS r FROM win
  ) WHERE r > 1
), gone AS (
  SELECT DISTINCT w.doc_id, w.i FROM worded w JOIN later t
  ON w.doc_id = t.doc_id AND w.k BETWEEN t.k AND t.k + 2
), kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.i) AS text
  FROM lines n ANTI JOIN gone g ON n.doc_id = g.doc_id AND n.i = g.i
  GROUP BY n.doc_id
)
SELECT d.doc_id,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  (SELECT count(*) FROM worded w WHERE w.doc_id = d.doc_id) AS n_lines,
  (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

QUALITY = """
WITH grid(rule, place, cutoff) AS (
  SELECT 'symbol_share', generate_subscripts(c, 1) - 1, unnest(c) FROM (SELECT [0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02]::DOUBLE[] AS c)
  UNION ALL SELECT 'capital_share', generate_subscripts(c, 1) - 1, unnest(c) FROM (SELECT [0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07]::DOUBLE[] AS c)
  UNION ALL SELECT 'dup_line_share', generate_subscripts(c, 1) - 1, unnest(c) FROM (SELECT [0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05]::DOUBLE[] AS c)
  UNION ALL SELECT 'shout_share', generate_subscripts(c, 1) - 1, unnest(c) FROM (SELECT [0.5, 0.3, 0.2, 0.15, 0.1, 0.05, 0.03, 0.02, 0.01]::DOUBLE[] AS c)
), docs AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents
), triples AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs)
  )
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM triples WHERE n > 1)
  GROUP BY doc_id
), base AS (
  SELECT d.doc_id, d.stratum, len(w) AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words,
    len(ls) AS n_lines,
    length(regexp_replace(t, '[^\\p{Lu}]', '', 'g')) AS caps,
    length(regexp_replace(t, '[^!]', '', 'g')) AS shouts
  FROM docs d LEFT JOIN repeats r USING (doc_id)
), shares AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS s1,
    CASE WHEN word_chars > 0 THEN caps / word_chars ELSE 0 END AS s2,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS s3,
    CASE WHEN n_words > 0 THEN shouts / n_words ELSE 0 END AS s4
  FROM base
), counted AS (
  -- the first of a doc_id's rows that pass the base rule stands for it among the labelled
  SELECT *, row_number() OVER (PARTITION BY doc_id, base_failed ORDER BY stratum, s1, s2, s3, s4) AS copy FROM shares
), signals AS (
  SELECT doc_id, stratum, base_failed, copy, unnest([
    {'rule': 'symbol_share', 'v': s1}, {'rule': 'capital_share', 'v': s2},
    {'rule': 'dup_line_share', 'v': s3}, {'rule': 'shout_share', 'v': s4}], recursive := true)
  FROM counted
), truth AS (
  SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), tried AS (
  SELECT stratum, g.rule, place, cutoff,
    count(*) FILTER (q > 0) AS n_good, count(*) FILTER (q <= 0) AS n_bad,
    count(*) FILTER (q > 0 AND v > cutoff) AS k_good, count(*) FILTER (q <= 0 AND v > cutoff) AS k_bad
  FROM signals s JOIN truth USING (doc_id) JOIN grid g ON s.rule = g.rule
  WHERE NOT base_failed AND copy = 1 GROUP BY ALL
), tested AS (
  SELECT *, CASE WHEN k_good >= n_good * 0.0125 THEN 1 ELSE (
    SELECT sum(exp(lgamma(n_good + 1) - lgamma(j + 1) - lgamma(n_good - j + 1) + j * ln(0.0125) + (n_good - j) * ln(0.9875)))
    FROM (SELECT unnest(range(k_good + 1)) AS j)) END AS p,
    (SELECT count(DISTINCT (stratum, rule)) FROM tried WHERE n_good > 0) AS pairs
  FROM tried
), chained AS (
  SELECT *, min(p <= 0.05 / pairs) OVER (PARTITION BY stratum, rule ORDER BY place) AS ok,
    k_bad / greatest(n_bad, 1) - k_good / greatest(n_good, 1) AS gain
  FROM tested
), chosen AS (
  SELECT stratum, rule, cutoff FROM (
    SELECT *, row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, place) AS r
    FROM chained WHERE ok AND n_good > 0 AND gain > 0
  ) WHERE r = 1
), failed AS (
  SELECT s.doc_id, string_agg(s.rule, ',' ORDER BY s.rule) AS rules
  FROM signals s JOIN chosen c ON s.stratum = c.stratum AND s.rule = c.rule AND s.v > c.cutoff
  GROUP BY s.doc_id
)
SELECT c.doc_id, c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.base_failed,
  NOT c.base_failed AND f.rules IS NULL AS kept, coalesce(f.rules, '') AS failed_rules
FROM counted c LEFT JOIN failed f USING (doc_id)
"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v::DOUBLE[], x.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 20
"""

RANKED = """
WITH items AS (
  SELECT item_id, row_number() OVER (ORDER BY item_id, text) AS item,
    list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), wanted AS (
  SELECT item, item_id, unnest(terms) AS term FROM items
), words AS (
  SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS terms
  FROM documents
), sizes AS (
  SELECT doc, doc_id, len(terms) AS n FROM words WHERE len(terms) > 0
), corpus AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS l FROM sizes
), norms AS (
  SELECT doc, doc_id, 50 + (50 * n * n_docs) // l AS m FROM sizes, corpus
), occurrences AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM words)
  WHERE term IN (SELECT term FROM wanted) GROUP BY doc, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM occurrences, corpus GROUP BY term
), scores AS (
  SELECT item, item_id, doc, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score, any_value(doc_id) AS doc_id
  FROM wanted JOIN occurrences USING (term) JOIN weights USING (term) JOIN norms USING (doc)
  GROUP BY item, item_id, doc
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0
) WHERE rank <= 50
"""

SPELLING = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT unnest(range(256))::BIGINT AS i)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS run
  FROM documents
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, run, count(*) AS n FROM runs GROUP BY ALL
), bytes AS (
  SELECT doc_id, run, n, hex(encode(doc_id || ':' || run)) AS h FROM counted
), hashed AS (
  SELECT run, n, xor(list_reduce(
      [4294967295::BIGINT] || [('0x' || substr(h, 2 * k + 1, 2))::BIGINT FOR k IN range(length(h) // 2)],
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), skipped AS (
  SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), shorter AS (
  SELECT DISTINCT s.word AS long_word, s.n AS long_n, w.word, w.n FROM skipped s JOIN words w ON s.rest = w.word
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM skipped a JOIN skipped b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT word, n, long_word, long_n FROM shorter
  UNION ALL SELECT long_word, long_n, word, n FROM shorter
), best AS (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word, n
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 10 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 10 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), ends AS (
  SELECT word, word AS root FROM formed WHERE form IS NULL
  UNION ALL SELECT f.word, e.root FROM formed f JOIN ends e ON f.form = e.word
)
SELECT f.word, f.form, e.root, f.n, f.n_near::BIGINT AS n_near, f.form_n FROM formed f JOIN ends e USING (word)
"""

ORACLE: dict[str, str] = {
    "op1_quality": QUALITY,
    "op3_topk": TOPK,
    "op4_lines": LINES,
    "op11_ranked": RANKED,
    "op13_spelling": SPELLING,
}
