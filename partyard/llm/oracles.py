"""SQL counterparts of the corpus queries that SQL can express."""

from __future__ import annotations

SOLID = r"[^\x20\x09-\x0D]"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{SOLID}+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':17') AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY 3 * words / CAST(weight AS DOUBLE), number) AS place FROM sources
), levels AS (
  SELECT *,
    (SELECT CAST(sum(words) AS BIGINT) FROM sources)
      - coalesce(CAST(sum(3 * words) OVER before AS BIGINT), 0) AS remaining,
    (SELECT CAST(sum(weight) AS BIGINT) FROM sources)
      - coalesce(CAST(sum(weight) OVER before AS BIGINT), 0) AS shares
  FROM ordered
  WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), free AS (
  SELECT place AS first, CAST(remaining AS DOUBLE) / CAST(shares AS DOUBLE) AS level FROM levels
  WHERE remaining * weight <= 3 * words * shares ORDER BY place LIMIT 1
), goals AS (
  SELECT o.source, o.words,
    CASE WHEN f.first IS NULL OR o.place < f.first THEN CAST(3 * o.words AS DOUBLE)
         ELSE f.level * o.weight END AS target
  FROM ordered o LEFT JOIN free f ON true
), plans AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS want FROM goals
), passes AS (
  SELECT *, CASE WHEN words > 0 THEN want // words ELSE 0 END AS whole,
    CASE WHEN words > 0 THEN want % words ELSE 0 END AS rest FROM plans
), placed AS (
  SELECT d.doc_id, d.size, p.words, p.target, p.whole, p.rest,
    coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before
  FROM sized d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, words AS source_size, target,
  CAST(size * (whole + CASE WHEN 2 * before + size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

QUALITY = rf"""
WITH listed AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{SOLID}+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{SOLID}')) AS lines
  FROM documents
), windows AS (
  SELECT id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS i FROM listed)
), counted AS (
  SELECT id, i, count(*) OVER (PARTITION BY id, a, b, c) AS n FROM windows
), repeats AS (
  SELECT id, count(DISTINCT i + k) AS n FROM counted, (SELECT unnest([0, 1, 2]) AS k)
  WHERE counted.n > 1 GROUP BY id
), measured AS (
  SELECT l.doc_id, l.text, CAST(len(l.words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(l.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(l.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l.lines) AS BIGINT) AS n_lines,
    CAST(len(l.lines) - len(list_distinct(l.lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM listed l LEFT JOIN repeats r USING (id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 3 * n_lines
    OR 2 * (length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g'))) > word_chars
    OR 2 * (length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g'))) < word_chars) AS kept
FROM judged
"""

ORACLES = {"op4_mix_sources": MIX, "op10_quality_rules": QUALITY}

EMBEDDINGS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.98
), reach AS (
  SELECT vec_id, vec_id AS root FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.root
), found AS (
  SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id
)
SELECT e.vec_id,
  CAST((SELECT count(*) FROM links WHERE a = e.vec_id) AS BIGINT) AS n_links,
  f.component_id, e.vec_id = f.component_id AS kept
FROM embeddings e JOIN found f USING (vec_id)
"""

ORACLES["op7_embedding_dedup"] = EMBEDDINGS

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

RESAMPLING = rf"""
WITH tabled AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1
    THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), listed AS (
  SELECT 'd' AS kind, row_number() OVER () AS no, doc_id, regexp_extract_all({LOWER}, '{WORD}') AS words FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), NULL, regexp_extract_all({LOWER}, '{WORD}') FROM benchmark
), features AS (
  SELECT kind, no, unnest(words) AS feature FROM listed
  UNION ALL
  SELECT kind, no, words[i] || ' ' || words[i + 1]
  FROM (SELECT kind, no, words, unnest(range(1, len(words))) AS i FROM listed)
), counted AS (
  SELECT kind, no, feature, count(*) AS n FROM features GROUP BY ALL
), placed AS (
  SELECT feature, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(1, len(bytes), 2),
        lambda i: 16 * (instr('0123456789ABCDEF', bytes[i]) - 1) + instr('0123456789ABCDEF', bytes[i + 1]) - 1)),
      lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, hex(encode(feature)) AS bytes FROM counted GROUP BY feature), tabled
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t
  FROM counted JOIN placed USING (feature) GROUP BY bucket
), totals AS (
  SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM buckets
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM buckets, totals
), weighed AS (
  SELECT no, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS gain
  FROM counted JOIN placed USING (feature) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY no
), scored AS (
  SELECT l.doc_id, len(l.words) AS n_words, coalesce(w.n_features, 0) AS n_features,
    CASE WHEN w.n_features > 0 THEN (w.gain - ((w.gain % w.n_features) + w.n_features) % w.n_features) // w.n_features
      ELSE 0 END AS weight,
    list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9),
      lambda i: CAST(instr('0123456789abcdef', sha256('7:' || l.doc_id)[i]) - 1 AS BIGINT))), lambda a, b: a * 16 + b) AS h
  FROM listed l LEFT JOIN weighed w USING (no) WHERE l.kind = 'd'
), drawn AS (
  SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, n_words,
    CAST(weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    25 * (SELECT count(*) FROM drawn WHERE n_words >= 20) // 100 AS most FROM drawn
)
SELECT doc_id, n_features, weight, score,
  CAST(CASE WHEN n_words >= 20 AND place <= most THEN place END AS BIGINT) AS rank
FROM ranked
"""

SEARCH = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS no, doc_id, regexp_extract_all({LOWER}, '{WORD}') AS words FROM documents
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_words FROM docs WHERE len(words) > 0
), asked AS (
  SELECT DISTINCT no, item_id, term FROM (
    SELECT row_number() OVER () AS no, item_id, unnest(regexp_extract_all({LOWER}, '{WORD}')) AS term FROM benchmark)
), held AS (
  SELECT no, doc_id, n, term, count(*) AS tf
  FROM (SELECT no, doc_id, len(words) AS n, unnest(words) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals
), parts AS (
  SELECT no, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words))) AS part
  FROM held JOIN weighed USING (term), totals
), scored AS (
  SELECT a.no, a.item_id, p.doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM asked a JOIN parts p USING (term) GROUP BY a.no, a.item_id, p.no, p.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES |= {"op11_target_resampling": RESAMPLING, "op13_lexical_search": SEARCH}
