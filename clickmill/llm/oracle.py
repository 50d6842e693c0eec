"""DuckDB SQL for the operators whose results SQL can state."""

NEAR_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), components AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN components c USING (vec_id) LEFT JOIN degrees d USING (vec_id)
"""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source
), levels AS (
  SELECT *,
    CAST(sum(n) OVER () - coalesce(sum(3 * n) OVER before, 0) AS BIGINT)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS level,
    row_number() OVER (ORDER BY n / weight, place) AS step
  FROM sources
  WINDOW before AS (ORDER BY n / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), first_free AS (
  SELECT level, step FROM levels WHERE 3 * n > level * weight ORDER BY step LIMIT 1
), targets AS (
  SELECT l.source, l.n, l.weight,
    CASE WHEN f.step IS NULL OR l.step < f.step THEN CAST(3 * l.n AS DOUBLE) ELSE f.level * l.weight END AS target,
    1 - (l.weight - 2) * 0.5::DOUBLE AS w0, 1 + (l.weight - 2) * 0.5::DOUBLE AS w1
  FROM levels l LEFT JOIN first_free f ON true
), placed AS (
  SELECT s.doc_id, s.size, s.source, t.n AS source_size, t.target, t.w0, t.w1,
    CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source
      ORDER BY md5('mix' || coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, [(source_size * k + before + size / 2) / target FOR k IN [0, 1, 2]] AS shares,
    CAST(before + size / 2 < target AS INTEGER)
      + CAST(source_size + before + size / 2 < target AS INTEGER)
      + CAST(source_size * 2 + before + size / 2 < target AS INTEGER) AS passes
  FROM placed
), timed AS (
  SELECT *, [CASE WHEN k <= passes THEN 2 * shares[k] / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * shares[k])) ELSE -1 END
    FOR k IN [1, 2, 3]] AS moments
  FROM taken
)
SELECT doc_id, size, source, source_size, target, passes, passes * size AS taken,
  moments[1] AS position, moments[2] AS position_2, moments[3] AS position_3
FROM timed
"""

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LEAKS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS place, doc_id,
    coalesce(regexp_extract_all(translate(text, '{LETTERS}', '{LETTERS.lower()}'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, '{LETTERS}', '{LETTERS.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, len(w[i : i + 9]) AS n, array_to_string(w[i : i + 9], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT place, i, n, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT place, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT place, i, n, item_id FROM doc_windows JOIN windows USING (n, words)
), hit_words AS (
  SELECT place, count(DISTINCT p) AS n_hit
  FROM (SELECT place, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT place, i, n FROM hits)) GROUP BY place
), hit_items AS (
  SELECT place, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL)) AS items
  FROM hits GROUP BY place
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (place) LEFT JOIN hit_items USING (place)
"""
