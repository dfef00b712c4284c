"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from medalyst.llm.secrets import BASE, WIDER

NEAR_DUPLICATES = r"""WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE
      WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
  n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY 1),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
  e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
  both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
  reach(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a)
  SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
  FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, MIN(other) AS component_id FROM reach GROUP BY 1) c USING (doc_id)"""


def _spans(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    """The spans of one pattern in ``t``: what stands before a match gives its place."""
    quoted = pattern.replace("'", "''")
    return f"""(SELECT list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
        'start': CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS INTEGER),
        'kind': {number}, 'name': '{kind}', 'size': CAST(length(m[i]) AS INTEGER), 'value': v[i]}}), lambda s: length(s.value) >= {least})
      FROM (SELECT string_split_regex(t, '{quoted}') AS g, regexp_extract_all(t, '{quoted}') AS m, regexp_extract_all(t, '{quoted}', {group}) AS v))"""


def secret_ownership(copied_owners: int = 3) -> str:
    base = [_spans(i, *kind) for i, kind in enumerate(BASE)]
    wider = [_spans(len(BASE) + i, *kind) for i, kind in enumerate(WIDER)]
    joined = lambda lists: lists[0] if len(lists) == 1 else f"list_concat({joined(lists[:-1])}, {lists[-1]})"
    listed = lambda spans: f"COALESCE(array_to_string(list_transform({spans}, lambda x: x.name || ':' || x.start || ':' || (x.start + x.size)), ','), '')"
    counts = ", ".join(f"CAST(len(list_filter(base, lambda x: x.kind = {i})) AS BIGINT) AS n_{kind}" for i, (kind, *_) in enumerate(BASE))
    return f"""WITH d AS (SELECT doc_id, source, COALESCE(text, '') AS t FROM documents),
  f AS (SELECT doc_id, source, list_sort({joined(base)}) AS base, list_sort({joined(wider)}) AS wide FROM d),
  o AS (SELECT doc_id, source, base, list_filter(wide,
      lambda x: len(list_filter(base, lambda b: b.start < x.start + x.size AND x.start < b.start + b.size)) = 0) AS wide FROM f),
  c AS (SELECT value, COUNT(DISTINCT source) AS owners FROM (SELECT source, unnest(list_concat(base, wide)).value AS value FROM o) GROUP BY 1),
  shared AS (SELECT COALESCE(list(value), []) AS many FROM c WHERE owners >= {copied_owners}),
  j AS (SELECT doc_id, base, list_filter(wide, lambda x: NOT list_contains(many, x.value)) AS added,
      list_filter(base, lambda x: NOT list_contains(many, x.value)) AS own FROM o, shared)
  SELECT doc_id, {counts}, sha256({listed('base')}) AS base_sha256, {listed('list_sort(list_concat(base, added))')} AS spans,
    CAST(len(own) + len(added) AS BIGINT) AS n_live, CAST(len(base) - len(own) AS BIGINT) AS n_copied FROM j"""


HARD_NEGATIVES = """WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
    FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
  p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
  QUALIFY rank <= 10"""


def _words_in_windows(size: int, name: str) -> str:
    """Words of a document inside windows of ``size`` words that it holds twice or more."""
    return f"""{name} AS (SELECT doc_id, COUNT(DISTINCT word) AS n FROM (
      SELECT doc_id, unnest(range(pos, pos + {size})) AS word FROM (
        SELECT doc_id, pos, COUNT(*) OVER (PARTITION BY doc_id, array_to_string(w[pos:pos + {size - 1}], ' ')) AS copies
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS pos FROM d)) WHERE copies > 1) GROUP BY 1)"""


REPETITION_RULES = rf"""WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  {_words_in_windows(3, 'windows')},
  {_words_in_windows(10, 'spans')},
  {_words_in_windows(41, 'long')},
  c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
  f AS (SELECT c.doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
      COALESCE(windows.n, 0) AS n_repeat_words, COALESCE(spans.n, 0) AS n_covered, long.n IS NOT NULL AS too_long,
      n_words < 50 OR 100 * COALESCE(windows.n, 0) > 50 * n_words AS base_failed
    FROM c LEFT JOIN windows USING (doc_id) LEFT JOIN spans USING (doc_id) LEFT JOIN long USING (doc_id))
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, base_failed,
    NOT base_failed AND NOT too_long AND n_covered <= 0.2 * n_words AS kept FROM f"""
