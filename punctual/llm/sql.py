"""DuckDB statements for those queries whose whole result SQL can state.

They share no code with the operators: links come from all pairs, components from a
recursion, windows of lines are compared as texts.
"""

from __future__ import annotations

_REACH = """
reach(a, b) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
"""

NEAR_DOCUMENTS = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
runs AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM split WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM runs x JOIN runs y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 85 * (p.n + q.n - k)
),
nodes AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

NEAR_VECTORS = f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS length
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
  WHERE list_dot_product(e, e) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM sound x JOIN sound y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) / (x.length * y.length) >= 0.98
),
nodes AS (SELECT vec_id AS id FROM embeddings),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),
{_REACH}
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""

LINES = """
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(l[i : i + 2], chr(10)) AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM split WHERE len(l) >= 3)
),
numbered AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM windows
),
gone AS (
  SELECT doc_id, list(DISTINCT i + o) AS lost
  FROM numbered, (SELECT unnest([0, 1, 2]) AS o) WHERE nth > 1 GROUP BY doc_id
)
SELECT s.doc_id, len(l) AS n_lines, coalesce(len(lost), 0) AS n_removed,
  CASE WHEN lost IS NULL THEN text ELSE array_to_string(list_transform(
    list_filter(range(1, len(l) + 1), lambda x: NOT list_contains(lost, x)), lambda x: l[x]), chr(10))
  END AS text
FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id
"""

# Kind, pattern, group whose length counts, least length.
_SECRETS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", 0, 1),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("url", r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:([^\s/:@]{3,128})@[^\s/:@]+", 0, 1),
]


def _kind_spans(nth: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT doc_id, '{kind}' AS kind, {nth} AS nth, pos, stop FROM (
    SELECT doc_id, stop - length(m) AS pos, stop, length(k) AS counted FROM (
      SELECT doc_id, unnest(ms) AS m, unnest(ks) AS k, unnest(list_transform(range(1, len(ms) + 1),
        lambda i: CAST(list_sum(list_transform(gaps[1 : i], lambda x: length(x)))
                  + list_sum(list_transform(ms[1 : i], lambda x: length(x))) AS BIGINT))) AS stop
      FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS ms,
              regexp_extract_all(text, '{pattern}', {group}) AS ks,
              string_split_regex(text, '{pattern}') AS gaps
            FROM pieces))) WHERE counted >= {least}"""


SECRETS = f"""
WITH pieces AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_kind_spans(n, *s) for n, s in enumerate(_SECRETS))}),
written AS (
  SELECT doc_id, nth, pos, kind, kind || ':' || pos || ':' || stop AS span FROM found
)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
  count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY pos, nth) FILTER (nth < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY pos, nth), '') AS spans
FROM documents d LEFT JOIN written w ON w.doc_id = d.doc_id GROUP BY d.doc_id
"""

SEARCH = r"""
WITH terms AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL
),
lengths AS (SELECT doc_id, len(t) AS n FROM terms WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
held AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM terms) GROUP BY ALL
),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total
),
impacts AS (
  SELECT h.doc_id, h.term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)) AS i
  FROM held h JOIN lengths l ON l.doc_id = h.doc_id, total
),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * i) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r,
    doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 10
"""

STATEMENTS = {
    "op3_minhash": NEAR_DOCUMENTS,
    "op4_binary_codes": NEAR_VECTORS,
    "op8_lines": LINES,
    "op10_secrets": SECRETS,
    "op12_search": SEARCH,
}
