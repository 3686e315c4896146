"""DuckDB SQL for the queries of this folder; its constants are its own."""

MIX_COPIES = r"""
d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM {documents}
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM d GROUP BY source
), w AS (
  SELECT *, 2 * source_size AS lim, CASE sid % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s
), o AS (
  SELECT *, row_number() OVER f AS k,
    sum(lim) OVER f AS held, sum(weight) OVER f AS held_weight,
    sum(source_size) OVER () AS everything, sum(weight) OVER () AS all_weight, count(*) OVER () AS n
  FROM w WINDOW f AS (ORDER BY lim / weight, sid ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT 0 AS k, min(n) AS n, (1.5::DOUBLE * min(everything)) / min(all_weight) AS level FROM o
  UNION ALL
  SELECT k, n, (1.5::DOUBLE * everything - held) / nullif(all_weight - held_weight, 0) FROM o
), level AS (
  SELECT l.level FROM levels l LEFT JOIN o ON o.k = l.k + 1
  WHERE l.k = l.n OR l.level * o.weight <= o.lim ORDER BY l.k LIMIT 1
), t AS (
  SELECT sid, source, source_size,
    CASE WHEN level.level IS NULL THEN lim::DOUBLE ELSE least(level.level * weight, lim::DOUBLE) END AS target,
    ('0x' || substr(md5('42:source:' || sid), 1, 6))::BIGINT AS shift
  FROM w, level
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(target / source_size * 16777216)::BIGINT ELSE 0 END AS expected FROM t
), r AS (
  SELECT d.doc_id, d.size, e.*, (row_number() OVER (
    PARTITION BY e.sid ORDER BY d.size, md5('42:' || d.doc_id), d.doc_id) - 1) * expected + shift AS start
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
), mix AS (
  SELECT doc_id, size, source, source_size, target, ((start + expected) // 16777216 - start // 16777216)::BIGINT AS copies
  FROM r
)"""

MIX = f"""WITH {MIX_COPIES.format(documents="documents")}
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM mix"""

QUALITY_ROWS = r"""
texts AS (
  SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS text FROM documents
), counted AS (
  SELECT id, doc_id, source, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT id, i, array_to_string(words[i:i + 7], ' ') AS gram
  FROM (SELECT id, words, unnest(range(1, len(words) - 6)) AS i FROM counted)
), again AS (
  SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, gram) AS c FROM windows) WHERE c > 1
), repeated AS (
  SELECT id, sum(n) AS n FROM (
    SELECT id, least(8, coalesce(lead(i) OVER (PARTITION BY id ORDER BY i) - i, 8)) AS n FROM again) GROUP BY id
), stats AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM counted LEFT JOIN repeated USING (id)
), judged AS (
  SELECT *, (n_words < 20)::INT AS r1, (100 * n_repeat_words > 30 * n_words)::INT AS r2, (2 * n_symbols > n_words)::INT AS r3
  FROM stats
), hosts AS (
  SELECT source, count(*) AS n, sum(r1) AS r1, sum(r2) AS r2, sum(r3) AS r3 FROM judged GROUP BY source
), prior AS (
  SELECT rule, avg(failed / n) AS mean, var_pop(failed / n) AS var
  FROM (SELECT source, n, unnest([1, 2, 3]) AS rule, unnest([r1, r2, r3]) AS failed FROM hosts) GROUP BY rule
), strength AS (
  SELECT rule, mean, CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, 2), 10000) ELSE 10000 END AS k
  FROM prior
), verdict AS (
  SELECT source, max((failed + mean * k) / (n + k)) > 0.5 AS rejected
  FROM (SELECT source, n, unnest([1, 2, 3]) AS rule, unnest([r1, r2, r3]) AS failed FROM hosts) JOIN strength USING (rule)
  GROUP BY source
), quality AS (
  SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 + r2 > 0 AS base_failed,
    r1 + r2 = 0 AND NOT rejected AS kept
  FROM judged j JOIN verdict v ON j.source IS NOT DISTINCT FROM v.source
)"""

QUALITY = f"WITH {QUALITY_ROWS} SELECT * FROM quality"


def _either_case(words: str) -> str:
    """A pattern with each letter in either case, ASCII letters only."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


_GIVEN = r"""["\x27]?\x20*[:=]\x20*["\x27]?"""
_ASSIGN = f"({_either_case('password|passwd|secret|token|api_?key')}){_GIVEN}([A-Za-z0-9+/_.=-]+)"
_IDENTIFIER = (
    f"({_either_case('account|access_?key|app|application|client|key|login|tenant|user')})_?({_either_case('id|name')})?"
    f"{_GIVEN}[A-Za-z0-9_.@+-]{{4,}}"
)
_ENDPOINT = (
    f"({_either_case('amqp|ftp|https?|mongodb|mysql|postgres|postgresql|redis|s3')})://[A-Za-z0-9_.:@/?&=%+~#-]{{4,}}"
    f"|({_either_case('database|endpoint|host|hostname|server')}){_GIVEN}[A-Za-z0-9_.:/-]{{4,}}"
)
_KEY = "[A-Za-z0-9+/]{40,}"

# Name, pattern and what a match must satisfy, in the order in which spans of one start stand.
_SPAN_KINDS = (
    ("assign", _ASSIGN, f"length(regexp_extract(value, '{_ASSIGN}', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(value) >= 20"),
    ("hex", "[0-9a-f]+", "length(value) >= 24"),
    ("identifier", _IDENTIFIER, "true"),
    ("key", _KEY, "length(value) = 40 AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')"),
    ("endpoint", _ENDPOINT, "true"),
    ("scope", "\\n[\\x20\\t\\r]*\\n", "true"),
)


def _spans(number: int, pattern: str, holds: str) -> str:
    return f"""
  SELECT id, {number} AS kind, value, "end" - length(value) AS start, "end" FROM (
    SELECT id, value, (sum(length(piece) + length(value)) OVER (PARTITION BY id ORDER BY i))::BIGINT AS "end" FROM (
      SELECT id, unnest(pieces[:len(hits)]) AS piece, unnest(hits) AS value, unnest(range(len(hits))) AS i FROM (
        SELECT id, string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS hits FROM texts)))
  WHERE {holds}"""


_ALL_SPANS = "\n  UNION ALL".join(_spans(i, pattern, holds) for i, (_, pattern, holds) in enumerate(_SPAN_KINDS))
_KIND_NAMES = ", ".join(f"'{name}'" for name, _, _ in _SPAN_KINDS)

CREDENTIALS = f"""WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
), matched AS ({_ALL_SPANS}
), placed AS (
  SELECT m.*, [1, 0, 1, 0, 1, 2][kind + 1] AS role,
    (SELECT count(*) FROM matched s WHERE s.kind = 6 AND s.id = m.id AND s.start < m.start) AS scope
  FROM matched m WHERE kind < 6
), parts AS (
  SELECT * FROM placed p WHERE kind < 3 OR NOT EXISTS (
    SELECT 1 FROM placed s WHERE s.kind < 3 AND s.id = p.id AND s.start < p."end" AND s."end" > p.start)
), ends AS (
  SELECT id, scope, role, unnest([start, "end"]) AS at FROM parts WHERE role < 2
), linked AS (
  SELECT id, kind, start, "end" FROM (
    SELECT w.id, w.kind, w.start, w."end", w.role, count(DISTINCT e.role) AS roles
    FROM parts w JOIN ends e ON e.id = w.id AND e.scope = w.scope AND e.role <> w.role
      AND e.at BETWEEN w.start - 400 AND w."end" + 400
    WHERE w.kind >= 3 GROUP BY ALL)
  WHERE role < 2 OR roles = 2
), spans AS (
  SELECT id, kind, start, [{_KIND_NAMES}][kind + 1] || ':' || start || ':' || "end" AS span
  FROM (SELECT id, kind, start, "end" FROM parts WHERE kind < 3 UNION ALL SELECT * FROM linked)
), per_text AS (
  SELECT id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM spans GROUP BY id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per_text USING (id)"""


NEGATIVES = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""
