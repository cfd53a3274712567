"""DuckDB SQL for the queries that SQL can express."""

OP4 = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
),
frequent AS (
  SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT k.doc_id, k.line, k.pos, (f.key IS NOT NULL AND k.doc_id <> f.keep) AS dropped
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _position(slot: int, knots: tuple[tuple[float, float], ...], share: str) -> str:
    """Inverse of the integral of a piecewise linear schedule, as SQL."""
    area = sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:]))
    done, cases = 0.0, []
    for (a, v), (b, w) in zip(knots, knots[1:]):
        weight, slope = v / area, (w - v) / (b - a) / area
        cases.append((done, f"{a!r}::DOUBLE + 2 * ({share} - {done!r}::DOUBLE) / ({weight!r}::DOUBLE + sqrt(greatest(0.0::DOUBLE, {weight!r}::DOUBLE * {weight!r}::DOUBLE + 2 * {slope!r}::DOUBLE * ({share} - {done!r}::DOUBLE))))"))
        done += (b - a) * (v + w) / 2 / area
    whens = " ".join(f"WHEN {share} >= {begin!r}::DOUBLE THEN {x}" for begin, x in reversed(cases[1:]))
    last = f"CASE {whens} ELSE {cases[0][1]} END" if whens else cases[0][1]
    return f"WHEN slot = {slot} THEN {last}"


OP10 = r"""
WITH slim AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM slim GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank FROM totals
),
weighed AS (SELECT *, CASE rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, 2 * source_size AS cap FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
),
found AS (SELECT first(level ORDER BY cap / w, rank) AS level FROM levels WHERE level * w <= cap),
targets AS (
  SELECT source, source_size, rank % 3 AS slot, least(cap::DOUBLE, coalesce((SELECT level FROM found) * w, cap::DOUBLE)) AS target FROM levels
),
streams AS (
  SELECT s.*, t.source_size, t.slot, t.target, floor(t.target + 0.5)::BIGINT AS goal,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM slim s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
taken AS (
  SELECT *, greatest(0, least(size, goal - start)) AS first_taken, greatest(0, least(size, goal - start - source_size)) AS second_taken,
         start / greatest(target, 1.0::DOUBLE) AS share FROM streams
)
SELECT doc_id, size, source_size, target, (first_taken + second_taken)::BIGINT AS taken,
       CASE WHEN first_taken > 0 THEN CASE {cases} END END AS position
FROM taken
"""

_SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 0.75), (0.5, 1.25), (1.0, 0.75)),
)
ORACLES = {
    "op4_line_dedup": OP4,
    "op10_mixing": OP10.replace("{cases}", " ".join(_position(k, knots, "share") for k, knots in enumerate(_SCHEDULES))),
}

#: all pairs of classes of equal sets, on as many documents as DuckDB can hold; components by recursion
OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s FROM words
),
classes AS MATERIALIZED (SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS MATERIALIZED (SELECT rep, n, unnest(s) AS x FROM classes),
links AS MATERIALIZED (
  SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.x = b.x AND a.rep <> b.rep AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reach(node, seen) AS (
  SELECT rep, rep FROM classes
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
),
found AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT t.doc_id, len(t.s)::BIGINT AS n_shingles, coalesce(f.component, t.doc_id) AS component_id
FROM sets t LEFT JOIN classes c ON len(t.s) > 0 AND c.s = t.s LEFT JOIN found f ON f.node = c.rep
"""
ORACLES["op5_ngram_jaccard"] = OP5

#: digests of payloads in base32, five hexadecimal digits making four letters
OP9 = r"""
WITH slim AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(encode(html)) AS h FROM slim),
named AS (
  SELECT page_id, n, h, array_to_string(list_transform(range(8), lambda i:
    array_to_string(list_transform([15, 10, 5, 0], lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, 5 * i + 1, 5))::BIGINT >> k) & 31) + 1)::INT, 1)), '')), '') AS digest FROM digests
),
firsts AS (SELECT h, min(page_id) AS first FROM named GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM named JOIN firsts USING (h)
"""
ORACLES["op9_warc"] = OP9
