"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import imatch, warc


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _resolved(sql: str) -> str:
    name = "split_part(piece, ';', 1)"
    code = f"""CASE WHEN regexp_full_match({name}, '#[0-9]{{1,7}}') THEN try_cast({name}[2:] AS INTEGER)
      WHEN regexp_full_match({name}, '#[xX][0-9a-fA-F]{{1,6}}') THEN try_cast('0x' || {name}[3:] AS INTEGER) END"""
    named = " ".join(f"WHEN {_quoted(n)} THEN {_quoted(c)}" for n, c in warc.NAMES.items())
    char = f"""CASE WHEN instr(piece, ';') BETWEEN 2 AND {warc.LONGEST + 1} THEN
      CASE WHEN NOT starts_with(piece, '#') THEN CASE {name} {named} END
        WHEN ({code}) BETWEEN 1 AND 55295 OR ({code}) BETWEEN 57344 AND 1114111 THEN chr({code}) END END"""
    one = f"CASE WHEN place = 1 THEN piece ELSE coalesce({char} || substr(piece, instr(piece, ';') + 1), '&' || piece) END"
    return f"array_to_string(list_transform(string_split({sql}, '&'), lambda piece, place: {one}), '')"


def _warc(date: str) -> str:
    edge = "'^[\"'']|[\"'']\\z'"
    scheme = "'^[a-zA-Z][a-zA-Z0-9+.-]*:'"
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
r AS (
  SELECT *, 'sha256:' || sha256(html) AS source_digest, regexp_replace(html, {_quoted(warc.UNSEEN)}, '', 'g') AS seen,
    md5(concat_ws(' ', 'response', coalesce(page_id::VARCHAR, ''), url, md5(html))) AS m,
    regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*:)', 1) AS scheme, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS host,
    regexp_extract(url, '^([^?#]*/)', 1) AS folder, regexp_extract(url, '^([^?#]*)', 1) AS page, regexp_extract(url, '^([^#]*)', 1) AS bare
  FROM p
),
t AS (
  SELECT *, '<urn:uuid:' || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] || '>' AS refers_to,
    trim(regexp_replace({_resolved(f"regexp_extract(html, {_quoted(warc.TITLE)}, 1)")}, '[ \\t\\r\\n\\f\\x{{00A0}}]+', ' ', 'g')) AS title,
    list_transform(regexp_extract_all(seen, {_quoted(warc.LINK)}, 1), lambda x: trim({_resolved(f"regexp_replace(x, {edge}, '', 'g')")})) AS refs,
    trim(regexp_replace(regexp_replace(regexp_replace({_resolved(f"regexp_replace(regexp_replace(replace(seen, chr(10), ' '), {_quoted(warc.BREAK)}, chr(10), 'g'), {_quoted(warc.TAG)}, '', 'g')")},
      {_quoted(warc.BLANKS)}, ' ', 'g'), {_quoted(warc.LINES)}, chr(10), 'g'), '^[ \\n]+|[ \\n]+\\z', '', 'g')) AS plain
  FROM r
),
b AS (
  SELECT page_id, url, refers_to, source_digest, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    array_to_string(list_concat(
      ['source-record-id: ' || refers_to, 'source-target-uri: ' || url, 'source-date: {date}', 'source-payload-digest: ' || source_digest,
       'source-http: HTTP/1.1 200 OK', 'source-http: Content-Type: text/html; charset=UTF-8', 'source-http: Content-Length: ' || strlen(html), 'title: ' || title],
      list_transform(refs, lambda x: 'outlink: ' || CASE
        WHEN regexp_matches(x, {scheme}) THEN x WHEN starts_with(x, '//') THEN scheme || x WHEN starts_with(x, '/') THEN host || x
        WHEN starts_with(x, '?') OR x = '' THEN page || x WHEN starts_with(x, '#') THEN bare || x
        ELSE CASE WHEN length(folder) > length(host) THEN folder ELSE host || '/' END || x END)
    ), chr(13) || chr(10)) || chr(13) || chr(10) AS block
  FROM t
  UNION ALL
  SELECT page_id, url, refers_to, source_digest, 'conversion', 'text/plain; charset=UTF-8', plain FROM t
),
n AS (SELECT *, md5(warc_type || ' ' || refers_to) AS m, strlen(block)::BIGINT AS content_length, 'sha256:' || sha256(block) AS block_digest FROM b),
i AS (SELECT *, '<urn:uuid:' || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] || '>' AS record_id FROM n)
SELECT page_id, warc_type, record_id, refers_to, url AS target_uri, content_type, content_length, block_digest, source_digest,
  array_to_string(['WARC/1.1', 'WARC-Type: ' || warc_type, 'WARC-Record-ID: ' || record_id, 'WARC-Date: {date}', 'WARC-Target-URI: ' || url,
    'WARC-Refers-To: ' || refers_to, 'WARC-Refers-To-Target-URI: ' || url, 'WARC-Refers-To-Date: {date}', 'WARC-Source-Payload-Digest: ' || source_digest,
    'WARC-Block-Digest: ' || block_digest, 'Content-Type: ' || content_type, 'Content-Length: ' || content_length], chr(13) || chr(10)) AS header,
  block
FROM i
"""


_KD = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_IMATCH = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT *, coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id FROM d),
e AS (SELECT o.doc_id, o.next_id, o.n, o.t, left(o.t, o.n - o.n // 3) || left(x.t, o.n // 3) AS edited FROM o JOIN d x ON x.doc_id = o.next_id),
sides AS (SELECT doc_id, 'p' AS side, t FROM e UNION ALL SELECT doc_id, 'q', edited FROM e),
words AS (SELECT doc_id, side, unnest(list_distinct(list_filter(regexp_split_to_array(lower(t), {_quoted(imatch.APART)}), lambda x: x <> ''))) AS term FROM sides),
lexicon AS (
  SELECT term FROM words WHERE side = 'p' GROUP BY term
  HAVING count(*) BETWEEN greatest({imatch.LEAST}, {imatch.LOW} * (SELECT count(*) FROM d)) AND greatest({imatch.LEAST}, {imatch.HIGH} * (SELECT count(*) FROM d))
),
subsets AS (SELECT term, j FROM lexicon, range({imatch.SUBSETS}) r(j) WHERE md5(j || ':' || term) < {list(imatch.BOUNDS)}[j // 16 + 1]),
hashes AS (SELECT doc_id, side, j, left(md5(string_agg(term, ' ' ORDER BY term)), {imatch.HASH_DIGITS}) AS h FROM words JOIN subsets USING (term) GROUP BY ALL),
whole AS (
  SELECT s.doc_id, s.side, r.j, CASE WHEN r.j < {imatch.SUBSETS} THEN h.h WHEN NOT EXISTS (FROM hashes x WHERE x.doc_id = s.doc_id AND x.side = s.side) THEN left(md5(s.t), {imatch.HASH_DIGITS}) END AS h
  FROM sides s CROSS JOIN range({imatch.SUBSETS + 1}) r(j) LEFT JOIN hashes h ON h.doc_id = s.doc_id AND h.side = s.side AND h.j = r.j
),
prints AS (SELECT doc_id, side, string_agg(coalesce(h, '-'), '.' ORDER BY j) AS print, list(h ORDER BY j) AS hs FROM whole GROUP BY ALL),
likes AS (
  SELECT e.doc_id, e.n, e.edited, p.print, q.print AS edited_print, list_zip(p.hs, q.hs) AS pq, list_zip(p.hs, x.hs) AS px
  FROM e JOIN prints p ON p.doc_id = e.doc_id AND p.side = 'p' JOIN prints q ON q.doc_id = e.doc_id AND q.side = 'q' JOIN prints x ON x.doc_id = e.next_id AND x.side = 'p'
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, print AS fingerprint, edited_print AS edited_fingerprint,
  len(list_filter(pq, lambda z: z[1] = z[2])) / len(list_filter(pq, lambda z: z[1] IS NOT NULL OR z[2] IS NOT NULL))::DOUBLE AS near_edited,
  len(list_filter(px, lambda z: z[1] = z[2])) / len(list_filter(px, lambda z: z[1] IS NOT NULL OR z[2] IS NOT NULL))::DOUBLE AS near_next
FROM likes
"""

_NEAR = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
  FROM w
),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach AS (SELECT doc_id AS id, doc_id AS c FROM s UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(r.c) AS component_id, min(r.c) = s.doc_id AS kept
FROM s JOIN reach r ON r.id = s.doc_id GROUP BY s.doc_id, s.sh
"""


def _ball(rounds: int = 4, parts: int = 4, entries: int = 256, scale: int = 1024) -> str:
    """All distances of all parts and entries, round by round; a distance and its entry are one number, least first."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, part, min(d * {entries} + entry) % {entries} AS entry, min(d * {entries} + entry) // {entries} AS d FROM (
    SELECT x.vec_id, x.part, c.entry, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{k} c USING (part, pos) GROUP BY ALL
  ) GROUP BY vec_id, part
)""")
        if k < rounds:
            steps.append(f"""
m{k} AS (SELECT part, pos, entry, sum(x)::BIGINT AS s, count(*) AS n FROM a{k} JOIN x USING (vec_id, part) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (
  SELECT entry, part, pos, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{k} c LEFT JOIN m{k} USING (entry, part, pos)
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
x AS MATERIALIZED (
  SELECT vec_id, (i - 1) // (len(v) // {parts}) AS part, (i - 1) % (len(v) // {parts}) AS pos, v[i] AS x FROM kept, unnest(range(1, len(v) + 1)) r(i)
),
c0 AS MATERIALIZED (
  SELECT entry, part, pos, x FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept) JOIN x USING (vec_id) WHERE entry < {entries}
),{",".join(steps)},
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


_MINED = """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM e a JOIN e c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score WHERE place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_warc_derivatives": _warc("2024-01-01T00:00:00Z"),
    "op6_kd_trees": _KD,
    "op9_imatch": _IMATCH,
    "op10_hyperminhash": _NEAR,
    "op11_ball_kmeans": _ball(),
    "op13_inverted_multi_index": _MINED,
}
