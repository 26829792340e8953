"""The registered queries in plain SQL, as an independent check of their results."""

from __future__ import annotations

NAMESPACE = "f8a7c9a1e45f4e6d8f3c1b7a2b9e8d0f"


def _point_id(question: str, source: str) -> str:
    name = f"'question:' || {question} || '|source:' || replace({source}, chr(92), '/')"
    h = f"sha1(from_hex('{NAMESPACE}') || encode({name}))"
    return (
        f"substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
        f"translate(substr({h},17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr({h},18,3) || '-' || "
        f"substr({h},21,12)"
    )


_CONTENT_HASH = (
    "sha256(sha256(q) || sha256(a) || sha256(product) || "
    "sha256(coalesce(array_to_string(list_transform(keywords, lambda k: sha256(k)), ''), '')))"
)

_DOCUMENT_ITEMS = """
  SELECT 'docs' || chr(92) || source || '.json' AS source, doc_id AS pos, text AS q, text AS a,
         lang AS product, [lang, source] AS keywords
  FROM documents"""

_PAIRS = """
  SELECT 'conversations/' || u.conv_id || '.json' AS source, u.turn AS pos, u.text AS q, r.text AS a,
         'chat' AS product, CAST([] AS VARCHAR[]) AS keywords
  FROM conversations u JOIN conversations r ON r.conv_id = u.conv_id AND r.turn = u.turn + 1
  WHERE u.role = 'user' AND r.role = 'assistant'"""

_ITEMS = f"items AS ({_DOCUMENT_ITEMS} UNION ALL {_PAIRS})"

_EARLIER_ITEMS = f"""earlier_items AS (
  SELECT d.source, d.pos, d.q, CASE WHEN l.quality = 1 THEN d.a ELSE d.product END AS a, d.product,
         d.keywords, l.quality, l.toxic
  FROM ({_DOCUMENT_ITEMS}) d JOIN labels l ON l.doc_id = d.pos
  UNION ALL
  SELECT 'benchmark.json', item_id, text, text, 'benchmark', CAST([] AS VARCHAR[]), 1, 0 FROM benchmark
  UNION ALL
  SELECT 'prompts/' || conv_id || '.json', turn, text, text, 'chat', CAST([] AS VARCHAR[]), 1, 0
  FROM conversations WHERE role = 'system')"""


def _last(name: str, items: str, digest: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY source DESC, pos DESC) AS rn,
           count(*) OVER (PARTITION BY point_id) AS copies
    FROM (SELECT *, {_point_id('q', 'source')} AS point_id, {digest} AS question_hash FROM {items}))
  WHERE rn = 1)"""


def _compared(digest: str) -> str:
    return f"""WITH {_ITEMS}, {_EARLIER_ITEMS},
{_last('c', 'items', digest)},
{_last('e', 'earlier_items', digest)},
p AS (
  SELECT point_id,
         CASE WHEN quality = 1 OR toxic <> 1 THEN source END AS source_file,
         CASE WHEN quality = 1 AND toxic <> 1 THEN question_hash
              WHEN quality <> 1 AND toxic <> 1 THEN sha256(question_hash) END AS question_hash
  FROM e),
compared AS (
  SELECT coalesce(c.point_id, p.point_id) AS point_id,
         CASE WHEN c.point_id IS NULL THEN 'delete'
              WHEN p.point_id IS NULL OR (p.source_file IS NULL AND p.question_hash IS NULL) THEN 'insert'
              WHEN c.question_hash IS NOT DISTINCT FROM p.question_hash THEN 'unchanged'
              ELSE 'update' END AS op,
         c.source AS source_file, c.pos AS pos, c.question_hash AS question_hash,
         coalesce(c.copies, 0) AS copies, p.source_file AS previous_source,
         p.question_hash AS previous_hash, p.point_id IS NOT NULL AS was_known
  FROM c FULL OUTER JOIN p ON c.point_id = p.point_id)
"""


_BY_QUESTION = _compared("sha256(q)")
_BY_CONTENT = _compared(_CONTENT_HASH)
_OP_COUNTS = "SELECT op, count(*) AS ids, CAST(sum(copies) AS BIGINT) AS items FROM compared GROUP BY op"


def _totals(process: str) -> str:
    return f"""SELECT CAST(coalesce(sum(copies), 0) AS BIGINT) AS evaluated,
       CAST(coalesce(sum(CASE WHEN {process} THEN copies END), 0) AS BIGINT) AS attempted,
       count(*) FILTER (WHERE {process}) AS to_upsert,
       count(*) FILTER (WHERE op = 'insert') AS inserted, count(*) FILTER (WHERE op = 'update') AS updated,
       count(*) FILTER (WHERE op = 'unchanged') AS unchanged, count(*) FILTER (WHERE op = 'delete') AS to_delete,
       count(*) FILTER (WHERE was_known) AS previous_points
FROM compared"""


# Files, their status and their items, straight from the rows they are written from.
_FILE_ITEMS = """file_items AS (
  SELECT 'docs/' || doc_id || '.json' AS source, 0 AS pos, NULL AS reason, text AS q, text AS a,
         lang AS product, lang || '|' || source AS keywords FROM documents
  UNION ALL
  SELECT 'docs/' || doc_id || '.json', 1, 'wrong_type', NULL, NULL, NULL, NULL FROM documents
  UNION ALL
  SELECT 'docs/' || doc_id || '.json', 2, 'missing_key', NULL, NULL, NULL, NULL FROM documents
  UNION ALL
  SELECT 'turns/' || u.conv_id || '/' || u.turn, 0, CASE WHEN r.text IS NULL THEN 'missing_key' END,
         u.text, r.text, 'chat', ''
  FROM conversations u LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') r
    ON r.conv_id = u.conv_id AND r.turn = u.turn + 1
  WHERE u.role = 'user')"""

_FILES = f"""{_FILE_ITEMS}, files AS (
  SELECT source, 'ok' AS status, count(*) FILTER (WHERE reason IS NULL) AS valid_items,
         count(*) FILTER (WHERE reason IS NOT NULL) AS invalid_items FROM file_items GROUP BY source
  UNION ALL SELECT 'pages/' || page_id, 'malformed', 0, 0 FROM pages
  UNION ALL SELECT 'events/' || event_id, 'not_array', 0, 0 FROM events
  UNION ALL SELECT 'labels/' || doc_id, 'empty', 0, 0 FROM labels)"""


def _pieces(level: int, separator: str, size: int) -> str:
    """Cut the segments of one level at a separator; short pieces form runs, long ones go on."""
    return f"""
cut{level} AS (
  SELECT key, base, unnest(list_transform(parts, lambda x, i: {{'n': i, 'body': CASE WHEN i = 1 THEN x ELSE {separator} || x END}}),
         recursive := true)
  FROM (SELECT key, base, string_split(body, {separator}) AS parts FROM seg{level} WHERE contains(body, {separator}))),
piece{level} AS (
  SELECT key, base AS segment, n, body,
         base + sum(length(body)) OVER (PARTITION BY key, base ORDER BY n) - length(body) AS base,
         sum(CASE WHEN length(body) >= {size} THEN 1 ELSE 0 END) OVER (PARTITION BY key, base ORDER BY n) AS longer
  FROM cut{level} WHERE length(body) > 0),
run{level} AS (
  SELECT key, {level} AS level, segment, longer, list(base ORDER BY n) || [max(base + length(body))] AS cuts
  FROM piece{level} WHERE length(body) < {size} GROUP BY key, segment, longer),
seg{level + 1} AS (
  SELECT key, base, body FROM seg{level} WHERE NOT contains(body, {separator})
  UNION ALL SELECT key, base, body FROM piece{level} WHERE length(body) >= {size})"""


def _recursive_chunks(texts: str, size: int, overlap: int) -> str:
    """CTEs ending in ``chunks(key, chunk_no, chunk)`` for ``texts(key, body)``."""
    levels = ",".join(_pieces(i, s, size) for i, s in enumerate(("chr(10) || chr(10)", "chr(10)", "' '")))
    step = size - overlap
    return f"""
seg0 AS (SELECT key, CAST(0 AS HUGEINT) AS base, body FROM ({texts}) WHERE length(body) > 0),{levels},
runs AS (
  SELECT *, list_count(cuts) AS last FROM (
    SELECT * FROM run0 UNION ALL SELECT * FROM run1 UNION ALL SELECT * FROM run2)),
packed AS (
  SELECT key, level, segment, longer, cuts, last, CAST(1 AS BIGINT) AS a,
         CAST(len(list_filter(cuts, lambda x: x <= cuts[1] + {size})) AS BIGINT) AS b FROM runs
  UNION ALL
  SELECT key, level, segment, longer, cuts, last, s,
         CAST(len(list_filter(cuts, lambda x: x <= cuts[s] + {size})) AS BIGINT)
  FROM (
    SELECT *, CAST(least(b, 1 + len(list_filter(cuts,
        lambda x: x < greatest(cuts[b] - {overlap}, cuts[b + 1] - {size})))) AS BIGINT) AS s
    FROM packed WHERE b < last)),
spans AS (
  SELECT key, cuts[a] AS lo, cuts[b] AS hi FROM packed
  UNION ALL
  SELECT key, base + i * {step}, least(base + i * {step} + {size}, base + length(body)) FROM (
    SELECT key, base, body,
           unnest(range(0, CAST(greatest(1, ceil((length(body) - {overlap}) / {step})) AS BIGINT))) AS i
    FROM seg3)),
slices AS (
  SELECT key, lo, regexp_replace(substr(body, CAST(lo + 1 AS BIGINT), CAST(hi - lo AS BIGINT)),
                                 '^\\s+|\\s+$', '', 'g') AS chunk
  FROM spans JOIN ({texts}) USING (key)),
chunks AS (
  SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY lo) - 1 AS INTEGER) AS chunk_no, chunk
  FROM slices WHERE chunk <> '')"""


def _windows(text: str, size: int, overlap: int) -> str:
    step = size - overlap
    count = f"CAST(greatest(1, ceil((length({text}) - {overlap}) / {step})) AS BIGINT)"
    return f"list_transform(range(0, {count}), lambda i: substr({text}, 1 + i * {step}, {size}))"


def _vectors(texts: str, dim: int) -> str:
    """CTEs ending in ``vectors(key, digest)`` for ``texts(key, body)``: the hashed words, in whole millionths."""
    return f"""
tokens AS (
  SELECT key, md5(token) AS h FROM (
    SELECT key, unnest(regexp_split_to_array(body, '\\s+')) AS token FROM ({texts})) WHERE token <> ''),
cells AS (
  SELECT key, ('0x' || substr(h, 1, 8))::BIGINT % {dim} AS bucket,
         sum(CASE WHEN ('0x' || substr(h, 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS s
  FROM tokens GROUP BY ALL),
norms AS (SELECT key, sqrt(sum(s * s)) AS norm FROM cells GROUP BY key),
vectors AS (
  SELECT k AS key, sha256(string_agg(CAST(CAST(floor(
      CASE WHEN norm > 0 THEN CAST(CAST(coalesce(s, 0) / norm AS FLOAT) AS DOUBLE) ELSE 0 END * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS digest
  FROM (SELECT key AS k, norm, unnest(range(0, {dim})) AS i FROM norms) LEFT JOIN cells ON cells.key = k AND bucket = i
  GROUP BY k)"""


_DIGEST_OF_TWO_RUNS = f"""WITH {_ITEMS}, {_EARLIER_ITEMS},
{_last('c', 'items', _CONTENT_HASH)},
{_last('p', 'earlier_items', _CONTENT_HASH)}
"""

ORACLE: dict[str, str] = {
    "doc_identity": f"""SELECT pos AS doc_id, source, {_point_id('q', 'source')} AS point_id,
       sha256(q) AS question_hash FROM ({_DOCUMENT_ITEMS})""",
    "content_identity": f"WITH {_ITEMS} SELECT source, pos, {_CONTENT_HASH} AS content_hash FROM items",
    "qa_pairs": f"SELECT source, pos, q, a, product FROM ({_PAIRS})",
    "qa_valid": f"""WITH {_FILE_ITEMS}
SELECT source, CAST(pos AS BIGINT) AS pos, q, a, product, keywords FROM file_items WHERE reason IS NULL""",
    "qa_rejects": f"""WITH {_FILE_ITEMS}
SELECT source, CAST(pos AS BIGINT) AS pos, reason FROM file_items WHERE reason IS NOT NULL""",
    "reject_counts": f"""WITH {_FILE_ITEMS}
SELECT reason, count(*) AS items FROM file_items WHERE reason IS NOT NULL GROUP BY reason""",
    "file_status": f"WITH {_FILES} SELECT source, status, valid_items, invalid_items FROM files",
    "dropped_files": """
SELECT 'pages/' || page_id AS source, 'malformed' AS status, left(html, 150) AS raw FROM pages
UNION ALL SELECT 'events/' || event_id, 'not_array', left(props, 150) FROM events""",
    "corpus_totals": f"""WITH {_FILES}
SELECT count(*) AS files_found,
       count(*) FILTER (WHERE status IN ('ok', 'empty')) AS files_parsed,
       count(*) FILTER (WHERE status NOT IN ('ok', 'empty')) AS files_failed,
       count(*) FILTER (WHERE status = 'too_large') AS files_too_large,
       count(*) FILTER (WHERE valid_items > 0) AS files_with_items,
       CAST(sum(valid_items) AS BIGINT) AS items_valid, CAST(sum(invalid_items) AS BIGINT) AS items_invalid
FROM files""",
    "current_points": f"""WITH {_ITEMS}, {_last('c', 'items', 'sha256(q)')}
SELECT point_id, source AS source_file, pos, question_hash, copies FROM c""",
    "dedup_last_wins": f"""WITH items AS ({_DOCUMENT_ITEMS}), {_last('c', 'items', 'sha256(q)')}
SELECT point_id, pos, q, a, product, array_to_string(keywords, '|') AS keywords FROM c""",
    "diff_ops": f"""{_BY_QUESTION} SELECT point_id, op, source_file, coalesce(pos, -1) AS pos, question_hash,
       copies, previous_source, previous_hash, was_known FROM compared""",
    "diff_counts": f"{_BY_QUESTION} {_OP_COUNTS}",
    "diff_content_key": f"{_BY_CONTENT} {_OP_COUNTS}",
    "change_totals": _BY_QUESTION + _totals("op IN ('insert', 'update')"),
    "force_totals": _BY_QUESTION + _totals("op <> 'delete'"),
    "force_plan": f"""{_BY_QUESTION} SELECT point_id,
       CASE WHEN op = 'delete' THEN 'delete' ELSE 'upsert' END AS action FROM compared""",
    "diff_insert": f"""{_BY_QUESTION} SELECT c.point_id, c.source AS source_file FROM c WHERE NOT EXISTS (
  SELECT 1 FROM p WHERE p.point_id = c.point_id AND (p.source_file IS NOT NULL OR p.question_hash IS NOT NULL))""",
    "diff_changed": f"""{_BY_QUESTION} SELECT c.point_id, c.source AS source_file FROM c JOIN p USING (point_id)
WHERE (p.source_file IS NOT NULL OR p.question_hash IS NOT NULL)
  AND (p.question_hash IS NULL OR p.question_hash <> c.question_hash)""",
    "diff_unchanged": f"""{_BY_QUESTION} SELECT c.point_id, c.source AS source_file FROM c JOIN p USING (point_id)
WHERE p.question_hash = c.question_hash""",
    "diff_deleted": f"""{_BY_QUESTION} SELECT p.point_id, p.source_file FROM p
WHERE p.point_id NOT IN (SELECT point_id FROM c)""",
    "keep_unread": f"""{_BY_QUESTION}
SELECT op, count(*) AS ids, CAST(sum(copies) AS BIGINT) AS items FROM (
  SELECT CASE WHEN op = 'delete' AND starts_with(previous_source, 'prompts/') THEN 'unchanged' ELSE op END AS op,
         copies FROM compared)
GROUP BY op""",
    "next_state": f"""{_BY_QUESTION}
SELECT point_id, source AS source_file, question_hash FROM c""",
    "state_roundtrip": f"""{_BY_QUESTION}
SELECT point_id, source AS source_file, question_hash FROM c""",
    "state_repair": """
SELECT version, version <> '1.0' AS version_mismatch, count(*) AS states, CAST(sum(entries) AS BIGINT) AS entries
FROM (SELECT lang AS version, 1 AS entries FROM documents
      UNION ALL SELECT '1.0', 0 FROM events UNION ALL SELECT '1.0', 0 FROM pages)
GROUP BY version""",
    "applied_changes": f"""{_DIGEST_OF_TWO_RUNS}
SELECT p.point_id, p.source, p.pos, p.question_hash FROM p JOIN c USING (point_id)
WHERE p.question_hash = c.question_hash
UNION ALL
SELECT c.point_id, c.source, c.pos, c.question_hash FROM c LEFT JOIN p USING (point_id)
WHERE p.point_id IS NULL OR p.question_hash <> c.question_hash""",
    "chunk_fixed": f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_no, chunks[i] AS chunk
FROM (SELECT doc_id, chunks, unnest(range(1, len(chunks) + 1)) AS i
      FROM (SELECT doc_id, {_windows('text', 1000, 150)} AS chunks FROM documents))""",
    "chunk_fixed_stats": f"""
SELECT page_id, CAST(len(chunks) AS BIGINT) AS windows,
       CAST(list_sum(list_transform(chunks, lambda c: length(c))) AS BIGINT) AS chars,
       sha256(array_to_string(chunks, '|')) AS digest
FROM (SELECT page_id, {_windows('html', 120, 30)} AS chunks FROM pages)""",
    "chunk_recursive": f"""WITH RECURSIVE {_recursive_chunks('SELECT doc_id AS key, text AS body FROM documents', 1000, 150)}
SELECT key AS doc_id, chunk_no, chunk FROM chunks""",
    "chunk_recursive_small": f"""WITH RECURSIVE {_recursive_chunks(
        "SELECT {'conv_id': conv_id, 'turn': turn} AS key, text AS body FROM conversations", 120, 30)}
SELECT key.conv_id AS conv_id, key.turn AS turn, chunk_no, chunk FROM chunks""",
    "chunk_without_overlap": r"""
SELECT page_id, sha256(regexp_replace(html, '\s+', '', 'g')) AS digest, TRUE AS fits, FALSE AS any_blank
FROM pages WHERE length(html) > 0""",
    "payload_build": f"""WITH RECURSIVE {_ITEMS},
identified AS (SELECT *, {_point_id('q', 'source')} AS id FROM items), {_recursive_chunks(
        "SELECT {'id': id, 'pos': pos} AS key, a AS body FROM identified", 1000, 150)}
SELECT id, pos, q AS question, product, source, coalesce(array_to_string(keywords, '|'), '') AS keywords,
       count(*) AS n_chunks, string_agg(chunk, chr(30) ORDER BY chunk_no) AS answer
FROM identified JOIN chunks ON chunks.key.id = identified.id AND chunks.key.pos = identified.pos
GROUP BY id, pos, q, product, source, keywords""",
    "encode_hashed": r"""
WITH tokens AS (
  SELECT doc_id, md5(token) AS h
  FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS token FROM documents) WHERE token <> ''),
cells AS (
  SELECT doc_id, CAST(('0x' || substr(h, 1, 8))::BIGINT % 384 AS INTEGER) AS bucket,
         sum(CASE WHEN ('0x' || substr(h, 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS s
  FROM tokens GROUP BY ALL),
norms AS (SELECT doc_id, sqrt(sum(s * s)) AS norm FROM cells GROUP BY doc_id)
SELECT doc_id, bucket, CAST(CAST(s / norm AS FLOAT) AS DOUBLE) AS value
FROM cells JOIN norms USING (doc_id) WHERE s <> 0""",
    "vector_checks": """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim,
       coalesce(len(embedding) <> 64 OR len(list_filter(embedding, lambda x: x IS NULL)) > 0, TRUE) AS fault,
       round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 3) AS square_norm
FROM embeddings""",
    "export_totals": f"WITH {_ITEMS} SELECT count(*) AS succeeded, CAST(0 AS BIGINT) AS failed FROM items",
    "export_arrived": f"""WITH {_ITEMS},
points AS (SELECT DISTINCT {_point_id('q', 'source')} AS id, source FROM items),
laned AS (SELECT *, ('0x' || substr(md5(id), 1, 7))::BIGINT % 16 AS lane FROM points)
SELECT id, source, lane, (row_number() OVER (PARTITION BY lane ORDER BY id) - 1) // 128 + 1 AS batch FROM laned""",
    "sync_report": f"""{_DIGEST_OF_TWO_RUNS},
compared AS (
  SELECT c.copies, c.point_id IS NOT NULL AS cur, p.point_id IS NOT NULL AS prev,
         c.question_hash = p.question_hash AS same
  FROM c FULL OUTER JOIN p ON c.point_id = p.point_id)
SELECT (SELECT count(*) FROM items) AS items_valid, (SELECT count(*) FROM items) AS evaluated,
       CAST(sum(copies) FILTER (WHERE cur AND (NOT prev OR NOT same)) AS BIGINT) AS attempted,
       count(*) FILTER (WHERE cur AND (NOT prev OR NOT same)) AS to_upsert,
       count(*) FILTER (WHERE cur AND NOT prev) AS inserted,
       count(*) FILTER (WHERE cur AND prev AND NOT same) AS updated,
       count(*) FILTER (WHERE cur AND prev AND same) AS unchanged,
       count(*) FILTER (WHERE cur AND (NOT prev OR NOT same)) AS upserted,
       count(*) FILTER (WHERE NOT cur) AS to_delete, count(*) FILTER (WHERE NOT cur) AS deleted,
       count(*) FILTER (WHERE cur) AS points
FROM compared""",
    "sync_state": f"""WITH {_ITEMS}, {_last('c', 'items', _CONTENT_HASH)}
SELECT point_id, source AS source_file, question_hash FROM c""",
    "sync_points": f"""WITH RECURSIVE {_ITEMS}, {_last('c', 'items', _CONTENT_HASH)}, {_recursive_chunks(
        "SELECT point_id AS key, a AS body FROM c", 1000, 150)},
answers AS (SELECT key, string_agg(chunk, chr(30) ORDER BY chunk_no) AS answer FROM chunks GROUP BY key), {_vectors(
        "SELECT point_id AS key, q AS body FROM c", 64)}
SELECT point_id AS id, q AS question, product, source, CAST(64 AS BIGINT) AS dim,
       coalesce(array_to_string(keywords, '|'), '') AS keywords, answer, digest AS vector_digest
FROM c JOIN answers ON answers.key = point_id JOIN vectors ON vectors.key = point_id""",
    "sync_idle": f"""WITH {_ITEMS}, {_last('c', 'items', _CONTENT_HASH)}
SELECT CAST(sum(copies) AS BIGINT) AS evaluated, CAST(0 AS BIGINT) AS to_upsert, count(*) AS unchanged, CAST(0 AS BIGINT) AS to_delete,
       CAST(0 AS BIGINT) AS upserted, CAST(0 AS BIGINT) AS deleted, count(*) AS points, TRUE AS same_version FROM c""",
    "sync_skips": f"""WITH {_ITEMS}, {_last('c', 'items', _CONTENT_HASH)}, {_vectors("SELECT point_id AS key, q AS body FROM c", 64)}
SELECT point_id, source AS source_file, CASE WHEN odd THEN 'insert' ELSE 'unchanged' END AS op,
       CASE WHEN odd THEN 'ValueError: odd length' END AS error, CASE WHEN NOT odd THEN digest END AS stored
FROM (SELECT *, length(q) % 17 = 0 AS odd FROM c) JOIN vectors ON key = point_id""",
    "nearest_exact": """
WITH v AS (SELECT vec_id AS id, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS v FROM embeddings)
SELECT query, id, distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, id) AS rank FROM (
    SELECT q.id AS query, p.id, sqrt(list_sum([(q.v[i] - p.v[i]) * (q.v[i] - p.v[i]) FOR i IN range(1, 65)])) AS distance
    FROM v q JOIN v p ON q.id % 20 = 0 AND p.id <> q.id)) WHERE rank <= 10""",
    "nearest_filtered": """
WITH v AS (SELECT vec_id AS id, label, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS v FROM embeddings)
SELECT query, id, distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, id) AS rank FROM (
    SELECT q.id AS query, p.id, -list_sum([q.v[i] * p.v[i] FOR i IN range(1, 65)]) AS distance
    FROM v q JOIN v p ON q.id % 20 = 0 AND p.label = 1)) WHERE rank <= 10""",
}
