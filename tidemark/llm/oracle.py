"""SQL that checks queries of this subpackage, for DuckDB."""

from tidemark.llm.risk_rules import ALPHA, DELTA, LADDERS

_RUNGS = ", ".join(
    f"('{rule}', {j}, CAST({cutoff} AS DOUBLE))" for rule, ladder in LADDERS.items() for j, cutoff in enumerate(ladder)
)
_SHARE, _LEVEL = repr(ALPHA / len(LADDERS)), repr(DELTA / len(LADDERS))

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

_RULES = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS body FROM documents),
w AS (
    SELECT r, doc_id, lang, body, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS w,
           [x for x in string_split(body, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM t
),
grams AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS j FROM again) GROUP BY r),
m AS (
    SELECT r, doc_id, lang, body, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(length(body) - length(regexp_replace(body, '[\\p{{Lu}}!]', '', 'g')) AS BIGINT) AS n_loud,
           CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN covered USING (r)
),
f AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           map {{'symbol_share': CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END,
                'loud_share': CASE WHEN word_chars > 0 THEN n_loud / word_chars ELSE 0 END,
                'line_share': CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END,
                'window_share': CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END}} AS shares
    FROM m
),
votes AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
once AS (
    SELECT lang, body, any_value(shares) AS shares FROM f JOIN votes USING (doc_id) WHERE NOT base_failed
    GROUP BY lang, body HAVING min(quality) = 1
),
ladder(rule, j, cutoff) AS (VALUES {_RUNGS}),
tested AS (
    SELECT lang, rule, j, cutoff, count(*) AS n, count(*) FILTER (shares[rule] > cutoff) AS k,
           (SELECT count(DISTINCT coalesce(lang, '')) FROM once) AS strata
    FROM once, ladder GROUP BY lang, rule, j, cutoff
),
tails AS (
    SELECT *, CASE WHEN k >= n * {_SHARE} THEN 1.0 ELSE list_sum([exp(
        lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_SHARE}) + (n - i) * ln(1 - {_SHARE})
    ) for i in range(0, k + 1)]) END AS p FROM tested
),
passed AS (
    SELECT *, coalesce(min(j) FILTER (p > {_LEVEL} / strata) OVER (PARTITION BY lang, rule), 1000) AS first_bad FROM tails
),
cuts AS (SELECT lang, rule, min(cutoff) AS cutoff FROM passed WHERE j < first_bad GROUP BY lang, rule)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (
           SELECT 1 FROM cuts c WHERE c.lang IS NOT DISTINCT FROM f.lang AND f.shares[c.rule] > c.cutoff
       ) AS kept
FROM f
"""


def _clusters(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Every round spelled out."""
    parts = [f"""
        k AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   [CAST(floor(greatest(-134217728.0, least(134217728.0, 256 * CAST(x AS DOUBLE)))) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims}
        ),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
            FROM (SELECT sha256('2:' || vec_id) AS h, v FROM k WHERE vec_id IS NOT NULL) ORDER BY h, v LIMIT {k}
        )"""]
    for i in range(rounds + 1):
        parts.append(f"""
        a{i} AS MATERIALIZED (
            SELECT r, vec_id, v, c, d FROM (
                SELECT k.r, k.vec_id, k.v, c.c,
                       CAST(list_sum([(k.v[i] - c.v[i]) * (k.v[i] - c.v[i]) FOR i IN range(1, {dims} + 1)]) AS BIGINT) AS d
                FROM k, c{i} c
            ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
        )""")
        if i < rounds:
            parts.append(f"""
        c{i + 1} AS MATERIALIZED (
            SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
                SELECT c, list(f ORDER BY i) AS v FROM (
                    SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS f
                    FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, range(1, {dims} + 1) t(i) GROUP BY c, i)
                ) GROUP BY c
            ) m USING (c)
        )""")
    return "WITH" + ",".join(parts) + f"""
        SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c USING (c)
    """


_RESAMPLED = f"""
WITH RECURSIVE crc(b, x) AS (
    SELECT range, list_reduce([range] || [0 FOR i IN range(8)], lambda s, z: CASE WHEN s % 2 = 1 THEN xor(3988292384, s >> 1) ELSE s >> 1 END)
    FROM range(256)
),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
dw AS MATERIALIZED (
    SELECT r, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, range(1, 4) t(n))
),
bw AS MATERIALIZED (
    SELECT array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT {_WORDS} AS w FROM benchmark), range(1, 4) t(n))
),
own AS (SELECT g, count(*) AS n FROM dw GROUP BY g),
wanted AS (SELECT g, count(*) AS n FROM bw GROUP BY g),
steps(g, h, i, s) AS (
    SELECT g, hex(g), 1, 4294967295 FROM (SELECT g FROM own UNION SELECT g FROM wanted)
    UNION ALL
    SELECT g, h, i + 2, xor(x, s >> 8) FROM steps JOIN crc ON b = xor(s, CAST('0x' || h[i:i + 1] AS BIGINT)) & 255 WHERE i < length(h)
),
bucket AS MATERIALIZED (SELECT g, xor(s, 4294967295) % 10000 AS b FROM steps WHERE i > length(h)),
s AS (SELECT b, sum(n) AS s FROM own JOIN bucket USING (g) GROUP BY b),
t AS (SELECT b, sum(n) AS t FROM wanted JOIN bucket USING (g) GROUP BY b),
gain AS MATERIALIZED (
    SELECT b, CAST(floor(1000 * ln(
        CAST(coalesce(t, 0) + 1 AS DOUBLE) * (CAST((SELECT count(*) FROM dw) AS DOUBLE) + 10000)
        / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (CAST((SELECT count(*) FROM bw) AS DOUBLE) + 10000))
    )) AS BIGINT) AS gain FROM s FULL JOIN t USING (b)
),
weights AS (SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN bucket USING (g) JOIN gain USING (b) GROUP BY r),
scores AS (
    SELECT r, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM d LEFT JOIN weights USING (r)
),
placed AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, r) AS place, 5 * count(*) OVER () // 100 AS drawn FROM scores WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM scores LEFT JOIN placed USING (r)
"""

_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)(?:\\?([^#]*))?"
_URLS = f"""
WITH u AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path, coalesce(regexp_extract(url, '{_PARTS}', 3), '') AS query
    FROM pages
),
n AS (
    SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '(?s)^.*@', ''), '(?::(?:80|443)?)?$', ''), '[.]$', ''), '^www[.]', '') AS name,
           regexp_replace(regexp_replace(path, '/+', '/', 'g'), '/$', '') AS place,
           list_sort([p FOR p IN string_split(query, '&') IF p <> '' AND NOT regexp_matches(p, '^(?:utm_[^=]*|gclid|fbclid|ref)(?:=|$)')]) AS own
    FROM u
),
c AS (SELECT *, CASE WHEN name <> '' THEN name || place || CASE WHEN len(own) > 0 THEN '?' || array_to_string(own, '&') ELSE '' END END AS canonical FROM n),
listed AS (
    SELECT DISTINCT canonical FROM c
    WHERE canonical IS NOT NULL AND regexp_matches(host, '(?:^|[.])(?:ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)[.]')
),
rules(h, p, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
fits AS (
    SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
    FROM c JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT page_id, host, path, rule, canonical, listed.canonical IS NOT NULL AS listed,
       coalesce(verdict, CASE WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN fits USING (page_id) LEFT JOIN listed USING (canonical)
"""

ORACLE: dict[str, str] = {
    "op11_centroid_tables": _clusters(),
    "op12_resampling": _RESAMPLED,
    "op13_url_bloom": _URLS,
    "op8_risk_rules": _RULES,
    "op10_decontaminate": f"""
        WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark),
        sized AS (SELECT item, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
        windows AS (
            SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS g
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)
        ),
        d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        places AS (
            SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
            FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
                  FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
        ),
        found AS (SELECT r, i, size, item FROM places JOIN windows USING (size, g)),
        hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS j FROM found) GROUP BY r),
        named AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
    """,
    "op1_warc_members": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        q AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
                     max(page_id) OVER (PARTITION BY body) AS keeper FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
        FROM q
    """,
}
