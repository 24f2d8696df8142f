"""SQL for the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

_LINE_FREQUENCY = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT row, unnest(regexp_extract_all(text, '{WORD}')) AS word,
        generate_subscripts(regexp_extract_all(text, '{WORD}'), 1) AS pos
    FROM texts
), counted AS (
    SELECT row, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY row
), windows AS (
    SELECT row, pos, word AS a, lead(word, 1) OVER w AS b, lead(word, 2) OVER w AS c
    FROM words WINDOW w AS (PARTITION BY row ORDER BY pos)
), found AS (
    SELECT row, pos FROM windows WHERE c IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY row, a, b, c) > 1
), covered AS (
    SELECT row, count(DISTINCT pos + k) AS n_repeat_words FROM found, (VALUES (0), (1), (2)) AS t(k) GROUP BY row
), lines AS (
    SELECT row, source, text, line, pos, len(regexp_extract_all(line, '{WORD}')) AS n_words,
        trim(regexp_replace(regexp_replace(lower(line), '\p{{Nd}}', '0', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS plain
    FROM (
        SELECT row, source, text, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM texts
    )
), repeated AS (
    SELECT row, count(*) AS n_dup_lines FROM (
        SELECT row FROM lines WHERE n_words > 0 QUALIFY row_number() OVER (PARTITION BY row, line ORDER BY pos) > 1
    ) GROUP BY row
), boilerplate AS (
    SELECT source, plain FROM lines WHERE plain <> '' GROUP BY source, plain HAVING count(DISTINCT row) > 20
), lost AS (
    SELECT row, sum(n_words) AS n FROM lines l JOIN boilerplate b
        ON l.source IS NOT DISTINCT FROM b.source AND l.plain = b.plain GROUP BY row
), measured AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(lost.n, 0) AS boilerplate_words
    FROM texts LEFT JOIN counted USING (row) LEFT JOIN covered USING (row)
        LEFT JOIN repeated USING (row) LEFT JOIN lost USING (row)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * boilerplate_words <= n_words AS kept,
    boilerplate_words::BIGINT AS boilerplate_words
FROM measured
"""

_BLOOM_CASCADE = r"""
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), rules(host, path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), spam(host) AS (
    SELECT a || '.example.' || b
    FROM (VALUES ('ads-track'), ('adult-x'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) AS n(a),
        (VALUES ('com'), ('net'), ('org')) AS t(b)
), ruled AS (
    SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
        arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, r.rule,
    coalesce(r.verdict, CASE WHEN EXISTS (
        SELECT 1 FROM spam s WHERE p.host = s.host OR ends_with(p.host, '.' || s.host)
    ) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN ruled r USING (page_id)
"""

_WATER_FILLING = rf"""
WITH sizes AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
        ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 3))::INTEGER AS bucket
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM sizes GROUP BY source
), caps AS (
    SELECT *, source_size * 2.0::DOUBLE AS cap FROM sources
), levels AS (
    SELECT max((1.5 * (SELECT sum(source_size) FROM caps)
        - coalesce((SELECT sum(b.cap) FROM caps b WHERE b.cap / b.weight < a.cap / a.weight), 0))
        / (SELECT sum(b.weight) FROM caps b WHERE b.cap / b.weight >= a.cap / a.weight)) AS level
    FROM caps a
), targets AS (
    SELECT source, source_size, least(cap, level * weight)::DOUBLE AS target,
        floor(CASE WHEN source_size = 0 THEN 0 ELSE least(cap, level * weight) / source_size END)::BIGINT AS whole
    FROM caps, levels
), ends AS (
    SELECT source, bucket, sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket) - sum(size) / 2 AS middle
    FROM sizes GROUP BY source, bucket
), extra AS (
    SELECT e.source, max(e.bucket) + 1 AS extra FROM ends e JOIN targets t ON e.source IS NOT DISTINCT FROM t.source
    WHERE e.middle < t.target - t.whole * t.source_size GROUP BY e.source
)
SELECT s.doc_id, s.size, t.source_size, t.target,
    (s.size * (t.whole + CASE WHEN s.bucket < coalesce(x.extra, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    LEFT JOIN extra x ON s.source IS NOT DISTINCT FROM x.source
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SIGNATURE_SEARCH = rf"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{TERM}')) AS term FROM documents
), sizes AS (
    SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes
), counts AS (
    SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{TERM}')) AS term FROM benchmark
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, corpus GROUP BY term, documents
), scores AS (
    SELECT item_id, doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // length)))) AS BIGINT) AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""

_EXACT_STREAM = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_frequency": _LINE_FREQUENCY,
    "op6_bloom_cascade": _BLOOM_CASCADE,
    "op10_water_filling": _WATER_FILLING,
    "op12_signature_search": _SIGNATURE_SEARCH,
    "op13_exact_stream": _EXACT_STREAM,
}
