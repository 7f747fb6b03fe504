"""The queries that SQL can express, for DuckDB over the same tables. Constants are spelled out, not imported."""

from __future__ import annotations

# Fixed values, as in the contracts: words are runs of anything but ASCII white space.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIX = rf"""
WITH docs AS (
    SELECT doc_id, source, md5(doc_id::VARCHAR) AS place, len({WORDS})::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
    FROM docs GROUP BY source
), weighted AS (
    SELECT *, (r % 3) AS turn, CASE r % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
        (2 * source_size)::DOUBLE AS bound FROM sources
), ordered AS (
    SELECT *, bound / weight AS full_at,
        coalesce(sum(bound) OVER earlier, 0)::DOUBLE AS full_before, coalesce(sum(weight) OVER earlier, 0)::DOUBLE AS gone,
        (SELECT sum(source_size)::BIGINT * 1.5::DOUBLE FROM weighted) AS budget, (SELECT sum(weight) FROM weighted) AS weights
    FROM weighted WINDOW earlier AS (ORDER BY bound / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), held AS (
    SELECT (budget - full_before) / (weights - gone) AS level FROM ordered
    WHERE (budget - full_before) / (weights - gone) <= full_at ORDER BY full_at, r LIMIT 1
), targets AS (
    SELECT source, source_size, turn, least(bound, weight * (SELECT level FROM held)) AS target FROM ordered
), placed AS (
    SELECT d.*, t.source_size, t.turn, t.target, size / 2.0::DOUBLE + coalesce(sum(size) OVER before, 0)::DOUBLE AS middle
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
    WINDOW before AS (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
    SELECT *, CASE turn WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE * (middle / target) AS area FROM placed
)
SELECT doc_id, size, source_size, target, size * ((middle < target)::INT + (middle + source_size < target)::INT) AS taken,
    CASE WHEN middle < target THEN round(CASE turn
        WHEN 0 THEN 2 * area / (6 + sqrt(36 - 4 * area))
        WHEN 1 THEN 2 * area / (1 + sqrt(1 + 4 * area))
        ELSE CASE WHEN area <= 0 THEN 0 WHEN area <= 0.25 THEN 2 * area / sqrt(4 * area)
             ELSE 0.5 + 2 * (area - 0.25) / (1 + sqrt(1 + 4 * (area - 0.25))) END
    END, 6) END AS position
FROM shares
"""

_STOPS = (
    "a and as at be by for from in is it of on or that the this to was with auf das dem den der des die ein eine im ist mit "
    "nicht sich und von zu au avec dans de du elle en est et la le les par pas pour que qui sur un une con del el es las los "
    "no para por se su una y"
).split()

QUALITY = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 4], chr(0)) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs WHERE len(w) >= 5)
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM
        (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id
), counts AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        len(ls) AS n_lines, len(list_filter(w, lambda x: list_contains({_STOPS!r}, lower(x)))) AS n_stops,
        length(t) - length(regexp_replace(t, '\p{{L}}+', '', 'g')) AS n_letters,
        length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS n_capitals,
        length(t) - length(replace(t, '!', '')) AS n_shouts,
        len(list_filter(ls, lambda x: substr(trim(x), 1, 1) IN ('-', '*', '•'))) AS n_bullets,
        len(list_filter(ls, lambda x: rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%…')) AS n_dotted
    FROM docs d LEFT JOIN covered c USING (doc_id)
), verdicts AS (
    SELECT *, array_to_string(list_filter([
        CASE WHEN n_words < 10 OR 100 * n_repeat_words > 20 * n_words THEN 'base' END,
        CASE WHEN word_chars < 2.0 * n_words OR word_chars > 15.0 * n_words THEN 'word_length' END,
        CASE WHEN n_symbols > 0.1::DOUBLE * n_words THEN 'symbols' END,
        CASE WHEN n_words >= 50 AND n_stops < 0.02::DOUBLE * n_words THEN 'stop_words' END,
        CASE WHEN n_capitals > 0.6::DOUBLE * n_letters THEN 'capitals' END,
        CASE WHEN n_shouts > 0.2::DOUBLE * n_words THEN 'shouting' END,
        CASE WHEN n_bullets > 0.9::DOUBLE * n_lines THEN 'bullets' END,
        CASE WHEN n_words >= 50 AND n_dotted > 0.3::DOUBLE * n_lines THEN 'trailing_dots' END,
        CASE WHEN n_words >= 50 AND n_dup_lines > 0.5 * n_lines THEN 'duplicate_lines' END
    ], lambda x: x IS NOT NULL), ',') AS broken FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, broken = '' AS kept, broken FROM verdicts
"""

LEAKS = r"""
WITH both_tables AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
), words AS (
    SELECT kind, id, list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')),
        '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM both_tables
), lengths AS (
    SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE kind = 'i' AND len(w) > 0
), grams AS (
    SELECT DISTINCT kind, id, array_to_string(w[i : i + k - 1], ' ') AS g
    FROM (SELECT kind, id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words JOIN lengths ON kind = 'd' OR k = least(len(w), 5) WHERE len(w) >= k)
), sizes AS (
    SELECT id, count(*) AS n FROM grams WHERE kind = 'i' GROUP BY id
)
SELECT d.id AS doc_id, i.id AS item_id, any_value(n)::BIGINT AS n_shingles, count(*)::BIGINT AS n_shared
FROM grams d JOIN grams i ON d.g = i.g JOIN sizes s ON s.id = i.id
WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY d.id, i.id HAVING count(*) * 100 >= any_value(n) * 80
"""

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, i - 1 AS line, list_sort(list_distinct(regexp_extract_all(
        translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS w
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM
        (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), sets AS (
    SELECT row_number() OVER (ORDER BY doc_id, line) AS id, w, doc_id, line FROM
        (SELECT w, (min([doc_id, line]))[1] AS doc_id, (min([doc_id, line]))[2] AS line FROM lines WHERE len(w) > 0 GROUP BY w)
), words AS (
    SELECT id, len(w) AS n, unnest(w) AS word FROM sets
), late AS (
    SELECT DISTINCT y.id FROM words x JOIN words y ON x.word = y.word AND x.id < y.id AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 80
    GROUP BY x.id, y.id HAVING count(*) * 100 >= (any_value(x.n) + any_value(y.n) - count(*)) * 80
), gone AS (
    SELECT l.doc_id, l.line FROM lines l JOIN sets s ON l.w = s.w LEFT JOIN late ON late.id = s.id
    WHERE late.id IS NOT NULL OR l.doc_id <> s.doc_id OR l.line <> s.line
)
SELECT doc_id, len(string_split(coalesce(any_value(text), ''), chr(10)))::BIGINT AS n_lines, count(line) AS n_removed,
    coalesce(string_agg(line::VARCHAR, ',' ORDER BY line), '') AS removed_lines
FROM documents LEFT JOIN gone USING (doc_id) GROUP BY doc_id
"""

WARC = r"""
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hexed FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY hexed) AS first_id FROM payloads
)
SELECT page_id, payload_bytes, list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform([32768, 1024, 32, 1],
        lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hexed, 5 * g + 1, 5))::BIGINT // d) % 32 + 1)::BIGINT, 1)),
    'string_agg', '')), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to, TRUE AS intact
FROM firsts
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(s.n) + any_value(t.n) - count(*))
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) LEFT JOIN sizes USING (doc_id)
"""

_MARK = r"(<)(\\*)(s>|/s>|<SYS>>|</SYS>>|\|)|(\[)(\\*)(INST\]|/INST\])"

CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), written AS (
    SELECT *, regexp_replace(text, '{_MARK}', '\1\4\\\2\5\3\6', 'g') AS escaped FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(role) + length(escaped) + 8)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

NEAREST = """
WITH whole AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c::DOUBLE))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, q.x AS qx, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM whole q JOIN whole c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id, qx ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE = {
    "op1_mix": MIX,
    "op2_line_dedup": LINE_DEDUP,
    "op3_warc": WARC,
    "op4_near_duplicates": NEAR_DUPLICATES,
    "op5_quality": QUALITY,
    "op6_chat": CHAT,
    "op7_leaks": LEAKS,
    "op11_nearest": NEAREST,
}
