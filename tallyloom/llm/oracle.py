"""The same results as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

QUALITY_RULES = r"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           row_number() OVER () AS r
    FROM documents
), eights AS (
    SELECT r, list(i) AS places FROM words, unnest(range(1, len(w) - 6)) AS t(i)
    GROUP BY r, array_to_string(list_slice(w, i, i + 7), ' ') HAVING count(*) > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n
    FROM (SELECT r, unnest(places) AS i FROM eights), unnest(range(0, 8)) AS t(k) GROUP BY r
), lines AS (
    SELECT r, count(*) - count(DISTINCT line) AS n, count(*) AS n_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), counts AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
           coalesce(l.n_lines, 0) AS n_lines
    FROM words LEFT JOIN covered c USING (r) LEFT JOIN lines l USING (r)
), failures AS (
    SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats,
           100 * n_symbols > 50 * word_chars AS symbols, 100 * n_dup_lines > 50 * n_lines AS lines
    FROM counts
), by_rule AS (
    SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS f
    FROM (SELECT source, unnest(['short', 'repeats', 'symbols', 'lines']) AS rule,
                 unnest([short, repeats, symbols, lines]) AS failed FROM failures)
    GROUP BY source, rule
), prior AS (
    SELECT rule, avg(f / n) AS m, var_pop(f / n) AS v, avg(1 / n) AS inverse, sum(n) AS documents
    FROM by_rule GROUP BY rule
), weighed AS (
    SELECT rule, m, CASE WHEN v > m * (1 - m) * inverse
                    THEN greatest(m * (1 - m) / (v - m * (1 - m) * inverse) - 1, 0)
                    ELSE documents END AS weight
    FROM prior
), rejected AS (
    SELECT DISTINCT source, true AS hit FROM by_rule JOIN weighed USING (rule)
    WHERE (f + weight * m) / (n + weight) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       short OR repeats AS base_failed, NOT (short OR repeats) AND hit IS NULL AS kept
FROM failures LEFT JOIN rejected ON failures.source IS NOT DISTINCT FROM rejected.source
"""



def crc32_table() -> list[int]:
    """CRC-32 of each half byte: four steps of the reversed polynomial."""
    out = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ 0xEDB88320 * (value & 1)
        out.append(value)
    return out


def _winner(nodes: str, name: str, weight: str) -> str:
    """The number of the child with the smallest draw, by row."""
    draw = f"-ln((('0x' || md5(key || '/' || {name})[1:13])::BIGINT + 0.5) / 4503599627370496.0) / {weight}"
    return f"(SELECT arg_min(c, {draw}) FROM (SELECT unnest({nodes}) AS c))"


def _place(regions: int, into: str) -> str:
    """40 shards of weight 1 in racks of 4 and regions of 2 racks; a sixth region is one shard."""
    return f"""
    {into}_region AS (
        SELECT *, {_winner(f"range({regions})", "c", "CASE WHEN c < 5 THEN 8 ELSE 1 END")} AS g FROM {into}_input
    ), {into}_rack AS (
        SELECT *, {_winner("range(CASE WHEN g < 5 THEN 2 ELSE 1 END)", "g || '.' || c", "CASE WHEN g < 5 THEN 4 ELSE 1 END")} AS k
        FROM {into}_region
    ), {into}_placed AS (
        SELECT * EXCLUDE (g, k),
               {_winner("range(8 * g + 4 * k, 8 * g + 4 * k + CASE WHEN g < 5 THEN 4 ELSE 1 END)", "g || '.' || k || '.' || c", "1")}::INTEGER AS {into}
        FROM {into}_rack
    )"""


SHARDING = f"""
WITH documents_bytes AS (
    SELECT doc_id, string_split(hex(encode(coalesce(text, ''))), '') AS digits, coalesce(text, '') = '' AS none
    FROM documents
), steps AS (
    SELECT doc_id, CASE WHEN none THEN []::BIGINT[] ELSE
           list_transform(range(len(digits)),  -- the lower half of each byte comes first
                          lambda i: (instr('0123456789ABCDEF', digits[xor(i, 1) + 1]) - 1)::BIGINT) END AS halves
    FROM documents_bytes
), sums AS (
    SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, len(halves) // 2 + 16 AS size,
           xor(list_reduce(list_concat([4294967295], halves),
               lambda crc, h: xor(crc >> 4, ({crc32_table()})[(xor(crc, h) & 15) + 1])), 4294967295) AS text_crc32
    FROM steps
), shard_input AS (SELECT * FROM sums), {_place(5, "shard")},
grown_shard_input AS (SELECT * FROM shard_placed), {_place(6, "grown_shard")}
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
       row_number() OVER (
           PARTITION BY shard ORDER BY md5(key || '/' || size || '/' || text_crc32)[1:2], doc_id, size, text_crc32
       ) - 1 AS slot, grown_shard
FROM grown_shard_placed
"""

URL_FILTERS = r"""
WITH rules(action, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), parts AS (
    SELECT page_id, row_number() OVER () AS r,
           CASE WHEN position('://' IN url) > 0 THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest
    FROM pages
), urls AS (
    SELECT page_id, r,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), best AS (
    SELECT r, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
           arg_max(action, length(rules.host || rules.path)) AS action
    FROM urls JOIN rules
      ON (urls.host = rules.host OR ends_with(urls.host, '.' || rules.host)) AND starts_with(urls.path, rules.path)
    GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM urls LEFT JOIN best USING (r)
"""

SOURCE_MIXING = r"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           row_number() OVER () AS r
    FROM documents
), placed AS (
    SELECT *, sum(size) OVER (
               PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, 'null') || '/' || size), size, r
               ROWS UNBOUNDED PRECEDING
           ) AS until
    FROM sizes
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS turn
    FROM sizes GROUP BY source
), weighed AS (
    SELECT *, ([5, 2, 1])[(turn - 1) % 3 + 1] AS weight, 3 * source_size AS most FROM sources
), rising AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER earlier, 0) AS rest,
           sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS rest_weight
    FROM weighed
    WINDOW earlier AS (ORDER BY most / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), held AS (
    SELECT *, most::HUGEINT * rest_weight < rest::HUGEINT * weight AS held FROM rising
), targets AS (
    SELECT source, source_size, turn,
           CASE WHEN held THEN most::DOUBLE
                ELSE weight::DOUBLE * (first(rest) OVER w)::DOUBLE / (first(rest_weight) OVER w)::DOUBLE END AS target
    FROM held WINDOW w AS (PARTITION BY held ORDER BY most / weight, turn)
), copies AS (
    SELECT r, size, turn, until + e * source_size AS until, (until + e * source_size)::DOUBLE / target AS finish
    FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source, range(3) AS t(e)
    WHERE size > 0 AND target > 0
), taken AS (
    SELECT r, greatest(0, least(size, (SELECT sum(size) FROM sizes)
               - (sum(size) OVER (ORDER BY finish, turn, until ROWS UNBOUNDED PRECEDING) - size))) AS taken
    FROM copies
)
SELECT doc_id, size, source_size, target, coalesce(sum(taken), 0)::BIGINT AS taken
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source LEFT JOIN taken USING (r)
GROUP BY r, doc_id, size, source_size, target
"""

LINE_DEDUP = r"""
WITH rows AS (
    SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), keyed AS (
    SELECT doc_id, r, i, lines[i] AS line,
           translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM rows, unnest(range(1, len(lines) + 1)) AS t(i)
), common AS (
    SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT r) >= 5
), marked AS (
    SELECT keyed.*, common.key IS NOT NULL AND doc_id IS DISTINCT FROM largest AS lost
    FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

RANKED_SEARCH = r"""
WITH texts AS (
    SELECT 'd' AS side, doc_id, NULL AS item_id, row_number() OVER () AS r, text FROM documents
    UNION ALL SELECT 't', NULL, item_id, row_number() OVER (), text FROM benchmark
), words AS (
    SELECT side, doc_id, item_id, r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM texts
), asked AS (
    SELECT DISTINCT r AS q, item_id, unnest(w) AS term FROM words WHERE side = 't'
), sizes AS (
    SELECT r, doc_id, len(w)::BIGINT AS n FROM words WHERE side = 'd' AND len(w) > 0
), totals AS (
    SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS terms FROM sizes
), held AS (
    SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM words WHERE side = 'd')
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * df + 1)))::BIGINT AS weight
    FROM (SELECT term, count(*)::BIGINT AS df FROM held GROUP BY term), totals
), scores AS (
    SELECT q, item_id, r, doc_id,
           sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // terms))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (r), totals
    GROUP BY q, item_id, r, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

IMPORTANCE_RESAMPLING = f"""
WITH texts AS (
    SELECT 'd' AS side, doc_id, row_number() OVER () AS r, text FROM documents
    UNION ALL SELECT 't', NULL, row_number() OVER (), text FROM benchmark
), words AS (
    SELECT side, doc_id, r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM texts
), features AS (
    SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature
    FROM words
), digits AS (
    SELECT feature, string_split(hex(encode(feature)), '') AS d FROM (SELECT DISTINCT feature FROM features)
), buckets AS (
    SELECT feature,
           xor(list_reduce(list_concat([4294967295], list_transform(range(len(d)),  -- the lower half of each byte comes first
                   lambda i: (instr('0123456789ABCDEF', d[xor(i, 1) + 1]) - 1)::BIGINT)),
               lambda crc, h: xor(crc >> 4, ({crc32_table()})[(xor(crc, h) & 15) + 1])), 4294967295) % 10000 AS bucket
    FROM digits
), counts AS (
    SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t
    FROM features JOIN buckets USING (feature) GROUP BY bucket
), totals AS (
    SELECT coalesce(sum(s), 0)::BIGINT AS all_s, coalesce(sum(t), 0)::BIGINT AS all_t FROM counts
), gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
    FROM counts, totals
), weights AS (
    SELECT r, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
    FROM features JOIN buckets USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
    SELECT doc_id, len(w) >= 20 AS may, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, 'null'))[1:8])::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (r) WHERE side = 'd'
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
           count(*) OVER (PARTITION BY may) AS n
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {
    "op2_quality_rules": QUALITY_RULES,
    "op4_sharding": SHARDING,
    "op5_url_filters": URL_FILTERS,
    "op6_source_mixing": SOURCE_MIXING,
    "op11_line_dedup": LINE_DEDUP,
    "op12_ranked_search": RANKED_SEARCH,
    "op13_importance_resampling": IMPORTANCE_RESAMPLING,
}
