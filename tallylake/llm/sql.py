"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

from tallylake.llm import hard_negatives, licenses, quality, url_rules, winnow

_LOW = f"translate(coalesce(text, ''), '{url_rules.UPPER}', '{url_rules.LOWER}')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOW}, '{_WORD}') AS w
    FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOW}, '{_WORD}') AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, least({winnow.SPAN_WORDS}, len(w)) AS n,
        array_to_string(w[p:p + least({winnow.SPAN_WORDS}, len(w)) - 1], ' ') AS g
    FROM i, unnest(range(1, greatest(len(w) - {winnow.SPAN_WORDS} + 1, 1) + 1)) AS t(p)
    WHERE len(w) > 0),
occ AS (
    SELECT rid, p, s.n, array_to_string(w[p:p + s.n - 1], ' ') AS g
    FROM d, (SELECT DISTINCT n FROM win) s, unnest(range(1, len(w) - s.n + 2)) AS t(p)),
hit AS (SELECT rid, p, occ.n, item_id FROM occ JOIN win ON occ.n = win.n AND occ.g = win.g),
marked AS (
    SELECT rid, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + n)) AS t(q) GROUP BY rid),
listed AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL)
    GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (rid) LEFT JOIN listed USING (rid)
"""


def _rules() -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_rules.RULES)


OP3 = rf"""
WITH parts AS (
    SELECT row_number() OVER () AS rid, page_id,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
            '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
rules(r_host, r_path, r_verdict) AS (VALUES {_rules()}),
best AS (
    SELECT rid, r_host || r_path AS rule, r_verdict FROM parts, rules
    WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    QUALIFY row_number() OVER (
        PARTITION BY rid
        ORDER BY length(r_host) DESC, length(r_path) DESC, r_verdict = 'block' DESC) = 1)
SELECT page_id, host, path, rule, coalesce(r_verdict, '{url_rules.DEFAULT_VERDICT}') AS verdict
FROM parts LEFT JOIN best USING (rid)
"""

OP4 = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes
    FROM pages),
h AS (SELECT page_id, payload_bytes, sha1(html) AS hex FROM p),
b AS (
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(hex, (i // 4)::INT * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)
            + 1, 1)), '') AS payload_digest
    FROM h),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM b)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM r
"""

_BLANKS = r"[\x20\x09-\x0D]+"
_NORM = (
    rf"regexp_replace(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'),"
    rf" '{_BLANKS}', ' ', 'g'), '^ | $', '', 'g')"
)

OP8 = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
l AS (
    SELECT rid, source, t, line, {_NORM} AS norm,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS size
    FROM d, unnest(string_split(t, chr(10))) AS x(line)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT t) AS n_texts FROM d GROUP BY source),
common AS (
    SELECT l.source, norm
    FROM l JOIN hosts ON l.source IS NOT DISTINCT FROM hosts.source
    GROUP BY l.source, norm, n_texts
    HAVING count(DISTINCT t) > {quality.MAX_TEXTS}
        AND count(DISTINCT t) > n_texts * {quality.MAX_SHARE}::DOUBLE),
boiler AS (
    SELECT rid, sum(size)::BIGINT AS n_boilerplate_words
    FROM l JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.norm = c.norm
    GROUP BY rid),
win AS (
    SELECT rid, p, array_to_string(w[p:p + 7], ' ') AS g
    FROM d, unnest(range(1, len(w) - 6)) AS x(p) WHERE len(w) >= 8),
again AS (SELECT rid, p FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rep AS (
    SELECT rid, count(DISTINCT q) AS n_repeat_words
    FROM again, unnest(range(p, p + 8)) AS x(q) GROUP BY rid),
m AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(t, '{quality.SYMBOLS}')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_boilerplate_words, 0) AS n_boilerplate_words
    FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN boiler USING (rid))
SELECT *, n_words < {quality.MIN_WORDS}
        OR 100 * n_repeat_words > {round(100 * quality.MAX_REPEATED)} * n_words AS base_failed,
    NOT (n_words < {quality.MIN_WORDS}
        OR 100 * n_repeat_words > {round(100 * quality.MAX_REPEATED)} * n_words)
        AND 100 * (n_words - n_boilerplate_words) >= {round(100 * quality.MIN_LEFT)} * n_words AS kept
FROM m
"""


def _templates() -> str:
    rows = []
    for number, (name, text) in enumerate(licenses.TEMPLATES):
        own = licenses.bigrams(licenses.template_words(text))
        rows += [f"({number}, '{name}', {len(own)}, '{b}')" for b in sorted(own)]
    return ", ".join(rows)


OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
k AS (
    SELECT rid, unnest(string_split_regex(t, '\n[\x20\x09\x0B-\x0D]*\n')) AS part,
        generate_subscripts(string_split_regex(t, '\n[\x20\x09\x0B-\x0D]*\n'), 1) AS n FROM d),
c AS (
    SELECT rid, n, string_split(
        regexp_replace(part, '([.!?])\s+([\p{{Lu}}"''(#*/])', '\1' || chr(30) || '\2', 'g'),
        chr(30)) AS c
    FROM k),
u AS (
    SELECT rid, 's' || n || '.' || w || '.' || p AS unit, array_to_string(c[p:p + w - 1], ' ') AS part
    FROM c, unnest(range(1, {licenses.MOST_SENTENCES} + 1)) AS x(w),
        unnest(CASE WHEN len(c) > w THEN range(1, len(c) - w + 2) ELSE [] END) AS y(p)
    UNION ALL
    SELECT rid, 'w', t FROM d WHERE rid IN (SELECT rid FROM k WHERE n = 2)
    UNION ALL
    SELECT rid, 'l' || n AS unit, part FROM (
        SELECT rid, unnest(string_split(t, chr(10))) AS part,
            generate_subscripts(string_split(t, chr(10)), 1) AS n FROM d)
    UNION ALL
    SELECT rid, 'b' || n AS unit, part FROM k WHERE contains(part, chr(10))),
w AS (SELECT rid, unit, regexp_extract_all(lower(part), '[\p{{L}}\p{{N}}]+') AS w FROM u),
b AS (SELECT DISTINCT rid, unit, w[p] || ' ' || w[p + 1] AS g
    FROM w, unnest(range(1, len(w))) AS x(p)),
sizes AS (SELECT rid, unit, count(*) AS size FROM b GROUP BY rid, unit),
t(template, license, t_size, g) AS (VALUES {_templates()}),
m AS (
    SELECT b.rid, b.unit, template, license,
        2 * count(*)::DOUBLE / (any_value(size) + any_value(t_size)) AS dice,
        {licenses.THRESHOLD.denominator} * 2 * count(*)
            >= {licenses.THRESHOLD.numerator} * (any_value(size) + any_value(t_size)) AS reached
    FROM b JOIN t ON b.g = t.g JOIN sizes ON sizes.rid = b.rid AND sizes.unit = b.unit
    GROUP BY b.rid, b.unit, template, license),
best AS (
    SELECT *, max(dice) OVER (PARTITION BY rid, unit) AS most FROM m WHERE reached),
f AS (
    SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
        count(*) AS n_matches, max(dice) AS best_dice
    FROM best WHERE dice = most GROUP BY rid)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_matches, 0) AS n_matches, best_dice
FROM d LEFT JOIN f USING (rid)
"""


OP12 = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor({hard_negatives.SCALE} * c::DOUBLE) for c in embedding] AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_inner_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place
        FROM s WHERE same) WHERE place <= {hard_negatives.POSITIVES}),
n AS (
    SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score,
        score AS negative_score, row_number() OVER (
            PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
        AND {hard_negatives.LOWEST} * positive_score <= 100 * score
        AND 100 * score <= {hard_negatives.HIGHEST} * positive_score)
SELECT * FROM n WHERE rank <= {hard_negatives.NEGATIVES}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_winnowing": OP2,
        "op3_url_filter": OP3,
        "op4_warc_transactions": OP4,
        "op8_line_quality": OP8,
        "op10_license_scan": OP10,
        "op12_hard_negatives": OP12,
    }
