"""DuckDB SQL for the registered queries of this subpackage that SQL can express."""

from __future__ import annotations

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

# Limits by metric from the quartiles: name, value, both sides, slack.
_METRICS = (
    ("word_length", "100 * word_chars // greatest(n_words, 1)", True, 100),
    ("symbols", "1000 * n_symbols // greatest(n_words, 1)", False, 100),
    ("dup_lines", "1000 * n_dup_lines // greatest(n_lines, 1)", False, 400),
    ("repeat_words", "1000 * n_repeat_words // greatest(n_words, 1)", False, 300),
)
_BUCKET = "(v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0)"
_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, base_failed, '{name}' AS metric, {value} AS v,"
    f" {slack} AS slack, {both} AS both_sides FROM c"
    for name, value, both, slack in _METRICS
)


def _quartiles(group: str) -> str:
    by = f"{group}, metric" if group else "metric"
    return f"""
        SELECT {by}, max(size) AS size, min(CASE WHEN 4 * r >= size THEN b END) AS q25,
               min(CASE WHEN 4 * r >= 2 * size THEN b END) AS q50,
               min(CASE WHEN 4 * r >= 3 * size THEN b END) AS q75
        FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY b) AS r,
                     count(*) OVER (PARTITION BY {by}) AS size FROM s)
        GROUP BY {by}"""


_QUALITY = rf"""
    WITH w AS (
        SELECT doc_id, lang, source, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
        FROM documents),
    p AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
    g AS (SELECT doc_id, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c
          FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
          FROM g WHERE c IS NOT NULL),
    r AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
          FROM k, range(3) AS x(o) WHERE n > 1 GROUP BY doc_id),
    f AS (SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
                 CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                 CAST(len(ls) AS BIGINT) AS n_lines,
                 CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
          FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
    c AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
    v AS ({_VALUES}),
    s AS (SELECT *, {_BUCKET} AS b FROM v WHERE NOT base_failed),
    q1 AS ({_quartiles("lang, source")}), q2 AS ({_quartiles("lang")}), q3 AS ({_quartiles("")}),
    u AS (SELECT q1.lang, q1.source, q1.metric,
                 CASE WHEN q1.size >= 100 THEN [q1.q25, q1.q50, q1.q75]
                      WHEN q2.size >= 100 THEN [q2.q25, q2.q50, q2.q75]
                      ELSE [q3.q25, q3.q50, q3.q75] END AS q
          FROM q1 LEFT JOIN q2 ON q1.metric = q2.metric AND q1.lang IS NOT DISTINCT FROM q2.lang
          JOIN q3 ON q1.metric = q3.metric),
    d AS (SELECT v.doc_id, bool_and(v.v <= q[2] + 6 * (q[2] - q[1]) + slack
                 AND (NOT both_sides OR v.v >= q[2] - 6 * (q[3] - q[2]) - slack)) AS inside
          FROM v JOIN u ON v.metric = u.metric AND v.lang IS NOT DISTINCT FROM u.lang
               AND v.source IS NOT DISTINCT FROM u.source
          GROUP BY v.doc_id)
    SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(inside, false) AS kept
    FROM c LEFT JOIN d ON c.doc_id = d.doc_id
"""

_NEGATIVES = """
    WITH given AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS BIGINT) AS y
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
    e AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (y + 1) % 10 ELSE y END AS label,
               list_transform(x, lambda v: floor(256 * v)) AS q
        FROM given
        WHERE len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
    s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
               CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                                   ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
"""

_TERMS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_SEARCH = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
    c AS (SELECT count(*) FILTER (len(ts) > 0) AS docs, sum(len(ts)) AS terms FROM d),
    i AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS ts FROM benchmark),
    q AS (SELECT item, term, count(*) AS repeats
          FROM (SELECT item, unnest(ts) AS term FROM i) GROUP BY item, term),
    t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d)
          WHERE term IN (SELECT term FROM q) GROUP BY r, term),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM t, c GROUP BY term, docs),
    m AS (SELECT r, doc_id, 75 + CAST((25 * len(ts) * docs) // terms AS BIGINT) AS m FROM d, c),
    s AS (SELECT item, r, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS score
          FROM t JOIN m USING (r) JOIN w USING (term) JOIN q USING (term) GROUP BY item, r)
    SELECT item_id,
           CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
           doc_id, CAST(score AS BIGINT) AS score
    FROM s JOIN m USING (r) JOIN i USING (item) WHERE score > 0
    QUALIFY rank <= 20
"""

# Base 32 of the 160 bits of a SHA-1, from its 40 hex digits.
_WARC = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    h AS (SELECT *, sha1(html) AS hex FROM p),
    b AS (SELECT *, array_to_string(list_transform(range(1, 41),
                 lambda i: right('000' || bin(strpos('0123456789abcdef', hex[i]) - 1), 4)), '') AS bits
          FROM h),
    d AS (SELECT *, array_to_string(list_transform(range(0, 32),
                 lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(
                     range(1, 6), lambda j: CAST(bits[5 * i + j] AS BIGINT) << (5 - j)))::INTEGER]), '') AS digest
          FROM b)
    SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest,
           CASE WHEN row_number() OVER latest = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN row_number() OVER latest > 1 THEN first_value(page_id) OVER latest END AS refers_to
    FROM d WINDOW latest AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST)
"""

ORACLE: dict[str, str] = {
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_NORM}) AS text_sha256, {_NORM} AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, text_sha256
        FROM d WINDOW same AS (PARTITION BY norm)
    """,
    "op4_quality_rules": _QUALITY,
    "op11_hard_negative_mining": _NEGATIVES,
    "op12_ranked_search": _SEARCH,
    "op13_warc": _WARC,
}
