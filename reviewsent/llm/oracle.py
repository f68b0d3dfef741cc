"""The operators that SQL can express, written apart from them.

Quality rules: windows as rows, not hashes in arrays. Divergence: every kept term of every group as a row.
"""

from reviewsent.llm.divergence import MIN_DOCS, SCALE, SMOOTHING, TOP
from reviewsent.llm.fill_middle import MARKS, RATE, SEED, SPM
from reviewsent.llm.quality import (CLASSES, COMMON_WORDS, GUARD_CHARS, GUARD_WORDS, MAX_CLASS_DISTANCE,
                                    MAX_LANGUAGES, MAX_REPEAT_PERCENT, MAX_WORD_DISTANCE, MIN_REFERENCE, MIN_WORDS, SPACE, WORDS)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def quality_sql() -> str:
    classes = ", ".join(f"length(regexp_replace(t, {_text(p)}, '', 'g'))" for p in CLASSES.values())
    words = ", ".join(map(_text, WORDS))
    listed = f"({', '.join(map(_text, COMMON_WORDS))})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, {_text(SPACE)}), lambda x: x <> '') AS words FROM d),
places AS (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w),
grams AS (SELECT rid, i, list_slice(words, i, i + 4) AS g FROM places),
repeated AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest(range(5)) AS k) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n
    FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
base AS (SELECT w.rid, doc_id, lang, length(t) AS n_chars, len(words) AS n_words,
    length(regexp_replace(t, {_text(SPACE)}, '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, [{classes}] AS classes,
    list_transform([{words}], lambda x: len(list_filter(words, lambda y: lower(y) = x))) AS common
    FROM w LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)),
kinds AS (SELECT rid, lang, 1 AS kind, n_chars AS n, list_append(classes, n_chars - list_sum(classes)) AS h
    FROM base WHERE n_chars >= {GUARD_CHARS}
    UNION ALL SELECT rid, lang, 2, n_words, list_append(common, n_words - list_sum(common)) FROM base WHERE n_words >= {GUARD_WORDS}),
bins AS (SELECT rid, lang, kind, i, CAST(c AS DOUBLE) / n AS p
    FROM (SELECT rid, lang, kind, n, unnest(range(len(h))) AS i, unnest(h) AS c FROM kinds)),
others AS (SELECT lang FROM kinds WHERE kind = 1 AND lang NOT IN {listed} GROUP BY lang HAVING count(*) >= {MIN_REFERENCE}
    ORDER BY count(*) DESC, lang LIMIT {MAX_LANGUAGES}),
refs AS (SELECT lang AS ref, kind, i, avg(p) AS q FROM bins WHERE lang IN {listed} OR (kind = 1 AND lang IN (FROM others))
    GROUP BY lang, kind, i),
distances AS (SELECT rid, kind, ref, sqrt(greatest(0, sum(
    (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))) AS x
    FROM bins JOIN refs USING (kind, i)
    WHERE (ref IN {listed} OR ref = lang) AND (lang IS NULL OR lang IN {listed} OR (kind = 1 AND lang IN (FROM others)))
    GROUP BY rid, kind, ref),
nearest AS (SELECT rid, min(x) FILTER (kind = 1) AS x1, min(x) FILTER (kind = 2) AS x2 FROM distances GROUP BY rid)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    NOT base_failed AND coalesce(x1, 0) <= {MAX_CLASS_DISTANCE} AND coalesce(x2, 0) <= {MAX_WORD_DISTANCE} AS kept
FROM base LEFT JOIN nearest USING (rid)"""


def divergence_sql() -> str:
    share = f"1 + ({SCALE}::HUGEINT * (n + {SMOOTHING})) // (total + {SMOOTHING} * v)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t
    FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM (SELECT DISTINCT rid, lang, term FROM w) GROUP BY lang, term HAVING count(*) >= {MIN_DOCS}),
found AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
sources AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT s.lang, s.source, k.term, coalesce(f.n, 0) AS n FROM sources s JOIN kept k ON k.lang = s.lang
    LEFT JOIN found f ON f.lang = s.lang AND f.source = s.source AND f.term = k.term),
sums AS (SELECT *, count(*) OVER (PARTITION BY lang, source) AS v, sum(n) OVER (PARTITION BY lang, source) AS total FROM cells),
p AS (SELECT lang, source, term, n, {share} AS p FROM sums),
whole AS (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term),
q AS (SELECT lang, term, {share} AS q FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS v, sum(n) OVER (PARTITION BY lang) AS total
    FROM whole)),
distances AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b
    ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term
    WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= {TOP}"""


def fill_middle_sql() -> str:
    p, s, m = MARKS
    draw = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"
    part = lambda low, high: f"array_to_string(list_slice(units, {low}, {high}), '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units FROM d),
n AS (SELECT *, CAST(len(units) AS BIGINT) AS n, {draw(0)} % (n + 1) AS x, {draw(1)} % (n + 1) AS y,
    CASE WHEN t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}') OR {draw(2)} % 100 >= {RATE} THEN 'plain'
    WHEN {draw(3)} % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM u),
parts AS (SELECT doc_id, n, form, t, {part(1, 'least(x, y)')} AS a, {part('least(x, y) + 1', 'greatest(x, y)')} AS b,
    {part('greatest(x, y) + 1', 'n')} AS c FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{p}' || a || '{s}' || c || '{m}' || b
        ELSE '{s}' || c || '{p}' || a || '{m}' || b END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts"""
