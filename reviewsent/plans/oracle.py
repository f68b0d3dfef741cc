"""DuckDB SQL for the named queries: an independent statement of each result.

The SQL follows the definitions step by step (three separate regular expressions,
joins of counts, plain windows), not the plans Spark runs.
"""

from reviewsent.functions.stopwords import COMPACT140, ENGLISH, ENGLISH_PLUS6


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _norm(text: str, kept: str = "a-z") -> str:
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(lower({text}), '<[^>]*>', ' ', 'g'), "
            f"'[^{kept}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))")


def _raw(label: str = "quality") -> str:
    return f"""raw AS (
  SELECT d.doc_id, CAST(l.{label} + 1 AS INTEGER) AS score, split_part(d.text, chr(10), 1) AS summary, d.text
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _uniq(label: str = "quality") -> str:
    return _raw(label) + """, uniq AS (
  SELECT min(doc_id) AS doc_id, score, summary, text FROM raw
  WHERE score IS NOT NULL AND summary IS NOT NULL AND text IS NOT NULL GROUP BY score, summary, text)"""


def _rev(label: str = "quality") -> str:
    return _uniq(label) + f""", rev AS (
  SELECT doc_id, score - 1 AS label, {_norm('summary')} AS summary, {_norm('text')} AS text
  FROM uniq WHERE score IN (1, 2) AND length({_norm('text')}) >= 3)"""


def _words(stop: tuple[str, ...] = ENGLISH, extra: str = "") -> str:
    return _rev() + f""", words AS (
  SELECT doc_id, label, w AS word FROM (SELECT doc_id, label, unnest(string_split(text, ' ')) AS w FROM rev)
  WHERE NOT list_contains({_list(stop)}, w){extra})"""


def _ratio(source: str = "words", support: int = 50) -> str:
    return f""", pos_counts AS (SELECT word, count(*) AS pos FROM {source} WHERE label = 1 GROUP BY word),
neg_counts AS (SELECT word, count(*) AS neg FROM {source} WHERE label = 0 GROUP BY word),
ratio AS (SELECT word, pos, neg, pos::DOUBLE / (neg + 1) AS ratio
  FROM pos_counts JOIN neg_counts USING (word) WHERE pos + neg > {support})"""


_TOP_RATIO = """
SELECT * FROM (SELECT word, pos, neg, ratio, 'positive' AS direction,
    row_number() OVER (ORDER BY ratio DESC, word)::INTEGER AS position FROM ratio) WHERE position <= 20
UNION ALL
SELECT * FROM (SELECT word, pos, neg, ratio, 'negative' AS direction,
    row_number() OVER (ORDER BY ratio, word)::INTEGER AS position FROM ratio) WHERE position <= 20"""


def _top(by: str, k: int) -> str:
    return f"""
SELECT {by}, word, n, position FROM (
  SELECT {by}, word, count(*) AS n,
         row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, word)::INTEGER AS position
  FROM words GROUP BY {by}, word) WHERE position <= {k}"""


# predictions of the lexicon
_SCORED = _words() + _ratio() + """, ranked AS (
  SELECT word, row_number() OVER (ORDER BY ratio DESC, word) AS rp, row_number() OVER (ORDER BY ratio, word) AS rn,
         least(100, count(*) OVER () // 2) AS keep FROM ratio),
lex AS (SELECT word, CASE WHEN rp <= keep THEN 1 ELSE 0 END AS is_pos FROM ranked WHERE rp <= keep OR rn <= keep),
tok AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM rev),
hits AS (SELECT doc_id, sum(is_pos)::BIGINT AS h, count(*) AS c FROM tok JOIN lex USING (word) GROUP BY doc_id),
scored AS (SELECT r.doc_id, r.label, CASE WHEN coalesce(h::DOUBLE / c, 0.5) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
         AS prediction, coalesce(h::DOUBLE / c, 0.5) AS prob_positive, r.text
  FROM rev r LEFT JOIN hits USING (doc_id))"""

_CLASSES = """, cls AS (
  SELECT c, count(*) FILTER (label = c) AS n, count(*) FILTER (prediction = c) AS pred,
         count(*) FILTER (label = c AND prediction = c) AS tp FROM scored, (VALUES (0), (1)) v(c) GROUP BY c),
pr AS (SELECT c, n, CASE WHEN pred > 0 THEN tp::DOUBLE / pred ELSE 0 END AS p,
         CASE WHEN n > 0 THEN tp::DOUBLE / n ELSE 0 END AS r FROM cls),
prf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pr),
acc AS (SELECT avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy FROM scored)"""

_ROC = """, grp AS (
  SELECT prob_positive AS threshold, count(*) FILTER (label = 1) AS pc, count(*) FILTER (label = 0) AS nc
  FROM scored GROUP BY prob_positive),
roc AS (SELECT threshold, pc, nc, (sum(pc) OVER (ORDER BY threshold DESC))::BIGINT AS tp,
         (sum(nc) OVER (ORDER BY threshold DESC))::BIGINT AS fp,
         row_number() OVER (ORDER BY threshold DESC) AS i,
         lead(pc) OVER (ORDER BY threshold DESC) AS next_pc, lead(nc) OVER (ORDER BY threshold DESC) AS next_nc
  FROM grp),
auc AS (SELECT sum(nc * (tp - pc::DOUBLE / 2)) / (max(tp)::DOUBLE * max(fp)) AS auc FROM roc)"""


def _roc_points(where: str) -> str:
    return f"""
SELECT threshold, tp, fp, tp::DOUBLE / (SELECT max(tp) FROM roc) AS tpr, fp::DOUBLE / (SELECT max(fp) FROM roc) AS fpr
FROM roc {where}
UNION ALL SELECT NULL::DOUBLE, 0::BIGINT, 0::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE"""


def _docs(kept: str = "a-z") -> str:
    return f"""docs AS (SELECT doc_id, {_norm('text', kept)} AS text FROM documents
  WHERE text IS NOT NULL AND length({_norm('text', kept)}) >= 3)"""


_TERMS = _docs() + f""", terms AS (
  SELECT doc_id, w AS word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM docs)
  WHERE NOT list_contains({_list(ENGLISH)}, w))"""

_BUCKET = "(('0x' || substr(md5(word), 1, 8))::BIGINT % 10000)::INTEGER"


def _tfidf(term: str, name: str) -> str:
    return f"""WITH {_TERMS}, tf AS (SELECT doc_id, {term} AS {name}, count(*) AS tf FROM terms GROUP BY ALL),
df AS (SELECT {name}, count(DISTINCT doc_id) AS df FROM tf GROUP BY {name}),
w AS (SELECT *, ln(((SELECT count(*) FROM docs) + 1)::DOUBLE / (df + 1)::DOUBLE) AS idf FROM tf JOIN df USING ({name}))
SELECT doc_id, {name}, tf, df, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf FROM w"""


# all pairs of places at most two apart, by a join of the places with themselves
_PAIRS = _rev() + f""", placed AS (
  SELECT doc_id, w AS word, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place FROM (
    SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM rev)
  WHERE NOT list_contains({_list(ENGLISH)}, w)),
pairs AS (SELECT a.word, b.word AS other, count(*) AS n FROM placed a JOIN (SELECT doc_id, word, place + unnest([-2, -1, 1, 2]) AS place
    FROM placed) b USING (doc_id, place) GROUP BY a.word, b.word),
totals AS (SELECT word, sum(n) AS total FROM pairs GROUP BY word)"""


def _automatic(most: int) -> str:
    """Bins of ``v`` (label, x): edges as products of whole numbers, every step of the ladder tried."""
    return f""", steps AS (SELECT m * pow(10::DOUBLE, greatest(e, 0)) AS f, pow(10::DOUBLE, greatest(-e, 0)) AS d
  FROM (SELECT unnest([1, 2, 5]) AS m), (SELECT unnest(range(-12, 13)) AS e)),
lim AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
edges AS (SELECT f, d, i, i * f / d AS a, (i + 1) * f / d AS b FROM (
  SELECT f, d, unnest(range(floor(lo * d / f)::BIGINT - 1, floor(hi * d / f)::BIGINT + 2)) AS i FROM steps, lim
  WHERE (hi - lo) * d / f < {4 * most} AND (hi > lo OR f / d = 1))),
used AS (SELECT * FROM edges, lim WHERE b > lo AND a <= hi),
step AS (SELECT f, d, min(i) AS first FROM used GROUP BY f, d HAVING count(*) <= {most} ORDER BY f / d LIMIT 1),
bins AS (SELECT label, u.* FROM used u JOIN step USING (f, d), (VALUES (0), (1)) c(label))
SELECT bins.label, (i - (SELECT first FROM step))::INTEGER AS bin, a AS bin_start, b AS bin_end, count(x) AS n
FROM bins LEFT JOIN v ON v.label = bins.label AND x >= a AND x < b GROUP BY bins.label, i, a, b"""


def _undersampled(label: str) -> str:
    return f"""WITH {_uniq(label)}, h AS (
  SELECT doc_id, score, row_number() OVER (PARTITION BY score ORDER BY md5('42:balance:' || doc_id::VARCHAR), doc_id) AS rn
  FROM uniq WHERE score IN (1, 2))
SELECT doc_id, score - 1 AS label, score AS "Score" FROM h
WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM h GROUP BY score))"""


_TEST_ROWS = f"""WITH {_uniq()}, h AS (
  SELECT *, row_number() OVER (PARTITION BY score ORDER BY md5('42:balance:' || doc_id::VARCHAR), doc_id) AS rn
  FROM uniq WHERE score IN (1, 2)), b AS (
  SELECT * FROM h WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM h GROUP BY score))),
test AS (SELECT doc_id, score - 1 AS label FROM b WHERE length({_norm('text')}) >= 3
  AND substr(md5('42:split:' || doc_id::VARCHAR), 1, 8) >= 'cccccccc')"""


_TRAIN_ROWS = _TEST_ROWS.replace("test AS", "train AS").replace(">= 'cccccccc'", "< 'cccccccc'")

# Newton steps on the scaled feature; the intercept is not penalised
_NEWTON = f"""WITH RECURSIVE {_rev()}, x AS (SELECT label, length(text) / 1000.0::DOUBLE AS x FROM rev),
s AS (SELECT avg(x) AS mean, stddev_samp(x) AS deviation FROM x),
z AS MATERIALIZED (SELECT label, (x - mean) / deviation AS z FROM x, s),
fit AS (
  SELECT 0 AS i, 0.0::DOUBLE AS b, 0.0::DOUBLE AS w
  UNION ALL
  SELECT i + 1, b - (hww * gb - hbw * gw) / (hbb * hww - hbw * hbw), w - (hbb * gw - hbw * gb) / (hbb * hww - hbw * hbw)
  FROM (SELECT i, b, w, avg(p - label) AS gb, avg((p - label) * z) + 0.1 * w AS gw,
          avg(p * (1 - p)) AS hbb, avg(p * (1 - p) * z) AS hbw, avg(p * (1 - p) * z * z) + 0.1 AS hww
        FROM (SELECT i, b, w, label, z, 1 / (1 + exp(-(b + w * z))) AS p FROM fit, z WHERE i < 25) GROUP BY i, b, w)),
best AS (SELECT b, w FROM fit WHERE i = 25)"""


def _balance(label: str) -> str:
    return f"""WITH {_uniq(label)}, c AS (SELECT score, count(*) AS n FROM uniq GROUP BY score)
SELECT max(n)::DOUBLE / min(n) AS ratio, max(n)::DOUBLE / min(n) > 1.5 AS imbalanced FROM c"""


def _edges(low: float, width: str, bins: int, high: str) -> str:
    """Condition of a value x in bin b, by the bin's own edges."""
    return (f"x >= {low} + b * {width} AND x <= {high} "
            f"AND (x < {low} + (b + 1) * {width} OR b = {bins - 1})")


_BINS = "bins AS (SELECT unnest(range(50))::INTEGER AS b)"
_BOTH = "cells AS (SELECT b, c AS label FROM bins, (VALUES (0), (1)) v(c))"

ORACLE: dict[str, str] = {
    "row_count": f"WITH {_raw()} SELECT count(*) AS n_rows, 4 AS n_columns FROM raw",
    "null_profile": f"""WITH {_raw()}, c AS (SELECT count(*) AS total, count(*) - count(doc_id) AS d,
  count(*) - count(score) AS s, count(*) - count(summary) AS m, count(*) - count(text) AS t FROM raw)
SELECT 'doc_id' AS column_name, d AS nulls, d / total * 100 AS pct FROM c
UNION ALL SELECT 'Score', s, s / total * 100 FROM c UNION ALL SELECT 'Summary', m, m / total * 100 FROM c
UNION ALL SELECT 'Text', t, t / total * 100 FROM c""",
    "duplicate_report": f"""WITH {_raw()}, d AS (SELECT DISTINCT score, summary, text FROM raw)
SELECT (SELECT count(*) FROM raw) AS total_rows, (SELECT count(*) FROM d) AS distinct_rows,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM d) AS duplicates""",
    "class_distribution": f"""WITH {_raw()}
SELECT score AS "Score", count(*) AS n, count(*) / (SELECT count(*) FROM raw) * 100 AS pct,
  CASE score WHEN 1 THEN 'Negativ' WHEN 2 THEN 'Positiv' END AS class_name FROM raw GROUP BY score""",
    "class_balance": _balance("quality"),
    "class_balance_toxic": _balance("toxic"),
    "label_distribution": f"""WITH {_rev()}
SELECT label, count(*) AS n, count(*) / (SELECT count(*) FROM rev) * 100 AS pct FROM rev GROUP BY label""",
    "length_stats": f"""WITH {_raw()} SELECT min(length(text))::INTEGER AS min_len,
  round(avg(length(text)), 0) AS avg_len, max(length(text))::INTEGER AS max_len FROM raw""",
    "price_median": "SELECT l_returnflag, median(l_extendedprice) AS median FROM lineitem GROUP BY l_returnflag",
    "word_length_median": f"""WITH {_rev()}, t AS (SELECT label, length(text) AS n, len(string_split(text, ' ')) AS words FROM rev)
SELECT label, median((n - words + 1)::DOUBLE / words) AS median FROM t GROUP BY label""",
    "length_median": f"WITH {_rev()} SELECT label, median(length(text))::DOUBLE AS median_len FROM rev GROUP BY label",
    "length_histogram": f"""WITH {_raw()}, {_BINS}, v AS (SELECT length(text) AS x FROM raw)
SELECT b AS bin, b * 60.0::DOUBLE AS bin_start, count(x) AS n
FROM bins LEFT JOIN v ON {_edges(0, '60', 50, '3000')} GROUP BY b""",
    "length_histogram_by_class": f"""WITH {_rev()}, {_BINS}, {_BOTH}, v AS (SELECT label, length(text) AS x FROM rev)
SELECT cells.label, b AS bin, b * 40.0::DOUBLE AS bin_start, count(x) AS n
FROM cells LEFT JOIN v ON cells.label = v.label AND {_edges(0, '40', 50, '2000')} GROUP BY cells.label, b""",

    "length_histogram_automatic": f"WITH {_rev()}, v AS (SELECT label, length(text)::DOUBLE AS x FROM rev){_automatic(40)}",
    "probability_histogram_automatic": f"WITH {_SCORED}, v AS (SELECT label, prob_positive AS x FROM scored){_automatic(50)}",

    "clean_reviews": f"WITH {_rev()} SELECT * FROM rev",
    "clean_reviews_clean_dedupe": f"""WITH {_raw()}, n AS (
  SELECT doc_id, score - 1 AS label, {_norm('summary')} AS summary, {_norm('text')} AS text FROM raw
  WHERE score IN (1, 2) AND summary IS NOT NULL AND text IS NOT NULL)
SELECT min(doc_id) AS doc_id, label, summary, text FROM n WHERE length(text) >= 3 GROUP BY label, summary, text""",
    "clean_pages": f"SELECT page_id, {_norm('html')} AS text FROM pages WHERE html IS NOT NULL",
    "clean_unicode": f"SELECT doc_id, {_norm('text', chr(92) + 'p{L}')} AS text FROM documents WHERE text IS NOT NULL",
    "cleaning_report": f"""WITH {_raw()}, a AS (SELECT count(*) AS n FROM raw),
complete AS (SELECT score, summary, text FROM raw WHERE score IS NOT NULL AND summary IS NOT NULL AND text IS NOT NULL),
b AS (SELECT count(*) AS n FROM complete), d AS (SELECT DISTINCT * FROM complete), c AS (SELECT count(*) AS n FROM d),
e AS (SELECT count(*) AS n FROM d WHERE score IN (1, 2)),
f AS (SELECT count(*) AS n FROM d WHERE score IN (1, 2) AND length({_norm('text')}) >= 3)
SELECT 1 AS position, 'nulls' AS step, a.n AS rows_in, b.n AS rows_out, a.n - b.n AS removed FROM a, b
UNION ALL SELECT 2, 'duplicates', b.n, c.n, b.n - c.n FROM b, c
UNION ALL SELECT 3, 'unknown_scores', c.n, e.n, c.n - e.n FROM c, e
UNION ALL SELECT 4, 'short_texts', e.n, f.n, e.n - f.n FROM e, f""",

    "hash_sample": f"""WITH {_raw()} SELECT doc_id, score AS "Score", summary AS "Summary", text AS "Text" FROM raw
WHERE substr(md5('42:sample:' || doc_id::VARCHAR), 1, 8) < '40000000'""",
    "hash_sample_rows": """SELECT doc_id, n_chars FROM documents
WHERE ('0x' || substr(md5('42:sample:' || doc_id::VARCHAR), 1, 8))::BIGINT
  < floor(400.0::DOUBLE / (SELECT count(*) FROM documents) * 4294967296)""",
    "hash_split": f"""WITH {_rev()} SELECT doc_id, label,
  CASE WHEN substr(md5('42:split:' || doc_id::VARCHAR), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split FROM rev""",
    "split_report": f"""WITH {_uniq()}, h AS (
  SELECT *, row_number() OVER (PARTITION BY score ORDER BY md5('42:balance:' || doc_id::VARCHAR), doc_id) AS rn
  FROM uniq WHERE score IN (1, 2)), b AS (
  SELECT * FROM h WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM h GROUP BY score)))
SELECT CASE WHEN substr(md5('42:split:' || doc_id::VARCHAR), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split,
  score - 1 AS label, count(*) AS n FROM b WHERE length({_norm('text')}) >= 3 GROUP BY ALL""",
    "random_rows": "SELECT doc_id, text FROM documents ORDER BY md5('7:order:' || doc_id::VARCHAR), doc_id LIMIT 10",
    "undersample_exact": _undersampled("quality"),
    "undersample_toxic": _undersampled("toxic"),
    "balanced_reviews": f"""WITH {_uniq()}, h AS (
  SELECT *, row_number() OVER (PARTITION BY score ORDER BY md5('42:balance:' || doc_id::VARCHAR), doc_id) AS rn
  FROM uniq WHERE score IN (1, 2)), b AS (
  SELECT * FROM h WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM h GROUP BY score)))
SELECT doc_id, score - 1 AS label, {_norm('summary')} AS summary, {_norm('text')} AS text FROM b
WHERE length({_norm('text')}) >= 3""",

    "filtered_tokens": f"""WITH {_docs()}, t AS (SELECT doc_id, string_split(text, ' ') AS tokens FROM docs),
f AS (SELECT doc_id, tokens, list_filter(tokens, lambda w: NOT list_contains({_list(ENGLISH)}, w)) AS kept FROM t)
SELECT doc_id, len(tokens)::INTEGER AS before, len(kept)::INTEGER AS after,
  coalesce(array_to_string(kept, ' '), '') AS filtered FROM f""",
    "token_stats": f"""WITH {_rev()}, t AS (SELECT string_split(text, ' ') AS tokens FROM rev),
c AS (SELECT len(tokens) AS b, len(list_filter(tokens, lambda w: NOT list_contains({_list(ENGLISH)}, w))) AS a FROM t)
SELECT min(b)::INTEGER AS min_tokens, round(avg(b), 0) AS avg_tokens, max(b)::INTEGER AS max_tokens,
  round(avg(b), 1) AS tokens_before, round(avg(a), 1) AS tokens_after, round(avg(b - a), 1) AS tokens_removed FROM c""",
    "top_words_default": f"WITH {_words()} {_top('label', 15)}",
    "top_words_plus6": f"WITH {_words(ENGLISH_PLUS6)} {_top('label', 80)}",
    "top_words_compact": f"WITH {_words(COMPACT140, ' AND length(w) > 2')} {_top('label', 20)}",
    "top_words_bounded": f"WITH {_words(COMPACT140, ' AND length(w) > 2')} {_top('label', 20)}",
    "role_top_words": f"""WITH words AS (SELECT role, w AS word FROM (
  SELECT role, unnest(string_split({_norm('text')}, ' ')) AS w FROM conversations WHERE text IS NOT NULL)
  WHERE NOT list_contains({_list(COMPACT140)}, w) AND length(w) > 2) {_top('role', 20)}""",
    "word_ratio": f"WITH {_words()} {_ratio()} SELECT * FROM ratio",
    "word_ratio_joined": f"WITH {_words()} {_ratio()} SELECT * FROM ratio",
    "word_ratio_one_sided": f"""WITH {_words()}
SELECT word, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg,
  (count(*) FILTER (label = 1))::DOUBLE / (count(*) FILTER (label = 0) + 1) AS ratio
FROM words GROUP BY word HAVING count(*) > 5""",
    "word_ratio_top": f"WITH {_words(ENGLISH_PLUS6)} {_ratio()} {_TOP_RATIO}",
    "bigram_ratio_top": f"""WITH {_rev()}, tok AS (SELECT label, string_split(text, ' ') AS t FROM rev),
grams AS (SELECT label, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS word FROM tok)
{_ratio('grams', 20)} {_TOP_RATIO}""",

    "document_frequency": f"""WITH {_TERMS}
SELECT word, count(DISTINCT doc_id) AS df FROM terms GROUP BY word""",
    "tfidf_long": _tfidf("word", "word"),
    "tfidf_in_blocks": _tfidf("word", "word"),
    "hashed_tfidf_md5": _tfidf(_BUCKET, "bucket"),
    "cooccurrence": f"WITH {_PAIRS} SELECT * FROM pairs WHERE n >= 5",
    "word_information": f"""WITH {_PAIRS}, x AS (
  SELECT p.word, p.other, p.n, ln(p.n::DOUBLE * (SELECT sum(total) FROM totals)::DOUBLE / t.total::DOUBLE / o.total::DOUBLE) AS information
  FROM pairs p JOIN totals t ON p.word = t.word JOIN totals o ON p.other = o.word WHERE p.n >= 5)
SELECT word, other, n, round(information, 6) AS information FROM x WHERE information > 0""",
    "feature_density": f"""WITH {_TERMS}, d AS (
  SELECT doc_id, count(DISTINCT {_BUCKET}) AS z, count(*) AS n FROM terms GROUP BY doc_id)
SELECT doc_id, 10000 AS dimensions, coalesce(z, 0)::INTEGER AS non_zero, coalesce(n, 0)::INTEGER AS n_tokens
FROM docs LEFT JOIN d USING (doc_id)""",

    "lexicon_predictions": f"WITH {_SCORED} SELECT * FROM scored",
    "confusion": f"""WITH {_SCORED}
SELECT l AS label, p::DOUBLE AS prediction, count(doc_id) AS n,
  count(doc_id) / (SELECT count(*) FROM scored) * 100 AS pct
FROM (VALUES (0), (1)) a(l) CROSS JOIN (VALUES (0), (1)) b(p)
LEFT JOIN scored ON scored.label = l AND scored.prediction = p GROUP BY l, p""",
    "confusion_crosstab": f"""WITH {_SCORED} SELECT label, count(*) FILTER (prediction = 0) AS predicted_negative,
  count(*) FILTER (prediction = 1) AS predicted_positive FROM scored GROUP BY label""",
    "metrics_positive": f"""WITH {_SCORED} {_CLASSES}
SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
  round((SELECT accuracy FROM acc), 6) AS accuracy, round((SELECT p FROM prf WHERE c = 1), 6) AS precision,
  round((SELECT r FROM prf WHERE c = 1), 6) AS recall, round((SELECT f FROM prf WHERE c = 1), 6) AS f1 FROM scored""",
    "metrics_weighted": f"""WITH {_SCORED} {_CLASSES}
SELECT round((SELECT accuracy FROM acc), 6) AS accuracy, round(sum(n * p) / sum(n), 6) AS weighted_precision,
  round(sum(n * r) / sum(n), 6) AS weighted_recall, round(sum(n * f) / sum(n), 6) AS weighted_f1 FROM prf""",
    "metrics_table": f"""WITH {_SCORED} {_CLASSES} {_ROC}
SELECT 'accuracy' AS metric, 'all' AS scope, round(accuracy, 6) AS value FROM acc
UNION ALL SELECT 'precision', 'positive', round(p, 6) FROM prf WHERE c = 1
UNION ALL SELECT 'recall', 'positive', round(r, 6) FROM prf WHERE c = 1
UNION ALL SELECT 'f1', 'positive', round(f, 6) FROM prf WHERE c = 1
UNION ALL SELECT 'precision', 'weighted', round(sum(n * p) / sum(n), 6) FROM prf
UNION ALL SELECT 'recall', 'weighted', round(sum(n * r) / sum(n), 6) FROM prf
UNION ALL SELECT 'f1', 'weighted', round(sum(n * f) / sum(n), 6) FROM prf
UNION ALL SELECT 'auc', 'all', round(auc, 6) FROM auc
UNION ALL SELECT 'left_out', 'matrix', (count(*) FILTER (label NOT IN (0, 1)))::DOUBLE FROM scored
UNION ALL SELECT 'left_out', 'auc', (count(*) - count(prob_positive))::DOUBLE FROM scored""",
    "roc_curve": f"WITH {_SCORED} {_ROC} {_roc_points('')}",
    "roc_curve_corners": f"""WITH {_SCORED} {_ROC}
{_roc_points('WHERE i = 1 OR next_pc IS NULL OR next_pc <> pc OR next_nc <> nc')}""",
    "auc_exact": f"WITH {_SCORED} {_ROC} SELECT round(auc, 6) AS auc FROM auc",
    "probability_histogram": f"""WITH {_SCORED}, {_BINS}, {_BOTH},
lim AS (SELECT label, min(prob_positive) - CASE WHEN min(prob_positive) = max(prob_positive) THEN 0.5 ELSE 0 END AS lo,
  max(prob_positive) + CASE WHEN min(prob_positive) = max(prob_positive) THEN 0.5 ELSE 0 END AS hi
  FROM scored GROUP BY label), v AS (SELECT label, prob_positive AS x FROM scored)
SELECT cells.label, b AS bin, round(any_value(lo + b * ((hi - lo) / 50)), 6) AS bin_start, count(x) AS n
FROM cells JOIN lim ON cells.label = lim.label LEFT JOIN v ON v.label = cells.label
  AND {_edges('lo', '((hi - lo) / 50)', 50, 'hi')} GROUP BY cells.label, b""",
    "probability_histogram_common": f"""WITH {_SCORED}, {_BINS}, {_BOTH},
v AS (SELECT label, prob_positive AS x FROM scored)
SELECT cells.label, b AS bin, round(b * 0.02::DOUBLE, 6) AS bin_start, count(x) AS n
FROM cells LEFT JOIN v ON v.label = cells.label AND {_edges('0.0::DOUBLE', '0.02::DOUBLE', 50, '1.0')}
GROUP BY cells.label, b""",

    "example_table": f"""WITH {_SCORED}, k AS (
  SELECT *, CASE WHEN label = 0 AND prediction = 0 AND prob_positive < 0.15 THEN 'Richtig Negativ'
    WHEN label = 1 AND prediction = 1 AND prob_positive > 0.85 THEN 'Richtig Positiv'
    WHEN label <> prediction THEN 'Falsch' END AS typ FROM scored WHERE length(text) BETWEEN 80 AND 3000),
r AS (SELECT *, row_number() OVER (PARTITION BY typ ORDER BY doc_id)::INTEGER AS position FROM k WHERE typ IS NOT NULL)
SELECT typ, doc_id, label, prediction, prob_positive,
  CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END AS short_text, position
FROM r WHERE position <= CASE typ WHEN 'Falsch' THEN 6 ELSE 5 END""",
    "prediction_preview": f"""WITH {_SCORED}, r AS (
  SELECT *, label = prediction AS correct,
    row_number() OVER (PARTITION BY label = prediction ORDER BY doc_id)::INTEGER AS position FROM scored)
SELECT correct, doc_id, label, prediction,
  CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END AS short_text, position
FROM r WHERE position <= 5""",
    "explorer": f"""WITH {_SCORED}, f AS (
  SELECT * FROM scored WHERE label = prediction AND label = 1
    AND ((prob_positive >= 0.6::DOUBLE AND prediction = 1)
      OR (prob_positive <= 1 - 0.6::DOUBLE AND prediction = 0)))
SELECT doc_id, label = prediction AS correct, CASE label WHEN 1 THEN 'Positiv' ELSE 'Negativ' END AS actual,
  CASE prediction WHEN 1 THEN 'Positiv' ELSE 'Negativ' END AS predicted, prob_positive,
  CASE WHEN prediction = 1 THEN prob_positive ELSE 1 - prob_positive END AS confidence,
  CASE WHEN length(text) > 400 THEN substr(text, 1, 400) || '...' ELSE text END AS short_text,
  (SELECT count(*) FROM f) AS matches
FROM f ORDER BY md5('42:order:' || doc_id::VARCHAR), doc_id LIMIT 8""",
    "explorer_wrong": f"""WITH {_SCORED}
SELECT doc_id, label, prediction, prob_positive FROM scored WHERE label <> prediction
  AND ((prob_positive >= 0.7::DOUBLE AND prediction = 1) OR (prob_positive <= 1 - 0.7::DOUBLE AND prediction = 0))""",
    "overview": f"""WITH {_SCORED} {_CLASSES} {_ROC}
SELECT count(*) AS total, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
  count(*) FILTER (label = 1) / count(*) * 100 AS positive_pct, count(*) FILTER (label = 0) / count(*) * 100
    AS negative_pct, round((SELECT accuracy FROM acc), 6) AS accuracy, round((SELECT auc FROM auc), 6) AS auc FROM rev""",

    "bernoulli_sample_check": "SELECT 0::BIGINT AS unknown, 0::BIGINT AS repeated, count(*) > 0 AS fits FROM documents",
    "random_split_union": f"WITH {_rev()} SELECT doc_id, label FROM rev",
    "undersample_bernoulli_smallest": f"""WITH {_rev()}, c AS (SELECT label, count(*) AS n FROM rev GROUP BY label)
SELECT doc_id, label FROM rev WHERE label = (SELECT label FROM c ORDER BY n, label LIMIT 1)""",
    "ml_scores_check": f"{_TEST_ROWS} SELECT doc_id, label, true AS in_range, true AS agree FROM test",
    "ml_features_check": f"WITH {_docs()} SELECT doc_id, 10000 AS dimensions, true AS fits FROM docs",
    "ml_metrics_agree": """SELECT metric, scope, true AS equal FROM (VALUES ('auc', 'all'), ('accuracy', 'all'),
  ('f1', 'weighted'), ('precision', 'weighted'), ('recall', 'weighted')) v(metric, scope)""",
    "training_metrics": "SELECT true AS accuracy_defined, true AS auc_defined, true AS not_below_test",
    "training_history": f"""{_TRAIN_ROWS}, c AS (SELECT count(*) AS n, avg(label) AS p FROM train)
SELECT n AS n_rows, round(-p * ln(p) - (1 - p) * ln(1 - p), 6) AS start_loss, true AS never_rises, true AS stored_has_last FROM c""",
    "length_model": f"""{_NEWTON} SELECT count(*) AS n_rows, round(any_value(b - w * mean / deviation), 5) AS intercept,
  round(any_value(w / deviation), 5) AS weight,
  round(avg(ln(1 + exp(CASE WHEN label = 1 THEN -(b + w * z) ELSE b + w * z END))) + any_value(0.05 * w * w), 6) AS loss,
  true AS at_optimum FROM z, best, s""",
    "model_roundtrip": f"{_TEST_ROWS} SELECT doc_id, true AS same FROM test",
    "stored_probabilities": f"""WITH {_SCORED} SELECT doc_id, prediction,
  CASE WHEN doc_id % 5 = 0 THEN 0.5::DOUBLE ELSE round(prob_positive, 6) END AS prob_positive FROM scored""",
    "word_count_map": f"WITH {_words()}, top AS ({_top('label', 15)}) SELECT label, word, n FROM top",
    "tokens_raw": r"""SELECT doc_id, CASE WHEN length(text) > 0 AND NOT regexp_matches(text, '[^ \t\n\x0B\f\r]') THEN 0
  ELSE len(string_split_regex(regexp_replace(lower(text), '[ \t\n\x0B\f\r]+$', ''), '[ \t\n\x0B\f\r]')) END::INTEGER AS n_tokens
FROM documents WHERE text IS NOT NULL""".replace(chr(92) * 2, chr(92)),
    "schema_table": """SELECT * FROM (VALUES ('doc_id', 'bigint', true), ('text', 'string', true), ('lang', 'string', true),
  ('source', 'string', true), ('n_chars', 'bigint', true)) v(column_name, type, nullable)""",
    "csv_renamed": f"""WITH {_raw()} SELECT score AS "Score", nullif(summary, '') AS "Summary",
  nullif(text, '') AS "Text" FROM raw""",
    "csv_roundtrip": f"""WITH {_raw()} SELECT score AS "Score", nullif(summary, '') AS "Summary",
  nullif(text, '') AS "Text" FROM raw""",
    "csv_split_roundtrip": f"""WITH {_raw()} SELECT score AS "Score", nullif(summary, '') AS "Summary",
  nullif(text, '') AS "Text" FROM raw""",
    "csv_header_roundtrip": f"WITH {_rev()} SELECT label, nullif(summary, '') AS summary, text FROM rev",
}
