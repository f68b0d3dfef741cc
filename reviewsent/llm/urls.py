"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

Everything runs in the JVM: SQL functions for the features, MLlib for the trees.

Defined results for odd input: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is judged by the trees on the features of an empty host. Repeated
rows are judged alike, one row each. Without labelled URLs of both kinds there is nothing
to learn: the verdict is then the only kind that occurs, or ``allow``.
"""

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from reviewsent.sources.shared import stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the task.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
         Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))
#: Bound of the training sample, in distinct labelled URLs.
MAX_LABELLED = 20_000

FEATURES = ["url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio",
            "hyphens", "url_entropy", "host_entropy", "parameters", "query_length", "has_fragment", "has_extension",
            "upper_ratio", "suffix_share", "suffix_hosts"]


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_rule(host: Column, path: Column, rules, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    result = None
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        result = F.when(fits, value(rule)) if result is None else result.when(fits, value(rule))
    return result if result is not None else F.lit(None).cast("string")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable is never computed again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits; 0 for an empty text."""
    def bits(chars):
        n = F.size(chars).cast("double")

        def add(total, char):
            p = (n - F.size(F.array_remove(chars, char))) / n
            return total - p * F.log2(p)
        return F.aggregate(F.array_distinct(chars), F.lit(0.0), add)
    return F.when(F.length(text) > 0, _let(F.split(text, ""), bits)).otherwise(0.0)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def split_url(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """``(key, url, host, path, suffix, rule, rule_verdict)``."""
    rows = pages.select(F.col(key), F.col(url).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    host, path = F.col("host"), F.col("path")
    return rows.withColumns({
        "suffix": F.substring_index(host, ".", -1),
        "rule": _by_rule(host, path, rules, lambda r: r.name),
        "rule_verdict": _by_rule(host, path, rules, lambda r: r.verdict)})


def lexical_features(rows: DataFrame) -> DataFrame:
    """Add the lexical features of :func:`split_url` rows; all are finite."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits, length = _count(url, "0123456789"), F.length(url)
    return rows.withColumns({
        "url_length": length, "host_length": F.length(host), "path_length": F.length(path),
        "depth": _count(path, "/"), "host_labels": _count(host, "."), "digit_ratio": _ratio(digits, length),
        "host_digit_ratio": _ratio(_count(host, "0123456789"), F.length(host)), "hyphens": _count(url, "-_"),
        "url_entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": F.when(query == "", 0).otherwise(1 + _count(query, "&;")), "query_length": F.length(query),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"),
        "has_extension": path.rlike(r"\.[A-Za-z0-9]+$").cast("int"),
        "upper_ratio": _ratio(_count(url, UPPER), length)})


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """Per host suffix: its share of all URLs and the logarithm of its hosts, over all rows."""
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return rows.groupBy("suffix").agg(
        (F.count(F.lit(1)) / total).alias("suffix_share"),
        F.log1p(F.approx_count_distinct("host")).alias("suffix_hosts"))


def labelled_sample(rows: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """Distinct URLs with a rule, at most about ``bound`` of them, drawn by hash."""
    labelled = rows.where(F.col("rule").isNotNull()).dropDuplicates(["url"])
    n = labelled.count()
    if n <= bound:
        return labelled
    return labelled.where(F.pmod(F.xxhash64("url", F.lit("sample")), F.lit(1 << 20)) < int(bound / n * (1 << 20)))


def judge_urls(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", bound: int = MAX_LABELLED,
               trees: int = 20, depth: int = 4) -> DataFrame:
    """``(key, host, path, rule, verdict, block_score)``: the rule's verdict, else the trees'.

    Statistics and sample are written, as the trees read their rows again and again.
    """
    rows = split_url(pages, rules, key, url)
    statistics = stage_table(suffix_statistics(rows), "suffix_statistics")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    sample = stage_table(lexical_features(labelled_sample(rows, bound)).join(statistics, "suffix").select(
        *FEATURES, F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0).alias("label")), "labelled_urls")
    sample = assembler.transform(sample).select("features", "label")
    kinds = sorted(r["label"] for r in sample.select("label").distinct().collect())  # at most two rows
    if len(kinds) < 2:
        only = "block" if kinds == [1.0] else "allow"
        return rows.select(key, "host", "path", "rule", F.coalesce("rule_verdict", F.lit(only)).alias("verdict"),
                           F.lit(kinds[0] if kinds else 0.0).alias("block_score"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=42).fit(sample)
    scored = model.transform(assembler.transform(lexical_features(rows).join(statistics, "suffix")))
    by_model = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return scored.select(key, "host", "path", "rule", F.coalesce("rule_verdict", by_model).alias("verdict"),
                         vector_to_array(F.col("probability"))[1].alias("block_score"))
