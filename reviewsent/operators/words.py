"""Tokens, stop words, word counts and word ratios.

Words are counted from rows ``(class, word)``. Spark merges equal words inside each
task before the shuffle, so a frequent word is no hot spot.
"""

from pyspark.sql import DataFrame, Window, functions as F

from reviewsent.functions.stopwords import STOP_WORDS
from reviewsent.functions.text import in_list, split_words, tokens, without_words
from reviewsent.sources.shared import stage_table

#: Groups of words that :func:`top_words_bounded` counts first.
BUCKETS = 1 << 16


def with_tokens(df: DataFrame, stop: str = "english", text: str = "text") -> DataFrame:
    """Add ``tokens`` and ``filtered_tokens`` of normalised text."""
    return (df.where(F.col(text).isNotNull())
            .withColumn("tokens", tokens(F.col(text)))
            .withColumn("filtered_tokens", without_words("tokens", STOP_WORDS[stop])))


def token_stats(df: DataFrame, stop: str = "english") -> DataFrame:
    """Tokens per text: smallest, mean and largest count, means before and after stop words."""
    counts = with_tokens(df, stop).select(F.size("tokens").alias("before"), F.size("filtered_tokens").alias("after"))
    return counts.agg(
        F.min("before").alias("min_tokens"),
        F.round(F.avg("before"), 0).alias("avg_tokens"),
        F.max("before").alias("max_tokens"),
        F.round(F.avg("before"), 1).alias("tokens_before"),
        F.round(F.avg("after"), 1).alias("tokens_after"),
        F.round(F.avg(F.col("before") - F.col("after")), 1).alias("tokens_removed"))


def word_rows(df: DataFrame, *keep: str, stop: str = "english", min_length: int = 0,
              text: str = "text") -> DataFrame:
    """One row per word that is no stop word and has at least ``min_length`` letters."""
    return without_stop_rows(
        df.where(F.col(text).isNotNull()).select(*keep, F.explode(tokens(F.col(text))).alias("word")),
        stop, min_length)


def split_word_rows(df: DataFrame, *keep: str, stop: str = "compact140", min_length: int = 3,
                    text: str = "text") -> DataFrame:
    """:func:`word_rows` for text with any whitespace; empty words are dropped."""
    return without_stop_rows(
        df.where(F.col(text).isNotNull()).select(*keep, F.explode(split_words(F.col(text))).alias("word")),
        stop, min_length)


def without_stop_rows(words: DataFrame, stop: str, min_length: int = 0) -> DataFrame:
    words = words.where(f"NOT {in_list('word', STOP_WORDS[stop])}")
    return words.where(F.length("word") >= min_length) if min_length else words


def ngram_rows(df: DataFrame, *keep: str, n: int = 2, text: str = "text") -> DataFrame:
    """One row per run of ``n`` adjacent tokens, stop words included ("not good")."""
    split = df.where(F.col(text).isNotNull()).select(*keep, tokens(F.col(text)).alias("_tokens"))
    grams = F.transform(F.sequence(F.lit(1), F.size("_tokens") - (n - 1)),
                        lambda i: F.array_join(F.slice("_tokens", i, n), " "))
    # sequence() counts down when a text has fewer than n tokens
    enough = F.when(F.size("_tokens") >= n, grams)
    return split.select(*keep, F.explode(enough).alias("word"))


def word_counts(words: DataFrame, by: str) -> DataFrame:
    return words.groupBy(by, "word").agg(F.count("*").alias("n"))


def top_words(words: DataFrame, by: str = "label", k: int = 15) -> DataFrame:
    """The ``k`` most frequent words per class, equal counts in order of the word.

    Spark keeps the first ``k`` rows of each class inside every task before it shuffles
    them for the final ranking.
    """
    return _first(word_counts(words, by), by, k)


def _first(counts: DataFrame, by: str, k: int) -> DataFrame:
    ranked = Window.partitionBy(by).orderBy(F.col("n").desc(), "word")
    return counts.withColumn("position", F.row_number().over(ranked)).where(F.col("position") <= k)


def top_words_bounded(words: DataFrame, by: str = "label", k: int = 15, buckets: int = BUCKETS) -> DataFrame:
    """The rows of :func:`top_words` without a shuffle of the vocabulary.

    Words are counted by hash bucket first, at most ``buckets`` rows per class and task. No word is more frequent than its
    bucket, so the words of the largest buckets give a least count for place ``k``, and only buckets that reach it can hold
    a better or an equal word; if these were not counted yet, a second round counts them. A flat distribution, or
    a class with fewer than ``k`` words, makes all of its buckets such, which is then :func:`top_words`. ``words`` is read
    twice, or three times: make it from a written table.
    """
    rows = words.select(by, "word", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int").alias("bucket"))
    totals = stage_table(rows.groupBy(by, "bucket").agg(F.count("*").alias("total")), "word_buckets")
    largest = Window.partitionBy(by).orderBy(F.col("total").desc(), "bucket")
    first = stage_table(totals.withColumn("place", F.row_number().over(largest)).where(F.col("place") <= 2 * k)
                        .select(by, "bucket"), "largest_buckets")
    counted = stage_table(word_counts(_of_buckets(rows, first, by), by), "counted_words")
    least = (_first(counted, by, k).groupBy(by).agg(F.count("*").alias("places"), F.min("n").alias("least"))
             .where(F.col("places") == k).select(F.col(by).alias("_class"), "least"))
    reach = (totals.join(least, totals[by].eqNullSafe(least["_class"]), "left")
             .where(F.col("total") >= F.coalesce("least", F.lit(0))).select(by, "bucket"))
    rest = stage_table(_of_buckets(reach, first, by, "left_anti"), "further_buckets")
    if not rest.isEmpty():
        counted = counted.unionByName(word_counts(_of_buckets(rows, rest, by), by))
    return _first(counted, by, k)


def _of_buckets(rows: DataFrame, chosen: DataFrame, by: str, how: str = "left_semi") -> DataFrame:
    chosen = chosen.select(F.col(by).alias("_class"), F.col("bucket").alias("_bucket"))
    return rows.join(chosen, rows[by].eqNullSafe(chosen["_class"]) & (rows["bucket"] == chosen["_bucket"]), how)


def word_count_map(top: DataFrame, by: str = "label") -> DataFrame:
    """The rows of :func:`top_words` as one word -> count map per class (at most k entries each)."""
    return top.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("frequencies"))


def word_ratio(words: DataFrame, min_support: int = 50, keep_one_sided: bool = False,
               label: str = "label") -> DataFrame:
    """``pos / (neg + 1)`` of the words seen more than ``min_support`` times.

    One pass counts both classes. Words of one class only are left out unless
    ``keep_one_sided``.
    """
    counts = words.groupBy("word").agg(F.count_if(F.col(label) == 1).alias("pos"),
                                       F.count_if(F.col(label) == 0).alias("neg"))
    kept = F.col("pos") + F.col("neg") > min_support
    if not keep_one_sided:
        kept = kept & (F.col("pos") > 0) & (F.col("neg") > 0)
    return _with_ratio(counts.where(kept))


def word_ratio_joined(words: DataFrame, min_support: int = 50, label: str = "label") -> DataFrame:
    """:func:`word_ratio` as an inner join of the counts of the two classes."""
    pos = words.where(F.col(label) == 1).groupBy("word").agg(F.count("*").alias("pos"))
    neg = words.where(F.col(label) == 0).groupBy("word").agg(F.count("*").alias("neg"))
    return _with_ratio(pos.join(neg, "word").where(F.col("pos") + F.col("neg") > min_support))


def _with_ratio(counts: DataFrame) -> DataFrame:
    return counts.withColumn("ratio", F.col("pos") / (F.col("neg") + 1))


def top_ratio(ratio: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` words of highest and the ``k`` words of lowest ratio, with their position.

    Two top-k sorts over the same aggregate; its shuffle runs once.
    """
    def ranked(direction: str, *order) -> DataFrame:
        position = F.row_number().over(Window.partitionBy("direction").orderBy(*order))
        return (ratio.orderBy(*order).limit(k).withColumn("direction", F.lit(direction))
                .withColumn("position", position))

    return ranked("positive", F.col("ratio").desc(), F.col("word")).unionByName(
        ranked("negative", F.col("ratio"), F.col("word")))
