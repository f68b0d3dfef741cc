"""Cleaning: nulls, duplicates, labels, normalised text, short texts."""

from pyspark.sql import DataFrame, functions as F

from reviewsent.functions.keys import row_digest
from reviewsent.functions.text import normalise, normalise_lower, sentiment_label
from reviewsent.sources.shared import stage_table

RAW_COLUMNS = ["Score", "Summary", "Text"]


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of ``columns`` (default: all).

    One ``IS NOT NULL`` per column: unlike ``na.drop``, these are pushed into the scan
    and turn an outer join below into an inner one.
    """
    for column in columns or df.columns:
        df = df.where(F.col(column).isNotNull())
    return df


def drop_duplicates(df: DataFrame, columns: list[str], key: str = "doc_id") -> DataFrame:
    """One row per distinct ``columns``, the one of smallest ``key``; ``key`` is unique.

    Digests of 32 bytes are shuffled and merged, not the rows. The keys of surplus copies are
    written, and the rows lose them by an anti join, which Spark broadcasts if their written
    size allows; else each row moves once, by its key.
    """
    digests = df.select(F.col(key).alias("_key"), row_digest(*[F.col(c) for c in columns]).alias("_digest"))
    first = digests.groupBy("_digest").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    surplus = stage_table(digests.join(first, "_digest").where("_key <> _first").select(F.col("_key").alias(key)),
                          "surplus_copies")
    return df.select(key, *columns).join(surplus, key, "left_anti")


def normalised_once(df: DataFrame, source: str, name: str, letters: str = "ascii") -> DataFrame:
    """Add the normalised form of ``source`` as ``name``.

    The value leaves a one-element generator, because the optimizer copies a plain
    projection into every filter above it and would run the regular expressions twice.
    Lower case is a step of its own, because a generator does not share common terms.
    """
    lower = df.withColumn("_lower", F.lower(source))
    return lower.select(*df.columns, F.explode(F.array(normalise_lower(F.col("_lower"), letters))).alias(name))


def keep_min_length(df: DataFrame, column: str, min_length: int = 3) -> DataFrame:
    return df.where(F.length(column) >= min_length)


def label_reviews(df: DataFrame, score: str = "Score") -> DataFrame:
    """Add ``label``; rows whose score is neither 1 nor 2 are dropped."""
    return df.withColumn("label", sentiment_label(F.col(score))).where(F.col("label").isNotNull())


def normalise_reviews(df: DataFrame, letters: str = "ascii", min_length: int = 3) -> DataFrame:
    """``(doc_id, label, summary, text)`` with normalised texts, short texts dropped."""
    cleaned = keep_min_length(normalised_once(df, "Text", "_clean_text", letters), "_clean_text", min_length)
    return cleaned.select("doc_id", "label", normalise(F.col("Summary"), letters).alias("summary"),
                          F.col("_clean_text").alias("text"))


def clean_reviews(raw: DataFrame, dedupe_on: str = "raw", letters: str = "ascii", min_length: int = 3,
                  dropna_columns: list[str] | None = None) -> DataFrame:
    """Raw ``(doc_id, Score, Summary, Text)`` -> ``(doc_id, label, summary, text)``.

    ``dedupe_on='raw'`` removes copies before the text is normalised, ``'clean'`` after.
    """
    complete = drop_incomplete(raw.select("doc_id", *RAW_COLUMNS), dropna_columns)
    if dedupe_on == "raw":
        complete = drop_duplicates(complete, RAW_COLUMNS)
    cleaned = normalise_reviews(label_reviews(complete), letters, min_length)
    if dedupe_on == "clean":
        cleaned = drop_duplicates(cleaned, ["label", "summary", "text"])
    return cleaned


def clean_texts(df: DataFrame, text: str, *keep: str, letters: str = "ascii", min_length: int = 0) -> DataFrame:
    """Columns ``keep`` and the normalised ``text`` of any table; null texts are dropped."""
    source = df.where(F.col(text).isNotNull())
    if not min_length:
        return source.select(*keep, normalise(F.col(text), letters).alias("text"))
    source = source.select(*keep, F.col(text).alias("_text"))
    return keep_min_length(normalised_once(source, "_text", "text", letters), "text", min_length).drop("_text")


def cleaning_report(raw: DataFrame, min_length: int = 3) -> DataFrame:
    """Rows before and after each cleaning step.

    One pass and one shuffle of row digests with three flags, instead of a count before
    and after every step.
    """
    complete = F.lit(True)
    for column in RAW_COLUMNS:
        complete = complete & F.col(column).isNotNull()
    known = complete & F.col("Score").isin(1, 2)
    # the texts of incomplete rows are not normalised: AND stops at the first false
    long_enough = known & (F.length(normalise_lower(F.col("_lower"))) >= min_length)
    rows = raw.withColumn("_lower", F.lower("Text")).select(row_digest(*[F.col(c) for c in RAW_COLUMNS]).alias("digest"),
                      complete.alias("complete"), known.alias("known"), long_enough.alias("long_enough"))
    groups = rows.groupBy("digest", "complete", "known", "long_enough").agg(F.count("*").alias("n"))
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(F.col("complete"), F.col("n"))), F.lit(0)).alias("complete"),
        F.count_if("complete").alias("distinct"),
        F.count_if("known").alias("known"),
        F.count_if("long_enough").alias("kept"))

    def step(position: int, name: str, before: str, after: str):
        return F.struct(F.lit(position).alias("position"), F.lit(name).alias("step"),
                        F.col(before).alias("rows_in"), F.col(after).alias("rows_out"),
                        (F.col(before) - F.col(after)).alias("removed"))

    return counts.select(F.inline(F.array(
        step(1, "nulls", "raw", "complete"),
        step(2, "duplicates", "complete", "distinct"),
        step(3, "unknown_scores", "distinct", "known"),
        step(4, "short_texts", "known", "kept"))))
