"""Profile of a table: counts, nulls, duplicates, class balance, lengths."""

from pyspark.sql import DataFrame, functions as F

from reviewsent.functions.keys import row_digest
from reviewsent.functions.text import label_name, sentiment_label


def schema_table(df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, type string, nullable boolean")


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percent of each column, in one pass."""
    counts = df.agg(F.count("*").alias("total"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return counts.select("total", F.inline(pairs)).select(
        "column_name", "nulls",
        F.when(F.col("total") > 0, F.col("nulls") / F.col("total") * 100).alias("pct"))


def duplicate_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Total, distinct and surplus rows. Only 32-byte digests are shuffled."""
    columns = columns or df.columns
    groups = (df.select(row_digest(*[F.col(c) for c in columns]).alias("digest"))
              .groupBy("digest").agg(F.count("*").alias("n")))
    return (groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
                       F.count("*").alias("distinct_rows"))
            .withColumn("duplicates", F.col("total_rows") - F.col("distinct_rows")))


def class_distribution(df: DataFrame, score: str = "Score") -> DataFrame:
    """Rows and share in percent per class."""
    counts = df.groupBy(score).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100).orderBy(score)


def named_class_distribution(df: DataFrame, score: str = "Score") -> DataFrame:
    """:func:`class_distribution` with the name of each class."""
    return class_distribution(df, score).withColumn("class_name", label_name(sentiment_label(F.col(score))))


def class_balance(df: DataFrame, score: str = "Score", limit: float = 1.5) -> DataFrame:
    """Ratio of the largest to the smallest class, and whether it is above ``limit``."""
    counts = df.groupBy(score).agg(F.count("*").alias("n"))
    return (counts.agg((F.max("n") / F.min("n")).alias("ratio"))
            .withColumn("imbalanced", F.col("ratio") > limit))


def length_stats(df: DataFrame, length) -> DataFrame:
    """Minimum, rounded mean and maximum of an integer column expression."""
    return df.select(length.alias("len")).agg(
        F.min("len").alias("min_len"), F.round(F.avg("len"), 0).alias("avg_len"), F.max("len").alias("max_len"))


def median_by(df: DataFrame, by: str, length) -> DataFrame:
    """Exact median per group of an integer column expression.

    Equal values are counted first, so the percentile holds one entry per distinct
    length, not one per row.
    """
    counts = df.select(by, length.alias("len")).groupBy(by, "len").agg(F.count("*").alias("n"))
    return counts.groupBy(by).agg(F.percentile("len", 0.5, F.col("n")).alias("median_len"))
