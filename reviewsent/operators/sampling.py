"""Samples, splits and class balancing.

The ``bernoulli_*`` and ``random_*`` forms are Spark's own and depend on how the rows
are partitioned. The ``hash_*`` forms draw by a hash of the row key: the same rows in
every run. Sample, split and balance draw from streams of their own, so they can follow
each other with one seed.
"""

from pyspark.sql import DataFrame, Window, functions as F

from reviewsent.functions.keys import hash_below, key_hash
from reviewsent.schema import CLASSES


def bernoulli_sample(df: DataFrame, target_rows: int, seed: int = 42) -> DataFrame:
    """About ``target_rows`` rows."""
    total = df.count()
    return df.sample(False, min(1.0, target_rows / total), seed) if total else df


def hash_sample(df: DataFrame, fraction: float, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """A share ``fraction`` of the rows."""
    return df.where(hash_below(F.col(key), fraction, seed, "sample")) if fraction < 1 else df


def hash_sample_rows(df: DataFrame, target_rows: int, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """About ``target_rows`` rows."""
    total = df.count()
    return hash_sample(df, target_rows / total, key, seed) if total else df


def random_rows(df: DataFrame, n: int, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """``n`` random rows; another seed is another draw."""
    return df.orderBy(key_hash(F.col(key), seed, "order"), key).limit(n)


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train_df, test_df = df.randomSplit([train, 1 - train], seed)
    return train_df, test_df


def with_split(df: DataFrame, train: float = 0.8, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Add ``split``: ``train`` or ``test``."""
    return df.withColumn("split", F.when(hash_below(F.col(key), train, seed, "split"), "train").otherwise("test"))


def hash_split(df: DataFrame, train: float = 0.8, key: str = "doc_id",
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, disjoint and complete."""
    below = hash_below(F.col(key), train, seed, "split")
    return df.where(below), df.where(~below)


def split_report(df: DataFrame, label: str = "label", train: float = 0.8, key: str = "doc_id",
                 seed: int = 42) -> DataFrame:
    """``(split, label, n)``: size and classes of both sides."""
    return with_split(df, train, key, seed).groupBy("split", label).agg(F.count("*").alias("n"))


def undersample_bernoulli(df: DataFrame, label: str = "label", seed: int = 42,
                          classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """Cut every class to about the size of the smallest one; rows of no class are dropped."""
    rows = df.where(F.col(label).isin(*classes))
    sizes = {row[label]: row["n"] for row in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows
    smallest = min(sizes.values())
    return rows.sampleBy(label, {value: smallest / n for value, n in sizes.items()}, seed)


def undersample(df: DataFrame, label: str = "label", key: str = "doc_id", seed: int = 42,
                classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """Cut every class to exactly the size of the smallest one: its rows of lowest key hash.

    Rows of no class are dropped. Rows with one key, also those without any, are kept or
    dropped together. No class is sorted as a whole. Rows are counted per class and hash
    prefix (65,536 prefixes), running counts find the prefix the cut falls into, and only
    the rows of that prefix are ranked. The last kept hash of each class, one row per
    class, is then broadcast and every row is compared with it.

    ``df`` is read three times, twice for ``label`` and ``key`` alone: pass a table that
    is already written.
    """
    rows = df.where(F.col(label).isin(*classes))
    hashed = rows.select(label, key_hash(F.col(key), seed, "balance").alias("_hash"))
    prefix = F.substring("_hash", 1, 4)
    counts = hashed.groupBy(label, prefix.alias("_prefix")).agg(F.count("*").alias("_n"))
    smallest = (counts.groupBy(label).agg(F.sum("_n").alias("_n"))
                .agg(F.min("_n").alias("_smallest")).scalar())

    upto = F.sum("_n").over(Window.partitionBy(label).orderBy("_prefix"))
    cuts = (counts.withColumn("_upto", upto).withColumn("_smallest", smallest)
            .where((F.col("_upto") >= F.col("_smallest")) & (F.col("_upto") - F.col("_n") < F.col("_smallest")))
            .select(label, "_prefix", (F.col("_smallest") - F.col("_upto") + F.col("_n")).alias("_need")))

    rank = F.row_number().over(Window.partitionBy(label).orderBy("_hash"))
    last = (hashed.withColumn("_prefix", prefix).join(F.broadcast(cuts), [label, "_prefix"])
            .withColumn("_rank", rank).where(F.col("_rank") == F.col("_need"))
            .select(label, F.col("_hash").alias("_last_hash")))
    kept = key_hash(F.col(key), seed, "balance") <= F.col("_last_hash")
    return rows.join(F.broadcast(last), label).where(kept).select(df.columns)
