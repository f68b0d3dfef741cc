"""Adapters from the given tables to the review schema."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ingest(df: DataFrame, path: str, files: int) -> DataFrame:
    """Write a table as ``files`` files of about equal rows and read it back.

    A parquet file is split no finer than its row groups, so a file written in one piece is
    one task, whatever its size. This is a step of its own, once per table: queries take
    their tables as they are.
    """
    df.repartition(files).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Labels up to this size, at 32 bytes a row, are broadcast to the documents, whose texts then stay where they are.
LABEL_BYTES = 64 << 20


def raw_reviews(spark: SparkSession, folder: str, label: str = "quality") -> DataFrame:
    """``(doc_id, Score, Summary, Text)``: first line as summary, ``label + 1`` as score.

    Documents without a label keep a null score. Once nulls are dropped the optimizer
    turns the left join into an inner join.
    """
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", label)
    if labels.count() * 32 <= LABEL_BYTES:  # else by a shuffle
        labels = F.broadcast(labels)
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        (F.col(label) + 1).cast("int").alias("Score"),
        F.substring_index("text", "\n", 1).alias("Summary"),
        F.col("text").alias("Text"),
    )
