import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType


@pytest.fixture(scope="session")
def docs(spark):
    """A function that makes a documents table of ``(doc_id, text)`` rows, with columns that clash."""
    def make(rows, partitions=3):
        schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                             StructField("lang", StringType()), StructField("source", StringType()),
                             StructField("n_chars", LongType()), StructField("chunk", StringType()),
                             StructField("kept", StringType()), StructField("n_words", StringType())])
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 1, "c", "k", "w") for r in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)
    return make
