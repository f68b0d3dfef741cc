"""TF-IDF in long form: one row per document and term.

``tfidf = tf * ln((m + 1) / (df + 1))`` with ``m`` documents, ``df`` of them having the
term: the weights of MLlib's IDF, with terms in place of hash buckets.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewsent.functions.stopwords import STOP_WORDS
from reviewsent.functions.text import tokens, without_words
from reviewsent.operators.words import without_stop_rows
from reviewsent.sources.shared import bucket_in_turn, bucketed_table, setting, stage_table


def md5_bucket(word: Column, buckets: int) -> Column:
    """Bucket of a word, from the first 32 bits of its md5."""
    return (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def filtered_tokens(text: str = "text", stop: str = "english") -> Column:
    """Terms of a normalised text column: its tokens that are no stop words."""
    return without_words(f"split({text}, ' ')", STOP_WORDS[stop])


def hashed_tokens(text: str = "text", buckets: int = 10_000, stop: str = "english") -> Column:
    """:func:`filtered_tokens` as md5 buckets."""
    return F.transform(filtered_tokens(text, stop), lambda w: md5_bucket(w, buckets))


def term_frequencies(df: DataFrame, terms: Column, key: str = "doc_id", name: str = "word") -> DataFrame:
    """``(key, term, tf)`` without a shuffle.

    All terms of a document are in one row: they are sorted there and each run of equal
    terms becomes one row. A document without terms has no row.
    """
    ordered = df.select(key, F.sort_array(terms).alias("_terms"))
    is_start = lambda term, i: F.when((i == 0) | (term != F.get("_terms", i - 1)), i)
    starts = ordered.withColumn(
        "_starts", F.filter(F.transform("_terms", is_start), lambda i: i.isNotNull()))

    def run(start, i):
        end = F.coalesce(F.get("_starts", i + 1), F.size("_terms"))
        return F.struct(F.get("_terms", start).alias(name), (end - start).cast("long").alias("tf"))

    return starts.select(key, F.inline(F.transform("_starts", run)))


def document_frequency(documents: DataFrame, text: str = "text", stop: str = "english") -> DataFrame:
    """Number of documents per word of a normalised text column.

    Repeats are dropped inside the row, stop words after it: as rows they are filtered in
    generated code, as array elements they are not.
    """
    distinct = F.explode(F.array_distinct(tokens(F.col(text)))).alias("word")
    return _document_frequency(without_stop_rows(documents.select(distinct), stop), "word")


def _document_frequency(tf: DataFrame, name: str) -> DataFrame:
    return tf.groupBy(name).agg(F.count("*").alias("df"))


def tfidf_long(documents: DataFrame, terms: Column, key: str = "doc_id", name: str = "word") -> DataFrame:
    """``(key, term, tf, df, idf, tfidf)``.

    Pass ``documents`` as a written table. The term frequencies are written once and read
    twice: only the term column for the document frequencies, all of it for the join. The
    written frequencies have a known size, by which Spark chooses the join; where it shuffles,
    the rows of a frequent term are split between tasks by adaptive execution.
    """
    m = documents.count()
    tf = stage_table(term_frequencies(documents, terms, key, name), "term_frequencies")
    frequencies = stage_table(_document_frequency(tf, name), "document_frequencies")
    return (tf.join(frequencies, name).withColumn("idf", F.log(F.lit(float(m + 1)) / (F.col("df") + 1)))
            .withColumn("tfidf", F.col("tf") * F.col("idf"))
            .select(key, name, "tf", "df", "idf", "tfidf"))


def tfidf_in_blocks(documents: DataFrame, terms: Column, key: str = "doc_id", name: str = "word") -> DataFrame:
    """:func:`tfidf_long` without a shuffle of the term frequencies, as a written table.

    The documents that one task reads are in one block; as many blocks as shuffles have partitions are dealt out in turn,
    each with a bucket of its own. Each block asks once per *distinct* term for its document frequency and
    applies the answer inside the block: the term frequencies are written bucketed by block, their
    distinct terms are counted there, and only rows (block, term) are shuffled, by term to be summed
    and by block to be joined. A term of all documents is one row per block.
    """
    spark = documents.sparkSession
    m = documents.count()
    tf = term_frequencies(documents, terms, key, name).withColumn("_block", bucket_in_turn(spark, F.spark_partition_id()))
    # the term frequencies may stay where they are although the join has the term as another key, the first, as sorting is by it
    # a task writes one bucket, so its rows need not be sorted by bucket first
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "1"), \
            bucketed_table(tf, "term_frequencies", "_block") as tf, \
            setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        asked = tf.groupBy("_block", name).agg(F.count("*").alias("_n"))
        answers = asked.select("_block", name, F.sum("_n").over(Window.partitionBy(name)).alias("df")).withColumn(
            "idf", F.log(F.lit(float(m + 1)) / (F.col("df") + 1)))
        weighed = tf.join(answers, [name, "_block"]).withColumn("tfidf", F.col("tf") * F.col("idf"))
        return stage_table(weighed.select(key, name, "tf", "df", "idf", "tfidf"), "tfidf")


def term_density(documents: DataFrame, terms: Column, dimensions: int = 10_000,
                 key: str = "doc_id") -> DataFrame:
    """Dimensions, non-zero entries and tokens of each document's term vector."""
    rows = documents.select(key, terms.alias("_terms"))
    return rows.select(key, F.lit(dimensions).alias("dimensions"),
                       F.size(F.array_distinct("_terms")).alias("non_zero"),
                       F.size("_terms").alias("n_tokens"))
