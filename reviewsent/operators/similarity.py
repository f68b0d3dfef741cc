"""Words that are used alike: co-occurrence counts, their information, vectors, nearest words.

1. Pairs of words at most ``window`` places apart are counted. Each text makes its pairs inside its row, each task
   merges equal pairs before the shuffle, and pairs of either order are one row there.
2. The positive pointwise mutual information of a pair compares its count with those of its words.
3. The information is a sparse symmetric matrix. Its largest eigenvectors are found by subspace iteration from random signs:
   every round is one distributed product of the matrix with a block of ``dimensions`` columns. The matrix lies in buckets
   of its rows, so sums need no shuffle; the columns are broadcast up to ``COLUMN_BYTES`` and joined by a shuffle
   beyond. Only products of columns with columns, ``dimensions`` squared numbers, are looked at by the driver.
4. The nearest words of a list of words have the largest cosines with theirs.

A text that is null or has fewer than two words has no pairs. A word next to itself counts like any other pair: twice,
once from either side.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewsent.operators.tfidf import filtered_tokens
from reviewsent.sources.shared import bucketed_table, stage_table

WINDOW, MIN_PAIRS, DIMENSIONS, ROUNDS = 2, 5, 16, 4
#: How many words may be asked for at once: their vectors are part of the plan.
MAX_ASKED = 1000
#: Words, totals and columns up to this size are broadcast.
COLUMN_BYTES = 64 << 20


def _word_lists(df: DataFrame, text: str, stop: str) -> DataFrame:
    return df.where(F.col(text).isNotNull()).select(filtered_tokens(text, stop).alias("_words"))


def _small(rows: DataFrame, row_bytes: int) -> bool:
    return rows.count() * row_bytes <= COLUMN_BYTES


def cooccurrence(df: DataFrame, window: int = WINDOW, min_pairs: int = MIN_PAIRS, text: str = "text",
                 stop: str = "english", totals: DataFrame | None = None) -> DataFrame:
    """``(word, other, n)``: how often ``other`` stands at most ``window`` places from ``word``, stop words left out;
    pairs seen at least ``min_pairs`` times. Each pair is there in both orders.

    With the written :func:`neighbour_counts` as ``totals``, words that have too few neighbours for any pair to
    be kept are left out before the shuffle, as long as the others are few enough to be broadcast.
    """
    words, n = F.col("_words"), F.size("_words")
    shifted = [F.arrays_zip(F.slice(words, 1, F.greatest(n - d, F.lit(0))).alias("a"), F.slice(words, d + 1, n).alias("b"))
               for d in range(1, window + 1)]
    rows = _word_lists(df, text, stop).where(n > 1).select(F.inline(F.concat(*shifted))).where(F.col("b").isNotNull())
    if totals is not None and _small(frequent := totals.where(F.col("total") >= min_pairs).select("word"), 64):
        for side in ("a", "b"):
            rows = rows.join(F.broadcast(frequent.withColumnRenamed("word", side)), side, "left_semi")
    low, high = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    counts = rows.groupBy(low, high).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("n", F.when(F.col("low") == F.col("high"), 2 * F.col("n")).otherwise(F.col("n")))
    both = F.when(F.col("low") == F.col("high"), F.array(F.struct(F.col("low").alias("word"), F.col("high").alias("other")))).otherwise(
        F.array(F.struct(F.col("low").alias("word"), F.col("high").alias("other")),
                F.struct(F.col("high").alias("word"), F.col("low").alias("other"))))
    return counts.where(F.col("n") >= min_pairs).select(F.inline(both), "n")


def neighbour_counts(df: DataFrame, window: int = WINDOW, text: str = "text", stop: str = "english") -> DataFrame:
    """``(word, total)``: neighbours of all occurrences of a word, the sum of its row in the table of all pairs.

    Counted from the places of the words, so that rare pairs need not be kept for it.
    """
    places = _word_lists(df, text, stop).select(F.size("_words").alias("_size"), F.posexplode("_words").alias("_place", "word"))
    near = F.least(F.col("_place"), F.lit(window)) + F.least(F.col("_size") - 1 - F.col("_place"), F.lit(window))
    return places.groupBy("word").agg(F.sum(near).alias("total")).where(F.col("total") > 0)


def information(pairs: DataFrame, totals: DataFrame) -> DataFrame:
    """``(word, other, n, information)``: pairs that are more frequent than chance, by the logarithm of how much.

    ``pairs`` and ``totals`` are written tables. Words with fewer neighbours than the rarest pair has are in no pair;
    the totals of the others are broadcast up to ``COLUMN_BYTES``.
    """
    everything = totals.agg(F.sum("total").alias("s")).scalar()
    totals = totals.where(F.col("total") >= pairs.agg(F.min("n")).scalar())
    other = totals.select(F.col("word").alias("other"), F.col("total").alias("_other_total"))
    if _small(totals, 64):
        totals, other = F.broadcast(totals), F.broadcast(other)
    ratio = F.col("n").cast("double") * everything / F.col("total") / F.col("_other_total")
    return (pairs.join(totals, "word").join(other, "other").select("word", "other", "n", F.log(ratio).alias("information"))
            .where(F.col("information") > 0))


# Long lists of columns go into the plan as SQL text: each column made in Python is a round trip to the JVM.

def _array(items) -> Column:
    return F.expr(f"array({', '.join(items)})")


def _signs(dimensions: int, seed: int) -> Column:
    return _array(f"if(xxhash64(word, {seed}, {k}) % 2 = 0, 1D, -1D)" for k in range(dimensions))


def multiplied(matrix: DataFrame, vectors: DataFrame, dimensions: int) -> DataFrame:
    """``(word, vector)``: the sparse ``matrix`` times the columns of ``vectors``, a written table or a plain function
    of the rows of ``matrix``."""
    columns = vectors.withColumnRenamed("word", "other")
    rows = matrix.join(F.broadcast(columns) if _small(vectors, 8 * dimensions + 64) else columns, "other")
    return rows.groupBy("word").agg(_array(f"sum(information * vector[{k}])" for k in range(dimensions)).alias("vector"))


def _products(rows: DataFrame, left: str, right: str, dimensions: int) -> np.ndarray:
    """``left`` transposed times ``right``: one row of ``dimensions`` squared sums."""
    sums = _array(f"sum({left}[{i}] * {right}[{j}])" for i in range(dimensions) for j in range(dimensions))
    return np.array([x or 0.0 for x in rows.agg(sums.alias("p")).first()["p"]]).reshape(dimensions, dimensions)


def _combined(columns: np.ndarray) -> Column:
    """``vector`` times a small matrix."""
    return _array(" + ".join(f"vector[{i}] * {float(x)!r}D" for i, x in enumerate(column)) for column in columns.T)


def _orthonormal(vectors: DataFrame, dimensions: int) -> tuple[DataFrame, int]:
    """The same space spanned by orthonormal columns; what is linearly dependent is left out."""
    values, turned = np.linalg.eigh(_products(vectors, "vector", "vector", dimensions))
    kept = values > max(values[-1], 0) * 1e-12 if len(values) else values > 0
    basis = turned[:, kept] / np.sqrt(values[kept])
    return vectors.select("word", _combined(basis).alias("vector")), int(kept.sum())


def word_vectors(matrix: DataFrame, dimensions: int = DIMENSIONS, rounds: int = ROUNDS, seed: int = 42) -> DataFrame:
    """``(word, vector)``: rows of the eigenvectors of largest absolute eigenvalue, each times the root of that value;
    a written table.

    ``matrix`` is ``(word, other, information)`` with both orders of each pair. There are fewer than
    ``dimensions`` columns if the matrix has a smaller rank, and no rows if it is empty.
    """
    rows = matrix.select("word", "other", "information").repartition("word")
    with bucketed_table(rows, "matrix", "word") as matrix:
        rank = dimensions
        signs = matrix.select("word").distinct().select("word", _signs(dimensions, seed).alias("vector"))
        vectors = stage_table(signs, "basis")
        for _ in range(rounds):
            product = stage_table(multiplied(matrix, vectors, rank), "product")
            vectors, rank = _orthonormal(product, rank)
            if not rank:
                return vectors
            vectors = stage_table(vectors, "basis")
        product = multiplied(matrix, vectors, rank).select("word", F.col("vector").alias("product"))
        inner = _products(vectors.join(stage_table(product, "product"), "word"), "vector", "product", rank)
    values, turned = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-np.abs(values))
    return stage_table(vectors.select("word", _combined((turned * np.sqrt(np.abs(values)))[:, order]).alias("vector")), "word_vectors")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _constant(word: str, vector: list[float]) -> str:
    text = "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"named_struct('word', {text}, 'vector', array({', '.join(f'{x!r}D' for x in vector)}))"


def similar_words(vectors: DataFrame, words: list[str], k: int = 10) -> DataFrame:
    """``(word, similar, cosine, position)``: the ``k`` words nearest to each of at most ``MAX_ASKED`` ``words``.

    The vectors asked for are constants of the plan, so each word is compared where it is; every task keeps its best ``k``
    before the shuffle. A word without a vector, or whose vector is zero, has no row.
    """
    if len(words) > MAX_ASKED:
        raise ValueError(f"at most {MAX_ASKED} words at once")
    normed = vectors.select("word", "vector", F.sqrt(_dot(F.col("vector"), F.col("vector"))).alias("_norm")).where(F.col("_norm") > 0)
    normed = normed.select("word", F.transform("vector", lambda x: x / F.col("_norm")).alias("vector"))
    asked = normed.where(F.col("word").isin(*words)).collect() if words else []
    if not asked:
        return vectors.sparkSession.createDataFrame([], "word string, similar string, cosine double, position int")
    found = normed.select(F.col("word").alias("similar"), F.inline(F.transform(
        _array(_constant(r["word"], r["vector"]) for r in asked), lambda one: F.struct(one["word"].alias("word"), _dot(one["vector"], F.col("vector")).alias("cosine")))))
    place = F.row_number().over(Window.partitionBy("word").orderBy(F.col("cosine").desc(), "similar"))
    return (found.where(F.col("word") != F.col("similar")).select("word", "similar", "cosine", place.alias("position"))
            .where(F.col("position") <= k))
