"""Example selection and the filtered browser over ``(doc_id, label, prediction, prob_positive, text)``."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewsent.functions.keys import key_hash
from reviewsent.functions.text import confidence, label_name, shorten
from reviewsent.operators.evaluation import auc, positive_metrics
from reviewsent.schema import CORRECT_NEGATIVE, CORRECT_POSITIVE, WRONG


def is_correct() -> Column:
    return F.col("label") == F.col("prediction")


def confident_correct(label: int, high: float = 0.85, low: float = 0.15) -> Column:
    """Rows of class ``label`` predicted right and with a clear probability."""
    clear = F.col("prob_positive") > high if label == 1 else F.col("prob_positive") < low
    return (F.col("label") == label) & (F.col("prediction") == label) & clear


def min_confidence(threshold: float) -> Column:
    """Predicted class has at least probability ``threshold``."""
    positive = (F.col("prob_positive") >= threshold) & (F.col("prediction") == 1)
    negative = (F.col("prob_positive") <= 1 - threshold) & (F.col("prediction") == 0)
    return positive | negative


def _first_per_group(df: DataFrame, group: str, limits: dict, key: str = "doc_id") -> DataFrame:
    """The first rows per group in key order; each task cuts its rows before the shuffle."""
    position = F.row_number().over(Window.partitionBy(group).orderBy(key))
    ranked = df.withColumn("position", position).where(F.col("position") <= max(limits.values()))
    keep = F.lit(False)
    for value, limit in limits.items():
        keep = keep | ((F.col(group) == value) & (F.col("position") <= limit))
    return ranked.where(keep)


def example_table(predictions: DataFrame, positives: int = 5, negatives: int = 5, wrong: int = 6,
                  lengths: tuple[int, int] = (80, 300), wrong_lengths: tuple[int, int] | None = None,
                  high: float = 0.85, low: float = 0.15, short: int = 80) -> DataFrame:
    """Confident right predictions of both classes and wrong ones, of readable length, in one pass.

    A kind with 0 rows asked for is left out.
    """
    length = F.length("text")
    readable = length.between(*lengths)
    kind = (F.when(confident_correct(0, high, low) & readable, CORRECT_NEGATIVE)
            .when(confident_correct(1, high, low) & readable, CORRECT_POSITIVE)
            .when(~is_correct() & length.between(*(wrong_lengths or lengths)), WRONG))
    rows = predictions.select(kind.alias("typ"), "doc_id", "label", "prediction", "prob_positive",
                              shorten(F.col("text"), short).alias("short_text"))
    limits = {CORRECT_NEGATIVE: negatives, CORRECT_POSITIVE: positives, WRONG: wrong}
    return _first_per_group(rows.where(F.col("typ").isNotNull()), "typ", limits)


def prediction_preview(predictions: DataFrame, n: int = 5, short: int = 80) -> DataFrame:
    """The first ``n`` right and the first ``n`` wrong predictions."""
    rows = predictions.select(is_correct().alias("correct"), "doc_id", "label", "prediction",
                              shorten(F.col("text"), short).alias("short_text"))
    return _first_per_group(rows, "correct", {True: n, False: n})


def explore(predictions: DataFrame, outcome: str = "all", sentiment: str = "all",
            min_conf: float = 0.5) -> DataFrame:
    """Filter by outcome (all, correct, wrong), true class (all, positive, negative) and confidence."""
    rows = predictions
    if outcome != "all":
        rows = rows.where(is_correct() if outcome == "correct" else ~is_correct())
    if sentiment != "all":
        rows = rows.where(F.col("label") == (1 if sentiment == "positive" else 0))
    return rows.where(min_confidence(min_conf)) if min_conf > 0.5 else rows


def explorer_cards(predictions: DataFrame, outcome: str = "all", sentiment: str = "all", min_conf: float = 0.5,
                   n: int = 8, seed: int = 42, short: int = 400) -> DataFrame:
    """``n`` random rows of :func:`explore` as shown to the reader, with the number of matches."""
    rows = explore(predictions, outcome, sentiment, min_conf)
    matches = rows.agg(F.count("*")).scalar()
    drawn = rows.orderBy(key_hash(F.col("doc_id"), seed, "order"), "doc_id").limit(n)
    return drawn.select(
        "doc_id", is_correct().alias("correct"),
        label_name(F.col("label")).alias("actual"), label_name(F.col("prediction")).alias("predicted"),
        "prob_positive", confidence(F.col("prediction"), F.col("prob_positive")).alias("confidence"),
        shorten(F.col("text"), short).alias("short_text")).withColumn("matches", matches)


def overview(reviews: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: reviews per class and in percent, accuracy and AUC of the predictions."""
    counts = reviews.agg(F.count("*").alias("total"), F.count_if(F.col("label") == 1).alias("positives"),
                         F.count_if(F.col("label") == 0).alias("negatives"))
    percent = lambda name: F.when(F.col("total") > 0, F.col(name) / F.col("total") * 100)
    return (counts.withColumn("positive_pct", percent("positives"))
            .withColumn("negative_pct", percent("negatives"))
            .withColumn("accuracy", positive_metrics(predictions).select("accuracy").scalar())
            .withColumn("auc", auc(predictions).scalar()))
