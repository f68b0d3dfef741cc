"""Confusion matrix, metrics, ROC curve and exact AUC of ``(label, prediction, prob_positive)``.

One rule for odd rows: a label or a prediction other than 0 and 1 (null too) belongs to no cell of
the matrix, in every form of it, and counts in no metric; a missing or NaN probability counts in
the matrix but not in ROC and AUC. ``metrics_table`` says how many rows each of them left out.
"""

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from reviewsent.sources.shared import stage_table


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def in_matrix() -> Column:
    return F.col("label").isin(0, 1) & F.col("prediction").isin(0.0, 1.0)


def confusion_counts(df: DataFrame) -> DataFrame:
    """One row ``tn, fp, fn, tp``."""
    label, prediction = F.col("label"), F.col("prediction")
    return df.agg(F.count_if((label == 0) & (prediction == 0)).alias("tn"),
                  F.count_if((label == 0) & (prediction == 1)).alias("fp"),
                  F.count_if((label == 1) & (prediction == 0)).alias("fn"),
                  F.count_if((label == 1) & (prediction == 1)).alias("tp"))


def confusion(df: DataFrame) -> DataFrame:
    """The four cells ``(label, prediction, n, pct)``; a cell without rows is 0."""
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cells = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(float(prediction)).alias("prediction"), F.col(cell).alias("n"))
        for cell, label, prediction in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))])
    rows = confusion_counts(df).select(total.alias("total"), F.inline(cells))
    return rows.select("label", "prediction", "n", (_share(F.col("n"), F.col("total")) * 100).alias("pct"))


def confusion_crosstab(df: DataFrame) -> DataFrame:
    """One row per label, one column per prediction."""
    table = df.where(in_matrix()).groupBy("label").pivot("prediction", [0.0, 1.0]).count().na.fill(0)
    return table.toDF("label", "predicted_negative", "predicted_positive")


def all_metrics(df: DataFrame) -> DataFrame:
    """One row: counts, accuracy, metrics of the positive class, and metrics weighted by class size."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp

    def f1(precision: str, recall: str) -> Column:
        return _share(2 * F.col(precision) * F.col(recall), F.col(precision) + F.col(recall))

    def weighted(metric: str) -> Column:
        return _share((tn + fp) * F.col(f"_{metric}") + (fn + tp) * F.col(metric), total)

    return (confusion_counts(df)
            .withColumns({"accuracy": _share(tn + tp, total),
                          "precision": _share(tp, tp + fp), "recall": _share(tp, tp + fn),
                          "_precision": _share(tn, tn + fn), "_recall": _share(tn, tn + fp)})
            .withColumns({"f1": f1("precision", "recall"), "_f1": f1("_precision", "_recall")})
            .withColumns({"weighted_precision": weighted("precision"), "weighted_recall": weighted("recall"),
                          "weighted_f1": weighted("f1")})
            .drop("_precision", "_recall", "_f1"))


def positive_metrics(df: DataFrame) -> DataFrame:
    """Counts, accuracy, and precision, recall and F1 of the positive class in one row."""
    return all_metrics(df).select("tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1")


def weighted_metrics(df: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 of both classes weighted by their rows."""
    return all_metrics(df).select("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")


def metrics_table(df: DataFrame) -> DataFrame:
    """``(metric, scope, value)``: accuracy and AUC of all rows, the rest positive and weighted, and
    the rows left out of the matrix and of the AUC."""
    def melt(frame: DataFrame, entries: list[tuple[str, str, str]]) -> DataFrame:
        return frame.select(F.inline(F.array(*[
            F.struct(F.lit(metric).alias("metric"), F.lit(scope).alias("scope"), F.col(column).alias("value"))
            for metric, scope, column in entries])))

    per_metric = [(m, scope, prefix + m) for scope, prefix in (("positive", ""), ("weighted", "weighted_"))
                  for m in ("precision", "recall", "f1")]
    outside = df.agg((F.count(F.lit(1)) - F.count_if(in_matrix())).cast("double").alias("matrix"),
                     (F.count(F.lit(1)) - F.count_if(has_score())).cast("double").alias("auc"))
    return (melt(all_metrics(df), [("accuracy", "all", "accuracy"), *per_metric])
            .unionByName(melt(auc(df), [("auc", "all", "auc")]))
            .unionByName(melt(outside, [("left_out", "matrix", "matrix"), ("left_out", "auc", "auc")])))


# Scores per window task: more distinct scores are cut into more ranges.
SCORES_PER_RANGE = 200_000


def has_score() -> Column:
    """Rows that ROC and AUC rest on: a missing probability and NaN are left out."""
    return F.col("prob_positive").isNotNull() & ~F.isnan("prob_positive")


def _score_groups(df: DataFrame) -> tuple[DataFrame, Row]:
    """Positives and negatives per distinct score, written because it is read several times; totals."""
    groups = (df.where(has_score()).groupBy(F.col("prob_positive").alias("threshold"))
              .agg(F.count_if(F.col("label") == 1).alias("positives"),
                   F.count_if(F.col("label") == 0).alias("negatives")))
    groups = stage_table(groups, "score_groups")
    return groups, groups.agg(F.count("*").alias("scores"), F.max("threshold").alias("highest"),
                              F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
                              F.coalesce(F.sum("negatives"), F.lit(0)).alias("negatives")).first()


def _running(groups: DataFrame, scores: int, scores_per_range: int) -> DataFrame:
    """Add ``tp`` and ``fp``, the counts at or above each score, and the next lower score's counts.

    Distinct scores can be as many as rows, so no window runs over all of them. They are
    range-partitioned, with as many ranges as keep each at about ``scores_per_range``, and
    written with the number of their range. Totals per range (one row each) give every range its start;
    inside a range a window adds up the rest. Any cut gives the same result.
    """
    ranges = max(1, -(-scores // scores_per_range))
    ranged = stage_table(groups.repartitionByRange(ranges, "threshold")
                         .withColumn("_range", F.spark_partition_id()), "score_ranges")

    # windows over one row per range
    above = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.orderBy(F.col("_range").desc())
    # single longs, not structs: the totals stay a hash aggregate
    starts = (ranged.groupBy("_range").agg(
        F.sum("positives").alias("_p"), F.sum("negatives").alias("_n"),
        F.max_by("positives", "threshold").alias("_first_p"), F.max_by("negatives", "threshold").alias("_first_n"))
        .select("_range", F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_tp_above"),
                F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_fp_above"),
                F.lead("_first_p").over(below).alias("_next_p"), F.lead("_first_n").over(below).alias("_next_n")))

    inside = Window.partitionBy("_range").orderBy(F.col("threshold").desc())
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(starts, "_range").select(
        "threshold", "positives", "negatives",
        (F.col("_tp_above") + F.sum("positives").over(upto)).alias("tp"),
        (F.col("_fp_above") + F.sum("negatives").over(upto)).alias("fp"),
        F.coalesce(F.lead("positives").over(inside), F.col("_next_p")).alias("next_positives"),
        F.coalesce(F.lead("negatives").over(inside), F.col("_next_n")).alias("next_negatives"))


def roc_curve(df: DataFrame, drop_collinear: bool = False,
              scores_per_range: int = SCORES_PER_RANGE) -> DataFrame:
    """``(threshold, tp, fp, tpr, fpr)``: one point per distinct score and the origin.

    The origin has a null threshold. ``drop_collinear`` drops the points that lie on the
    line between their neighbours, but never the first or last score.
    """
    groups, totals = _score_groups(df)
    points = _running(groups, totals["scores"], scores_per_range)
    if drop_collinear:
        corner = (F.col("next_positives").isNull() | (F.col("next_positives") != F.col("positives"))
                  | (F.col("next_negatives") != F.col("negatives")))
        points = points.where(corner | (F.col("threshold") == F.lit(totals["highest"]).cast("double")))
    # an aggregate without keys always has one row
    origin = groups.agg(F.lit(None).cast("double").alias("threshold"),
                        F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"))

    def rate(count: str, total: int) -> Column:
        return F.col(count) / total if total else F.lit(None).cast("double")

    return (points.select("threshold", "tp", "fp").unionByName(origin)
            .withColumn("tpr", rate("tp", totals["positives"])).withColumn("fpr", rate("fp", totals["negatives"])))


def auc(df: DataFrame, scores_per_range: int = SCORES_PER_RANGE, undefined: float | None = None) -> DataFrame:
    """Exact area under the ROC curve by trapezoids over tied scores.

    ``undefined`` (default: null) if a class has no row, or if all scores are equal.
    """
    groups, totals = _score_groups(df)
    points = _running(groups, totals["scores"], scores_per_range)
    area = F.sum(F.col("negatives") * (F.col("tp") - F.col("positives") / 2))
    pairs = float(totals["positives"]) * totals["negatives"]
    defined = pairs > 0 and totals["scores"] > 1
    return points.agg((area / pairs if defined else F.lit(undefined).cast("double")).alias("auc"))
