"""Exact medians of values that are as distinct as the rows, by distributed selection.

Pivots from a mergeable quantile sketch enclose the wanted rank, the rows around them are counted
exactly, and only the part that holds the rank is looked at again. The sketch decides how fast the
rows shrink, the counts decide the result, so its error costs time at most. No task holds a class:
what is shuffled is one sketch or one row of counts per class and task.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reviewsent.sources.shared import stage_table

#: Splitters that a sketch is asked for, and its accuracy: ranks are off by at most a 10,000th of the rows.
SPLITTERS, ACCURACY = 256, 10_000


def _same(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """``left`` with the columns of ``right`` of the same class; null is a class."""
    right = right.withColumnRenamed(by, "_class")
    return left.join(right, left[by].eqNullSafe(right["_class"])).drop("_class")


def _pivots(rows: DataFrame, wanted: DataFrame, by: str) -> DataFrame:
    """``(by, rank, low, high)``: two values around the wanted rank, as the sketch sees it."""
    grid = F.array(*[F.lit(i / SPLITTERS) for i in range(SPLITTERS + 1)])
    sketch = rows.groupBy(by).agg(F.count("*").alias("n"), F.percentile_approx("value", grid, F.lit(ACCURACY)).alias("grid"))
    at = F.floor(F.col("rank") * SPLITTERS / F.col("n")).cast("int") + 1
    return _same(sketch, wanted, by).select(
        by, "rank", F.element_at("grid", F.greatest(F.lit(1), at - 1)).alias("low"),
        F.element_at("grid", F.least(F.lit(SPLITTERS + 1), at + 2)).alias("high"))


def _parts(rows: DataFrame, pivots: DataFrame, by: str) -> DataFrame:
    """Per class the part that holds the rank (0 below, 1 at low, 2 between, 3 at high, 4 above) and the rank within it."""
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    counts = _same(rows, pivots, by).groupBy(by, "rank", "low", "high").agg(
        F.count_if(value < low).alias("c1"), F.count_if(value <= low).alias("c2"),
        F.count_if((value <= low) | (value < high)).alias("c3"), F.count_if(value <= high).alias("c4"))
    ends = [F.col(f"c{i}") for i in range(1, 5)]
    part = reduce(lambda rest, i: F.when(F.col("rank") < ends[i], i).otherwise(rest), reversed(range(4)), F.lit(4))
    before = F.when(F.col("part") == 0, 0)
    for i, end in enumerate(ends):
        before = before.when(F.col("part") == i + 1, end)
    return counts.withColumn("part", part).select(by, "low", "high", "part", (F.col("rank") - before).alias("rank"))


def select_rank(rows: DataFrame, wanted: DataFrame, by: str) -> DataFrame:
    """``(by, value)``: the value of 0-based ``rank`` per class of ``wanted``, out of written ``(by, value)`` rows.

    A round keeps some hundredth of the rows, written for the next one, so a trillion rows take about six. Each
    round drops at least its pivots, whatever the sketch says, so it ends.
    """
    found = []
    while not wanted.isEmpty():
        parts = stage_table(_parts(rows, stage_table(_pivots(rows, wanted, by), "pivots"), by), "parts")
        at_pivot = F.col("part").isin(1, 3)
        found.append(parts.where(at_pivot).select(by, F.when(F.col("part") == 1, F.col("low")).otherwise(F.col("high")).alias("value")))
        value, part = F.col("value"), F.col("part")
        inside = (F.when(part == 0, value < F.col("low")).when(part == 4, value > F.col("high"))
                  .otherwise((value > F.col("low")) & (value < F.col("high"))))
        wanted = parts.where(~at_pivot)
        rows = stage_table(_same(rows, wanted, by).where(inside).select(by, "value"), "inside")
        wanted = wanted.select(by, "rank")
    return reduce(DataFrame.unionByName, found) if found else rows.select(by, "value").limit(0)


def exact_median(df: DataFrame, by: str, value: Column) -> DataFrame:
    """``(by, median)``: exact median of a double per class, the mean of both middle values for an even count.

    Null values are left out, and so is a class that has nothing else. NaN counts as the largest value, as Spark sorts
    it; null is a class of its own.
    """
    rows = stage_table(df.select(by, value.cast("double").alias("value")).where(F.col("value").isNotNull()), "values")
    wanted = stage_table(rows.groupBy(by).agg(F.expr("(count(*) - 1) div 2").alias("rank")), "ranks")
    lower = stage_table(select_rank(rows, wanted, by).withColumnRenamed("value", "lower"), "lower_middle")
    both = _same(rows, lower, by).groupBy(by, "lower").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") <= F.col("lower")).alias("reached"),
        F.min(F.when(F.col("value") > F.col("lower"), F.col("value"))).alias("following"))
    upper = F.when(F.col("reached") > F.floor(F.col("n") / 2), F.col("lower")).otherwise(F.col("following"))
    middle = F.when(upper == F.col("lower"), F.col("lower")).otherwise(F.col("lower") + (upper - F.col("lower")) * 0.5)
    return both.select(by, middle.alias("median"))
