"""Medians by selection against a sort."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from reviewsent.operators import selection


def brute(rows):
    classes = {}
    for label, value in rows:
        if value is not None:
            classes.setdefault(label, []).append(value)
    return {label: statistics.median(values) for label, values in classes.items()}


def medians(spark, rows):
    df = spark.createDataFrame(rows, "label string, x double").repartition(5)
    return {r["label"]: r["median"] for r in selection.exact_median(df, "label", F.col("x")).collect()}


def test_distinct_values_and_ties(spark):
    rng = random.Random(3)
    rows = [("distinct", rng.gauss(0, 1e6)) for _ in range(30_001)] + [("even", rng.expovariate(1e-9)) for _ in range(5_000)]
    rows += [("ties", float(rng.choice([1, 2, 2, 3]))) for _ in range(4_000)] + [("hot", 7.0)] * 4_999 + [("hot", rng.random()) for _ in range(5_000)]
    rows += [("steep", 2.0 ** rng.randint(-1000, 1000)) for _ in range(3_000)]
    rows += [("one", -3.5), ("two", 1.0), ("two", 4.0), ("nulls", None), (None, 5.0), (None, 6.0), (None, None), ("zero", 0.0), ("zero", -0.0)]
    rng.shuffle(rows)
    found = medians(spark, rows)
    assert found == pytest.approx(brute(rows), rel=1e-15)
    assert "nulls" not in found and found[None] == 5.5


def test_wrong_pivots_cost_rounds_only(spark, monkeypatch):
    """With a sketch that is wrong by far the result is the same."""
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.random()) for _ in range(300)]

    def smallest(rows, wanted, by):
        ends = rows.groupBy(by).agg(F.expr("percentile(value, 0.1, 1)").alias("low"))
        return selection._same(ends, wanted, by).select(by, "rank", "low", F.col("low").alias("high"))
    monkeypatch.setattr(selection, "_pivots", smallest)
    assert medians(spark, rows) == pytest.approx(brute(rows), rel=1e-15)


def test_not_a_number_is_largest_and_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    found = medians(spark, [("a", 1.0), ("a", nan), ("a", inf), ("b", -inf), ("b", nan), ("b", 2.0), ("c", nan)])
    assert found["a"] == inf and found["b"] == 2.0 and found["c"] != found["c"]
    empty = spark.createDataFrame([], "label string, x double")
    assert selection.exact_median(empty, "label", F.col("x")).collect() == []
