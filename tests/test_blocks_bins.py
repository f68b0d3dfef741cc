"""Automatic bins and the block dictionary of TF-IDF against plain Python."""

import contextlib
import math
import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reviewsent.operators import histograms, tfidf
from reviewsent.sources import shared


def ladder_bins(values, most):
    """Exact decimal steps, smallest first."""
    exact = [Decimal(repr(v)) for v in values]
    low, high = min(exact), max(exact)
    steps = sorted(Decimal(m).scaleb(e) for m in (1, 2, 5) for e in range(-15, 20)) if high > low else [Decimal(1)]
    for step in steps:
        first = math.floor(low / step)
        if math.floor(high / step) - first + 1 <= most:
            counts = Counter(math.floor(v / step) - first for v in exact)
            return [(i, float((first + i) * step), float((first + i + 1) * step), counts[i])
                    for i in range(math.floor(high / step) - first + 1)]


CASES = {
    "one": [3.5], "same": [7.0] * 5, "same negative": [-2.5] * 3, "zero": [0.0, 0.0], "negative": [-17.0, -3.0, -3.0, -0.5],
    "across zero": [-0.3, -0.1, 0.0, 0.1, 0.2, 0.3, 0.7], "tenths": [k / 10 for k in range(31)], "whole": [float(k) for k in range(40)],
    "small": [1e-7, 3e-7, 9.5e-7], "large": [1e12, 3e12, 2.5e12 + 1], "edges": [0.0, 50.0, 100.0], "wide": [-1e6, 0.001, 1e6],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("most", [2, 7, 50])
def test_automatic_bins(spark, name, most):
    values = CASES[name]
    df = spark.createDataFrame([(1, v) for v in values], "label int, v double")
    found = sorted((r["bin"], r["bin_start"], r["bin_end"], r["n"])
                   for r in histograms.histogram_automatic(df, F.col("v"), most, classes=(1,)).collect())
    assert found == ladder_bins(values, most)


def test_random_values_of_two_classes(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 1), round(rng.gauss(0, 40), 2)) for _ in range(2000)]
    odd = [(0, None), (1, float("nan")), (0, float("inf")), (1, float("-inf")), (5, 1e9), (None, 1e9)]
    df = spark.createDataFrame(rows + odd, "label int, v double").withColumn("bin", F.lit("clash"))
    found = histograms.histogram_automatic(df, F.col("v"), 30).collect()
    whole = ladder_bins([v for _, v in rows], 30)
    for label in (0, 1):
        first = whole[0][1]
        step = whole[0][2] - whole[0][1]
        counts = Counter(math.floor(v / step) for c, v in rows if c == label)
        assert sorted((r["bin"], r["bin_start"], r["n"]) for r in found if r["label"] == label) == [
            (i, a, counts[round(first / step) + i]) for i, a, _, _ in whole]


def test_one_bin_is_refused(spark):
    with pytest.raises(ValueError):
        histograms.histogram_automatic(spark.createDataFrame([(1, 1.0)], "label int, v double"), F.col("v"), 1)


def test_no_values(spark):
    df = spark.createDataFrame([(1, None), (0, float("nan"))], "label int, v double")
    assert histograms.histogram_automatic(df, F.col("v"), 10).collect() == []


def test_blocks_equal_long_form(spark):
    rows = [(i, ["hot", f"w{i % 97}"] + (["warm"] * (i % 3) if i % 3 else []) + ["it's", ""]) for i in range(2000)] + [(5000, []), (5001, None), (7, ["hot"])]
    df = spark.createDataFrame(rows, "doc_id long, terms array<string>").withColumn("tf", F.lit("clash")).withColumn("_n", F.lit("clash"))
    bag = lambda found: Counter(map(tuple, found.collect()))
    for parts in (1, 7):
        assert bag(tfidf.tfidf_in_blocks(df.repartition(parts), F.col("terms"))) == bag(tfidf.tfidf_long(df, F.col("terms")))
    assert tfidf.tfidf_in_blocks(df.where("doc_id > 9000"), F.col("terms")).collect() == []


def test_blocks_shuffle_distinct_terms_only(spark, monkeypatch):
    """Term frequencies are joined where they lie; only distinct terms per block are exchanged."""
    plans = []
    monkeypatch.setattr(tfidf, "stage_table", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString())
                        or shared.stage_table(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(i, ["a", f"w{i % 9}"]) for i in range(300)], "doc_id long, terms array<string>").repartition(5)
        tfidf.tfidf_in_blocks(df, F.col("terms"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plans[-1])
    assert len(exchanges) == 2 and "SortMergeJoin" in plans[-1] and "Bucketed: true" in plans[-1]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("term_frequencies")]


def test_blocks_fill_buckets_in_turn(spark, monkeypatch):
    """As many blocks as partitions, at most the buckets, and no bucket with two of them while another has none."""
    seen = []

    @contextlib.contextmanager
    def looked(df, name, column):
        with shared.bucketed_table(df, name, column) as table:
            seen.append({r[0]: r[1] for r in table.select(F.pmod(F.hash(column), F.lit(8)), column).distinct().collect()})
            yield table

    monkeypatch.setattr(tfidf, "bucketed_table", looked)
    with shared.setting(spark, "spark.sql.shuffle.partitions", "8"):
        for parts in (5, 8, 20):
            df = spark.range(4000).select(F.col("id").alias("doc_id"), F.array(F.lit("a"), F.concat(F.lit("w"), F.col("id") % 9)).alias("terms"))
            found = tfidf.tfidf_in_blocks(df.repartition(parts), F.col("terms"))
            assert found.count() == 8000 and found.where("word = 'a'").agg(F.min("df"), F.max("df")).first() == (4000, 4000)
            assert sorted(seen[-1]) == list(range(min(parts, 8))) and len(set(seen[-1].values())) == min(parts, 8)
