"""Cleaning steps, profile, samples, splits, balancing."""

from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from reviewsent.operators import cleaning, profile, sampling

RAW = [
    (1, 1, "Bad", "It is BAD"), (2, 1, "Bad", "It is BAD"), (3, 2, "Good", "so <b>good</b>!"),
    (4, 2, "good!", "So good"), (5, 2, None, "no summary"), (6, None, "x", "no score"),
    (7, 3, "x", "unknown score"), (8, 2, "short", "ok"), (9, 1, "!!", "an empty clean summary"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, "doc_id long, Score int, Summary string, Text string")


def test_clean_reviews(raw):
    rows = {r["doc_id"]: tuple(r) for r in cleaning.clean_reviews(raw).collect()}
    assert rows == {1: (1, 0, "bad", "it is bad"), 3: (3, 1, "good", "so good"), 4: (4, 1, "good", "so good"),
                    9: (9, 0, "", "an empty clean summary")}


def test_duplicates_after_cleaning(raw):
    rows = cleaning.clean_reviews(raw, dedupe_on="clean").collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 3, 9]


def test_null_drop_can_be_restricted(raw):
    kept = cleaning.clean_reviews(raw, dropna_columns=["Score", "Text"])
    assert 5 in [r["doc_id"] for r in kept.collect()]


def test_cleaning_report_equals_counts_of_the_steps(raw):
    steps = {r["step"]: (r["rows_in"], r["rows_out"], r["removed"]) for r in cleaning.cleaning_report(raw).collect()}
    assert steps == {"nulls": (9, 7, 2), "duplicates": (7, 6, 1), "unknown_scores": (6, 5, 1),
                     "short_texts": (5, 4, 1)}
    assert cleaning.clean_reviews(raw).count() == 4
    assert [r["rows_in"] for r in cleaning.cleaning_report(raw.limit(0)).collect()] == [0, 0, 0, 0]


def test_profile(raw):
    nulls = {r["column_name"]: (r["nulls"], r["pct"]) for r in profile.null_profile(raw).collect()}
    assert nulls["Score"] == (1, 1 / 9 * 100) and nulls["doc_id"] == (0, 0.0)
    assert tuple(profile.duplicate_report(raw, cleaning.RAW_COLUMNS).first()) == (9, 8, 1)
    assert tuple(profile.shape(raw).first()) == (9, 4)
    balance = profile.class_balance(raw.where("Score in (1, 2)")).first()
    assert balance["ratio"] == 4 / 3 and balance["imbalanced"] is False
    shares = {r["Score"]: r["pct"] for r in profile.class_distribution(raw).collect()}
    assert shares[2] == 4 / 9 * 100 and abs(sum(shares.values()) - 100) < 1e-9


def test_median_of_even_and_odd_groups(spark):
    df = spark.createDataFrame([(0, "a"), (0, "abc"), (1, "ab"), (1, "ab"), (1, "abcde")], "label int, t string")
    rows = {r["label"]: r["median_len"] for r in profile.median_by(df, "label", F.length("t")).collect()}
    assert rows == {0: 2.0, 1: 2.0}


@pytest.mark.parametrize("sizes", [(50, 7), (7, 50), (20, 20), (300, 1)])
def test_undersample_keeps_the_lowest_hashes(spark, sizes):
    rows = [(label * 1000 + i, label) for label, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    expected = set()
    for label in (0, 1):
        ids = sorted((md5(f"42:balance:{i}".encode()).hexdigest(), i) for i, l in rows if l == label)
        expected |= {i for _, i in ids[:min(sizes)]}
    kept = sampling.undersample(df).collect()
    assert {r["doc_id"] for r in kept} == expected
    assert Counter(r["label"] for r in kept) == {0: min(sizes), 1: min(sizes)}


def test_undersample_ranks_inside_one_hash_prefix(spark):
    # equal keys: one hash prefix holds a whole class
    df = spark.createDataFrame([(5, 0)] * 4 + [(i, 1) for i in range(9)], "doc_id long, label int")
    assert sampling.undersample(df).where("label = 1").count() == 4


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id").withColumn("label", (F.col("doc_id") % 5 == 0).cast("int"))
    results = []
    for n in (1, 3, 16):
        part = df.repartition(n)
        results.append((
            {r[0] for r in sampling.hash_sample(part, 0.1).select("doc_id").collect()},
            {r[0] for r in sampling.hash_sample_rows(part, 300).select("doc_id").collect()},
            [r[0] for r in sampling.random_rows(part, 5).select("doc_id").collect()],
            {r[0] for r in sampling.undersample(part).select("doc_id").collect()},
            {tuple(r) for r in sampling.with_split(part).select("doc_id", "split").collect()}))
    assert results[0] == results[1] == results[2]
    assert 140 < len(results[0][0]) < 260 and len(results[0][2]) == 5 and len(results[0][3]) == 800


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    train, test = sampling.hash_split(df)
    assert train.join(test, "doc_id").count() == 0 and train.count() + test.count() == 1000
    a, b = sampling.random_split(df)
    assert a.count() + b.count() == 1000 and a.join(b, "doc_id").count() == 0


def test_sample_sizes_above_the_table(spark):
    df = spark.range(10).withColumnRenamed("id", "doc_id")
    assert sampling.bernoulli_sample(df, 400).count() == 10
    assert sampling.hash_sample_rows(df, 400).count() == 10
    assert sampling.bernoulli_sample(df.limit(0), 5).count() == 0


def test_sample_balance_and_split_with_one_seed(spark):
    """Each class has a fifth of its rows in test, whatever was sampled and balanced before."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    for rows in (df, sampling.hash_sample(df, 0.25), sampling.undersample(df),
                 sampling.undersample(sampling.hash_sample(df, 0.25))):
        found = {(r["split"], r["label"]): r["n"] for r in sampling.split_report(rows).collect()}
        for label in (0, 1):
            n = found["train", label] + found["test", label]
            assert abs(found["test", label] - 0.2 * n) <= 3 * (n * 0.16) ** 0.5


def test_null_keys_and_unknown_labels(spark):
    rows = [(None, 0), (1, 0), (2, 1), (3, 1), (4, 1), (5, 7), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    assert Counter(r["label"] for r in sampling.undersample(df).collect()) == {0: 2, 1: 2}
    assert {r["label"] for r in sampling.undersample_bernoulli(df).collect()} <= {0, 1}


def test_bernoulli_undersampling_is_near_balance(spark):
    df = spark.range(4000).select((F.col("id") % 4 == 0).cast("int").alias("label"))
    n = {r["label"]: r["count"] for r in sampling.undersample_bernoulli(df).groupBy("label").count().collect()}
    assert n[1] == 1000 and 850 < n[0] < 1150
