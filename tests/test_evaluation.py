"""Confusion, metrics, ROC, AUC, histograms, examples, model."""

import math
import random

import pytest
from pyspark.sql import functions as F

from reviewsent.operators import evaluation, explore, histograms, model
from reviewsent.operators.lexicon import lexicon_predictions, sentiment_lexicon
from reviewsent.plans import stages
from reviewsent.schema import CORRECT_NEGATIVE, CORRECT_POSITIVE, WRONG
from reviewsent.sources import files

SCHEMA = "doc_id long, label int, prediction double, prob_positive double, text string"


def frame(spark, pairs, text="x" * 100):
    rows = [(i, label, 1.0 if p > 0.5 else 0.0, p, text) for i, (label, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def four(spark):
    return frame(spark, [(0, 0.10), (0, 0.40), (1, 0.35), (1, 0.80)])


@pytest.fixture(scope="module")
def many(spark):
    rnd = random.Random(7)
    pairs = []
    for _ in range(3000):
        label = rnd.randrange(2)
        # scores pile up near 0 and 1, with ties
        pairs.append((label, round(rnd.betavariate(0.3 + label * 0.5, 0.5), 3)))
    return frame(spark, pairs).persist()


def brute_auc(pairs):
    pos = [p for label, p in pairs if label == 1]
    neg = [p for label, p in pairs if label == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_known_answers(four):
    assert tuple(evaluation.confusion_counts(four).first()) == (2, 0, 1, 1)
    positive = evaluation.positive_metrics(four).first()
    assert (positive["accuracy"], positive["precision"], positive["recall"]) == (0.75, 1.0, 0.5)
    assert math.isclose(positive["f1"], 2 / 3)
    weighted = evaluation.weighted_metrics(four).first()
    assert math.isclose(weighted["weighted_precision"], 5 / 6) and weighted["weighted_recall"] == 0.75
    assert math.isclose(weighted["weighted_f1"], 0.7333333333333333)
    assert evaluation.auc(four).first()["auc"] == 0.75
    points = evaluation.roc_curve(four).orderBy(F.col("threshold").desc_nulls_first()).collect()
    assert [(r["threshold"], r["fpr"], r["tpr"]) for r in points] == [
        (None, 0.0, 0.0), (0.8, 0.0, 0.5), (0.4, 0.5, 0.5), (0.35, 0.5, 1.0), (0.1, 1.0, 1.0)]


def test_cells_without_rows(spark):
    df = frame(spark, [(0, 0.1), (0, 0.2)])
    assert [(r["label"], r["prediction"], r["n"], r["pct"]) for r in evaluation.confusion(df).collect()] == [
        (0, 0.0, 2, 100.0), (0, 1.0, 0, 0.0), (1, 0.0, 0, 0.0), (1, 1.0, 0, 0.0)]
    row = evaluation.positive_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert [tuple(r) for r in evaluation.confusion_crosstab(df).collect()] == [(0, 2, 0)]


def test_auc_is_null_without_two_classes_or_two_scores(spark):
    assert evaluation.auc(frame(spark, [(1, 0.2), (1, 0.7)])).first()["auc"] is None
    assert evaluation.auc(frame(spark, [(1, 0.5), (0, 0.5)])).first()["auc"] is None
    assert evaluation.auc(frame(spark, [(1, 0.5)]).limit(0)).first()["auc"] is None
    assert evaluation.auc(frame(spark, [(1, 0.2), (1, 0.7)]), undefined=0.0).first()["auc"] == 0.0


@pytest.mark.parametrize("per_bucket", [1, 7, 50, 10**6])
def test_auc_equals_brute_force_for_any_buckets(many, per_bucket):
    pairs = [(r["label"], r["prob_positive"]) for r in many.collect()]
    assert math.isclose(evaluation.auc(many, per_bucket).first()["auc"], brute_auc(pairs), rel_tol=1e-12)


@pytest.mark.parametrize("drop", [False, True])
def test_roc_does_not_depend_on_buckets(many, drop):
    one = sorted(map(str, evaluation.roc_curve(many, drop).collect()))
    assert one == sorted(map(str, evaluation.roc_curve(many, drop, scores_per_range=10).collect()))


def test_odd_rows_are_left_out_and_counted(spark):
    rows = [(0, 0, 0.0, 0.1, "t"), (1, 1, 1.0, 0.9, "t"), (2, 0, 0.0, None, "t"), (3, 1, 1.0, float("nan"), "t"),
            (4, 7, 1.0, 0.8, "t"), (5, None, 0.0, 0.2, "t"), (6, 1, None, 0.3, "t")]
    df = spark.createDataFrame(rows, SCHEMA)
    table = {(r["metric"], r["scope"]): r["value"] for r in evaluation.metrics_table(df).collect()}
    assert table["left_out", "matrix"] == 3 and table["left_out", "auc"] == 2
    assert table["accuracy", "all"] == 1 and table["auc", "all"] == 1
    cells = sum(r["n"] for r in evaluation.confusion(df).collect())
    crosstab = evaluation.confusion_crosstab(df).collect()
    assert cells == sum(r["predicted_negative"] + r["predicted_positive"] for r in crosstab) == 4
    assert {r["label"] for r in crosstab} == {0, 1}
    assert evaluation.roc_curve(df).count() == 6


def test_dropped_points_lie_on_the_line(spark):
    df = frame(spark, [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4)])
    kept = [r["threshold"] for r in evaluation.roc_curve(df, True).orderBy(F.desc("threshold")).collect()]
    assert kept == [0.9, 0.7, 0.5, 0.4, None]


def test_reversed_scores_mirror_the_auc(many):
    reverse = many.withColumn("prob_positive", 1 - F.col("prob_positive"))
    total = evaluation.auc(many).first()["auc"] + evaluation.auc(reverse).first()["auc"]
    assert math.isclose(total, 1.0, rel_tol=1e-12)


def test_metrics_equal_mllib_evaluators(many):
    table = {(r["metric"], r["scope"]): r["value"] for r in evaluation.metrics_table(many).collect()}
    ml = model.evaluator_metrics(many)
    for ours, theirs in ((("accuracy", "all"), "accuracy"), (("precision", "weighted"), "weightedPrecision"),
                         (("recall", "weighted"), "weightedRecall"), (("f1", "weighted"), "f1"),
                         (("auc", "all"), "areaUnderROC")):
        assert math.isclose(table[ours], ml[theirs], rel_tol=1e-9)


def test_histogram_edges(spark):
    values = [0, 39, 40, 1999, 2000, 2001, None]
    df = spark.createDataFrame([(0, v) for v in values], "label int, v int")
    rows = histograms.histogram(df, F.col("v"), 0, 2000).collect()
    assert len(rows) == 100
    assert {(r["label"], r["bin"]): r["n"] for r in rows if r["n"]} == {(0, 0): 2, (0, 1): 1, (0, 49): 2}
    assert {r["bin"]: r["bin_start"] for r in rows if r["label"] == 1}[49] == 1960.0


def test_histogram_counts_every_value_in_the_bin_of_its_edges(many):
    values = [r[0] for r in many.select("prob_positive").collect()]
    rows = histograms.histogram_all(many, F.col("prob_positive"), 0, 1).collect()
    width = 1.0 / 50
    expected = [sum(i * width <= v and (v < (i + 1) * width or i == 49) for v in values) for i in range(50)]
    assert [r["n"] for r in sorted(rows, key=lambda r: r["bin"])] == expected


def test_own_range_histogram(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 3.0), (1, 3.0)], "label int, v double")
    rows = {(r["label"], r["bin"]): (r["bin_start"], r["n"])
            for r in histograms.histogram_own_range(df, F.col("v"), bins=4).collect()}
    assert rows[0, 0] == (1.0, 1) and rows[0, 3] == (1.75, 1) and rows[0, 1][1] == 0
    assert rows[1, 0][0] == 2.5 and rows[1, 2] == (3.0, 2)


def test_examples(spark):
    pairs = [(1, 0.9)] * 7 + [(0, 0.1)] * 3 + [(1, 0.1)] * 8 + [(1, 0.85), (0, 0.15)]
    rows = explore.example_table(frame(spark, pairs)).collect()
    kinds = [r["typ"] for r in rows]
    assert [kinds.count(k) for k in (CORRECT_POSITIVE, CORRECT_NEGATIVE, WRONG)] == [5, 3, 6]
    assert all(len(r["short_text"]) == 83 for r in rows)
    assert explore.example_table(frame(spark, pairs, text="short")).count() == 0
    assert explore.example_table(frame(spark, pairs), wrong=0).where(F.col("typ") == WRONG).count() == 0


def test_explorer_filters(spark):
    df = frame(spark, [(1, 0.9), (1, 0.6), (1, 0.2), (0, 0.1), (0, 0.45), (0, 0.7)])

    def ids(**kwargs):
        return [r["doc_id"] for r in explore.explore(df, **kwargs).orderBy("doc_id").collect()]

    assert ids() == [0, 1, 2, 3, 4, 5]
    assert ids(outcome="correct") == [0, 1, 3, 4] and ids(outcome="wrong") == [2, 5]
    assert ids(sentiment="positive") == [0, 1, 2] and ids(outcome="wrong", sentiment="negative") == [5]
    # 1 - 0.8 is a little less than 0.2 in floating point
    assert ids(min_conf=0.8) == [0, 3] and ids(min_conf=0.75) == [0, 2, 3]
    cards = explore.explorer_cards(df, n=4).collect()
    assert len(cards) == 4 and all(r["matches"] == 6 for r in cards)
    assert explore.explorer_cards(df, outcome="wrong", min_conf=0.95).count() == 0


def test_overview(spark, four):
    row = explore.overview(four, four).first()
    assert (row["total"], row["positives"], row["negative_pct"], row["accuracy"], row["auc"]) == (4, 2, 50.0, 0.75, 0.75)


def test_lexicon(spark):
    ratio = spark.createDataFrame([("good", 9.0), ("fine", 3.0), ("poor", 0.5), ("bad", 0.1)],
                                  "word string, ratio double").withColumn("pos", F.lit(1)).withColumn("neg", F.lit(1))
    positive, negative = sentiment_lexicon(ratio)
    assert (sorted(positive), sorted(negative)) == (["fine", "good"], ["bad", "poor"])
    assert sentiment_lexicon(ratio.limit(0)) == ([], [])
    df = spark.createDataFrame([(1, 1, "good good bad"), (2, 0, "bad"), (3, 0, "none")], "doc_id long, label int, text string")
    rows = lexicon_predictions(df, positive, negative).orderBy("doc_id").collect()
    assert [(r["prediction"], r["prob_positive"]) for r in rows] == [(1.0, 2 / 3), (0.0, 0.0), (0.0, 0.5)]


@pytest.fixture(scope="module")
def separable(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        label = i % 2
        sentiment = rnd.choice(["great", "love", "best"] if label else ["waste", "broken", "awful"])
        rows.append((i, label, f"{sentiment} {rnd.choice(['book', 'film', 'radio'])} {rnd.choice('abcd')}"))
    return spark.createDataFrame(rows, "doc_id long, label int, text string").persist()


@pytest.mark.parametrize("scope", ["train", "all"])
def test_model_learns_and_survives_saving(spark, separable, scope, tmp_path):
    trained, scored = stages.train_and_score(separable, idf_scope=scope)
    scored = scored.persist()
    assert set(scored.columns) == {"doc_id", "label", "prediction", "prob_positive", "text"}
    assert 30 < scored.count() < 90
    assert evaluation.positive_metrics(scored).first()["accuracy"] == 1.0
    assert scored.where((F.col("prob_positive") > 0.5) != (F.col("prediction") == 1)).count() == 0
    path = str(tmp_path / "model")
    model.save_model(trained, path)
    again = model.score(model.load_model(path), separable)
    joined = scored.join(again.select("doc_id", F.col("prob_positive").alias("p")), "doc_id")
    assert joined.where(F.abs(F.col("p") - F.col("prob_positive")) > 1e-12).count() == 0
    metrics = model.training_metrics(trained, separable).first()
    assert metrics["accuracy"] == 1.0 and metrics["auc"] == 1.0


def test_stored_probability_vectors_become_a_column(separable):
    trained = model.train(separable)
    vectors = trained.transform(separable).select("doc_id", "label", "prediction", "probability", "text")
    fixed = model.fix_probability(vectors)
    assert dict(fixed.dtypes)["prob_positive"] == "double" and "probability" not in fixed.columns
    both = fixed.join(model.score(trained, separable, "doc_id").withColumnRenamed("prob_positive", "p"), "doc_id")
    assert both.where(F.col("p") != F.col("prob_positive")).count() == 0
    some = vectors.withColumn("probability", F.when(F.col("doc_id") % 3 > 0, F.col("probability")))
    for missing in (None, 0.5):
        rows = model.fix_probability(some, missing).collect()
        assert all((r["prob_positive"] == missing) == (r["doc_id"] % 3 == 0) or r["prob_positive"] == 0.5 for r in rows)


def test_stages_from_raw_reviews_to_predictions(spark, folder, tmp_path):
    from reviewsent.sources.tables import raw_reviews
    cleaned = stages.write_cleaned(raw_reviews(spark, folder), str(tmp_path / "cleaned"))
    assert cleaned.columns == ["doc_id", "label", "summary", "text"]
    features = stages.write_features(cleaned, str(tmp_path / "features"))
    assert features.columns == ["doc_id", "label", "text", "filtered_tokens", "tfidf_features"]
    assert features.count() == cleaned.count()
    predictions = stages.write_predictions(cleaned, str(tmp_path / "predictions"), str(tmp_path / "model"))
    assert files.read_stage(spark, str(tmp_path / "predictions"), "prob_positive").count() == predictions.count()
    assert len(model.load_model(str(tmp_path / "model")).stages) == 5
