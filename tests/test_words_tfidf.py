"""Word counts, ratios and TF-IDF."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizer, IDF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewsent.operators import tfidf, words
from reviewsent.operators.model import add_features, feature_model, vector_shape


@pytest.fixture
def labelled_words(spark):
    rows = [("great", 90, 9), ("waste", 2, 59), ("even", 25, 25), ("superb", 70, 0)]
    data = [(1, w) for w, pos, _ in rows for _ in range(pos)] + [(0, w) for w, _, neg in rows for _ in range(neg)]
    return spark.createDataFrame(data, "label int, word string")


def test_word_ratio(labelled_words):
    rows = {r["word"]: (r["pos"], r["neg"], r["ratio"]) for r in words.word_ratio(labelled_words).collect()}
    assert rows == {"great": (90, 9, 9.0), "waste": (2, 59, 2 / 60)}
    joined = words.word_ratio_joined(labelled_words)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, words.word_ratio(labelled_words).collect()))
    one_sided = words.word_ratio(labelled_words, keep_one_sided=True).collect()
    assert {r["word"] for r in one_sided} == {"great", "waste", "superb"}


def test_top_ratio_both_ways(labelled_words):
    rows = words.top_ratio(words.word_ratio(labelled_words), 1).collect()
    assert {(r["direction"], r["word"], r["position"]) for r in rows} == {
        ("positive", "great", 1), ("negative", "waste", 1)}


def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (1, "c"), (0, "z")], "label int, word string")
    rows = words.top_words(df, k=2).orderBy("label", "position").collect()
    assert [tuple(r) for r in rows] == [(0, "z", 1, 1), (1, "c", 2, 1), (1, "a", 1, 2)]
    maps = {r["label"]: r["frequencies"] for r in words.word_count_map(words.top_words(df, k=2)).collect()}
    assert maps == {0: {"z": 1}, 1: {"c": 2, "a": 1}}


def test_null_texts_are_skipped(spark):
    df = spark.createDataFrame([(1, None), (1, "good book")], "label int, text string")
    assert words.word_rows(df, "label").count() == 2
    assert words.split_word_rows(df, "label").count() == 2
    assert words.token_stats(df).first()["max_tokens"] == 2


def test_term_frequencies_equal_a_counter(spark):
    rnd = random.Random(1)
    docs = [(i, [rnd.choice("abcdefgh") for _ in range(rnd.randrange(0, 40))]) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, terms array<string>")
    rows = tfidf.term_frequencies(df, F.col("terms")).collect()
    expected = {(i, w): n for i, t in docs for w, n in Counter(t).items()}
    assert {(r["doc_id"], r["word"]): r["tf"] for r in rows} == expected and len(rows) == len(expected)


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, ["a", "b", "b"]), (2, ["a"]), (3, ["c"])], "doc_id long, terms array<string>")
    rows = {(r["doc_id"], r["word"]): r for r in tfidf.tfidf_long(df, F.col("terms")).collect()}
    assert math.isclose(rows[2, "a"]["idf"], math.log(4 / 3)) and math.isclose(rows[3, "c"]["idf"], math.log(2))
    assert math.isclose(rows[1, "b"]["tfidf"], 2 * math.log(2))


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_tfidf_for_either_join(spark, threshold):
    # one term in every document, one in a third of them
    rows = [(i, ["hot", f"w{i % 97}"] + (["warm"] if i % 3 == 0 else [])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, terms array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        result = tfidf.tfidf_long(df, F.col("terms"))
        join = "BroadcastHashJoin" if threshold != "-1" else "SortMergeJoin"
        assert join in result._jdf.queryExecution().executedPlan().toString()
        found = {(r["doc_id"], r["word"]): r["df"] for r in result.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    frequency = {"hot": 3000, "warm": 1000} | {f"w{k}": len(range(k, 3000, 97)) for k in range(97)}
    assert found == {(i, w): frequency[w] for i, words in rows for w in words}


def test_document_frequency(spark):
    df = spark.createDataFrame([(1, "good bad the bad"), (2, "good")], "doc_id long, text string")
    assert {tuple(r) for r in tfidf.document_frequency(df).collect()} == {("good", 2), ("bad", 1)}


def test_long_form_equals_mllib_idf(spark):
    texts = [(1, "good book good plot"), (2, "bad book"), (3, "plot"), (4, "")]
    df = words.with_tokens(spark.createDataFrame(texts, "doc_id long, text string"))
    vectorizer = CountVectorizer(inputCol="filtered_tokens", outputCol="tf").fit(df)
    counted = vectorizer.transform(df)
    weighted = IDF(inputCol="tf", outputCol="w").fit(counted).transform(counted)
    expected = {(r["doc_id"], vectorizer.vocabulary[i]): v
                for r in weighted.select("doc_id", vector_to_array("w").alias("v")).collect()
                for i, v in enumerate(r["v"]) if v}
    ours = {(r["doc_id"], r["word"]): r["tfidf"] for r in tfidf.tfidf_long(df, F.col("filtered_tokens")).collect()}
    expected.update({k: 0.0 for k in ours if k not in expected})
    assert ours.keys() >= {k for k, v in expected.items() if v}
    assert all(math.isclose(ours[k], expected[k], abs_tol=1e-12) for k in ours)


def test_hashing_buckets_and_vector_shape(spark):
    buckets = {"great": 750, "love": 6240, "book": 393, "product": 447, "money": 6103}
    df = spark.createDataFrame([(i, w) for i, w in enumerate(buckets)] + [(9, "great great book")],
                               "doc_id long, text string")
    features = add_features(feature_model(df), df)
    dense = features.select("doc_id", F.unwrap_udt("tfidf_features")["indices"].alias("i")).collect()
    assert {r["doc_id"]: r["i"] for r in dense if r["doc_id"] < 9} == {
        i: [b] for i, b in enumerate(buckets.values())}
    shape = features.where("doc_id = 9").select(*vector_shape("tfidf_features")).first()
    assert tuple(shape) == (10_000, 2)


def test_results_do_not_depend_on_partitions(spark):
    rows = [(i, i % 2, f"word{i % 7} word{i % 3} good") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, label int, text string")
    outs = []
    for n in (1, 3, 16):
        part = df.repartition(n)
        outs.append((sorted(map(tuple, words.top_words(words.word_rows(part, "label"), k=3).collect())),
                     sorted(map(tuple, tfidf.tfidf_long(part, tfidf.filtered_tokens()).collect()))))
    assert outs[0] == outs[1] == outs[2]


@pytest.mark.parametrize("buckets", [2, 64, 1 << 16])
def test_top_words_by_buckets(spark, buckets):
    """Frequent words, ties at the last place, a flat class, a class of fewer words than asked, a null class."""
    rng = random.Random(9)
    rows = [("zipf", f"w{int(rng.paretovariate(0.7))}") for _ in range(20_000)] + [("hot", "one")] * 5_000
    rows += [("flat", f"f{i}") for i in range(500)] * 3 + [("few", w) for w in "aab"] + [(None, w) for w in "xyyzzz" * 3]
    rows += [("hidden", f"h{i % 40}") for i in range(4_000)] + [("hidden", f"r{i}") for i in range(9_000)]
    df = spark.createDataFrame(rows, "label string, word string").repartition(6)
    expected = words.top_words(df, k=15).orderBy("label", "position").collect()
    assert words.top_words_bounded(df, k=15, buckets=buckets).select("label", "word", "n", "position").orderBy(
        "label", "position").collect() == expected
    assert words.top_words_bounded(df.limit(0), k=15, buckets=buckets).collect() == []
