"""Co-occurrence, information and vectors against plain Python and numpy."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewsent.operators import similarity
from reviewsent.sources import shared
from reviewsent.sources.shared import stage_table

TEXTS = ["good plot good book", "bad plot", "good", "", None, "x x x", "a the of", "good book plot the bad book"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n", F.lit("clash"))


def counted(texts, window):
    pairs, totals = Counter(), Counter()
    for text in texts:
        words = [w for w in (text or "").split(" ") if w not in ("the", "of", "a")] if text is not None else []
        for i, word in enumerate(words):
            for j in range(max(0, i - window), min(len(words), i + window + 1)):
                if i != j:
                    pairs[word, words[j]] += 1
                    totals[word] += 1
    return pairs, totals


@pytest.mark.parametrize("window", [1, 2, 5])
def test_pairs_and_totals(spark, window):
    df = frame(spark, TEXTS)
    pairs, totals = counted(TEXTS, window)
    found = similarity.cooccurrence(df, window, min_pairs=1)
    assert {(r["word"], r["other"]): r["n"] for r in found.collect()} == pairs and found.count() == len(pairs)
    assert {r["word"]: r["total"] for r in similarity.neighbour_counts(df, window).collect()} == totals
    assert similarity.cooccurrence(df, window, min_pairs=3).count() == sum(n >= 3 for n in pairs.values())


@pytest.mark.parametrize("most", [0, 1 << 26])
def test_rare_words_are_left_out_before_the_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(similarity, "COLUMN_BYTES", most)
    df = frame(spark, clusters() + ["rare film0 once film1 only film0"] * 2)
    totals = stage_table(similarity.neighbour_counts(df), "totals")
    bag = lambda rows: sorted(map(tuple, rows.collect()))
    found = similarity.cooccurrence(df, totals=totals)
    assert ("LeftSemi" in found._jdf.queryExecution().executedPlan().toString()) == (most > 0)
    assert bag(found) == bag(similarity.cooccurrence(df))


def test_a_hot_pair_and_repeated_texts(spark):
    df = frame(spark, ["hot pair " * 50] * 40).withColumn("text", F.trim("text"))
    pairs, _ = counted([("hot pair " * 50).strip()] * 40, 2)
    assert {(r["word"], r["other"]): r["n"] for r in similarity.cooccurrence(df).collect()} == pairs


def clusters(seed=3):
    """Texts of three topics; words of a topic stand together."""
    rng = random.Random(seed)
    topics = [[f"{name}{i}" for i in range(6)] for name in ("film", "kitchen", "garden")]
    return [" ".join(rng.choice(topics[k % 3] if rng.random() < 0.9 else rng.choice(topics)) for _ in range(30)) for k in range(240)]


@pytest.fixture(scope="module")
def matrix(spark):
    df = frame(spark, clusters())
    totals = stage_table(similarity.neighbour_counts(df), "totals")
    return stage_table(similarity.information(stage_table(similarity.cooccurrence(df), "pairs"), totals), "information")


def dense(matrix):
    rows = matrix.collect()
    words = sorted({r["word"] for r in rows})
    place = {w: i for i, w in enumerate(words)}
    out = np.zeros((len(words), len(words)))
    for r in rows:
        out[place[r["word"]], place[r["other"]]] = r["information"]
    return words, out


@pytest.mark.parametrize("most", [0, 1 << 26])
def test_information(spark, monkeypatch, most):
    monkeypatch.setattr(similarity, "COLUMN_BYTES", most)
    df = frame(spark, clusters())
    totals = stage_table(similarity.neighbour_counts(df), "totals")
    matrix = similarity.information(stage_table(similarity.cooccurrence(df), "pairs"), totals)
    pairs, totals = counted(clusters(), 2)
    whole = sum(totals.values())
    expected = {k: math.log(n * whole / totals[k[0]] / totals[k[1]]) for k, n in pairs.items() if n >= 5}
    found = {(r["word"], r["other"]): r["information"] for r in matrix.collect()}
    assert found.keys() == {k for k, v in expected.items() if v > 0}
    assert all(math.isclose(v, expected[k], abs_tol=1e-12) for k, v in found.items())


def cosines(vectors):
    normed = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return normed @ normed.T


@pytest.mark.parametrize("dimensions,rounds,allowed,most", [(18, 2, 1e-9, 0), (18, 2, 1e-9, 1 << 26), (3, 12, 1e-4, 1 << 26)])
def test_vectors_are_those_of_numpy(spark, matrix, monkeypatch, dimensions, rounds, allowed, most):
    monkeypatch.setattr(similarity, "COLUMN_BYTES", most)  # with broadcasts and without
    words, whole = dense(matrix)
    assert np.allclose(whole, whole.T)
    values, columns = np.linalg.eigh(whole)
    kept = np.argsort(-np.abs(values))[:dimensions]
    expected = cosines(columns[:, kept] * np.sqrt(np.abs(values[kept])))
    found = {r["word"]: r["vector"] for r in similarity.word_vectors(matrix, dimensions, rounds).collect()}
    ours = np.array([found[w] for w in words])
    assert ours.shape == (len(words), dimensions)
    assert np.abs(cosines(ours) - expected).max() < allowed


def test_nearest_words_are_of_the_same_topic(matrix):
    vectors = stage_table(similarity.word_vectors(matrix, 3, 12), "vectors")
    asked = ["film0", "garden5", "it's \\ unknown"]
    rows = similarity.similar_words(vectors, asked, k=5).collect()
    assert len(rows) == 10 and {r["word"] for r in rows} == set(asked[:2])
    assert all(r["similar"][:4] == r["word"][:4] for r in rows)
    for word in asked[:2]:
        ordered = sorted((r for r in rows if r["word"] == word), key=lambda r: r["position"])
        assert [r["position"] for r in ordered] == [1, 2, 3, 4, 5]
        assert [r["cosine"] for r in ordered] == sorted((r["cosine"] for r in ordered), reverse=True)


def test_few_words_and_none(spark):
    matrix = spark.createDataFrame([("a", "b", 2.0), ("b", "a", 2.0)], "word string, other string, information double")
    vectors = similarity.word_vectors(matrix, dimensions=5)
    assert {len(r["vector"]) for r in vectors.collect()} <= {1, 2}
    nothing = similarity.word_vectors(matrix.where("information > 9"), dimensions=4)
    assert nothing.collect() == [] and similarity.similar_words(nothing, ["a"]).collect() == []
    assert similarity.similar_words(vectors, []).collect() == []
    with pytest.raises(ValueError):
        similarity.similar_words(vectors, ["a"] * 1001)


def test_sums_of_a_product_need_no_shuffle(spark, matrix):
    with shared.bucketed_table(matrix.repartition("word"), "matrix", "word") as rows:
        vectors = stage_table(rows.select("word").distinct().select("word", similarity._signs(4, 1).alias("vector")), "signs")
        text = similarity.multiplied(rows, vectors, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_pairs_are_merged_before_the_shuffle(spark, folder):
    from reviewsent.plans.catalog import cooccurrence
    text = cooccurrence(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text and "hashpartitioning(_words" not in text
