"""Loss, gradient and loss history against numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation, functions as F

from reviewsent.operators import model


def numpy_loss(x, y, intercept, weights, reg=model.REG_PARAM):
    deviation = x.std(0, ddof=1)
    scaled = weights * deviation
    margin = x @ weights + intercept
    p = 1 / (1 + np.exp(-margin))
    loss = np.logaddexp(0, np.where(y == 1, -margin, margin)).mean() + reg / 2 * (scaled ** 2).sum()
    by_weight = np.where(deviation > 0, ((p - y)[:, None] * x).mean(0) / np.where(deviation > 0, deviation, 1) + reg * scaled, 0)
    return loss, np.sqrt((p - y).mean() ** 2 + (by_weight ** 2).sum())


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.poisson(0.7, (300, 12)).astype(float) * rng.uniform(0.1, 3, 12)
    x[:, 5] = 0  # a feature that no row has
    x[7] = 0  # a row without entries
    return x, (x[:, 0] + rng.normal(size=300) > x[:, 1]).astype(float)


@pytest.fixture(scope="module", params=["sparse", "dense"])
def rows(spark, data, request):
    if request.param == "dense":
        df = spark.createDataFrame([(float(y), [float(v) for v in r]) for r, y in zip(*data)], "label double, x array<double>")
        return df.select("label", array_to_vector("x").alias("tfidf_features"))
    pairs = [(float(y), Vectors.sparse(12, [(int(i), float(r[i])) for i in np.flatnonzero(r)])) for r, y in zip(*data)]
    return spark.createDataFrame(pairs, ["label", "tfidf_features"])


@pytest.mark.parametrize("steps", [1, 5, 200])
def test_loss_and_gradient(rows, data, steps):
    fitted = model.fit_classifier(rows, max_iter=steps, tol=1e-12)
    history = [r["loss"] for r in model.loss_history(fitted).orderBy("iteration").collect()]
    found = model.loss_and_gradient(fitted, rows).first()
    loss, norm = numpy_loss(*data, fitted.intercept, fitted.coefficients.toArray())
    assert found["n_rows"] == 300
    assert found["loss"] == pytest.approx(loss, rel=1e-9) == pytest.approx(history[-1], rel=1e-9)
    assert found["gradient_norm"] == pytest.approx(norm, rel=1e-6, abs=1e-9)
    share = data[1].mean()
    assert history[0] == pytest.approx(-share * np.log(share) - (1 - share) * np.log(1 - share))
    assert all(b <= a for a, b in zip(history, history[1:]))
    assert (found["gradient_norm"] < 1e-5) == (steps == 200)


def test_gradient_after_an_observation(spark, rows):
    spark.range(3).observe(Observation("before"), F.count("*").alias("n")).collect()  # the session can't be serialised from here on
    fitted = model.fit_classifier(rows, max_iter=3)
    assert fitted.hasSummary and model.loss_and_gradient(fitted, rows).first()["n_rows"] == 300


def test_history_outlives_the_fit(spark, tmp_path):
    docs = spark.createDataFrame([(i, i % 2, "good tasty food" if i % 2 else "bad awful food") for i in range(40)],
                                 "doc_id long, label int, text string")
    model.train(docs, num_features=64, max_iter=4, history_path=str(tmp_path / "history"))
    kept = spark.read.parquet(str(tmp_path / "history")).agg(F.min("iteration"), F.max("iteration"), F.count("*")).first()
    assert kept[0] == 0 and 1 <= kept[1] <= 4 and kept[2] == kept[1] + 1
