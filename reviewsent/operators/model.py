"""MLlib features and the logistic-regression sentiment model."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, IDFModel, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewsent.functions.stopwords import STOP_WORDS
from reviewsent.operators.evaluation import auc, positive_metrics
from reviewsent.sources.shared import new_path, stage_table

# Size of the feature vectors, iterations and regularisation of the classifier.
NUM_FEATURES = 10_000
MAX_ITER, REG_PARAM = 20, 0.1


def text_model(num_features: int = NUM_FEATURES, stop: str = "english") -> PipelineModel:
    """Tokenizer, stop words and hashed term frequency; nothing to fit."""
    return PipelineModel(stages=[
        Tokenizer(inputCol="text", outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens", stopWords=list(STOP_WORDS[stop])),
        HashingTF(inputCol="filtered_tokens", outputCol="raw_features", numFeatures=num_features),
    ])


def fit_idf(vectors: DataFrame) -> IDFModel:
    return IDF(inputCol="raw_features", outputCol="tfidf_features").fit(vectors.select("raw_features"))


def feature_model(documents: DataFrame, num_features: int = NUM_FEATURES, stop: str = "english") -> PipelineModel:
    """:func:`text_model` and the IDF weights fitted on ``documents``, to be saved and used on others."""
    text = text_model(num_features, stop)
    return PipelineModel(stages=[*text.stages, fit_idf(add_features(text, documents))])


def term_vectors(text: PipelineModel, documents: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``raw_features``, written: fitting reads them often, the texts are read once."""
    return stage_table(add_features(text, documents).select(*keep, "raw_features"), "term_vectors")


def features(documents: DataFrame, *keep: str, num_features: int = NUM_FEATURES, stop: str = "english") -> DataFrame:
    """``keep`` columns and ``tfidf_features`` with the IDF weights of all rows; the texts are read once."""
    vectors = term_vectors(text_model(num_features, stop), documents, *keep)
    return fit_idf(vectors).transform(vectors).drop("raw_features")


def add_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the columns of ``model`` to the rows that have a text."""
    return model.transform(df.where(F.col("text").isNotNull())).drop("tokens")


def vector_shape(vector: str) -> tuple[Column, Column]:
    """Dimensions and non-zero entries of a sparse vector column, read from its fields."""
    fields = F.unwrap_udt(F.col(vector))
    return fields["size"].alias("dimensions"), F.size(fields["indices"]).alias("non_zero")


def fit_classifier(features: DataFrame, max_iter: int = MAX_ITER, reg_param: float = REG_PARAM,
                   tol: float = 1e-6) -> LogisticRegressionModel:
    """Logistic regression on ``tfidf_features`` and ``label``; MLlib caches what it iterates over."""
    lr = LogisticRegression(featuresCol="tfidf_features", labelCol="label", maxIter=max_iter, regParam=reg_param, tol=tol)
    return lr.fit(features.select("label", "tfidf_features"))


def loss_history(classifier: LogisticRegressionModel) -> DataFrame:
    """``(iteration, loss)`` of a freshly fitted classifier, from 0 before the first step: one row per iteration."""
    losses = classifier.summary.objectiveHistory
    return SparkSession.active().createDataFrame([(i, float(x)) for i, x in enumerate(losses)], "iteration int, loss double")


def loss_and_gradient(classifier: LogisticRegressionModel, features: DataFrame, reg_param: float = REG_PARAM) -> DataFrame:
    """``(n_rows, loss, gradient_norm)`` of the stored weights on ``label`` and ``tfidf_features``, one row.

    The loss is what the fit lowers: the mean of the logistic loss, and ``reg_param / 2`` times the squared weights of
    features scaled to standard deviation 1. The gradient is that by the intercept and by these weights, so it is near 0
    where the fit has come to its end. Rows are read once; what is shuffled is a row per feature and task. A freshly
    fitted classifier is scored :func:`detached`.
    """
    if classifier.hasSummary:
        classifier = detached(classifier)
    margin = vector_to_array(F.col("rawPrediction"))[1]
    wrong_way = F.when(F.col("label") == 1, -margin).otherwise(margin)
    logistic = F.greatest(wrong_way, F.lit(0.0)) + F.log1p(F.exp(-F.abs(wrong_way)))
    vector = F.unwrap_udt(F.col("tfidf_features"))
    places = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    rows = classifier.transform(features.select("label", "tfidf_features")).select(
        logistic.alias("loss"), (positive_probability() - F.col("label")).alias("residual"),
        F.arrays_zip(places.alias("place"), vector["values"].alias("x")).alias("entries"))
    # place -1 has one entry per row: the intercept's feature, which also carries count and loss
    whole = F.array(F.struct(F.lit(-1).alias("place"), F.lit(1.0).alias("x")))
    entries = rows.select("loss", "residual", F.inline(F.concat(whole, F.col("entries"))))
    sums = entries.groupBy("place").agg(
        F.sum(F.col("residual") * F.col("x")).alias("slope"), F.sum("x").alias("s1"), F.sum(F.col("x") * F.col("x")).alias("s2"),
        F.sum(F.when(F.col("place") == -1, F.col("loss"))).alias("loss"))
    weights = SparkSession.active().createDataFrame(  # as many rows as features
        list(enumerate(classifier.coefficients.toArray().tolist())), "place int, weight double")
    sums = stage_table(sums.join(weights, "place", "left"), "gradient_sums")
    total = sums.where("place = -1").select(F.col("s1").alias("n"), F.col("loss").alias("total_loss"), F.col("slope").alias("by_intercept"))
    n = total.select("n").scalar()
    deviation = F.sqrt(F.greatest(F.lit(0.0), (F.col("s2") - F.col("s1") * F.col("s1") / n) / (n - 1)))
    scaled = sums.where("place >= 0").select("slope", "weight", deviation.alias("deviation")).where("deviation > 0")
    by_weight = F.col("slope") / F.col("deviation") / n + reg_param * F.col("weight") * F.col("deviation")
    penalty = scaled.agg(F.coalesce(F.sum((F.col("weight") * F.col("deviation")) ** 2), F.lit(0.0)))
    squares = scaled.agg(F.coalesce(F.sum(by_weight * by_weight), F.lit(0.0)))
    return total.select(F.col("n").cast("long").alias("n_rows"),
                        (F.col("total_loss") / F.col("n") + reg_param / 2 * penalty.scalar()).alias("loss"),
                        F.sqrt((F.col("by_intercept") / F.col("n")) ** 2 + squares.scalar()).alias("gradient_norm"))


def detached(classifier: LogisticRegressionModel) -> LogisticRegressionModel:
    """The classifier written to the shared folder and loaded back, without its training summary.

    A freshly fitted model holds its summary, and with it the session and the training
    data. Scoring would ship all that with every task, and fails where the session has
    parts that cannot be serialised.
    """
    path = new_path(SparkSession.active(), "classifier")
    classifier.write().save(path)
    return LogisticRegressionModel.load(path)


def train(train_df: DataFrame, idf_documents: DataFrame | None = None,
          num_features: int = NUM_FEATURES, stop: str = "english",
          max_iter: int = MAX_ITER, reg_param: float = REG_PARAM, history_path: str | None = None) -> PipelineModel:
    """Features and classifier as one model.

    The IDF weights come from the training rows. Pass all rows as ``idf_documents`` to
    fit them before the split. The :func:`loss_history` of the fit goes to ``history_path``,
    a table that outlives the session.
    """
    text = text_model(num_features, stop)
    vectors = term_vectors(text, train_df, "label")
    idf = fit_idf(vectors if idf_documents is None else add_features(text, idf_documents))
    classifier = fit_classifier(idf.transform(vectors), max_iter, reg_param)
    if history_path:
        loss_history(classifier).write.mode("overwrite").parquet(history_path)
    return PipelineModel(stages=[*text.stages, idf, detached(classifier)])


def positive_probability(probability: str = "probability") -> Column:
    """Second element of the vector; null for a missing vector."""
    vector = F.col(probability)
    return F.when(vector.isNotNull(), vector_to_array(vector)[1])


def score(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns (default: doc_id, label, text) with ``prediction`` and ``prob_positive``."""
    keep = keep or ("doc_id", "label", "text")
    scored = model.transform(df.where(F.col("text").isNotNull()))
    return scored.select(*keep, "prediction", positive_probability().alias("prob_positive"))


def training_metrics(model: PipelineModel, train_df: DataFrame) -> DataFrame:
    """Accuracy and area under ROC on the training rows.

    Computed from the scored rows. MLlib's own summary needs the attached model, see
    :func:`detached`.
    """
    scored = stage_table(score(model, train_df).drop("text"), "train_predictions")
    return positive_metrics(scored).select("accuracy").withColumn("auc", auc(scored).scalar())


def fix_probability(predictions: DataFrame, missing: float | None = None) -> DataFrame:
    """Replace the probability vector of stored predictions by ``prob_positive``.

    A missing vector gives ``missing``, null unless asked for otherwise.
    """
    positive = F.coalesce(positive_probability(), F.lit(missing).cast("double"))
    return predictions.withColumn("prob_positive", positive).drop("probability")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def evaluator_metrics(predictions: DataFrame) -> dict[str, float]:
    """MLlib's own evaluators; the relational forms are in ``operators.evaluation``."""
    rows = predictions.select(F.col("label").cast("double").alias("label"), "prediction", "prob_positive")
    binary = BinaryClassificationEvaluator(rawPredictionCol="prob_positive", metricName="areaUnderROC", numBins=0)
    multi = MulticlassClassificationEvaluator()
    names = ("accuracy", "weightedPrecision", "weightedRecall", "f1")
    return {"areaUnderROC": binary.evaluate(rows),
            **{name: multi.evaluate(rows, {multi.metricName: name}) for name in names}}
