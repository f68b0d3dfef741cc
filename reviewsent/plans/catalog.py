"""Named queries over the given tables. Each reads its whole tables."""

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewsent.functions import text
from reviewsent.operators import (cleaning, evaluation, explore, histograms, model, profile, sampling, selection,
                                  similarity, tfidf, words)
from reviewsent.plans import stages
from reviewsent.schema import CLEANED, REVIEWS
from reviewsent.sources import files
from reviewsent.sources.shared import new_path, stage_table
from reviewsent.sources.tables import raw_reviews, read_table

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_reviews(raw_reviews(spark, folder))


def staged_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return stage_table(reviews(spark, folder), "cleaned_reviews")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_texts(read_table(spark, folder, "documents"), "text", "doc_id", min_length=3)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return stages.lexicon_scored(staged_reviews(spark, folder))


def staged_scores(scored: DataFrame) -> DataFrame:
    """What the metrics read of predictions, without the texts."""
    return stage_table(scored.select("label", "prediction", "prob_positive"), "scores")


# profile

def row_count(spark, folder):
    return profile.shape(raw_reviews(spark, folder))


def null_profile(spark, folder):
    return profile.null_profile(raw_reviews(spark, folder))


def duplicate_report(spark, folder):
    return profile.duplicate_report(raw_reviews(spark, folder), cleaning.RAW_COLUMNS)


def class_distribution(spark, folder):
    return profile.named_class_distribution(raw_reviews(spark, folder))


def class_balance(spark, folder):
    return profile.class_balance(stages.labelled_unique(raw_reviews(spark, folder)))


def class_balance_toxic(spark, folder):
    return profile.class_balance(stages.labelled_unique(raw_reviews(spark, folder, "toxic")))


def label_distribution(spark, folder):
    return profile.class_distribution(reviews(spark, folder), "label")


def length_stats(spark, folder):
    return profile.length_stats(raw_reviews(spark, folder), F.length("Text"))


def length_median(spark, folder):
    return profile.median_by(reviews(spark, folder), "label", F.length("text"))


def price_median(spark, folder):
    """A median of doubles of which most occur once."""
    return selection.exact_median(read_table(spark, folder, "lineitem"), "l_returnflag", F.col("l_extendedprice"))


def word_length_median(spark, folder):
    """The mean letters per word of a text: a double that few texts share."""
    tokens = F.size(F.split("text", " "))
    return selection.exact_median(reviews(spark, folder), "label", (F.length("text") - tokens + 1) / tokens)


def length_histogram(spark, folder):
    return histograms.histogram_all(raw_reviews(spark, folder), F.length("Text"), 0, 3000)


def length_histogram_by_class(spark, folder):
    return histograms.histogram(reviews(spark, folder), F.length("text"), 0, 2000)


def length_histogram_automatic(spark, folder):
    return histograms.histogram_automatic(staged_reviews(spark, folder).select("label", "text"), F.length("text"), 40)


# cleaning

def clean_reviews_clean_dedupe(spark, folder):
    return cleaning.clean_reviews(raw_reviews(spark, folder), dedupe_on="clean")


def clean_pages(spark, folder):
    return cleaning.clean_texts(read_table(spark, folder, "pages"), "html", "page_id")


def clean_unicode(spark, folder):
    return cleaning.clean_texts(read_table(spark, folder, "documents"), "text", "doc_id", letters="unicode")


def cleaning_report(spark, folder):
    return cleaning.cleaning_report(raw_reviews(spark, folder))


# samples

def hash_sample(spark, folder):
    return sampling.hash_sample(raw_reviews(spark, folder), 0.25)


def hash_sample_rows(spark, folder):
    return sampling.hash_sample_rows(read_table(spark, folder, "documents").select("doc_id", "n_chars"), 400)


def hash_split(spark, folder):
    return sampling.with_split(reviews(spark, folder).select("doc_id", "label"))


def random_rows(spark, folder):
    return sampling.random_rows(read_table(spark, folder, "documents").select("doc_id", "text"), 10, seed=7)


def undersampled(spark, folder, label):
    rows = stages.labelled_unique(raw_reviews(spark, folder, label)).select("doc_id", "label", "Score")
    return sampling.undersample(stage_table(rows, "distinct_reviews"))


def undersample_exact(spark, folder):
    return undersampled(spark, folder, "quality")


def undersample_toxic(spark, folder):
    return undersampled(spark, folder, "toxic")


def balanced_reviews(spark, folder):
    return stages.balanced_reviews(raw_reviews(spark, folder))


def split_report(spark, folder):
    """Size and classes of both sides of the split that the model is trained and judged on."""
    return sampling.split_report(balanced_reviews(spark, folder).select("doc_id", "label"))


def bernoulli_sample(spark, folder):
    return sampling.bernoulli_sample(read_table(spark, folder, "documents"), 400)


def random_split(spark, folder):
    train, test = sampling.random_split(reviews(spark, folder).select("doc_id", "label"))
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def undersample_bernoulli(spark, folder):
    return sampling.undersample_bernoulli(reviews(spark, folder).select("doc_id", "label"))


# words

def filtered_tokens(spark, folder):
    rows = words.with_tokens(documents(spark, folder))
    return rows.select("doc_id", F.size("tokens").alias("before"), F.size("filtered_tokens").alias("after"),
                       F.array_join("filtered_tokens", " ").alias("filtered"))


def token_stats(spark, folder):
    return words.token_stats(reviews(spark, folder))


def top_words_default(spark, folder):
    return words.top_words(words.word_rows(reviews(spark, folder), "label"), k=15)


def top_words_plus6(spark, folder):
    return words.top_words(words.word_rows(reviews(spark, folder), "label", stop="english_plus6"), k=80)


def top_words_compact(spark, folder):
    return words.top_words(words.split_word_rows(reviews(spark, folder), "label"), k=20)


def top_words_bounded(spark, folder):
    return words.top_words_bounded(words.split_word_rows(staged_reviews(spark, folder).select("label", "text"), "label"), k=20)


def role_top_words(spark, folder):
    turns = cleaning.clean_texts(read_table(spark, folder, "conversations"), "text", "role")
    return words.top_words(words.split_word_rows(turns, "role"), "role", k=20)


def word_ratio(spark, folder):
    return words.word_ratio(words.word_rows(reviews(spark, folder), "label"))


def word_ratio_joined(spark, folder):
    return words.word_ratio_joined(words.word_rows(staged_reviews(spark, folder), "label"))


def word_ratio_one_sided(spark, folder):
    return words.word_ratio(words.word_rows(reviews(spark, folder), "label"), min_support=5, keep_one_sided=True)


def word_ratio_top(spark, folder, min_support=50):
    rows = words.word_rows(reviews(spark, folder), "label", stop="english_plus6")
    return words.top_ratio(words.word_ratio(rows, min_support), 20)


def bigram_ratio_top(spark, folder):
    rows = words.ngram_rows(reviews(spark, folder), "label", n=2)
    return words.top_ratio(words.word_ratio(rows, min_support=20), 20)


# TF-IDF

def document_frequency(spark, folder):
    return tfidf.document_frequency(documents(spark, folder))


def tfidf_long(spark, folder):
    rows = stage_table(documents(spark, folder), "documents")
    return rounded(tfidf.tfidf_long(rows, tfidf.filtered_tokens()), "idf", "tfidf")


def tfidf_in_blocks(spark, folder):
    rows = stage_table(documents(spark, folder), "documents")
    return rounded(tfidf.tfidf_in_blocks(rows, tfidf.filtered_tokens()), "idf", "tfidf")


def hashed_tfidf_md5(spark, folder):
    rows = stage_table(documents(spark, folder), "documents")
    return rounded(tfidf.tfidf_long(rows, tfidf.hashed_tokens(), name="bucket"), "idf", "tfidf")


def feature_density(spark, folder):
    return tfidf.term_density(documents(spark, folder), tfidf.hashed_tokens())


# similar words

def cooccurrence(spark, folder):
    return staged_pairs(staged_reviews(spark, folder))[0]


def staged_pairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs, and the totals of their words."""
    totals = stage_table(similarity.neighbour_counts(rows), "neighbour_counts")
    return similarity.cooccurrence(rows, totals=totals), totals


def word_information(spark, folder):
    return rounded(staged_information(staged_reviews(spark, folder))[0], "information")


def staged_information(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The information of pairs, and the totals of words it is made with."""
    pairs, totals = staged_pairs(rows)
    return similarity.information(stage_table(pairs, "pairs"), totals), totals


def similar_words(spark, folder, asked=20, k=10):
    """The words used most like the most frequent ones."""
    found, totals = staged_information(staged_reviews(spark, folder))
    vectors = similarity.word_vectors(found)
    frequent = totals.join(vectors.select("word"), "word").orderBy(F.col("total").desc(), "word").limit(asked)
    return rounded(similarity.similar_words(vectors, [r["word"] for r in frequent.collect()], k), "cosine")


# evaluation, on the predictions of the lexicon

def confusion(spark, folder):
    return evaluation.confusion(predictions(spark, folder))


def confusion_crosstab(spark, folder):
    return evaluation.confusion_crosstab(predictions(spark, folder))


def metrics_positive(spark, folder):
    return rounded(evaluation.positive_metrics(predictions(spark, folder)), "accuracy", "precision", "recall", "f1")


def metrics_weighted(spark, folder):
    return rounded(evaluation.weighted_metrics(predictions(spark, folder)),
                   "accuracy", "weighted_precision", "weighted_recall", "weighted_f1")


def metrics_table(spark, folder):
    return rounded(evaluation.metrics_table(staged_scores(predictions(spark, folder))), "value")


def roc_curve(spark, folder):
    return evaluation.roc_curve(predictions(spark, folder))


def roc_curve_corners(spark, folder):
    return evaluation.roc_curve(predictions(spark, folder), drop_collinear=True)


def auc_exact(spark, folder):
    return rounded(evaluation.auc(predictions(spark, folder)), "auc")


def probability_histogram(spark, folder):
    rows = staged_scores(predictions(spark, folder))
    return rounded(histograms.histogram_own_range(rows, F.col("prob_positive")), "bin_start")


def probability_histogram_common(spark, folder):
    return rounded(histograms.histogram(predictions(spark, folder), F.col("prob_positive"), 0, 1), "bin_start")


def probability_histogram_automatic(spark, folder):
    return histograms.histogram_automatic(staged_scores(predictions(spark, folder)), F.col("prob_positive"))


# checks of what SQL can say about samples, vectors and models

def bernoulli_sample_check(spark, folder):
    """Rows of the sample that are no documents in all columns, and keys that it has twice: none. Its size is within six
    standard deviations of what was asked for, and it is not empty."""
    documents = read_table(spark, folder, "documents")
    rows = F.struct(*documents.columns)
    sample = bernoulli_sample(spark, folder).groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.sha2(F.to_json(rows), 256)).alias("row"))
    known = documents.select("doc_id", F.sha2(F.to_json(rows), 256).alias("known"))
    total, wanted = documents.count(), 400
    share = min(1.0, wanted / max(1, total))
    allowed = 6 * (total * share * (1 - share)) ** 0.5
    return sample.join(known, "doc_id", "left").agg(
        F.count_if(~F.col("row").eqNullSafe(F.col("known"))).alias("unknown"), F.count_if(F.col("n") > 1).alias("repeated"),
        ((F.count("*") > 0) & (F.abs(F.count("*") - F.lit(total * share)) <= allowed)).alias("fits"))


def random_split_union(spark, folder):
    """Both sides together: every row once."""
    return random_split(spark, folder).drop("split")


def undersample_bernoulli_smallest(spark, folder):
    """The smallest class, which stays complete."""
    rows = reviews(spark, folder).select("doc_id", "label")
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))
    smallest = counts.agg(F.min_by("label", F.struct("n", "label"))).scalar()
    return sampling.undersample_bernoulli(rows).where(F.col("label") == smallest)


def ml_scores_check(spark, folder):
    """The scored test rows, and whether probability and prediction agree."""
    p = F.col("prob_positive")
    return ml_train_score(spark, folder).select("doc_id", "label", p.between(0, 1).alias("in_range"),
                                                ((p > 0.5) == (F.col("prediction") == 1)).alias("agree"))


def ml_features_check(spark, folder):
    """Vectors have no more entries than the document has distinct terms."""
    rows = ml_hashing_tfidf(spark, folder)
    terms = documents(spark, folder).select("doc_id", F.size(F.array_distinct(tfidf.filtered_tokens())).alias("terms"))
    return rows.join(terms, "doc_id").select("doc_id", "dimensions", (F.col("non_zero") <= F.col("terms")).alias("fits"))


def ml_metrics_agree(spark, folder):
    """MLlib's evaluators against the relational metrics of the same predictions."""
    scored = staged_scores(ml_train_score(spark, folder))
    theirs = model.evaluator_metrics(scored)
    names = {("auc", "all"): "areaUnderROC", ("accuracy", "all"): "accuracy", ("f1", "weighted"): "f1",
             ("precision", "weighted"): "weightedPrecision", ("recall", "weighted"): "weightedRecall"}
    expected = spark.createDataFrame([(*k, float(theirs[v])) for k, v in names.items()], "metric string, scope string, theirs double")
    return evaluation.metrics_table(scored).join(F.broadcast(expected), ["metric", "scope"]).select(
        "metric", "scope", (F.abs(F.col("value") - F.col("theirs")) < 1e-9).alias("equal"))


def training_metrics(spark, folder):
    """Training metrics beside those of the test rows: both defined, training at least as good."""
    rows = stage_table(stages.balanced_reviews(raw_reviews(spark, folder)), "balanced_reviews")
    trained, scored = stages.train_and_score(rows)
    train_rows, _ = sampling.hash_split(rows)
    test = evaluation.positive_metrics(staged_scores(scored)).select(F.col("accuracy").alias("test_accuracy"))
    train = model.training_metrics(trained, train_rows)
    return train.select(F.col("accuracy").between(0, 1).alias("accuracy_defined"), F.col("auc").between(0, 1).alias("auc_defined"),
                        (F.col("accuracy") >= test.scalar()).alias("not_below_test"))


def training_history(spark, folder):
    """The loss before the first step, whether it ever rises, and whether the stored weights have the last one."""
    rows = stage_table(stages.balanced_reviews(raw_reviews(spark, folder)), "balanced_reviews")
    train_rows, _ = sampling.hash_split(rows)
    path = new_path(spark, "loss_history")
    trained = model.train(train_rows, history_path=path)
    features = trained.stages[-2].transform(model.term_vectors(model.text_model(), train_rows, "label"))
    stored = model.loss_and_gradient(trained.stages[-1], features).select("n_rows", F.col("loss").alias("stored"))
    last = F.max_by("loss", "iteration")
    losses = F.transform(F.array_sort(F.collect_list(F.struct("iteration", "loss"))), lambda s: s["loss"])  # one per iteration
    steps = spark.read.parquet(path).agg(F.min_by("loss", "iteration").alias("start_loss"), last.alias("last"), losses.alias("losses"))
    rising = F.exists(F.sequence(F.lit(2), F.size("losses")), lambda i: F.element_at("losses", i) > F.element_at("losses", i - 1) + 1e-9)
    return steps.select(
        F.lit(stored.select("n_rows").scalar()).alias("n_rows"), F.round("start_loss", 6).alias("start_loss"),
        (~rising).alias("never_rises"),
        (F.abs(F.col("last") - stored.select("stored").scalar()) < 1e-6).alias("stored_has_last"))


def length_model(spark, folder):
    """Label by text length in thousands of characters: weights that SQL can find as well, and their loss."""
    rows = stage_table(reviews(spark, folder).select("label", (F.length("text") / 1000.0).alias("x")), "lengths")
    rows = rows.select("label", array_to_vector(F.array("x")).alias("tfidf_features"))
    fitted = model.fit_classifier(rows, max_iter=200, tol=1e-13)
    return model.loss_and_gradient(fitted, rows).select(
        "n_rows", F.round(F.lit(float(fitted.intercept)), 5).alias("intercept"),
        F.round(F.lit(float(fitted.coefficients[0])), 5).alias("weight"), F.round("loss", 6).alias("loss"),
        (F.col("gradient_norm") < 1e-5).alias("at_optimum"))


def model_roundtrip(spark, folder):
    """Scores of the model after saving and loading, beside those before."""
    rows = stage_table(stages.balanced_reviews(raw_reviews(spark, folder)), "balanced_reviews")
    trained, scored = stages.train_and_score(rows)
    path = new_path(spark, "model")
    model.save_model(trained, path)
    again = model.score(model.load_model(path), sampling.hash_split(rows)[1], "doc_id").select(
        "doc_id", F.col("prob_positive").alias("p"))
    return scored.join(again, "doc_id").select("doc_id", (F.abs(F.col("p") - F.col("prob_positive")) < 1e-12).alias("same"))


def stored_probabilities(spark, folder):
    """Predictions stored with probability vectors, some of them missing."""
    p = F.col("prob_positive")
    vector = F.when(F.col("doc_id") % 5 != 0, array_to_vector(F.array(1 - p, p)))
    stored = predictions(spark, folder).withColumn("probability", vector).select("doc_id", "prediction", "probability")
    return rounded(model.fix_probability(stored, missing=0.5), "prob_positive")


def word_count_map(spark, folder):
    """The word -> count map of each class, as rows again."""
    found = words.word_count_map(words.top_words(words.word_rows(reviews(spark, folder), "label"), k=15))
    return found.select("label", F.explode("frequencies").alias("word", "n"))


def tokens_raw(spark, folder):
    rows = read_table(spark, folder, "documents").where(F.col("text").isNotNull())
    return rows.select("doc_id", F.size(text.tokens_raw(F.col("text"))).alias("n_tokens"))


def schema_table(spark, folder):
    return profile.schema_table(read_table(spark, folder, "documents"))


# examples and explorer

def example_table(spark, folder):
    return explore.example_table(predictions(spark, folder), lengths=(80, 3000))


def prediction_preview(spark, folder):
    return explore.prediction_preview(predictions(spark, folder))


def explorer(spark, folder):
    rows = stage_table(predictions(spark, folder), "predictions")
    return explore.explorer_cards(rows, "correct", "positive", 0.6)


def explorer_wrong(spark, folder):
    return explore.explore(predictions(spark, folder), "wrong", "all", 0.7).drop("text")


def overview(spark, folder):
    rows = staged_reviews(spark, folder)
    scored = staged_scores(stages.lexicon_scored(rows))
    return rounded(explore.overview(rows, scored), "accuracy", "auc")


# sources and sinks

def csv_roundtrip(spark, folder):
    """Reviews -> headerless CSV -> parquet -> rows. CSV reads an empty field as null."""
    csv_path, parquet_path = new_path(spark, "reviews_csv"), new_path(spark, "reviews")
    rows = raw_reviews(spark, folder).select("Score", "Summary", "Text")
    files.write_csv(rows, csv_path)
    return files.csv_to_parquet(spark, csv_path, parquet_path, REVIEWS).drop("doc_id")


def csv_split_roundtrip(spark, folder):
    """:func:`csv_roundtrip` by a reader that splits files within records."""
    csv_path, parquet_path = new_path(spark, "reviews_csv"), new_path(spark, "reviews")
    files.write_csv(raw_reviews(spark, folder).select("Score", "Summary", "Text"), csv_path)
    return files.csv_to_parquet(spark, csv_path, parquet_path, REVIEWS, split=True).drop("doc_id")


def csv_renamed(spark, folder):
    """Reviews -> headerless CSV -> columns named by position."""
    path = new_path(spark, "reviews_csv")
    files.write_csv(raw_reviews(spark, folder).select("Score", "Summary", "Text"), path)
    return files.rename_columns(files.read_csv(spark, path, schema=None), "Score", "Summary", "Text").select(
        F.col("Score").cast("int").alias("Score"), "Summary", "Text")


def csv_header_roundtrip(spark, folder):
    """Cleaned reviews -> CSV with header -> parquet -> rows."""
    csv_path, parquet_path = new_path(spark, "cleaned_csv"), new_path(spark, "cleaned")
    files.write_csv(reviews(spark, folder).drop("doc_id"), csv_path, header=True)
    return files.csv_to_parquet(spark, csv_path, parquet_path, CLEANED, header=True, key=None)


# MLlib

def ml_hashing_tfidf(spark, folder):
    vectors = model.term_vectors(model.text_model(), documents(spark, folder), "doc_id")
    features = model.fit_idf(vectors).transform(vectors)
    return features.select("doc_id", *model.vector_shape("tfidf_features"))


def ml_train_score(spark, folder):
    rows = stage_table(stages.balanced_reviews(raw_reviews(spark, folder)), "balanced_reviews")
    return stages.train_and_score(rows)[1]


def ml_metrics(spark, folder):
    return evaluation.metrics_table(staged_scores(ml_train_score(spark, folder)))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    row_count, null_profile, duplicate_report, class_distribution, class_balance, class_balance_toxic,
    label_distribution, length_stats, length_median, price_median, word_length_median, length_histogram, length_histogram_by_class, length_histogram_automatic,
    clean_reviews_clean_dedupe, clean_pages, clean_unicode, cleaning_report,
    hash_sample, hash_sample_rows, hash_split, split_report, random_rows, undersample_exact, undersample_toxic,
    balanced_reviews, bernoulli_sample, random_split, undersample_bernoulli,
    filtered_tokens, token_stats, top_words_default, top_words_plus6, top_words_compact, top_words_bounded, role_top_words,
    word_ratio, word_ratio_joined, word_ratio_one_sided, word_ratio_top, bigram_ratio_top,
    document_frequency, tfidf_long, tfidf_in_blocks, hashed_tfidf_md5, feature_density, cooccurrence, word_information, similar_words,
    confusion, confusion_crosstab, metrics_positive, metrics_weighted, metrics_table,
    roc_curve, roc_curve_corners, auc_exact, probability_histogram, probability_histogram_common,
    probability_histogram_automatic,
    example_table, prediction_preview, explorer, explorer_wrong, overview,
    csv_roundtrip, csv_split_roundtrip, csv_renamed, csv_header_roundtrip, ml_hashing_tfidf, ml_train_score, ml_metrics,
    bernoulli_sample_check, random_split_union, undersample_bernoulli_smallest, ml_scores_check, ml_features_check,
    ml_metrics_agree, training_metrics, training_history, length_model, model_roundtrip, stored_probabilities, word_count_map, tokens_raw, schema_table,
)}
QUERIES["clean_reviews"] = reviews
QUERIES["lexicon_predictions"] = predictions
