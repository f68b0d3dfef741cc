"""The stages from raw reviews to evaluated predictions, each written where the next reads it."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from reviewsent.operators.cleaning import (RAW_COLUMNS, clean_reviews, drop_duplicates, drop_incomplete,
                                           label_reviews, normalise_reviews)
from reviewsent.operators.lexicon import lexicon_predictions, sentiment_lexicon
from reviewsent.operators.model import features, save_model, score, train
from reviewsent.operators.sampling import hash_sample, hash_split, undersample
from reviewsent.operators.words import word_ratio, word_rows
from reviewsent.sources.files import write_verified
from reviewsent.schema import PREDICTIONS
from reviewsent.sources.shared import run_folder, stage_table


def labelled_unique(raw: DataFrame) -> DataFrame:
    """Complete, distinct, labelled raw reviews."""
    complete = drop_incomplete(raw.select("doc_id", *RAW_COLUMNS))
    return label_reviews(drop_duplicates(complete, RAW_COLUMNS))


def balanced_reviews(raw: DataFrame, seed: int = 42) -> DataFrame:
    """Cleaned reviews with classes of equal size before short texts are dropped.

    The distinct reviews are written first: the balancing reads them three times.
    """
    return normalise_reviews(undersample(stage_table(labelled_unique(raw), "distinct_reviews"), seed=seed))


def write_cleaned(raw: DataFrame, path: str, balance: bool = True, seed: int = 42, sample: float = 1.0) -> DataFrame:
    """Sampled (a share ``sample`` of the raw rows), cleaned and balanced reviews."""
    with run_folder(raw.sparkSession):
        rows = hash_sample(raw, sample, seed=seed)
        return write_verified(balanced_reviews(rows, seed) if balance else clean_reviews(rows), path)


def write_features(cleaned: DataFrame, path: str) -> DataFrame:
    """Features with the IDF weights of all rows: ``(doc_id, label, text, filtered_tokens, tfidf_features)``."""
    with run_folder(cleaned.sparkSession):
        return write_verified(features(cleaned, "doc_id", "label", "text", "filtered_tokens"), path)


def train_and_score(cleaned: DataFrame, idf_scope: str = "train", train_share: float = 0.8,
                    seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Split by key hash, train, and score the test rows.

    ``idf_scope='all'`` fits the IDF weights on all rows instead of the training rows.
    """
    train_df, test_df = hash_split(cleaned, train_share, seed=seed)
    model = train(train_df, cleaned if idf_scope == "all" else None)
    return model, score(model, test_df)


def write_predictions(cleaned: DataFrame, path: str, model_path: str | None = None,
                      idf_scope: str = "train", seed: int = 42) -> DataFrame:
    with run_folder(cleaned.sparkSession):
        model, predictions = train_and_score(cleaned, idf_scope, seed=seed)
        if model_path:
            save_model(model, model_path)
        return write_verified(predictions.select(*PREDICTIONS.names), path)


def lexicon_scored(cleaned: DataFrame, min_support: int = 50, size: int = 100) -> DataFrame:
    """Predictions of the lexicon built from the same written reviews."""
    ratio = word_ratio(word_rows(cleaned, "label"), min_support)
    return lexicon_predictions(cleaned, *sentiment_lexicon(ratio, size))
