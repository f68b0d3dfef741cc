"""Physical plans: what is read, what is shuffled, what stays out of Python."""

import re

import pytest
from pyspark.sql import functions as F

from reviewsent.operators import cleaning, explore, histograms, profile, sampling, tfidf, words
from reviewsent.plans.catalog import QUERIES
from reviewsent.sources.shared import run_folder, stage_table
from reviewsent.sources.tables import raw_reviews


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def reviews(spark, folder):
    return stage_table(cleaning.clean_reviews(raw_reviews(spark, folder)), "reviews")


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, folder, name, threshold):
    """The plan of every query, with and without broadcasts; its stage tables are written while it is made."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        with run_folder(spark):
            text = plan(QUERIES[name](spark, folder))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # rows are never sorted in one task for a window; totals per range of scores may be
    assert all("sum(_p" in line or "_range" in line or "_first" in line
               for line in re.findall(r".*windowspecdefinition\((?!\w+#).*", text)), text


STAGED_WITHOUT_TEXTS = ["metrics_table", "probability_histogram", "ml_metrics", "undersample_exact", "undersample_toxic",
                        "overview"]


@pytest.mark.parametrize("name", STAGED_WITHOUT_TEXTS)
def test_stage_tables_hold_no_texts_that_nobody_reads(spark, folder, name, monkeypatch):
    from reviewsent.plans import catalog
    seen = {}
    monkeypatch.setattr(catalog, "stage_table", lambda df, label: seen.update({label: df.columns}) or stage_table(df, label))
    QUERIES[name](spark, folder)
    for label in ("scores", "distinct_reviews", "score_groups"):
        assert not {"text", "Text", "Summary"} & set(seen.get(label, []))
    assert seen


def test_duplicate_texts_are_never_shuffled(spark, folder):
    text = plan(cleaning.clean_reviews(raw_reviews(spark, folder)))
    assert not re.search(r"hashpartitioning\([^)]*(Text|Summary|Score)#", text)


def test_tag_removal_reads_a_text_once(spark):
    import time
    from reviewsent.functions.text import strip_tags
    rows = ["<" * 200_000, "<" * 200_000 + ">", "a<b>c" * 40_000 + "<" * 100_000, "x>" * 100_000, "<<a>b<", "a", ""]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    start = time.time()
    found = [r[0] for r in df.select(strip_tags(F.col("t"))).collect()]
    assert time.time() - start < 10
    assert found[1:] == [re.sub("<[^>]*>", " ", r) for r in rows[1:]] and found[0] == rows[0]


def test_texts_are_normalised_once(spark, folder):
    text = plan(cleaning.clean_reviews(raw_reviews(spark, folder)))
    # one regular-expression chain for the summary, one for the text
    assert text.count("[^a-z]+") == 2


def test_duplicates_shuffle_digests_only(spark, folder):
    text = plan(profile.duplicate_report(raw_reviews(spark, folder), cleaning.RAW_COLUMNS))
    assert "hashpartitioning(digest" in text and "hashpartitioning(Text" not in text
    assert "partial_count" in text


def test_dropping_nulls_makes_the_join_an_inner_one(spark, folder):
    text = plan(cleaning.drop_incomplete(raw_reviews(spark, folder)))
    assert "Inner" in text and "LeftOuter" not in text


def test_only_needed_columns_are_read(reviews):
    text = plan(profile.median_by(reviews, "label", F.length("text")))
    assert "ReadSchema: struct<label:int,text:string>" in text
    assert "ReadSchema: struct<label:int>" in plan(profile.class_distribution(reviews, "label"))
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,1)]" in plan(explore.explore(reviews, sentiment="positive"))


def test_top_words_are_cut_before_the_shuffle(reviews):
    text = plan(words.top_words(words.word_rows(reviews, "label")))
    assert text.count("WindowGroupLimit") == 2 and "partial_count" in text


def test_top_ratio_takes_the_first_rows_without_a_full_sort(reviews):
    text = plan(words.top_ratio(words.word_ratio(words.word_rows(reviews, "label"))))
    assert text.count("TakeOrderedAndProject") == 2


def test_term_frequencies_need_no_shuffle(reviews):
    assert "Exchange" not in plan(tfidf.term_frequencies(reviews, tfidf.filtered_tokens()))


def test_lexicon_scores_need_no_shuffle(reviews):
    from reviewsent.operators.lexicon import lexicon_predictions
    many = [f"w{i}" for i in range(100)]
    text = plan(lexicon_predictions(reviews, many, many))
    assert "Exchange" not in text and "INSET" in text


def test_undersampling_ranks_one_hash_prefix_only(reviews):
    text = plan(sampling.undersample(reviews))
    assert "_prefix" in text and text.count("BroadcastHashJoin") >= 2
    # whole texts are never shuffled: the only scan that reads them feeds a broadcast join
    assert text.count("text:string") == 1


def test_hash_sample_is_a_filter(reviews):
    text = plan(sampling.hash_sample(reviews, 0.1))
    assert "Exchange" not in text and "Window" not in text


def test_histogram_counts_before_the_shuffle(reviews):
    assert "partial_count" in plan(histograms.histogram(reviews, F.length("text"), 0, 2000))
