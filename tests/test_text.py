"""Normalisation, tokens, stop words, shortening."""

import pytest
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from reviewsent.functions import stopwords, text
from reviewsent.functions.keys import hex_threshold, row_digest
from reviewsent.operators import words

CLEAN = [
    ("Great!!!<br />GREAT.", "great great", True),
    ("Don't buy, it's BAD", "don t buy it s bad", True),
    ("Größe", "gr e", True),
    ("a < b > c", "a c", True),
    ("1 < 2", "", False),
    ("ok", "ok", False),
    ("a b", "a b", True),
    ("  \t \n", "", False),
    ("<p>only</p>", "only", True),
    ("5 stars", "stars", True),
]
# runs of every kind of character, long enough to overflow a recursive regular expression
HARD = ["x" + "!?" * 20_000 + "y", "<" * 500 + "a" + ">", " a b\x0bc", "ÄÖÜ ß é", "a\r\nb\tc", "<<a>>b<"]


@pytest.mark.parametrize("raw,expected,kept", CLEAN)
def test_normalise(spark, raw, expected, kept):
    row = spark.createDataFrame([(raw,)], "t string").select(text.normalise(F.col("t")).alias("c")).first()
    assert row["c"] == expected
    assert (len(row["c"]) >= 3) == kept


def test_normalise_equals_its_five_steps(spark):
    df = spark.createDataFrame([(t,) for t in HARD + [c[0] for c in CLEAN]], "t string")
    steps = F.trim(text.collapse_spaces(text.letters_only(text.strip_tags(F.lower("t")))))
    rows = df.select(steps.alias("a"), text.normalise(F.col("t")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)


def test_normalise_is_idempotent(spark):
    df = spark.createDataFrame([(t,) for t in HARD + [c[0] for c in CLEAN]], "t string")
    once = text.normalise(F.col("t"))
    assert df.where(once != text.normalise(once)).count() == 0


def test_unicode_letters_are_kept_on_request(spark):
    df = spark.createDataFrame([("Größe: 5 €",)], "t string")
    assert df.select(text.normalise(F.col("t"), "unicode").alias("c")).first()["c"] == "größe"


def test_raw_tokens_equal_mllib_tokenizer(spark):
    inputs = [" a  b ", "", "A\tb\n", "   ", "a", "x  ", "  x", "Don't  STOP\n\nnow"]
    df = spark.createDataFrame([(t,) for t in inputs], "t string")
    rows = Tokenizer(inputCol="t", outputCol="ml").transform(df).withColumn(
        "ours", text.tokens_raw(F.col("t"))).collect()
    assert [r["ours"] for r in rows] == [r["ml"] for r in rows]
    assert rows[0]["ours"] == ["", "a", "", "b"] and rows[1]["ours"] == [""] and rows[2]["ours"] == ["a", "b"]
    assert spark.createDataFrame([(None,)], "t string").select(text.tokens_raw(F.col("t"))).first()[0] is None


def test_word_split_has_no_empty_words(spark):
    df = spark.createDataFrame([("  a \t b\n",)], "t string")
    assert df.select(text.split_words(F.col("t"))).first()[0] == ["a", "b"]


def test_stop_word_lists():
    assert set(stopwords.ENGLISH) == set(StopWordsRemover.loadDefaultStopWords("english"))
    assert len(stopwords.ENGLISH) == 181 and len(stopwords.ENGLISH_PLUS6) == 187
    assert len(set(stopwords.COMPACT140)) == 140
    assert {"s", "t", "don", "not", "no", "would", "could", "don't", "i'm"} <= set(stopwords.ENGLISH)
    assert not {"ll", "d", "m", "re", "ve", "ain", "couldn", "doesn", "y", "o", "ma"} & set(stopwords.ENGLISH)


@pytest.mark.parametrize("name", ["english", "english_plus6", "compact140", "none"])
def test_stop_words_equal_mllib_remover(spark, name):
    df = spark.createDataFrame([("don't you can't really get the one book i d buy buy",), ("the",), ("",)], "text string")
    remover = StopWordsRemover(inputCol="tokens", outputCol="ml", stopWords=list(stopwords.STOP_WORDS[name]))
    rows = remover.transform(words.with_tokens(df, name)).collect()
    assert [r["filtered_tokens"] for r in rows] == [r["ml"] for r in rows]


def test_bigrams_equal_mllib_ngram(spark):
    df = spark.createDataFrame([(1, "not good at all"), (2, "good"), (3, "a b")], "label int, text string")
    for n in (1, 2, 3):
        ours = words.ngram_rows(df, "label", n=n).collect()
        split = df.withColumn("tokens", text.tokens(F.col("text")))
        ml = NGram(n=n, inputCol="tokens", outputCol="g").transform(split).select("label", F.explode("g")).collect()
        assert sorted(map(tuple, ours)) == sorted(map(tuple, ml))


def test_shorten_and_names(spark):
    df = spark.createDataFrame([("abcdef", 1, 0.9), ("abc", 0, 0.2)], "t string, label int, p double")
    rows = df.select(text.shorten(F.col("t"), 3).alias("s"), text.shorten(F.col("t"), 3, "").alias("bare"),
                     text.label_name(F.col("label")).alias("n"),
                     text.confidence(F.col("label"), F.col("p")).alias("c")).collect()
    assert [tuple(r) for r in rows] == [("abc...", "abc", "Positiv", 0.9), ("abc", "abc", "Negativ", 0.8)]


def test_unknown_scores_have_no_label(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "s int")
    assert [r[0] for r in df.select(text.sentiment_label(F.col("s"))).collect()] == [0, 1, None, None]


def test_row_digest_tells_fields_and_nulls_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "x"), ("", "x"), ("-", "x"), ("1:a", ""), ("a", "1:")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(row_digest(F.col("a"), F.col("b"))).distinct().count() == len(rows)


def test_hex_threshold():
    assert hex_threshold(0.25) == "40000000" and hex_threshold(0.8) == "cccccccc"
    assert hex_threshold(1 - 2**-40) == "ffffffff"
