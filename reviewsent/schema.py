"""Schemas of the stage tables and the names shown for labels."""

from pyspark.sql import types as T

# raw reviews: Score 1 = negative, 2 = positive
REVIEWS = T.StructType([
    T.StructField("Score", T.IntegerType()),
    T.StructField("Summary", T.StringType()),
    T.StructField("Text", T.StringType()),
])

CLEANED = T.StructType([
    T.StructField("label", T.IntegerType()),
    T.StructField("summary", T.StringType()),
    T.StructField("text", T.StringType()),
])

# what scoring writes and the evaluation reads
PREDICTIONS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("prob_positive", T.DoubleType()),
    T.StructField("text", T.StringType()),
])

CLASSES = (0, 1)

# Names shown for the classes and for the kinds of example.
NEGATIVE, POSITIVE = "Negativ", "Positiv"
CORRECT_NEGATIVE, CORRECT_POSITIVE, WRONG = "Richtig Negativ", "Richtig Positiv", "Falsch"
