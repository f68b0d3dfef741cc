"""A scorer without training: positive and negative words from the word ratios.

The evaluation operators take any predictions. This scorer gives them probabilities
that a SQL query can compute as well, which MLlib's weights do not.
"""

from pyspark.sql import Column, DataFrame, functions as F

from reviewsent.functions.text import in_list
from reviewsent.operators.words import top_ratio


def sentiment_lexicon(ratio: DataFrame, size: int = 100) -> tuple[list[str], list[str]]:
    """Up to ``size`` words of highest and of lowest ratio, at most half of all words each.

    The lists are part of the plan that scores, so they come to the driver: at most
    ``2 * size`` words.
    """
    count = ratio.agg(F.count("*")).scalar()
    rows = top_ratio(ratio, size).withColumn("total", count).collect()
    keep = min(size, rows[0]["total"] // 2) if rows else 0
    lists = {"positive": [], "negative": []}
    for row in rows:
        if row["position"] <= keep:
            lists[row["direction"]].append(row["word"])
    return lists["positive"], lists["negative"]


def lexicon_predictions(reviews: DataFrame, positive: list[str], negative: list[str]) -> DataFrame:
    """``(doc_id, label, prediction, prob_positive, text)``, each text scored in its own row.

    Probability = positive hits / all hits, 0.5 without a hit. The lists have no word in
    common. All tokens are looked up once, the few hits a second time.
    """
    def listed(words: str, words_in: list[str]) -> Column:
        return F.expr(f"filter({words}, w -> {in_list('w', words_in)})")

    counted = (reviews.select("doc_id", "label", "text", listed("split(text, ' ')", positive + negative).alias("_hits"))
               .withColumn("_pos", F.size(listed("_hits", positive))).withColumn("_all", F.size("_hits")))
    scored = counted.withColumn(
        "prob_positive", F.when(F.col("_all") > 0, F.col("_pos") / F.col("_all")).otherwise(F.lit(0.5)))
    prediction = F.when(F.col("prob_positive") > 0.5, 1.0).otherwise(0.0)
    return scored.select("doc_id", "label", prediction.alias("prediction"), "prob_positive", "text")
