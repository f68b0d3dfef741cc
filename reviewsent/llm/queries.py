"""One query per operator, with production parameters, over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewsent.llm import (divergence, fill_middle, langid, minhash, oracle, packing, pieces, pii, pitman_yor, projections,
                            quality, suffix_dedup, token_files, urls)
from reviewsent.sources.shared import new_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_array_dedup(spark, folder):
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"), keep_text=False).drop("kept")


def op2_best_fit_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"), with_ids=False).drop("ids")


def op3_quality_rules(spark, folder):
    return quality.judge_quality(table(spark, folder, "documents")).drop("class_distance", "word_distance")


def op4_language_id(spark, folder):
    return langid.identify_language(table(spark, folder, "documents"))


def op5_pii_semi_crf(spark, folder):
    return pii.find_personal_data(table(spark, folder, "documents"))


def op6_url_filter(spark, folder):
    return urls.judge_urls(table(spark, folder, "pages"))


def op7_sentencepiece(spark, folder):
    """Ids and, decoded from them, the digest of the text they stand for."""
    found = pieces.encode_documents(table(spark, folder, "documents"))
    back = F.sha2(F.encode(pieces.decode_ids(F.col("ids"), pieces.Pieces()), "utf-8"), 256)
    return found.select("doc_id", "n_tokens", "ids_crc32", "text_sha256", back.alias("decoded_sha256"))


def op8_collision_projections(spark, folder):
    return projections.group_vectors(table(spark, folder, "embeddings"))


def op9_minhash_near_dedup(spark, folder):
    return minhash.group_copies(table(spark, folder, "documents"))


def op10_pitman_yor(spark, folder):
    return pitman_yor.score_documents(table(spark, folder, "documents"))


def op11_source_divergence(spark, folder):
    return divergence.audit_sources(table(spark, folder, "documents"))


def op12_token_files(spark, folder):
    path = new_path(spark, "token_ids")
    token_files.write_ids(table(spark, folder, "documents"), path)
    return token_files.read_ids(spark, path, with_ids=False).drop("ids")


def op13_fill_in_middle(spark, folder):
    found = fill_middle.fill_in_middle(table(spark, folder, "documents"))
    digest = lambda text: F.sha2(F.encode(text, "utf-8"), 256)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                        digest(back).alias("restored_sha256"))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_suffix_array_dedup, op2_best_fit_packing, op3_quality_rules, op4_language_id, op5_pii_semi_crf, op6_url_filter,
    op7_sentencepiece, op8_collision_projections, op9_minhash_near_dedup, op10_pitman_yor, op11_source_divergence,
    op12_token_files, op13_fill_in_middle)}
ORACLE: dict[str, str] = {"op3_quality_rules": oracle.quality_sql(), "op11_source_divergence": oracle.divergence_sql(),
                          "op13_fill_in_middle": oracle.fill_middle_sql()}
