"""The registered queries of this folder: thin digests over the operators, on whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, language, media, minmax, nndescent, packing, quality, token_counts, toxicity, url_filter
from .training import remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the rows whose crc32 remainder by 4 is not 2; predicts for all."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(remainder(F.col("doc_id"), 4) != 2), "doc_id", "text", "lang")
    found = language.identify(docs, model)
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op2_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in windows of 2048 tokens that each hold the sources in the corpus's proportions."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, size=2048)


def op3_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


# The rules of the query, as verdict and rule.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op4_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op6_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the labelled rows whose crc32 remainder by 4 is not 2; scores all."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = remainder(F.col("doc_id"), 4) != 2
    model = quality.train(docs.where(learn), labels.where(learn), "quality")
    found = quality.classify(docs, model, threshold=0.7)
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op7_toxicity_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the labelled rows whose crc32 remainder by 5 is not 0; scores all."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = remainder(F.col("doc_id"), 5) != 0
    model = toxicity.train(docs.where(learn), labels.where(learn), "toxic")
    found = toxicity.classify(docs, model)
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest other vectors of every vector whose id is divisible by 100."""
    return nndescent.neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the digest of what they decode to."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_and_read(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_crf, op2_mixture_packing, op3_minmax_near_duplicates, op4_url_vocabulary, op5_token_counts, op6_quality_cnn, op7_toxicity_weak, op8_nn_descent, op9_byte_bpe, op10_media_chunks)}


def oracle_sql() -> dict[str, str]:
    return {"op4_url_vocabulary": url_filter.sql(URL_RULES)}
