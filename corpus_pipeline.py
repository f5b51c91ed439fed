"""Corpus pipeline: quality, language, near-duplicates, packing. Each stage is one operator of entwine.llm.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and reread as the next one's docs. All but the last return the columns of documents.

Defined results: a text of score under QUALITY goes, empty and null texts with it (nothing can be learned from them); a
text whose language is `und`, is not wanted, or fills less than SHARE of the text's words by the random field's
marginals goes (foreign, mixed or unreadable text; by default every learned language is wanted); of each group of near-copies the smallest doc_id stays, repeated rows of one doc_id
stay once, rows with a null doc_id stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwine.llm import language, minmax, packing, quality
from entwine.llm.batches import Stages, bounded_batches, slices
from entwine.llm.training import remainder

QUALITY = 0.7  # as in the query of the classifier
SHARE = 0.4  # least mean marginal of a text's language: texts in two languages stay
WANTED: frozenset[str] | None = None  # languages to keep; None: all learned ones


def kept(docs: DataFrame, keep) -> DataFrame:
    """The rows of docs, all columns, where keep(batch) is true; batches are small slices."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=1 << 18):
            yield b.filter(pa.array(keep(b), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the convolutional network holds for good; it learns from the labelled documents of sf_dir."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = remainder(F.col("doc_id"), 4) != 2
    model = spark.sparkContext.broadcast(quality.train(docs.where(learn), labels.where(learn), "quality"))
    tables: dict[str, np.ndarray] = {}

    def keep(b: pa.RecordBatch) -> np.ndarray:
        if "pairs" not in tables:
            tables["pairs"] = model.value.pair_tables()
        full = pc.fill_null(pc.greater(pc.binary_length(b.column("text")), 0), False).to_numpy(zero_copy_only=False)
        return full & (quality.scores(*quality.utf8(b.column("text")), model.value, tables["pairs"]) >= QUALITY)

    return kept(docs, keep)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: frozenset[str] | None = WANTED, share: float = SHARE) -> DataFrame:
    """Texts in a wanted language, as the random field labels their words. It learns from the labelled rows it is given."""
    model = spark.sparkContext.broadcast(language.train(docs.where(remainder(F.col("doc_id"), 4) != 2), "doc_id", "text", "lang"))

    def keep(b: pa.RecordBatch) -> list[bool]:
        names, scores = language.labelled(b, model.value)
        return [name != language.UNDETERMINED and (wanted is None or name in wanted) and score >= share for name, score in zip(names, scores, strict=True)]

    return kept(docs, keep)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: five-word shingles, similarity 0.8 and more."""
    judged = minmax.near_duplicates(docs, width=5, percent=80)
    gone = Stages(spark, "dedup").put(judged.where("not kept").select("doc_id").distinct())
    named = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"]).select(docs.columns)
    return named.unionByName(docs.where("doc_id is null"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, size=2048)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", dedup_stage), ("packing", packing_stage)]

#: Trained stages, which SQL cannot express; tests/llm holds the whole pipeline against the operators and a plain grouping.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = Stages(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = stages.put(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
