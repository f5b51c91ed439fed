"""New targets against a fixed S1 table: each micro-batch is blocked, scored and appended; a fingerprint of the settings is
kept with the output, so a run with other settings does not continue it."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import features
from ..operators.prepare import prepare
from ..plans.pipeline import Pipeline


def fingerprint(pipeline: Pipeline) -> str:
    return hashlib.sha256(json.dumps(asdict(pipeline.config), sort_keys=True, default=list).encode()).hexdigest()


def guard(spark: SparkSession, out: str, print_: str) -> None:
    """Writes the settings' fingerprint beside the output, or raises where another one is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/_settings")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        there = spark.read.text(f"{out}/_settings").first()["value"]
        if there != print_:
            raise ValueError("the output was begun with other settings")
        return
    spark.createDataFrame([(print_,)], "value string").coalesce(1).write.text(f"{out}/_settings")


def match_stream(pipeline: Pipeline, s1: DataFrame, targets: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """targets: a stream of records. Scored pairs go to out/pairs, partitioned by batch; a repeated batch overwrites its
    own partition, so a restart neither loses nor doubles rows."""
    spark = s1.sparkSession
    guard(spark, out, fingerprint(pipeline))
    fixed = prepare(s1)

    def each(batch: DataFrame, number: int) -> None:
        ready = prepare(batch.drop("source"))
        pairs = pipeline.candidates(fixed, ready)
        scored = pipeline.scorer(features.features(pairs, fixed, ready)).select("s1_id", "cand_id", "prob", F.lit(number).alias("batch"))
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/pairs")

    writer = targets.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
