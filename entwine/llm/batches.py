"""Shared plumbing of the text operators: Arrow slices, staged tables, prefix sums.

All text operators are `mapInArrow` over (id, text): one pass, no shuffle of texts. A batch is cut into slices of a few
MB of text, so that memory is bounded by the slice (or by the one longest text), never by the number of rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import shared_dir

SLICE_BYTES = 1 << 20
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows: texts of 100 kB would otherwise make batches of 1 GB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and the offset of each (n + 1). Null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in batches of about `limit` bytes of text; a longer text is alone in its batch."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for i, n in enumerate(size):
            if held and held + n > limit:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += int(n)
        if first < batch.num_rows:
            yield batch.slice(first)


class Stages:
    """Written tables of one query: they cut the lineage, are read as often as needed, and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def put(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        out = df.write.option("compression", "zstd")
        (out.partitionBy(partition_by) if partition_by else out).parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        found.__dict__["staged_at"] = path
        return found

    def drop(self, df: DataFrame | None) -> None:
        """Deletes a table that no later plan reads."""
        if df is not None and (path := df.__dict__.get("staged_at")):
            jvm = self.spark._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


BLOCK = 1024


def running_total(df: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of the group with a smaller `order` (a dense integer from 0).

    Two levels: rows of BLOCK consecutive orders are summed in one window partition, blocks are summed in another, so no
    task holds more than BLOCK rows of a group plus one row for each BLOCK of them.
    """
    df = df.withColumn("_block", F.floor(F.col(order) / BLOCK))
    before = Window.partitionBy(group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.groupBy(group, "_block").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(group, "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = df.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
    return inside.join(blocks, [group, "_block"]).withColumn(out, F.col("_before") + F.col("_inside")).drop("_before", "_inside", "_block")


SLOTS = 1 << 23


def slot_of(column: str):
    """A number below SLOTS for each key."""
    return F.pmod(F.xxhash64(column), F.lit(SLOTS)).cast("int")


def bitmap(keys: DataFrame, slot) -> bytes:
    """Of the slots of all rows: SLOTS / 8 bytes for any number of keys, gathered as at most SLOTS / 32 numbers.

    A first sieve before a join: it lets all wanted keys pass, and some others; the more keys, the more others.
    """
    words = keys.select(slot.alias("s")).groupBy(F.floor(F.col("s") / 32).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, s % 32)")).alias("bits"))
    out = np.zeros(SLOTS // 32, "<u4")
    found = words.toArrow()
    out[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    return out.tobytes()


def passes(slots: np.ndarray, bits: bytes) -> np.ndarray:
    return (np.frombuffer(bits, np.uint8)[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1
