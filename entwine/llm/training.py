"""Bounded training samples for the classifiers: the only rows that ever reach the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


LABELS = 64  # classes that a sample may hold; rarer ones are never learned


def remainder(id_column: Column, m: int) -> Column:
    """crc32(id as text) mod m; null ids count as remainder 0."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % m, F.lit(0)).cast("int")


def sample(rows: DataFrame, label: str, order: str, most: int) -> DataFrame:
    """Of each of the at most LABELS most frequent labels, the `most` rows that come first in the order of a hash: a bounded
    sample that is the same for any partitioning. One top-k for each label, so no label is gathered in one task."""
    kinds = [r[label] for r in rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(LABELS).collect()]
    out = None
    for kind in kinds:
        part = rows.where(F.col(label) == F.lit(kind)).orderBy(F.xxhash64(order), order).limit(most)
        out = part if out is None else out.unionByName(part)
    return rows.limit(0) if out is None else out
