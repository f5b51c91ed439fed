"""Scans and sinks of record tables, ground truth and result lists. Schemas are fixed; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(n, T.StringType()) for n in ("source1_entity_id", "matched_entity_ids")])
MATCHES, CANDIDATES = ("source1_entity_id", "matched_entity_ids"), ("source1_entity_id", "candidate_entity_ids")


def read_records(spark: SparkSession, path: str, quoted: bool = True, multiline: bool = False) -> DataFrame:
    """Tab-separated records with a header. quoted: the double quote quotes, doubled ones stand for one. Literal NA stays."""
    options = {"sep": "\t", "header": True, "encoding": "UTF-8", "multiLine": multiline, "quote": '"' if quoted else "", "escape": '"' if quoted else "\\"}
    found = spark.read.schema(RECORD).options(**options).csv(path)
    return found.na.fill("").withColumn("source", F.substring("entity_id", 1, 2))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Records by splitting lines at tabs, without quoting; lines of fewer than four fields are skipped."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where(F.size(parts) >= 4)
    return lines.select(*(F.get(parts, i).alias(f.name) for i, f in enumerate(RECORD))).where("entity_id <> 'entity_id'").withColumn("source", F.substring("entity_id", 1, 2))


def stream_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(RECORD).options(sep="\t", header=True, quote='"', escape='"').csv(path).na.fill("").withColumn("source", F.substring("entity_id", 1, 2))


RANGES, SAMPLE = 64, 4096


def ranked(records: DataFrame, by: list[str], order: str, out: str) -> DataFrame:
    """Adds `out`: the place (from 1) within `by`, in the order of the column `order`, which is unique there.

    No group is sorted in one task: RANGES ranges of `order`, cut by a sample of SAMPLE values that the driver holds, are
    ranked on their own, and each adds the number of rows in the ranges before it.
    """
    tries = records.select(F.col(order).alias("v")).where("v is not null").orderBy(F.xxhash64("v")).limit(SAMPLE)
    seen = sorted({r["v"] for r in tries.collect()})
    cuts = seen[:: max(1, len(seen) // RANGES)][1:]
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(order))) if cuts else F.lit(0)
    placed = records.withColumn("_range", F.when(F.col(order).isNull(), -1).otherwise(place))
    inside = placed.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_range").orderBy(order)))
    sizes = placed.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("_range").alias("_range2"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("_range") == F.col("_range2")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return inside.join(starts, same).withColumn(out, (F.col("_r") + F.col("_before")).cast("int")).drop("_range", "_range2", "_r", "_before", *(f"_{c}" for c in by))


def with_ordinal(records: DataFrame, order: str = "entity_id") -> DataFrame:
    """Adds ordinal: the place in source and country, by `order`. Caps and quotas depend on it, so it has to be explicit."""
    return ranked(records, ["source", "country"], order, "ordinal")


def only(records: DataFrame, ids: DataFrame) -> DataFrame:
    """The records whose entity_id is in `ids`."""
    return records.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")


def first_ids(spark: SparkSession, path: str) -> DataFrame:
    """The distinct first fields (entity_id) of a tab-separated file with a header; blank lines count for nothing."""
    one = F.trim(F.get(F.split("value", "\t"), 0)).alias("entity_id")
    lines = spark.read.text(path).select(one).where("entity_id <> ''")
    return lines.where(~F.col("entity_id").isin("entity_id", "source1_entity_id")).distinct()


def first_rows(records: DataFrame, n: int) -> DataFrame:
    """The n records of the smallest ids."""
    return records.orderBy("entity_id").limit(n)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return explode_lists(spark.read.schema(TRUTH).options(sep="\t", header=True).csv(path), *MATCHES)


def explode_lists(lists: DataFrame, id_col: str, list_col: str) -> DataFrame:
    """(s1_id, cand_id) of comma-separated lists; entries are trimmed, empty ones dropped."""
    one = F.explode(F.split(F.coalesce(F.col(list_col), F.lit("")), ",")).alias("cand_id")
    return lists.select(F.col(id_col).alias("s1_id"), one).select("s1_id", F.trim("cand_id").alias("cand_id")).where("cand_id <> ''")


def share_of(share: dict[str, int]) -> Column:
    """The share of the row's country; 0 where none is given."""
    return F.coalesce(F.create_map([F.lit(x) for kv in share.items() for x in kv])[F.col("country")], F.lit(0))


def first_of_each(records: DataFrame, share: dict[str, int], order: str = "entity_id") -> DataFrame:
    """The first rows of each country, as many as `share` says."""
    return ranked(records.where(share_of(share) > 0), ["country"], order, "_place").where(F.col("_place") <= share_of(share)).drop("_place")


def cohort(records: DataFrame, excluded: DataFrame, carried: DataFrame, share: dict[str, int]) -> DataFrame:
    """Carried ids, then the first others until each country has its share; never an excluded one."""
    free = records.join(excluded.select("entity_id").distinct(), "entity_id", "left_anti")
    marked = free.join(carried.select("entity_id", F.lit("0").alias("_later")).distinct(), "entity_id", "left").withColumn("_later", F.concat(F.coalesce("_later", F.lit("1")), "entity_id"))
    placed = ranked(marked, ["country"], "_later", "_place")
    return placed.where(F.col("_later").startswith("0") | (F.col("_place") <= share_of(share))).drop("_place", "_later")


def target_pool(targets: DataFrame, needed: DataFrame, distractors: int) -> DataFrame:
    """Needed targets, and the first others of each source."""
    ids = needed.select("entity_id").distinct()
    others = ranked(targets.join(ids, "entity_id", "left_anti"), ["source"], "entity_id", "_place").where(F.col("_place") <= distractors).drop("_place")
    return targets.join(ids, "entity_id", "left_semi").unionByName(others)


def spine_lists(s1: DataFrame, pairs: DataFrame, list_col: str) -> DataFrame:
    """One row for each S1 id, its sorted distinct candidates as a comma list, empty where it has none."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("cand_id")), ",").alias(list_col))
    return s1.select(F.col("entity_id").alias("source1_entity_id")).join(lists, F.col("source1_entity_id") == F.col("s1_id"), "left").select("source1_entity_id", F.coalesce(list_col, F.lit("")).alias(list_col))


def write_lists(lists: DataFrame, path: str) -> None:
    """Sorted by id, with a header, singletons as an id and a tab. One file per range of ids."""
    lists.orderBy("source1_entity_id").write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote="").csv(path)


def pad(lists: DataFrame, s1: DataFrame) -> DataFrame:
    """A snapshot of unfinished results: one row for each S1 record, with an empty list where it has none yet."""
    key, column = lists.columns
    spine = s1.select(F.col("entity_id").alias(key)).distinct()
    return spine.join(lists, key, "left").select(key, F.coalesce(column, F.lit("")).alias(column))


def write_features(table: DataFrame, path: str) -> None:
    """Feature matrices are Parquet tables: ids, label and one column a feature, in order."""
    table.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_features(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The table, if it has the features in this order."""
    found = spark.read.parquet(path)
    if [c for c in found.columns if c in set(names)] != list(names):
        raise ValueError("the table's features are others, or in another order")
    return found


def write_report(frames: dict[str, DataFrame], path: str) -> None:
    """One folder of JSON lines for each metrics table."""
    for name, frame in frames.items():
        frame.coalesce(1).write.mode("overwrite").json(f"{path}/{name}")
