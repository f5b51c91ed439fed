"""The whole run as one lazy plan: prepare, block, quota, features, score, lists. Only prepared records and candidate
pairs are materialised: as tables where a work folder is given, else as cached blocks that may spill to disk."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, features
from ..operators.prepare import prepare
from ..sources.records import CANDIDATES, MATCHES, spine_lists, with_ordinal


@dataclass
class Config:
    """mode: offline (union of bucket-capped rules), online or preflight; order: ordinal repeats file order within quotas,
    ranked prefers pairs with more rules. ngram: add TF-IDF neighbours (offline mode). ascii_words: see `text.edges`. nulls: see
    `prepare`."""

    mode: str = "offline"
    groups: tuple[str, ...] = blocking.DEFAULT_GROUPS
    ngram: bool = False
    limits: dict[str, int] = field(default_factory=lambda: {"S2": 60, "S3": 90})
    order: str = "ranked"
    threshold: float = 0.72
    work: str | None = None
    ascii_words: bool = False
    nulls: bool = False


def rule_score(table: DataFrame) -> DataFrame:
    """A scorer without training: seven tenths token overlap of names, three tenths an equal postal code or house number."""
    code = F.greatest("postal_code_exact", "house_number_exact").cast("double")
    return table.withColumn("prob", F.round(0.7 * F.col("name_token_jaccard").cast("double") + 0.3 * code, 6))


class Pipeline:
    def __init__(self, spark: SparkSession, config: Config | None = None, scorer: Callable[[DataFrame], DataFrame] = rule_score):
        self.spark, self.config, self.scorer = spark, config or Config(), scorer

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        if not self.config.work:
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        path = f"{self.config.work}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def candidates(self, s1: DataFrame, targets: DataFrame) -> DataFrame:
        """s1_id, cand_id, rules, within the quotas. s1, targets: prepared records."""
        c = self.config
        if c.mode == "offline" and c.order == "ranked":
            return self._ranked(s1, targets)
        orders = targets if "ordinal" in targets.columns else with_ordinal(targets)
        if c.mode == "offline":
            pairs = blocking.block(s1, targets, c.groups).select("s1_id", "cand_id", "evidence")
            if c.ngram:
                near = blocking.ngram_neighbours(s1, targets).select("s1_id", "cand_id", F.lit("blocked_char_ngram").alias("evidence"))
                pairs = pairs.unionByName(near)
            pairs = pairs.join(orders.select(F.col("entity_id").alias("cand_id"), "source", "ordinal"), "cand_id")
        else:
            pairs = blocking.block_online(s1, orders, c.mode)
        order = ("-rules", "cand_id") if c.order == "ranked" else ("ordinal", "cand_id")
        return blocking.quota(pairs, c.limits, order).select("s1_id", "cand_id", "rules")

    def _ranked(self, s1: DataFrame, targets: DataFrame) -> DataFrame:
        """Offline pairs in the order of evidence. All rows of an S1 record meet in one task, by one shuffle, which serves the
        union of rules and the quota after it; the source is that of the id, as in `prepare`, and no ordinal is joined."""
        rows = blocking.block(s1, targets, self.config.groups, once=False).select("s1_id", "cand_id", "evidence")
        if self.config.ngram:
            rows = rows.unionByName(blocking.ngram_neighbours(s1, targets).select("s1_id", "cand_id", F.lit("blocked_char_ngram").alias("evidence")))
        rows = rows.repartition("s1_id").withColumn("source", F.substring("cand_id", 1, 2))
        return blocking.quota(rows, self.config.limits, ("-rules", "cand_id")).select("s1_id", "cand_id", "rules")

    def run(self, records: DataFrame) -> tuple[DataFrame, DataFrame]:
        """matches and candidates, one row for each S1 record. records: entity_id, business_name, business_address, country."""
        ready = self._kept(prepare(records, self.config.ascii_words, self.config.nulls), "prepared")
        s1, targets = ready.where("source = 'S1'"), ready.where("source <> 'S1'")
        pairs = self._kept(self.candidates(s1, targets), "pairs")
        scored = self.scorer(features.features(pairs, s1, targets))
        hits = scored.where(F.col("prob") >= self.config.threshold)
        return spine_lists(s1, hits, MATCHES[1]), spine_lists(s1, pairs, CANDIDATES[1])
