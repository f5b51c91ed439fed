"""Labels, entity split, hardness, negative sampling, integrity checks, hard examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What a rule adds to the hardness of a negative pair (compact and suffix names share one).
RULE_BONUS = [
    (("blocked_exact_name",), 8), (("blocked_compact_name", "blocked_suffix_name"), 6), (("blocked_translit",), 5), (("blocked_consonant_skeleton",), 4),
    (("blocked_postal",), 4), (("blocked_house",), 3), (("blocked_address_name_combo",), 3), (("blocked_address_token",), 2),
]


def digest(*columns: str | Column) -> Column:
    """A text that orders rows at random, the same in every engine."""
    return F.md5(F.concat_ws("|", *columns))


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds label: 1 where the pair is in truth (s1_id, cand_id)."""
    known = truth.select("s1_id", "cand_id").distinct().withColumn("_y", F.lit(1))
    return pairs.join(known, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("_y", F.lit(0))).drop("_y")


def split(ids: DataFrame, id_col: str = "s1_id", seed: int = 42, percent: int = 80) -> DataFrame:
    """Adds part: train or validation, by a digest of the id; an entity is never in both."""
    bucket = F.conv(F.substring(digest(F.lit(str(seed)), id_col), 1, 6), 16, 10).cast("long") % 100
    return ids.withColumn("part", F.when(bucket < percent, "train").otherwise("validation"))


def hardness(x: str = "x", y: str = "y", rules: str = "rules") -> Column:
    """How misleading a negative pair is: agreeing rules, names, postal codes, house numbers. x, y: prepared records."""
    has = lambda names: F.arrays_overlap(F.col(rules), F.array(*map(F.lit, names)))
    n1 = F.col(f"{x}.norm")
    n2 = F.when(F.col(f"{y}.has_indic"), F.col(f"{y}.trans")).otherwise(F.col(f"{y}.norm"))
    out = 2.0 * F.size(rules)
    for names, bonus in RULE_BONUS:
        out += F.when(has(names), float(bonus)).otherwise(0.0)
    alike = F.when((n1 == "") | (n2 == ""), 0.0).when(n1 == n2, 5.0).when((F.length(n1) >= 3) & (F.length(n2) >= 3) & (F.substring(n1, 1, 3) == F.substring(n2, 1, 3)), 2.0).otherwise(0.0)
    agree = lambda c, v: F.when((F.col(f"{x}.{c}") != "") & (F.lower(f"{x}.{c}") == F.lower(f"{y}.{c}")), v).otherwise(0.0)
    return out + alike + agree("postal", 3.0) + agree("house", 2.0)


def sample_negatives(labelled: DataFrame, times: float = 4.0, seed: int = 42) -> DataFrame:
    """All positives; of each S1's negatives a budget (four for each positive, 2 to 25; 3 without positives), four fifths
    of it the hardest, the rest by digest. labelled: s1_id, cand_id, label, hardness."""
    per = labelled.groupBy("s1_id").agg(F.sum("label").alias("_p"), F.sum(1 - F.col("label")).alias("_n"))
    budget = F.when(F.col("_p") > 0, F.least("_n", F.greatest(F.lit(2), F.least(F.lit(25), F.floor(F.col("_p") * times))))).otherwise(F.least("_n", F.lit(3)))
    negatives = labelled.where("label = 0").join(per.withColumn("_b", budget).withColumn("_h", F.floor(F.col("_b") * 0.8)), "s1_id")
    hard = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("hardness"), "cand_id"))
    ranked = negatives.withColumn("_r", hard)
    rest = F.row_number().over(Window.partitionBy("s1_id", F.col("_r") <= F.col("_h")).orderBy(digest(F.lit(str(seed)), "s1_id", "cand_id")))
    kept = ranked.withColumn("_q", rest).where((F.col("_r") <= F.col("_h")) | (F.col("_q") <= F.col("_b") - F.col("_h")))
    return labelled.where("label = 1").unionByName(kept.select(labelled.columns))


RATIOS = (1.0, 2.0, 3.0, 4.0, 5.0)


def ratio_table(labelled: DataFrame, ratios: tuple[float, ...] = RATIOS) -> DataFrame:
    """ratio, positives, negatives, total, per_positive, positive_pct: what each ratio of negatives to positives would keep
    (two negatives at least for an S1 with positives), and all negatives as ratio 0."""
    per = labelled.groupBy("s1_id").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    grid = F.explode(F.array(*map(F.lit, (0.0, *map(float, ratios))))).alias("ratio")
    wanted = F.when(F.col("ratio") == 0, F.col("n")).when(F.col("p") > 0, F.greatest(F.lit(2), F.floor(F.col("p") * F.col("ratio")))).otherwise(F.floor("ratio"))
    sums = per.select("p", "n", grid).groupBy("ratio").agg(F.sum("p").alias("positives"), F.sum(F.least("n", wanted)).alias("negatives"))
    total = F.col("positives") + F.col("negatives")
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return sums.select("ratio", "positives", "negatives", total.alias("total"), div(F.col("negatives"), F.col("positives")).alias("per_positive"), div(100 * F.col("positives"), total).alias("positive_pct"))


def sampling_statistics(s1: DataFrame, labelled: DataFrame, sampled: DataFrame) -> DataFrame:
    """what, mean, median, p95, most, none: of the positives, negatives, sampled negatives and candidates of an S1 record."""
    count = lambda df, name: df.groupBy("s1_id").agg(F.count("*").alias(name))
    counts = {"positives": labelled.where("label = 1"), "negatives": labelled.where("label = 0"), "sampled_negatives": sampled.where("label = 0"), "candidates": labelled}
    full = s1.select(F.col("entity_id").alias("s1_id"))
    for name, df in counts.items():
        full = full.join(count(df, name), "s1_id", "left")
    rows = full.na.fill(0).select(F.explode(F.array(*(F.struct(F.lit(n).alias("what"), F.col(n).alias("n")) for n in counts))).alias("e")).select("e.*")
    return rows.groupBy("what").agg(F.avg("n").alias("mean"), F.expr("percentile(n, 0.5)").alias("median"), F.expr("percentile(n, 0.95)").alias("p95"), F.max("n").alias("most"), F.sum((F.col("n") == 0).cast("long")).alias("none"))


def integrity(labelled: DataFrame, truth: DataFrame, features: list[str] = ()) -> DataFrame:
    """check, violations: positives outside truth, negatives in truth, entities in both parts, wrong targets, self pairs,
    non-finite features. labelled: s1_id, cand_id, label, part, features."""
    known = truth.select("s1_id", "cand_id").distinct()
    positive, negative = labelled.where("label = 1"), labelled.where("label = 0")
    count = lambda df, name: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
    bad = F.lit(False)
    for f in features:
        bad |= F.isnan(f) | F.col(f).isNull() | (F.abs(F.col(f)) == float("inf"))
    checks = [
        count(positive.join(known, ["s1_id", "cand_id"], "left_anti"), "positives_in_truth"), count(negative.join(known, ["s1_id", "cand_id"], "left_semi"), "negatives_not_in_truth"),
        count(labelled.groupBy("s1_id").agg(F.count_distinct("part").alias("n")).where("n > 1"), "no_split_overlap"), count(labelled.where(~F.col("cand_id").rlike("^S[23]-")), "target_prefix"),
        count(labelled.where("s1_id = cand_id"), "no_self_pair"), count(labelled.where(bad), "finite_features"),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


# The masks below and their thresholds.


def hard_masks(table: DataFrame) -> DataFrame:
    """Adds the six masks of hard positives, the seven of hard negatives, hard_positive and hard_negative."""
    c = F.col
    pos, neg = c("label") == 1, c("label") == 0
    positive = {
        "hp_missing_address": c("candidate_address_missing") == 1, "hp_divergent_address": (c("candidate_address_missing") == 0) & (c("address_token_jaccard") < 0.35),
        "hp_low_name": (c("name_normalized_levenshtein") < 0.65) | (c("name_token_sort_ratio") < 0.65), "hp_cross_script": c("is_cross_script") == 1,
        "hp_translit": (c("name_has_transliteration") == 1) & (c("name_translit_normalized_levenshtein") < 0.75),
        "hp_missing_codes": (c("postal_missing_either") == 1) & (c("house_missing_either") == 1) & (c("name_normalized_levenshtein") < 0.85),
    }
    negative = {
        "hn_homonym": c("name_exact_diff_address") == 1, "hn_missing_address": (c("name_normalized_levenshtein") >= 0.85) & (c("candidate_address_missing") == 1),
        "hn_same_postal": c("same_postal_and_high_name_sim") == 1, "hn_same_house": c("same_house_and_high_name_sim") == 1,
        "hn_cross_script": (c("is_cross_script") == 1) & (c("name_translit_normalized_levenshtein") >= 0.8), "hn_many_rules": (c("num_blocking_rules") >= 3) & (c("address_token_jaccard") < 0.3),
        "hn_same_tokens": (c("name_token_sort_ratio") >= 0.85) & (c("address_token_jaccard") < 0.2) & (c("candidate_address_missing") == 0),
    }
    out = table.withColumns({k: pos & v for k, v in positive.items()} | {k: neg & v for k, v in negative.items()})
    any_of = lambda names: F.greatest(*(c(n).cast("int") for n in names)) == 1
    return out.withColumns({"hard_positive": any_of(positive), "hard_negative": any_of(negative)})


def enriched(table: DataFrame, negatives: bool = False) -> DataFrame:
    """The table with its hard positives (and negatives) a second time."""
    marked = hard_masks(table)
    again = marked.where(F.col("hard_positive") | (F.col("hard_negative") if negatives else F.lit(False)))
    return table.unionByName(again.select(table.columns))
