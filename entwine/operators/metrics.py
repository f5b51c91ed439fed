"""Blocking and matching metrics, sweeps, taxonomies, summaries: grouped counts, nothing collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SWEEP = [round(0.05 * i, 2) for i in range(1, 20)]
FINE_SWEEP = [round(0.5 + 0.02 * i, 2) for i in range(23)]


def f05(tp: Column, predicted: Column, true: Column) -> Column:
    """Empty truth: 1 without predictions, else 0. Without common ids: 0."""
    p, r = tp / predicted, tp / true
    return F.when((true == 0) & (predicted == 0), 1.0).when((true == 0) | (predicted == 0) | (tp == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def volumes(s1: DataFrame, targets: DataFrame, pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: pairs, mean, median, p95 and most candidates of an S1, reduction, recall over all and by script."""
    counts = s1.select(F.col("entity_id").alias("s1_id")).join(pairs.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    a = counts.agg(F.sum("n").alias("pairs"), F.avg("n").alias("mean_candidates"), F.expr("percentile(n, 0.5)").alias("median_candidates"), F.expr("percentile(n, 0.95)").alias("p95_candidates"), F.max("n").alias("max_candidates"), F.count("*").alias("n_s1"))
    links = truth.join(pairs.select("s1_id", "cand_id").distinct().withColumn("_hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    b = links.agg(F.count("*").alias("links"), F.count("_hit").alias("found"))
    c = targets.agg(F.count("*").alias("n_targets"))
    joined = a.crossJoin(b).crossJoin(c)  # three single rows
    return joined.select("pairs", "mean_candidates", "median_candidates", "p95_candidates", "max_candidates", (1 - F.col("pairs") / (F.col("n_s1") * F.col("n_targets"))).alias("reduction"), "links", "found", F.when(F.col("links") > 0, F.col("found") / F.col("links")).otherwise(0.0).alias("recall"))


def recall_by(truth: DataFrame, pairs: DataFrame, s1: DataFrame, by: str = "country") -> DataFrame:
    hits = truth.join(pairs.select("s1_id", "cand_id").distinct().withColumn("_hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    return hits.join(s1.select(F.col("entity_id").alias("s1_id"), by), "s1_id").groupBy(by).agg(F.count("*").alias("links"), F.sum(F.coalesce("_hit", F.lit(0))).alias("found")).withColumn("recall", F.col("found") / F.col("links"))


def per_entity(s1: DataFrame, scored: DataFrame, truth: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold, s1_id, country, predicted, true, tp, f05, for every S1 of the spine. scored: s1_id, cand_id, prob.

    A pair is predicted at the thresholds up to its score: it is exploded to these, then counted."""
    grid = F.array(*map(F.lit, thresholds))
    marked = scored.join(truth.select("s1_id", "cand_id").distinct().withColumn("_y", F.lit(1)), ["s1_id", "cand_id"], "left")
    hits = marked.select("s1_id", F.coalesce("_y", F.lit(0)).alias("y"), F.explode(F.filter(grid, lambda t: t <= F.col("prob"))).alias("threshold"))
    counted = hits.groupBy("s1_id", "threshold").agg(F.count("*").alias("predicted"), F.sum("y").alias("tp"))
    true = truth.select("s1_id", "cand_id").distinct().groupBy("s1_id").agg(F.count("*").alias("true"))
    spine = s1.select(F.col("entity_id").alias("s1_id"), "country", F.explode(grid).alias("threshold")).join(true, "s1_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    full = spine.join(counted, ["s1_id", "threshold"], "left").select("threshold", "s1_id", "country", zero("predicted").alias("predicted"), zero("true").alias("true"), zero("tp").alias("tp"))
    return full.withColumn("f05", f05(F.col("tp"), F.col("predicted"), F.col("true")))


def sweep(entities: DataFrame, *by: str) -> DataFrame:
    """Of `per_entity`, by threshold (and `by`): macro F0.5, pair precision and recall and F1, singleton accuracy, mean
    predictions, entities with a false positive."""
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    one = F.col("true") == 0
    sums = entities.groupBy("threshold", *by).agg(
        F.avg("f05").alias("macro_f05"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("true").alias("true"), F.avg("predicted").alias("mean_predicted"),
        F.sum(one.cast("long")).alias("singletons"), F.sum((one & (F.col("predicted") == 0)).cast("long")).alias("singletons_right"), F.sum((F.col("predicted") > F.col("tp")).cast("long")).alias("entities_with_fp"),
    )
    p, r = div(F.col("tp"), F.col("predicted")), div(F.col("tp"), F.col("true"))
    return sums.select("threshold", *by, "macro_f05", p.alias("precision"), r.alias("recall"), div(2 * p * r, p + r).alias("f1"), div(F.col("singletons_right"), F.col("singletons")).alias("singleton_accuracy"), "mean_predicted", "entities_with_fp")


def best(swept: DataFrame) -> DataFrame:
    """The threshold of the highest macro F0.5, the smallest of equals."""
    return swept.orderBy(F.desc("macro_f05"), "threshold").limit(1)


def ceiling(s1: DataFrame, pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Macro F0.5 of a perfect classifier on the candidates."""
    right = pairs.select("s1_id", "cand_id").distinct().join(truth.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"], "left_semi").withColumn("prob", F.lit(1.0))
    return per_entity(s1, right, truth, [1.0]).agg(F.avg("f05").alias("ceiling"), F.count("*").alias("n_s1"))


def summary(table: DataFrame, column: str, *by: str) -> DataFrame:
    """count, mean, standard deviation (population), least, deciles and quartiles, most."""
    p = {f"p{q}": F.expr(f"percentile({column}, {q / 100})") for q in (10, 25, 50, 75, 90)}
    return table.groupBy(*by).agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"), F.min(column).alias("least"), *(v.alias(k) for k, v in p.items()), F.max(column).alias("most"))


def chain(cases: list[tuple[str, Column]], other: str) -> Column:
    out = None
    for name, test in cases:
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(other)


# The classes below, their order and thresholds.


def false_positive_class() -> Column:
    c = F.col
    name, address = c("name_levenshtein_ratio"), c("address_levenshtein_ratio")
    return chain([
        ("missing_address", c("either_address_missing") == 1), ("commercial_homonym_franchise", (c("name_exact_diff_address") == 1) | ((c("name_exact") == 1) & (address < 0.35))),
        ("same_house_diff_biz", (c("house_number_exact") == 1) & (name < 0.7)), ("same_postal_diff_biz", (c("postal_code_exact") == 1) & (name < 0.7)), ("cross_script_false_match", c("is_cross_script") == 1),
        ("generic_company_name", (c("name_token_jaccard") >= 0.75) & (name < 0.85)), ("similar_name_wrong_address", (name >= 0.85) & (address < 0.5)),
    ], "other_marginal_false_merges")


def false_negative_class() -> Column:
    c = F.col
    name, address = c("name_levenshtein_ratio"), c("address_levenshtein_ratio")
    house, postal = c("house_missing_either") == 1, c("postal_missing_either") == 1
    return chain([
        ("missing_address", c("either_address_missing") == 1), ("cross_script_translit_divergence", (c("is_cross_script") == 1) & (c("name_translit_levenshtein_ratio") < 0.8)), ("low_address_similarity", (address < 0.4) & (name >= 0.8)),
        ("low_name_similarity_dba", name < 0.65), ("legal_suffix_variation", (c("name_nosuff_exact") == 1) & ((address < 0.65) | house)), ("missing_house_number", house & (address < 0.6)),
        ("missing_postal_code", postal & (address < 0.6)), ("typo_ocr_variation", (name >= 0.65) & (name < 0.82)),
    ], "other_marginal_confidence_drop")


def errors(table: DataFrame, threshold: float) -> DataFrame:
    """kind (fp, fn), category, n. table: features with label and prob."""
    fp, fn = (F.col("label") == 0) & (F.col("prob") >= threshold), (F.col("label") == 1) & (F.col("prob") < threshold)
    return table.where(fp | fn).select(F.when(fp, "fp").otherwise("fn").alias("kind"), F.when(fp, false_positive_class()).otherwise(false_negative_class()).alias("category")).groupBy("kind", "category").agg(F.count("*").alias("n"))


def miss_class(x: str = "x", y: str = "y") -> Column:
    """Why blocking missed a true link, first reason that fits. x, y: prepared records."""
    from ..functions import similarity as S
    from ..functions import text as X

    a, b = (lambda k: F.col(f"{x}.{k}")), (lambda k: F.col(f"{y}.{k}"))
    cross = a("has_indic") != b("has_indic")
    n2 = F.when(cross, b("trans")).otherwise(b("norm"))
    s1, s2 = a("nosuff"), X.remove_legal(n2)
    name = S.levenshtein_similarity(a("norm"), n2)
    t1, t2 = F.array_sort(F.array_distinct(X.tokens(a("norm")))), F.array_sort(F.array_distinct(X.tokens(n2)))
    d1, d2 = F.array_distinct(X.tokens(a("address"))), F.array_distinct(X.tokens(b("address")))
    house = F.lower(a("house"))
    return chain([
        ("missing_address", (b("address") == "") | b("address").isin("none", "null", "undefined")), ("missing_postal", (a("postal") == "") & (b("postal") == "") & (name < 0.6)), ("transliteration", cross & (name < 0.4)), ("indic_script", cross),
        ("legal_suffix", (s1 == s2) & (s1 != "")), ("word_order", (t1 == t2) & (F.size(t1) >= 2)), ("typo", (F.levenshtein(s1, s2) <= 2) & (F.least(F.length(s1), F.length(s2)) >= 4)),
        ("frequent_bucket", (house != "") & (house == F.lower(b("house"))) & house.rlike("^[0-9]{1,9}$") & (F.coalesce(F.expr(f"try_cast({x}.house as int)"), F.lit(99)) <= 25)),
        ("missing_house", (a("house") == "") & (b("house") == "") & (name < 0.7)), ("address_variation", (a("address") != "") & (S.jaccard(d1, d2) < 0.15)), ("name_variation", name < 0.5),
    ], "other")


def misses(links: DataFrame, pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """category, n of the links (s1_id, cand_id) that are no pairs. s1, targets: prepared records."""
    missed = links.distinct().join(pairs.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"], "left_anti")
    x = s1.select(F.col("entity_id").alias("s1_id"), F.struct(*s1.columns).alias("x"))
    y = targets.select(F.col("entity_id").alias("cand_id"), F.struct(*targets.columns).alias("y"))
    return missed.join(x, "s1_id").join(y, "cand_id").select(miss_class().alias("category")).groupBy("category").agg(F.count("*").alias("n"))


def exemplars(table: DataFrame, by: str, order: list[str | Column], most: int = 3) -> DataFrame:
    """The first rows of each class."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return table.withColumn("rank", rank).where(F.col("rank") <= most)


def bands(scored: DataFrame, prob: str = "prob") -> DataFrame:
    """Pairs of sure, impossible and doubtful scores."""
    p = F.col(prob)
    n = lambda c: F.sum(c.cast("long"))
    return scored.agg(n(p >= 0.99).alias("sure"), n(p <= 0.01).alias("impossible"), n((p >= 0.75) & (p <= 0.85)).alias("doubtful"), F.count("*").alias("pairs"))


#: Candidate limits that are compared: name, S2, S3, both together (S2 first); None: no limit.
FRONTIER = [
    ("shared_150", None, None, 150), ("75_75", 75, 75, None), ("70_80", 70, 80, None), ("80_70", 80, 70, None), ("60_90", 60, 90, None), ("90_60", 90, 60, None), ("100_100", 100, 100, None), ("unbounded", None, None, None),
]


def frontier(ranked: DataFrame, truth: DataFrame, s1: DataFrame, threshold: float, configs: list[tuple] = FRONTIER) -> DataFrame:
    """One row a limit: pairs, mean, p95 and most candidates, pairs and recall by source, macro F0.5 of the pairs with a
    score of at least threshold, and true links that it recovers and drops against the first limit.

    ranked: s1_id, cand_id, source, rank (in S1 and source), place (in S1 over both sources), prob.
    """
    most = F.lit(1 << 60)
    grid = F.array(*(F.struct(F.lit(n).alias("config"), *(F.lit(v if v is not None else 1 << 60).alias(k) for k, v in (("q2", a), ("q3", b), ("q", c)))) for n, a, b, c in configs))
    known = truth.select("s1_id", "cand_id").distinct()
    marked = ranked.join(known.withColumn("_y", F.lit(1)), ["s1_id", "cand_id"], "left")
    kept = marked.select("s1_id", "cand_id", "source", "rank", "place", "prob", F.coalesce("_y", F.lit(0)).alias("y"), F.explode(grid).alias("g"))
    fits = (F.col("rank") <= F.when(F.col("source") == "S2", F.col("g.q2")).otherwise(F.col("g.q3"))) & (F.col("place") <= F.least("g.q", most))
    s2, hit, base = F.col("source") == "S2", fits & (F.col("y") == 1), configs[0]
    first = (F.col("rank") <= F.when(s2, F.lit(base[1] if base[1] is not None else 1 << 60)).otherwise(F.lit(base[2] if base[2] is not None else 1 << 60))) & (F.col("place") <= (base[3] if base[3] is not None else 1 << 60))
    n = lambda c: F.sum(c.cast("long"))
    named = kept.withColumn("config", F.col("g.config"))
    per = named.groupBy("config", "s1_id").agg(
        n(fits).alias("n"), n(fits & s2).alias("n2"), n(hit).alias("found"), n(hit & s2).alias("found2"), n(hit & ~first).alias("recovered"), n((F.col("y") == 1) & first & ~fits).alias("dropped"),
        n(fits & (F.col("prob") >= threshold)).alias("predicted"), n(hit & (F.col("prob") >= threshold)).alias("tp"),
    )
    true = known.groupBy("s1_id").agg(F.count("*").alias("true"), n(F.col("cand_id").startswith("S2-")).alias("true2"))
    spine = s1.select(F.col("entity_id").alias("s1_id"), F.explode(F.array(*(F.lit(c[0]) for c in configs))).alias("config")).join(true, "s1_id", "left")
    full = spine.join(per, ["config", "s1_id"], "left").na.fill(0)
    share = lambda a, b: F.when(F.sum(b) > 0, F.sum(a) / F.sum(b)).otherwise(0.0)
    c = F.col
    return full.groupBy("config").agg(
        F.sum("n").alias("pairs"), F.avg("n").alias("mean_candidates"), F.expr("percentile(n, 0.95)").alias("p95_candidates"), F.max("n").alias("max_candidates"), F.sum("n2").alias("pairs_s2"), F.sum(c("n") - c("n2")).alias("pairs_s3"), F.sum("found").alias("found"),
        share(c("found"), c("true")).alias("recall"), share(c("found2"), c("true2")).alias("recall_s2"), share(c("found") - c("found2"), c("true") - c("true2")).alias("recall_s3"), F.avg(f05(c("tp"), c("predicted"), c("true"))).alias("macro_f05"), F.sum("recovered").alias("recovered"), F.sum("dropped").alias("dropped"),
    )


def recall_split(truth: DataFrame, pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """split, links, found, recall: over all, by country of the S1 record, and by script (cross: the target is Indic)."""
    hits = truth.join(pairs.select("s1_id", "cand_id").distinct().withColumn("_hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    named = hits.join(s1.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id").join(targets.select(F.col("entity_id").alias("cand_id"), "has_indic"), "cand_id")
    splits = F.explode(F.array(F.lit("all"), F.concat(F.lit("country "), "country"), F.when(F.col("has_indic"), "script cross").otherwise("script latin"))).alias("split")
    return named.select(splits, F.coalesce("_hit", F.lit(0)).alias("hit")).groupBy("split").agg(F.count("*").alias("links"), F.sum("hit").alias("found")).withColumn("recall", F.col("found") / F.col("links"))


def match_split(s1: DataFrame, matches: DataFrame) -> DataFrame:
    """split, entities, matched, rate by country, script and presence of an address of the S1 record, and for each source
    the matches (as entities and matched) with their share. s1: prepared; matches: s1_id, cand_id."""
    some = matches.select("s1_id").distinct().withColumn("_m", F.lit(1))
    there = ~((F.col("address") == "") | F.col("address").isin("none", "null", "undefined"))
    splits = F.array(F.concat(F.lit("country "), "country"), F.when(F.col("has_indic"), "script indic").otherwise("script latin"), F.when(there, "address present").otherwise("address missing"))
    hits = s1.join(some, F.col("entity_id") == F.col("s1_id"), "left").select(F.explode(splits).alias("split"), F.coalesce("_m", F.lit(0)).alias("m"))
    rates = hits.groupBy("split").agg(F.count("*").alias("entities"), F.sum("m").alias("matched")).withColumn("rate", F.col("matched") / F.col("entities"))
    total = matches.agg(F.count("*").alias("_all"))  # one row
    by_source = matches.groupBy(F.concat(F.lit("source "), F.substring("cand_id", 1, 2)).alias("split")).agg(F.count("*").alias("entities")).crossJoin(total)
    return rates.unionByName(by_source.select("split", "entities", F.col("entities").alias("matched"), (F.col("entities") / F.col("_all")).alias("rate")))


def separation(table: DataFrame) -> DataFrame:
    """category, pos, neg, and the mean sem_name and sem_both of positive and negative pairs with their difference, in the
    classes that names and addresses tell apart badly. table: features, label, sem_name, sem_both."""
    c = F.col
    classes = {
        "acronym": c("name_normalized_levenshtein") < 0.65, "missing_address": c("candidate_address_missing") == 1, "cross_script": c("is_cross_script") == 1, "typo": (c("name_levenshtein_ratio") >= 0.65) & (c("name_levenshtein_ratio") < 0.85),
        "homonym": (c("label") == 0) & (c("name_exact_diff_address") == 1),
    }
    inside = F.explode(F.filter(F.array(*(F.when(v, F.lit(k)) for k, v in classes.items())), lambda x: x.isNotNull())).alias("category")
    mean = lambda col, y: F.coalesce(F.avg(F.when(c("label") == y, c(col))), F.lit(0.0))
    out = table.select("label", "sem_name", "sem_both", inside).groupBy("category").agg(F.sum("label").alias("pos"), F.sum(1 - c("label")).alias("neg"), *(mean(col, y).alias(f"{n}_{col}") for col in ("sem_name", "sem_both") for n, y in (("pos", 1), ("neg", 0))))
    return out.withColumns({"name_separation": c("pos_sem_name") - c("neg_sem_name"), "both_separation": c("pos_sem_both") - c("neg_sem_both")})


def match_rates(s1: DataFrame, matches: DataFrame, by: str) -> DataFrame:
    """entities, matched and rate of each group; matches: s1_id, cand_id."""
    some = matches.select("s1_id").distinct().withColumn("_m", F.lit(1))
    hits = s1.join(some, F.col("entity_id") == F.col("s1_id"), "left")
    return hits.groupBy(by).agg(F.count("*").alias("entities"), F.sum(F.coalesce("_m", F.lit(0))).alias("matched")).withColumn("rate", F.col("matched") / F.col("entities"))


def match_histogram(s1: DataFrame, matches: DataFrame) -> DataFrame:
    counts = s1.select(F.col("entity_id").alias("s1_id")).join(matches.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left")
    return counts.groupBy(F.coalesce("n", F.lit(0)).alias("matches")).agg(F.count("*").alias("entities"))
