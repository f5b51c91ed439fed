"""The 96 pair features, in a fixed order. `features` takes them from one Arrow pass over narrow records (see `pairwise`): as
built-in expressions they make one very large method, which ran slowly. `plain_features` has all but the Indel
similarities as built-in expressions over enriched records."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pairwise
from ..functions import similarity as S
from ..functions import text as X
from .blocking import RULES
from .prepare import enrich

# Names and order of the features.
NAMES = [
    "name_exact", "name_compact_exact", "name_nosuff_exact", "name_translit_exact", "name_nosuff_translit_exact", "name_levenshtein_ratio",
    "name_normalized_levenshtein", "name_token_sort_ratio", "name_token_set_ratio", "name_w_ratio", "name_translit_levenshtein_ratio",
    "name_translit_normalized_levenshtein", "name_translit_token_sort_ratio", "name_translit_token_set_ratio", "name_translit_w_ratio",
    "name_char2_jaccard", "name_char3_jaccard", "name_char4_jaccard", "name_char5_jaccard", "name_translit_char2_jaccard",
    "name_translit_char3_jaccard", "name_translit_char4_jaccard", "name_token_jaccard", "name_token_overlap_count",
    "name_shared_token_fraction_min", "name_shared_token_fraction_max", "name_translit_token_jaccard", "name_translit_token_overlap_count",
    "name_translit_shared_token_fraction_min", "name_length_diff", "name_length_ratio", "name_token_count_diff", "name_token_count_ratio",
    "name_first_token_exact", "name_last_token_exact", "name_prefix3_exact", "name_prefix4_exact", "name_prefix5_exact",
    "name_translit_first_token_exact", "name_translit_prefix3_exact", "consonant_skeleton_exact", "consonant_skeleton_levenshtein",
    "consonant_skeleton_jaccard", "consonant_skeleton_len_diff", "consonant_skeleton_len_ratio", "address_exact",
    "address_compact_similarity", "address_levenshtein_ratio", "address_normalized_levenshtein", "address_token_jaccard",
    "address_token_set_ratio", "address_char3_ngram_jaccard", "address_length_ratio", "address_token_count_ratio",
    "address_numeric_token_overlap", "address_numeric_token_jaccard", "house_number_exact", "postal_code_exact",
    "postal_code_prefix3_exact", "s1_address_missing", "candidate_address_missing", "both_address_missing", "either_address_missing",
    "postal_missing_either", "postal_missing_both", "house_missing_either", "house_missing_both", "same_country",
    "same_postal_and_high_name_sim", "same_house_and_high_name_sim", "same_postal_and_same_house", "same_postal_and_same_name_prefix",
    "addr_sim_x_name_sim", "max_name_similarity", "max_address_similarity", "name_and_addr_high_confidence", "name_exact_diff_address",
    "s1_has_indic", "candidate_is_indic", "is_cross_script", "name_has_transliteration", "s1_script_latin", "candidate_script_latin",
    "candidate_source_is_S2", "candidate_source_is_S3", *RULES, "num_blocking_rules",
]
GROUPS = {
    "name": [n for n in NAMES if n.startswith(("name_", "consonant_", "max_name"))],
    "address": [n for n in NAMES if n.startswith(("address_", "house_", "postal_", "max_address")) or n.endswith("address_missing")],
    "evidence": [n for n in NAMES if n.startswith("blocked_") or n == "num_blocking_rules"],
}


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def ratio(a: Column, b: Column) -> Column:
    return F.when(F.greatest(a, b) > 0, F.least(a, b) / F.greatest(a, b)).otherwise(1.0)


def share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(0.0)


def pair_records(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Both prepared records of each pair as structs x and y. Only records that occur in pairs are enriched."""
    left = enrich(s1.join(pairs.select(F.col("s1_id").alias("entity_id")).distinct(), "entity_id", "left_semi"))
    right = enrich(targets.join(pairs.select(F.col("cand_id").alias("entity_id")).distinct(), "entity_id", "left_semi"))
    pack = lambda df, key, name: df.select(F.col("entity_id").alias(key), F.struct(*df.columns).alias(name))
    return pairs.join(pack(left, "s1_id", "x"), "s1_id").join(pack(right, "cand_id", "y"), "cand_id")


def missing(address: Column) -> Column:
    return (address == "") | address.isin("none", "null", "undefined")


def light_columns(skel1: Column, skel2: Column) -> dict[str, Column]:
    """The features that need no more than comparisons and lengths of the texts of x and y, by name."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    same = lambda a, b: flag((a != "") & (a == b))
    n1, n2, nt = F.length(x("norm")), F.length(y("norm")), F.length(y("trans"))
    prefix = lambda a, b, la, lb, n: flag((la >= n) & (lb >= n) & (F.substring(a, 1, n) == F.substring(b, 1, n)))
    m1, m2 = missing(x("address")), missing(y("address"))
    either = m1 | m2
    there = lambda v: F.when(either, 0.0).otherwise(v)
    p1, p2, h1, h2 = F.lower(x("postal")), F.lower(y("postal")), F.lower(x("house")), F.lower(y("house"))
    i1, i2 = x("has_indic") | x("address_indic"), y("has_indic") | y("address_indic")
    return {
        "name_exact": same(x("norm"), y("norm")), "name_compact_exact": same(x("compact"), y("compact")), "name_nosuff_exact": same(x("nosuff"), y("nosuff")),
        "name_translit_exact": same(x("norm"), y("trans")), "name_nosuff_translit_exact": same(x("nosuff"), y("trans_nosuff")),
        "name_length_diff": F.abs(n1 - n2).cast("double"), "name_length_ratio": ratio(n1, n2),
        **{f"name_prefix{n}_exact": prefix(x("norm"), y("norm"), n1, n2, n) for n in (3, 4, 5)}, "name_translit_prefix3_exact": prefix(x("norm"), y("trans"), n1, nt, 3),
        "consonant_skeleton_exact": same(skel1, skel2), "consonant_skeleton_len_diff": F.abs(F.length(skel1) - F.length(skel2)).cast("double"), "consonant_skeleton_len_ratio": ratio(F.length(skel1), F.length(skel2)),
        "address_exact": there(flag(x("address") == y("address"))), "address_length_ratio": there(ratio(F.length(x("address")), F.length(y("address")))),
        "house_number_exact": same(h1, h2), "postal_code_exact": same(p1, p2), "postal_code_prefix3_exact": prefix(p1, p2, F.length(p1), F.length(p2), 3),
        "s1_address_missing": flag(m1), "candidate_address_missing": flag(m2), "both_address_missing": flag(m1 & m2), "either_address_missing": flag(either),
        "postal_missing_either": flag((p1 == "") | (p2 == "")), "postal_missing_both": flag((p1 == "") & (p2 == "")), "house_missing_either": flag((h1 == "") | (h2 == "")), "house_missing_both": flag((h1 == "") & (h2 == "")),
        "same_country": same(x("country"), y("country")), "s1_has_indic": flag(i1), "candidate_is_indic": flag(i2), "is_cross_script": flag(i1 != i2), "name_has_transliteration": flag(y("trans") != y("norm")),
        "s1_script_latin": flag(~i1), "candidate_script_latin": flag(~i2), "candidate_source_is_S2": flag(F.col("cand_id").startswith("S2-")), "candidate_source_is_S3": flag(F.col("cand_id").startswith("S3-")),
        **{r: flag(F.array_contains("rules", r)) for r in RULES}, "num_blocking_rules": F.size("rules").cast("double"),
    }


def plain_features(joined: DataFrame) -> DataFrame:
    """Adds `f`: the features that need no Indel similarity and no other feature."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    inter = lambda a, b: F.size(F.array_intersect(a, b)).cast("double")
    distinct = F.array_distinct
    t1, t2, tt, a1, a2 = distinct(x("toks")), distinct(y("toks")), distinct(y("toks_trans")), distinct(x("toks_address")), distinct(y("toks_address"))
    size = lambda a: F.size(a)
    edge = lambda a, b, at: flag((F.size(a) > 0) & (F.size(b) > 0) & (F.try_element_at(a, F.lit(at)) == F.try_element_at(b, F.lit(at))))
    skel1, skel2 = x("skel"), F.when(y("has_indic") | y("address_indic"), y("trans_skel")).otherwise(y("skel"))
    either = missing(x("address")) | missing(y("address"))
    there = lambda v: F.when(either, 0.0).otherwise(v)
    columns = light_columns(skel1, skel2) | {
        "name_normalized_levenshtein": S.levenshtein_similarity(x("norm"), y("norm")), "name_translit_normalized_levenshtein": S.levenshtein_similarity(x("norm"), y("trans")),
        **{f"name_char{n}_jaccard": S.jaccard(x(f"char{n}_name"), y(f"char{n}_name")) for n in (2, 3, 4, 5)},
        **{f"name_translit_char{n}_jaccard": S.jaccard(x(f"char{n}_name"), y(f"char{n}_trans")) for n in (2, 3, 4)},
        "name_token_jaccard": S.jaccard(t1, t2), "name_token_overlap_count": inter(t1, t2),
        "name_shared_token_fraction_min": share(inter(t1, t2), F.least(size(t1), size(t2))), "name_shared_token_fraction_max": share(inter(t1, t2), F.greatest(size(t1), size(t2))),
        "name_translit_token_jaccard": S.jaccard(t1, tt), "name_translit_token_overlap_count": inter(t1, tt), "name_translit_shared_token_fraction_min": share(inter(t1, tt), F.least(size(t1), size(tt))),
        "name_token_count_diff": F.abs(F.size(x("toks")) - F.size(y("toks"))).cast("double"), "name_token_count_ratio": ratio(F.size(x("toks")), F.size(y("toks"))),
        "name_first_token_exact": edge(x("toks"), y("toks"), 1), "name_last_token_exact": edge(x("toks"), y("toks"), -1), "name_translit_first_token_exact": edge(x("toks"), y("toks_trans"), 1),
        "consonant_skeleton_levenshtein": S.levenshtein_similarity(skel1, skel2), "consonant_skeleton_jaccard": S.jaccard(X.char_ngrams(skel1, 2), X.char_ngrams(skel2, 2)),
        "address_compact_similarity": there(S.levenshtein_similarity(x("compact_address"), y("compact_address"))),
        "address_normalized_levenshtein": there(S.levenshtein_similarity(x("address"), y("address"))), "address_token_jaccard": there(S.jaccard(a1, a2)), "address_char3_ngram_jaccard": there(S.jaccard(x("char3_address"), y("char3_address"))),
        "address_token_count_ratio": there(ratio(F.size(x("toks_address")), F.size(y("toks_address")))), "address_numeric_token_overlap": there(inter(x("nums"), y("nums"))), "address_numeric_token_jaccard": there(S.jaccard(x("nums"), y("nums"))),
    }
    return joined.withColumn("f", F.struct(*(v.alias(k) for k, v in columns.items())))


def narrow(records: DataFrame, key: str, name: str) -> DataFrame:
    """A prepared record as a struct of the texts that `features` compares; it passes through two joins for each pair."""
    indic = F.col("has_indic") | F.col("address_indic")
    latin = F.when(indic, F.col("trans_nosuff")).otherwise(F.col("nosuff"))
    own = ["norm", "compact", "nosuff", "address"] + (["trans", "trans_nosuff"] if name == "y" else [])
    skel, nums = X.consonants(F.col("nosuff") if name == "x" else latin), F.array_join(X.number_tokens(F.col("address")), " ")
    made = {"indic": indic, "postal": F.lower("postal"), "house": F.lower("house"), "country": F.coalesce("country", F.lit("")), "skel": skel, "nums": nums}
    return records.select(F.col("entity_id").alias(key), F.struct(*own, *(v.alias(k) for k, v in made.items())).alias(name))


def features(pairs: DataFrame, s1: DataFrame, targets: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """pairs (s1_id, cand_id, rules) -> s1_id, cand_id, carried columns, the 96 features as floats, in order."""
    return compare(pairs, narrow(s1, "s1_id", "x"), narrow(targets, "cand_id", "y"), carried)


def compare(pairs: DataFrame, left: DataFrame, right: DataFrame, carried: tuple[str, ...] = (), packed: str | None = None) -> DataFrame:
    """`features` of narrow records. packed: one column of this name holds the 96 features as a vector, instead of one each."""
    joined = pairs.select("s1_id", "cand_id", *carried, "rules").join(left, "s1_id").join(right, "cand_id")
    texts = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "xy" for c in joined.schema[side].dataType.names]
    found = sum((F.array_contains("rules", r).cast("int") * (1 << i) for i, r in enumerate(RULES)), F.lit(0))
    kept = joined.select("s1_id", "cand_id", *carried)
    flat = joined.select(*kept.columns, *texts, found.alias("_rules"), F.size("rules").alias("_n"))
    new = [T.StructField(packed, VectorUDT())] if packed else [T.StructField(n, T.FloatType()) for n in NAMES]
    return flat.mapInArrow(functools.partial(_compared, kept=len(kept.columns), packed=packed), T.StructType([*kept.schema, *new]))


def _compared(batches: Iterator[pa.RecordBatch], kept: int, packed: str | None) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        read = {n: b.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(b.schema.names) if i >= kept}
        of = {side: {n[2:]: v for n, v in read.items() if n.startswith(f"{side}_")} for side in "xy"}
        values = pairwise.whole(of["x"], of["y"]) | {r: read["_rules"] >> i & 1 for i, r in enumerate(RULES)} | {"num_blocking_rules": read["_n"]}
        for s in ("S2", "S3"):
            values[f"candidate_source_is_{s}"] = np.fromiter((c.startswith(f"{s}-") for c in b.column(1).to_pylist()), bool, b.num_rows)
        floats = [values[n].astype(np.float32) for n in NAMES]
        if packed:
            ends = np.arange(0, b.num_rows * len(NAMES) + 1, len(NAMES), dtype=np.int32)
            rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.stack(floats, axis=1).ravel().astype(np.float64)))
            dense = [pa.array(np.ones(b.num_rows, np.int8)), pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.list_(pa.int32())), rows]
            new = {packed: pa.StructArray.from_arrays(dense, VectorUDT.sqlType().names)}
        else:
            new = {n: pa.array(v) for n, v in zip(NAMES, floats, strict=True)}
        yield pa.RecordBatch.from_arrays([*b.columns[:kept], *new.values()], names=[*b.schema.names[:kept], *new])


def profile(table: DataFrame, columns: list[str]) -> DataFrame:
    """One row a column: mean, least, most, share of non-zero values in percent, numbers of NaN and infinite values. All are
    aggregated side by side in one row, which is then turned: a row of the table is not multiplied by its columns."""
    of = lambda c: F.col(c).cast("double")
    per = {
        "mean": lambda v: F.avg(v), "least": lambda v: F.min(v), "most": lambda v: F.max(v), "nonzero_pct": lambda v: 100 * F.avg((v != 0).cast("double")),
        "n_nan": lambda v: F.sum(F.isnan(v).cast("long")), "n_inf": lambda v: F.sum((F.abs(v) == float("inf")).cast("long")),
    }
    whole = table.agg(*(f(of(c)).alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in per.items()), F.count("*").alias("_n"))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), *(F.col(f"{k}_{i}").alias(k) for k in per)) for i, c in enumerate(columns)))).alias("e")
    return whole.where("_n > 0").select(rows).select("e.*")
