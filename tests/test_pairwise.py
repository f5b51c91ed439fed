"""The costly features of many pairs at once against the plain functions and the built-in expressions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from entwine.functions import pairwise as P
from entwine.functions import similarity as S
from entwine.operators import features as Fe
from entwine.operators import model
from entwine.operators.prepare import prepare


def names(n: int, letters: str, seed: int) -> list[str]:
    some = random.Random(seed)
    return [" ".join("".join(some.choices(letters, k=some.choice((0, 1, 3, 9, 40, 64, 65, 90, 300)))).split()) for _ in range(n)]


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


@pytest.mark.parametrize("letters", ["ab cé", "abcdefghijklmnop   ", "ab सू"])
def test_as_the_plain_functions(letters):
    a, b = names(300, letters, 1), names(300, letters, 2)
    i = np.arange(300)
    got = P.name_scores(P.Words(a + b), i, i + 300, (2, 3, 4, 5))
    for name, f in {"levenshtein_ratio": S.indel, "token_sort_ratio": S.token_sort, "token_set_ratio": S.token_set, "w_ratio": S.weighted}.items():
        assert got[name].tolist() == [f(x, y) for x, y in zip(a, b, strict=True)]
    assert P.distances(a[:80], b[:80], edits=True)[1].tolist() == [edits(x, y) for x, y in zip(a[:80], b[:80], strict=True)] == [P.levenshtein(x, y) for x, y in zip(a[:80], b[:80], strict=True)]
    for n in (2, 3, 4, 5):
        sets = [(P.gram_set(x, n), P.gram_set(y, n)) for x, y in zip(a, b, strict=True)]
        assert got[f"char{n}_jaccard"].tolist() == [len(x & y) / len(x | y) if x | y else 1.0 for x, y in sets]


def test_as_the_built_in_expressions(spark):
    """Every feature that both ways know, on all pairs of records with odd texts."""
    odd = ["", "a", "ab", "Zephyr Freight LLC", "zephyr zephyr freight", "సూర్య వస్త్ర", "x" * 70, "M/s. Kamal & Sons Pvt Ltd", "Straße Ñandú 12", "freight zephyr", "un deux trois quatre"]
    places = ["", "none", "12-B Main St. 10001", "12 Main Street 10001", "Plot No. 7 a a b 560001", "y" * 300 + " 1", "12/3 b a a 10001"]
    records = [(f"S{1 + (k + l) % 3}-{k}-{l}", n, a, "en") for k, n in enumerate(odd) for l, a in enumerate(places)]
    ready = prepare(spark.createDataFrame(records, "entity_id string, business_name string, business_address string, country string")).cache()
    s1, targets = ready.where("source = 'S1'"), ready.where("source <> 'S1'")
    pairs = s1.select(F.col("entity_id").alias("s1_id")).crossJoin(targets.select(F.col("entity_id").alias("cand_id"))).where("abs(hash(s1_id, cand_id)) % 2 = 0").withColumn("rules", F.array(F.lit("blocked_house")))
    plain = Fe.plain_features(Fe.pair_records(pairs, s1, targets))
    known = [n for n in plain.select("f.*").columns]
    want = {(r["s1_id"], r["cand_id"]): r for r in plain.select("s1_id", "cand_id", *(F.col(f"f.{n}").cast("float").alias(n) for n in known)).collect()}
    got = Fe.features(pairs, s1, targets).collect()
    assert len(got) == len(want) > 500
    for r in got:
        w = want[r["s1_id"], r["cand_id"]]
        assert {n: r[n] for n in known} == {n: w[n] for n in known}


def test_no_arrays_pass_through_the_joins(spark):
    """Of a record only the compared texts meet its pairs: sets of n-grams made the rows of the joins kilobytes wide."""
    ready = prepare(spark.createDataFrame([("S1-1", "a b", "1 c", "en"), ("S2-2", "a b", "1 c", "en")], "entity_id string, business_name string, business_address string, country string"))
    assert all(f.dataType.typeName() in ("string", "boolean") for side in "xy" for f in Fe.narrow(ready, "id", side).schema[side].dataType.fields)


def test_packed_features_are_the_columns_and_make_the_same_model(spark):
    ready = prepare(spark.createDataFrame([(f"S{1 + k % 3}-{k}", f"alpha {'beta' * (k % 4)} {k % 5}", f"{k % 6} main st 1000{k % 3}", "en") for k in range(24)], "entity_id string, business_name string, business_address string, country string")).cache()
    s1, targets = ready.where("source = 'S1'"), ready.where("source <> 'S1'")
    pairs = s1.select(F.col("entity_id").alias("s1_id")).crossJoin(targets.select(F.col("entity_id").alias("cand_id"))).withColumn("rules", F.array(F.lit("blocked_house"), F.lit("blocked_postal")))
    pairs = pairs.withColumn("label", (F.xxhash64("s1_id", "cand_id") % 2 == 0).cast("int")).coalesce(1)
    one, many = Fe.compare(pairs, Fe.narrow(s1, "s1_id", "x"), Fe.narrow(targets, "cand_id", "y"), ("label",), packed="v").cache(), Fe.features(pairs, s1, targets, ("label",)).cache()
    vectors = {(r.s1_id, r.cand_id): (r.label, *r.v.toArray().tolist()) for r in one.collect()}
    assert len(vectors) > 100 and vectors == {(r[0], r[1]): tuple(r[2:]) for r in many.collect()}
    fitted = model.fit(one, packed="v", maxIter=2, maxDepth=2, subsamplingRate=1.0, featureSubsetStrategy="all")
    rows = lambda scored: sorted((r.s1_id, r.cand_id, r.prob) for r in scored.collect())
    assert rows(model.score(fitted, one, packed="v")) == rows(model.score(fitted, many)) and len({p for *_, p in rows(model.score(fitted, many))}) > 1
