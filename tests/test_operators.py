import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from entwine.operators import blocking as B
from entwine.operators import features as Fe
from entwine.operators import labels as L
from entwine.operators import metrics as M
from entwine.operators import model, validate
from entwine.operators.prepare import prepare
from entwine.plans.pipeline import Config, Pipeline
from entwine.sources import records as R

RECORDS = "entity_id string, business_name string, business_address string, country string"
TARGETS = [
    ("S2-001", "Mirabel's Candle Works Inc.", "2210 Juniper Dr., Oak Hollow, NC 27999", "US"), ("S3-002", "Lantern Partners LLC", "81 Quarry Rd, Elmford 55990", "US"), ("S2-003", "Zephyr Freight LLC", "640 Harbor Parkway, Tallgrass 75990", "US"),
    ("S2-004", "నీలం పుస్తకాలు ప్రైవేట్ లిమిటెడ్", "Flat 10, Surya Nagar, Telangana", "India"), ("S3-005", "Kamal Textiles", "H.No 4471, Sangli 416990", "India"), ("S2-006", "सूर्य वस्त्र भंडार", "Unknown", "India"), ("S2-007", "Zephyr Freight Inc", "12 Rue du Moulin, Lyon 69990", "France"),
]


@pytest.fixture(scope="module")
def targets(spark):
    return prepare(spark.createDataFrame(TARGETS, RECORDS)).cache()


def found(spark, targets, name, address, country, groups=B.DEFAULT_GROUPS):
    s1 = prepare(spark.createDataFrame([("S1-1", name, address, country)], RECORDS))
    return {r["cand_id"] for r in B.block(s1, targets, groups).collect()}


def test_blocking_rules(spark, targets):
    assert found(spark, targets, "Zephyr Freight Inc", "640 Harbor Parkway, Tallgrass 75990", "US") == {"S2-003"}
    assert "S2-001" in found(spark, targets, "Mirabels Candle Works", "2210 Juniper Dr", "US")
    assert "S2-004" in found(spark, targets, "Neelan Pustakaalu Pvt Ltd", "Surya Nagar, Telangana", "India")
    assert "S3-005" in found(spark, targets, "Camal Weaving Corp", "H.No 4471, Sangli 416990", "India")


def test_ngrams(spark, targets):
    s1 = prepare(spark.createDataFrame([("S1-1", "Lantern Partnrs", "x", "US")], RECORDS))
    assert {r["cand_id"] for r in B.ngram_neighbours(s1, targets, floor=0.3).collect()} == {"S3-002"}


def test_quota(spark):
    rows = [("S1-1", f"S2-{i}", "r", "S2", i) for i in range(500)] + [("S1-1", f"S3-{i}", "r", "S3", i) for i in range(120)] + [("S1-1", "S2-3", "q", "S2", 3)]
    pairs = spark.createDataFrame(rows, "s1_id string, cand_id string, evidence string, source string, ordinal int")
    out = B.quota(pairs, {"S2": 60, "S3": 90}).collect()
    assert len(out) == 150 and max(r["ordinal"] for r in out if r["source"] == "S2") == 59
    assert [r["rules"] for r in out if r["cand_id"] == "S2-3"] == [["q", "r"]]
    assert B.shared_quota(pairs).count() == 150


@pytest.mark.parametrize("mode", ["online", "preflight"])
def test_quotas_bound_online_buckets(spark, mode):
    """Whole buckets and those cut at the limits of the quota give the same pairs and evidence, and the latter fewer rows."""
    words = ["amber", "birch", "cedar", "dune"]
    row = lambda s, i: (f"{s}-{i}", f"{words[i % 2]} {words[i // 2 % 4]}", f"{i % 3} {words[i % 4]} {words[i % 4]} 1234{i % 2}", "US")
    s1 = prepare(spark.createDataFrame([row("S1", i) for i in range(12)], RECORDS)).cache()
    targets = R.with_ordinal(prepare(spark.createDataFrame([row(s, i) for i in range(60) for s in ("S2", "S3")], RECORDS))).cache()
    limits = {"S2": 3, "S3": 5}
    whole, bound = B.block_online(s1, targets, mode), B.block_online(s1, targets, mode, limits=limits)
    rows = lambda df: sorted((r["s1_id"], r["cand_id"], *r["rules"]) for r in df.collect())
    assert rows(B.quota(whole, limits)) == rows(B.quota(bound, limits)) and bound.distinct().count() < whole.count()
    assert rows(B.shared_quota(whole, 7)) == rows(B.shared_quota(B.block_online(s1, targets, mode, shared=7), 7))


def test_ngrams_of_equal_names_in_blocks(spark, monkeypatch):
    """Many records of a few names, in several blocks: the neighbours of all pairs of records."""
    names = ["amber birch works", "amber birch", "cedar dune", "cedar dunes works", "birch amber", "dune"]
    side = lambda s, n: prepare(spark.createDataFrame([(f"{s}-{i:03d}", names[i * i % 6], "", "US") for i in range(n)], RECORDS))
    s1, targets = side("S1", 9).cache(), side("S2", 40).cache()
    want = sorted(map(tuple, B.ngram_neighbours(s1, targets, floor=0.2, share_df=1.0, k=1000).collect()))
    first = lambda i: sorted((r for r in want if r[0] == i), key=lambda r: (-r[2], r[1]))[:7]
    monkeypatch.setattr(B, "NAMES_A_BLOCK", 2)
    got = sorted(map(tuple, B.ngram_neighbours(s1, targets, floor=0.2, share_df=1.0, k=7).collect()))
    assert got == sorted(r for i in sorted({r[0] for r in want}) for r in first(i)) and len(got) == 63


def test_caps(spark, targets):
    many = prepare(spark.createDataFrame([(f"S2-{i}", "same name here", "", "US") for i in range(B.BUCKET + 1)], RECORDS))
    assert found(spark, many, "same name here", "", "US", ("exact",)) == set()
    assert len(found(spark, many.limit(B.BUCKET), "same name here", "", "US", ("exact",))) == B.BUCKET


def pair(spark, a, b, rules=("blocked_postal",)):
    x, y = prepare(spark.createDataFrame([("S1-1", *a)], RECORDS)), prepare(spark.createDataFrame([("S2-1", *b)], RECORDS))
    pairs = spark.createDataFrame([("S1-1", "S2-1", list(rules))], "s1_id string, cand_id string, rules array<string>")
    return Fe.features(pairs, x, y).first()


def test_features(spark):
    assert len(Fe.NAMES) == len(set(Fe.NAMES)) == 96
    same = pair(spark, ("Fern Co", "12 Birch St 75990", "US"), ("Fern Co", "12 Birch St 75990", "US"))
    assert all(same[n] == 1 for n in ("name_exact", "name_levenshtein_ratio", "name_char3_jaccard", "address_exact", "postal_code_exact", "house_number_exact", "same_country", "name_w_ratio", "num_blocking_rules", "blocked_postal"))
    assert same.__fields__[2:] == Fe.NAMES and all(math.isfinite(same[n]) for n in Fe.NAMES)
    order = pair(spark, ("alpha beta", "x", "US"), ("beta alpha", "x", "US"))
    assert order["name_token_sort_ratio"] == 1 and order["name_token_jaccard"] == 1 and order["name_exact"] == 0
    gone = pair(spark, ("Fern Corporation", "12 Birch 75990", "US"), ("Fern Company", "", "US"), ())
    assert gone["name_nosuff_exact"] == 1 and gone["candidate_address_missing"] == 1 and gone["address_levenshtein_ratio"] == 0 and gone["postal_missing_either"] == 1
    cross = pair(spark, ("neelan pustakaalu", "a", "India"), ("నీలం పుస్తకాలు", "a", "India"))
    assert cross["is_cross_script"] == 1 and cross["name_translit_exact"] == 1 and cross["name_exact"] == 0


def test_metrics(spark):
    s1 = spark.createDataFrame([("a", "US"), ("b", "US"), ("c", "US"), ("d", "US")], "entity_id string, country string")
    truth = spark.createDataFrame([("a", "x"), ("a", "z"), ("d", "q")], "s1_id string, cand_id string")
    scored = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.9), ("a", "z", 0.9), ("c", "x", 0.9), ("d", "q", 0.1)], "s1_id string, cand_id string, prob double")
    out = {r["s1_id"]: r["f05"] for r in M.per_entity(s1, scored, truth, [0.5]).collect()}
    assert round(out["a"], 3) == 0.714 and (out["b"], out["c"], out["d"]) == (1, 0, 0)
    assert M.best(M.sweep(M.per_entity(s1, scored, truth, [0.5, 0.95]))).first()["threshold"] == 0.95


def test_sampling(spark):
    rows = [("a", f"S2-{i}", 1 if i < 2 else 0, float(i)) for i in range(60)] + [("b", f"S2-{i}", 0, float(i)) for i in range(9)]
    labelled = spark.createDataFrame(rows, "s1_id string, cand_id string, label int, hardness double")
    out = L.sample_negatives(labelled).collect()
    a, b = [r for r in out if r["s1_id"] == "a" and not r["label"]], [r for r in out if r["s1_id"] == "b"]
    assert len(a) == 8 and len(b) == 3 and sum(r["label"] for r in out) == 2
    assert {r["hardness"] for r in a} >= set(range(54, 60)) and {r["hardness"] for r in b} >= {7.0, 8.0}
    parts = L.split(spark.range(2000).select(F.concat(F.lit("S1-"), "id").alias("s1_id"))).groupBy("part").count().collect()
    assert 1500 < {r["part"]: r["count"] for r in parts}["train"] < 1700


def test_validation(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-1", "n", "a", "US"), ("S1-2", "n", "a", "US"), ("S1-3", "n", "a", "US")], RECORDS)
    targets = spark.createDataFrame([("S2-1", "n", "a", "US"), ("S2-2", "n", "a", "FR")], RECORDS)
    lists = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", "S1-9"), ("S1-2", "X,S2-2,S2-7"), ("S1-9", "")], "source1_entity_id string, ids string")
    n = {r["rule"].partition(".")[2]: r["n"] for r in validate.list_rules(lists, "m", s1, targets).collect()}
    assert n == {"malformed_row": 0, "duplicate_s1": 1, "duplicate_in_list": 1, "self_match": 1, "wrong_prefix": 1, "missing_s1": 1, "extra_s1": 1, "unknown_id": 3, "cross_country": 1}
    pairs = spark.createDataFrame([("S1-1", "S2-9"), ("S1-1", "S2-1")], "s1_id string, cand_id string")
    R.write_lists(R.spine_lists(s1, pairs, "matched_entity_ids"), f"{tmp_path}/out")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/out").collect() if "source1" not in r["value"]] == ["S1-1\tS2-1,S2-9", "S1-2\t", "S1-3\t"]
    assert validate.header_errors(spark, f"{tmp_path}/out", R.MATCHES) == []
    assert sorted(tuple(r) for r in R.read_truth(spark, f"{tmp_path}/out").collect()) == [("S1-1", "S2-1"), ("S1-1", "S2-9")]


def test_scan(spark, tmp_path):
    (tmp_path / "s.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"a ""b"""\tNA\tUS\nS1-2\tx\t\tUS\n', encoding="utf-8")
    rows = R.read_records(spark, f"{tmp_path}/s.tsv").orderBy("entity_id").collect()
    assert [tuple(r) for r in rows] == [("S1-1", 'a "b"', "NA", "US", "S1"), ("S1-2", "x", "", "US", "S1")]
    assert R.read_raw(spark, f"{tmp_path}/s.tsv").count() == 2
    pool = R.with_ordinal(R.read_records(spark, f"{tmp_path}/s.tsv"))
    assert R.first_of_each(pool, {"US": 1}).count() == 1
    assert {r["entity_id"] for r in R.cohort(pool, pool.where("entity_id = 'S1-1'"), pool.limit(0), {"US": 5}).collect()} == {"S1-2"}


def test_pipeline_and_model(spark, targets, tmp_path):
    everything = spark.createDataFrame([("S1-1", "Zephyr Freight Inc", "640 Harbor Parkway, Tallgrass 75990", "US"), ("S1-2", "Nobody", "", "US"), *TARGETS], RECORDS)
    matches, candidates = Pipeline(spark, Config(threshold=0.5, work=f"{tmp_path}/work")).run(everything)
    assert {tuple(r) for r in matches.collect()} == {("S1-1", "S2-003"), ("S1-2", "")}
    again, _ = Pipeline(spark, Config(threshold=0.5)).run(everything.repartition(5).orderBy(F.rand(3)))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in matches.collect()}
    for mode in ("online", "preflight"):
        assert Pipeline(spark, Config(mode=mode)).run(everything)[1].count() == 2
    table = spark.range(60).select("id", *((F.col("id") * (i + 1) % 7).cast("float").alias(n) for i, n in enumerate(Fe.NAMES)), (F.col("id") % 7 > 3).cast("int").alias("label"))
    fitted = model.fit(table, maxIter=2, maxDepth=2)
    assert abs(sum(model.importance(fitted).values()) - 1) < 1e-6 and model.score(fitted, table).where("prob between 0 and 1").count() == 60
    model.save(fitted, f"{tmp_path}/m")
    assert model.load(spark, f"{tmp_path}/m")[1]["features"] == Fe.NAMES
    with pytest.raises(ValueError):
        model.score(fitted, table.select("id", *reversed(Fe.NAMES)))


def test_stream(spark, tmp_path):
    from entwine.streaming.incremental import match_stream

    s1 = spark.createDataFrame([("S1-1", "Zephyr Freight Inc", "640 Harbor Parkway, Tallgrass 75990", "US")], RECORDS)
    (tmp_path / "in").mkdir()
    for k, rows in enumerate((TARGETS[:3], TARGETS[3:])):
        (tmp_path / "in" / f"{k}.tsv").write_text("\n".join(["\t".join(["entity_id", "business_name", "business_address", "country"]), *("\t".join(r) for r in rows)]) + "\n", encoding="utf-8")
    for _ in range(2):  # the second run finds nothing new
        match_stream(Pipeline(spark), s1, R.stream_records(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert [r["cand_id"] for r in spark.read.parquet(f"{tmp_path}/out/pairs").collect()] == ["S2-003"]
    with pytest.raises(ValueError):
        match_stream(Pipeline(spark, Config(threshold=0.1)), s1, R.stream_records(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/ck")


def test_semantic_space_counts_every_text(spark):
    """Three texts among 120,000 are enough for a term; all four similarities are there."""
    from entwine.operators.semantics import Space, semantic_features

    text = F.when(F.col("id") % 40_000 == 7, "zq").otherwise(F.when(F.col("id") % 3 == 0, "ab").otherwise("cd"))
    space = Space(spark.range(120_000).select("id", text.alias("text")))
    assert "zq" in space.place_of and np.isclose(space.idf[space.place_of["zq"]], np.log(120_001 / 4) + 1)
    rows = [(f"{s}-{i}", w, w, a) for s in ("S1", "S2") for i, (w, a) in enumerate([("red fox", "1 main road"), ("blue cat", "2 mill lane"), ("old dog", "")] * 3)]
    t = spark.createDataFrame(rows, "entity_id string, norm string, trans string, address string")
    pairs = spark.createDataFrame([("S1-0", "S2-0"), ("S1-0", "S2-1"), ("S1-2", "S2-2")], "s1_id string, cand_id string")
    got = {(r["s1_id"], r["cand_id"]): r for r in semantic_features(pairs, t.where("entity_id like 'S1%'"), t.where("entity_id like 'S2%'")).collect()}
    same, other, bare = got["S1-0", "S2-0"], got["S1-0", "S2-1"], got["S1-2", "S2-2"]
    assert all(np.isclose(same[c], 1) and other[c] < 0.9 for c in ("sem_name", "sem_trans", "sem_address", "sem_both")) and bare["sem_address"] == 0


def batch_run(spark, out, **config):
    from entwine.plans.batches import BatchRun

    return BatchRun(Pipeline(spark, Config(threshold=0.5, **config)), str(out), 3)


def test_batches_stop_resume_and_roll_back(spark, tmp_path):
    """A batch counts once its manifest can be read; half-written and corrupt ones run anew, and settings are fixed."""
    people = [(f"S1-{i}", n, a, c) for i, (_, n, a, c) in enumerate(TARGETS * 3)]
    everything = spark.createDataFrame([*people, *TARGETS], RECORDS).cache()
    s1 = everything.where("entity_id like 'S1%'")
    whole, _ = Pipeline(spark, Config(threshold=0.5)).run(everything)
    want = sorted(tuple(r) for r in whole.collect())
    run = batch_run(spark, tmp_path / "out")
    assert run.committed() == {} and run.lists("matches").count() == 0
    assert len(run.run(everything, stop_after=2)) == 2
    part = sorted(tuple(r) for r in run.lists("matches").collect())
    assert part and set(part) < set(want)
    run.snapshot(s1, str(tmp_path / "snapshot"))
    rows = [r["value"] for r in spark.read.text(f"{tmp_path}/snapshot/matches").collect() if "source1" not in r["value"]]
    assert len(rows) == len(people) and {r.split("\t")[0] for r in rows} == {p[0] for p in people}
    (tmp_path / "out" / "manifest" / "batch=0.json").write_text('{"batch": 0, "sett', encoding="utf-8")  # cut off
    (tmp_path / "out" / "matches" / "batch=2").mkdir()
    (tmp_path / "out" / "matches" / "batch=2" / "part-0.csv").write_text("source1_entity_id\tmatched_entity_ids\nS1-0\thalf\n", encoding="utf-8")
    assert set(run.committed()) == {1} and run.roll_back() == [0, 2]
    assert not (tmp_path / "out" / "matches" / "batch=0").exists()
    done = run.run(everything)
    assert set(done) == {0, 1, 2} and sorted(tuple(r) for r in run.lists("matches").collect()) == want
    assert sum(d["pairs"] for d in done.values()) == R.explode_lists(run.lists("candidates"), *R.CANDIDATES).count()
    with pytest.raises(ValueError):
        batch_run(spark, tmp_path / "out", limits={"S2": 1, "S3": 1}).run(everything)


def test_ranks_are_row_numbers(spark):
    """Ranges and sums of them give what one sort of a group would."""
    rows = [(f"{(i * 7919) % 20_000:05}", "ab"[i % 5 == 0]) for i in range(20_000)] + [("zz", None)]
    table = spark.createDataFrame(rows, "entity_id string, country string")
    got = {(r["country"], r["entity_id"]): r["place"] for r in R.ranked(table, ["country"], "entity_id", "place").collect()}
    for c in ("a", "b", None):
        ids = sorted(i for i, k in rows if k == c)
        assert [got[c, i] for i in ids] == list(range(1, len(ids) + 1))
    assert R.ranked(table.limit(0), ["country"], "entity_id", "place").count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\t\n\nS1-1\tx\n", encoding="utf-8")
    assert {r["entity_id"] for r in R.first_ids(spark, f"{tmp_path}/l.tsv").collect()} == {"S1-1", "S1-2"}
    table = spark.createDataFrame([("S1-1", "S2-1", 1, 0.5, 0.25)], "s1_id string, cand_id string, label int, f1 float, f2 float")
    R.write_features(table, f"{tmp_path}/features")
    assert [tuple(r) for r in R.read_features(spark, f"{tmp_path}/features", ["f1", "f2"]).collect()] == [("S1-1", "S2-1", 1, 0.5, 0.25)]
    with pytest.raises(ValueError):
        R.read_features(spark, f"{tmp_path}/features", ["f2", "f1"])
    R.write_report({"one": table.select("label"), "two": table.select("f1")}, f"{tmp_path}/report")
    assert spark.read.json(f"{tmp_path}/report/one").first()["label"] == 1


def test_ngrams_lose_no_pair(spark):
    """The prefix filter against all pairs, for several floors."""
    rng = np.random.default_rng(4)
    names = lambda n: [" ".join("".join(rng.choice(list("abcde"), rng.integers(2, 7))) for _ in range(rng.integers(1, 4))) for _ in range(n)]
    rows = [(f"{s}-{i}", n, "", "US") for s, k in (("S1", 40), ("S2", 120)) for i, n in enumerate(names(k))]
    ready = prepare(spark.createDataFrame(rows, RECORDS)).cache()
    s1, targets = ready.where("source = 'S1'"), ready.where("source = 'S2'")
    for floor in (0.2, 0.4, 0.7):
        found = lambda reach: {tuple(r) for r in B.ngram_neighbours(s1, targets, floor=floor, reach=reach).collect()}  # noqa: E731, B023
        assert found(1.0) == found(0.5) == found(0.0) and found(0.0)


def test_separation_and_appended_similarities(spark):
    from entwine.operators import semantics

    rows = [(f"S1-{i}", f"S2-{i}", i % 2, 0.5 if i < 4 else 0.9, 0.7, float(i % 4 == 0), 0.0, 1.0 if i == 2 else 0.0, i / 10, i / 20) for i in range(8)]
    names = ["name_normalized_levenshtein", "name_levenshtein_ratio", "candidate_address_missing", "is_cross_script", "name_exact_diff_address", "sem_name", "sem_both"]
    table = spark.createDataFrame(rows, "s1_id string, cand_id string, label int, " + ", ".join(f"{n} double" for n in names))
    out = {r["category"]: r for r in M.separation(table).collect()}
    assert set(out) == {"acronym", "missing_address", "typo", "homonym"}
    low = [r for r in rows if r[3] < 0.65]
    mean = lambda y: sum(r[8] for r in low if r[2] == y) / sum(r[2] == y for r in low)
    assert (out["acronym"]["pos"], out["acronym"]["neg"]) == (2, 2) and out["acronym"]["name_separation"] == pytest.approx(mean(1) - mean(0))
    assert out["homonym"]["pos"] == 0 and out["homonym"]["neg"] == 1
    sims = spark.createDataFrame([(f"S1-{i}", f"S2-{i}", 0.1, 0.2, 0.3, 0.4) for i in range(8)], "s1_id string, cand_id string, " + ", ".join(f"{c} double" for c in semantics.FOUR))
    base = spark.range(8).select(F.concat(F.lit("S1-"), "id").alias("s1_id"), F.concat(F.lit("S2-"), "id").alias("cand_id"), *(F.lit(0.0).alias(n) for n in Fe.NAMES))
    assert len(semantics.append(base, sims).columns) == 102 and len(semantics.append(base, sims, semantics.TWO).columns) == 100


def test_feature_ablation(spark):
    rows = [(f"S1-{i % 30}", f"S2-{i}", i % 3 == 0) for i in range(90)]
    pairs = spark.createDataFrame([(a, b, int(y)) for a, b, y in rows], "s1_id string, cand_id string, label int")
    table = pairs.select("*", *((F.when(F.lit(n.startswith("name_")), F.col("label")).otherwise(0) + F.lit(i % 3) * 0.0).cast("float").alias(n) for i, n in enumerate(Fe.NAMES))).cache()
    s1 = pairs.select(F.col("s1_id").alias("entity_id"), F.lit("US").alias("country")).distinct()
    out = {r["subset"]: r for r in model.ablation(table, table, s1, pairs.where("label = 1"), maxIter=2, maxDepth=2, minInstancesPerNode=1).collect()}
    assert list(out) == list(model.ABLATIONS) and out["all"]["features"] == 96 and out["name_only"]["macro_f05"] == 1 > out["address_only"]["macro_f05"]
    assert set(model.CONFIGS) == {"champion", "weighted", "shallow", "balanced", "large", "leaves"} and model.promoted(0.5, 0.6) and not model.promoted(0.5, 0.5)
    heavy = model.fit(table, ["name_exact"], positive_weight=3.65, maxIter=1, maxDepth=1)
    assert model.score(heavy, table.select("label", "name_exact")).where("prob > 0.5").count() == 30


def test_ranked_candidates_are_shuffled_once(spark, targets):
    """Union of rules and quota need one shuffle of all pairs; there were four, with a join of ordinals."""
    s1 = prepare(spark.createDataFrame([("S1-1", "Zephyr Freight Inc", "640 Harbor Parkway, Tallgrass 75990", "US")], RECORDS))
    pairs = Pipeline(spark, Config()).candidates(s1, targets)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    by = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert sum(k.startswith("s1_id") for k in by) == 1 and not any("cand_id" in k.split("),")[0] for k in by)
    assert [(r["s1_id"], r["cand_id"]) for r in pairs.collect()] == [("S1-1", "S2-003")]
