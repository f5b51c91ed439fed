"""Every operator over odd rows and over no rows."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from entwine.llm import bpe, language, media, minmax, nndescent, packing, quality, token_counts, toxicity, url_filter

from test_methods import brute_components

DATA = "/root/testdata/sf0.001"


def trained(docs):
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("quality"), F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("toxic"))
    return language.train(docs, "doc_id", "text", "lang"), quality.train(docs, labels, "quality"), toxicity.train(docs, labels, "toxic")


@pytest.fixture(scope="module")
def models(odd):
    return trained(odd)


def test_language(odd, models):
    out = {r["doc_id"]: r for r in language.identify(odd, models[0]).collect()}
    assert out[1]["lang_pred"] == out[2]["lang_pred"] == out[3]["lang_pred"] == out[10]["lang_pred"] == "und"
    assert out[1]["score"] == 0
    assert out[6]["lang_pred"] == "en" and 0 < out[6]["score"] <= 1
    assert language.identify(odd, models[0]).count() == 14


def test_quality(odd, models):
    out = quality.classify(odd, models[1], 0.7).collect()
    assert len(out) == 14 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)


def test_toxicity(odd, models):
    out = toxicity.classify(odd, models[2]).collect()
    assert len(out) == 14 and all(0 <= r["score"] <= 1 for r in out)


def test_untrained(empty, odd):
    lang, good, toxic = trained(empty)
    assert {r["lang_pred"] for r in language.identify(odd, lang).collect()} == {"und"}
    assert {r["score"] for r in quality.classify(odd, good, 0.7).collect()} == {0.5}
    assert {r["predicted"] for r in toxicity.classify(odd, toxic).collect()} == {0}
    assert language.identify(empty, lang).count() == quality.classify(empty, good, 0.7).count() == toxicity.classify(empty, toxic).count() == 0


def test_packing(odd, empty, files):
    out = packing.pack(odd, files("byte_bpe_50k.json"), 1).toPandas()
    filled = out.groupby("sequence_id")["length"].sum().sort_index()
    assert (filled.iloc[:-1] == 2048).all() and filled.index.tolist() == list(range(len(filled)))
    assert (out[out.doc_id == 1][["length", "doc_tokens", "start"]].values == [[1, 1, 0]]).all()
    assert len(out[out.doc_id == 8]) >= 2  # a repeated row is packed twice
    assert packing.pack(empty, files("byte_bpe_50k.json"), 1).count() == 0


def test_near_duplicates(odd, empty):
    out = minmax.near_duplicates(odd, 4).collect()
    by = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert by[6]["component_id"] == by[7]["component_id"] == 6 and by[6]["kept"] and not by[7]["kept"]
    assert by[4]["component_id"] == by[11]["component_id"] == 4 and by[4]["n_shingles"] == 1
    assert by[1]["n_shingles"] == by[3]["n_shingles"] == 0 and by[1]["component_id"] == 1 and by[1]["kept"]
    assert [r["component_id"] for r in out if r["doc_id"] is None] == [None, None] and len(out) == 14
    assert minmax.near_duplicates(empty).count() == 0


def test_urls(spark):
    schema = "page_id long, url string, id string, host string, rule string"
    pages = spark.createDataFrame([(1, None, "", "", ""), (1, "", "", "", ""), (2, "no scheme porn", "", "", ""), (3, "HTTP://A.Example.ORG/es/x?y", "", "", ""), (4, "x://free-bets.example.net#q", "", "", ""), (7, "x://h/free/click?win=bets", "", "", ""), (8, "x://h/free-sale", "", "", ""), (None, "http://notorg/", "", "", ""), (5, "http://org", "", "", ""), (6, "http://h.net/FREE" + "a" * 100_000, "", "", "")], schema)
    out = {r["page_id"]: r for r in url_filter.judge(pages, (("allow", "org/"), ("block", "example.org/es/"))).collect()}
    assert (out[1]["host"], out[1]["path"], out[1]["rule"], out[1]["verdict"]) == ("", "", None, "allow")
    assert out[2]["verdict"] == "block" and out[3]["rule"] == "example.org/es/" and out[3]["host"] == "a.example.org"
    assert out[4]["verdict"] == out[7]["verdict"] == "block" and out[8]["verdict"] == "allow" and (out[7]["soft_terms"], out[7]["soft_weight"]) == (4, 5)
    table = spark.createDataFrame([("Sale ", 3, "x"), ("free", 1, "x"), ("free", 0, "x"), (None, 1, "x"), ("", 0, "x")], "term string, weight int, url string")
    own = {r["page_id"]: r for r in url_filter.judge(pages, (), url_filter.read_vocabulary(table), min_hits=1).collect()}
    assert own[8]["strict_terms"] == 1 and own[8]["soft_weight"] == 3 and own[4]["verdict"] == "block" and own[3]["verdict"] == "allow"
    assert url_filter.judge(pages, (), ()).where("verdict = 'block'").count() == 0 and out[None]["rule"] is None and out[5]["rule"] is None and out[6]["verdict"] == "allow"
    assert url_filter.judge(pages.limit(0), ()).count() == 0


def test_token_counts(odd, empty, files):
    out = {r["doc_id"]: r for r in token_counts.count_tokens(odd, files("piece_bpe_32k.model"), 4096).collect()}
    assert out[1]["n_tokens"] == out[2]["n_tokens"] == 0 and out[6]["over_limit"] and out[4]["n_bytes"] == 4
    assert token_counts.count_tokens(empty, files("piece_bpe_32k.model"), 1).count() == 0


def test_bpe(odd, empty, files):
    ranks = files("byte_bpe_multi_50k.tiktoken")
    out = bpe.round_trip(odd, ranks).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in odd.collect()}
    import hashlib

    assert len(out) == 14 and all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]]).hexdigest() for r in out if r["doc_id"])
    coded = bpe.encode(odd.where("doc_id is not null").dropDuplicates(["doc_id"]), ranks)
    assert all(bytes(r["decoded"]) == texts[r["doc_id"]] for r in bpe.decode(coded, ranks).collect())
    assert all(len(r["starts"]) * 4 == len(r["ids"]) and (not r["starts"] or r["starts"][0] == 0) for r in coded.collect())
    assert bpe.round_trip(empty, ranks).count() == 0


def test_media(odd, empty):
    out = media.store_and_read(odd).collect()
    assert len(out) == 14 and all(r["payload_bytes"] % 576 == 0 and r["payload_bytes"] > 0 for r in out)
    same = [r for r in out if r["doc_id"] in (6, 7)]
    assert {k: same[0][k] for k in ("payload_sha256", "media_sha256", "feature")} == {k: same[1][k] for k in ("payload_sha256", "media_sha256", "feature")}
    assert media.store_and_read(empty).count() == 0


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (200, [0.0, 0.0])]
    table = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, node string, d double")
    out = nndescent.neighbours(table, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in out] == [(0, 1, 1), (0, 2, 2), (0, 3, 8), (0, 4, 100), (100, 1, 8), (100, 2, 0), (100, 3, 1), (100, 4, 2)]
    assert out[0]["score"] == 0 and abs(out[3]["score"] - 2**0.5) < 1e-12
    assert nndescent.neighbours(table.limit(0), F.col("id") % 100 == 0).count() == 0
    ragged = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0 + 1e-12]), (2, [1.0, 2.5]), (3, [1.0, 2.0, 3.0]), (4, []), (100, [5.0])], "vec_id long, embedding array<double>")
    out = nndescent.neighbours(ragged, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in out] == [(0, 1), (0, 2)] and 0 < out[0]["score"] < 1e-11  # double precision is kept


def test_pipeline_stages(spark, odd, empty, tmp_path):
    slim = lambda df: df.select("doc_id", "text", "lang", "source", "n_chars")
    odd.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (slim(odd), slim(empty)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns
            out.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
    kept = corpus_pipeline.dedup_stage(spark, slim(odd), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 2, 3, 4, 5, 6, 8, 9, 10] and sum(r["doc_id"] is None for r in kept) == 2


def test_pipeline_with_other_columns(spark, odd, tmp_path):
    """Extra columns with names that operators use, nulls in all of them: they come out of every filtering stage."""
    odd.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, str(tmp_path))
        if name != "packing":
            assert out.columns == odd.columns
        out.collect()


def test_language_stage_rejects_by_the_random_field(spark, tmp_path):
    """Mixed texts, and languages that are not wanted, go; rows without a label are judged by their words."""
    import random

    rng = random.Random(5)
    words = {"en": "the cat sat with another thing on this mat".split(), "de": "der Hund und die Katze schlafen nicht heute".split(), "fr": "le chat dort sur une chaise avec ses amis".split()}
    rows = [(10 * i + k, " ".join(rng.choices(words[c], k=40)), c, "s", 1) for i in range(60) for k, c in enumerate(words)]
    mixed = [w for _ in range(4) for c in words for w in rng.choices(words[c], k=10)]
    rows += [(5000, " ".join(mixed), None, "s", 1), (5001, " ".join(rng.choices(words["de"], k=40)), None, "s", 1), (5002, "123 ！", None, "s", 1), (5003, None, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    every = {r[0] for r in rows}
    assert ids(corpus_pipeline.language_stage(spark, docs, "")) == every - {5000, 5002, 5003}
    german = corpus_pipeline.language_stage(spark, docs, "", wanted=frozenset({"de"}))
    assert ids(german) == {r[0] for r in rows if r[2] == "de"} | {5001}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_pipeline_is_its_operators(spark):
    """The whole pipeline against classifiers applied row by row, brute-force grouping and the tokenizer's counts."""
    import public_tokenizers

    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    learn = corpus_pipeline.remainder(F.col("doc_id"), 4) != 2
    good = quality.train(docs.where(learn), labels.where(learn), "quality")
    tables = good.pair_tables()
    rows = [r for r in docs.collect() if r["text"] and quality.scores(*quality.utf8(pa.array([r["text"]])), good, tables)[0] >= 0.7]
    left = spark.createDataFrame(rows, docs.schema)
    field = language.train(left.where(learn), "doc_id", "text", "lang")
    names = [language.labelled(pa.RecordBatch.from_arrays([pa.array([r["text"]])], ["text"]), field) for r in rows]
    rows = [r for r, (name, score) in zip(rows, names, strict=True) if name[0] != "und" and score[0] >= corpus_pipeline.SHARE]
    roots = brute_components({r["doc_id"]: r["text"] for r in rows}, 5, 80)
    rows = [r for r in rows if roots[r["doc_id"]][1] == r["doc_id"]]
    t = packing.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: len(t.ids(r["text"])) + 1 for r in rows}
    out = corpus_pipeline.run(spark, DATA).toPandas()
    assert out.groupby("doc_id")["length"].sum().to_dict() == want and (out.groupby("sequence_id")["length"].sum().sort_index().iloc[:-1] == 2048).all()
