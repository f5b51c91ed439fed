"""Operators against brute force, exact round trips and held-out accuracy."""

import collections
import glob
import hashlib
import itertools
import math
import os
import random
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entwine.llm import bpe, components, language, media, minmax, nndescent, packing, quality, shingles, token_counts, toxicity, url_filter
from entwine.llm import queries as registered
from entwine.llm.batches import Stages, running_total, utf8

DATA = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def messy(alphabet, n, most, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(most))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_bpe_is_the_library(files, name):
    e = bpe.Encoder(files(name))
    texts = messy("a b'\n\t \xa0's're LL'll1２é中!?　\u0085 zt''͸\U0001F600_-́", 4000, 30) + ["", "don't  stop\n\n 'se x", "'", "''ll"]
    raw, offsets = utf8(pa.array(texts))
    ids, begins, starts = e.encode(raw, offsets)
    assert e.decode(ids, starts, len(raw)) == raw.tobytes()
    for i, t in enumerate(texts):
        got, at = ids[4 * begins[i] : 4 * begins[i + 1]], starts[begins[i] : begins[i + 1]] - offsets[i]
        assert np.frombuffer(got, "<u4").tolist() == e.library.encode_ordinary(t) and e.decode(got, at) == t.encode()
        parts = [e.bytes_of[k] for k in np.frombuffer(got, "<u4").tolist()]
        assert at.tolist() == [sum(map(len, parts[:k])) for k in range(len(parts))]
    if len(begins) > 1:  # the bytes stand where the offsets say
        text = texts[next(i for i in range(len(texts)) if begins[i + 1] - begins[i] > 2)]
        alone, _, at = e.encode(*utf8(pa.array([text])))
        assert e.decode(alone, at + 3) == b"\0\0\0" + text.encode()


def test_scan_is_the_automaton():
    nexts, starts, _, _ = bpe.automaton()
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 17, 1000):
        symbols = rng.integers(0, bpe.SYMBOLS, n).astype(np.uint8)
        state, want = bpe.START, []
        for x in symbols:
            want.append(bool(starts[state, x]))
            state = nexts[state, x]
        assert bpe.token_starts(symbols).tolist() == want


def test_token_counts_are_the_library(files):
    c = token_counts.Counter(files("piece_bpe_32k.model"))
    texts = messy("a b  the\n\t\xa0éﬁ▁</s>12\U0001F600３", 4000, 40) + ["", " ", "  ", "a ", "a  ", " a"]
    assert c.separate and c.count(texts) == [len(c.library.encode(t)) for t in texts]
    assert all(len(c.library.encode(w)) == 1 for w in list(c.proven)[:500] if w)


def test_packing_ids_are_the_library(files):
    tokenizers = pytest.importorskip("tokenizers")
    t, h = packing.Tokenizer(files("byte_bpe_50k.json")), tokenizers.Tokenizer.from_file(files("byte_bpe_50k.json"))
    for s in messy([*"a b  the\n\t\xa0éﬁ'<|endoftext|>s12\U0001F600３ſ", "<|endoftext|>"], 1500, 40):
        assert t.ids(s).tolist() == h.encode(s, add_special_tokens=False).ids


def test_schedule_fills_every_window():
    rng = np.random.default_rng(0)
    for k in range(120):
        n, size = int(rng.integers(1, 9)), int(rng.integers(3, 60))
        totals = rng.integers(0, 3000, n) * (rng.random(n) < 0.8)
        target = None if k % 2 else rng.random(n).tolist()
        places = packing.Places(packing.schedule(totals.tolist(), size, target))
        grid = np.full(int(totals.sum()), -1)
        for q in range(n):
            edges = np.unique([0, totals[q], *rng.integers(0, totals[q] + 1, 5)])
            who, at, length, window, offset = places.of(q, edges[:-1], edges[1:])
            assert length.sum() == totals[q] and (at >= edges[who]).all() and (offset + length <= size).all()
            for w, o, m in zip(window, offset, length, strict=True):
                assert (grid[w * size + o : w * size + o + m] == -1).all()
                grid[w * size + o : w * size + o + m] = q
        assert (grid >= 0).all()
    one = packing.round_robin(np.array([16384, 8192, 8191, 1]), 2048)
    assert (np.abs(np.diff(one, axis=0) - np.array([1024, 512, 512, 0])) <= 1).all()


@tables
def test_packing_keeps_every_token(spark, files):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = packing.pack(docs, files("byte_bpe_50k.json"), 1).toPandas().sort_values(["doc_id", "start"])
    t = packing.Tokenizer(files("byte_bpe_50k.json"))
    ids = {r["doc_id"]: np.append(t.ids(r["text"] or ""), 1).astype("<u4") for r in docs.collect()}
    for doc, rows in out.groupby("doc_id"):
        assert rows["start"].tolist() == [0, *(rows["start"] + rows["length"]).tolist()[:-1]] and rows["length"].sum() == len(ids[doc])
        assert all(zlib.crc32(ids[doc][a : a + n].tobytes()) == c for a, n, c in zip(rows["start"], rows["length"], rows["ids_crc32"], strict=True))
    mix = out.groupby(["sequence_id", "source"])["length"].sum().unstack(fill_value=0)
    assert (mix.iloc[:-1].sum(axis=1) == 2048).all() and mix.iloc[:-2].std().max() < 5


def test_packing_mixes_every_source(spark, files):
    """300 equal sources: each has its share of every window, and a target for one of them is met."""
    rows = [(10 * s + k, "word " * 60, f"s{s:03}") for s in range(300) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = packing.pack(docs, files("byte_bpe_50k.json"), 1).toPandas()
    mix = out.groupby(["sequence_id", "source"])["length"].sum().unstack(fill_value=0)
    full = mix[mix.sum(axis=1) == 2048]
    assert len(full) > 10 and mix.shape[1] == 300 and (full - 2048 / 300).abs().max().max() <= 2
    target = {"s299": 0.05} | {f"s{s:03}": 0.95 / 299 for s in range(299)}
    more = spark.createDataFrame([(5000 + k, "word " * 60, "s299") for k in range(40)], docs.schema)
    out = packing.pack(docs.unionByName(more), files("byte_bpe_50k.json"), 1, target=target).toPandas()
    assert abs(out[(out["sequence_id"] == 0) & (out["source"] == "s299")]["length"].sum() - 0.05 * 2048) <= 2


def shingle_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset([tuple(w)]) if 0 < len(w) < width else frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def brute_components(texts, width, percent):
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for i, s in sets.items():
        for j, n in collections.Counter(j for g in s for j in where[g] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


@tables
@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_are_brute_force(spark, width):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = brute_components({r["doc_id"]: r["text"] for r in docs.collect()}, width, 80)
    out = minmax.near_duplicates(docs, width).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == want and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_large_groups_of_near_copies(spark):
    """Chains of edits, more texts than a block and a bucket hold; copies of each."""
    rng, base = random.Random(4), [f"w{i}" for i in range(60)]
    texts, now = {}, base
    for i in range(700):
        if i % 50 == 0:
            now = list(base)
        now = list(now)
        now[rng.randrange(60)] = f"e{rng.randrange(10**6)}"
        texts[i] = " ".join(now)
    texts |= {1000 + i: texts[7] for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minmax.near_duplicates(docs, 4).collect()} == brute_components(texts, 4, 80)


def test_copies_of_one_text_need_no_tiles(spark, monkeypatch):
    """3,000 texts around one: a comparison with the leader of a bucket each links them all."""
    monkeypatch.setattr(minmax, "tiles", None)
    rng, base = random.Random(6), [f"w{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for i in range(1, 3000):
        now = list(base)
        now[rng.randrange(150)] = f"e{i}"
        texts[i] = " ".join(now)
    out = minmax.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4), 4).collect()
    assert {r["component_id"] for r in out} == {0} and len(out) == 3000


def test_tiles_meet_all_that_may_be_linked(spark, monkeypatch):
    """Every pair of a group that is not in its largest cluster and has sizes near enough is in a tile, and few others."""
    monkeypatch.setattr(minmax, "BLOCK", 8)
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 0, 0, 0, i]), 7 if i < 150 else 9, rng.choice([10, 12, 13, 100, 119, 1000])) for i in range(200)]
    rows = [(i, root if g == 7 else i, g, n) for i, root, g, n in rows]
    nodes = spark.createDataFrame(rows, "id long, root long, grp long, n long")
    placed = collections.defaultdict(lambda: ([], []))
    for r in minmax.tiles(nodes, 80, Stages(spark, "t")).collect():
        placed[r["tile"]][r["part"]].append(r["id"])
    met = set()
    for one, two in placed.values():
        met |= {frozenset(p) for p in (itertools.product(one, two) if two else itertools.combinations(one, 2))}
    main = {7: 0, 9: 150}
    for (i, a, g, n), (j, b, h, m) in itertools.combinations(rows, 2):
        if g == h and (a != main[g] or b != main[g]) and 100 * min(n, m) >= 80 * max(n, m):
            assert frozenset((i, j)) in met
        if g != h or max(n, m) > 2 * min(n, m) or (a == b == main[g] and a != i):
            assert frozenset((i, j)) not in met


def test_min_max_estimates_similarity():
    rng = np.random.default_rng(1)
    common, a, b = rng.integers(0, 1 << 62, 600).astype(np.uint64), rng.integers(0, 1 << 62, 100).astype(np.uint64), rng.integers(0, 1 << 62, 100).astype(np.uint64)
    values = np.concatenate([common, a, common, b])
    low, high = shingles.min_max(values, np.array([0, 700, 1400]), 400)
    for v in (low, high):
        assert abs((v[:, 0] == v[:, 1]).mean() - 600 / 800) < 0.08


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(500, 500), (7, 8)]
    out = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), Stages(spark, "t")).collect()}
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 400)}


def test_running_total(spark):
    rows = [(g, o, (o * 7 + len(g)) % 5) for g in ("a", "bb") for o in range(2500) if o % 3]
    out = running_total(spark.createDataFrame(rows, "g string, o long, v long"), "g", "o", "v", "s").collect()
    for g in ("a", "bb"):
        total = 0
        for r in sorted((r for r in out if r["g"] == g), key=lambda r: r["o"]):
            assert r["s"] == total
            total += r["v"]


def test_marginals_are_brute_force():
    rng = np.random.default_rng(0)
    for n, k in ((7, 3), (9, 2), (1, 4)):
        score, first = rng.normal(size=(n, k)), rng.random(n) < 0.2
        first[0] = True
        move, start, want = np.exp(rng.normal(size=(k, k))), np.exp(rng.normal(size=k)), np.zeros((n, k))
        for y in itertools.product(range(k), repeat=n):
            p = np.prod([np.exp(score[t, y[t]]) * (start[y[t]] if first[t] else move[y[t - 1], y[t]]) for t in range(n)])
            for t in range(n):
                want[t, y[t]] += p
        assert np.allclose(language.marginals(score, first, move, start), want / want.sum(axis=1, keepdims=True))


@tables
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    out = registered.op1_language_crf(spark, DATA).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) > 0.97 * len(out)


def test_letters_are_those_of_unicode():
    """Signs, digits and marks of any script are no letters; rare letters are."""
    none = ["！？", "٣٤٥", "،؟", "︵", "\ufe0f", "１２", "́", "\U0001f600", "×÷", "—…", "", " \t", "_-7", "\U000e0041"]
    some = ["ª º", "ℂ ℕ", "中", "ж", "é", "\U00010400", "1a", "！ß？"]
    texts = none + some + messy("a1é中！٣ª \n×\U0001f600\U00010400ж́", 500, 6)
    raw, offsets = utf8(pa.array(texts))
    begin, end, count = shingles.words(raw, offsets)
    n = np.bincount(np.repeat(np.arange(len(texts)), count), language.letters(raw, begin, end), len(texts))
    assert n.tolist() == [sum(unicodedata.category(c)[0] == "L" for c in t) for t in texts]
    rows = [(name, [" ".join(w * 10)]) for name, w in (("en", ["the", "cat"]), ("de", ["der", "Hund"])) for _ in range(5)]
    names, scores = language.labelled(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), language.fit(rows))
    assert all((name == "und") == (k == 0) and (score == 0) == (k == 0) for name, score, k in zip(names, scores, n, strict=True))


def test_switching_words():
    en, de = "the cat sat on the mat with another thing".split(), "der Hund und die Katze schlafen auf dem Sofa".split()
    rng = random.Random(2)
    rows = [(name, [" ".join(rng.choices(w, k=20))]) for _ in range(60) for name, w in (("en", en), ("de", de))]
    m = language.fit(rows)
    text = " ".join(en + de)
    raw, offsets = utf8(pa.array([text]))
    begin, end, _ = shingles.words(raw, offsets)
    first = np.zeros(len(begin), bool)
    first[0] = True
    p = language.marginals(m.emissions(raw, begin, end), first, m.move, m.first)
    assert [m.labels[i] for i in p.argmax(axis=1)] == ["en"] * len(en) + ["de"] * len(de)


def held_out(spark, name, label, data):
    """Share of label 1 that is predicted, and share of label 0 that is, among rows never learned from."""
    labels = spark.read.parquet(f"{data}/labels.parquet")
    out = getattr(registered, name)(spark, data).join(labels, "doc_id").where("held_out").collect()
    of = lambda y: [r["predicted"] for r in out if r[label] == y]
    return sum(of(1)) / len(of(1)), sum(of(0)) / len(of(0))


@tables
@pytest.mark.parametrize("data", [DATA, "/root/testdata/sf0.1"])
def test_toxicity_held_out(spark, data):
    recall, false = held_out(spark, "op7_toxicity_weak", "toxic", data)
    assert recall >= 0.9 and false <= 0.02


@tables
def test_quality_held_out(spark):
    recall, false = held_out(spark, "op6_quality_cnn", "quality", DATA)
    assert recall >= 0.95 and false <= 0.1


def test_convolution_is_brute_force():
    rng = np.random.default_rng(0)
    m = quality.Model(rng.normal(size=(256, quality.DEPTH)), rng.normal(size=(quality.WIDTH, quality.DEPTH, quality.FILTERS)), rng.normal(size=quality.FILTERS).astype(np.float32), rng.normal(size=2 * quality.FILTERS), 0.3)
    rows = rng.integers(0, 256, (3, quality.CHUNK)).astype(np.uint8)
    got, where = quality.pooled(rows, m.pair_tables(), m.bias, True)
    for i in range(3):
        at = np.arange(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)
        windows = np.stack([m.embedding[rows[i, a : a + quality.WIDTH]] for a in at])
        response = np.einsum("nwd,wdf->nf", windows, m.kernel) + m.bias
        assert np.allclose(got[i], np.maximum(response.max(axis=0), 0), atol=1e-4) and (where[i] == response.argmax(axis=0)).all()
    for size in (0, 1, 510, 511, *range(512, 3000), 50_001):
        begin, end = quality.chunk_edges(size)
        assert begin[0] == 0 and end[-1] == size and (begin[1:] <= end[:-1]).all() and (begin % 2 == 0).all() and (end - begin <= quality.CHUNK).all()


def test_quality_score_is_brute_force():
    """Every byte of a text counts, the last one too."""
    rng = np.random.default_rng(1)
    m = quality.Model(rng.normal(size=(256, quality.DEPTH)), 0.3 * rng.normal(size=(quality.WIDTH, quality.DEPTH, quality.FILTERS)), rng.normal(size=quality.FILTERS).astype(np.float32), 0.1 * rng.normal(size=2 * quality.FILTERS), 0.3)
    texts = ["", "a", "é" * 300 + "x", *messy("ab cé\n\U0001f600", 6, 2500)] + ["q" * n for n in (511, 512, 513, 1025, 1473)]
    raw, offsets = utf8(pa.array(texts))
    got = quality.scores(raw, offsets, m, m.pair_tables())
    for text, score in zip(texts, got, strict=True):
        data, vectors, at = text.encode(), [], 0
        while True:
            last = at + quality.CHUNK >= len(data)
            at = max(0, len(data) - quality.CHUNK + len(data) % 2) if last else at
            chunk = data[at : at + quality.CHUNK].ljust(quality.CHUNK, b"\0")
            x = m.embedding[list(chunk)]
            responses = [np.einsum("wd,wdf->f", x[i : i + quality.WIDTH], m.kernel) + m.bias for i in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)]
            vectors.append(np.maximum(np.max(responses, axis=0), 0))
            if last:
                break
            at += quality.CHUNK - quality.OVERLAP
        z = np.concatenate([np.mean(vectors, axis=0), np.max(vectors, axis=0)]) @ m.weight + m.offset
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-4
    changed = [t[:-1] + "#" for t in texts if len(t) > 512 and t.isascii()]
    same = [t for t in texts if len(t) > 512 and t.isascii()]
    assert (quality.scores(*utf8(pa.array(changed)), m, m.pair_tables()) != quality.scores(*utf8(pa.array(same)), m, m.pair_tables())).any()


def test_label_model_finds_the_label():
    """Three voters, one of them copied nine times; copies count once, and a voter of noise says little."""
    rng = np.random.default_rng(0)
    y = rng.random(2000) < 0.3
    votes = np.stack([(rng.random(2000) < np.where(y, hit, false)) for hit, false in ((0.7, 0.01), (0.6, 0.02), (0.5, 0.01))], axis=1)
    noise = rng.random(2000) < 0.2
    votes = np.concatenate([np.repeat(votes[:, :1], 9, axis=1), votes, noise[:, None]], axis=1)
    fires = votes[:, :12].any(axis=1)
    p, parent = toxicity.label_model(np.concatenate([votes, ~fires[:, None]], axis=1), np.where(fires, 0.9, 0.05), 0.3, 1, 1)
    assert ((p > 0.5) == y).mean() > 0.93 and (parent[1:10] >= 0).all() and parent[-1] == -1
    assert (p[y & votes[:, 0]] > 0.9).all() and (p[noise & ~fires] < 0.1).all()


def plain_label_model(votes, start, share, alone, against):
    """The same model, a text and a voter at a time."""
    n, m = len(votes), len(votes[0])
    p, parent = list(start), [-1] * m
    for k in range(toxicity.ROUNDS):
        if k % toxicity.AGAIN == 0:
            for i in range(m - alone):
                best, parent[i] = -math.inf, -1
                for j in range(m - alone):
                    a, b = sum(v[i] for v in votes), sum(v[j] for v in votes)
                    if b < a or (b == a and j < i):
                        told = 0.0
                        for q in (p, [1 - x for x in p]):
                            both = collections.Counter()
                            for v, w in zip(votes, q, strict=True):
                                both[v[i], v[j]] += w
                            for (x, z), c in both.items():
                                told += c * math.log(c * sum(q) / (sum(both[x, u] for u in (0, 1)) * sum(both[u, z] for u in (0, 1)))) if c else 0
                        if told >= toxicity.LINK and told > best:
                            best, parent[i] = told, j
        odds = []
        for v in votes:
            z = math.log(share / (1 - share))
            for i in (i for i in range(m) if v[i]):
                same = [u for u in range(n) if parent[i] < 0 or votes[u][parent[i]] == v[parent[i]]]
                held, fired = [sum(p[u] for u in same), sum(1 - p[u] for u in same)], [sum(p[u] for u in same if votes[u][i]), sum(1 - p[u] for u in same if votes[u][i])]
                overall = (sum(fired) + 0.01) / (sum(held) + 0.02)
                told = math.log((fired[0] + overall) / (held[0] + 1)) - math.log((fired[1] + overall) / (held[1] + 1))
                z += min(told, 0) if i >= m - against else max(told, 0)
            odds.append(z)
        p = [1 / (1 + math.exp(-max(-30, min(30, z)))) for z in odds]
    return p, parent


def test_label_model_is_brute_force():
    rng = np.random.default_rng(2)
    y = rng.random(60) < 0.4
    votes = np.stack([(rng.random(60) < np.where(y, hit, 0.1)) for hit in (0.9, 0.6, 0.5)], axis=1)
    votes = np.concatenate([votes[:, :1], votes, (~votes.any(axis=1))[:, None]], axis=1)
    start = np.where(votes[:, :4].any(axis=1), 0.9, 0.05)
    p, parent = toxicity.label_model(votes, start, 0.4, 1, 1)
    want, whose = plain_label_model(votes.astype(int).tolist(), start.tolist(), 0.4, 1, 1)
    assert np.allclose(p, want, atol=1e-6) and parent.tolist() == whose and max(whose) >= 0


def plain_terms(text):
    """Words and beginnings of a text, by occurrence; which are dense; which are so in several words."""
    low = text.translate({i: i + 32 for i in (*range(65, 91), *range(0xC0, 0xDF))})
    found = [w.encode() for w in re.findall(r"[A-Za-z\u0080-\U0010ffff]+", low)]
    places = collections.defaultdict(list)
    for w in found:
        for t in [("word", w), *(("begin", w[:k]) for k in toxicity.PREFIXES if len(w) >= k)]:
            places[t].append(w)
    dense = {t for t, ws in places.items() if len(ws) >= toxicity.DENSE * len(found)}
    return places, dense, {t for t in dense if len(set(places[t])) > 1}, len(found)


def term_hash(t):
    raw = np.frombuffer(t[1], np.uint8)
    h = shingles.word_hashes(raw, np.array([0]), np.array([len(raw)]))
    return int((h if t[0] == "word" else shingles.mixed(h + np.uint64(len(t[1]))))[0])


def test_toxic_terms_are_brute_force(spark):
    """Counts, choice and votes of the lexicon, over whole long texts, against sets."""
    rng = random.Random(8)
    syllables = ["ba", "ne", "Ö", "ti", "ra", "é", "lo"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 6)))
    texts = [" ".join([word() for _ in range(rng.choice([5, 40, 3000]))] + (["vile" + word() for _ in range(60)] + ["scum"] if i % 3 == 0 else [])) for i in range(60)]
    label = np.array([float(i % 3 == 0) for i in range(60)])
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(5)
    got = toxicity.Sample(table, np.arange(60)).telling(label, toxicity.RATIO, "evidence", 10_000)
    counts = [collections.defaultdict(lambda: [0.0, 0.0]) for _ in range(3)]
    plain = [plain_terms(t) for t in texts]
    for y, (places, dense, various, _) in zip(label, plain, strict=True):
        for kind, found in enumerate((places, dense, various)):
            for t in found:
                counts[kind][t][int(1 - y)] += 1
    want, (n1, n0) = set(), (label.sum(), 60 - label.sum())
    for kind in range(3):
        for t, (k1, k0) in counts[kind].items():
            part = lambda k, n: k * math.log(k * (n1 + n0) / ((k1 + k0) * n)) if k else 0  # noqa: E731, B023
            if k1 >= 1 and (k1 / n1) / ((k0 + 0.5) / n0) >= toxicity.RATIO and 2 * (part(k1, n1) + part(k0, n0)) >= (toxicity.VARIOUS if kind == 2 else toxicity.EVIDENCE):
                want.add((term_hash(t), min(kind, 1)))
    assert set(got) == want and (term_hash(("word", b"scum")), 0) in want and (term_hash(("begin", b"vile")), 1) in want
    lexicon = toxicity.Lexicon(toxicity.hashes(got))
    row, term, dense, share = lexicon.found(*utf8(pa.array(texts)))
    known = {int(h): k for k, h in enumerate(lexicon.vocabulary)}
    for i, (places, thick, _, n) in enumerate(plain):
        mine = {known[term_hash(t)]: t for t in places if term_hash(t) in known}
        assert dict(zip(term[row == i].tolist(), dense[row == i].tolist(), strict=True)) == {k: t in thick for k, t in mine.items()}
        assert math.isclose(share[i], sum(any(w.startswith(t[1]) if t[0] == "begin" else w == t[1] for t in mine.values()) for w in (w for t, ws in places.items() if t[0] == "word" for w in ws)) / n)


def test_toxic_passage_in_a_long_text(spark):
    """A text of 400 kB counts whole, in learning and in scoring."""
    rng = random.Random(3)
    plain = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n))
    bad = lambda n: " ".join(rng.choice(["scum", "moron", "idiot"]) if rng.random() < 0.1 else plain(1) for _ in range(n))
    rows = [(i, bad(80_000 if i % 40 == 0 else 60) if i % 2 == 0 else plain(80_000 if i % 40 == 1 else 60), i % 2 == 0) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs.where("doc_id < 100"), labels, "toxic")
    assert all(r["predicted"] == (r["doc_id"] + 1) % 2 for r in toxicity.classify(docs, model).collect())


def test_gear_and_chunks():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    h = media.gear(data)
    for i in (40, 777, 199_999):
        assert int(h[i]) == sum(int(media.GEAR[data[i - j]]) << j for j in range(32)) % (1 << 32)
    marks = lambda d: np.flatnonzero((media.gear(d) >> np.uint32(32 - media.MASK_BITS)) == 0) + 1
    ends = lambda d: media.cuts(marks(d), 0, len(d))
    sizes = np.diff([0, *ends(data)])
    assert sizes.sum() == len(data) and sizes[:-1].min() >= media.LEAST and sizes.max() <= media.MOST
    shifted = np.concatenate([data[:100], rng.integers(0, 256, 37).astype(np.uint8), data[100:]])
    assert len({e for e in ends(data)} & {e - 37 for e in ends(shifted)}) > 0.7 * len(sizes)  # cuts follow the content


@tables
def test_media_round_trip(spark):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    out = registered.op10_media_chunks(spark, DATA).collect()
    assert len(out) == len(texts)
    for r in out:
        p = media.payload_of(texts[r["doc_id"]])
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(texts[r["doc_id"]]), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))


def test_borrowed_chunks(spark):
    """Long texts that share passages across tasks and within one text."""
    rng = random.Random(1)
    passage = ["".join(rng.choice("abcdefgh ") for _ in range(30_000)) for _ in range(4)]
    rows = [(i, passage[i % 4] + str(i) * 50 + passage[(i + 1) % 4] + passage[i % 4]) for i in range(40)]
    out = {r["doc_id"]: r for r in media.store_and_read(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert all(out[i]["payload_sha256"] == hashlib.sha256(media.payload_of(t.encode())).hexdigest() for i, t in rows)


def test_neighbours_recall(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 24)).astype(np.float32)
    x[100:160] = x[0]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    out = nndescent.neighbours(table, F.col("id") % 100 == 0).toPandas()
    d = x.astype(float)
    hit = 0
    for q, rows in out.groupby("query_id"):
        dist = np.sqrt(((d - d[q]) ** 2).sum(axis=1))
        dist[q] = np.inf
        want = np.lexsort((np.arange(len(d)), dist))[:10]
        rows = rows.sort_values("rank")
        hit += len(set(want) & set(rows["vec_id"]))
        assert rows["rank"].tolist() == list(range(1, 11)) and np.array_equal(rows["score"], dist[rows["vec_id"]])
        if q in (0, 100):
            assert rows["vec_id"].tolist() == want.tolist()
    assert hit >= 0.9 * 10 * 40


def recall(spark, x, asked):
    """Share of the ten nearest distances that are met, among the rows asked for."""
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    out = nndescent.neighbours(table, F.col("id").isin([int(i) for i in asked])).toPandas()
    d, hit = x.astype(float), 0
    for q in asked:
        dist = ((d - d[q]) ** 2).sum(axis=1)
        dist[q] = np.inf
        want = np.lexsort((np.arange(len(d)), dist))[:10]
        hit += len(set(want) & set(out.loc[out["query_id"] == q, "vec_id"]))
    return hit / (10 * len(asked))


def test_neighbours_recall_beside_an_outlier_and_among_near_copies(spark):
    """One vector 1e8 times larger, and 1,500 that differ by 1e-5 of their length."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 24)).astype(np.float32)
    x[:1500] = x[0] * (1 + 1e-5 * rng.normal(size=(1500, 24))).astype(np.float32)
    x[-1] *= 1e8
    assert recall(spark, x, range(0, 1500, 50)) >= 0.9
    assert recall(spark, x, range(1500, 3900, 80)) >= 0.9


def test_neighbours_recall_in_groups_without_a_pivot(spark, monkeypatch):
    """66 separate groups of 60, 16 pivots."""
    monkeypatch.setattr(nndescent, "PIVOTS", 16)
    rng = np.random.default_rng(7)
    x = (np.repeat(rng.normal(size=(66, 24)) * 10, 60, axis=0) + rng.normal(size=(3960, 24))).astype(np.float32)
    assert recall(spark, x, range(0, 3960, 66)) >= 0.95


def test_urls_are_regular_expressions():
    for url in messy(["free", "casino", "win", "bets", "-", ".", "/", "a", "A", "FREE", "spam", "http://", "é", "1"], 2000, 9):
        low = url.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
        found = [w for t, w in url_filter.VOCABULARY if re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)]
        assert url_filter.hits(url, url_filter.VOCABULARY) == (found.count(0), sum(w > 0 for w in found), sum(found))


@tables
def test_urls_are_the_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{glob.glob(f'{DATA}/pages.parquet')[0]}'")
    want = con.execute(registered.oracle_sql()["op4_url_vocabulary"])
    names = [c[0] for c in want.description]
    got = registered.op4_url_vocabulary(spark, DATA)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r[n] for n in names)) for r in got.collect())
