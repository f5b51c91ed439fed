"""Toxicity by weak supervision (operator 7).

1. Lexicon. From a bounded sample of labelled texts (DOCS of each label, whole): every word, and every word beginning of
   PREFIXES bytes, that is at least RATIO times as frequent among toxic texts, on clear evidence: by occurring, or by being
   dense, that is, by making at least DENSE of a text's words. A beginning that is dense in several different words of a text
   needs less evidence, as chance rarely does that. At most CANDIDATES stay, those with the clearest evidence.
2. Voters. Each lexicon entry votes for toxic where it occurs (or is dense) and abstains elsewhere; entries that fire where
   a clearer one does are left out, VOTERS stay. One voter says toxic where the whole lexicon is dense; two vote against:
   where nothing of the lexicon occurs, and where it occurs but is not dense. Fixed patterns vote as well: shouting,
   exclamation marks, grawlix, direct address.
3. Label model. A generative model of the votes given the unseen label: each voter has a rate of firing for either label
   (its accuracy) and may depend on one other voter besides the label, its parent: of the voters that fire more rarely, the
   one that tells most about it beyond the label (the correlations, with rates for either state of the parent). Rates,
   parents and the posterior of the label are fitted by expectation maximisation on the sample without its labels.
   Abstaining says nothing, and no voter counts for the side that it votes against.
4. A linear classifier learns the posterior labels from TERMS words and beginnings: whether they occur and are dense, and
   whether all together are. It scores all texts.

The sample's texts stay in executors: passes over them count terms, list votes and add up posteriors. What the driver holds
is bounded by DOCS, CANDIDATES and TERMS, whatever the length of the texts.

Defined results: null text is the empty text; without training rows of two labels every score is 0; repeated rows give
repeated rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import Stages, bounded_batches, slices, utf8
from .language import folded
from .shingles import min_max, mixed, shingle_sets, word_hashes, words
from .training import sample

DOCS = 2500
PREFIXES = (4, 5, 6, 7)
CANDIDATES, VOTERS, TERMS = 4000, 400, 300
RATIO, EVIDENCE, VARIOUS = 24.0, 20.0, 11.0  # evidence: twice the log likelihood ratio against equal frequency; VARIOUS: in several words
DENSE = 0.01  # share of a text's words
ROUNDS, AGAIN, LINK = 24, 4, 8.0  # rounds; parents are chosen anew every AGAIN of them; mutual information (nats) of a parent
UNIT = 1024  # posteriors are added up in this unit, so that sums don't depend on their order
SHOUTING, MARKS = 0.5, 3  # share of capitals, number of exclamation marks
SLICE = 1 << 18

# Bytes that are neither ASCII letters nor part of a longer character separate words.
NO_LETTERS = np.ones(256, bool)
NO_LETTERS[65:91] = NO_LETTERS[97:123] = NO_LETTERS[128:] = False
# Words of direct address in the four languages of the corpus.
ADDRESS = ("you", "your", "du", "dich", "dein", "ihr", "tu", "toi", "vous", "ton", "tú", "te", "usted", "tus")


def terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and of their beginnings; the text and the word (a running number) of each; words of each text."""
    begin, end, count = words(raw, offsets, NO_LETTERS)
    text = np.repeat(np.arange(len(count)), count)
    if not len(begin):
        return np.zeros(0, np.uint64), text, text, count
    low = folded(raw)
    found, of = [word_hashes(low, begin, end)], [np.arange(len(begin))]
    for n in PREFIXES:
        on = np.flatnonzero(end - begin >= n)
        found.append(mixed(word_hashes(low, begin[on], begin[on] + n) + np.uint64(n)))
        of.append(on)
    word = np.concatenate(of)
    return np.concatenate(found), text[word], word, count


def hashed(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(folded(raw), np.array([0]), np.array([len(raw)]))[0])


ADDRESS_HASHES = np.sort(np.array([hashed(w) for w in ADDRESS], np.uint64))


def present(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All terms, each once a text: text, term, whether dense, and whether several different words of the text begin with
    it and it is dense; sorted by text, then term."""
    h, text, word, count = terms(raw, offsets)
    if not len(h):
        return text, h, np.zeros(0, bool), np.zeros(0, bool)
    whole = h[: count.sum()][word]  # the words come first
    order = np.lexsort((whole, h, text))
    h, text, whole = h[order], text[order], whole[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])])
    at = np.flatnonzero(new)
    dense = np.diff(np.append(at, len(h))) >= DENSE * count[text[at]]
    other = np.concatenate([[False], whole[1:] != whole[:-1]]) & ~new
    return text[at], h[at], dense, dense & np.logical_or.reduceat(other, at)


def patterns(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, 4): shouting, exclamation marks, grawlix (two different signs of @#$%&* side by side), direct address."""
    total = lambda hit: np.diff(np.concatenate([[0], np.cumsum(hit)])[offsets])
    upper = total((raw >= 65) & (raw <= 90))
    letters = total(~NO_LETTERS[raw])
    sign = np.isin(raw, np.frombuffer(b"@#$%&*", np.uint8))
    swear = np.zeros(len(raw), bool)
    swear[1:] = sign[1:] & sign[:-1] & (raw[1:] != raw[:-1])
    begin, end, count = words(raw, offsets, NO_LETTERS)
    address = np.zeros(len(count), bool)
    if len(begin):
        address[np.repeat(np.arange(len(count)), count)[np.isin(word_hashes(folded(raw), begin, end), ADDRESS_HASHES)]] = True
    return np.stack([upper > SHOUTING * np.maximum(letters, 1), total(raw == 33) >= MARKS, total(swear) > 0, address], axis=1)


@dataclass
class Lexicon:
    """Sorted term hashes, looked up through a table of their first 16 bits."""

    vocabulary: np.ndarray

    def __post_init__(self) -> None:
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True

    def found(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """text, term and whether dense, of the terms of the vocabulary that occur, each once a text; and for each text the
        share of its words that hold one (0 for a text without words)."""
        h, text, word, count = terms(raw, offsets)
        n = len(count)
        if not len(self.vocabulary) or not len(h):
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool), np.zeros(n)
        on = np.flatnonzero(self.sieve[(h >> np.uint64(48)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, h[on])
        at[at == len(self.vocabulary)] = 0
        on, at = (x[self.vocabulary[at] == h[on]] for x in (on, at))
        pair, often = np.unique(text[on] * len(self.vocabulary) + at, return_counts=True)
        where, term = np.divmod(pair, len(self.vocabulary))
        _, one = np.unique(word[on], return_index=True)
        share = np.bincount(text[on][one], minlength=n) / np.maximum(count, 1)
        return where, term, often >= DENSE * count[where], share


@dataclass
class Model:
    """vocabulary: sorted term hashes; weight: of each where it occurs, then of each where it is dense, then of the whole
    vocabulary being dense; offset."""

    vocabulary: np.ndarray
    weight: np.ndarray
    offset: float


def inputs(raw: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ones in the classifier's input matrix."""
    text, term, dense, share = lexicon.found(raw, offsets)
    n = len(lexicon.vocabulary)
    whole = np.flatnonzero(share >= DENSE)
    return np.concatenate([text, text[dense], whole]), np.concatenate([term, term[dense] + n, np.full(len(whole), 2 * n)])


def scores(raw: np.ndarray, offsets: np.ndarray, model: Model, lexicon: Lexicon) -> np.ndarray:
    row, column = inputs(raw, offsets, lexicon)
    z = np.bincount(row, model.weight[column], len(offsets) - 1) + model.offset
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def parents(v: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Parent of each voter (-1: none): of the voters that fire more rarely, the one with most mutual information given the
    label, at least LINK nats. v (texts, voters) 0 or 1, p: posterior of the label of each text."""
    m = v.shape[1]
    told = np.zeros((m, m))
    for q in (p, 1 - p):
        n = q.sum() + 1e-9
        both = (v * q[:, None]).T @ v
        one = np.diag(both)
        for k, a, b in ((both, one[:, None], one), (one[:, None] - both, one[:, None], n - one), (one - both, n - one[:, None], one), (n - one[:, None] - one + both, n - one[:, None], n - one)):
            k = np.maximum(k, 1e-9)
            told += k * np.log(k * n / np.maximum(a * b, 1e-9))
    rate = v.sum(axis=0)
    rarer = (rate[None, :] < rate[:, None]) | ((rate[None, :] == rate[:, None]) & np.tri(m, k=-1, dtype=bool))
    told = np.where(rarer, told, -np.inf)
    best = told.argmax(axis=1) if m else np.zeros(0, int)
    return np.where(told[np.arange(m), best] >= LINK, best, -1)


def label_model(votes: np.ndarray, start: np.ndarray, share: float, alone: int = 0, against: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the label of each text, and the parent of each voter. votes (texts, voters): who fires; start: the
    posterior to begin with; share: of label 1; alone: so many voters, the last ones, depend on the label only; against: so
    many, the last ones, vote for label 0.

    For a voter and a state s of its parent, P(fires | label, s) is estimated with a prior of one text of each label at the
    voter's overall rate. A voter that fires adds the log ratio of its two rates; one that abstains adds nothing.
    """
    v = votes.astype(float)
    p, m = start.astype(float), v.shape[1]
    prior = np.log(share / (1 - share))
    side = np.where(np.arange(m) < m - against, 1, -1)
    parent = np.full(m, -1)
    for k in range(ROUNDS):
        if k % AGAIN == 0:
            parent[: m - alone] = parents(v[:, : m - alone], p)
        state = np.where(parent >= 0, v[:, np.maximum(parent, 0)], 1.0)
        z = np.full(len(v), prior)
        for s in (state, 1 - state):
            held1, held0 = p @ s, (1 - p) @ s
            fired = v * s
            n1, n0 = p @ fired, (1 - p) @ fired
            overall = (n1 + n0 + 0.01) / (held1 + held0 + 0.02)
            z += fired @ (np.maximum(np.log(((n1 + overall) / (held1 + 1)) / ((n0 + overall) / (held0 + 1))) * side, 0) * side)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return p, parent


def apart(votes: np.ndarray) -> list[int]:
    """At most VOTERS voters, the first ones first, without those that fire, four times in five, where an earlier one
    does: words and longer beginnings of a beginning that votes already."""
    kept: list[int] = []
    for i in range(votes.shape[1]):
        mine = votes[:, i]
        if len(kept) < VOTERS and not (kept and votes[mine][:, kept].mean(axis=0).max() >= 0.8):
            kept.append(i)
    return kept


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 800, rate: float = 0.03, decay: float = 3e-6) -> tuple[np.ndarray, float]:
    """Adam steps on the logistic loss. y: posteriors; the likelier label is learned, weighted by how sure it is. (Soft
    labels would hold every text with several terms at the posterior of a text with one.)"""
    sure = np.abs(2 * y - 1) / len(y)
    w, m, s = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -40, 40))) - (y > 0.5)) * sure
        g = np.append(x.T @ error + decay * w[:-1], error.sum())
        m, s = 0.9 * m + 0.1 * g, 0.98 * s + 0.02 * g**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.98**t)) + 1e-9)
    return w[:-1], float(w[-1])


def copy_keys(raw: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Three keys a text (none without words): both minima and both maxima of a pair of permutations of its three-word
    shingles. Near-copies agree in one."""
    h, edges = shingle_sets(raw, offsets, 3)
    n = np.diff(edges)
    full = np.flatnonzero(n)
    out: list[list[int]] = [[] for _ in n]
    if len(full):
        low, high = min_max(h, np.append(edges[:-1][full], len(h)), 6)
        keys = np.stack([mixed(low[k] + mixed(low[k + 1] + mixed(high[k] + mixed(high[k + 1] + np.uint64(k))))) for k in (0, 2, 4)], axis=1).view(np.int64)
        for i, found in zip(full.tolist(), keys.tolist(), strict=True):
            out[i] = found
    return out


def without_copies(rows: list[tuple[int, int, list[int]]]) -> list[tuple[int, int]]:
    """(id, label) of rows (id, label, copy keys) that are not near-copies of an earlier row of the same label: a word of a
    text that was copied many times is no better evidence than a word of one text."""
    seen, out = set(), []
    for i, label, keys in rows:
        found = {(label, k) for k in keys}
        if not found & seen:
            out.append((i, label))
            seen |= found
    return out


@dataclass
class Sample:
    """Texts (id, text) in a written table, and the ids, sorted, that count."""

    texts: DataFrame
    ids: np.ndarray

    def over(self, work, schema: str) -> DataFrame:
        """work(rows of self.ids, raw, offsets) -> batch, over slices of the texts that count."""
        ids = self.texts.sparkSession.sparkContext.broadcast(self.ids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, limit=SLICE):
                found = b.column("id").to_numpy()
                at = np.minimum(np.searchsorted(ids.value, found), len(ids.value) - 1)
                good = ids.value[at] == found
                if good.any():
                    yield work(at[good], *utf8(b.filter(pa.array(good)).column("text")))

        return self.texts.mapInArrow(run, schema)

    def listed(self, work) -> list[tuple[int, list[int]]]:
        """(row, numbers) of each text, where work(raw, offsets) -> rows and numbers."""

        def run(at: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
            row, number = work(raw, offsets)
            order = np.argsort(row, kind="stable")
            edges = np.searchsorted(row[order], np.arange(len(at) + 1))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(number[order], pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), lists], ["row", "numbers"])

        return [(r["row"], r["numbers"]) for r in self.over(run, "row int, numbers array<int>").collect()]

    def telling(self, label: np.ndarray, ratio: float, score: str, most: int) -> list[tuple[int, int]]:
        """(term, whether dense) of the terms that go with the label (a number from 0 to 1 for each id), at most `most`,
        the highest `score` first (an SQL expression over evidence, odds and k1)."""
        share = self.texts.sparkSession.sparkContext.broadcast(np.round(label * UNIT).astype(np.int64))

        def count(at: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
            text, h, dense, various = present(raw, offsets)
            out = []
            for kind, on in enumerate((np.ones(len(h), bool), dense, various)):
                term, place = np.unique(h[on], return_inverse=True)
                one = share.value[at[text[on]]]
                k1, n = np.bincount(place, one, len(term)), np.bincount(place, minlength=len(term))
                out.append((term.view(np.int64), np.full(len(term), kind, np.int32), k1.astype(np.int64), (n * UNIT - k1).astype(np.int64)))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["term", "kind", "k1", "k0"])

        n1 = float(share.value.sum()) / UNIT
        n0 = len(self.ids) - n1
        if min(n1, n0) <= 0:
            return []
        summed = self.over(count, "term long, kind int, k1 long, k0 long").groupBy("term", "kind").agg((F.sum("k1") / UNIT).alias("k1"), (F.sum("k0") / UNIT).alias("k0"))
        part = lambda k, n: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) * (n1 + n0) / ((F.col("k1") + F.col("k0")) * n))).otherwise(0.0)
        found = summed.where("k1 >= 1").select("term", "kind", "k1", (2 * (part("k1", n1) + part("k0", n0))).alias("evidence"), (F.col("k1") / n1 / ((F.col("k0") + 0.5) / n0)).alias("odds"))
        clear = found.where((F.col("odds") >= ratio) & (F.col("evidence") >= F.when(F.col("kind") == 2, VARIOUS).otherwise(EVIDENCE)))
        ranked = clear.groupBy("term", F.least("kind", F.lit(1)).alias("kind")).agg(F.max(F.expr(score)).alias("score")).orderBy(F.desc("score"), "term", "kind").limit(most).collect()
        return [(r["term"] % (1 << 64), r["kind"]) for r in ranked]


def filled(n: int, width: int, lists: list[tuple[int, list[int]]]) -> np.ndarray:
    """(n, width) of ones and zeros from (row, columns of the ones)."""
    out = np.zeros((n, width), bool)
    for row, columns in lists:
        out[row, columns] = True
    return out


def hashes(found: list[tuple[int, int]], most: int | None = None) -> np.ndarray:
    """The first `most` different terms, sorted."""
    return np.sort(np.array(list(dict.fromkeys(h for h, _ in found))[:most], np.uint64))


def fit(sample: Sample, label: np.ndarray) -> Model:
    """label: 0 or 1 for each id of the sample."""
    nothing = Model(np.zeros(0, np.uint64), np.zeros(1), -40.0)
    candidates = sample.telling(label, RATIO, "evidence", CANDIDATES)
    if not candidates:
        return nothing
    spark, lexicon = sample.texts.sparkSession, Lexicon(hashes(candidates))
    column = np.full((2, len(lexicon.vocabulary)), -1)
    for i, (h, kind) in enumerate(candidates):
        column[kind, np.searchsorted(lexicon.vocabulary, np.uint64(h))] = i
    n, told = len(candidates), spark.sparkContext.broadcast((lexicon, column))

    def vote(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lexicon, column = told.value
        text, term, dense, share = lexicon.found(raw, offsets)
        by_pattern, pattern = np.nonzero(patterns(raw, offsets))
        row = np.concatenate([text, text[dense], by_pattern, np.arange(len(share))])
        number = np.concatenate([column[0, term], column[1, term[dense]], pattern + n, np.where(share >= DENSE, n + 4, np.where(share == 0, n + 5, n + 6))])
        return row[number >= 0], number[number >= 0]

    votes = filled(len(label), n + 7, sample.listed(vote))
    votes = np.concatenate([votes[:, :n][:, apart(votes[:, :n])], votes[:, n:]], axis=1)
    posterior, _ = label_model(votes, np.where(votes[:, -3], 0.9, 0.05), float(label.mean()), 3, 2)
    picked = sample.telling(posterior, np.e, "ln(odds) * sqrt(k1)", 2 * TERMS)
    if not picked:
        return nothing
    vocabulary = hashes(picked, TERMS)
    chosen = spark.sparkContext.broadcast(Lexicon(vocabulary))
    x = filled(len(label), 2 * len(vocabulary) + 1, sample.listed(lambda raw, offsets: inputs(raw, offsets, chosen.value)))
    return Model(vocabulary, *logistic(x.astype(float), posterior))


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """docs, labels: rows that may be learned from. DOCS texts of each label at most are taken, whole."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("label")).where("id is not null and label in (0, 1)")
    picked = [(r["id"], r["label"]) for r in sample(known.distinct(), "label", "id", 2 * DOCS).collect()]  # some may not be in docs
    stages = Stages(spark, "toxicity")
    wanted = spark.createDataFrame(picked, "id long, label int")
    found = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).where("octet_length(text) > 0")
    texts = stages.put(found.join(F.broadcast(wanted), "id").groupBy("id", "label").agg(F.min("text").alias("text")))  # one of repeated rows

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=SLICE):
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(copy_keys(*utf8(b.column("text"))), pa.list_(pa.int64()))], ["id", "label", "keys"])

    rows = texts.mapInArrow(keyed, "id long, label int, keys array<long>").orderBy(F.xxhash64("id"), "id", "label").collect()
    own = [r for label in (0, 1) for r in [r for r in rows if r["label"] == label][:DOCS]]
    kept = dict(without_copies([(r["id"], r["label"], r["keys"]) for r in own]))
    ids = np.array(sorted(kept), np.int64)
    label = np.array([kept[i] for i in ids.tolist()], float)
    model = fit(Sample(texts, ids), label) if len(set(kept.values())) == 2 else Model(np.zeros(0, np.uint64), np.zeros(1), -40.0)
    stages.drop(texts)
    return model


def classify(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted (1 if score >= threshold)."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value.vocabulary)
        for b in slices(batches, limit=SLICE):
            p = scores(*utf8(b.column("text")), shared.value, lexicon)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    found = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return found.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, score double, predicted int").withColumnRenamed("id", id_col)
