"""Language identification by a linear-chain conditional random field over words (operator 1).

Features of a word are its byte 2-, 3- and 4-grams within " word " (those at the blanks are its affixes) and, as lexicon,
the whole word; all are hashed into weight tables with one weight for each language. Learned transitions between the
languages of neighbouring words let a word borrow evidence from its context and still switch inside a text.
Forward-backward gives each word the marginal probability of each language; a text has the language with the highest
mean over its words that have letters, and that mean as score.

Training takes a bounded sample: DOCS texts for each language (the training.LABELS most frequent ones), of which WINDOWS
windows of WINDOW words each, chosen over the whole text. Training sequences are joined from windows of one to three
texts, so switches occur. Prediction reads whole texts: words of many texts form one chain, cut into blocks whose
transfer matrices are multiplied in parallel.

Defined results: null text and text without a letter (a character of a letter category in Unicode) is `und` with score 0;
without any training rows everything is; repeated rows give repeated rows; extra columns are ignored; ties go to the label
that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, slices, utf8
from .bpe import LETTER, classes
from .shingles import BYTE, FOLD, word_hashes, words
from .training import sample

DOCS, WINDOWS, WINDOW = 400, 6, 40
TABLE_BITS = 16
GRAMS = (2, 3, 4)
EPOCHS, RATE, DECAY, BATCH = 6, 0.5, 1e-6, 64
LEXICON = 20_000
UNDETERMINED = "und"

ASCII_LETTERS = np.zeros(256, bool)
ASCII_LETTERS[65:91] = ASCII_LETTERS[97:123] = True


def folded(raw: np.ndarray) -> np.ndarray:
    """Lower-cased A-Z and U+00C0 to U+00DE."""
    out = FOLD[raw]
    second = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)) + 1
    out[second] += 0x20
    return out


def letters(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Number of letters of each word: characters whose general category in Unicode is one of the letters'."""
    is_letter = ASCII_LETTERS[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if len(lead):
        at = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.int32)
        first, second, third, fourth = (at[lead + k] for k in range(4))
        two, three = (first & 0x1F) << 6 | second & 0x3F, (first & 0x0F) << 12 | (second & 0x3F) << 6 | third & 0x3F
        four = (first & 0x07) << 18 | (second & 0x3F) << 12 | (third & 0x3F) << 6 | fourth & 0x3F
        is_letter[lead] = classes()[np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))] == LETTER
    total = np.concatenate([[0], np.cumsum(is_letter)])
    return total[end] - total[begin]


def gram_codes(low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table places of all n-grams of " word " for all words, by n, and where each word's begin (words + 1)."""
    size = end - begin + 2
    edges = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(edges[-1]) - np.repeat(edges[:-1] - begin + 1, size)
    spread = np.full(edges[-1], 32, np.uint8)
    inner = np.ones(edges[-1], bool)
    inner[edges[:-1]] = False
    inner[edges[1:] - 1] = False
    spread[inner] = low[at[inner]]
    codes = BYTE[spread]
    last = np.repeat(edges[1:], size)
    place = np.arange(edges[-1])
    out = np.full((len(GRAMS), edges[-1]), 1 << TABLE_BITS, np.int32)  # the last row of the table is zero
    h = np.zeros(edges[-1], np.uint64)
    for n in range(1, max(GRAMS) + 1):
        size = max(0, edges[-1] - n + 1)
        h = (h[:size] + codes[n - 1 : n - 1 + size]) * np.uint64(0x9E3779B97F4A7C15)
        if n in GRAMS:
            found = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - TABLE_BITS)
            out[GRAMS.index(n), :size] = np.where(place[:size] + n <= last[:size], found, 1 << TABLE_BITS)
    return out, edges


@dataclass
class Model:
    """labels in order; table (places + 1, labels): gram weights; lexicon: sorted word hashes; lexical (words + 1, labels):
    their weights; move: transition probabilities up to a factor; first: the same for a first word."""

    labels: list[str]
    table: np.ndarray
    lexicon: np.ndarray
    lexical: np.ndarray
    move: np.ndarray
    first: np.ndarray

    def lexicon_places(self, h: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.lexicon, h)
        at[at == len(self.lexicon)] = 0
        return np.where(self.lexicon[at] == h, at, len(self.lexicon)) if len(self.lexicon) else np.zeros(len(h), np.int64)

    def emissions(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Scores of each label at each word; every distinct word is scored once."""
        low = folded(raw)
        h, one, back = np.unique(word_hashes(low, begin, end), return_index=True, return_inverse=True)
        codes, edges = gram_codes(low, begin[one], end[one])
        sums = self.lexical[self.lexicon_places(h)]
        for k in range(len(GRAMS)):
            sums += np.add.reduceat(self.table[codes[k]], edges[:-1], axis=0)
        return sums[back]


def marginals(score: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of each label at each word. score (words, labels); first: which words begin a text.

    All texts form one chain: at the beginning of a text the transition is `start`, whatever came before. Blocks of about
    sqrt(words) words multiply their transfer matrices side by side; then vectors run over the blocks, forward and
    backward; then all blocks run through their words from the vectors they got.
    """
    n, k = score.shape
    e = np.exp(score - score.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    width = max(1, int(n**0.5))
    blocks = -(-n // width)
    padded = np.ones((blocks * width, k))
    padded[:n] = e
    begins = np.ones(blocks * width, bool)  # what is padded stands apart
    begins[:n] = first
    begins[0] = True
    e = np.ascontiguousarray(padded.reshape(blocks, width, k).transpose(1, 0, 2))
    begins = begins.reshape(blocks, width).T

    def forward(v: np.ndarray, t: int) -> np.ndarray:
        """v (..., blocks, labels) over word t; normalised."""
        to = np.where(begins[t][..., None], start, v @ move) * e[t]
        return to / to.sum(axis=-1, keepdims=True)

    # Transfer of each block: labels rows at once, with their common scale.
    m = np.broadcast_to(np.eye(k)[:, None, :], (k, blocks, k)).copy()
    for t in range(width):
        m = np.where(begins[t][None, :, None], m.sum(axis=-1, keepdims=True) * start, m @ move) * e[t]
        m /= m.sum(axis=(0, 2), keepdims=True)
    into = np.empty((blocks, k))
    v = np.full(k, 1 / k)
    for b in range(blocks):
        into[b] = v
        v = v @ m[:, b]
        v /= v.sum()
    out_of = np.empty((blocks, k))
    v = np.ones(k)
    for b in range(blocks - 1, -1, -1):
        out_of[b] = v
        v = m[:, b] @ v
        v /= v.sum()
    alpha, v = np.empty((width, blocks, k)), into
    for t in range(width):
        v = forward(v, t)
        alpha[t] = v
    v = out_of
    for t in range(width - 1, -1, -1):
        alpha[t] *= v
        back = e[t] * v
        v = np.where(begins[t][:, None], (back @ start)[:, None], back @ move.T)
        v = v / v.sum(axis=1, keepdims=True)
    p = alpha.transpose(1, 0, 2).reshape(-1, k)[:n]
    return p / p.sum(axis=1, keepdims=True)


def windows(text: str | None, most: int = WINDOWS, size: int = WINDOW) -> list[str]:
    """Up to `most` windows of words, spread over the whole text."""
    found = (text or "").split()
    if len(found) <= size:
        return [" ".join(found)] if found else []
    starts = np.linspace(0, len(found) - size, min(most, len(found) // size)).astype(int)
    return [" ".join(found[i : i + size]) for i in starts]


def sequences(rows: list[tuple[str, list[str]]], seed: int = 5) -> list[tuple[str, list[int]]]:
    """(text, label of each word): windows in random order, joined by one to three. rows: label number, windows."""
    rng = np.random.default_rng(seed)
    all_windows = [(label, w) for label, found in rows for w in found]
    order, out = rng.permutation(len(all_windows)).tolist(), []
    while order:
        part = [all_windows[order.pop()] for _ in range(min(len(order), int(rng.integers(1, 4))))]
        out.append((" ".join(w for _, w in part), [label for label, w in part for _ in w.split(" ")]))
    return out


def fit(rows: list[tuple[str, list[str]]], seed: int = 5) -> Model:
    """Maximises the conditional likelihood of the labels by AdaGrad steps. rows: (label, windows) of each text."""
    labels = sorted({label for label, _ in rows})
    k = len(labels)
    if not k:
        return Model([], np.zeros((1, 0), np.float32), np.zeros(0, np.uint64), np.zeros((1, 0), np.float32), np.ones((0, 0)), np.ones(0))
    number = {label: i for i, label in enumerate(labels)}
    todo = sequences([(number[label], found) for label, found in rows], seed)
    table, move, start = np.zeros(((1 << TABLE_BITS) + 1, k), np.float32), np.zeros((k, k)), np.zeros(k)
    prepared = []
    for i in range(0, len(todo), BATCH):
        part = todo[i : i + BATCH]
        raw, offsets = utf8(pa.array([t for t, _ in part], pa.string()))
        begin, end, count = words(raw, offsets)
        gold = np.concatenate([np.array(y) for _, y in part]) if part else np.zeros(0, int)
        if len(gold) != len(begin):  # a character that only Unicode calls white space stands inside a word
            continue
        low = folded(raw)
        codes, edges = gram_codes(low, begin, end)
        first = np.zeros(len(begin), bool)
        first[(np.cumsum(count) - count)[count > 0]] = True
        prepared.append((codes, edges, word_hashes(low, begin, end), first, gold))
    seen, often = np.unique(np.concatenate([p[2] for p in prepared]) if prepared else np.zeros(0, np.uint64), return_counts=True)
    lexicon = np.sort(seen[np.argsort(-often, kind="stable")[:LEXICON]])
    lexical = np.zeros((len(lexicon) + 1, k), np.float32)
    model = Model(labels, table, lexicon, lexical, np.ones((k, k)), np.ones(k))
    squares = [np.full(x.shape, 1e-2, np.float32) for x in (table, lexical, move, start)]

    def step(x: np.ndarray, g: np.ndarray, s: np.ndarray, at: np.ndarray | None = None) -> None:
        if at is None:
            s += g * g
            x += RATE * g / np.sqrt(s)
        else:
            s[at] += g * g
            x[at] += RATE * g / np.sqrt(s[at]) - DECAY * x[at]

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(prepared)).tolist():
            codes, edges, hashes, first, gold = prepared[i]
            at = np.searchsorted(lexicon, hashes)
            at[at == len(lexicon)] = 0
            at = np.where(lexicon[at] == hashes, at, len(lexicon))
            score = sum(np.add.reduceat(table[codes[j]], edges[:-1], axis=0) for j in range(len(GRAMS))) + lexical[at]
            move_p, start_p = np.exp(move), np.exp(start)
            p = marginals(score, first, move_p, start_p)
            residual = (np.eye(k)[gold] - p).astype(np.float32)
            spread = np.repeat(residual, np.diff(edges), axis=0)
            for j in range(len(GRAMS)):
                places, back = np.unique(codes[j], return_inverse=True)
                g = np.stack([np.bincount(back, spread[:, c], len(places)) for c in range(k)], axis=1).astype(np.float32)
                g[places == 1 << TABLE_BITS] = 0
                step(table, g, squares[0], places)
            places, back = np.unique(at, return_inverse=True)
            g = np.stack([np.bincount(back, residual[:, c], len(places)) for c in range(k)], axis=1).astype(np.float32)
            g[places == len(lexicon)] = 0
            step(lexical, g, squares[1], places)
            inner = np.flatnonzero(~first)
            e = np.exp(score - score.max(axis=1, keepdims=True))
            # Pair marginals: what is before a word and what is after it, from the word marginals' factors.
            pairs = pair_counts(score, first, move_p, start_p, p, e, inner)
            observed = np.zeros((k, k))
            np.add.at(observed, (gold[inner - 1], gold[inner]), 1)
            step(move, observed - pairs, squares[2])
            step(start, residual[first].sum(axis=0).astype(float), squares[3])
    model.move, model.first = np.exp(move - move.max()), np.exp(start - start.max())
    return model


def pair_counts(score: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray, p: np.ndarray, e: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Expected number of each pair of neighbouring labels. With a(t) the forward vector, the pair at t - 1, t has the
    probability of label j at t times a(t - 1, i) move(i, j) over the sum of that over i."""
    n, k = score.shape
    alpha = np.empty((n, k))
    # Forward vectors of all sequences side by side: the sequences are short, so one step a place in the sequence.
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, n))
    v = start * e[begin]
    v /= v.sum(axis=1, keepdims=True)
    alpha[begin] = v
    for t in range(1, int(length.max())):
        on = begin[length > t] + t
        v = (alpha[on - 1] @ move) * e[on]
        alpha[on] = v / v.sum(axis=1, keepdims=True)
    joint = alpha[inner - 1][:, :, None] * move
    return (joint / joint.sum(axis=1, keepdims=True) * p[inner][:, None, :]).sum(axis=0)


def train(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> Model:
    """From at most DOCS texts of each label, of which at most WINDOWS * WINDOW words are taken."""
    rows = docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].cast("string").alias("text"), docs[label_col].cast("string").alias("label")).where("id is not null and label is not null and text is not null")
    picked = sample(rows.select("id", "label"), "label", "id", DOCS)
    wanted = {(r["id"], r["label"]) for r in picked.collect()}  # at most 64 * DOCS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, label, windows(t)) for i, t, label in zip(*(b.column(c).to_pylist() for c in ("id", "text", "label")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.list_(pa.string()))], ["id", "label", "windows"])

    ids = docs.sparkSession.createDataFrame(sorted(wanted), "id string, label string") if wanted else picked
    kept = rows.join(F.broadcast(ids), ["id", "label"]).select("id", "label", "text").mapInArrow(cut, "id string, label string, windows array<string>")
    first = kept.groupBy("id", "label").agg(F.min("windows").alias("windows"))  # one of repeated rows
    found = [(r["label"], [w for w in r["windows"] if w]) for r in sorted(first.collect(), key=lambda r: (r["label"], r["id"]))]
    return fit([x for x in found if x[1]])


def labelled(batch: pa.RecordBatch, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of a batch with a column `text`."""
    raw, offsets = utf8(batch.column("text"))
    texts = len(offsets) - 1
    names, scores = [UNDETERMINED] * texts, np.zeros(texts)
    begin, end, count = words(raw, offsets)
    if not len(begin) or not model.labels:
        return names, scores
    weight = letters(raw, begin, end)
    first = np.zeros(len(begin), bool)
    starts = np.cumsum(count) - count
    first[starts[count > 0]] = True
    p = marginals(model.emissions(raw, begin, end), first, model.move, model.first) * (weight > 0)[:, None]
    full = np.flatnonzero(count)
    sums = np.add.reduceat(p, starts[full], axis=0)
    n = np.add.reduceat((weight > 0).astype(np.int64), starts[full])
    for i, s, m in zip(full.tolist(), sums, n.tolist(), strict=True):
        if m:
            best = int(s.argmax())
            names[i], scores[i] = model.labels[best], min(1.0, float(s[best]) / m)
    return names, scores


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=1 << 18):
            names, scores = labelled(b, shared.value)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(names, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    found = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return found.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("id", id_col)
