"""Document quality by a byte-level convolutional network in numpy (operator 6).

A text is cut into chunks of CHUNK bytes that overlap by OVERLAP, over its whole length. FILTERS learned filters slide over
the bytes of a chunk (each byte through a learned embedding), WIDTH bytes wide and STRIDE apart; their largest response
over a chunk, floored at zero, is the chunk's vector. A text is the mean and the maximum of its chunks' vectors; a learned
linear layer turns both into one probability.

Training takes a bounded sample: DOCS texts for each label, of which up to CHUNKS chunks each, spread over the whole text.
Prediction reads every byte; filters and embedding are folded into tables of byte pairs, so a response is a sum of
WIDTH / 2 table rows.

Defined results: null text is the empty text, an empty chunk of zero bytes; without training rows of two labels every
score is 0.5; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, slices, utf8
from .training import sample

DOCS, CHUNKS = 1200, 12
CHUNK, OVERLAP = 512, 32
FILTERS, WIDTH, STRIDE, DEPTH = 16, 8, 2, 8
STEPS, BATCH, RATE = 450, 64, 3e-3
PER_CALL = 256  # chunks whose responses are held at once


@dataclass
class Model:
    """embedding (256, DEPTH); kernel (WIDTH, DEPTH, FILTERS); bias (FILTERS); weight (2 * FILTERS); offset."""

    embedding: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    constant: bool = False

    def pair_tables(self) -> np.ndarray:
        """(WIDTH / 2, 65536, FILTERS): response of each filter to each pair of bytes at each place (little-endian)."""
        single = np.einsum("bd,wdf->wbf", self.embedding, self.kernel).astype(np.float32)
        return np.stack([(single[2 * j + 1][:, None, :] + single[2 * j][None, :, :]).reshape(65536, -1) for j in range(WIDTH // 2)])


def chunk_edges(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the chunks of a text of `size` bytes. They begin at even places; the last one is moved back so that
    it is full, or lacks one byte, and ends with the text."""
    if size <= CHUNK:
        return np.array([0]), np.array([size])
    begin = np.arange(0, size - OVERLAP, CHUNK - OVERLAP)
    begin = np.minimum(begin, size - CHUNK + size % 2)
    return begin, np.minimum(begin + CHUNK, size)


def chunk_rows(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(chunks, CHUNK) bytes, padded with zero."""
    at = begin[:, None] + np.arange(CHUNK)
    rows = raw[np.minimum(at, max(0, len(raw) - 1))] if len(raw) else np.zeros(at.shape, np.uint8)
    return np.where(at < end[:, None], rows, 0).astype(np.uint8)


def pooled(rows: np.ndarray, tables: np.ndarray, bias: np.ndarray, winners: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Largest response of each filter over each chunk (chunks, FILTERS), floored at zero; and where it is, in strides."""
    pairs = rows.view("<u2")
    steps = pairs.shape[1] - WIDTH // 2 + 1
    out = np.empty((len(rows), len(bias)), np.float32)
    where = np.empty((len(rows), len(bias)), np.int32) if winners else None
    for i in range(0, len(rows), PER_CALL):
        part = pairs[i : i + PER_CALL]
        response = tables[0][part[:, :steps]]
        for j in range(1, WIDTH // 2):
            response += tables[j][part[:, j : j + steps]]
        out[i : i + PER_CALL] = response.max(axis=1)
        if winners:
            where[i : i + PER_CALL] = response.argmax(axis=1)
    return np.maximum(out + bias, 0), where


def combined(vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, 2 * FILTERS): mean and maximum of the chunks of each text. starts: first chunk of each text."""
    n = np.diff(np.append(starts, len(vectors)))[:, None]
    return np.concatenate([np.add.reduceat(vectors, starts, axis=0) / n, np.maximum.reduceat(vectors, starts, axis=0)], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[tuple[int, list[bytes]]], seed: int = 3) -> Model:
    """Adam steps on the logistic loss, with both labels weighing the same. rows: (label, chunks) of each text."""
    rng = np.random.default_rng(seed)
    scale = (WIDTH * DEPTH) ** -0.5
    p = {"embedding": rng.normal(0, 1, (256, DEPTH)), "kernel": rng.normal(0, scale, (WIDTH, DEPTH, FILTERS)), "bias": np.zeros(FILTERS), "weight": rng.normal(0, 0.1, 2 * FILTERS), "offset": np.zeros(1)}
    labels = np.array([y for y, _ in rows])
    if len(set(labels.tolist())) < 2:
        return Model(*(p[k] for k in ("embedding", "kernel", "bias", "weight")), 0.0, True)
    weight_of = {y: len(labels) / (2 * (labels == y).sum()) for y in (0, 1)}
    chunks = [np.frombuffer(b"".join(c.ljust(CHUNK, b"\0") for c in found), np.uint8).reshape(-1, CHUNK) for _, found in rows]
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    t = 0
    epochs = -(-STEPS // -(-len(rows) // BATCH))
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            x = np.concatenate([chunks[j] for j in part])
            n = np.array([len(chunks[j]) for j in part])
            starts = np.cumsum(n) - n
            text = np.repeat(np.arange(len(part)), n)
            model = Model(p["embedding"], p["kernel"], p["bias"], p["weight"], 0.0)
            v, where = pooled(x, model.pair_tables(), p["bias"].astype(np.float32), True)
            z = combined(v, starts)
            y = labels[part]
            error = (sigmoid(z @ p["weight"] + p["offset"]) - y) * np.array([weight_of[k] for k in y]) / len(part)
            g = {"weight": z.T @ error + 1e-4 * p["weight"], "offset": np.array([error.sum()])}
            top = v == z[text, FILTERS:]
            up = error[text][:, None] * (p["weight"][:FILTERS] / n[text][:, None] + p["weight"][FILTERS:] * top) * (v > 0)
            g["bias"] = up.sum(axis=0)
            g["kernel"], g["embedding"] = np.zeros_like(p["kernel"]), np.zeros_like(p["embedding"])
            for f in range(FILTERS):
                on = np.flatnonzero(up[:, f])
                seen = x[on[:, None], where[on, f][:, None] * STRIDE + np.arange(WIDTH)]
                g["kernel"][:, :, f] = np.einsum("n,nwd->wd", up[on, f], p["embedding"][seen])
                for w in range(WIDTH):
                    g["embedding"] += np.bincount(seen[:, w], up[on, f], 256)[:, None] * p["kernel"][w, :, f]
            t += 1
            rate = RATE * (1 if epoch < epochs * 2 // 3 else 0.3)
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                p[k] = p[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
    return Model(p["embedding"], p["kernel"], p["bias"].astype(np.float32), p["weight"], float(p["offset"][0]))


def spread(text: str | None) -> list[bytes]:
    """Up to CHUNKS chunks of a text, spread over its whole length."""
    raw = (text or "").encode()
    begin, end = chunk_edges(len(raw))
    pick = np.unique(np.linspace(0, len(begin) - 1, min(CHUNKS, len(begin))).astype(int))
    return [raw[begin[i] : end[i]] for i in pick]


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """docs, labels: rows that may be learned from. At most DOCS texts of each label and CHUNKS chunks of each reach the driver."""
    spark = docs.sparkSession
    known = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("label")).where("id is not null and label in (0, 1)")
    picked = [(r["id"], r["label"]) for r in sample(known.distinct(), "label", "id", 2 * DOCS).collect()]  # twice, as some may not be in docs
    if not picked:
        return fit([])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array([spread(t) for t in b.column("text").to_pylist()], pa.list_(pa.binary()))], ["id", "label", "chunks"])

    wanted = spark.createDataFrame(picked, "id long, label int")
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).where("text is not null")
    held = texts.join(F.broadcast(wanted), "id").select("id", "label", "text").mapInArrow(cut, "id long, label int, chunks array<binary>")
    rows = held.groupBy("id", "label").agg(F.min("chunks").alias("chunks")).collect()  # one of repeated rows
    out = []
    for label in (0, 1):
        out += [(label, [bytes(c) for c in r["chunks"]]) for r in sorted(rows, key=lambda r: r["id"]) if r["label"] == label][:DOCS]
    model = fit(out)
    if not model.constant:  # the fit holds both labels for equally frequent
        counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
        model.offset += math.log(counts[1] / counts[0])
    return model


def scores(raw: np.ndarray, offsets: np.ndarray, model: Model, tables: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each text, from all of its bytes."""
    if model.constant:
        return np.full(len(offsets) - 1, 0.5)
    begins, ends, starts = [], [], []
    n = 0
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        x, y = chunk_edges(b - a)
        begins.append(x + a)
        ends.append(y + a)
        starts.append(n)
        n += len(x)
    if not n:
        return np.zeros(0)
    rows = chunk_rows(raw, np.concatenate(begins), np.concatenate(ends))
    v, _ = pooled(rows, tables, model.bias)
    return sigmoid(combined(v, np.array(starts)) @ model.weight + model.offset)


def scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with a column `text`, and the score of each row."""
    tables = model.pair_tables()
    for b in slices(batches, limit=1 << 18):
        yield b, scores(*utf8(b.column("text")), model, tables)


def classify(docs: DataFrame, model: Model, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted (1 if score >= threshold)."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, p in scored(batches, shared.value):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    found = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return found.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, score double, predicted int").withColumnRenamed("id", id_col)
