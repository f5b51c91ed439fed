"""Mixture-controlled packing by deficit round-robin over source queues (operator 2).

1. One pass tokenises the texts and writes, with each document's ids, its place in the queue of its source among the
   rows of its own task. Only counts of tokens by task and source are shuffled; their running totals give every document
   its place in the whole queue.
2. The driver holds one number for each queue; every source has its own. It runs the
   round-robin over one frame of FRAME windows (more where sources are many): each window credits each queue with its share of 2048 tokens, serves the
   whole tokens of the credit, gives what is left to the largest deficits and carries the rest to the next window. A
   frame ends without deficits, so it repeats until a queue runs short; then the shares are drawn up anew. The schedule
   grows with the number of sources, not with the corpus, and is the same in every partition.
3. A second pass over the written ids looks up each document's pieces in the schedule; no ids are shuffled.

Every window is full but the last. Defined results: null text is the empty text, one end token; a null source is a queue
of its own; repeated rows are packed as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import Stages, bounded_batches, running_total, slices
from .bpe import PATTERN, load_ranks

FRAME = 16
BROADCAST_ROWS = 100_000  # of (task, source) offsets; beyond that they are joined by a shuffle
SPECIAL = "<|endoftext|>"


class Tokenizer:
    """The ids that the tokenizers library gives for a byte-level BPE file, without added tokens, by the same ranks."""

    def __init__(self, path: str):
        if path.endswith(".tiktoken"):
            ranks, special = load_ranks(path), {}
        else:
            ranks, special = ranks_of_json(path)
        self.special = special
        self.library = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.library.encode(text, allowed_special="all"), np.uint32)
        return self.library.encode_to_numpy(text, disallowed_special=())


def ranks_of_json(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Vocabulary of a byte-level BPE file as bytes, and its added tokens. Bytes are written as printable characters:
    those that are printable stand for themselves, the others follow from 256 in order."""
    import json

    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in found["added_tokens"]}
    return {bytes(byte_of[c] for c in k): v for k, v in found["model"]["vocab"].items() if k not in special}, special


@functools.lru_cache(2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


@dataclass
class Phase:
    """frames repetitions of one frame. window: the first one's number. start: what each queue has given before.
    served: tokens that each queue has given within the frame before each of its windows (windows + 1, queues)."""

    window: int
    frames: int
    start: np.ndarray
    served: np.ndarray


def round_robin(quota: np.ndarray, size: int) -> np.ndarray:
    """Deficit round-robin over one frame: quota tokens of each queue, in windows of `size` (the last may be short)."""
    total = int(quota.sum())
    windows = -(-total // size)
    served, credit = [np.zeros(len(quota), np.int64)], np.zeros(len(quota), np.int64)  # credit in total-ths of a token
    for w in range(windows):
        room = min(size, total - w * size)
        credit += quota * room
        give = np.minimum(np.maximum(credit // total, 0), quota - served[-1])
        left = room - int(give.sum())
        while left > 0:  # the largest deficits first; lower queue numbers on ties
            rest = np.where(give < quota - served[-1], credit - give * total, -(1 << 62))
            for q in np.argsort(-rest, kind="stable")[:left]:
                if give[q] < quota[q] - served[-1][q] and left:
                    give[q] += 1
                    left -= 1
        credit -= give * total
        served.append(served[-1] + give)
    return np.array(served, np.int32)


def shares(left: np.ndarray, target: np.ndarray | None, tokens: int) -> np.ndarray:
    """Whole tokens of each queue for a frame: by target proportions, or by what is left; no more than there is."""
    out, weight = np.zeros(len(left), np.int64), (left if target is None else np.where(left > 0, target, 0)).astype(float)
    while (room := tokens - int(out.sum())) > 0:
        free = left - out
        w = np.where(free > 0, np.maximum(weight, 1e-12), 0)
        add = np.minimum(np.floor(room * w / w.sum()).astype(np.int64), free)
        if not add.any():
            add[np.argsort(-np.where(free > 0, w, -1), kind="stable")[: min(room, int((free > 0).sum()))]] = 1
        out += add
    return out


def schedule(totals: list[int], size: int, target: list[float] | None = None) -> list[Phase]:
    """Phases that serve all tokens of all queues. Their number is bounded by that of the queues, not by the tokens."""
    left, start, window, out = np.array(totals, np.int64), np.zeros(len(totals), np.int64), 0, []
    goal = None if target is None else np.array(target, float)
    frame = size * max(FRAME, -(-4 * len(totals) // size))  # tokens; some of each queue
    while left.sum() > 0:
        quota = shares(left, goal, int(min(frame, left.sum())))
        used = quota > 0
        frames = int((left[used] // quota[used]).min()) if quota.sum() == frame else 1
        served = round_robin(quota, size)
        out.append(Phase(window, frames, start.copy(), served))
        start += quota * frames
        left -= quota * frames
        window += frames * (len(served) - 1)
    return out


class Places:
    """Where the tokens of documents go: the windows that a queue is served in, as arrays."""

    def __init__(self, phases: list[Phase]):
        self.phases = phases
        self.before = [np.hstack([np.zeros((len(p.served) - 1, 1), np.int64), np.cumsum(np.diff(p.served, axis=0), axis=1)]) for p in phases]

    def of(self, queue: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Which document, position in the queue, length, window, offset; documents hold the tokens a..b of the queue."""
        found = [[] for _ in range(5)]
        for p, before in zip(self.phases, self.before, strict=True):
            quota, first, mine = int(p.served[-1, queue]), int(p.start[queue]), p.served[:, queue]
            if not quota:
                continue
            x, y = np.maximum(a, first) - first, np.minimum(b, first + quota * p.frames) - first
            docs = np.flatnonzero(y > x)
            if not len(docs):
                continue
            steps = len(mine) - 1
            slot = lambda v: (v // quota) * steps + np.searchsorted(mine, v % quota, "right") - 1
            lo, hi = slot(x[docs]), slot(y[docs] - 1)
            n = hi - lo + 1
            who = np.repeat(docs, n)
            w = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            frame, k = np.divmod(w, steps)
            begin = np.maximum(frame * quota + mine[k], x[who])
            end = np.minimum(frame * quota + mine[k + 1], y[who])
            full = end > begin
            values = (who, begin + first, end - begin, p.window + w, before[k, queue] + begin - frame * quota - mine[k])
            for out, v in zip(found, values, strict=True):
                out.append(v[full])
        return tuple(np.concatenate(v) if v else np.zeros(0, np.int64) for v in found)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = 2048, target: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    target: wanted proportion of each source; None: what is left of each, so that all queues end together and every
    window has the proportions of the corpus.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    stages = Stages(spark, "packing")
    key = docs.schema[id_col].dataType.simpleString()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, seen = tokenizer(tokenizer_path), TaskContext.get().partitionId(), {}
        for b in slices(batches):
            ids, local, counts = [], [], []
            for text, source in zip(b.column("text").to_pylist(), b.column("source").to_pylist(), strict=True):
                got = np.append(tok.ids(text or ""), np.uint32(end_id))
                local.append(seen.get(source, 0))
                counts.append(len(got))
                seen[source] = local[-1] + len(got)
                ids.append(got.astype("<u2" if got.max() < 1 << 16 else "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("source"), pa.array([part] * len(ids), pa.int32()), pa.array(local, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["id", "source", "part", "local", "doc_tokens", "ids"])

    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), F.coalesce(docs[source_col].cast("string"), F.lit("\0")).alias("source"))
    told = stages.put(texts.mapInArrow(tokenise, f"id {key}, source string, part int, local long, doc_tokens long, ids binary"))
    by_task = told.groupBy("source", "part").agg(F.sum("doc_tokens").alias("tokens"))
    own = sorted(r["source"] for r in by_task.select("source").distinct().collect())
    queues = spark.createDataFrame(list(zip(own, range(len(own)), strict=True)), "source string, queue int")
    based = running_total(by_task.join(F.broadcast(queues), "source"), "queue", "part", "tokens", "base")
    bases = stages.put(based.select("source", "part", "queue", "base", "tokens"))
    sums = {r["queue"]: r["n"] for r in bases.groupBy("queue").agg(F.sum("tokens").alias("n")).collect()}  # a row a source
    totals = [sums[i] for i in range(len(own))]
    goal = None
    if target is not None:
        named = {("\0" if s is None else s): p for s, p in target.items()}
        goal = [named.get(s, 0.0) for s in own]
    phases = schedule(totals, size, goal)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(phases)
        for b in slices(batches, "ids"):
            base = b.column("base").to_numpy() + b.column("local").to_numpy()
            tokens = b.column("doc_tokens").to_numpy()
            queues = b.column("queue").to_numpy()
            raw = b.column("ids").to_pylist()
            ids = [x if len(x) == 4 * n else np.frombuffer(x, "<u2").astype("<u4").tobytes() for x, n in zip(raw, tokens.tolist(), strict=True)]
            found = []
            for q in np.unique(queues):
                rows = np.flatnonzero(queues == q)
                who, at, *more = places.of(int(q), base[rows], base[rows] + tokens[rows])
                found.append((rows[who], at, *more))
            who, at, n, window, offset = (np.concatenate(x) for x in zip(*found, strict=True))
            start = at - base[who]
            crc = [zlib.crc32(memoryview(ids[d])[4 * s : 4 * (s + k)]) for d, s, k in zip(who.tolist(), start.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(who)), *map(pa.array, (start, n)), pa.array(crc, pa.int64()), pa.array(tokens[who]), pa.array(window), pa.array(offset), b.column("source").take(pa.array(who))], ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    few = bases.count() <= BROADCAST_ROWS
    placed = told.join((F.broadcast if few else lambda x: x)(bases.select("source", "part", "queue", "base")), ["source", "part"])
    out = placed.select("id", "source", "local", "doc_tokens", "ids", "queue", "base").mapInArrow(cut, f"id {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string")
    return out.withColumn("source", F.when(F.col("source") != "\0", F.col("source"))).withColumnRenamed("id", id_col)
