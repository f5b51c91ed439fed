"""Media columns stored as content-defined chunks (operator 10).

A payload is cut where a rolling gear hash of the last 32 bytes has MASK_BITS zero bits, so equal passages give equal
chunks wherever they stand. The stored form of a payload (its medium) is the ordered list of chunk sizes and digests; the
chunks themselves are in a store.

1. One pass over the texts writes the store: for each payload its list and, as one compressed block, those of its chunks
   that its task has not written before. Payloads that its task has written before are not written again.
2. Digests (no bytes) are grouped to the first place of each chunk in the whole store. A join gives every list entry
   whose chunk has its place in another block; all readers use that one place, other copies in the store are garbage.
3. Payloads whose chunks are all in their own block are read back there. For the others the blocks that hold foreign
   chunks are found by a bitmap of fixed size, so only these blocks are opened for foreign use, and chunks are joined to
   the lists by digest. A bitmap that fills up only makes more blocks pass; the join decides.

Every chunk read back is checked against its digest, every payload against its own; a mismatch raises.

Defined results: null text is the empty text (one sample row of pad bytes); equal texts give equal values; repeated rows
give repeated rows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import SLOTS, Stages, bitmap, bounded_batches, passes, slices, slot_of

UNIT, PAD = 576, b"\xff"
LEAST, MOST, MASK_BITS = 1024, 32768, 12
DIGEST = 16
SEEN = 200_000  # digests that a task remembers; beyond that it starts anew and may write a chunk twice
FORMAT = b"CDC1"

GEAR = np.random.default_rng(20260101).integers(0, 1 << 32, 256, dtype=np.uint32)


def payload_of(text: bytes) -> bytes:
    return text + PAD * (-len(text) % UNIT or (UNIT if not text else 0))


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash of the last 32 bytes at each byte: sum of GEAR[byte] shifted by age, in five doubling steps."""
    h = GEAR[data]
    for k in range(5):
        age = 1 << k
        h[age:] += h[:-age] << np.uint32(age)
    return h


def cuts(candidates: np.ndarray, begin: int, end: int) -> list[int]:
    """Ends of the chunks of the bytes begin..end. A candidate is the place after a byte whose hash has the zero bits."""
    out, at = [], begin
    while end - at > LEAST:
        i = int(np.searchsorted(candidates, at + LEAST))
        found = int(candidates[i]) if i < len(candidates) else end
        at = min(found, at + MOST, end)
        out.append(at)
    if at < end:
        out.append(end)
    return out


def digest_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=DIGEST).digest()


def medium(size: int, sizes: bytes, digests: bytes) -> bytes:
    """The stored form: format, payload size, number of chunks, their sizes, their digests."""
    return FORMAT + size.to_bytes(8, "little") + (len(sizes) // 4).to_bytes(4, "little") + sizes + digests


def feature(payload: bytes, chunks: int) -> str:
    """Of the bytes read back: number of chunks, sum of the samples, number of distinct samples, most frequent sample."""
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    return f"chunks={chunks};sum={int((counts * np.arange(256)).sum())};distinct={int((counts > 0).sum())};mode={int(counts.argmax())}"


STORE = "sha binary, n_bytes long, payload_bytes long, key long, digests binary, sizes binary, here binary, block binary"


def write_store(docs: DataFrame, stages: Stages, id_col: str, text_col: str) -> DataFrame:
    """One row a document: id, digest and sizes of its payload, key of the pack that holds it; and that pack, in the row of
    the first document of its task that has the payload: list and block."""
    names = ["id", *(c.split()[0] for c in STORE.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, payloads, chunks = TaskContext.get().partitionId() << 33, {}, set()
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            data = [payload_of(t) for t in texts]
            whole = np.frombuffer(b"".join(data), np.uint8)
            candidates = np.flatnonzero((gear(whole) >> np.uint32(32 - MASK_BITS)) == 0) + 1
            rows, begin = [], 0
            for text, payload in zip(texts, data, strict=True):
                end, sha = begin + len(payload), hashlib.sha256(payload).digest()
                if sha in payloads:
                    rows.append((sha, len(text), len(payload), payloads[sha], None, None, None, None))
                else:
                    at = [begin, *cuts(candidates, begin, end)]
                    parts = [payload[x - begin : y - begin] for x, y in zip(at, at[1:], strict=False)]
                    digests = [digest_of(p) for p in parts]
                    new = []
                    for d in digests:
                        new.append(d not in chunks)
                        chunks.add(d)
                    block = squeeze.compress(b"".join(p for p, n in zip(parts, new, strict=True) if n))
                    rows.append((sha, len(text), len(payload), key, b"".join(digests), np.diff(at).astype("<u4").tobytes(), bytes(new), block))
                    payloads[sha] = key
                    key += 1
                    if len(chunks) + len(payloads) > SEEN:
                        chunks, payloads = set(), {}
                begin = end
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names)

    found = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return stages.put(found.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, {STORE}"))


def listed(digests: bytes) -> list[bytes]:
    return [digests[i : i + DIGEST] for i in range(0, len(digests), DIGEST)]


def list_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a list entry: digest, key, idx, here."""
    for b in batches:
        keys, idx, digests, here = [], [], [], []
        for key, d, h in zip(*(b.column(c).to_pylist() for c in ("key", "digests", "here")), strict=True):
            each = listed(d)
            digests += each
            keys += [key] * len(each)
            idx += range(len(each))
            here += map(bool, h)
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(keys, pa.int64()), pa.array(idx, pa.int32()), pa.array(here, pa.bool_())], ["digest", "key", "idx", "here"])


def opened(row: dict) -> dict[int, bytes]:
    """Chunks in the row's own block, by place in its list, each checked against its digest. A chunk that the list repeats
    is in the block once."""
    data, at, by = zstandard.ZstdDecompressor().decompress(row["block"]), 0, {}
    digests = listed(row["digests"])
    for n, h, d in zip(np.frombuffer(row["sizes"], "<u4").tolist(), row["here"], digests, strict=True):
        if h:
            by[d] = data[at : at + n]
            at += n
            if digest_of(by[d]) != d:
                raise ValueError(f"a chunk of block {row['key']} does not match its digest")
    return {i: by[d] for i, d in enumerate(digests) if d in by}


HEAD = ["sha", "payload_bytes", "digests", "sizes", "here", "block"]
RESULT = ["key", "read_sha", "tail_crc32", "media_bytes", "media_sha", "feature"]
RESULT_TYPE = "key long, read_sha binary, tail_crc32 long, media_bytes long, media_sha binary, feature string"


def measured(row: dict, chunks: dict[int, bytes]) -> tuple:
    """The result row of a payload put together from the chunks of its list."""
    parts = [chunks[i] for i in range(len(row["sizes"]) // 4)]
    payload = b"".join(parts)
    sha = hashlib.sha256(payload).digest()
    if sha != row["sha"] or len(payload) != row["payload_bytes"]:
        raise ValueError("a payload read back does not match its digest")
    form = medium(len(payload), row["sizes"], row["digests"])
    return row["key"], sha, zlib.crc32(payload[-32:]), len(form), hashlib.sha256(form).digest(), feature(payload, len(parts))


def results(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], RESULT)


def digest_slot(column: str):
    """A slot from the first three bytes of a digest, which are as good as any hash of it."""
    return (F.conv(F.hex(F.substring(column, 1, 3)), 16, 10).cast("int") % SLOTS).cast("int")


def store_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature."""
    bounded_batches(docs.sparkSession)
    stages = Stages(docs.sparkSession, "media")
    store = write_store(docs, stages, id_col, text_col)
    packs = store.where(F.col("digests").isNotNull())
    entries = packs.select("key", "digests", "here").mapInArrow(list_rows, "digest binary, key long, idx int, here boolean")
    places = stages.put(entries.where("here").groupBy("digest").agg(F.min("key").alias("owner")))
    foreign = stages.put(entries.join(places, "digest").where("owner <> key").select("key", "idx", "digest", "owner"))
    lent_bits, borrowers = bitmap(foreign, digest_slot("digest")), bitmap(foreign, slot_of("key"))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "block"):
            rows = b.filter(pa.array(~passes(b.column("slot").to_numpy(), borrowers))).to_pylist()
            yield results([measured(r, opened(r)) for r in rows])

    def lent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in slices(batches, "block"):
            found = []
            for r in b.to_pylist():
                digests = listed(r["digests"])
                slots = np.array([int.from_bytes(d[:3], "big") % SLOTS for d in digests])
                wanted = np.flatnonzero(passes(slots, lent_bits) & (np.frombuffer(r["here"], np.uint8) > 0))
                if len(wanted):
                    chunks = opened(r)
                    found += [(digests[i], r["key"], squeeze.compress(chunks[i])) for i in wanted.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.binary()))], ["digest", "owner", "chunk"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks of the borrowers, still compressed."""
        for b in batches:
            yield b.filter(pa.array(passes(b.column("slot").to_numpy(), borrowers))).select(["key", *HEAD])

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loosen = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for r in b.to_pylist():
                chunks, digests = {c["idx"]: loosen.decompress(c["chunk"]) for c in r["chunks"]}, listed(r["digests"])
                if any(digest_of(c) != digests[i] for i, c in chunks.items()):
                    raise ValueError("a chunk read back does not match its digest")
                rows.append(measured(r, opened(r) | chunks))
            yield results(rows)

    slotted = packs.withColumn("slot", slot_of("key"))
    local = slotted.mapInArrow(alone, RESULT_TYPE)
    mine = slotted.mapInArrow(own, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packs.select("key", *HEAD).schema))
    borrowed = foreign.join(packs.mapInArrow(lent, "digest binary, owner long, chunk binary"), ["digest", "owner"]).select("key", F.struct("idx", "chunk").alias("c"))
    both = mine.withColumn("c", F.lit(None).cast(borrowed.schema["c"].dataType)).unionByName(borrowed, allowMissingColumns=True)
    gathered = both.groupBy("key").agg(F.collect_list("c").alias("chunks"), *(F.first(h, ignorenulls=True).alias(h) for h in HEAD))
    read = stages.put(local.unionByName(gathered.mapInArrow(rebuilt, RESULT_TYPE)))
    hexed = lambda c: F.lower(F.hex(c))
    out = store.select(F.col("id").alias(id_col), "n_bytes", "payload_bytes", "key").join(read, "key")
    return out.select(id_col, "n_bytes", "payload_bytes", hexed("read_sha").alias("payload_sha256"), "tail_crc32", "media_bytes", hexed("media_sha").alias("media_sha256"), "feature")
