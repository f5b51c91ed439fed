"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation (operator 9; packing uses it too).

Pre-tokenisation without regex: every codepoint gets a class (letter, number, white space, other), looked up in one
array; two characters of look-ahead (white space before a non-space, apostrophe before a contraction) are folded into
the class, so that the pattern becomes a finite automaton over 18 symbols. A symbol is a function from state to state;
function composition is associative, so the automaton runs as a blocked scan: all blocks compose their functions in
parallel, the block functions are applied one after the other, then all blocks replay from their true start state.
Slices between boundaries feed a cache of merged pairs; their byte offsets give each token its own, and decoding puts the
bytes of each token at its offset, all in one gather.

Defined results: null text is the empty text; an empty text has no tokens; the digest of no ids is the digest of no
bytes; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .batches import bounded_batches, slices, utf8

# The split pattern of the rank files, the White_Space property of Unicode.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_LAST, SPACE_MORE, WHITE_LAST, WHITE_MORE = range(9)
SYMBOLS = 18  # the second nine: the same at the start of a text
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ATTACHED, IN_WHITE, ONE_LEFT, TWO_LEFT, CLOSED = range(9)
UNKNOWN = 255
CACHED_BYTES, CACHED_PIECES = 48, 300_000


@functools.cache
def classes() -> np.ndarray:
    """Class of each codepoint; UNKNOWN where this Python's Unicode has no such character, as a later one may have it."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        name = unicodedata.category(chr(c))
        out[c] = UNKNOWN if name == "Cn" else kind.get(name[0], OTHER)
    out[WHITE_SPACE] = WHITE_MORE
    out[32] = SPACE_MORE
    return out


def step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a token starts with this character."""
    if symbol >= 9:
        state, symbol = START, symbol - 9
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    if symbol == LETTER and state in (ONE_LEFT, TWO_LEFT):
        return (CLOSED if state == ONE_LEFT else ONE_LEFT), False
    if symbol in run:
        return run[symbol], state not in (run[symbol], ATTACHED)
    if symbol in (SHORT, LONG):
        if state in (IN_OTHERS, ATTACHED):
            return IN_OTHERS, False
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    if symbol == SPACE_LAST:
        return ATTACHED, True
    if symbol == WHITE_LAST:
        return CLOSED, True
    return IN_WHITE, state != IN_WHITE


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """next state [state, symbol]; starts [state, symbol]; composed [function, symbol]; applied [function, state].

    The functions are those that symbols generate by composition, numbered as they are found; 0 is the identity.
    """
    nexts = np.array([[step(s, x)[0] for x in range(SYMBOLS)] for s in range(9)], np.uint8)
    starts = np.array([[step(s, x)[1] for x in range(SYMBOLS)] for s in range(9)], bool)
    found = {tuple(range(9)): 0}
    order, composed = [tuple(range(9))], []
    for f in order:
        row = []
        for x in range(SYMBOLS):
            g = tuple(int(nexts[s, x]) for s in f)
            if g not in found:
                found[g] = len(order)
                order.append(g)
            row.append(found[g])
        composed.append(row)
    return nexts, starts, np.array(composed, np.uint16), np.array(order, np.uint8)


def symbols(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the characters, and which characters are of unknown class. first: where a text begins."""
    kind = classes()[codes]
    unknown = kind == UNKNOWN
    kind = np.where(unknown, OTHER, kind)
    n = len(codes)
    ends = np.ones(n, bool)  # the last character of its text
    ends[:-1] = first[1:]
    white = kind >= SPACE_MORE
    before_word = np.zeros(n, bool)
    before_word[:-1] = ~white[1:] & ~ends[:-1]
    kind = kind - (white & before_word).astype(np.uint8)
    quotes = np.flatnonzero((codes == 39) & ~ends)
    if len(quotes):
        one = codes[quotes + 1]
        kind[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        more = quotes[(quotes + 2 < n)]
        more = more[~ends[more + 1]]
        pair = codes[more + 1].astype(np.uint64) * 0x110000 + codes[more + 2]
        kind[more[np.isin(pair, np.array([ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")], np.uint64))]] = LONG
    return kind + np.where(first, 9, 0).astype(np.uint8), unknown


def token_starts(symbol: np.ndarray) -> np.ndarray:
    """Which characters start a token, by a blocked scan of transition functions."""
    n = len(symbol)
    if not n:
        return np.zeros(0, bool)
    nexts, starts, composed, applied = automaton()
    width = max(1, int(n**0.5))
    blocks = -(-n // width)
    padded = np.zeros(blocks * width, np.uint8)
    padded[:n] = symbol
    rows = np.ascontiguousarray(padded.reshape(blocks, width).T)
    f = np.zeros(blocks, np.uint16)
    for row in rows:
        f = composed[f, row]
    state, at = np.zeros(blocks, np.uint8), START
    for i, g in enumerate(f.tolist()):
        state[i] = at
        at = applied[g, at]
    out = np.empty((width, blocks), bool)
    for k, row in enumerate(rows):
        out[k] = starts[state, row]
        state = nexts[state, row]
    return out.T.ravel()[:n]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder:
    """Encodes slices of texts. special: strings that are one token each wherever they stand (then `split` first)."""

    def __init__(self, path: str, pattern: str = PATTERN):
        ranks = load_ranks(path)
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.merge = self.library._core_bpe.encode_single_piece
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.length = np.array([len(x) for x in self.bytes_of], np.int64)
        self.place = np.cumsum(self.length) - self.length
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.cache: dict[bytes, bytes] = {}

    def piece(self, piece: bytes) -> bytes:
        """Ids of a slice as little-endian 32-bit numbers, merged once and then cached."""
        got = self.cache.get(piece)
        if got is None:
            got = np.array(self.merge(piece), "<u4").tobytes()
            if len(piece) <= CACHED_BYTES:
                if len(self.cache) >= CACHED_PIECES:
                    self.cache.clear()
                self.cache[piece] = got
        return got

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, as bytes; where each text's ids begin, counted in ids (n + 1); and the byte
        offset in `raw` of each token: that of its slice, and what the slice's tokens before it hold."""
        texts = len(offsets) - 1
        data = raw.tobytes()
        codes = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((raw & 0xC0) != 0x80)  # byte offset of each character
        if len(at) != len(codes):  # not UTF-8: replaced characters are bytes of their own
            return self.one_by_one([self.plain(data[x:y]) for x, y in zip(offsets[:-1], offsets[1:], strict=True)], offsets)
        filled = np.flatnonzero(np.diff(offsets))
        first = np.zeros(len(codes), bool)
        begin = np.searchsorted(at, offsets)  # character that each text begins with
        first[begin[:-1][filled]] = True
        symbol, unknown = symbols(codes, first)
        starts = np.flatnonzero(token_starts(symbol))
        slices_at = at[starts]
        edges = slices_at.tolist()
        edges.append(len(data))
        piece, cache = self.piece, self.cache
        parts = [cache.get(p) or piece(p) for p in map(data.__getitem__, map(slice, edges, edges[1:]))]
        sizes = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4, out=sizes[1:])
        begins = sizes[np.searchsorted(starts, begin)]
        out = b"".join(parts)
        if unknown.any():
            odd = set(np.searchsorted(begin, np.flatnonzero(unknown), "right") - 1)
            return self.one_by_one([self.plain(data[offsets[i] : offsets[i + 1]]) if i in odd else out[4 * begins[i] : 4 * begins[i + 1]] for i in range(texts)], offsets)
        held = self.before(out)
        return out, begins, np.repeat(slices_at - held[sizes[:-1]] if len(parts) else slices_at, np.diff(sizes)) + held

    def before(self, ids: bytes) -> np.ndarray:
        """Bytes of all tokens before each."""
        n = self.length[np.frombuffer(ids, "<u4")]
        return np.cumsum(n) - n

    def plain(self, text: bytes) -> bytes:
        return np.array(self.library.encode_ordinary(text.decode("utf-8", "replace")), "<u4").tobytes()

    def one_by_one(self, each: list[bytes], offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        begins = np.cumsum([0, *(len(x) // 4 for x in each)])
        at = [self.before(x) + o for x, o in zip(each, offsets.tolist(), strict=False)]
        return b"".join(each), begins, np.concatenate(at) if at else np.zeros(0, np.int64)

    def decode(self, ids: bytes, starts: np.ndarray, size: int | None = None) -> bytes:
        """The bytes of all tokens, each at its offset, in one gather. size: of the text; without it, up to the last token."""
        token = np.frombuffer(ids, "<u4")
        n = self.length[token]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out = np.zeros(size if size is not None else int(starts[-1] + n[-1]) if len(token) else 0, np.uint8)
        out[np.repeat(starts, n) + inside] = self.all_bytes[np.repeat(self.place[token], n) + inside]
        return out.tobytes()


@functools.lru_cache(2)
def encoder(path: str, pattern: str = PATTERN) -> Encoder:
    """One for each Python worker."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, ids (binary, little-endian unsigned 32-bit), starts (the byte offset of each token)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        for b in slices(batches):
            raw, offsets = utf8(b.column("text"))
            ids, begins, starts = enc.encode(raw, offsets)
            each = [ids[4 * x : 4 * y] for x, y in zip(begins[:-1], begins[1:], strict=True)]
            starts = starts - np.repeat(offsets[:-1], np.diff(begins))
            lists = pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(starts, pa.int64())).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(each, pa.binary()), lists], ["id", "ids", "starts"])

    found = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return found.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, ids binary, starts array<long>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id") -> DataFrame:
    """encoded (id, ids, starts) -> id, decoded (binary: the bytes of each id at its offset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        for b in batches:
            rows = zip(b.column("ids").to_pylist(), b.column("starts").to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([enc.decode(x or b"", np.array(at or [], np.int64)) for x, at in rows], pa.binary())], ["id", "decoded"])

    found = encoded.select(encoded[id_col].alias("id"), "ids", "starts")
    return found.mapInArrow(run, f"id {encoded.schema[id_col].dataType.simpleString()}, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded from ids and offsets, in one pass over the texts."""
    bounded_batches(docs.sparkSession)
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        hexed = lambda x: hashlib.sha256(x).hexdigest()
        for b in slices(batches):
            raw, offsets = utf8(b.column("text"))
            ids, begins, starts = enc.encode(raw, offsets)
            each = [ids[4 * x : 4 * y] for x, y in zip(begins[:-1], begins[1:], strict=True)]
            decoded = memoryview(enc.decode(ids, starts, len(raw)))
            texts = [hexed(decoded[x:y]) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(begins)), pa.array(map(hexed, each), pa.string()), pa.array(texts, pa.string())], names)

    found = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return found.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
