"""Token counts with a whole-token shortcut (operator 5).

The model is SentencePiece BPE with the identity normaliser and a dummy prefix: a text becomes a blank sign followed by
the text with its blanks turned into signs. `Counter` proves two things about the vocabulary before it counts:

* no vocabulary string has a blank sign after another character, so merges never cross the place before a blank run.
  Pre-tokens (a blank run and what follows up to the next blank) are then independent and their counts add up;
* which vocabulary strings encode alone as one token: each is given to the library once. A pre-token among them counts
  as one token by a look-up; only the rest is merged, once for each distinct pre-token and then cached.

Where the proof fails (another normaliser, or such a string) every text goes to the library whole.

Defined results: null is the empty text and has no tokens; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from .batches import bounded_batches, slices

SIGN = "▁"
CACHED_CHARS, CACHED_PIECES = 48, 400_000


class Counter(dict):
    """Counts of pre-tokens, without their first blank sign."""

    def __init__(self, model_path: str):
        super().__init__()
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        self.separate = not any(re.search(f"[^{SIGN}]{SIGN}", p) for p in pieces) and self.keeps_blanks()
        words = [p[1:] for p in pieces if p[0] == SIGN and SIGN not in p[1:]] if self.separate else []
        self.proven = {w: 1 for w, ids in zip(words, self.library.encode(words, num_threads=1), strict=True) if len(ids) == 1 and w}
        if self.separate:
            self.proven[""] = 1  # a blank sign of its own, at the end of a text
        self.update(self.proven)

    def keeps_blanks(self) -> bool:
        """The normaliser adds one blank sign in front and changes nothing else in these probes."""
        probes = ["a", " a", "a  b ", " 　x", "ﬁ½ é\n\tA"]
        return all("".join(self.library.encode(p, out_type=str)).replace("<0x0A>", "\n").replace("<0x09>", "\t") == SIGN + p.replace(" ", SIGN) for p in probes)

    def pre_tokens(self, text: str) -> list[str] | None:
        """None: the text has to be encoded whole."""
        if not text:
            return []
        if not self.separate or SIGN in text:  # a sign in the text itself reads as a blank
            return None
        words = text.split(" ")
        return self.joined(words) if "" in words else words

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. What neither is proven nor cached is merged in one call for all texts."""
        split = list(map(self.pre_tokens, texts))
        if len(self) > CACHED_PIECES:
            self.clear()
            self.update(self.proven)
        missing = list(set().union(*filter(None, split)).difference(self))
        merged = dict(zip(missing, map(len, self.library.encode(missing, num_threads=1)), strict=True))
        self.update(merged)
        out = [len(self.library.encode(t, num_threads=1)) if words is None else sum(map(self.__getitem__, words)) for t, words in zip(texts, split, strict=True)]
        for piece in merged:
            if len(piece) > CACHED_CHARS:
                del self[piece]
        return out

    @staticmethod
    def joined(words: list[str]) -> list[str]:
        """Pre-tokens where blanks are doubled: a run of blanks belongs to the word after it; at the end it is its own."""
        out, blanks = [], 0
        for w in words:
            if w:
                out.append(" " * blanks + w)
                blanks = 0
            else:
                blanks += 1
        if blanks:
            out.append(" " * (blanks - 1))
        return out


@functools.lru_cache(2)
def counter(model_path: str) -> Counter:
    return Counter(model_path)


def count_tokens(docs: DataFrame, model_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_path)
        for b in slices(batches):
            texts = pc.fill_null(b.column("text"), "")
            tokens = pa.array(c.count(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), pc.binary_length(texts).cast(pa.int64()), tokens, pc.greater(tokens, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    found = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return found.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
