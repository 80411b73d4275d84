"""Sizes of texts in tokens of a public byte-pair vocabulary, exact and without encoding every text.

The vocabulary's split pattern only looks at the classes of neighbouring characters, so the pieces of a whole Arrow batch are cut by
numpy masks over its code points. Pieces are hashed, each distinct piece is encoded once per task by the tokenizer itself, and the
size of a text is the sum over its pieces: merges never cross them.

Defined results: null and empty texts have 0 tokens; special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import mix, slices

#: Rank file of a public tokenizer; any other file in the same format may be given.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The split pattern published with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
_SLOTS = 20


def _class_of(code: int) -> int:
    c = chr(code)
    kind = unicodedata.category(c)[0]
    if c.isspace() and not 0x1C <= code <= 0x1F:
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(kind, OTHER)


@cache
def _classes() -> np.ndarray:
    return np.array([_class_of(i) for i in range(0x10000)], np.uint8)


def _raw_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points as they stand (tokens are counted before any normalisation) and where each text starts."""
    texts = (texts.fill_null("") if texts.null_count else texts).cast(pa.large_string())
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if bufs[2] is None or off[-1] == off[0]:
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(bufs[2], np.uint8)[off[0] : off[-1]]
    cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    if len(cps) == len(raw):
        return cps, off - off[0]
    return cps, np.append(0, np.cumsum((raw & 0xC0) != 0x80))[off - off[0]]


def piece_starts(cps: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mask of the code points at which the split pattern begins a piece."""
    n = len(cps)
    if (cps < 0x10000).all():
        kind = _classes()[cps]
    else:
        kind = _classes()[np.where(cps < 0x10000, cps, 0)]
        far = np.flatnonzero(cps >= 0x10000)
        kind[far] = [_class_of(int(c)) for c in cps[far]]
    first = np.zeros(n + 1, bool)
    first[off] = True
    last = first[1:]
    first = first[:n]
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # of white space before other text the last character stands alone, or with the text where it is a plain blank
    space = kind == SPACE
    tail = np.flatnonzero(space[:-1] & ~space[1:] & ~last[:-1]) if n else np.zeros(0, np.int64)
    begins[tail] = True
    plain = tail[cps[tail] == 32]
    begins[plain + 1] = False
    # English endings after an apostrophe that begins a piece
    quote = np.flatnonzero((cps == 39) & begins)
    if len(quote):
        room = lambda k: quote + k < n
        at = lambda k: np.where(room(k), cps[np.minimum(quote + k, n - 1)], 0)
        doc_end = off[np.searchsorted(off, quote, "right")]
        one, two = at(1), at(2)
        short = np.isin(one, [ord(c) for c in "stmd"]) & (quote + 1 < doc_end)
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & (quote + 2 < doc_end)
        for hit, size in ((short, 2), (long & ~short, 3)):
            q = quote[hit]
            begins[q + 1] = False
            nxt = q + size
            begins[nxt[nxt < n]] = True
    return begins


class Counter:
    """Tokens of each text of a batch; remembers the size of every distinct piece it has met."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("cotejo", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.keys = np.zeros(1 << _SLOTS, np.uint64)
        self.sizes = np.zeros(1 << _SLOTS, np.int32)
        self.rest: dict[int, int] = {}
        self.powers = np.cumprod(np.full(1 << 16, np.uint64(0x9E3779B97F4A7C15)))

    def count(self, texts: pa.Array) -> np.ndarray:
        cps, off = _raw_points(texts)
        if not len(cps):
            return np.zeros(len(texts), np.int64)
        heads = np.flatnonzero(piece_starts(cps, off))
        place = np.arange(len(cps)) - np.repeat(heads, np.diff(np.append(heads, len(cps))))
        h = mix(np.add.reduceat((cps.astype(np.uint64) + np.uint64(1)) * self.powers[place & 0xFFFF], heads)) | np.uint64(1)
        slot = (h >> np.uint64(64 - _SLOTS)).astype(np.int64)
        known = self.keys[slot] == h
        if not known.all():
            miss = np.flatnonzero(~known)
            new, where = np.unique(h[miss], return_index=True)
            ends = np.append(heads[1:], len(cps))
            for x, k in zip(new.tolist(), miss[where].tolist(), strict=True):
                if x in self.rest:
                    continue
                piece = cps[heads[k] : ends[k]].tobytes().decode("utf-32-le")
                size = len(self.encoding.encode_ordinary(piece))
                s = x >> (64 - _SLOTS)
                if self.keys[s] == 0:
                    self.keys[s], self.sizes[s] = x, size
                else:
                    self.rest[x] = size
            known = self.keys[slot] == h
        sizes = self.sizes[slot].astype(np.int64)
        odd = np.flatnonzero(~known)
        if len(odd):
            sizes[odd] = [self.rest[x] for x in h[odd].tolist()]
        total = np.append(0, np.cumsum(sizes))
        at = np.searchsorted(heads, off)
        return np.diff(total[at])


def _counting(path: str):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for b in slices(batches, b_text):
            counter = counter or Counter(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
            yield pa.RecordBatch.from_arrays([*b.columns[:b_text], pa.array(counter.count(b.column(b_text)), pa.int64())], names=["doc_id", "source", "tokens"])

    b_text = 2
    return run


def token_sizes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str | None = "source", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, tokens) of every document, counted where it lies; the vocabulary travels with the job."""
    spark = docs.sparkSession
    if vocabulary not in getattr(spark.sparkContext, "_cotejo_files", set()):
        spark.sparkContext.addFile(vocabulary)
        spark.sparkContext._cotejo_files = getattr(spark.sparkContext, "_cotejo_files", set()) | {vocabulary}
    src = F.col(source).cast("string") if source else F.lit(None).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), src.alias("source"), F.col(text).cast("string").alias("text")).mapInArrow(_counting(vocabulary), "doc_id long, source string, tokens long")
