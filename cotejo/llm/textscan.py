"""Whole Arrow batches of text as numpy arrays: code points, words and word hashes, without a loop over characters or documents."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_S33 = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    h = (h ^ (h >> _S33)) * _MIX1
    h = (h ^ (h >> _S33)) * _MIX2
    return h ^ (h >> _S33)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For the basic plane: is it a letter or digit; its lower-case form (its own where that is several characters)."""
    word = np.zeros(0x10000, bool)
    low = np.arange(0x10000, dtype=np.uint32)
    for i in range(0x10000):
        c = chr(i)
        word[i] = c.isalnum() or unicodedata.category(c) in ("Mn", "Mc")
        if len(c.lower()) == 1:
            low[i] = ord(c.lower())
    return word, low


@cache
def _powers() -> np.ndarray:
    return np.cumprod(np.full(4096, _ODD, np.uint64))


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after another, and where each text starts (one more than there are texts). Null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if bufs[2] is None or off[-1] == off[0]:
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(bufs[2], np.uint8)[off[0] : off[-1]]
    text = raw.tobytes().decode("utf-8")
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        # a few texts have separate accents: they are put right one by one, and only they
        return code_points(pa.array([t if t.isascii() else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.large_string())) if any(not unicodedata.is_normalized("NFC", t) for t in texts.to_pylist()) else _points(text, raw, off)
    return _points(text, raw, off)


def _points(text: str, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(cps) == len(raw):
        return cps, off - off[0]
    lead = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
    return cps, lead[off - off[0]]


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut where the texts of a column pass ``limit`` bytes, so that the arrays over their characters stay small."""
    for b in batches:
        size = pa.compute.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // limit
        cuts = np.append(0, np.flatnonzero(np.diff(part)) + 1) if len(part) else np.zeros(0, np.int64)
        for lo, hi in zip(cuts, np.append(cuts[1:], b.num_rows), strict=True):
            yield b.slice(int(lo), int(hi - lo))


@dataclass
class Words:
    """Words of a batch: 64-bit hash of each, and where the words of each text start."""

    hashes: np.ndarray
    starts: np.ndarray


def joined_lines(cps: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words divided by a hyphen at the end of a line made whole again."""
    if len(cps) < 4:
        return cps, off
    word, _ = _tables()
    cut = np.flatnonzero((cps[1:-1] == 45) & (cps[2:] == 10)) + 1
    cut = cut[(cut + 2 < len(cps))]
    if not len(cut):
        return cps, off
    letter = lambda c: word[np.where(c < 0x10000, c, 0)] & ~((c >= 48) & (c <= 57))
    cut = cut[letter(cps[cut - 1]) & letter(cps[cut + 2])]
    gone = np.zeros(len(cps), bool)
    gone[cut] = gone[cut + 1] = True
    return cps[~gone], off - np.append(0, np.cumsum(gone))[off]


def words_of(texts: pa.Array) -> Words:
    """Words compared without letter case, punctuation, spacing and line breaks: runs of letters and digits, in lower case."""
    cps, off = joined_lines(*code_points(texts))
    word, low = _tables()
    if not len(cps):
        return Words(np.zeros(0, np.uint64), np.zeros(len(off), np.int64))
    basic = cps < 0x10000
    if basic.all():
        inside, lower = word[cps], low[cps]
    else:
        safe = np.where(basic, cps, 0)
        inside, lower = word[safe], np.where(basic, low[safe], cps)
        inside[~basic] = [chr(c).isalnum() for c in cps[~basic]]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = off[:-1][(off[:-1] < len(cps)) & (np.diff(off) > 0)]
    begins[at] |= inside[at]
    picked = np.flatnonzero(inside)
    first = np.flatnonzero(begins[picked])
    if not len(first):
        return Words(np.zeros(0, np.uint64), np.zeros(len(off), np.int64))
    place = np.arange(len(picked)) - np.repeat(first, np.diff(np.append(first, len(picked))))
    weighted = (lower[picked].astype(np.uint64) + np.uint64(1)) * _powers()[place & 4095]
    hashes = mix(np.add.reduceat(weighted, first))
    return Words(hashes, np.searchsorted(picked[first], off))


class Windows:
    """Hash of any run of words of a batch in constant time, from one prefix sum."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _ODD, np.uint64)]))
        self.prefix = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:n])])
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]))

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[begin]) * self.back[begin] + (end - begin).astype(np.uint64))
