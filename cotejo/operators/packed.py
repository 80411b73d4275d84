"""Several values packed in one field: one row per value, position kept.

Arrow string buffers are scanned whole: quote parity and delimiter masks are numpy arrays over the bytes of a batch, value bounds
become child offsets of a list array, and the list is flattened with the ordinals of its parents. Records whose quoting is mixed,
nested or broken go through ``split_value``, the same grammar one character at a time; both give the same values.

Defined results: a null, empty or blank field has no values; a delimiter run yields empty values, which are dropped and not
counted; repeated values stay; a quote mark that never closes is ordinary text; other columns of the input do not matter,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HARD = ",;|\n\r\t•·"
SOFT = "-–—/"
CLOSING = {'"': '"', "'": "'", "«": "»", "“": "”"}
LINE_DELIMITERS = "\n\r\t"


def _delimiter_at(s: str, i: int) -> bool:
    c = s[i]
    if c in HARD:
        return True
    return c in SOFT and 0 < i < len(s) - 1 and s[i - 1].isspace() and s[i + 1].isspace()


def _closing(s: str, start: int, mark: str) -> int:
    """Place of the mark that closes a value opened before start: doubled marks are text, and only blanks may stand before what follows."""
    k = s.find(mark, start)
    while k >= 0:
        if s.startswith(mark, k + 1):
            k = s.find(mark, k + 2)
            continue
        m = k + 1
        while m < len(s) and s[m].isspace() and s[m] not in LINE_DELIMITERS:
            m += 1
        if m == len(s) or _delimiter_at(s, m):
            return k
        k = s.find(mark, k + 1)
    return -1


def _inner(s: str, i: int) -> int:
    """End of a quotation inside an unquoted value that opens at i, or i where it is only a mark."""
    if i and not (s[i - 1].isspace() or s[i - 1] in "(["):
        return i
    k = s.find(CLOSING[s[i]], i + 1)
    while k >= 0:
        if k + 1 == len(s) or not s[k + 1].isalnum():
            return k
        k = s.find(CLOSING[s[i]], k + 1)
    return i


def split_value(s: str | None) -> list[str]:
    """The values of one field, in order."""
    out: list[str] = []
    if s is None:
        return out
    i, n = 0, len(s)
    while i < n:
        j = i
        while j < n and s[j].isspace() and s[j] not in LINE_DELIMITERS:
            j += 1
        if j < n and s[j] in CLOSING and (k := _closing(s, j + 1, CLOSING[s[j]])) >= 0:
            mark = CLOSING[s[j]]
            value, i = s[j + 1 : k].replace(mark * 2, mark), k + 1
            while i < n and not _delimiter_at(s, i):
                i += 1
        else:
            e = i
            while e < n and not _delimiter_at(s, e):
                e = (_inner(s, e) if s[e] in CLOSING else e) + 1
            value, i = s[i:e], e
        if value := value.strip():
            out.append(value)
        i += 1
    return out


def _bytes_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array, whatever its own offset; null values have no bytes."""
    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_string())
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0] : off[-1]]


def _pair(b: np.ndarray, *code: int) -> np.ndarray:
    """Mask of the first bytes of a multi-byte character."""
    m = np.zeros(len(b), bool)
    if len(b) >= len(code):
        hit = b[: len(b) - len(code) + 1] == code[0]
        for k, c in enumerate(code[1:], 1):
            hit = hit & (b[k : len(b) - len(code) + 1 + k] == c)
        m[: len(hit)] = hit
    return m


_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_HARD1 = np.zeros(256, bool)
_HARD1[[ord(c) for c in HARD if ord(c) < 128]] = True
_SOFT1 = np.zeros(256, bool)
_SOFT1[[ord(c) for c in SOFT if ord(c) < 128]] = True


def split_array(arr: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Child offsets (one more than there are parents) and the flat values of a string array."""
    off, b = _bytes_of(arr)
    n = len(off) - 1
    if not len(b):
        return np.zeros(n + 1, np.int64), pa.array([], pa.string())
    starts, ends = off[:-1], off[1:]
    parent = np.repeat(np.arange(n), np.diff(off))

    dq, sq = b == 34, b == 39
    open_g, close_g = _pair(b, 0xC2, 0xAB), _pair(b, 0xC2, 0xBB)
    odd = _pair(b, 0xE2, 0x80, 0x9C) | _pair(b, 0xE2, 0x80, 0x9D) | sq
    count = lambda m: np.bincount(parent[m], minlength=n)
    n_dq, n_og, n_cg = count(dq), count(open_g), count(close_g)
    wide = b >= 0x80
    # white space beyond ASCII: only the character machine knows all of it
    rare_ws = _pair(b, 0xC2, 0xA0) | _pair(b, 0xE1, 0x9A, 0x80) | _pair(b, 0xE3, 0x80, 0x80) | _pair(b, 0xC2, 0x85) | _pair(b, 0xE2, 0x80, 0xAF) | _pair(b, 0xE2, 0x81, 0x9F)
    rare_ws |= _pair(b, 0xE2, 0x80) & np.append(np.append(b[2:], 0)[: len(b)] <= 0xA9, False)[: len(b)] & _in_general_spaces(b)
    slow = (count(odd | rare_ws) > 0) | ((n_dq > 0) & (n_og + n_cg > 0)) | (n_dq % 2 == 1) | (n_og != n_cg)

    # quote parity within each record
    running = np.cumsum(dq.astype(np.int64))
    base = np.where(starts > 0, running[np.maximum(starts - 1, 0)], 0)
    depth = np.cumsum(open_g.astype(np.int64) - close_g)
    base_d = np.where(starts > 0, depth[np.maximum(starts - 1, 0)], 0)
    inside = ((running - base[parent]) % 2 == 1) | (depth - base_d[parent] > 0)

    # delimiter masks
    ws = _WS[b]
    before, after = np.append(False, ws[:-1]), np.append(ws[1:], False)
    first, last = np.zeros(len(b), bool), np.zeros(len(b), bool)
    filled = ends > starts
    first[starts[filled]] = True
    last[ends[filled] - 1] = True
    two = _pair(b, 0xC2, 0xB7)
    three = _pair(b, 0xE2, 0x80, 0xA2)
    dash3 = _pair(b, 0xE2, 0x80, 0x93) | _pair(b, 0xE2, 0x80, 0x94)
    soft = _SOFT1[b] & before & after & ~first & ~last
    end3 = np.append(after[2:], [False, False])[: len(b)]
    last3 = np.append(last[2:], [True, True])[: len(b)]
    soft3 = dash3 & before & end3 & ~first & ~last3
    cut = (_HARD1[b] | two | three | soft | soft3) & ~inside
    at = np.flatnonzero(cut)
    width = 1 + two[at] + 2 * (three[at] | soft3[at])

    # value bounds: after each record start and each delimiter, up to the next delimiter or record end
    v_start = np.concatenate([starts, at + width])
    v_end = np.concatenate([ends, at])
    v_parent = np.concatenate([np.arange(n), parent[at]])
    order = np.argsort(v_start, kind="stable")
    v_start, v_parent = v_start[order], v_parent[order]
    # sort ends by (parent, place): each record has as many ends as starts
    e_parent = np.concatenate([np.arange(n), parent[at]])
    e_order = np.lexsort((v_end, e_parent))
    v_end = v_end[e_order]
    s_order = np.lexsort((v_start, v_parent))
    v_start, v_parent = v_start[s_order], v_parent[s_order]

    # outer white space goes
    idx = np.arange(len(b))
    next_text = np.minimum.accumulate(np.where(ws, len(b), idx)[::-1])[::-1]
    prev_text = np.maximum.accumulate(np.where(ws, -1, idx))
    next_text, prev_text = np.append(next_text, len(b)), np.append(prev_text, -1)
    v_start = next_text[v_start]
    v_end = np.where(v_end > 0, prev_text[np.maximum(v_end - 1, 0)] + 1, 0)

    # enclosing quotes
    full = v_end > v_start
    quoted_v = np.zeros(len(v_start), bool)
    has = (np.append(np.cumsum(dq | open_g | close_g), 0))
    marks_in = np.where(full, has[np.maximum(v_end - 1, 0)] - np.where(v_start > 0, has[np.maximum(v_start - 1, 0)], 0), 0)
    cand = np.flatnonzero(full & (marks_in > 0))
    doubled = np.zeros(len(v_start), bool)
    for c in cand:
        raw = bytes(b[v_start[c] : v_end[c]])
        if len(raw) >= 2 and raw[:1] == b'"' and raw[-1:] == b'"' and b'"' not in raw[1:-1].replace(b'""', b""):
            v_start[c], v_end[c], quoted_v[c], doubled[c] = v_start[c] + 1, v_end[c] - 1, True, b'""' in raw[1:-1]
        elif len(raw) >= 4 and raw[:2] == b"\xc2\xab" and raw[-2:] == b"\xc2\xbb" and raw.count(b"\xc2\xab") == 1 and raw.count(b"\xc2\xbb") == 1:
            v_start[c], v_end[c], quoted_v[c] = v_start[c] + 2, v_end[c] - 2, True
        else:
            slow[v_parent[c]] = True
    if quoted_v.any():
        v_start = np.where(quoted_v, next_text[v_start], v_start)
        v_end = np.where(quoted_v & (v_end > 0), prev_text[np.maximum(v_end - 1, 0)] + 1, v_end)
    del wide

    keep = (v_end > v_start) & ~slow[v_parent]
    v_start, v_end, v_parent, doubled = v_start[keep], v_end[keep], v_parent[keep], doubled[keep]
    size = v_end - v_start
    flat_off = np.append(0, np.cumsum(size))
    take = np.arange(flat_off[-1]) - np.repeat(flat_off[:-1], size) + np.repeat(v_start, size)
    values = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(flat_off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(b[take]))).cast(pa.string())
    counts = np.bincount(v_parent, minlength=n)
    if not (slow.any() or doubled.any()):
        return np.append(0, np.cumsum(counts)), values
    # the few records of the character machine, and doubled marks, are put in place
    mine = values.to_pylist()
    for k in np.flatnonzero(doubled):
        mine[k] = mine[k].replace('""', '"')
    merged: list[str] = []
    place = np.append(0, np.cumsum(counts))
    text = arr.to_pylist() if slow.any() else None
    previous = 0
    for k in np.flatnonzero(slow):
        merged += mine[previous : place[k]]
        own = split_value(text[k])
        merged += own
        previous, counts[k] = place[k], len(own)
    merged += mine[previous:]
    return np.append(0, np.cumsum(counts)), pa.array(merged, pa.string())


def _in_general_spaces(b: np.ndarray) -> np.ndarray:
    """First bytes of U+2000..U+200A, U+2028 and U+2029."""
    third = np.append(b[2:], [0, 0])[: len(b)]
    return ((third >= 0x80) & (third <= 0x8A)) | (third == 0xA8) | (third == 0xA9)


def split_packed(df: DataFrame, id_col: str, fields: Sequence[str], at_least: int = 1) -> DataFrame:
    """(id, field_name, value_pos, field_value) of every field with at least ``at_least`` values. No shuffle: each batch is scanned where it lies."""
    names = list(fields)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("field_name", T.StringType()), T.StructField("value_pos", T.IntegerType()), T.StructField("field_value", T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f, name in enumerate(names):
                child, values = split_array(batch.column(f + 1))
                count = np.diff(child)
                wanted = np.repeat(count >= at_least, count)
                ordinal = np.repeat(np.arange(len(count)), count)
                pos = np.arange(len(values)) - np.repeat(child[:-1], count) + 1
                if not wanted.any():
                    continue
                ordinal, pos = ordinal[wanted], pos[wanted]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(ordinal)), pa.array([name]).take(pa.array(np.zeros(len(ordinal), np.int64))), pa.array(pos.astype(np.int32)), values.filter(pa.array(wanted))],
                    names=[id_col, "field_name", "value_pos", "field_value"],
                )

    return df.select(F.col(id_col), *[F.col(c).cast("string").alias(f"_f{k}") for k, c in enumerate(names)]).mapInArrow(scan, schema)
