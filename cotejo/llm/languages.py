"""Languages of documents and of their passages by bit-sliced n-gram filters.

A table of bytes is a Bloom filter for all languages at once: bit L of a byte belongs to language L, and the AND of an n-gram's
bytes gives every language that knows it. Per segment the set bits are counted by language, corrected for the filter's rate of
false positives, and the language that explains clearly the most n-grams wins; its share of the n-grams is the confidence.
Segments are sentences; adjacent sentences of one language make a passage.

The filters are built on a bounded sample of labelled rows (``SAMPLE_ROWS`` rows a language of at most ``SAMPLE_CHARS`` characters, longer texts cut
to that where there are too few; those with the smallest hash of their id), cleaned of wrong labels by judging the sample with its own first filters. Everything
else covers all rows and whole texts.

Defined results: rows without an id, and null, empty and letterless texts, have no language and give no row; segments too short to be a sentence or too
unlike any language have none; a label may be a code of two or three letters with or without region, or a name; ties go to the
language that comes first in ``LANGUAGES``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textscan import _tables, code_points, slices

LANGUAGES = ("es", "pt", "en", "fr", "it", "qu")
#: How a label may name each language (ISO 639-1, 639-2 and 639-3 codes, names).
NAMES = {
    "es": "es spa cas spanish español espanol castellano espagnol espanhol spagnolo",
    "pt": "pt por portuguese português portugues portugués portoghese portugais",
    "en": "en eng english inglés ingles inglês anglais inglese",
    "fr": "fr fra fre french francés frances français francais francês francese",
    "it": "it ita italian italiano italien",
    "qu": "qu que quz quy quechua runasimi kichwa quichua",
}
NO_LANGUAGE = ("", "und", "unknown", "n/a", "na", "none", "null", "nil", "mul", "mis", "zxx", "-", "--", "?", "xx", "unk", "desconocido")

GRAM = 5
TABLE_BITS = 20
SAMPLE_ROWS = 400
SAMPLE_CHARS = 6000
#: A sentence has at least so many n-grams and words; its language explains this share of them, and this much more than the next.
LEAST_GRAMS, LEAST_WORDS, SHARE, MARGIN = 30, 6, 0.45, 0.15
#: Text without any sentence end is judged in parts of so many characters.
MOST_CHARS = 1 << 20


def label_language(label: Column) -> Column:
    """The language a label names: one of LANGUAGES, 'other' for another language, null where it names none."""
    plain = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    head = F.split(plain, "[-_ (,;]").getItem(0)
    out = F.when(plain.isin(*NO_LANGUAGE) | ~plain.rlike(r"\p{L}"), F.lit(None))
    for lang in LANGUAGES:
        names = NAMES[lang].split()
        out = out.when(plain.isin(*names) | head.isin(*names), F.lit(lang))
    return out.otherwise(F.lit("other"))


@cache
def _letters() -> np.ndarray:
    word, _ = _tables()
    digits = np.array([chr(i).isnumeric() for i in range(0x10000)])
    return word & ~digits


class Grams:
    """Segments and hashed n-grams of a batch of texts."""

    def __init__(self, texts: pa.Array):
        cps, off = code_points(texts)
        cps = np.where(cps < 0x10000, cps, 0x20).astype(np.uint32)
        self.off, n = off, len(cps)
        letter, (_, low) = _letters()[cps] if n else np.zeros(0, bool), _tables()
        starts = np.zeros(n + 1, bool)
        starts[off[:-1]] = True
        starts = starts[:n]
        if not n:
            self.seg_start = np.zeros(0, np.int64)
            self.seg_doc, self.seg_end, self.words = self.seg_start, self.seg_start, self.seg_start
            self.hash, self.owner = np.zeros(0, np.uint64), self.seg_start
            return
        # a sentence ends at . ; : ! ? before white space, or at an empty line
        space = (cps == 32) | (cps == 10) | (cps == 13) | (cps == 9) | (cps == 0xA0)
        stop = (cps == 46) | (cps == 59) | (cps == 33) | (cps == 63) | (cps == 58)
        ends = np.zeros(n, bool)
        ends[1:] = stop[:-1] & space[1:]
        newline = cps == 10
        ends[1:] |= newline[:-1] & newline[1:]
        # no segment is longer than its counters can count
        begins = ends | starts | ((np.arange(n) - np.repeat(off[:-1], np.diff(off))) % MOST_CHARS == 0)
        self.seg_start = np.flatnonzero(begins)
        self.seg_end = np.append(self.seg_start[1:], n)
        self.seg_doc = np.searchsorted(off, self.seg_start, "right") - 1
        segment = (np.cumsum(begins) - 1).astype(np.int32)
        # letters in lower case, every run of anything else one blank
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        folded = np.where(letter, low[cps], 32)[keep].astype(np.uint64)
        seg = segment[keep]
        first = letter.copy()
        first[1:] &= ~letter[:-1]
        self.words = np.bincount(segment[first], minlength=len(self.seg_start))
        m = len(folded) - GRAM + 1
        if m <= 0:
            self.hash, self.owner = np.zeros(0, np.uint64), np.zeros(0, np.int32)
            return
        h = folded[:m].copy()
        for k in range(1, GRAM):
            h *= np.uint64(0x100000001B3)
            h += folded[k : k + m]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        inside = seg[:m] == seg[GRAM - 1 :]
        self.hash, self.owner = h[inside], seg[:m][inside]


def _slots(h: np.ndarray, bits: int = TABLE_BITS) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - bits)).astype(np.int64), ((h >> np.uint64(64 - 2 * bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)


class Filters:
    """The bit-sliced filters and their false-positive rates."""

    def __init__(self, table: np.ndarray):
        self.table = table
        density = np.array([((table >> k) & 1).mean() for k in range(len(LANGUAGES))])
        self.false_positive = density**2
        spread = np.arange(256, dtype=np.uint64)
        # three counters of 21 bits in each of two whole numbers: one addition counts three languages
        self.low = sum(((spread >> np.uint64(k)) & np.uint64(1)) << np.uint64(21 * k) for k in range(3))
        self.high = sum(((spread >> np.uint64(k + 3)) & np.uint64(1)) << np.uint64(21 * k) for k in range(3))

    def counts(self, g: Grams) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each segment, and how many of them each language knows, corrected for false positives."""
        segments = len(g.seg_start)
        total = np.bincount(g.owner, minlength=segments).astype(float)
        out = np.zeros((segments, len(LANGUAGES)))
        if len(g.hash):
            a, b = _slots(g.hash)
            masks = self.table[a] & self.table[b]
            heads = np.flatnonzero(np.append(True, g.owner[1:] != g.owner[:-1]))
            rows = g.owner[heads]
            for words, base in ((self.low, 0), (self.high, 3)):
                packed = np.add.reduceat(words[masks], heads)
                for k in range(3):
                    out[rows, base + k] = (packed >> np.uint64(21 * k)) & np.uint64((1 << 21) - 1)
        fp = self.false_positive
        return total, np.clip((out - total[:, None] * fp) / (1 - fp), 0, None)

    def judge(self, g: Grams) -> tuple[np.ndarray, np.ndarray]:
        """Language number (-1: none) and confidence of each segment."""
        total, known = self.counts(g)
        share = known / np.maximum(total, 1)[:, None]
        best = share.argmax(1)
        rows = np.arange(len(share))
        top = share[rows, best] if len(share) else np.zeros(0)
        rest = share.copy()
        if len(share):
            rest[rows, best] = -1
        margin = top - (rest.max(1) if len(share) else 0)
        sure = (total >= LEAST_GRAMS) & (g.words >= LEAST_WORDS) & (top >= SHARE) & (margin >= MARGIN)
        return np.where(sure, best, -1), np.round(top, 4)


def build_filters(texts: Sequence[str], labels: Sequence[int], rounds: int = 2) -> Filters:
    """Filters from labelled texts. An n-gram enters the filter of each language in which its rate of documents is high enough.

    After the first round, texts that the filters judge to be in another language than their label, or in none, are left out.
    """
    g = Grams(pa.array(list(texts), pa.string()))
    doc = g.seg_doc[g.owner] if len(g.hash) else np.zeros(0, np.int64)
    lang = np.asarray(labels)
    use = np.ones(len(lang), bool)
    low = np.uint64((1 << min(64 - 2 * TABLE_BITS, max(1, len(lang).bit_length()))) - 1)
    if len(lang) > int(low):
        raise ValueError("the sample is larger than the filters can tell apart")
    filters = Filters(np.zeros(1 << TABLE_BITS, np.uint8))
    for r in range(rounds):
        mine = use[doc]
        # an n-gram counts once a document: the low bits of its hash, which the slots do not use, make room for the document
        pairs = np.unique((g.hash[mine] & ~low) | doc[mine].astype(np.uint64))
        holder = (pairs & low).astype(np.int64)
        pairs &= ~low
        heads = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
        grams, where = pairs[heads], np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(pairs))))
        rate = np.zeros((len(grams), len(LANGUAGES)))
        raw = np.zeros((len(grams), len(LANGUAGES)), np.int64)
        for k in range(len(LANGUAGES)):
            size = max(1, int((use & (lang == k)).sum()))
            raw[:, k] = np.bincount(where[lang[holder] == k], minlength=len(grams))
            rate[:, k] = raw[:, k] / size
        enters = (raw >= 2) & (rate >= 0.25 * rate.max(1, keepdims=True))
        table = np.zeros(1 << TABLE_BITS, np.uint8)
        a, b = _slots(grams)
        for k in range(len(LANGUAGES)):
            table[a[enters[:, k]]] |= 1 << k
            table[b[enters[:, k]]] |= 1 << k
        filters = Filters(table)
        if r + 1 < rounds:
            found, _ = filters.judge(g)
            votes = np.zeros((len(lang), len(LANGUAGES)))
            np.add.at(votes, (g.seg_doc[found >= 0], found[found >= 0]), (g.seg_end - g.seg_start)[found >= 0])
            use = (votes.sum(1) > 0) & (votes.argmax(1) == lang) & (votes.max(1) >= 0.9 * votes.sum(1))
    return filters


def sample_labelled(docs: DataFrame, id_col: str, text: str, label: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[list[str], list[int]]:
    """At most ``rows`` texts a language, those whose id hashes lowest; where a language has fewer texts of at most ``chars`` characters,
    the openings of longer ones make up the rest. Counted first, so that only about as many as needed are sorted."""
    named = docs.select(F.xxhash64(id_col).alias("_h"), F.substring(text, 1, chars).alias("_t"), (F.length(text) > chars).alias("_long"), label_language(F.col(label)).alias("_l")).filter(F.col("_l").isin(*LANGUAGES) & (F.length("_t") > 0))
    counts = {(r[0], r[1]): r[2] for r in named.groupBy("_l", "_long").count().collect()}
    out_t: list[str] = []
    out_l: list[int] = []
    for k, lang in enumerate(LANGUAGES):
        left = rows
        for long in (False, True):
            n = counts.get((lang, long), 0)
            if not n or left <= 0:
                continue
            part = named.filter((F.col("_l") == lang) & (F.col("_long") == long))
            if n > 3 * rows:
                part = part.filter(F.col("_h") < int(-(2**63) + 2**64 * (3 * rows / n)))
            for r in part.orderBy("_h").limit(left).select("_t").collect():
                out_t.append(r[0])
                out_l.append(k)
            left -= min(n, left)
    return out_t, out_l


def _passages(filters: Filters) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            g = Grams(b.column(2))
            lang, confidence = filters.judge(g)
            told = np.flatnonzero(lang >= 0)
            if not len(told):
                continue
            doc, lng, conf = g.seg_doc[told], lang[told], confidence[told]
            size = (g.seg_end - g.seg_start)[told].astype(float)
            heads = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (lng[1:] != lng[:-1])))
            lasts = np.append(heads[1:], len(told)) - 1
            begin, end = g.seg_start[told[heads]] - g.off[doc[heads]], g.seg_end[told[lasts]] - g.off[doc[heads]]
            weight = np.add.reduceat(size * conf, heads) / np.add.reduceat(size, heads)
            number = np.arange(len(heads)) - np.repeat(np.flatnonzero(np.append(True, doc[heads][1:] != doc[heads][:-1])), np.diff(np.append(np.flatnonzero(np.append(True, doc[heads][1:] != doc[heads][:-1])), len(heads)))) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(doc[heads])),
                    b.column(1).take(pa.array(doc[heads])),
                    pa.array(number.astype(np.int32)),
                    pa.array(begin.astype(np.int64)),
                    pa.array(end.astype(np.int64)),
                    pa.array(np.add.reduceat(size, heads).astype(np.int64)),
                    pa.array([LANGUAGES[x] for x in lng[heads]], pa.string()),
                    pa.array(np.round(weight, 4)),
                ],
                names=["doc_id", "named", "passage", "begin_at", "end_at", "chars", "lang", "confidence"],
            )

    return run


def passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang", filters: Filters | None = None) -> DataFrame:
    """(doc_id, named, passage, begin_at, end_at, chars, lang, confidence): every stretch of sentences in one language, in order.

    named is the language of the label. One pass over the texts, no shuffle.
    """
    filters = filters or build_filters(*sample_labelled(docs, id_col, text, label))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), label_language(F.col(label)).alias("named"), F.col(text).cast("string").alias("text")).filter("text is not null and doc_id is not null")
    return rows.mapInArrow(_passages(filters), "doc_id long, named string, passage int, begin_at long, end_at long, chars long, lang string, confidence double")


def document_languages(found: DataFrame) -> DataFrame:
    """(doc_id, named, opening, lang, share, confidence): one row per document and language, with its share of the judged text."""
    per = found.groupBy("doc_id", "named", "lang").agg(F.sum("chars").alias("chars"), (F.sum(F.col("confidence") * F.col("chars")) / F.sum("chars")).alias("confidence"), F.min("passage").alias("passage"))
    whole = per.groupBy("doc_id", "named").agg(F.collect_list(F.struct("passage", "lang", "chars", "confidence")).alias("langs"), F.sum("chars").alias("all"), F.min_by("lang", "passage").alias("opening"))
    return whole.select("doc_id", "named", "opening", F.size("langs").alias("languages"), F.explode("langs").alias("l"), "all").select("doc_id", "named", "opening", "languages", "l.lang", F.round(F.col("l.chars") / F.col("all"), 4).alias("share"), F.round("l.confidence", 4).alias("confidence"))


def mislabelled(found: DataFrame) -> DataFrame:
    """(doc_id, lang) of documents without a label, with a label unlike their opening, or in several languages."""
    return document_languages(found).filter(F.col("named").isNull() | (F.col("named") != F.col("opening")) | (F.col("languages") > 1)).select("doc_id", "lang")
