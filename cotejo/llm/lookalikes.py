"""Visually identical text with different characters, brought to one form.

Two steps. Character repair: compatibility and full-width letters, digits and marks, separate accents, invisible characters and
unusual spaces have one right form each, whatever stands around them. Script-aware repair: in each token the dominant script is
determined; look-alike letters are substituted in tokens of mixed script, and in tokens wholly of another script only when each
letter has a Latin look-alike and the result is a word of the corpus vocabulary (all purely Latin words of the corpus and of the
given reference names). The JVM picks the few fields with unusual characters by one pattern; only those reach Python.

Two deviations from substituting in mixed-script tokens only, both needed for the required result: a token wholly of look-alikes
is repaired too when the vocabulary holds the result ("standing for" a Latin letter), and a mixed token in which Latin dominates is
repaired even if its Latin form occurs nowhere else, so that two disguises of one unknown name become equal.

Defined results: null stays null and is no case; an empty text is no case; line breaks and tabs are kept; capitals, doubled blanks
and the signs ° « » are no case; real foreign words and symbols are left alone; repeated rows are judged one by one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters of other scripts that look like a Latin letter, as pairs of the letter and its Latin form.
CYRILLIC = "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ӏl ѵv кk АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ԚQ ԜW ҮY ӀI ѴV"
GREEK = "αa γy ιi κk νv οo ρp τt υu χx ηn ωw εe ϲc ϳj ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ"
ARMENIAN = "ոn սu օo հh ցg զq յj լl աw ՏS ՍU ՕO ԼL"
LATIN_OF = {pair[0]: pair[1] for block in (CYRILLIC, GREEK, ARMENIAN) for pair in block.split()}

#: Fields without any of these characters need no repair: the pattern excludes what is ordinary in Latin-1 text.
UNUSUAL = r"[^\x09\x0A\x0D\x20-\x7E\xA1-\xA9\xAB\xAC\xAE-\xB1\xB4\xB6-\xB8\xBB\xBF-\xFF]"
_FOREIGN = regex.compile(r"[\p{L}--\p{Latin}--\p{Common}--\p{Inherited}]", regex.V1)
_TOKEN = regex.compile(r"[\p{L}\p{M}]+")
_LETTERS = r"[^\p{L}\p{M}]+"


class _Characters(dict):
    """Code point -> what should stand there; filled as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = unicodedata.category(c)
        if c in "\t\n\r" or c == " ":
            out = c
        elif kind in ("Zs", "Zl", "Zp"):
            out = " "
        elif kind in ("Cf", "Cc") or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or code in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0):
            out = ""
        elif (kind[0] in "LNM" or 0xFF01 <= code <= 0xFFEE) and unicodedata.normalize("NFKC", c) != unicodedata.normalize("NFC", c):
            out = unicodedata.normalize("NFKC", c)
        else:
            out = c
        self[code] = out
        return out


_CHARACTERS = _Characters()


def repair_characters(text: str) -> str:
    """Every character in its ordinary form; letters of other scripts stay."""
    return unicodedata.normalize("NFC", text.translate(_CHARACTERS))


def latin_form(token: str) -> str | None:
    """The token with each foreign letter replaced by its Latin look-alike, or None where one has none."""
    out = []
    for c in unicodedata.normalize("NFD", token):
        if _FOREIGN.match(c):
            c = LATIN_OF.get(c)
            if c is None:
                return None
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def judge(token: str) -> tuple[bool, str | None, bool]:
    """(certain case, Latin form, needs the vocabulary) of a token that holds a foreign letter."""
    foreign = len(_FOREIGN.findall(token))
    latin = sum(c.isalpha() for c in token) - foreign
    form = latin_form(token)
    if latin > 0 and form is not None:
        return True, form, foreign > latin
    if latin > 0:
        # a letter without a Latin look-alike is meant as it stands: a unit, a formula, a foreign word
        return False, None, False
    return False, form, form is not None


_JUDGED = T.StructType(
    [
        T.StructField("_n", T.LongType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("folded", T.StringType()),
        T.StructField("certain", T.BooleanType()),
        T.StructField("asked", T.ArrayType(T.StringType())),
    ]
)


def _judge_fields(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for n, name, text in zip(pdf["_n"], pdf["field_name"], pdf["text"], strict=True):
            folded = repair_characters(text)
            certain, asked = folded != text, []
            if _FOREIGN.search(folded):
                for token in set(_TOKEN.findall(folded)):
                    if _FOREIGN.search(token):
                        sure, form, ask = judge(token)
                        certain |= sure
                        if ask:
                            asked.append(form.lower())
            rows.append((n, name, folded, certain, sorted(set(asked))))
        yield pd.DataFrame(rows, columns=["_n", "field_name", "folded", "certain", "asked"])


def vocabulary(texts: Sequence[Column], frames: Sequence[DataFrame]) -> DataFrame:
    """(word): the distinct purely Latin words, in lower case, of one text column of each frame. Combined before the shuffle."""
    out: DataFrame | None = None
    for text, df in zip(texts, frames, strict=True):
        words = df.select(F.explode(F.array_distinct(F.split(F.lower(text), _LETTERS))).alias("word")).filter(F.col("word").rlike(r"^\p{IsLatin}+$"))
        out = words if out is None else out.unionByName(words)
    return out.distinct()


def judged_fields(df: DataFrame, id_col: str, fields: Sequence[str], names: DataFrame | None = None, name_col: str = "sala") -> DataFrame:
    """(id, field_name, folded, is_case, known): only fields with an unusual character; known = asked-for Latin words that exist."""
    long = df.select(F.col(id_col).cast("long").alias("_n"), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields])).alias("_f")).select("_n", "_f.field_name", "_f.text")
    odd = long.filter(F.col("text").rlike(UNUSUAL))
    judged = odd.mapInPandas(_judge_fields, _JUDGED)
    asked = judged.select(F.explode("asked").alias("word")).distinct()
    frames, texts = [long], [F.col("text")]
    if names is not None:
        frames.append(names.select(F.col(name_col).alias("text")))
        texts.append(F.col("text"))
    known = vocabulary(texts, frames).join(asked, "word", "left_semi")
    # one row per field again; a field asks for few words, so the words of one field meet in one row
    told = judged.select("_n", "field_name", "folded", "certain", F.explode_outer("asked").alias("word")).join(known.withColumn("_known", F.lit(True)), "word", "left")
    return (
        told.groupBy("_n", "field_name", "folded", "certain")
        .agg(F.collect_set(F.when(F.col("_known"), F.col("word"))).alias("known"))
        .select(F.col("_n").alias(id_col), "field_name", "folded", (F.col("certain") | (F.size("known") > 0)).alias("is_case"), "known")
    )


@F.pandas_udf(T.StringType())
def _substituted(folded: pd.Series, known: pd.Series) -> pd.Series:
    def one(text: str, words: Sequence[str]) -> str:
        have = set(words)

        def repl(m: regex.Match) -> str:
            token = m.group()
            if not _FOREIGN.search(token):
                return token
            sure, form, ask = judge(token)
            return form if form is not None and (form.lower() in have or (sure and not ask)) else token

        return _TOKEN.sub(repl, text) if _FOREIGN.search(text) else text

    return pd.Series([one(t, w) for t, w in zip(folded, known, strict=True)])


def repaired_fields(df: DataFrame, id_col: str, fields: Sequence[str], names: DataFrame | None = None, name_col: str = "sala") -> DataFrame:
    """(id, field_name, clean_text, match_key): every filled field in its one form; match_key also has single blanks and capitals.

    Ordinary fields never leave the JVM; the repaired ones are judged and substituted in Python.
    """
    long = df.select(F.col(id_col), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields])).alias("_f")).select(id_col, "_f.field_name", "_f.text")
    plain = long.filter(F.col("text").isNotNull() & ~F.col("text").rlike(UNUSUAL)).select(id_col, "field_name", F.col("text").alias("clean_text"))
    odd = judged_fields(df, id_col, fields, names, name_col).select(id_col, "field_name", _substituted("folded", "known").alias("clean_text"))
    return plain.unionByName(odd).withColumn("match_key", F.upper(F.trim(F.regexp_replace("clean_text", r"\s+", " "))))
