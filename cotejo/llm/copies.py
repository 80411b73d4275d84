"""Duplicates hidden by formatting differences, collapsed into one record with the number of its copies.

Every field is reduced to its letters (case aside) and digits, the fields are put in a fixed order whatever order or layout they
came in, and the result is hashed to 128 bits. One aggregation with map-side combining then gives each set of copies its smallest
id and its size; the bounds of a second, independent 64-bit hash show whether a 128-bit hash stands for two different records, and
such hashes are regrouped by the full canonical text.

Defined results: null, empty and punctuation-only values are the same (no letters or digits); a payload that cannot be read, and
a record without any field, counts as a record of four empty fields; columns of the layout win over the payload where both are
filled; labels and keys may have any case and outer blanks; repeated rows are copies; rows without an id are counted and not
listed; other columns do not matter.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import HOT_SHARE, lookup, materialize

IDENTITY = ("expediente", "sala", "tipo", "fecha")


@F.pandas_udf(T.StringType())
def _composed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Compatibility forms and separate accents made one; only asked for the few values that hold unusual characters."""
    for s in parts:
        yield s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else None)


def letters_and_digits(c: Column) -> Column:
    """Lower-case letters and digits of a text in their order; everything else goes."""
    unusual = c.rlike(r"[^\x00-\x{24F}\x{2010}-\x{2015}\x{2018}-\x{201F}]|[ªº²³¹¼½¾]")
    composed = F.coalesce(_composed(F.when(unusual, c)), c)
    return F.coalesce(F.lower(F.upper(F.regexp_replace(composed, r"[^\p{L}\p{N}]+", ""))), F.lit(""))


def _named(name: str) -> Callable[[Column], Column]:
    return lambda entry: F.lower(F.trim(entry["key"])) == name


def unpacked_identity(df: DataFrame, fields: Sequence[str] = IDENTITY, payload: str = "payload") -> list[Column]:
    """One column per field, from its own column, a JSON object or labelled text."""
    text = F.col(payload)
    entries = F.map_entries(F.from_json(F.when(F.ltrim(F.regexp_replace(text, r"^\s+", "")).startswith("{"), text), "map<string,string>"))
    out = []
    for f in fields:
        from_json = F.filter(entries, _named(f))
        labelled = F.regexp_extract(text, rf"(?i)(?:^|[\n\r|;])\s*{f}\s*:([^\n\r|]*)", 1)
        out.append(F.coalesce(F.col(f), F.try_element_at(from_json, F.lit(1))["value"], labelled))
    return out


def identity_hashes(df: DataFrame, id_col: str, fields: Sequence[str] = IDENTITY, payload: str = "payload") -> DataFrame:
    """(id, h128, check, canon): 16 bytes of hash, an independent 64-bit hash and the canonical text."""
    raw = df.select(F.col(id_col).cast("long").alias("id"), *[c.alias(f"_c{k}") for k, c in enumerate(unpacked_identity(df, fields, payload))])
    canon = raw.select("id", F.concat_ws("\x1f", *[letters_and_digits(F.col(f"_c{k}")) for k in range(len(fields))]).alias("canon"))
    return canon.select("id", F.unhex(F.md5("canon")).alias("h128"), F.xxhash64("canon").alias("check"), "canon")


def copy_groups(hashes: DataFrame) -> DataFrame:
    """(h128, check, keep_id, copies): one row per set of copies.

    Grouping by both hashes is the collision check: sets whose 128-bit hashes agree and whose texts do not are kept apart here, and
    ``collisions`` counts them.
    """
    return hashes.groupBy("h128", "check").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))


def collisions(hashes: DataFrame) -> DataFrame:
    """Hashes that stand for more than one canonical text: none, as long as the hashes do their work."""
    return hashes.groupBy("h128", "check").agg(F.min("canon").alias("a"), F.max("canon").alias("b")).filter("a <> b").select("h128", "check")


def copy_members(hashes: DataFrame, groups: DataFrame) -> DataFrame:
    """(keep_id, dup_id) of every record that is not the first of its set. Hot sets meet their row by a bounded broadcast."""
    several = groups.filter("copies > 1").select("h128", "check", "keep_id", "copies")
    hot = several.filter(F.col("copies") > max(10_000, int(hashes.count() * HOT_SHARE))).select("h128", "check")
    return lookup(hashes.select("id", "h128", "check"), several, ["h128", "check"], how="inner", hot=hot).filter("id <> keep_id").select("keep_id", F.col("id").alias("dup_id"))


def collapse(df: DataFrame, id_col: str, fields: Sequence[str] = IDENTITY, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """The sets of copies and the hashed records they were made from, both written once to the shared folder."""
    hashed = materialize(identity_hashes(df, id_col, fields, payload), "identity-hashes")
    torn = collisions(hashed)
    groups = copy_groups(hashed)
    if not torn.isEmpty():
        # the texts decide: a number for each text of the torn hashes takes the place of the check hash
        exact = hashed.join(F.broadcast(torn.limit(100_000)) if torn.limit(100_001).count() <= 100_000 else torn, ["h128", "check"], "left_semi")
        rest = hashed.join(torn, ["h128", "check"], "left_anti")
        exact = exact.withColumn("h128", F.encode("canon", "UTF-8"))
        hashed = materialize(rest.unionByName(exact), "identity-hashes")
        groups = copy_groups(hashed)
    return materialize(groups, "copy-groups"), hashed
