"""Reconciliation of two sides by key: what both have, what only one has, and what contradicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage(left: DataFrame, right: DataFrame, key: str, contradiction: Column | None = None) -> DataFrame:
    """(key, verdict): duplicate, missing (no right side), unknown (no left side), contradiction or ok; one full outer join.

    contradiction is a condition over the columns of both sides.
    """
    l = left.groupBy(key).agg(F.count(F.lit(1)).alias("_nl"), *[F.first(c, True).alias(c) for c in left.columns if c != key])  # noqa: E741
    both = l.join(right.withColumn("_r", F.lit(True)), key, "full_outer")
    verdict = F.when(F.col("_nl").isNull(), "unknown").when(F.col("_nl") > 1, "duplicate").when(F.col("_r").isNull(), "missing")
    if contradiction is not None:
        verdict = verdict.when(F.coalesce(contradiction, F.lit(False)), "contradiction")
    return both.select(key, verdict.otherwise("ok").alias("verdict"))


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count(F.lit(1)).alias("keys"))


def missing_from(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left side without a row on the right."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def existing_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left side with a row on the right."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_semi")


def alias_lookup(rows: DataFrame, stored: DataFrame, row_id: str, aliases: Sequence[str], stored_id: str, stored_aliases: Sequence[str]) -> DataFrame:
    """(row_id, matches, stored_id): each row with the stored document that has one of its aliases, whatever column it stands in.

    matches above 1 is a conflict: the row's aliases lead to different documents; stored_id is then the smallest.
    """
    explode = lambda df, i, cols: df.select(F.col(i), F.explode(F.array_distinct(F.array_compact(F.array(*[F.lower(c) for c in cols])))).alias("_alias"))
    known = explode(stored, stored_id, stored_aliases).distinct()
    mine = explode(rows, row_id, aliases)
    return mine.join(known, "_alias").groupBy(row_id).agg(F.countDistinct(stored_id).alias("matches"), F.min(stored_id).alias(stored_id))


def shared_aliases(stored: DataFrame, stored_id: str, aliases: Sequence[str]) -> DataFrame:
    """(alias, documents) of aliases that more than one document claims."""
    one = stored.select(stored_id, F.explode(F.array_distinct(F.array_compact(F.array(*[F.lower(c) for c in aliases])))).alias("alias")).distinct()
    return one.groupBy("alias").agg(F.count(F.lit(1)).alias("documents")).filter("documents > 1")


def foreign_key_gaps(tables: Mapping[str, DataFrame], links: Sequence[tuple[str, Sequence[str], str, Sequence[str]]]) -> DataFrame:
    """(link, rows_without) for each link (table, columns, other table, its columns): rows whose target is missing. Zero rows are listed."""
    out: DataFrame | None = None
    for t, cols, other, keys in links:
        target = tables[other].select(*[F.col(k).alias(c) for k, c in zip(keys, cols, strict=True)]).distinct()
        n = tables[t].join(target, list(cols), "left_anti").agg(F.lit(f"{t}({','.join(cols)})->{other}").alias("link"), F.count(F.lit(1)).alias("rows_without"))
        out = n if out is None else out.unionByName(n)
    return out


def provenance_breaks(rows: DataFrame, sources: DataFrame, key: str, same: Sequence[str]) -> DataFrame:
    """(key, broken): what each row and its source (unique on key) do not agree in, null-safe; rows that agree in all give none.

    A row without a source breaks in the key itself.
    """
    found = rows.select(key, *same).join(sources.select(key, *[F.col(c).alias(f"_{c}") for c in same], F.lit(True).alias("_there")), key, "left")
    differs = [F.when(F.col("_there").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in same]
    broken = F.array_compact(F.array(F.when(F.col("_there").isNull(), F.lit(key)), *differs))
    return found.select(key, F.explode(broken).alias("broken"))


def file_verdicts(events: DataFrame, files: DataFrame, least: int, magic: bytes = b"%PDF-") -> DataFrame:
    """(document, verdict) of events that name a stored file (document, path, bytes, sha256), held against the files there are (path,
    content): missing, size, too_small, signature, hash or ok. One join by path; the content is read once and stays in its task."""
    seen = files.select("path", F.length("content").alias("_size"), F.substring("content", 1, len(magic)).alias("_magic"), F.sha2("content", 256).alias("_hash"))
    verdict = (
        F.when(F.col("_size").isNull(), "missing").when(~F.col("_size").eqNullSafe(F.col("bytes")), "size").when(F.col("_size") < least, "too_small")
        .when(F.col("_magic") != F.lit(magic), "signature").when(~F.col("_hash").eqNullSafe(F.lower("sha256")), "hash").otherwise("ok")
    )
    return events.join(seen, "path", "left").select("document", verdict.alias("verdict"))
