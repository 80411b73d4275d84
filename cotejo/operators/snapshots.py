"""What changed between consecutive full snapshots.

Rows are reduced to (snapshot, key hash, row hash, row id) in the JVM, spread over hash buckets of the key, and each bucket is
sorted in numpy: a key of a snapshot is looked up in the preceding one by ``searchsorted`` on one composite code per key and
snapshot. Full values are fetched only for the keys that differ, by row id.

Defined results: keys are compared in capitals without outer white space; a row without a key is no record, though its snapshot
counts as delivered; of rows with the same key in a snapshot the one with the highest row id counts; empty and blank values equal
null; a snapshot that was not delivered is skipped; the first snapshot gives no change; rows without a group, snapshot or row id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import hot_keys, lookup, shuffle_width

_EDGES = r"(?U)^\s+|\s+$"


def trimmed(c: Column | str) -> Column:
    """Without outer white space of any kind; empty becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.regexp_replace(c.cast("string"), _EDGES, "")
    return F.when(t != "", t)


def delivered(rows: DataFrame, group: str, version: str) -> DataFrame:
    """(group, version, previous, following) of every snapshot that has rows."""
    w = Window.partitionBy(group).orderBy(version)
    return rows.select(group, version).filter(F.col(group).isNotNull() & F.col(version).isNotNull()).distinct().select(group, version, F.lag(version).over(w).alias("previous"), F.lead(version).over(w).alias("following"))


def _diff_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: columns g, v, prev, next, k1, k2, h, id -> kind, at, old_id, new_id."""
    cols = list(zip(*[[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches], strict=True))
    if not cols:
        return
    g, v, prev, nxt, k1, k2, h, rid = (np.concatenate(c) for c in cols)
    # one dense number per (group, key hash), one per version: the composite code orders keys, then snapshots
    order = np.lexsort((rid, v, k2, k1, g))
    g, v, prev, nxt, k1, k2, h, rid = (a[order] for a in (g, v, prev, nxt, k1, k2, h, rid))
    new_key = np.append(True, (g[1:] != g[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
    last = np.append(new_key[1:] | (v[1:] != v[:-1]), True)
    key = (np.cumsum(new_key) - 1)[last]
    g, v, prev, nxt, h, rid = (a[last] for a in (g, v, prev, nxt, h, rid))
    versions = np.unique(np.concatenate([v, prev[prev >= 0], nxt[nxt >= 0]]))
    code = key * len(versions) + np.searchsorted(versions, v)

    def find(of: np.ndarray) -> np.ndarray:
        """Place of the same key in snapshot ``of``, -1 where it has none."""
        wanted = key * len(versions) + np.searchsorted(versions, np.where(of >= 0, of, versions[0]))
        at = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
        return np.where((of >= 0) & (code[at] == wanted), at, -1)

    before, after = find(prev), find(nxt)
    added = np.flatnonzero((prev >= 0) & (before < 0))
    changed = np.flatnonzero((before >= 0) & (h[np.maximum(before, 0)] != h))
    removed = np.flatnonzero((nxt >= 0) & (after < 0))
    none = np.full
    kind = np.repeat(np.array(["added", "changed", "removed"]), [len(added), len(changed), len(removed)])
    at = np.concatenate([v[added], v[changed], nxt[removed]])
    old = np.concatenate([none(len(added), -1), rid[before[changed]], rid[removed]])
    new = np.concatenate([rid[added], rid[changed], none(len(removed), -1)])
    grp = np.concatenate([g[added], g[changed], g[removed]])
    for s in range(0, len(kind), 65_536):
        e = slice(s, s + 65_536)
        yield pa.RecordBatch.from_arrays(
            [pa.array(grp[e].astype(np.int64)), pa.array(at[e].astype(np.int32)), pa.array(kind[e].tolist(), pa.string()), pa.array(old[e].astype(np.int64), mask=old[e] < 0), pa.array(new[e].astype(np.int64), mask=new[e] < 0)],
            names=["_g", "_at", "change_kind", "old_id", "new_id"],
        )


def snapshot_changes(rows: DataFrame, group: str, version: str, key: str, values: Sequence[str], row_id: str, width: int | None = None) -> DataFrame:
    """(group, version, key, change_kind, old_id, new_id): group and version are whole numbers of 0 or more, row ids as well.

    Shuffles 8 numbers a row once, by bucket; the full rows move only for keys that differ.
    """
    width = width or shuffle_width(rows.sparkSession)
    slim = rows.select(
        F.col(group).cast("long").alias("g"),
        F.col(version).cast("int").alias("v"),
        F.col(row_id).cast("long").alias("id"),
        F.upper(trimmed(key)).alias("_key"),
        F.xxhash64(*[F.coalesce(F.concat(F.lit("="), trimmed(c)), F.lit("~")) for c in values]).alias("h"),
    )
    compact = slim.filter("_key is not null and g is not null and v is not null and id is not null").select("g", "v", F.xxhash64("_key").alias("k1"), F.xxhash64(F.lit("second"), F.reverse("_key")).alias("k2"), "h", "id")
    there = delivered(slim, "g", "v")
    with_neighbours = lookup(compact, there, ["g", "v"], hot=hot_keys(slim.select("g", "v"), ["g", "v"]))
    bucketed = with_neighbours.select("g", "v", F.coalesce("previous", F.lit(-1)).cast("int").alias("previous"), F.coalesce("following", F.lit(-1)).cast("int").alias("following"), "k1", "k2", "h", "id").repartition(width, "g", "k1", "k2")
    diff = bucketed.mapInArrow(_diff_bucket, "_g long, _at int, change_kind string, old_id long, new_id long")
    full = rows.select(F.col(row_id).cast("long").alias("_row"), F.upper(trimmed(key)).alias("_identity"))
    return (
        diff.withColumn("_row", F.coalesce("new_id", "old_id"))
        .join(full, "_row")
        .select(F.col("_g").alias(group), F.col("_at").alias(version), F.col("_identity").alias(key), "change_kind", "old_id", "new_id")
    )


def snapshot_audit(rows: DataFrame, passes: DataFrame, changes: DataFrame, group: str = "replay_id", version: str = "pass", key: str = "identity_id") -> DataFrame:
    """The changes of each delivered pass held against the totals and new identities declared for it.

    One row per declared pass: what was observed, whether it has rows, whether the final total fits the identities seen, and how
    many declared new identities were not added or added ones not declared. Null declarations stay null: unknown, not zero.
    """
    ident = rows.select(group, version, F.upper(trimmed(key)).alias("_k"))
    seen = ident.groupBy(group, version).agg(F.count(F.lit(1)).alias("rows_seen"), F.countDistinct("_k").alias("identities_seen"))
    kinds = changes.groupBy(group, version).agg(*[F.count_if(F.col("change_kind") == k).alias(k) for k in ("added", "removed", "changed")])
    first = delivered(rows, group, version).filter("previous is null").select(group, version)
    news = changes.filter("change_kind = 'added'").select(group, version, F.col(key).alias("_k"))
    news = news.unionByName(ident.filter("_k is not null").join(first, [group, version], "left_semi").distinct()).withColumn("_new", F.lit(1))
    declared = passes.filter("expected_new_identities is not null").select(group, version, F.explode("expected_new_identities").alias("_e")).select(group, version, F.upper(trimmed("_e")).alias("_k")).distinct().withColumn("_said", F.lit(1))
    odds = news.join(declared, [group, version, "_k"], "full_outer").groupBy(group, version).agg(F.count_if(F.col("_new").isNull()).alias("declared_not_seen"), F.count_if(F.col("_said").isNull()).alias("seen_not_declared"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    known = F.col("expected_new_identities").isNotNull()
    return (
        passes.join(seen, [group, version], "left")
        .join(kinds, [group, version], "left")
        .join(odds, [group, version], "left")
        .select(
            group, version, "initial_total", "final_total", zero("rows_seen"), zero("identities_seen"), zero("added"), zero("removed"), zero("changed"),
            F.when(known, F.coalesce("declared_not_seen", F.lit(0))).cast("long").alias("declared_not_seen"),
            F.when(known, F.coalesce("seen_not_declared", F.lit(0))).cast("long").alias("seen_not_declared"),
            (F.coalesce("identities_seen", F.lit(0)) == F.col("final_total")).alias("final_total_fits"),
        )
    )
