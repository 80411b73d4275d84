"""Repeated passes: first sightings, convergence, contiguity, drift and repeated pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize


def first_seen(sightings: DataFrame, keys: Sequence[str], version: str = "pass") -> DataFrame:
    """(keys..., first_pass, last_pass, sightings)."""
    return sightings.groupBy(*keys).agg(F.min(version).alias("first_pass"), F.max(version).alias("last_pass"), F.count(F.lit(1)).alias("sightings"))


def new_per_pass(sightings: DataFrame, partition: str, keys: Sequence[str], version: str = "pass", unresolved: str | None = None) -> DataFrame:
    """(partition, pass, seen, new_identities): identities of a pass, and those that no earlier pass of the partition had.

    Where ``unresolved`` marks a sighting without identity, the new count of that pass is null: unknown, not zero.
    """
    first = sightings.groupBy(partition, *keys).agg(F.min(version).alias(version)).groupBy(partition, version).agg(F.count(F.lit(1)).alias("_new"))
    seen = sightings.groupBy(partition, version, *keys).agg((F.max(F.col(unresolved).cast("int")) if unresolved else F.lit(0)).alias("_u")).groupBy(partition, version).agg(F.count(F.lit(1)).alias("seen"), F.sum("_u").alias("unresolved"))
    return seen.join(first, [partition, version], "left").select(partition, version, "seen", F.when(F.col("unresolved") == 0, F.coalesce("_new", F.lit(0))).alias("new_identities"))


def convergence(per_pass: DataFrame, partition: str, version: str = "pass") -> DataFrame:
    """(partition, passes, last_pass, converged): converged where the last pass brought nothing new; null where that is unknown."""
    return per_pass.groupBy(partition).agg(F.count(F.lit(1)).alias("passes"), F.max(version).alias("last_pass"), F.max_by(F.col("new_identities") == 0, F.col(version)).alias("converged"))


def contiguity(passes: DataFrame, partition: str, version: str = "pass") -> DataFrame:
    """(partition, contiguous): passes are numbered 1, 2, 3 without gap or repeat. One aggregation; no ordering is needed to decide it."""
    return passes.groupBy(partition).agg(((F.min(version) == 1) & (F.max(version) == F.countDistinct(version)) & (F.count(version) == F.countDistinct(version))).alias("contiguous"))


def order_breaks(events: DataFrame, partition: str, order: str, version: str) -> DataFrame:
    """(partition, breaks): events that stand behind a later pass in append order.

    The ledger is cut into ranges of its order; each range is looked through on its own, and only the first and last event of each
    range are held against each other, so no partition, however large, is sorted in one task.
    """
    cut = events.select(partition, order, version).repartitionByRange(partition, order).withColumn("_range", F.spark_partition_id())
    cut = materialize(cut, "ledger-ranges")
    inside = Window.partitionBy("_range", partition).orderBy(order)
    within = cut.select(partition, (F.lag(version).over(inside) > F.col(version)).alias("_b"))
    ends = cut.groupBy("_range", partition).agg(F.min_by(version, order).alias("_first"), F.max_by(version, order).alias("_last"), F.min(order).alias("_from"))
    beside = Window.partitionBy(partition).orderBy("_from")
    between = ends.select(partition, (F.lag("_last").over(beside) > F.col("_first")).alias("_b"))
    return within.unionByName(between).groupBy(partition).agg(F.count_if("_b").alias("breaks"))


def drift(observed: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """(keys..., first_value, last_value, drifted): first held against last; a change that goes back is no drift."""
    return observed.groupBy(*keys).agg(F.min_by(value, order).alias("first_value"), F.max_by(value, order).alias("last_value")).withColumn("drifted", ~F.col("first_value").eqNullSafe(F.col("last_value")))


def repeated_pages(pages: DataFrame, partition: Sequence[str], fingerprint: str = "fingerprint") -> DataFrame:
    """(partition..., fingerprint, pages) of fingerprints that more than one page has."""
    return pages.groupBy(*partition, fingerprint).agg(F.count(F.lit(1)).alias("pages")).filter("pages > 1")


def silent_repeats(pages: DataFrame, partition: Sequence[str], order: str, fingerprint: str = "fingerprint") -> DataFrame:
    """Pages equal to the page before them."""
    w = Window.partitionBy(*partition).orderBy(order)
    return pages.withColumn("_before", F.lag(fingerprint).over(w)).filter(F.col("_before") == F.col(fingerprint)).drop("_before")


def first_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in order; later ones are repeats. By aggregation, so that hot keys combine before the shuffle."""
    other = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*other), F.struct(*order)) if other else F.count(F.lit(1))
    picked = rows.groupBy(*keys).agg(best.alias("_r"), F.count(F.lit(1)).alias("occurrences"))
    return picked.select(*keys, "_r.*", "occurrences")


def stalled_pages(rows: DataFrame, partition: str, page: str, key: str) -> DataFrame:
    """(partition, page) of pages on which no key is new to the partition."""
    first = rows.groupBy(partition, key).agg(F.min(page).alias(page)).select(partition, page).distinct()
    return rows.select(partition, page).distinct().join(first, [partition, page], "left_anti")


def replay_convergence(rows: DataFrame, group: str, version: str, key: str) -> DataFrame:
    """(group, converged_after, missed_by_first): the first pass without new identities, and how many the first pass did not have."""
    first = rows.groupBy(group, key).agg(F.min(version).alias("_f"))
    missed = first.join(rows.groupBy(group).agg(F.min(version).alias("_v")), group).groupBy(group).agg(F.count_if(F.col("_f") > F.col("_v")).alias("missed_by_first"))
    quiet = new_per_pass(rows, group, [key], version).filter("new_identities = 0").groupBy(group).agg(F.min(version).alias("converged_after"))
    return missed.join(quiet, group, "left").select(group, "converged_after", "missed_by_first")
