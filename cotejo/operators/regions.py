"""Which partitions hold which identities: exact regions, pairwise intersections and the count equations that follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def membership_regions(placed: DataFrame, root: str, partition: str) -> DataFrame:
    """(partitions, documents): identities per exact set of partitions. A set has at most as many members as there are partitions."""
    sets = placed.groupBy(root).agg(F.array_sort(F.collect_set(partition)).alias("partitions"))
    return sets.groupBy("partitions").agg(F.count(F.lit(1)).alias("documents"))


def intersections(regions: DataFrame) -> DataFrame:
    """(left, right, documents) of every pair of partitions, 0 where they share nothing. Made from the regions, which are few."""
    names = regions.select(F.explode("partitions").alias("p")).agg(F.array_sort(F.collect_set("p")).alias("_all"))
    pairs = names.select(F.explode(F.flatten(F.transform("_all", lambda x: F.transform(F.filter("_all", lambda y: y > x), lambda y: F.struct(x.alias("left"), y.alias("right")))))).alias("_p")).select("_p.*")
    held = regions.select("documents", F.explode(F.flatten(F.transform("partitions", lambda x: F.transform(F.filter("partitions", lambda y: y > x), lambda y: F.struct(x.alias("left"), y.alias("right")))))).alias("_p")).groupBy("_p.left", "_p.right").agg(F.sum("documents").alias("documents"))
    return pairs.join(held, ["left", "right"], "left").select("left", "right", F.coalesce("documents", F.lit(0)).alias("documents"))


def partition_rollup(members: DataFrame, partition: str, root: str, resolved: str) -> DataFrame:
    """(partition, raw, resolved, unresolved, unique_documents, duplicates): the last two are null while anything is unresolved."""
    agg = members.groupBy(partition).agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col(resolved)).alias("resolved"), F.countDistinct(F.when(F.col(resolved), F.col(root))).alias("_u"))
    open_ = F.col("raw") - F.col("resolved")
    return agg.select(partition, "raw", "resolved", open_.alias("unresolved"), F.when(open_ == 0, F.col("_u")).alias("unique_documents"), F.when(open_ == 0, F.col("raw") - F.col("_u")).alias("duplicates"))


def count_equations(rollup: DataFrame, regions: DataFrame, published: int | None = None, not_enumerable: int | None = None) -> DataFrame:
    """One row: raw memberships, distinct documents by regions, duplicates, and whether the published total is explained."""
    raw = rollup.agg(F.sum("raw").alias("raw"), F.sum("unresolved").alias("unresolved"))
    unique = regions.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("unique_documents"))
    gap = F.lit(published).cast("long") - F.col("unique_documents")
    return raw.join(F.broadcast(unique), F.lit(True), "left").select(
        "raw", "unresolved", F.when(F.col("unresolved") == 0, F.col("unique_documents")).alias("unique_documents"),
        F.when(F.col("unresolved") == 0, F.col("raw") - F.col("unique_documents")).alias("duplicates"),
        gap.alias("gap"), (gap == F.lit(not_enumerable).cast("long")).alias("explained"),
    )


def partition_gap(totals: DataFrame, partition: str, total: str, published: int) -> DataFrame:
    """(partition, total, gap): what each partition announces and, in the row without a partition, their sum and what it lacks of the
    published total. A total that is not known leaves the sum unknown."""
    known = F.count(F.lit(1)) == F.count(total)
    rolled = totals.rollup(partition).agg(F.when(known, F.sum(total)).alias("total"), F.grouping(partition).alias("_all"))
    return rolled.select(partition, "total", F.when(F.col("_all") == 1, F.lit(published).cast("long") - F.col("total")).alias("gap"))


def collision_statistics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct keys, keys held more than once, occurrences beyond the first, and the largest multiplicity."""
    per = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.count(F.lit(1)).alias("unique_keys"), F.count_if(F.col("_n") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("beyond_first"), F.coalesce(F.max("_n"), F.lit(0)).alias("most"))
