"""Groups of records linked by shared aliases, and what follows for their identity.

Alternating large-star and small-star steps (Kiveris et al., "Connected components in MapReduce and beyond", SoCC 2014). Each step
is one aggregation and one join on whole numbers; hot vertices stay out of the shuffle; each round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import lookup, materialize, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """(node, root): root is the smallest node linked with node. Nodes are whole numbers; nodes without edges are not listed."""
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    state = materialize(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        # large star: every neighbour above a node is linked with the smallest of the node and its neighbours
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = materialize(lookup(both.filter("v > u"), low, ["u"], how="inner").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large-star")
        # small star: a node and its smaller neighbours are linked with the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = lookup(large, least, ["u"], how="inner")
        small = materialize(linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(linked.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        release(state, large)
        state = small
        if before == tuple(now):
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def alias_components(members: DataFrame, member_id: str, aliases: Sequence[str], shared_namespace: bool = True) -> DataFrame:
    """(member_id, root) of every member, linked over equal aliases; members without a partner are their own root.

    In a shared namespace an alias means the same in whatever column it stands; otherwise only within its column.
    """
    tag = (lambda c: F.lower(F.col(c))) if shared_namespace else (lambda c: F.concat(F.lit(f"{c}="), F.lower(F.col(c))))
    long = members.select(F.col(member_id), F.explode(F.array_distinct(F.array_compact(F.array(*[tag(c) for c in aliases])))).alias("_alias"))
    owner = long.groupBy("_alias").agg(F.min(member_id).alias("_owner"))
    edges = lookup(long, owner, ["_alias"], how="inner").filter(F.col(member_id) != F.col("_owner")).select(F.col(member_id).alias("a"), F.col("_owner").alias("b")).distinct()
    roots = connected_components(edges)
    return members.select(member_id).join(roots.withColumnRenamed("node", member_id), member_id, "left").select(member_id, F.coalesce("root", member_id).alias("root"))


def strong_conflicts(placed: DataFrame, root: str, strong: str) -> DataFrame:
    """(root, values) of groups in which a strong alias has more than one value."""
    return placed.filter(F.col(strong).isNotNull()).groupBy(root).agg(F.countDistinct(strong).alias("values")).filter("values > 1")


def resolved_composites(placed: DataFrame, root: str, composite: str, member_id: str) -> DataFrame:
    """Members whose composite identity is theirs alone, or only that of their own group."""
    settled = placed.filter(F.col(composite).isNotNull()).groupBy(composite).agg(F.count(F.lit(1)).alias("_n"), F.countDistinct(root).alias("_roots")).filter("_n = 1 or _roots = 1")
    return placed.join(settled.select(composite), composite, "left_semi").select(member_id)


def reviewed_members(placed: DataFrame, content_hash: str, member_id: str, reviews: DataFrame) -> DataFrame:
    """(content_hash, covered): whether a review (content_hash, member_id, class) names exactly the members that have the hash."""
    have = placed.filter(F.col(content_hash).isNotNull()).select(content_hash, member_id).distinct().withColumn("_h", F.lit(1))
    said = reviews.select(content_hash, member_id).distinct().withColumn("_s", F.lit(1))
    both = have.join(said, [content_hash, member_id], "full_outer")
    return both.groupBy(content_hash).agg((F.count_if(F.col("_h").isNull() | F.col("_s").isNull()) == 0).alias("covered"))


def resolution_method(placed: DataFrame, root: str, methods: Sequence[tuple[str, str]]) -> DataFrame:
    """(root, method): the first method, by order of priority, whose condition holds for a member of the group; null for none."""
    rank = F.lit(None).cast("int")
    for k in range(len(methods) - 1, -1, -1):
        rank = F.when(F.expr(methods[k][1]), F.lit(k)).otherwise(rank)
    names = F.array(*[F.lit(m) for m, _ in methods])
    return placed.groupBy(root).agg(F.min(rank).alias("_k")).select(root, F.when(F.col("_k").isNotNull(), F.get(names, F.col("_k"))).alias("method"))
