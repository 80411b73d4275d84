"""Pairwise matches consolidated into groups: seed-tree pruning (after Lulli et al., "Fast connected components computation in
large graphs by vertex pruning", IEEE TPDS 2017), as DataFrame joins.

Each round every vertex proposes the smallest of itself and its neighbours to all of them. A vertex that nobody proposes drops out
into a propagation forest below its smallest proposal; the proposals of each vertex are linked with the smallest one and make up
the next, smaller graph. When no edge is left, the vertices still standing are the seeds, and their identifiers flow down the
forest, latest round first.

No neighbourhood is ever collected: every step is an aggregation with map-side combining or an equi-join in which hot vertices (a
hub may touch a third of all edges) are kept out of the shuffle. Each round is written to the shared folder.

Defined results: null ends and self-loops link nothing; repeated edges count once; an empty edge table gives an empty forest;
vertices without edges are not listed (they are their own group). Of the membership ledger, records without any alias are left out;
null partitions and tokens are values like others.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import HOT_SHARE, Scratch, dashed, empty, lookup, materialize, release, uuid_key

HOT_LEAST = 10_000


def _hot(counted: DataFrame, key: str, total: int) -> DataFrame:
    """Vertices with more than HOT_SHARE of the rows, of which there can be only 1 / HOT_SHARE."""
    return counted.filter(F.col("n") > max(HOT_LEAST, int(total * HOT_SHARE))).select(key)


def seed_trees(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, kind: str = "long") -> DataFrame:
    """(node, root) of every vertex with an edge; root is the smallest vertex of its group. Vertices are whole numbers of a kind."""
    ends = edges.select(F.col(a).cast(kind).alias("u"), F.col(b).cast(kind).alias("v")).filter("u is not null and v is not null and u <> v")
    graph = materialize(ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "graph")
    trees: list[DataFrame] = []
    for _ in range(max_rounds):
        total = graph.count()
        if not total:
            release(graph)
            break
        mins = materialize(graph.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "minima")
        told = lookup(graph, mins.select("u", "m"), ["u"], how="inner", hot=_hot(mins, "u", total)).select(F.col("v").alias("x"), F.col("m").alias("p"))
        proposals = materialize(told.unionByName(mins.select(F.col("u").alias("x"), F.col("m").alias("p"))).distinct(), "proposals")
        best = materialize(proposals.groupBy("x").agg(F.min("p").alias("least_p"), F.max(F.col("p") == F.col("x")).alias("stays"), F.count(F.lit(1)).alias("n")), "best")
        release(graph, mins)
        trees.append(materialize(best.filter("not stays").select(F.col("x").alias("node"), F.col("least_p").alias("parent")), "tree"))
        several = best.filter("n > 1")
        linked = lookup(proposals, several.select("x", "least_p"), ["x"], how="inner", hot=_hot(best, "x", proposals.count())).filter("p <> least_p").select(F.col("least_p").alias("u"), F.col("p").alias("v"))
        graph = materialize(linked.unionByName(linked.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "graph")
        release(proposals, best)
    else:
        raise RuntimeError(f"groups did not settle in {max_rounds} rounds")
    return _flow_down(edges, trees, kind)


def _flow_down(edges: DataFrame, trees: list[DataFrame], kind: str) -> DataFrame:
    """Seeds to the vertices below them. A parent outlives its children's round, so its own root is known when theirs is asked for."""
    spark = edges.sparkSession
    known: DataFrame | None = None
    parts: list[DataFrame] = []
    for tree in reversed(trees):
        if known is None:
            labelled = tree.select("node", F.col("parent").alias("root"))
        else:
            labelled = lookup(tree, known.select(F.col("node").alias("parent"), "root"), ["parent"]).select("node", F.coalesce("root", "parent").alias("root"))
        labelled = materialize(labelled, "labels")
        parts.append(labelled)
        known = reduce(DataFrame.unionByName, parts)
    release(*trees)
    if known is None:
        return empty(spark, f"node {kind}, root {kind}")
    roots = known.select(F.col("root").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return known.unionByName(roots)


#: Node numbers have 126 bits: about one equal pair is to be expected among 10^19 keys. Whole numbers of this kind are combined and
#: compared in place, which byte strings are not.
NODE = "decimal(38,0)"


def _half(c: Column) -> Column:
    return F.shiftrightunsigned(c, 1).cast("decimal(19,0)")


def _node(c: Column | str) -> Column:
    """The number of an alias, from two independent hashes."""
    c = F.col(c) if isinstance(c, str) else c
    high, low = _half(F.xxhash64(c)), _half(F.xxhash64(F.lit("second"), F.reverse(c)))
    return (high * F.lit(str(1 << 63)).cast("decimal(19,0)") + low).cast(NODE)


def consolidate(sightings: DataFrame, record: list[str], aliases: list[str], key_of: Callable[[str], Column] = uuid_key) -> DataFrame:
    """(record..., group_key, records): one row per distinct record with at least one alias.

    Records are linked by any alias they share, whatever column it stands in and over any number of records. group_key is the
    smallest alias of the group. Aliases are compared as ``key_of`` writes them; null and blank aliases link nothing.
    """
    keys = F.array_sort(F.array_compact(F.array(*[key_of(c) for c in aliases])))
    keyed = sightings.select(*record, keys.alias("_keys")).filter(F.size("_keys") > 0)
    # one row per record and set of aliases: redelivered and repeated sightings end here, before anything else is shuffled
    scratch = Scratch()
    seen = scratch.keep(keyed.select(*record, F.element_at("_keys", 1).alias("low"), F.slice("_keys", 2, len(aliases)).alias("others")).distinct(), "sightings")
    firsts = scratch.keep(seen.groupBy(*record).agg(F.min("low").alias("first"), F.count(F.lit(1)).alias("n")), "records")
    names = [F.coalesce(F.col(c), F.lit("")) for c in record]
    rec = F.xxhash64(*names, F.lit("record"))
    rec2 = F.xxhash64(F.lit("other"), *[F.reverse(c) for c in names])
    # edges inside a sighting, and from each sighting of a record to the record's first alias
    inside = seen.filter(F.size("others") > 0).select("low", F.explode("others").alias("key")).select(F.col("low").alias("p"), F.col("key").alias("q"))
    many = firsts.filter("n > 1").select(rec.alias("_r"), rec2.alias("_s"), "first", "n")
    across = lookup(seen.select(rec.alias("_r"), rec2.alias("_s"), "low"), many.select("_r", "_s", "first"), ["_r", "_s"], how="inner", hot=many.filter(F.col("n") > HOT_LEAST).select("_r", "_s")).filter("first <> low").select(F.col("first").alias("p"), F.col("low").alias("q"))
    pairs = scratch.keep(inside.unionByName(across).filter("p <> q").distinct(), "pairs")
    roots = scratch.keep(seed_trees(pairs.select(_node("p").alias("a"), _node("q").alias("b")), kind=NODE), "roots")
    placed = lookup(firsts.select(*record, "first", _node("first").alias("node")), roots, ["node"]).select(*record, "first", F.coalesce("root", "node").alias("root"))
    placed = materialize(placed, "placed")
    scratch.clear()
    groups = placed.groupBy("root").agg(F.min("first").alias("group_key"), F.count(F.lit(1)).alias("records"))
    sized = materialize(groups, "groups")
    hot = sized.filter(F.col("records") > max(HOT_LEAST, int(placed.count() * HOT_SHARE))).select("root")
    return lookup(placed, sized, ["root"], how="inner", hot=hot).select(*record, "group_key", "records")


def membership_groups(memberships: DataFrame) -> DataFrame:
    """(partition_id, membership_token, group_key, records) of every record of the membership ledger."""
    rows = memberships.select("partition_id", uuid_key("membership_token").alias("membership_token"), "document_uuid", "pdf_uuid")
    grouped = consolidate(rows, ["partition_id", "membership_token"], ["document_uuid", "pdf_uuid"])
    return grouped.select("partition_id", dashed("membership_token").alias("membership_token"), dashed("group_key").alias("group_key"), "records")
