"""Texts of varying length combined into containers of fixed capacity by large-item matching.

Only the histogram of token counts reaches the driver: it has one row per distinct length, whatever the number of documents. There
documents above one third of the capacity are paired, at most two to a container, each with the largest partner that fits; smaller
ones go by falling size into the smallest gap that takes them, and open containers of their own when none does. Containers with the
same content are planned as one run, so a plan has a few runs per length. Each document then finds its container from its rank
among the documents of its length; ranks come from hash buckets, so no length, however common, meets in one task.

Defined results: documents without tokens get no container; a document above the capacity is cut into full containers and a rest
that is packed like any other; equal lengths are ranked by id; a capacity of null or below 1 gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, shuffle_width

MAX_LENGTHS = 2_000_000
#: Capacities planned in one run.
MAX_CAPACITIES = 1000


@dataclass
class Plan:
    """Where items of each size go: arrays over runs in order of (size, rank), and the number of containers."""

    size: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    per: np.ndarray
    containers: int

    def place(self, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Container of the items with these sizes and ranks among their size."""
        key = self.size.astype(np.int64) << 40 | self.rank
        at = np.searchsorted(key, size.astype(np.int64) << 40 | rank, "right") - 1
        return self.first[at] + (rank - self.rank[at]) // self.per[at]


def plan_containers(counts: dict[int, int], capacity: int) -> Plan:
    """Large-item matching, then best fit by falling size, over numbers of items of each size from 1 to capacity."""
    left = {s: n for s, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int]] = []
    gaps: list[int] = []
    open_runs: dict[int, list[tuple[int, int]]] = {}
    total = 0

    def put(size: int, first: int, bins: int, per: int) -> None:
        runs.append((size, used[size], first, per))
        used[size] += bins * per
        left[size] -= bins * per

    def leave(gap: int, first: int, bins: int) -> None:
        if gap and bins:
            if gap not in open_runs:
                insort(gaps, gap)
                open_runs[gap] = []
            open_runs[gap].append((first, bins))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        k = bisect_left(large, capacity - s + 1) - 1
        t = large[k] if k >= 0 else 0
        if t == s and left[s] < 2:
            t = large[k - 1] if k >= 1 else 0
        if not t:
            n = left[s]
            put(s, total, n, 1)
        elif t == s:
            n = left[s] // 2
            put(s, total, n, 2)
        else:
            n = min(left[s], left[t])
            put(s, total, n, 1)
            put(t, total, n, 1)
        leave(capacity - s - t, total, n)
        total += n
        large = [x for x in large if left[x] > 0] if t else large[:-1]
    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[s] > 0:
            k = bisect_left(gaps, s)
            if k < len(gaps):
                gap = gaps[k]
                first, bins = open_runs[gap].pop()
                if not open_runs[gap]:
                    del open_runs[gap], gaps[k]
            else:
                gap, first = capacity, total
                bins = -(-left[s] // (capacity // s))
                total += bins
            per = min(gap // s, left[s])
            full = min(bins, left[s] // per)
            put(s, first, full, per)
            leave(gap - per * s, first, full)
            first, bins, rest = first + full, bins - full, left[s]
            if bins and rest:
                put(s, first, 1, rest)
                leave(gap - rest * s, first, 1)
                first, bins = first + 1, bins - 1
            leave(gap, first, bins)
    runs.sort()
    a = np.array(runs, np.int64).reshape(-1, 4)
    return Plan(a[:, 0], a[:, 1], a[:, 2], a[:, 3], total)


@dataclass
class Layout:
    """A capacity's plan with what turns a document's length and rank into items."""

    capacity_id: int
    capacity: int
    plan: Plan
    lengths: np.ndarray
    rest_rank: np.ndarray
    full_first: np.ndarray


def layout(capacity_id: int, capacity: int, lengths: np.ndarray, counts: np.ndarray) -> Layout:
    whole = np.where(lengths > capacity, lengths // capacity, 0)
    rest = lengths - whole * capacity
    sizes: dict[int, int] = {}
    rest_rank = np.zeros(len(lengths), np.int64)
    for k, (r, n) in enumerate(zip(rest.tolist(), counts.tolist(), strict=True)):
        if r:
            rest_rank[k] = sizes.get(r, 0)
            sizes[r] = sizes.get(r, 0) + n
    plan = plan_containers(sizes, capacity)
    full_first = plan.containers + np.append(0, np.cumsum(whole * counts)[:-1]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
    return Layout(capacity_id, capacity, plan, lengths, rest_rank, full_first)


def _assigning(layouts: list[Layout]):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, tokens, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for x in layouts:
                at = np.searchsorted(x.lengths, tokens)
                whole = np.where(tokens > x.capacity, tokens // x.capacity, 0)
                rest = tokens - whole * x.capacity
                doc = np.repeat(np.arange(len(ids)), whole)
                piece = np.arange(len(doc)) - np.repeat(np.append(0, np.cumsum(whole)[:-1]), whole)
                has = np.flatnonzero(rest > 0)
                container = np.concatenate([x.full_first[at[doc]] + rank[doc] * whole[doc] + piece, x.plan.place(rest[has], x.rest_rank[at[has]] + rank[has]) if len(has) else np.zeros(0, np.int64)])
                part = np.concatenate([piece, whole[has]])
                size = np.concatenate([np.full(len(doc), x.capacity), rest[has]])
                owner = np.concatenate([doc, has])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(owner), x.capacity_id), pa.int32()), pa.array(container, pa.int64()), pa.array(ids[owner], pa.int64()), pa.array(part + 1, pa.int32()), pa.array(part * x.capacity, pa.int64()), pa.array(size, pa.int64())],
                    names=["capacity_id", "container", "doc_id", "piece", "token_from", "tokens"],
                )

    return run


def ranked(sizes: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, tokens, rank): rank from 0 among the documents of the same length, through hash buckets of bounded size."""
    spread = sizes.filter("tokens > 0").select("doc_id", "tokens", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).alias("bucket"))
    counts = spread.groupBy("tokens", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("tokens", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("tokens", "bucket").orderBy("doc_id")
    return spread.withColumn("r", F.row_number().over(within) - 1).join(offsets, ["tokens", "bucket"]).select("doc_id", "tokens", (F.col("base") + F.col("r")).alias("rank"))


def pack(sizes: DataFrame, capacities: DataFrame, buckets: int | None = None) -> DataFrame:
    """(capacity_id, container, doc_id, piece, token_from, tokens) for every capacity: containers are numbered from 0.

    sizes: doc_id, tokens. capacities: capacity_id, capacity_tokens; a handful of rows.
    """
    spark = sizes.sparkSession
    sizes = materialize(sizes.select("doc_id", "tokens"), "token-sizes")
    lengths = sizes.filter("tokens > 0").groupBy("tokens").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LENGTHS + 1).toPandas().sort_values("tokens")
    if len(lengths) > MAX_LENGTHS:
        raise ValueError("more distinct lengths than a driver should hold; cut the longest texts first")
    wanted = [(int(r[0]), int(r[1])) for r in capacities.filter("capacity_tokens >= 1").select("capacity_id", "capacity_tokens").orderBy("capacity_id").limit(MAX_CAPACITIES + 1).collect()]
    if len(wanted) > MAX_CAPACITIES:
        raise ValueError(f"more than {MAX_CAPACITIES} capacities")
    v, n = lengths["tokens"].to_numpy(np.int64), lengths["n"].to_numpy(np.int64)
    layouts = [layout(c, cap, v, n) for c, cap in wanted]
    buckets = buckets or 4 * shuffle_width(spark)
    return ranked(sizes, buckets).mapInArrow(_assigning(layouts), "capacity_id int, container long, doc_id long, piece int, token_from long, tokens long")


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Containers, tokens and the share of space used per capacity, with the least number of containers any packing needs."""
    held = packed.groupBy("capacity_id").agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("items"))
    return held.join(F.broadcast(capacities.select("capacity_id", "capacity_tokens")), "capacity_id").select(
        "capacity_id", "capacity_tokens", "documents", "items", "tokens", "containers", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"), F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4).alias("fill")
    )
