"""Current state of append-only ledgers: the last event of a key is its state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(events: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key with the values of its last event. Combined before the shuffle, so a hot key sends one row per task.

    order decides what is last: the append order of the ledger, not the clock.
    """
    last = F.max_by(F.struct(*values), F.struct(*order) if len(order) > 1 else F.col(order[0])).alias("_last")
    return events.groupBy(*keys).agg(last).select(*keys, "_last.*")


def state_counts(states: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """(state, documents) with a row for every known state, 0 where none has it."""
    spark = states.sparkSession
    counted = states.groupBy(F.col(column).alias("state")).agg(F.count(F.lit(1)).alias("documents"))
    return spark.createDataFrame([(s,) for s in known], "state string").join(counted, "state", "left").select("state", F.coalesce("documents", F.lit(0)).alias("documents"))


def open_failures(failures: DataFrame, key: str = "failure_id", order: str = "ledger_seq", values: Sequence[str] = ("phase", "document_id", "partition_id", "page", "retryable", "occurred_at", "next_retry_at", "resolution")) -> DataFrame:
    """Failures whose last event leaves them open; one that was resolved and opened again is open."""
    return latest_by_key(failures, [key], [order], list(values)).filter("resolution = 'open'")


def logical_pending(opened: DataFrame, key: str = "failure_id", by: Sequence[str] = ("phase", "document_id")) -> DataFrame:
    """(by..., canonical_id, failures): the open failures of one document and phase stand under the smallest id."""
    has = F.lit(True)
    for c in by:
        has = has & F.col(c).isNotNull()
    return opened.filter(has).groupBy(*by).agg(F.min(key).alias("canonical_id"), F.count(F.lit(1)).alias("failures"))


def resolution_events(opened: DataFrame, pending: DataFrame, at: Column, key: str = "failure_id", by: Sequence[str] = ("phase", "document_id")) -> DataFrame:
    """The events that close every open failure but the canonical one of its document and phase."""
    return opened.join(pending.select(*by, "canonical_id"), list(by)).filter(F.col(key) != F.col("canonical_id")).select(key, *by, F.lit("resolved").alias("resolution"), at.alias("resolved_at"))


def resolve_all(opened: DataFrame, documents: DataFrame, at: Column, key: str = "failure_id", by: Sequence[str] = ("phase", "document_id")) -> DataFrame:
    """The events that close every open failure of some documents (by...): one row per failure, appended to the ledger as they are."""
    return opened.join(documents.select(*by).distinct(), list(by), "left_semi").select(key, *by, F.lit("resolved").alias("resolution"), at.alias("resolved_at"))
