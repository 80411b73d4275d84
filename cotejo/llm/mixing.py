"""Sources mixed to target weights.

Tokens are summed per source (map-side combined, one row per source); the total is the largest at which every source that has
tokens can hold its share within its cap of repeats. Each source's repetition rate follows, and every document is emitted
floor(rate) times plus one more time with probability equal to the fraction, drawn from a hash of its id and the seed: the same
documents come out of any cluster and any partitioning, and no document has to know another.

Defined results: a source without documents or with a target of 0 or null gives nothing and its share is spread over the others in
proportion; documents without a source or of a source without a target are not selected; documents without tokens are not
selected; a cap of null or below 1 counts as 1; repeated targets of one source are added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_SOURCES = 100_000


def repetition_rates(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available, rate): one row per target. total: tokens wanted, as many as can be had if None."""
    per = sizes.filter("tokens > 0 and source is not null").groupBy("source").agg(F.sum("tokens").alias("available"))
    want = targets.filter("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(1))).alias("max_repeats"))
    known = want.join(per, "source", "left").select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), "max_repeats", F.coalesce("available", F.lit(0)).alias("available"))
    usable = (F.col("available") > 0) & (F.col("target_share") > 0)
    weight, most = known.agg(F.sum(F.when(usable, F.col("target_share"))), F.min(F.when(usable, F.col("max_repeats") * F.col("available") / F.col("target_share")))).first()
    if weight is None:
        return known.withColumn("rate", F.lit(0.0))
    wanted = F.lit(float(total if total is not None else most * weight))
    # with a total beyond reach, each source gives what its cap allows
    rate = F.when(usable, F.least(F.col("max_repeats").cast("double"), wanted * F.col("target_share") / F.lit(weight) / F.col("available"))).otherwise(F.lit(0.0))
    return known.withColumn("rate", rate)


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 42, total: float | None = None) -> DataFrame:
    """(doc_id, source, copy, tokens): the selection, one row per copy of a document, copies numbered from 1."""
    rates = repetition_rates(sizes, targets, total).filter("rate > 0").select("source", "rate", "max_repeats")
    bounded = rates.limit(MAX_SOURCES)
    few = targets.limit(MAX_SOURCES + 1).count() <= MAX_SOURCES
    placed = sizes.filter("tokens > 0").join(F.broadcast(bounded) if few else rates, "source")
    # 53 bits of the hash make a fraction from 0 up to, not including, 1
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / F.lit(float(1 << 53))
    whole = F.floor("rate")
    copies = F.least(F.col("max_repeats"), whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0)).cast("int")
    return placed.withColumn("_n", copies).filter("_n > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"), "tokens")


def share_report(selection: DataFrame, sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """Per target: the share wanted, the rate used, and the share of tokens reached."""
    got = selection.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.max("copy").alias("most_copies"))
    everything = got.agg(F.sum("tokens")).first()[0] or 1
    rates = repetition_rates(sizes, targets, total)
    return (
        rates.join(got, "source", "left")
        .select(
            "source", "target_share", "max_repeats", "available", F.round("rate", 6).alias("rate"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
            F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.round(F.coalesce(F.col("tokens") / F.lit(everything), F.lit(0.0)), 6).alias("actual_share"),
        )
    )
