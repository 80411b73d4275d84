"""Session-wide helpers: tables, shared scratch space and joins that survive hot keys."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from math import ceil
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot when it holds more than this share of the rows; there can be at most 1 / HOT_SHARE such keys.
HOT_SHARE = 1 / 500


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per session, for those that do not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_cotejo_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cotejo-code-")
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(f"{folder}/cotejo_code.zip", "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    sc.addPyFile(f"{folder}/cotejo_code.zip")
    sc._cotejo_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir, or, in a local session without one, a temporary one of our
    own. A cluster without the setting is an error: a folder of one machine would lose the rows that others write."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    own = getattr(spark.sparkContext, "_cotejo_scratch", None)
    if own is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="cotejo-")
        spark.sparkContext._cotejo_scratch = own
        spark.sparkContext.setCheckpointDir(own)
        atexit.register(shutil.rmtree, own, True)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/cotejo/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):  # noqa: ANN202
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder; one that is not there is no error."""
    system, target = _hadoop(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of the shared folder, null where it is not there."""
    system, target = _hadoop(spark, path)
    if not system.exists(target):
        return None
    with_stream = system.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(with_stream)).decode("utf-8")
    finally:
        with_stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the shared folder, written beside its place and renamed."""
    system, target = _hadoop(spark, path)
    _, beside = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = system.create(beside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    system.delete(target, False)
    if not system.rename(beside, target):
        raise OSError(f"{path} could not be replaced")


def materialize(df: DataFrame, label: str = "table", codec: str = "zstd") -> DataFrame:
    """Writes df to the shared folder as Parquet and reads it back: the lineage is cut, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cotejo_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Deletes tables written by materialize() that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_cotejo_path", None)
        if path:
            delete_path(df.sparkSession, path)
            df._cotejo_path = None


class Scratch:
    """Tables of one run that can go together once its result is written."""

    def __init__(self) -> None:
        self.frames: list[DataFrame] = []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        out = materialize(df, label)
        self.frames.append(out)
        return out

    def clear(self) -> None:
        release(*self.frames)
        self.frames = []


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: what the cluster's owner sized for its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, least: int = 10_000) -> DataFrame:
    """The keys with most rows, of those with more than ``least``: at most 1/share of them, so safe to broadcast, and every key that
    holds more than ``share`` of the rows is among them.

    The count is map-side combined; only one row per key and task is shuffled, and no row count is needed.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > least)
    return counted.orderBy(F.desc("_n")).limit(ceil(1 / share)).select(*keys)


def lookup(facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left", hot: DataFrame | None = None, least: int = 10_000) -> DataFrame:
    """facts joined with dim (unique on keys), with hot keys of facts kept out of the shuffle.

    Rows of a hot key meet their single dim row by a broadcast of at most 1/HOT_SHARE rows; all others are shuffled by key.
    Null keys never match; with ``how='left'`` they stay, with nulls on the right.
    """
    if hot is None:
        hot = hot_keys(facts, keys, least=least)
    keys = list(keys)
    hot_rows = [r for r in hot.limit(ceil(1 / HOT_SHARE) + 1).collect()]
    if not hot_rows:
        return facts.join(dim, keys, how)
    small = F.broadcast(facts.sparkSession.createDataFrame(hot_rows, hot.schema))
    marked = small.withColumn("_hot", F.lit(True))
    facts_marked = facts.join(marked, keys, "left")
    hot_dim = dim.join(small, keys, "left_semi")
    warm = facts_marked.filter(F.col("_hot")).drop("_hot").join(F.broadcast(hot_dim), keys, how)
    cold = facts_marked.filter(F.col("_hot").isNull()).drop("_hot").join(dim, keys, how)
    return warm.unionByName(cold)


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], most: int, ways: int = 32, least: int = 100_000) -> DataFrame:
    """Inner join of two tables that may both repeat keys. Rows of ``left`` with a hot key are spread over ``ways`` tasks, and the rows
    of ``right`` with such a key, of any number, go to each of them; nothing is broadcast but the hot keys, at most 1/HOT_SHARE.

    most: no key stands in more rows of ``left``; up to ``least`` of them no key is looked for.
    """
    keys = list(keys)
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max(least, int(most * HOT_SHARE))).select(*keys)
    hot_rows = counts.limit(ceil(1 / HOT_SHARE) + 1).collect() if most > least else []
    if not hot_rows:
        return left.join(right, keys)
    small = F.broadcast(left.sparkSession.createDataFrame(hot_rows, left.select(*keys).schema).withColumn("_hot", F.lit(True)))
    rest = [c for c in left.columns if c not in keys]
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*rest), F.lit(ways))).otherwise(F.lit(0)).cast("int")
    many = left.join(small, keys, "left").withColumn("_salt", salt).drop("_hot")
    every = F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0))))
    return many.join(right.join(small, keys, "left").withColumn("_salt", every).drop("_hot"), [*keys, "_salt"]).drop("_salt")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows, made without a job or a Python worker."""
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in schema.split(", "))])


def uuid_key(col: Column | str) -> Column:
    """The last 32 hexadecimal digits in lower case, or the trimmed lower-case text where there are fewer; blank becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    digits = F.regexp_replace(F.lower(c), "[^0-9a-f]", "")
    plain = F.lower(F.trim(c))
    return F.when(F.length(digits) >= 32, F.right(digits, F.lit(32))).otherwise(F.when(plain != "", plain))


def dashed(col: Column | str) -> Column:
    """32 hexadecimal digits written 8-4-4-4-12; anything else stays as it is."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, "^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$", "$1-$2-$3-$4-$5")
