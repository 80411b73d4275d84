"""Line-oriented sources: ledgers, audit files and logs.

Every line keeps its file and its number in it, so "last wins" has an order on any cluster: (file, line). Files of a ledger are
read whole and split in one task each; a ledger that should be read in parallel is written in parts, as the sink does.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINES = "file string, line long, text string, closed boolean"


class LineError(ValueError):
    """A line that is no valid record, with its number."""


def exists(spark: SparkSession, path: str) -> bool:
    """True where a path or pattern leads to a file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            parts = content.split(b"\n")
            closed = parts[-1] == b""
            if closed:
                parts.pop()
            for at in range(0, len(parts), 10_000):
                chunk = parts[at : at + 10_000]
                last = at + len(chunk) == len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(chunk), pa.string()),
                        pa.array(range(at + 1, at + 1 + len(chunk)), pa.int64()),
                        pa.array([x.decode("utf-8", "replace").rstrip("\r") for x in chunk], pa.string()),
                        pa.array([True] * (len(chunk) - 1) + [closed or not last], pa.bool_()),
                    ],
                    names=["file", "line", "text", "closed"],
                )


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text, closed) of every line; closed is false for a last line without a line end. No file gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], LINES)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_split, LINES)


@F.pandas_udf(T.BooleanType())
def _valid_json(s: pd.Series) -> pd.Series:
    def one(v: str) -> bool:
        try:
            return isinstance(json.loads(v), dict)
        except ValueError:
            return False

    return s.map(one)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, tolerate_tail: bool = True) -> DataFrame:
    """The records of a ledger with (file, line). Blank lines are skipped; an invalid last line without a line end is left out
    where ``tolerate_tail``; any other invalid line raises LineError with its place.

    Validity is decided by a JSON parser, as from_json accepts junk behind an object.
    """
    rows = lines(spark, path).filter(F.trim("text") != "").withColumn("_ok", _valid_json("text"))
    broken = rows.filter(~F.col("_ok") & (F.col("closed") | F.lit(not tolerate_tail))).orderBy("file", "line").select("file", "line").first()
    if broken is not None:
        raise LineError(f"{broken['file']}: line {broken['line']} is no valid record")
    return rows.filter("_ok").select("file", "line", F.from_json("text", schema).alias("_r")).select("file", "line", "_r.*")


def truncated_tail(spark: SparkSession, path: str) -> bool:
    """True where a ledger ends in an invalid line without a line end."""
    return not lines(spark, path).filter((F.trim("text") != "") & ~F.col("closed")).filter(~_valid_json("text")).isEmpty()


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """(n, type, text) of an audit file, n counting the lines that are not blank; an invalid line raises LineError."""
    rows = lines(spark, path).filter(F.trim("text") != "").withColumn("_ok", _valid_json("text"))
    numbered = rows.select("line", "_ok", F.trim("text").alias("text"))
    broken = numbered.filter(~F.col("_ok")).agg(F.min("line").alias("at")).first()["at"]
    if broken is not None:
        n = numbered.filter(F.col("line") <= broken).count()
        raise LineError(f"line {n} is no valid JSON object")
    return numbered.select(F.col("line").alias("n"), F.get_json_object("text", "$.type").alias("type"), "text")


def read_json(path: str) -> dict:
    """A small JSON document, read on the driver; errors name the file."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except ValueError as e:
        raise LineError(f"{path}: no valid JSON") from e


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id) of an id list: distinct, in lower case; a line that is no UUID raises LineError."""
    from ..functions.identity import UUID_PATTERN

    rows = lines(spark, path).filter(F.trim("text") != "").select("line", F.lower(F.trim("text")).alias("id"))
    broken = rows.filter(~F.col("id").rlike(UUID_PATTERN)).agg(F.min("line").alias("at")).first()["at"]
    if broken is not None:
        raise LineError(f"line {broken} is no identifier")
    return rows.select("id").distinct()


def supervisor_log(spark: SparkSession, path: str) -> tuple[DataFrame, int | None]:
    """(pass, new_memberships, partitions) of completed passes, the last line of a pass counting, and the pass that converged."""
    rows = lines(spark, path)
    pattern = r"pass=(\d+) complete=true new_memberships=(\d+) partitions=(\d+)"
    got = lambda g: F.regexp_extract("text", pattern, g)
    done = rows.filter(F.col("text").rlike(pattern)).select(got(1).cast("int").alias("pass"), got(2).cast("long").alias("new_memberships"), got(3).cast("int").alias("partitions"), "line")
    last = done.groupBy("pass").agg(F.max_by(F.struct("new_memberships", "partitions"), "line").alias("_r")).select("pass", "_r.*")
    converged = rows.filter(F.col("text").rlike(r"converged=true pass=\d+")).agg(F.max_by(F.regexp_extract("text", r"converged=true pass=(\d+)", 1).cast("int"), "line").alias("p")).first()["p"]
    return last, converged


_DISCOVERY = "command string, partitions array<struct<partitionId:string,initialQueryTotal:long,finalQueryTotal:long,queryTotal:long>>, globalTotal struct<initial:long,final:long>"


def discovery_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Totals by partition (partition, initial, final) and over all (initial, final), from the JSON lines of a mixed log.

    First initial and last final count; lines that are no valid record or belong to another command are skipped.
    """
    rows = lines(spark, path).filter(F.ltrim("text").startswith("{")).filter(_valid_json("text"))
    runs = rows.select("line", F.from_json("text", _DISCOVERY).alias("r")).filter("r.command = 'discover'").select("line", "r.*")
    each = runs.select("line", F.posexplode("partitions").alias("at", "p")).select("line", "at", "p.*")
    first = F.coalesce("initialQueryTotal", "queryTotal")
    last = F.coalesce("finalQueryTotal", "queryTotal")
    seen = lambda c: F.when(c.isNotNull(), F.struct("line", "at"))
    totals = each.groupBy(F.col("partitionId").alias("partition")).agg(F.min_by(first, seen(first)).alias("initial"), F.max_by(last, seen(last)).alias("final"))
    g = runs.select("line", F.col("globalTotal.initial").alias("i"), F.col("globalTotal.final").alias("f"))
    return totals, g.agg(F.min_by("i", F.when(F.col("i").isNotNull(), F.col("line"))).alias("initial"), F.max_by("f", F.when(F.col("f").isNotNull(), F.col("line"))).alias("final"))


def has_rows(df: DataFrame) -> bool:
    """True where there is a row; stops at the first."""
    return not df.isEmpty()


def binaries(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of files. Spark does not list empty files: one that a manifest names and this does not is missing or empty."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")
