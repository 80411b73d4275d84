"""Ledgers fed by streams: repeated deliveries and restarts add nothing twice."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..sources.sinks import append_new


def ledger_stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New files of a folder of JSON lines as they come; one trigger takes a bounded number of files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def ingest(stream: DataFrame, table: str, keys: Sequence[str], checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True) -> StreamingQuery:
    """Appends the rows with new keys to a Parquet table. Rows are written before the offset is kept, and a batch that is run
    again finds its own keys, so every row is there exactly once."""

    def batch(df: DataFrame, _: int) -> None:
        append_new(transform(df) if transform else df, table, keys)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


LATEST = "document string, state string, seq long"


def _fold(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    at, what = state.get if state.exists else (-1, None)
    for pdf in batches:
        k = pdf["seq"].idxmax()
        if pdf.at[k, "seq"] > at:
            at, what = int(pdf.at[k, "seq"]), pdf.at[k, "state"]
    state.update((at, what))
    yield pd.DataFrame({"document": [key[0]], "state": [what], "seq": [at]})


def latest_state_stream(events: DataFrame) -> DataFrame:
    """(document, state, seq) whenever a document gets events: the state of its highest sequence number, late events included.

    events: document, state, seq. Per key only two values are kept, however many events there are.
    """
    return events.groupBy("document").applyInPandasWithState(_fold, LATEST, "seq long, state string", "update", GroupStateTimeout.NoTimeout)


def repeat_until_quiet(run_pass: Callable[[int], int], most: int = 100) -> int:
    """Runs full passes until one brings no new identity; the number of that pass. run_pass gives how many were new."""
    for n in range(1, most + 1):
        if run_pass(n) == 0:
            return n
    raise RuntimeError(f"no quiet pass in {most}")
