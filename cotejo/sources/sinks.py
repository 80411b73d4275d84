"""Appends that may be repeated, and files that are replaced whole or not at all."""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ledger import exists


def append_jsonl(df: DataFrame, path: str) -> None:
    """Rows appended to a ledger as JSON lines, in parts."""
    df.write.mode("append").option("ignoreNullFields", "true").json(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Rows whose key the Parquet table at path does not have yet, one per key, appended; how many there were. Null keys are equal.

    Writing the same rows again appends nothing, so a run may be repeated after any failure.
    """
    spark = df.sparkSession
    fresh = df.dropDuplicates(list(keys))
    if exists(spark, path):
        known = spark.read.parquet(path).select(*[F.col(c).alias(f"_known_{c}") for c in keys])
        # null is a key like others, as it is for dropDuplicates
        fresh = fresh.join(known, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in keys]), "left_anti")
    fresh = fresh.persist()
    try:
        n = fresh.count()
        if n:
            fresh.write.mode("append").parquet(path)
        return n
    finally:
        fresh.unpersist()


def replace_file(path: str, text: str, mode: int = 0o600) -> None:
    """A small file replaced at once: written beside, synced, renamed, folder synced. Refuses to work beside another's leftover."""
    folder = os.path.dirname(os.path.abspath(path))
    stale = [f for f in os.listdir(folder) if f.startswith(f".{os.path.basename(path)}.") and f.endswith(".tmp")]
    if stale:
        raise FileExistsError(f"leftover of an interrupted write: {stale[0]}")
    beside = os.path.join(folder, f".{os.path.basename(path)}.{uuid.uuid4().hex}.tmp")
    fd = os.open(beside, os.O_WRONLY | os.O_CREAT | os.O_EXCL, mode)
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(beside, path)
    except BaseException:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(beside)
        raise
    with contextlib.suppress(OSError):
        at = os.open(folder, os.O_RDONLY)
        os.fsync(at)
        os.close(at)


def contained(folder: str, name: str) -> str:
    """The path of a file directly in a folder; a name that leads anywhere else is an error."""
    home = os.path.realpath(folder)
    path = os.path.realpath(os.path.join(home, name))
    if os.path.dirname(path) != home:
        raise ValueError("the name leads out of the folder")
    return path


def write_receipt(path: str, receipt: dict[str, Any]) -> None:
    replace_file(path, json.dumps(receipt, indent=2, ensure_ascii=False) + "\n")


def keep_plan(path: str, plan: dict[str, Any]) -> dict[str, Any]:
    """The plan of a data folder: created where there is none, otherwise it must be equal."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        if found != plan:
            raise ValueError("the folder holds data of another plan")
        return found
    folder = os.path.dirname(os.path.abspath(path))
    if os.path.isdir(os.path.join(folder, "data")) and os.listdir(os.path.join(folder, "data")):
        raise ValueError("the folder holds data without a plan")
    os.makedirs(folder, exist_ok=True)
    replace_file(path, json.dumps(plan, indent=2, ensure_ascii=False) + "\n")
    return plan


#: What a resume point must say.
CHECKPOINT_FIELDS = {"baseUrl": str, "queryHash": str, "partitionId": str, "page": int}


class CheckpointError(ValueError):
    """A resume point that cannot be used, and why."""


def save_checkpoint(path: str, state: dict[str, Any]) -> None:
    """A resume point replaced at once; one that lacks a field is refused before anything is written."""
    replace_file(path, json.dumps(_valid_checkpoint(state), ensure_ascii=False) + "\n")


def _valid_checkpoint(state: Any) -> dict[str, Any]:
    wrong = [k for k, kind in CHECKPOINT_FIELDS.items() if not isinstance(state, dict) or type(state.get(k)) is not kind]
    if wrong or state["page"] < 1:
        raise CheckpointError(f"no valid resume point: {', '.join(wrong) or 'page'}")
    return state


def load_checkpoint(path: str) -> dict[str, Any] | None:
    """The resume point, null where none was ever written. Leftovers beside a valid one are removed; leftovers without one are an
    error, because it cannot be told whether they are whole."""
    folder, name = os.path.split(os.path.abspath(path))
    rest = [os.path.join(folder, f) for f in (os.listdir(folder) if os.path.isdir(folder) else []) if f.startswith(f".{name}.") and f.endswith(".tmp")]
    if not os.path.exists(path):
        if rest:
            raise CheckpointError(f"no resume point but leftovers of a write: {', '.join(map(os.path.basename, sorted(rest)))}")
        return None
    try:
        with open(path, encoding="utf-8") as f:
            state = _valid_checkpoint(json.load(f))
    except json.JSONDecodeError as e:
        raise CheckpointError("no valid resume point: no JSON") from e
    for f in rest:
        os.unlink(f)
    return state


def resume_place(state: dict[str, Any] | None, base_url: str, query_hash: str, partitions: Sequence[str]) -> tuple[str, int] | None:
    """Partition and page to go on from; a resume point of another address, query or set of partitions is an error."""
    if state is None:
        return None
    wrong = [n for n, ok in (("baseUrl", state["baseUrl"] == base_url), ("queryHash", state["queryHash"] == query_hash), ("partitionId", state["partitionId"] in partitions)) if not ok]
    if wrong:
        raise CheckpointError(f"the resume point is of another run: {', '.join(wrong)}")
    return state["partitionId"], state["page"]


def store_content(folder: str, name: str, body: bytes, least: int, most: int, magic: bytes = b"%PDF-", expected: int | None = None) -> dict[str, Any]:
    """A file that is there only once its content was found good: written beside its place, checked, renamed. {code, bytes, sha256};
    with a code nothing is left behind, and a file that was there stays."""
    path, size = contained(folder, name), len(body)
    faults = (("EMPTY", size == 0), ("TOO_LARGE", size > most), ("TOO_SMALL", size < least), ("INVALID_SIGNATURE", not body.startswith(magic)), ("INCOMPLETE", expected is not None and size != expected))
    code = next((c for c, wrong in faults if wrong), None)
    if code is None:
        beside = f"{path}.{uuid.uuid4().hex}.part"
        try:
            with open(beside, "xb") as f:
                f.write(body)
                f.flush()
                os.fsync(f.fileno())
            os.replace(beside, path)
        finally:
            with contextlib.suppress(FileNotFoundError):
                os.unlink(beside)
    return {"code": code, "bytes": size, "sha256": None if code else hashlib.sha256(body).hexdigest()}


def summary_line(df: DataFrame) -> str:
    """A one-row summary as one line of JSON."""
    return df.limit(1).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).first()["j"]
