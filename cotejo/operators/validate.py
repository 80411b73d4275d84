"""Invariants as violation rows. They are counted first and raised on the driver, never hidden in a column that may be pruned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import UUID_PATTERN


class InvariantError(ValueError):
    """Data that breaks an invariant; carries the counts by rule."""

    def __init__(self, counts: Mapping[str, int]):
        self.counts = dict(counts)
        super().__init__("; ".join(f"{k}: {v} rows" for k, v in sorted(self.counts.items())))


def filled(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))


def uuid_like(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(UUID_PATTERN), F.lit(False))


def one_of(c: str, values: Sequence[str]) -> Column:
    return F.coalesce(F.col(c).isin(*values), F.lit(False))


def at_least(c: str, least: int, optional: bool = False) -> Column:
    return F.coalesce(F.col(c) >= least, F.lit(optional))


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, rows): how many rows break each rule, with a row for every rule. One scan, one row shuffled per task."""
    counted = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("rows")) for n in rules])).alias("_v")).select("_v.*")


def require(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """df itself, if no row breaks a rule; InvariantError otherwise. Evaluated at once."""
    broken = {r["rule"]: r["rows"] for r in violations(df, rules).filter("rows > 0").collect()}
    if broken:
        raise InvariantError(broken)
    return df


def content_verdict(content: Column, least: int, most: int, magic: bytes = b"%PDF-", expected: Column | None = None) -> Column:
    """{code, retryable, sha256}: why a body is refused, or its hash. Empty, too small, too large, wrong signature, incomplete."""
    size = F.length(content)
    code = F.when(size.isNull() | (size == 0), "EMPTY").when(size > most, "TOO_LARGE").when(size < least, "TOO_SMALL").when(F.substring(content, 1, len(magic)) != F.lit(magic), "INVALID_SIGNATURE")
    if expected is not None:
        code = code.when(size != expected, "INCOMPLETE")
    return F.struct(code.alias("code"), F.coalesce(code == "INCOMPLETE", F.lit(False)).alias("retryable"), F.when(code.isNull(), F.sha2(content, 256)).alias("sha256"))


def leaked(values: DataFrame, column: str, published: str, least: int = 6) -> DataFrame:
    """Sensitive values that occur in a text to be published: the text travels to the values, of which there may be any number."""
    return values.filter((F.length(column) >= least) & F.lit(published).contains(F.col(column))).select(column).distinct()


#: Rules of the ledgers. The states, phases, classes and resolutions a ledger may name.
STATES = ("pending", "downloaded", "failed", "no_pdf")
PHASES = ("preflight", "discover", "detail", "download")
CLASSES = ("rate_limit", "timeout", "network", "http_permanent", "access", "security", "structural", "invalid_content", "interrupted")
RESOLUTIONS = ("open", "resolved", "abandoned")


def membership_rules() -> dict[str, Column]:
    return {
        "partition_filled": filled("partition_id"),
        "pass_positive": at_least("pass", 1),
        "token_filled": filled("membership_token"),
        "has_alias": filled("document_uuid") | filled("pdf_uuid"),
        "document_uuid_plain": F.col("document_uuid").isNull() | uuid_like("document_uuid"),
        "pdf_uuid_plain": F.col("pdf_uuid").isNull() | uuid_like("pdf_uuid"),
    }


def manifest_rules() -> dict[str, Column]:
    state = F.col("pdf_state")
    return {
        "event_filled": filled("event_id"),
        "document_plain": uuid_like("document_id"),
        "state_known": one_of("pdf_state", STATES),
        "failed_has_failure": (state != "failed") | filled("failure_id"),
        "downloaded_has_hash": (state != "downloaded") | (F.col("sha256_hex").rlike("(?i)^[0-9a-f]{64}$") & filled("relative_path")),
        "downloaded_has_size": (state != "downloaded") | at_least("byte_count", 1),
        "no_pdf_has_reason": (state != "no_pdf") | filled("no_pdf_reason"),
    }


def failure_rules() -> dict[str, Column]:
    return {
        "failure_filled": filled("failure_id"),
        "phase_known": one_of("phase", PHASES),
        "class_known": one_of("classification", CLASSES),
        "resolution_known": one_of("resolution", RESOLUTIONS),
        "attempts_positive": at_least("attempts", 1),
        "page_positive": F.col("page").isNull() | at_least("page", 1),
        "detail_has_document": (F.col("phase") != "detail") | filled("document_id"),
        "resolved_has_time": (F.col("resolution") != "resolved") | F.col("resolved_at").isNotNull(),
    }


def document_rules() -> dict[str, Column]:
    return {
        "document_plain": uuid_like("document_id"),
        "partition_filled": filled("partition_id"),
        "page_positive": at_least("source_page", 1),
        "row_not_negative": at_least("source_row", 0),
        "state_known": one_of("pdf_state", ("pending", "no_pdf")),
        "time_known": F.col("discovered_at").isNotNull(),
    }
