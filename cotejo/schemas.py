"""Schemas of ledgers and audit events. Files are always read with these, never with inferred ones."""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


S, I, L, B, TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()  # noqa: E741
STRINGS = T.ArrayType(S)
FIELDS = T.MapType(S, STRINGS)
PAIRS = T.ArrayType(_s(("name", S), ("value", S)))
REQUEST = _s(("method", S), ("url", S))
COUNTS = _s(("initial", L), ("final", L))

IDENTITY = _s(("documentUuid", S), ("pdfUuid", S))
MEMBERSHIP = _s(("schemaVersion", I), ("type", S), ("partitionId", S), ("pass", I), ("membershipToken", S), ("identity", IDENTITY), ("observedAt", S))
DOCUMENT = _s(
    ("schemaVersion", I), ("documentId", S), ("partitionId", S), ("sourcePage", I), ("sourceRow", I), ("discoveredAt", S), ("title", S), ("resolutionNumber", S), ("caseNumber", S), ("resolutionDate", S),
    ("metadata", _s(("list", FIELDS), ("detail", FIELDS), ("unknownFields", FIELDS))), ("wordUrl", S), ("pdf", _s(("state", S), ("request", REQUEST), ("reason", S))),
)
MANIFEST = _s(("schemaVersion", I), ("eventId", S), ("documentId", S), ("occurredAt", S), ("state", S), ("request", REQUEST), ("relativePath", S), ("sha256", S), ("bytes", L), ("effectiveUrl", S), ("failureId", S), ("reason", S))
FAILURE = _s(
    ("schemaVersion", I), ("failureId", S), ("phase", S), ("partitionId", S), ("documentId", S), ("request", REQUEST), ("page", I), ("classification", S), ("attempts", I), ("retryable", B), ("message", S),
    ("status", I), ("code", S), ("retryAfterMs", L), ("nextRetryAt", S), ("resolution", S), ("occurredAt", S), ("resolvedAt", S),
)
CHECKPOINT = _s(("schemaVersion", I), ("source", S), ("baseUrl", S), ("queryHash", S), ("partitionId", S), ("page", I), ("confirmedRow", I), ("updatedAt", S))

#: Audit events: one file, five kinds, told apart by ``type``.
AUDIT = {
    "partition": _s(("id", S), ("classification", S), ("queryFingerprint", S), ("evidence", STRINGS), ("queryTotalException", S)),
    "pass": _s(("partitionId", S), ("pass", I), ("initialTotal", L), ("finalTotal", L), ("completed", B)),
    "membership": _s(
        ("partitionId", S), ("pass", I), ("membershipToken", S),
        ("identity", _s(("documentUuid", S), ("pdfUuid", S), ("composite", _s(("expediente", S), ("fecha", S), ("sala", S), ("tipo", S), ("normalizationVersion", S))), ("contentHash", _s(("algorithm", S), ("value", S), ("normalizationVersion", S))))),
    ),
    "hashReview": _s(("value", S), ("normalizationVersion", S), ("equivalenceClasses", T.ArrayType(T.ArrayType(_s(("partitionId", S), ("membershipToken", S))))), ("reviewer", S), ("evidenceRef", S)),
}
CLASSIFICATIONS = ("included", "candidate", "subset", "year-shard")
