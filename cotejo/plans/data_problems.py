"""Queries of the general data problems (packed fields, orphan references, snapshot changes) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.orphans import Ref, Source, direct_orphans, orphan_cascade, orphan_report
from ..operators.packed import split_packed
from ..operators.snapshots import snapshot_audit, snapshot_changes
from ..runtime import table

PACKED = ("palabras", "norma_di", "pretensiones")
COMPARED = ("title", "resolution_number", "resolution_date", "pdf_state")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(table(spark, d, "list_records"), "record_id", PACKED, at_least=2)


def p3_values(spark: SparkSession, d: str) -> DataFrame:
    """How often each single value occurs over all records and fields."""
    return split_packed(table(spark, d, "list_records"), "record_id", PACKED).groupBy("field_name", "field_value").agg(F.count(F.lit(1)).alias("occurrences"), F.countDistinct("record_id").alias("records"))


def reference_graph(spark: SparkSession, d: str) -> dict[str, Source]:
    """The foreign keys of the ledgers."""
    return {
        "scraped_documents": Source(table(spark, d, "scraped_documents"), "ledger_seq", "discovered_at", key="document_id", gone="withdrawn_at"),
        "failures": Source(table(spark, d, "failures"), "ledger_seq", "occurred_at", key="failure_id", refs=(Ref("document_id", "scraped_documents"),)),
        "download_manifest": Source(table(spark, d, "download_manifest"), "ledger_seq", "occurred_at", key="event_id", refs=(Ref("document_id", "scraped_documents"), Ref("failure_id", "failures"))),
    }


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The first layer of the cascade: the rows whose own reference leads nowhere."""
    return orphan_cascade(reference_graph(spark, d), inherited=False).select("ref_table", "ref_field", F.col("row_id").alias("ledger_seq"))


def p4_direct(spark: SparkSession, d: str) -> DataFrame:
    """The direct orphans with the key that leads nowhere, without the cascade."""
    return direct_orphans(reference_graph(spark, d)).filter("orphan").select("ref_table", "ref_field", "ref_key", F.col("row_id").alias("ledger_seq"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(orphan_cascade(reference_graph(spark, d)))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "replay_rows"), "replay_id", "pass", "identity_id", COMPARED, "row_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d).select("replay_id", "pass", "identity_id", "change_kind")


def p7_audit(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_audit(table(spark, d, "replay_rows"), table(spark, d, "replay_passes"), _changes(spark, d))


QUERIES = {"p3_found": p3_found, "p3_values": p3_values, "p4_found": p4_found, "p4_direct": p4_direct, "p4_report": p4_report, "p7_found": p7_found, "p7_audit": p7_audit}

_KEY = "CASE WHEN length(regexp_replace(lower({0}), '[^0-9a-f]', '', 'g')) >= 32 THEN right(regexp_replace(lower({0}), '[^0-9a-f]', '', 'g'), 32) WHEN trim({0}) <> '' THEN lower(trim({0})) END"
_REFS = f"""WITH docs AS (SELECT {_KEY.format("document_id")} AS k, min(discovered_at) AS b, min(withdrawn_at) AS e FROM scraped_documents GROUP BY 1),
fails AS (SELECT {_KEY.format("failure_id")} AS k, min(occurred_at) AS b FROM failures GROUP BY 1),
refs AS (SELECT 'download_manifest' AS ref_table, 'document_id' AS ref_field, ledger_seq, {_KEY.format("document_id")} AS k, occurred_at AS seen_at, NULL AS own FROM download_manifest
 UNION ALL SELECT 'failures', 'document_id', ledger_seq, {_KEY.format("document_id")}, occurred_at, {_KEY.format("failure_id")} FROM failures
 UNION ALL SELECT 'download_manifest', 'failure_id', ledger_seq, {_KEY.format("failure_id")}, occurred_at, NULL FROM download_manifest),
judged AS (SELECT r.*, CASE WHEN ref_field = 'document_id' THEN d.k IS NULL OR d.b > r.seen_at OR coalesce(d.e <= r.seen_at, false) ELSE f.k IS NULL OR f.b > r.seen_at END AS orphan
 FROM refs r LEFT JOIN docs d ON r.ref_field = 'document_id' AND d.k = r.k LEFT JOIN fails f ON r.ref_field = 'failure_id' AND f.k = r.k WHERE r.k IS NOT NULL)"""
_SNAP = """WITH r AS (SELECT replay_id, pass, upper(trim(identity_id, E' \\t\\r\\n')) AS identity_id, nullif(trim(title, E' \\t\\r\\n'), '') AS t, nullif(trim(resolution_number, E' \\t\\r\\n'), '') AS n, nullif(trim(resolution_date, E' \\t\\r\\n'), '') AS d, nullif(trim(pdf_state, E' \\t\\r\\n'), '') AS s, row_id FROM replay_rows),
one AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY replay_id, pass, identity_id ORDER BY row_id DESC) = 1),
p AS (SELECT replay_id, pass, lag(pass) OVER (PARTITION BY replay_id ORDER BY pass) AS prev FROM (SELECT DISTINCT replay_id, pass FROM replay_rows)),
was AS (SELECT p.pass, o.* EXCLUDE (pass) FROM p JOIN one o ON o.replay_id = p.replay_id AND o.pass = p.prev),
now AS (SELECT o.* FROM one o JOIN p ON p.replay_id = o.replay_id AND p.pass = o.pass AND p.prev IS NOT NULL),
chg AS (SELECT coalesce(n.replay_id, w.replay_id) AS replay_id, coalesce(n.pass, w.pass) AS pass, coalesce(n.identity_id, w.identity_id) AS identity_id,
 CASE WHEN w.identity_id IS NULL THEN 'added' WHEN n.identity_id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
 FROM now n FULL JOIN was w ON n.replay_id = w.replay_id AND n.pass = w.pass AND n.identity_id = w.identity_id
 WHERE w.identity_id IS NULL OR n.identity_id IS NULL OR w.t IS DISTINCT FROM n.t OR w.n IS DISTINCT FROM n.n OR w.d IS DISTINCT FROM n.d OR w.s IS DISTINCT FROM n.s)"""

SQL = {
    "p4_found": f"{_REFS} SELECT ref_table, ref_field, ledger_seq FROM judged WHERE orphan",
    "p4_direct": f"{_REFS} SELECT ref_table, ref_field, k AS ref_key, ledger_seq FROM judged WHERE orphan",
    "p4_report": f"""{_REFS}, bad AS (SELECT DISTINCT own FROM judged WHERE orphan AND own IS NOT NULL),
k AS (SELECT j.*, (NOT orphan AND ref_field = 'failure_id' AND b.own IS NOT NULL) AS inherited FROM judged j LEFT JOIN bad b ON b.own = j.k AND j.ref_field = 'failure_id')
SELECT ref_table, ref_field, strftime(seen_at, '%Y-%m') AS month, count(*) FILTER (orphan) AS direct_orphans, count(*) FILTER (inherited) AS inherited_orphans FROM k WHERE orphan OR inherited GROUP BY 1, 2, 3""",
    "p7_found": f"{_SNAP} SELECT replay_id, pass, identity_id, change_kind FROM chg",
    "p7_audit": f"""{_SNAP}, seen AS (SELECT replay_id, pass, count(*) AS rows_seen, count(DISTINCT identity_id) AS identities_seen FROM r GROUP BY 1, 2),
kinds AS (SELECT replay_id, pass, count(*) FILTER (change_kind = 'added') AS added, count(*) FILTER (change_kind = 'removed') AS removed, count(*) FILTER (change_kind = 'changed') AS changed FROM chg GROUP BY 1, 2),
news AS (SELECT replay_id, pass, identity_id FROM chg WHERE change_kind = 'added' UNION SELECT o.replay_id, o.pass, o.identity_id FROM one o JOIN p ON p.replay_id = o.replay_id AND p.pass = o.pass AND p.prev IS NULL),
said AS (SELECT DISTINCT replay_id, pass, upper(trim(e)) AS identity_id FROM (SELECT replay_id, pass, unnest(expected_new_identities) AS e FROM replay_passes)),
odds AS (SELECT coalesce(n.replay_id, s.replay_id) AS replay_id, coalesce(n.pass, s.pass) AS pass, count(*) FILTER (n.identity_id IS NULL) AS declared_not_seen, count(*) FILTER (s.identity_id IS NULL) AS seen_not_declared
 FROM news n FULL JOIN said s ON n.replay_id = s.replay_id AND n.pass = s.pass AND n.identity_id = s.identity_id GROUP BY 1, 2)
SELECT q.replay_id, q.pass, q.initial_total, q.final_total, coalesce(rows_seen, 0) AS rows_seen, coalesce(identities_seen, 0) AS identities_seen, coalesce(added, 0) AS added, coalesce(removed, 0) AS removed, coalesce(changed, 0) AS changed,
 CASE WHEN expected_new_identities IS NOT NULL THEN coalesce(declared_not_seen, 0) END AS declared_not_seen, CASE WHEN expected_new_identities IS NOT NULL THEN coalesce(seen_not_declared, 0) END AS seen_not_declared, coalesce(identities_seen, 0) = final_total AS final_total_fits
FROM replay_passes q LEFT JOIN seen USING (replay_id, pass) LEFT JOIN kinds USING (replay_id, pass) LEFT JOIN odds USING (replay_id, pass)""",
}
