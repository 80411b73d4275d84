"""Queries over the ledgers of a corpus: state, coverage, identity, regions, passes, validation and functions. Each has its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, text, web
from ..operators import components, coverage, limits, passes, regions, state, validate
from ..runtime import materialize, table, uuid_key

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def k(c: str) -> str:
    """The SQL of uuid_key()."""
    return f"CASE WHEN length(regexp_replace(lower({c}), '[^0-9a-f]', '', 'g')) >= 32 THEN right(regexp_replace(lower({c}), '[^0-9a-f]', '', 'g'), 32) WHEN trim({c}) <> '' THEN lower(trim({c})) END"


def manifest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "download_manifest").select("ledger_seq", uuid_key("document_id").alias("document"), "pdf_state", uuid_key("failure_id").alias("failure"), "occurred_at")


def failures(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "failures")
    return t.select("ledger_seq", uuid_key("failure_id").alias("failure_id"), uuid_key("document_id").alias("document_id"), *[c for c in t.columns if c not in ("ledger_seq", "failure_id", "document_id")])


def documents(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "scraped_documents")
    return t.select(uuid_key("document_id").alias("document"), *[c for c in t.columns if c != "document_id"])


def memberships(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus_memberships").select("ledger_seq", "partition_id", "pass", uuid_key("membership_token").alias("token"), uuid_key("document_uuid").alias("document"), uuid_key("pdf_uuid").alias("pdf"))


_MAN = f"(SELECT ledger_seq, {k('document_id')} AS document, pdf_state, {k('failure_id')} AS failure, occurred_at FROM download_manifest)"
_FAIL = f"(SELECT * REPLACE ({k('failure_id')} AS failure_id, {k('document_id')} AS document_id) FROM failures)"
_DOC = f"(SELECT * EXCLUDE (document_id), {k('document_id')} AS document FROM scraped_documents)"
_MEM = f"(SELECT ledger_seq, partition_id, pass, {k('membership_token')} AS token, {k('document_uuid')} AS document, {k('pdf_uuid')} AS pdf FROM corpus_memberships)"
_LATEST = f"(SELECT document, arg_max(pdf_state, ledger_seq) AS pdf_state, arg_max(coalesce(failure, ''), ledger_seq) AS failure FROM {_MAN} GROUP BY document)"
_OPEN = f"(SELECT * FROM {_FAIL} QUALIFY row_number() OVER (PARTITION BY failure_id ORDER BY ledger_seq DESC) = 1 AND resolution = 'open')"


# --- state of ledgers -------------------------------------------------------------------------------------------------------


def latest_manifest(spark: SparkSession, d: str) -> DataFrame:
    return state.latest_by_key(manifest(spark, d), ["document"], ["ledger_seq"], ["pdf_state", "failure", "occurred_at"])


@query(f"SELECT document, pdf_state, nullif(failure, '') AS failure FROM {_LATEST}")
def latest_state(spark: SparkSession, d: str) -> DataFrame:
    return latest_manifest(spark, d).select("document", "pdf_state", "failure")


@query(f"SELECT s AS state, count(document) AS documents FROM unnest(['pending', 'downloaded', 'failed', 'no_pdf']) t(s) LEFT JOIN {_LATEST} l ON l.pdf_state = s GROUP BY s")
def state_counts(spark: SparkSession, d: str) -> DataFrame:
    return state.state_counts(latest_manifest(spark, d), "pdf_state", validate.STATES)


@query(f"SELECT DISTINCT document FROM {_MAN}")
def manifest_documents(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).select("document").distinct()


@query(f"SELECT failure_id, phase, document_id, partition_id FROM {_OPEN}")
def open_failures(spark: SparkSession, d: str) -> DataFrame:
    return state.open_failures(failures(spark, d)).select("failure_id", "phase", "document_id", "partition_id")


@query(f"SELECT DISTINCT phase, document_id, failure_id FROM {_OPEN} WHERE document_id IS NOT NULL")
def open_by_document(spark: SparkSession, d: str) -> DataFrame:
    """The open failures of each phase and document, one row each."""
    return state.open_failures(failures(spark, d)).filter("document_id is not null").select("phase", "document_id", "failure_id").distinct()


@query(f"SELECT phase, document_id, min(failure_id) AS canonical_id, count(*) AS failures FROM {_OPEN} WHERE document_id IS NOT NULL GROUP BY ALL")
def logical_pending(spark: SparkSession, d: str) -> DataFrame:
    return state.logical_pending(state.open_failures(failures(spark, d)))


@query(f"WITH o AS {_OPEN} SELECT failure_id, phase, document_id, 'resolved' AS resolution FROM o WHERE document_id IS NOT NULL QUALIFY failure_id <> min(failure_id) OVER (PARTITION BY phase, document_id)")
def resolution_events(spark: SparkSession, d: str) -> DataFrame:
    opened = state.open_failures(failures(spark, d))
    return state.resolution_events(opened, state.logical_pending(opened), F.lit("2026-01-01").cast("timestamp")).drop("resolved_at")


@query(f"SELECT failure_id, phase, document_id, 'resolved' AS resolution FROM {_OPEN} WHERE document_id IN (SELECT document FROM {_DOC})")
def resolved_failures_of_stored(spark: SparkSession, d: str) -> DataFrame:
    """The events that close every open failure of the stored documents."""
    opened = state.open_failures(failures(spark, d))
    stored = coverage.existing_in(opened.select("phase", F.col("document_id").alias("document")), documents(spark, d), ["document"])
    return state.resolve_all(opened, stored.withColumnRenamed("document", "document_id"), F.lit("2026-01-01").cast("timestamp")).drop("resolved_at")


@query(f"SELECT phase, count(*) AS open_failures FROM {_OPEN} GROUP BY phase")
def open_failure_counts(spark: SparkSession, d: str) -> DataFrame:
    return state.open_failures(failures(spark, d)).groupBy("phase").agg(F.count(F.lit(1)).alias("open_failures"))


# --- membership folds -------------------------------------------------------------------------------------------------------


@query(f"""SELECT partition_id, token, min(pass) AS first_pass, max(pass) AS last_pass, arg_min(document, ledger_seq) FILTER (document IS NOT NULL) AS document, arg_min(pdf, ledger_seq) FILTER (pdf IS NOT NULL) AS pdf,
count(DISTINCT document) <= 1 AND count(DISTINCT pdf) <= 1 AS consistent FROM {_MEM} GROUP BY ALL""")
def membership_first_fold(spark: SparkSession, d: str) -> DataFrame:
    """First known alias of each record, and whether its aliases ever contradict."""
    seq = lambda c: F.when(F.col(c).isNotNull(), F.col("ledger_seq"))
    return memberships(spark, d).groupBy("partition_id", "token").agg(
        F.min("pass").alias("first_pass"), F.max("pass").alias("last_pass"), F.min_by("document", seq("document")).alias("document"), F.min_by("pdf", seq("pdf")).alias("pdf"),
        ((F.countDistinct("document") <= 1) & (F.countDistinct("pdf") <= 1)).alias("consistent"),
    )


@query(f"SELECT partition_id, token, string_agg(DISTINCT pass::varchar, ',' ORDER BY pass::varchar) AS passes, arg_max(document, ledger_seq) FILTER (document IS NOT NULL) AS document, arg_max(pdf, ledger_seq) FILTER (pdf IS NOT NULL) AS pdf FROM {_MEM} GROUP BY ALL")
def membership_last_fold(spark: SparkSession, d: str) -> DataFrame:
    """Last known alias of each record and the passes that saw it (a record has few passes)."""
    seq = lambda c: F.when(F.col(c).isNotNull(), F.col("ledger_seq"))
    return memberships(spark, d).groupBy("partition_id", "token").agg(
        F.array_join(F.array_sort(F.collect_set(F.col("pass").cast("string"))), ",").alias("passes"), F.max_by("document", seq("document")).alias("document"), F.max_by("pdf", seq("pdf")).alias("pdf"),
    )


@query(f"SELECT partition_id, pass, count(*) AS sightings, count(DISTINCT token) AS records FROM {_MEM} GROUP BY ALL")
def pass_partition_counts(spark: SparkSession, d: str) -> DataFrame:
    return memberships(spark, d).groupBy("partition_id", "pass").agg(F.count(F.lit(1)).alias("sightings"), F.countDistinct("token").alias("records"))


@query(f"SELECT partition_id, pass, token, count(*) AS n FROM {_MEM} GROUP BY ALL HAVING count(*) > 1")
def redelivered_memberships(spark: SparkSession, d: str) -> DataFrame:
    return memberships(spark, d).groupBy("partition_id", "pass", "token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


# --- identity ----------------------------------------------------------------------------------------------------------------

_RECS = f"(SELECT partition_id, token, min(ledger_seq) AS id, arg_min(document, ledger_seq) FILTER (document IS NOT NULL) AS document, arg_min(pdf, ledger_seq) FILTER (pdf IS NOT NULL) AS pdf FROM {_MEM} GROUP BY ALL)"


def _placed_sql(shared: bool = True) -> str:
    u, w = ("document", "pdf") if shared else ("'d' || document", "'p' || pdf")
    return f"""RECURSIVE recs AS {_RECS}, long AS (SELECT id, unnest([{u}, {w}]) AS u FROM recs), own AS (SELECT id, min(id) OVER (PARTITION BY u) AS o FROM long WHERE u IS NOT NULL),
e AS (SELECT id AS a, o AS b FROM own UNION SELECT o, id FROM own),
c(node, root) USING KEY (node) AS (SELECT id, id FROM recs UNION SELECT e.b, min(c.root) FROM c JOIN e ON e.a = c.node JOIN recurring.c AS o ON o.node = e.b WHERE c.root < o.root GROUP BY e.b),
placed AS (SELECT recs.*, c.root FROM recs JOIN c ON c.node = recs.id)"""


def placed(spark: SparkSession, d: str, shared_namespace: bool = True) -> DataFrame:
    """(id, root, partition_id, token, document, pdf): every record with the group its aliases put it in."""
    seq = lambda c: F.when(F.col(c).isNotNull(), F.col("ledger_seq"))
    recs = materialize(memberships(spark, d).groupBy("partition_id", "token").agg(F.min("ledger_seq").alias("id"), F.min_by("document", seq("document")).alias("document"), F.min_by("pdf", seq("pdf")).alias("pdf")), "records")
    roots = components.alias_components(recs, "id", ["document", "pdf"], shared_namespace)
    return materialize(recs.join(roots, "id"), "placed")


@query(f"WITH {_placed_sql()} SELECT id, root FROM placed")
def alias_components(spark: SparkSession, d: str) -> DataFrame:
    return placed(spark, d).select("id", "root")


@query(f"WITH {_placed_sql(False)} SELECT id, root FROM placed")
def alias_components_by_column(spark: SparkSession, d: str) -> DataFrame:
    """As alias_components, but document and file aliases are never the same thing."""
    return placed(spark, d, shared_namespace=False).select("id", "root")


@query(f"WITH {_placed_sql()} SELECT root, count(DISTINCT document) AS values FROM placed WHERE document IS NOT NULL GROUP BY root HAVING count(DISTINCT document) > 1")
def alias_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return components.strong_conflicts(placed(spark, d), "root", "document")


@query(f"WITH {_placed_sql()} SELECT root, CASE WHEN bool_or(document IS NOT NULL) THEN 'documentUuid' WHEN bool_or(pdf IS NOT NULL) THEN 'pdfUuid' END AS method FROM placed GROUP BY root")
def resolution_methods(spark: SparkSession, d: str) -> DataFrame:
    return components.resolution_method(placed(spark, d), "root", [("documentUuid", "document is not null"), ("pdfUuid", "pdf is not null")])


_COMP = "concat_ws(chr(31), lower(trim(regexp_replace(case_number, '\\s+', ' ', 'g'))), lower(trim(regexp_replace(resolution_date, '\\s+', ' ', 'g'))))"
_COMPOSED = f"(SELECT document, CASE WHEN case_number <> '' AND resolution_date <> '' THEN {_COMP} END AS composite FROM {_DOC} GROUP BY ALL)"


@query(f"WITH x AS {_COMPOSED}, g AS (SELECT composite FROM x WHERE composite IS NOT NULL GROUP BY composite HAVING count(*) = 1 OR count(DISTINCT document) = 1) SELECT document FROM x JOIN g USING (composite)")
def composite_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose case number and date are theirs alone."""
    composed = documents(spark, d).select("document", identity.composite_identity(["case_number", "resolution_date"]).alias("composite")).distinct()
    return components.resolved_composites(composed.withColumn("root", F.col("document")), "root", "composite", "document")


# --- regions and equations ------------------------------------------------------------------------------------------------------


@query(f"WITH {_placed_sql()}, s AS (SELECT root, string_agg(DISTINCT partition_id, '|' ORDER BY partition_id) AS partitions FROM placed GROUP BY root) SELECT partitions, count(*) AS documents FROM s GROUP BY 1")
def membership_regions(spark: SparkSession, d: str) -> DataFrame:
    return regions.membership_regions(placed(spark, d), "root", "partition_id").select(F.array_join("partitions", "|").alias("partitions"), "documents")


@query(f"""WITH {_placed_sql()}, s AS (SELECT DISTINCT root, partition_id AS p FROM placed), n AS (SELECT DISTINCT p FROM s)
SELECT a.p AS left, b.p AS right, count(x.root) AS documents FROM n a JOIN n b ON a.p < b.p LEFT JOIN (SELECT l.root, l.p AS lp, r.p AS rp FROM s l JOIN s r ON l.root = r.root AND l.p < r.p) x ON x.lp = a.p AND x.rp = b.p GROUP BY a.p, b.p""")
def partition_intersections(spark: SparkSession, d: str) -> DataFrame:
    return regions.intersections(regions.membership_regions(placed(spark, d), "root", "partition_id"))


@query(f"""WITH {_placed_sql()}, a AS (SELECT partition_id, count(*) AS raw, count(*) FILTER (document IS NOT NULL OR pdf IS NOT NULL) AS resolved, count(DISTINCT root) FILTER (document IS NOT NULL OR pdf IS NOT NULL) AS u FROM placed GROUP BY 1)
SELECT partition_id, raw, resolved, raw - resolved AS unresolved, CASE WHEN raw = resolved THEN u END AS unique_documents, CASE WHEN raw = resolved THEN raw - u END AS duplicates FROM a""")
def partition_rollup(spark: SparkSession, d: str) -> DataFrame:
    return regions.partition_rollup(placed(spark, d).withColumn("ok", F.col("document").isNotNull() | F.col("pdf").isNotNull()), "partition_id", "root", "ok")


@query(f"WITH {_placed_sql()} SELECT count(*) AS raw, 0::bigint AS unresolved, count(DISTINCT root) AS unique_documents, count(*) - count(DISTINCT root) AS duplicates, 670050 - count(DISTINCT root) AS gap, 670050 - count(DISTINCT root) = 0 AS explained FROM placed")
def count_equations(spark: SparkSession, d: str) -> DataFrame:
    p = placed(spark, d).withColumn("ok", F.lit(True))
    return regions.count_equations(regions.partition_rollup(p, "partition_id", "root", "ok"), regions.membership_regions(p, "root", "partition_id"), 670_050, 0)


@query("WITH g AS (SELECT count(*) AS n FROM scraped_documents GROUP BY case_number, resolution_date) SELECT count(*) AS unique_keys, count(*) FILTER (n > 1) AS duplicate_groups, sum(n - 1)::bigint AS beyond_first, max(n) AS most FROM g")
def collision_statistics(spark: SparkSession, d: str) -> DataFrame:
    return regions.collision_statistics(table(spark, d, "scraped_documents"), ["case_number", "resolution_date"])


# --- passes ------------------------------------------------------------------------------------------------------------------

_NEW = """WITH f AS (SELECT partition_id, {0} AS x, min(pass) AS pass FROM {1} GROUP BY ALL), n AS (SELECT partition_id, pass, count(*) AS n FROM f GROUP BY ALL), s AS (SELECT partition_id, pass, count(DISTINCT {0}) AS seen FROM {1} GROUP BY ALL),
per AS (SELECT partition_id, pass, seen, coalesce(n, 0) AS new_identities FROM s LEFT JOIN n USING (partition_id, pass))"""


@query(f"{_NEW.format('token', _MEM)} SELECT * FROM per")
def new_per_pass(spark: SparkSession, d: str) -> DataFrame:
    return passes.new_per_pass(memberships(spark, d), "partition_id", ["token"])


@query(f"{_NEW.format('token', _MEM)} SELECT partition_id, count(*) AS passes, max(pass) AS last_pass, arg_max(new_identities = 0, pass) AS converged FROM per GROUP BY 1")
def convergence(spark: SparkSession, d: str) -> DataFrame:
    return passes.convergence(passes.new_per_pass(memberships(spark, d), "partition_id", ["token"]), "partition_id")


@query(f"""WITH {_placed_sql()}, s AS (SELECT m.partition_id, m.pass, p.root FROM {_MEM} m JOIN placed p ON p.partition_id = m.partition_id AND p.token = m.token), f AS (SELECT partition_id, root, min(pass) AS pass FROM s GROUP BY ALL),
n AS (SELECT partition_id, pass, count(*) AS n FROM f GROUP BY ALL), q AS (SELECT partition_id, pass, count(DISTINCT root) AS seen FROM s GROUP BY ALL) SELECT partition_id, pass, seen, coalesce(n, 0) AS new_identities FROM q LEFT JOIN n USING (partition_id, pass)""")
def new_groups_per_pass(spark: SparkSession, d: str) -> DataFrame:
    seen = memberships(spark, d).join(placed(spark, d).select("partition_id", "token", "root"), ["partition_id", "token"])
    return passes.new_per_pass(seen, "partition_id", ["root"])


@query("SELECT replay_id, min(pass) = 1 AND max(pass) = count(DISTINCT pass) AND count(pass) = count(DISTINCT pass) AS contiguous FROM replay_passes GROUP BY 1")
def contiguity(spark: SparkSession, d: str) -> DataFrame:
    return passes.contiguity(table(spark, d, "replay_passes"), "replay_id")


@query("WITH x AS (SELECT partition_id, lag(pass) OVER (PARTITION BY partition_id ORDER BY ledger_seq) > pass AS b FROM corpus_memberships) SELECT partition_id, count(*) FILTER (b) AS breaks FROM x GROUP BY 1")
def order_breaks(spark: SparkSession, d: str) -> DataFrame:
    return passes.order_breaks(table(spark, d, "corpus_memberships"), "partition_id", "ledger_seq", "pass")


@query("SELECT replay_id, arg_min(coalesce(final_total, -1), pass) AS first_value, arg_max(coalesce(final_total, -1), pass) AS last_value, arg_min(coalesce(final_total, -1), pass) <> arg_max(coalesce(final_total, -1), pass) AS drifted FROM replay_passes GROUP BY 1")
def drift(spark: SparkSession, d: str) -> DataFrame:
    return passes.drift(table(spark, d, "replay_passes").select("replay_id", "pass", F.coalesce("final_total", F.lit(-1)).alias("total")), ["replay_id"], "pass", "total")


_PAGES = "(SELECT replay_id, pass, page, sha256(to_json(list(identity_id ORDER BY page_pos, identity_id))::varchar) AS fingerprint, count(*) AS rows FROM replay_rows GROUP BY ALL)"


def pages(spark: SparkSession, d: str) -> DataFrame:
    return identity.page_fingerprints(table(spark, d, "replay_rows"), ["replay_id", "pass", "page"], "page_pos", ["identity_id"])


@query(f"SELECT * FROM {_PAGES}")
def page_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d)


@query(f"SELECT replay_id, fingerprint, count(*) AS pages FROM {_PAGES} GROUP BY ALL HAVING count(*) > 1")
def repeated_pages(spark: SparkSession, d: str) -> DataFrame:
    return passes.repeated_pages(pages(spark, d), ["replay_id"])


@query(f"SELECT replay_id, pass, page FROM {_PAGES} QUALIFY fingerprint = lag(fingerprint) OVER (PARTITION BY replay_id, page ORDER BY pass)")
def unchanged_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that a pass delivered exactly as the pass before."""
    return passes.silent_repeats(pages(spark, d), ["replay_id", "page"], "pass").select("replay_id", "pass", "page")


@query(f"SELECT document, arg_min(partition_id, ledger_seq) AS partition_id, arg_min(source_page, ledger_seq) AS source_page, count(*) AS occurrences FROM {_DOC} GROUP BY document")
def first_rows(spark: SparkSession, d: str) -> DataFrame:
    return passes.first_rows(documents(spark, d).select("document", "ledger_seq", "partition_id", "source_page"), ["document"], ["ledger_seq"]).drop("ledger_seq")


@query("WITH x AS (SELECT replay_id, page, upper(trim(identity_id)) AS i FROM replay_rows), f AS (SELECT DISTINCT replay_id, page FROM (SELECT replay_id, i, min(page) AS page FROM x GROUP BY ALL)) SELECT DISTINCT replay_id, page FROM x ANTI JOIN f USING (replay_id, page)")
def stalled_pages(spark: SparkSession, d: str) -> DataFrame:
    return passes.stalled_pages(table(spark, d, "replay_rows").withColumn("identity_id", F.upper(F.trim("identity_id"))), "replay_id", "page", "identity_id")


@query("""WITH x AS (SELECT replay_id, pass, upper(trim(identity_id)) AS i FROM replay_rows), f AS (SELECT replay_id, i, min(pass) AS pass FROM x GROUP BY ALL), v AS (SELECT replay_id, min(pass) AS v FROM x GROUP BY 1),
q AS (SELECT DISTINCT replay_id, pass FROM x ANTI JOIN (SELECT DISTINCT replay_id, pass FROM f) USING (replay_id, pass)), qq AS (SELECT replay_id, min(pass) AS converged_after FROM q GROUP BY 1)
SELECT f.replay_id, any_value(converged_after) AS converged_after, count(*) FILTER (f.pass > v) AS missed_by_first FROM f JOIN v USING (replay_id) LEFT JOIN qq USING (replay_id) GROUP BY f.replay_id""")
def replay_convergence(spark: SparkSession, d: str) -> DataFrame:
    return passes.replay_convergence(table(spark, d, "replay_rows").withColumn("identity_id", F.upper(F.trim("identity_id"))), "replay_id", "pass", "identity_id")


# --- coverage and joins ------------------------------------------------------------------------------------------------------

_DOCS1 = f"(SELECT document, any_value(pdf_state) AS announced FROM {_DOC} GROUP BY document)"


def announced(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).groupBy("document").agg(F.first("pdf_state").alias("announced"))


@query(f"""SELECT coalesce(x.document, l.document) AS document, CASE WHEN x.document IS NULL THEN 'unknown' WHEN l.document IS NULL THEN 'missing' WHEN coalesce((announced = 'no_pdf') <> (pdf_state = 'no_pdf'), false) THEN 'contradiction' ELSE 'ok' END AS verdict
FROM {_DOCS1} x FULL JOIN {_LATEST} l ON x.document = l.document""")
def download_coverage(spark: SparkSession, d: str) -> DataFrame:
    clash = (F.col("announced") == "no_pdf") != (F.col("pdf_state") == "no_pdf")
    return coverage.coverage(announced(spark, d), latest_manifest(spark, d).select("document", "pdf_state"), "document", clash)


@query(f"SELECT DISTINCT document FROM {_DOC} ANTI JOIN {_MAN} USING (document)")
def documents_without_state(spark: SparkSession, d: str) -> DataFrame:
    return coverage.missing_from(documents(spark, d).select("document").distinct(), manifest(spark, d), ["document"])


@query(f"SELECT l.document FROM {_LATEST} l WHERE pdf_state = 'failed' AND failure IN (SELECT failure_id FROM {_OPEN})")
def failed_with_open_failure(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose current event failed by a failure that is still open."""
    failed = latest_manifest(spark, d).filter("pdf_state = 'failed'").select("document", F.col("failure").alias("failure_id"))
    return coverage.existing_in(failed, state.open_failures(failures(spark, d)), ["failure_id"]).select("document")


@query(f"SELECT failure_id FROM {_OPEN} o WHERE document_id IN (SELECT document FROM {_DOC})")
def open_failures_of_stored(spark: SparkSession, d: str) -> DataFrame:
    opened = state.open_failures(failures(spark, d)).select("failure_id", F.col("document_id").alias("document"))
    return coverage.existing_in(opened, documents(spark, d), ["document"]).select("failure_id")


@query(f"""WITH r AS (SELECT ledger_seq, unnest([document, pdf]) AS u FROM {_MEM}) SELECT ledger_seq, count(DISTINCT x.document) AS matches, min(x.document) AS document FROM (SELECT DISTINCT * FROM r WHERE u IS NOT NULL) r JOIN (SELECT DISTINCT document FROM {_DOC}) x ON x.document = r.u GROUP BY ledger_seq""")
def sightings_of_stored(spark: SparkSession, d: str) -> DataFrame:
    stored = documents(spark, d).select("document", F.col("document").alias("alias"))
    return coverage.alias_lookup(memberships(spark, d), stored.distinct(), "ledger_seq", ["document", "pdf"], "document", ["alias"])


_GAPS = [("manifest", ["document"], "documents", ["document"]), ("failures", ["document"], "documents", ["document"]), ("documents", ["document"], "memberships", ["document"]), ("replay_rows", ["replay_id", "pass"], "replay_passes", ["replay_id", "pass"])]


@query(f"""SELECT 'manifest(document)->documents' AS link, count(*) AS rows_without FROM {_MAN} m ANTI JOIN {_DOC} x USING (document)
UNION ALL SELECT 'failures(document)->documents', count(*) FROM (SELECT document_id AS document FROM {_FAIL}) f ANTI JOIN {_DOC} x USING (document)
UNION ALL SELECT 'documents(document)->memberships', count(*) FROM {_DOC} x ANTI JOIN {_MEM} m USING (document)
UNION ALL SELECT 'replay_rows(replay_id,pass)->replay_passes', count(*) FROM replay_rows ANTI JOIN replay_passes USING (replay_id, pass)""")
def foreign_key_gaps(spark: SparkSession, d: str) -> DataFrame:
    tables = {"manifest": manifest(spark, d), "failures": failures(spark, d).withColumnRenamed("document_id", "document"), "documents": documents(spark, d), "memberships": memberships(spark, d), "replay_rows": table(spark, d, "replay_rows"), "replay_passes": table(spark, d, "replay_passes")}
    return coverage.foreign_key_gaps(tables, _GAPS)


@query(f"SELECT partition_id, count(*) AS rows, count(DISTINCT document) AS documents FROM {_DOC} GROUP BY partition_id")
def documents_per_partition(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("document").alias("documents"))


@query("SELECT phase, count(*) FILTER (http_status = 429 AND next_retry_at IS NULL) AS rate_limited, count(*) AS attempts_logged FROM failures GROUP BY phase")
def rate_limited_attempts(spark: SparkSession, d: str) -> DataFrame:
    """Answers 429 per phase; rows that only record a delay before the next try are no answers of their own."""
    return table(spark, d, "failures").groupBy("phase").agg(F.count_if((F.col("http_status") == 429) & F.col("next_retry_at").isNull()).alias("rate_limited"), F.count(F.lit(1)).alias("attempts_logged"))


_TOTALS = "(SELECT partition_id, sum(final_total)::bigint AS total FROM replay_passes WHERE pass = 1 GROUP BY partition_id)"


@query(f"SELECT partition_id, total, NULL::bigint AS gap FROM {_TOTALS} UNION ALL SELECT NULL, sum(total)::bigint, (670050 - sum(total))::bigint FROM {_TOTALS}")
def partition_gaps(spark: SparkSession, d: str) -> DataFrame:
    totals = table(spark, d, "replay_passes").filter("pass = 1").groupBy("partition_id").agg(F.sum("final_total").alias("total"))
    return regions.partition_gap(totals, "partition_id", "total", 670_050)


_SOURCES = f"(SELECT {k('native_id')} AS document, arg_min(partition_id, record_id) AS p, arg_min(page, record_id) AS n, arg_min(record_index, record_id) AS i FROM list_records GROUP BY 1)"


@query(f"""WITH j AS (SELECT d.*, s.document AS src, p, n, i FROM (SELECT DISTINCT document, partition_id, source_page, source_row FROM {_DOC}) d LEFT JOIN {_SOURCES} s USING (document))
SELECT document, unnest(list_filter([CASE WHEN src IS NULL THEN 'document' END, CASE WHEN src IS NOT NULL AND partition_id IS DISTINCT FROM p THEN 'partition_id' END, CASE WHEN src IS NOT NULL AND source_page IS DISTINCT FROM n THEN 'source_page' END, CASE WHEN src IS NOT NULL AND source_row IS DISTINCT FROM i THEN 'source_row' END], lambda x: x IS NOT NULL)) AS broken FROM j""")
def provenance_breaks(spark: SparkSession, d: str) -> DataFrame:
    """What stored documents and the list rows they were read from do not agree in."""
    first = lambda c: F.min_by(c, "record_id")
    sources = table(spark, d, "list_records").groupBy(uuid_key("native_id").alias("document")).agg(first("partition_id").alias("partition_id"), first("page").alias("source_page"), first("record_index").alias("source_row"))
    stored = documents(spark, d).select("document", "partition_id", "source_page", "source_row").distinct()
    return coverage.provenance_breaks(stored, sources, "document", ["partition_id", "source_page", "source_row"])


_STORED = f"(SELECT {k('document_id')} AS path, arg_min(encode(text), doc_id) AS content FROM documents GROUP BY 1)"


@query(f"""WITH e AS (SELECT ledger_seq AS document, {k('document_id')} AS path, byte_count AS bytes, sha256_hex AS sha FROM download_manifest WHERE pdf_state = 'downloaded'),
j AS (SELECT e.*, octet_length(content) AS size, content, f.path IS NOT NULL AS there FROM e LEFT JOIN {_STORED} f USING (path))
SELECT document, CASE WHEN NOT there THEN 'missing' WHEN size IS DISTINCT FROM bytes THEN 'size' WHEN size < 300 THEN 'too_small' WHEN sha256(content) IS DISTINCT FROM lower(sha) THEN 'hash' ELSE 'ok' END AS verdict FROM j""")
def file_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Downloaded files held against contents: a document's first text stands in for its file."""
    events = table(spark, d, "download_manifest").filter("pdf_state = 'downloaded'").select(F.col("ledger_seq").alias("document"), uuid_key("document_id").alias("path"), F.col("byte_count").alias("bytes"), F.col("sha256_hex").alias("sha256"))
    texts = table(spark, d, "documents").groupBy(uuid_key("document_id").alias("path")).agg(F.min_by("text", "doc_id").alias("text"))
    return coverage.file_verdicts(events, texts.select("path", F.encode("text", "UTF-8").alias("content")), 300, b"")


# --- validation --------------------------------------------------------------------------------------------------------------


def _rule_sql(name: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) FILTER (NOT coalesce({c}, false)) AS rows FROM {name}" for r, c in rules.items())


_U = "regexp_matches({0}, '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$')"


@query(_rule_sql("corpus_memberships", {"partition_filled": "length(trim(partition_id)) > 0", "pass_positive": "pass >= 1", "token_filled": "length(trim(membership_token)) > 0", "has_alias": "coalesce(length(trim(document_uuid)) > 0, false) OR coalesce(length(trim(pdf_uuid)) > 0, false)", "document_uuid_plain": f"document_uuid IS NULL OR {_U.format('document_uuid')}", "pdf_uuid_plain": f"pdf_uuid IS NULL OR {_U.format('pdf_uuid')}"}))
def membership_violations(spark: SparkSession, d: str) -> DataFrame:
    return validate.violations(table(spark, d, "corpus_memberships"), validate.membership_rules())


@query(_rule_sql("download_manifest", {"event_filled": "length(trim(event_id)) > 0", "document_plain": _U.format("document_id"), "state_known": "pdf_state IN ('pending', 'downloaded', 'failed', 'no_pdf')", "failed_has_failure": "pdf_state <> 'failed' OR coalesce(length(trim(failure_id)) > 0, false)", "downloaded_has_hash": "pdf_state <> 'downloaded' OR (regexp_matches(sha256_hex, '^[0-9a-fA-F]{64}$') AND coalesce(length(trim(relative_path)) > 0, false))", "downloaded_has_size": "pdf_state <> 'downloaded' OR coalesce(byte_count >= 1, false)", "no_pdf_has_reason": "pdf_state <> 'no_pdf' OR coalesce(length(trim(no_pdf_reason)) > 0, false)"}))
def manifest_violations(spark: SparkSession, d: str) -> DataFrame:
    return validate.violations(table(spark, d, "download_manifest"), validate.manifest_rules())


@query(_rule_sql("failures", {"failure_filled": "length(trim(failure_id)) > 0", "phase_known": "phase IN ('preflight', 'discover', 'detail', 'download')", "class_known": "classification IN ('rate_limit', 'timeout', 'network', 'http_permanent', 'access', 'security', 'structural', 'invalid_content', 'interrupted')", "resolution_known": "resolution IN ('open', 'resolved', 'abandoned')", "attempts_positive": "attempts >= 1", "page_positive": "page IS NULL OR page >= 1", "detail_has_document": "phase <> 'detail' OR coalesce(length(trim(document_id)) > 0, false)", "resolved_has_time": "resolution <> 'resolved' OR resolved_at IS NOT NULL"}))
def failure_violations(spark: SparkSession, d: str) -> DataFrame:
    return validate.violations(table(spark, d, "failures"), validate.failure_rules())


@query(_rule_sql("scraped_documents", {"document_plain": _U.format("document_id"), "partition_filled": "length(trim(partition_id)) > 0", "page_positive": "source_page >= 1", "row_not_negative": "source_row >= 0", "state_known": "pdf_state IN ('pending', 'no_pdf')", "time_known": "discovered_at IS NOT NULL"}))
def document_violations(spark: SparkSession, d: str) -> DataFrame:
    return validate.violations(table(spark, d, "scraped_documents"), validate.document_rules())


@query("SELECT doc_id, CASE WHEN text IS NULL OR octet_length(encode(text)) = 0 THEN 'EMPTY' WHEN octet_length(encode(text)) > 20000 THEN 'TOO_LARGE' WHEN octet_length(encode(text)) < 300 THEN 'TOO_SMALL' WHEN text[:5] <> 'Causa' THEN 'INVALID_SIGNATURE' END AS code, CASE WHEN octet_length(encode(text)) BETWEEN 300 AND 20000 AND text[:5] = 'Causa' THEN sha256(text) END AS sha256 FROM documents")
def content_verdicts(spark: SparkSession, d: str) -> DataFrame:
    verdict = validate.content_verdict(F.encode("text", "UTF-8"), 300, 20_000, b"Causa")
    return table(spark, d, "documents").select("doc_id", verdict.alias("v")).select("doc_id", "v.code", "v.sha256")


PUBLISHED = '{"receipt": "partitions supreme, superior; last case 00417-2016-0-9907"}'


@query(f"SELECT DISTINCT case_number FROM scraped_documents WHERE length(case_number) >= 6 AND contains('{PUBLISHED}', case_number)")
def leaked_values(spark: SparkSession, d: str) -> DataFrame:
    return validate.leaked(table(spark, d, "scraped_documents"), "case_number", PUBLISHED)


# --- functions ---------------------------------------------------------------------------------------------------------------


@query("SELECT record_id, trim(regexp_replace(sala, '[\\s\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}\\x{0085}]+', ' ', 'g'), ' ') AS clean_sala FROM list_records")
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "list_records").select("record_id", text.clean("sala").alias("clean_sala"))


@query("SELECT record_id, lower(trim(regexp_replace(nfc_normalize(sumilla), '[\\s\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}\\x{0085}]+', ' ', 'g'), ' ')) AS normal FROM list_records")
def normalized_summaries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "list_records").select("record_id", text.normalize("sumilla").alias("normal"))


@query("SELECT ledger_seq, regexp_replace('Bearer ' || failure_id || ' ' || message || '?token=' || failure_id, '(Bearer|Basic)\\s+[A-Za-z0-9._~+/=-]+', '\\1 [REDACTED]', 'gi').regexp_replace('([?&](?:access_?token|token|javax\\.faces\\.ViewState)=)[^&\\s]+', '\\1[REDACTED]', 'gi') AS safe FROM failures")
def redacted_messages(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("Bearer "), "failure_id", F.lit(" "), "message", F.lit("?token="), "failure_id")
    return table(spark, d, "failures").select("ledger_seq", text.redact(raw).alias("safe"))


@query("SELECT ledger_seq, least(120000.0, 2000.0 * pow(2, greatest(0, attempts - 1)))::bigint AS cap_ms, CASE WHEN http_status = 429 THEN 'rate_limit' WHEN http_status = 403 THEN 'access' WHEN http_status IN (408, 425, 500, 502, 503, 504) THEN 'http_transient' WHEN http_status >= 400 THEN 'http_permanent' END AS status_class FROM failures")
def retry_timing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "failures").select("ledger_seq", web.backoff_cap_ms("attempts", 2000, 120_000).alias("cap_ms"), web.classify_status("http_status").alias("status_class"))


@query(f"SELECT ledger_seq, lower(document_id) AS uuid, {_U.format('document_id')} AS safe FROM download_manifest WHERE {_U.format('document_id')}")
def request_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "download_manifest").filter(validate.uuid_like("document_id"))
    url = F.concat(F.lit("https://court.example/files/get?uuid="), "document_id")
    return rows.select("ledger_seq", web.url_uuid(url).alias("uuid"), web.safe_request(url, "https://court.example", "/files/get").alias("safe"))


@query("SELECT ledger_seq, 'page=' || source_page || '&row=' || source_row || '&page=0&view=ok' AS body FROM scraped_documents")
def form_bodies(spark: SparkSession, d: str) -> DataFrame:
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    pairs = F.array(pair("page", F.col("source_page")), pair("row", F.col("source_row")), pair("page", F.lit(0)))
    return table(spark, d, "scraped_documents").select("ledger_seq", web.encode_pairs(web.set_control(pairs, "view", "ok")).alias("body"))


@query("SELECT ledger_seq, sha256('{\"document_id\":\"' || document_id || '\",\"partition_id\":\"' || partition_id || '\",\"source_page\":' || source_page || '}') AS fingerprint FROM scraped_documents")
def row_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "scraped_documents").select("ledger_seq", identity.json_hash(F.struct("document_id", "partition_id", "source_page")).alias("fingerprint"))


@query("SELECT record_id, nullif(recurso, '') AS title, nullif(nroexp, '') AS case_number, nullif(tipo_resolucion, '') AS resolution_type, nullif(sumilla, '') AS summary FROM list_records")
def renamed_fields(spark: SparkSession, d: str) -> DataFrame:
    cols = {"recurso": "recurso", "nroexp": "nroexp", "tipoResolucion": "tipo_resolucion", "fechaResolucion": "fecha_resolucion", "sumilla": "sumilla"}
    fields = F.map_from_entries(F.array(*[F.struct(F.lit(n).alias("key"), F.array(F.col(c)).alias("value")) for n, c in cols.items()]))
    m = identity.renamed_fields(fields)
    return table(spark, d, "list_records").select("record_id", m.alias("m")).select("record_id", *[F.try_element_at("m", F.lit(a)).alias(b) for a, b in (("title", "title"), ("caseNumber", "case_number"), ("resolutionType", "resolution_type"), ("summary", "summary"))])


@query("SELECT partition_id, case_number, count(*) AS n FROM scraped_documents GROUP BY ALL ORDER BY n DESC, case_number, partition_id LIMIT 20")
def largest_cases(spark: SparkSession, d: str) -> DataFrame:
    """Top-k report: the cases with the most stored documents."""
    per = table(spark, d, "scraped_documents").groupBy("partition_id", "case_number").agg(F.count(F.lit(1)).alias("n"))
    return limits.top_then(per, 20, [F.desc("n"), "case_number", "partition_id"], ["partition_id", "case_number"])


@query("SELECT ledger_seq, source_page, source_row FROM scraped_documents WHERE (source_page, source_row) >= (100, 5)")
def resumed_rows(spark: SparkSession, d: str) -> DataFrame:
    return limits.resume_from(table(spark, d, "scraped_documents"), "source_page", "source_row", (100, 5)).select("ledger_seq", "source_page", "source_row")


@query("""SELECT ledger_seq, CASE WHEN http_status = 500 AND message = '' THEN 'session_invalid' WHEN http_status = 429 THEN 'rate_limit' WHEN http_status = 403 THEN 'access' WHEN http_status IN (408, 425, 500, 502, 503, 504) THEN 'http_transient' WHEN http_status >= 400 THEN 'http_permanent' END AS kind,
coalesce(http_status IN (429, 408, 425, 500, 502, 503, 504) OR (http_status = 403 AND phase <> 'preflight' AND attempts = 1), false) AS retry, coalesce((http_status = 500 AND message = '') OR (http_status = 403 AND phase <> 'preflight' AND attempts = 1), false) AS restart FROM failures""")
def status_verdicts(spark: SparkSession, d: str) -> DataFrame:
    verdict = web.status_verdict("http_status", "attempts", F.col("phase") == "preflight", F.col("message") == "")
    return table(spark, d, "failures").select("ledger_seq", verdict.alias("v")).select("ledger_seq", F.col("v.class").alias("kind"), F.col("v.retryable").alias("retry"), "v.restart")


# --- sets --------------------------------------------------------------------------------------------------------------------


@query(f"SELECT document FROM {_DOC} INTERSECT SELECT document FROM {_MAN}")
def documents_on_both_sides(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("document").intersect(manifest(spark, d).select("document"))


@query(f"SELECT document FROM {_MAN} EXCEPT SELECT document FROM {_DOC}")
def manifest_only_documents(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).select("document").subtract(documents(spark, d).select("document"))


@query(f"SELECT document, source FROM (SELECT document, 'documents' AS source FROM {_DOC} UNION SELECT document, 'manifest' FROM {_MAN})")
def all_known_documents(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("document", F.lit("documents").alias("source")).unionByName(manifest(spark, d).select("document", F.lit("manifest").alias("source"))).distinct()


# --- native Spark, not in the reference ------------------------------------------------------------------------------------------


@query("SELECT o_orderpriority, l_returnflag, count(*) AS lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY CUBE (o_orderpriority, l_returnflag)")
def native_revenue_cube(spark: SparkSession, d: str) -> DataFrame:
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    joined = lines.select("l_orderkey", "l_returnflag", "l_extendedprice", "l_discount").join(orders.select("o_orderkey", "o_orderpriority"), lines["l_orderkey"] == orders["o_orderkey"])
    return joined.cube("o_orderpriority", "l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT user_id, arg_max(event_type, event_id) AS last_type, count(*) AS events FROM events GROUP BY user_id")
def native_last_event(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last_type"), F.count(F.lit(1)).alias("events"))


@query("SELECT c_mktsegment, n_name, count(*) AS customers, count(o_orderkey) AS orders FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT o_custkey, any_value(o_orderkey) AS o_orderkey FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY ALL")
def native_customers_with_orders(spark: SparkSession, d: str) -> DataFrame:
    c, n, o = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "orders")
    some = o.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("o", F.lit(1))
    return c.select("c_custkey", "c_nationkey", "c_mktsegment").join(n.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey").join(some, "c_custkey", "left").groupBy("c_mktsegment", "n_name").agg(F.count(F.lit(1)).alias("customers"), F.count("o").alias("orders"))
