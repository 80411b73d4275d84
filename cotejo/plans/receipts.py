"""Completeness of a corpus proved or refuted: receipts from an audit file, or from the ledgers of a data folder.

Everything that grows with the corpus is an aggregation or a join; a receipt is put together on the driver from one row per
partition, pass and region. Two kinds of trouble are kept apart: broken invariants raise InvariantError and give no receipt,
missing evidence gives a receipt with status FAIL and its reasons. Null counts mean unknown.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.identity import UUID_PATTERN, composite_identity
from ..functions.text import normalize
from ..operators import components, passes, regions, state
from ..operators.validate import InvariantError, failure_rules, require, uuid_like
from ..runtime import materialize, ship
from ..sources.ledger import discovery_log, exists, read_audit, read_json, read_jsonl, supervisor_log

SHA256, COMMIT = r"[0-9a-f]{64}", r"[0-9a-f]{40}"


def fail_if(rows: DataFrame | int | bool, rule: str) -> None:
    """Raises InvariantError where rows exist."""
    n = rows.limit(1).count() if isinstance(rows, DataFrame) else int(rows)
    if n:
        raise InvariantError({rule: n})


def json_hash(value: Any) -> str:
    """SHA-256 of compact JSON, keys in their order."""
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def check_plan(plan: dict[str, Any]) -> list[dict[str, Any]]:
    """The ordered partitions of a plan whose hashes hold."""
    parts = [{"id": p.get("id"), "kind": p.get("kind"), "search": p.get("search")} for p in plan.get("partitions") or []]
    fail_if(plan.get("schemaVersion") != 1 or not parts or not re.fullmatch(COMMIT, plan.get("commit") or ""), "plan header")
    fail_if(any(not p["id"] or not p["kind"] or not isinstance(p["search"], dict) for p in parts), "plan partition")
    fail_if(len({p["id"] for p in parts}) != len(parts), "plan partition repeated")
    fail_if(any(json_hash(p) != q.get("fingerprint") for p, q in zip(parts, plan["partitions"], strict=True)), "partition fingerprint")
    version = plan.get("corpusPlanVersion")
    fail_if(plan.get("queryHash") != json_hash({"version": version, "partitions": parts}), "plan query hash")
    fail_if(plan.get("fingerprint") != json_hash({"schemaVersion": 1, "version": version, "partitions": parts}), "plan fingerprint")
    return parts


def seal_plan(version: str, commit: str, parts: list[dict[str, Any]]) -> dict[str, Any]:
    """A plan with its hashes."""
    bare = [{"id": p["id"], "kind": p["kind"], "search": p["search"]} for p in parts]
    return {
        "schemaVersion": 1, "corpusPlanVersion": version, "queryHash": json_hash({"version": version, "partitions": bare}), "commit": commit,
        "fingerprint": json_hash({"schemaVersion": 1, "version": version, "partitions": bare}), "partitions": [{**p, "fingerprint": json_hash(p)} for p in bare],
    }


def _region_rows(placed: DataFrame) -> tuple[list[dict[str, Any]], list[dict[str, Any]], int]:
    found = materialize(regions.membership_regions(placed, "root", "partitionId"), "regions")
    rows = [{"partitions": list(r["partitions"]), "documents": r["documents"]} for r in found.collect()]
    pairs = [r.asDict() for r in regions.intersections(found).orderBy("left", "right").collect()]
    return sorted(rows, key=lambda r: "|".join(r["partitions"])), pairs, sum(r["documents"] for r in rows)


def reconcile(spark: SparkSession, path: str) -> dict[str, Any]:
    """The receipt of an audit file: identities resolved by document, file, composite or reviewed hash."""
    ship(spark)
    audit = materialize(read_audit(spark, path), "audit")
    fail_if(audit.filter(~F.coalesce(F.col("type").isin("run", *schemas.AUDIT), F.lit(False))), "event type")
    runs = audit.filter("type = 'run'").select("text").limit(2).collect()
    fail_if(len(runs) != 1, "exactly one run event")
    run = json.loads(runs[0][0])
    total = run.get("publishedGlobalTotal") or {}
    fail_if(run.get("schemaVersion") != 1 or run.get("origin") not in ("captured-metadata", "synthetic-contractual") or not isinstance(run.get("observed"), bool), "run header")
    fail_if(not isinstance(total.get("initial"), int) or not isinstance(total.get("final"), int), "published total")
    fail_if(run.get("commit") is not None and not re.fullmatch(COMMIT, run["commit"]), "run commit")
    kind = lambda t: audit.filter(F.col("type") == t).select("n", F.from_json("text", schemas.AUDIT[t]).alias("e")).select("n", "e.*")

    parts = kind("partition")
    partitions = {r["id"]: r.asDict(recursive=True) for r in parts.collect()}
    fail_if(not partitions or None in partitions or "" in partitions or parts.count() != len(partitions), "partition id")
    fail_if(any(p["classification"] not in schemas.CLASSIFICATIONS for p in partitions.values()), "classification")
    pass_events = materialize(kind("pass"), "passes")
    known = parts.select(F.col("id").alias("partitionId"))
    fail_if(pass_events.join(known, "partitionId", "left_anti"), "pass of an unknown partition")
    fail_if(pass_events.filter(~F.coalesce((F.col("pass") > 0) & (F.col("initialTotal") >= 0) & (F.col("finalTotal") >= 0) & F.col("completed").isNotNull(), F.lit(False))), "pass values")
    fail_if(known.join(passes.contiguity(pass_events, "partitionId"), "partitionId", "left").filter(~F.coalesce("contiguous", F.lit(False))), "passes from 1 without gap")

    ident = lambda c: F.lower(F.col(f"identity.{c}"))
    comp, content = F.col("identity.composite"), F.col("identity.contentHash")
    seen = kind("membership").withColumn("document", ident("documentUuid")).withColumn("pdf", ident("pdfUuid"))
    composite = composite_identity([comp[c] for c in ("expediente", "fecha", "sala", "tipo", "normalizationVersion")])
    print_ = F.when(content.isNotNull(), F.concat_ws("\x1f", F.lower(content["value"]), normalize(content["normalizationVersion"])))
    seen = materialize(seen.withColumn("composite", composite).withColumn("content", print_), "sightings")
    fail_if(seen.isEmpty(), "memberships")
    fail_if(seen.filter(~F.coalesce(F.length("membershipToken") > 0, F.lit(False))), "membership token")
    fail_if(seen.join(pass_events.select("partitionId", "pass"), ["partitionId", "pass"], "left_anti"), "membership of an unknown pass")
    fail_if(seen.filter((F.col("document").isNotNull() & ~uuid_like("document")) | (F.col("pdf").isNotNull() & ~uuid_like("pdf"))), "identifier")
    fail_if(seen.filter((comp.isNotNull() & F.col("composite").isNull()) | (content.isNotNull() & ~F.coalesce((content["algorithm"] == "sha256") & content["value"].rlike(f"(?i)^{SHA256}$"), F.lit(False)))), "composite or hash")
    fail_if(seen.filter(F.coalesce("document", "pdf", "composite", "content").isNull()), "membership without identity")
    key = ["partitionId", "membershipToken"]
    fail_if(seen.groupBy(*key, "pass").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "membership twice in a pass")
    four = F.struct("document", "pdf", "composite", "content")
    members = materialize(seen.groupBy(*key).agg(F.min("n").alias("id"), F.min_by(four, "n").alias("i"), F.countDistinct(F.to_json(four)).alias("c")).select(*key, "id", "i.*", "c"), "members")
    fail_if(members.filter("c > 1"), "identity that contradicts itself")

    review = kind("hashReview").select("n", F.concat_ws("\x1f", F.lower("value"), normalize("normalizationVersion")).alias("content"), "value", "equivalenceClasses", "reviewer", "evidenceRef")
    fail_if(review.filter(~F.coalesce(F.col("value").rlike(f"(?i)^{SHA256}$") & (F.size("equivalenceClasses") > 0) & (F.length("reviewer") > 0) & (F.length("evidenceRef") > 0), F.lit(False))), "hash review")
    fail_if(review.groupBy("content").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "hash review twice")
    named = review.select("content", F.posexplode("equivalenceClasses").alias("k", "c")).select("content", "k", F.explode("c").alias("m")).select("content", "k", "m.*")
    named = materialize(named.join(members.select(*key, "id"), key, "left"), "reviews")
    fail_if(review.join(members, "content", "left_anti"), "hash review without memberships")
    fail_if(named.filter("id is null"), "hash review of an unknown membership")
    fail_if(named.groupBy("content", "id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "hash review that repeats a membership")
    reviewed = review.select("content")
    cover = components.reviewed_members(members.join(reviewed, "content", "left_semi"), "content", "id", named)
    sizes = members.filter("content is not null").groupBy("content").agg(F.count(F.lit(1)).alias("size"))
    fail_if(cover.filter("not covered").join(sizes.filter("size > 1"), "content", "left_semi"), "hash review that does not cover its group")

    first = components.alias_components(members, "id", ["document", "pdf"], shared_namespace=False)
    placed = materialize(members.join(first, "id"), "placed")
    fail_if(components.strong_conflicts(placed, "root", "document"), "different documents linked by one file")
    by_composite = components.resolved_composites(placed, "root", "composite", "id").withColumn("by_composite", F.lit(True))
    classes = named.select("id", F.concat_ws("/", "content", F.col("k").cast("string")).alias("klass")).distinct()
    second = components.alias_components(members.join(classes, "id", "left"), "id", ["document", "pdf", "klass"], shared_namespace=False)
    by_hash = placed.join(reviewed, "content", "left_semi").select("id").withColumn("by_hash", F.lit(True))
    placed = members.join(second, "id").join(by_composite, "id", "left").join(by_hash, "id", "left")
    placed = materialize(placed, "placed")
    fail_if(components.strong_conflicts(placed, "root", "document"), "different documents linked by a review")
    order = [("documentUuid", "document is not null"), ("pdfUuid", "pdf is not null"), ("nonCollidingComposite", "by_composite"), ("reviewedHash", "by_hash")]
    methods = components.resolution_method(placed, "root", order)
    placed = materialize(placed.join(methods, "root").withColumn("ok", F.col("method").isNotNull()), "resolved")

    rollup = {r["partitionId"]: r for r in regions.partition_rollup(placed, "partitionId", "root", "ok").collect()}
    counts = {(r["partitionId"], r["method"]): r["c"] for r in placed.groupBy("partitionId", "method").agg(F.count(F.lit(1)).alias("c")).collect()}
    sightings = seen.select(*key, "pass").join(placed.select(*key, "root", (~F.col("ok")).alias("open")), key)
    fresh = {(r["partitionId"], r["pass"]): r for r in passes.new_per_pass(sightings, "partitionId", ["root"], unresolved="open").collect()}
    held = {(r["partitionId"], r["pass"]): (r["n"], r["u"]) for r in sightings.groupBy("partitionId", "pass").agg(F.count(F.lit(1)).alias("n"), F.count_if("open").alias("u")).collect()}
    outputs, converged_all = [], True
    declared: dict[str, list[Any]] = {}
    for r in pass_events.orderBy("partitionId", "pass").collect():
        declared.setdefault(r["partitionId"], []).append(r)
    for pid in sorted(partitions):
        p, roll = partitions[pid], rollup.get(pid)
        raw, unresolved = (roll["raw"], roll["unresolved"]) if roll else (0, 0)
        rows = []
        for e in declared[pid]:
            n, u = held.get((pid, e["pass"]), (0, 0))
            new = fresh.get((pid, e["pass"]))
            rows.append({"pass": e["pass"], "initialTotal": e["initialTotal"], "finalTotal": e["finalTotal"], "completed": e["completed"], "newIdentities": (new["new_identities"] if new else 0) if not u else None, "unresolvedSightings": u})
        converged = unresolved == 0 and rows[-1]["completed"] and rows[-1]["newIdentities"] == 0
        converged_all &= converged or p["classification"] != "included"
        outputs.append({
            "id": pid, "classification": p["classification"], "queryTotals": {"initial": rows[0]["initialTotal"], "final": rows[-1]["finalTotal"]}, "passes": rows,
            "enumeration": {"rawMemberships": raw, "uniqueDocuments": roll["unique_documents"] if roll else 0, "duplicateOccurrences": roll["duplicates"] if roll else 0, "withResolvedIdentity": raw - unresolved, "unresolvedIdentity": unresolved},
            "identityResolutionCounts": {m: counts.get((pid, m), 0) for m, _ in order} | {"unresolved": unresolved},
            "finalPassMemberships": held.get((pid, rows[-1]["pass"]), (0, 0))[0], "queryTotalException": p["queryTotalException"], "evidence": sorted(p["evidence"] or []),
        })
    included = [o for o in outputs if o["classification"] == "included"]
    raw, unresolved = sum(o["enumeration"]["rawMemberships"] for o in included), sum(o["enumeration"]["unresolvedIdentity"] for o in included)
    region_rows, pairs, unique = ([], [], None) if unresolved else _region_rows(placed.filter(F.col("partitionId").isin([o["id"] for o in included])))
    gap = run.get("notEnumerableWithReason") or {"count": None, "reason": None, "evidenceStatus": "not-demonstrated"}
    shown = gap.get("count") is not None and gap.get("evidenceStatus") == "demonstrated"
    approval = run.get("scopeApproval") or {"status": "pending", "approver": None, "evidence": None}
    unknown = (["duplicateOccurrences", "identity-derived intersections", "publiclyEnumerableCorpus", "uniqueDocuments"] if unresolved else []) + ([] if shown else ["notEnumerableWithReason"])
    checks = [
        (len(included) < len(outputs), "some partitions are not included"),
        (unresolved > 0, f"{unresolved} memberships have no resolved identity"),
        (not converged_all, "not every included partition ended in a complete pass without new identities"),
        *[(o["finalPassMemberships"] != o["queryTotals"]["final"] and not o["queryTotalException"], f"the last pass of {o['id']} does not meet its final total") for o in included],
        (not re.fullmatch(COMMIT, run.get("commit") or ""), "the evidence is not bound to a commit"),
        (approval.get("status") != "approved" or not approval.get("approver") or not approval.get("evidence"), "the scope is not approved"),
        (not shown or not gap.get("reason"), "the difference that cannot be enumerated is not demonstrated"),
        (unique is not None and total["final"] != unique + (gap.get("count") or 0), "the published total is not the enumerable corpus and the explained difference"),
    ]
    reasons = [text for bad, text in checks if bad]
    receipt = {
        "schemaVersion": 2, "origin": run["origin"], "observed": run["observed"], "capturedAt": run.get("capturedAt"), "commit": run.get("commit"), "partitions": outputs, "membershipRegions": region_rows, "intersections": pairs,
        "consistencyStrategy": {"kind": "repeat-until-no-new-identities", "liveConvergenceObserved": converged_all},
        "reconciliation": {
            "rawMemberships": raw, "uniqueDocuments": unique, "duplicateOccurrences": None if unique is None else raw - unique, "withResolvedIdentity": raw - unresolved, "unresolvedIdentity": unresolved,
            "publishedGlobalTotal": {**total, "stable": total["initial"] == total["final"]}, "publiclyEnumerableCorpus": unique, "notEnumerableWithReason": gap, "unknownTerms": sorted(set(unknown)),
        },
        "identityReviewSummary": {"reviewedHashGroups": cover.count()}, "scopeApproval": approval, "privacy": {"identifiersEmitted": False, "sourceRowsEmitted": False}, "status": "FAIL" if reasons else "PASS", "failureReasons": reasons,
    }
    text = json.dumps(receipt, ensure_ascii=False)
    secret = members.select(F.explode(F.array_compact(F.array("membershipToken", "document", "pdf"))).alias("v")).unionByName(seen.select(F.explode(F.array_compact(F.array(comp["expediente"], comp["fecha"], comp["sala"], comp["tipo"], content["value"]))).alias("v")))
    fail_if(secret.filter((F.length("v") >= 6) & F.lit(text).contains(F.col("v"))), "the receipt shows an identifier")
    return receipt


def finalize(spark: SparkSession, folder: str, now: str) -> dict[str, Any]:
    """The receipt of a data folder: plan, run metadata, four ledgers and two logs. Aliases share one namespace."""
    ship(spark)
    at = lambda *p: os.path.join(folder, *p)
    parts = check_plan(plan := read_json(at("corpus-plan.json")))
    meta = read_json(at("run-receipt.json"))
    ids = [p["id"] for p in parts]
    fail_if(meta.get("schemaVersion") != 2 or not re.fullmatch(COMMIT, meta.get("commit") or ""), "run metadata")
    for mine, theirs in (("commit", "commit"), ("corpusPlanVersion", "corpusPlanVersion"), ("queryHash", "queryHash"), ("corpusPlanFingerprint", "fingerprint")):
        fail_if(meta.get(mine) != plan.get(theirs), f"run {mine} against the plan")
    fail_if(meta.get("partitions") != ids, "run partitions against the plan, in order")

    raw = read_jsonl(spark, at("data", "corpus-memberships.jsonl"), schemas.MEMBERSHIP, tolerate_tail=False)
    seen = raw.select("line", "schemaVersion", "type", "partitionId", "pass", F.lower("membershipToken").alias("token"), F.lower("identity.documentUuid").alias("document"), F.lower("identity.pdfUuid").alias("pdf"))
    seen = materialize(seen, "sightings")
    fail_if(seen.isEmpty(), "memberships")
    good = (F.col("schemaVersion") == 1) & (F.col("type") == "membership") & (F.col("pass") > 0) & uuid_like("token") & (F.col("document").isNull() | uuid_like("document")) & (F.col("pdf").isNull() | uuid_like("pdf")) & (F.col("document").isNotNull() | F.col("pdf").isNotNull())
    require(seen, {"membership shape": good, "declared partition": F.col("partitionId").isin(ids)})
    fail_if(passes.order_breaks(seen.withColumn("all", F.lit(1)), "all", "line", "pass").filter("breaks > 0"), "memberships in order of passes")
    key = ["partitionId", "token"]
    fail_if(seen.groupBy(*key, "pass").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "membership twice in a pass")
    known = lambda c: F.when(F.col(c).isNotNull(), F.col("line"))
    members = seen.groupBy(*key).agg(F.min("line").alias("id"), F.min("pass").alias("first"), F.min_by("document", known("document")).alias("document"), F.min_by("pdf", known("pdf")).alias("pdf"), F.countDistinct("document").alias("nd"), F.countDistinct("pdf").alias("np"))
    members = materialize(members, "members")
    fail_if(members.filter("nd > 1 or np > 1"), "a token that changes its aliases")
    placed = materialize(members.join(components.alias_components(members, "id", ["document", "pdf"]), "id"), "placed")
    fail_if(components.strong_conflicts(placed, "root", "document"), "different documents linked by one file")

    docs = read_jsonl(spark, at("data", "documents.jsonl"), schemas.DOCUMENT, tolerate_tail=False).select("schemaVersion", "partitionId", F.lower("documentId").alias("document"))
    docs = materialize(docs, "documents")
    require(docs, {"document shape": (F.col("schemaVersion") == 1) & uuid_like("document"), "declared partition": F.col("partitionId").isin(ids)})
    fail_if(docs.groupBy("document").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "document twice")
    events = read_jsonl(spark, at("data", "download-manifest.jsonl"), schemas.MANIFEST, tolerate_tail=False).select("line", "schemaVersion", F.lower("documentId").alias("document"), "state")
    events = materialize(events, "manifest")
    states = ("pending", "downloaded", "failed", "no_pdf")
    require(events, {"manifest shape": (F.col("schemaVersion") == 1) & uuid_like("document"), "manifest state": F.col("state").isin(*states)})
    fail_if(events.join(docs, "document", "left_anti"), "manifest of an unknown document")
    fail_if(docs.join(events, "document", "left_anti"), "document without state")
    aliases = members.select(F.explode(F.array_compact(F.array("document", "pdf"))).alias("document")).distinct()
    fail_if(docs.join(aliases, "document", "left_anti"), "document without membership")
    current = state.latest_by_key(events, ["document"], ["line"], ["state"])
    by_state = {r["state"]: r["documents"] for r in state.state_counts(current, "state", states).collect()}
    open_details = 0
    if exists(spark, at("data", "failures.jsonl")):
        fails = read_jsonl(spark, at("data", "failures.jsonl"), schemas.FAILURE, tolerate_tail=False)
        renamed = fails.select("line", F.lower("failureId").alias("failure_id"), "phase", "classification", "resolution", "attempts", "page", F.col("documentId").alias("document_id"), F.col("resolvedAt").alias("resolved_at"))
        require(renamed, failure_rules())
        open_details = state.latest_by_key(renamed, ["failure_id"], ["line"], ["phase", "resolution"]).filter("phase = 'detail' and resolution = 'open'").count()

    region_rows, pairs, unique = _region_rows(placed)
    n_docs = docs.count()
    fail_if(unique != n_docs, "the union of memberships is not the documents")
    per = {(r["pass"], r["partitionId"]): r["n"] for r in seen.groupBy("pass", "partitionId").agg(F.count(F.lit(1)).alias("n")).collect()}
    new = {(r["first"], r["partitionId"]): r["n"] for r in members.groupBy("first", "partitionId").agg(F.count(F.lit(1)).alias("n")).collect()}
    done, converged_pass = supervisor_log(spark, at("supervisor.log"))
    complete = {r["pass"]: r for r in done.collect()}
    totals, overall = discovery_log(spark, at("discover.log"))
    logged = {r["partition"]: r for r in totals.collect()}
    whole = overall.first()
    record = complete.get(converged_pass)
    converged = record is not None and record["new_memberships"] == 0 and record["partitions"] == len(ids)
    if converged_pass is not None:
        fail_if(any(not per.get((converged_pass, i)) for i in ids), "a converged pass without every partition")
        fail_if(record is None or sum(n for (p, _), n in new.items() if p == converged_pass) != record["new_memberships"], "declared new memberships against the ledger")
    outputs = []
    for i in sorted(ids):
        told, said = (meta.get("queryTotals") or {}).get(i) or {}, logged.get(i)
        first = told["initial"] if told.get("initial") is not None else (said["initial"] if said else None)
        final = told["final"] if told.get("final") is not None else (said["final"] if said else None)
        mine = sorted(p for p, j in per if j == i)
        n = sum(c for (_, j), c in new.items() if j == i)
        here = sum(r["documents"] for r in region_rows if i in r["partitions"])
        last = (per.get((converged_pass, i), 0) if converged_pass is not None else per[(mine[-1], i)] if mine else 0) or 0
        outputs.append({"id": i, "queryTotals": {"initial": first, "final": final}, "memberships": n, "uniqueDocuments": here, "duplicateOccurrences": n - here, "passes": [{"pass": p, "memberships": per[(p, i)], "newIdentities": new.get((p, i), 0)} for p in mine], "finalPassMemberships": last, "queryTotalReconciled": final is not None and final == last})
    count = sum(o["memberships"] for o in outputs)
    published = meta.get("publishedGlobalTotal") or {"initial": whole["initial"], "final": whole["final"]}
    given = meta.get("notEnumerableWithReason") or {}
    if given.get("evidenceStatus") == "demonstrated" and isinstance(given.get("count"), int) and given.get("reason"):
        gap = given
    elif published.get("final") == unique:
        gap = {"count": 0, "reason": "the enumerable union is the published total", "evidenceStatus": "demonstrated"}
    else:
        gap = {"count": None, "reason": None, "evidenceStatus": "not-demonstrated"}
    explained = published.get("initial") is not None and published.get("final") is not None and gap["count"] is not None and published["final"] == unique + gap["count"]
    approval = meta.get("scopeApproval") or ({"status": "approved", "approver": "corpus-owner", "evidence": "run-receipt.authorizedAt"} if meta.get("authorizedAt") else {"status": "pending", "approver": None, "evidence": None})
    checks = [
        (not converged, "no complete pass converged without new identities"),
        *[(not o["queryTotalReconciled"], f"partition {o['id']} does not meet its total") for o in outputs],
        (approval.get("status") != "approved" or not approval.get("approver") or not approval.get("evidence"), "the scope is not approved"),
        (gap["count"] is None, "the difference that cannot be enumerated is not demonstrated"),
        (not explained, "the published total is not the enumerable union and the demonstrated difference"),
        (open_details > 0, f"{open_details} detail failures are open"),
    ]
    reasons = [text for bad, text in checks if bad]
    receipt = {
        "schemaVersion": 1, "kind": "corpus-final-reconciliation", "generatedAt": now, "commit": meta["commit"], "corpusPlan": {"version": plan["corpusPlanVersion"], "queryHash": plan["queryHash"], "fingerprint": plan["fingerprint"]},
        "inputs": {"membershipRecords": seen.count(), "logicalMemberships": count, "documents": n_docs, "manifestEvents": events.count(), "manifestCurrentStates": {s: by_state[s] for s in states}, "openDetailFailures": open_details},
        "partitions": outputs, "membershipRegions": region_rows, "intersections": pairs,
        "reconciliation": {"rawMemberships": count, "uniqueDocuments": unique, "duplicateOccurrences": count - unique, "regionUnion": unique, "publishedGlobalTotal": published, "notEnumerableWithReason": gap, "equations": {"rawEqualsUniquePlusDuplicates": True, "regionsEqualUniqueDocuments": True, "globalEqualsEnumerablePlusClassifiedDifference": explained}},
        "consistency": {"strategy": "repeat-complete-pass-until-zero-new-memberships", "converged": converged, "convergedPass": converged_pass}, "scopeApproval": approval,
        "privacy": {"aggregatedOnly": True, "identifiersEmitted": False, "sourceRowsEmitted": False, "urlsEmitted": False}, "status": "FAIL" if reasons else "PASS", "failureReasons": reasons,
    }
    fail_if(bool(re.search(UUID_PATTERN.strip("^$").replace("^", "").replace("$", ""), json.dumps(receipt))), "the receipt shows an identifier")
    return receipt
