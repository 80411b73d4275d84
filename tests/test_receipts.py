import copy
import json

import pytest

from cotejo.operators.validate import InvariantError
from cotejo.plans.receipts import check_plan, finalize, reconcile, seal_plan
from cotejo.sources.sinks import write_receipt

C = "a" * 40
H = "b" * 64


def u(n):
    return f"00000000-0000-4000-8000-{n:012d}"


def events():
    """Three partitions; one ruling in all, two in two, and one each in one partition alone."""
    comp = {"composite": {"expediente": "EXP-C", "fecha": "2000-01-03", "sala": "SALA-C", "tipo": "TIPO-C", "normalizationVersion": "v1"}}
    file_hash = {"contentHash": {"algorithm": "sha256", "value": H, "normalizationVersion": "v1"}}
    held = {
        "P1": {"TOK-P1-A": {"documentUuid": u(1), "pdfUuid": u(91)}, "TOK-P1-B": {"pdfUuid": u(92)}, "TOK-P1-C": comp, "TOK-P1-D": file_hash},
        "P2": {"TOK-P2-A": {"pdfUuid": u(91)}, "TOK-P2-B": {"pdfUuid": u(92)}, "TOK-P2-D": file_hash},
        "P3": {"TOK-P3-A": {"documentUuid": u(1)}, "TOK-P3-E": {"documentUuid": u(5)}},
    }
    out = [{"type": "run", "schemaVersion": 1, "origin": "synthetic-contractual", "observed": False, "capturedAt": "2026-01-01T00:00:00Z", "commit": C, "publishedGlobalTotal": {"initial": 5, "final": 5}, "notEnumerableWithReason": {"count": 0, "reason": "none", "evidenceStatus": "demonstrated"}, "scopeApproval": {"status": "approved", "approver": "x", "evidence": "y"}}]
    for p, members in held.items():
        out.append({"type": "partition", "id": p, "classification": "included", "evidence": [p]})
        for n in (1, 2):
            out.append({"type": "pass", "partitionId": p, "pass": n, "initialTotal": len(members), "finalTotal": len(members), "completed": True})
            out += [{"type": "membership", "partitionId": p, "pass": n, "membershipToken": t, "identity": i} for t, i in members.items()]
    out.append({"type": "hashReview", "value": H, "normalizationVersion": "v1", "equivalenceClasses": [[{"partitionId": "P1", "membershipToken": "TOK-P1-D"}, {"partitionId": "P2", "membershipToken": "TOK-P2-D"}]], "reviewer": "r", "evidenceRef": "e"})
    return out


@pytest.fixture
def audit(spark, tmp_path):
    def run(data):
        path = tmp_path / "audit.ndjson"
        path.write_text("\n".join(json.dumps(e) for e in data) + "\n")
        return reconcile(spark, str(path))

    return run


def test_pass(audit):
    data = events()
    got = audit(data)
    assert got["status"] == "PASS" and got["failureReasons"] == []
    r = got["reconciliation"]
    assert (r["rawMemberships"], r["uniqueDocuments"], r["duplicateOccurrences"]) == (9, 5, 4)
    assert {"|".join(x["partitions"]): x["documents"] for x in got["membershipRegions"]} == {"P1": 1, "P1|P2": 2, "P1|P2|P3": 1, "P3": 1}
    assert {(x["left"], x["right"]): x["documents"] for x in got["intersections"]} == {("P1", "P2"): 3, ("P1", "P3"): 1, ("P2", "P3"): 1}
    p1 = got["partitions"][0]
    assert p1["identityResolutionCounts"] == {"documentUuid": 1, "pdfUuid": 1, "nonCollidingComposite": 1, "reviewedHash": 1, "unresolved": 0}
    assert [x["newIdentities"] for x in p1["passes"]] == [4, 0]
    shuffled = [e for e in data if e["type"] != "membership"] + [e for e in data if e["type"] == "membership"][::-1]
    assert audit(shuffled) == got


def test_unresolved(audit):
    data = [e for e in events() if not (e.get("partitionId") in ("P2", "P3") or e.get("id") in ("P2", "P3") or e["type"] == "hashReview")]
    for e in data:
        if e["type"] == "membership":
            e["identity"] = copy.deepcopy(next(x["identity"] for x in events() if x.get("membershipToken") == "TOK-P1-C"))
    got = audit([e for e in data if e.get("membershipToken") not in ("TOK-P1-A", "TOK-P1-D")])
    assert got["status"] == "FAIL" and got["membershipRegions"] == [] and got["partitions"][0]["passes"][0]["newIdentities"] is None
    e = got["partitions"][0]["enumeration"]
    assert (e["unresolvedIdentity"], e["uniqueDocuments"]) == (2, None) and "uniqueDocuments" in got["reconciliation"]["unknownTerms"]


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        (lambda d: d.append({"type": "membership", "partitionId": "P3", "pass": 1, "membershipToken": "TOK-P3-X", "identity": {"documentUuid": u(7), "pdfUuid": u(92)}}) or d.append({"type": "membership", "partitionId": "P3", "pass": 1, "membershipToken": "TOK-P3-Y", "identity": {"documentUuid": u(8), "pdfUuid": u(92)}}), "linked by one file"),
        (lambda d: d[-1]["equivalenceClasses"][0].pop(), "does not cover"),
        (lambda d: d.append({"type": "other"}), "event type"),
        (lambda d: d.append(d[0]), "exactly one run"),
        (lambda d: d.append({"type": "pass", "partitionId": "P1", "pass": 4, "initialTotal": 1, "finalTotal": 1, "completed": True}), "without gap"),
        (lambda d: d.append({"type": "membership", "partitionId": "P1", "pass": 1, "membershipToken": "TOK-P1-A", "identity": {"documentUuid": u(1), "pdfUuid": u(91)}}), "twice in a pass"),
        (lambda d: d.append({"type": "membership", "partitionId": "P9", "pass": 1, "membershipToken": "T", "identity": {"pdfUuid": u(1)}}), "unknown pass"),
        (lambda d: d.append({"type": "membership", "partitionId": "P3", "pass": 2, "membershipToken": "TOK-P3-Z", "identity": {}}), "without identity"),
    ],
)
def test_broken_invariants(audit, change, rule):
    data = events()
    change(data)
    with pytest.raises(InvariantError, match=rule):
        audit(data)


def test_missing_evidence(audit):
    single = [e for e in events() if e.get("pass") != 2]
    assert any("without new identities" in r for r in audit(single)["failureReasons"])
    short = events()
    for e in short:
        if e["type"] == "pass" and e["partitionId"] == "P2" and e["pass"] == 2:
            e["finalTotal"] = 4
    assert any("P2" in r for r in audit(short)["failureReasons"])
    short[next(k for k, e in enumerate(short) if e.get("id") == "P2")]["queryTotalException"] = "explained"
    assert audit(short)["status"] == "PASS"


@pytest.fixture
def folder(tmp_path):
    plan = seal_plan("v1", C, [{"id": i, "kind": "main", "search": {"court": i}} for i in ("B", "A")])
    m = lambda p, n, t, **i: {"schemaVersion": 1, "type": "membership", "partitionId": p, "pass": n, "membershipToken": u(t), "identity": i, "observedAt": "2026-01-01T00:00:00Z"}
    both = lambda n: [m("A", n, 11, documentUuid=u(1)), m("A", n, 12, documentUuid=u(2), pdfUuid=u(92)), m("B", n, 13, pdfUuid=u(92)), m("B", n, 14, documentUuid=u(3))]
    files = {
        "corpus-memberships.jsonl": both(1) + both(2),
        "documents.jsonl": [{"schemaVersion": 1, "documentId": u(k), "partitionId": "A"} for k in (1, 2, 3)],
        "download-manifest.jsonl": [{"schemaVersion": 1, "documentId": u(k), "state": s} for k, s in ((1, "pending"), (2, "pending"), (3, "pending"), (1, "downloaded"))],
    }
    (tmp_path / "data").mkdir()
    for name, rows in files.items():
        (tmp_path / "data" / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    (tmp_path / "corpus-plan.json").write_text(json.dumps(plan))
    meta = {"schemaVersion": 2, "commit": C, "corpusPlanVersion": "v1", "queryHash": plan["queryHash"], "corpusPlanFingerprint": plan["fingerprint"], "partitions": ["B", "A"], "queryTotals": {"A": {"initial": 2, "final": 2}, "B": {"initial": 2, "final": 2}}, "publishedGlobalTotal": {"initial": 3, "final": 3}, "authorizedAt": "2026-01-01"}
    (tmp_path / "run-receipt.json").write_text(json.dumps(meta))
    (tmp_path / "supervisor.log").write_text("pass=1 complete=true new_memberships=4 partitions=2\npass=2 complete=true new_memberships=0 partitions=2\nconverged=true pass=2\n")
    (tmp_path / "discover.log").write_text(json.dumps({"command": "discover", "partitions": [{"partitionId": "A", "queryTotal": 2}], "globalTotal": {"initial": 3, "final": 3}}) + "\n")
    return tmp_path


def test_folder(spark, folder):
    got = finalize(spark, str(folder), "2026-01-02T00:00:00Z")
    assert got["status"] == "PASS", got["failureReasons"]
    r = got["reconciliation"]
    assert (r["rawMemberships"], r["uniqueDocuments"], r["duplicateOccurrences"]) == (4, 3, 1)
    assert {"|".join(x["partitions"]): x["documents"] for x in got["membershipRegions"]} == {"A": 1, "A|B": 1, "B": 1}
    assert got["inputs"]["manifestCurrentStates"] == {"pending": 2, "downloaded": 1, "failed": 0, "no_pdf": 0} and r["notEnumerableWithReason"]["count"] == 0
    write_receipt(str(folder / "receipt.json"), got)
    assert json.loads((folder / "receipt.json").read_text()) == got


def test_folder_fails_honestly(spark, folder):
    (folder / "data" / "failures.jsonl").write_text(json.dumps({"schemaVersion": 1, "failureId": u(70), "phase": "detail", "documentId": u(1), "classification": "timeout", "attempts": 1, "retryable": True, "message": "m", "resolution": "open", "occurredAt": "2026-01-01T00:00:00Z"}) + "\n")
    (folder / "supervisor.log").write_text("pass=1 complete=true new_memberships=4 partitions=2\n")
    got = finalize(spark, str(folder), "now")
    assert got["status"] == "FAIL" and got["inputs"]["openDetailFailures"] == 1 and len(got["failureReasons"]) == 2


@pytest.mark.parametrize(
    ("name", "change", "rule"),
    [
        ("data/download-manifest.jsonl", lambda t: "\n".join(t.splitlines()[:2]) + "\n", "document without state"),
        ("supervisor.log", lambda t: t.replace("pass=2 complete=true new_memberships=0", "pass=2 complete=true new_memberships=1"), "declared new memberships"),
        ("run-receipt.json", lambda t: t.replace('["B", "A"]', '["A", "B"]'), "in order"),
        ("corpus-plan.json", lambda t: t.replace('"court": "A"', '"court": "Z"'), "fingerprint"),
        ("data/documents.jsonl", lambda t: t + json.dumps({"schemaVersion": 1, "documentId": u(9), "partitionId": "A"}) + "\n", "document without state"),
        ("data/corpus-memberships.jsonl", lambda t: "\n".join(reversed(t.splitlines())) + "\n", "order of passes"),
    ],
)
def test_folder_invariants(spark, folder, name, change, rule):
    (folder / name).write_text(change((folder / name).read_text()))
    with pytest.raises(InvariantError, match=rule):
        finalize(spark, str(folder), "now")


def test_plan():
    plan = seal_plan("v1", C, [{"id": "A", "kind": "main", "search": {"q": "ñ"}}])
    assert [p["id"] for p in check_plan(plan)] == ["A"]
    for key in ("queryHash", "fingerprint", "commit"):
        with pytest.raises(InvariantError):
            check_plan({**plan, key: "0" * 64})
