from datetime import datetime

import pytest
from cotejo.operators.orphans import Ref, Source, direct_orphans, orphan_cascade, orphan_report
from cotejo.operators.snapshots import snapshot_audit, snapshot_changes

T = lambda d: datetime(2025, 1, d)


def graph(spark):
    docs = spark.createDataFrame([(1, "A", T(2), None), (2, "A", T(2), None), (3, "B", T(1), T(5)), (4, None, T(1), None)], "n long, k string, at timestamp, gone timestamp")
    fails = spark.createDataFrame([(1, "F1", "a", T(3)), (2, "F2", "B", T(5)), (3, "F3", None, T(3)), (4, "F2", "B", T(4)), (5, "F4", "", T(1))], "n long, k string, doc string, at timestamp")
    man = spark.createDataFrame(
        [(1, "E1", "A", "F1", T(2)), (2, "E2", "A", "F2", T(6)), (3, "E3", "X", None, T(6)), (3, "E3", "X", None, T(6)), (4, "E4", " ", "F9", T(6)), (5, "E5", "A", "F1", None), (6, "E6", "B", "F1", T(4))],
        "n long, k string, doc string, fail string, at timestamp",
    )
    return {
        "docs": Source(docs, "n", "at", key="k", gone="gone"),
        "fails": Source(fails, "n", "at", key="k", refs=(Ref("doc", "docs"),)),
        "man": Source(man, "n", "at", key="k", refs=(Ref("doc", "docs"), Ref("fail", "fails"))),
    }


def test_direct_and_inherited(spark, rows):
    got = rows(orphan_cascade(graph(spark)), "ref_table", "ref_field", "row_id", "kind")
    assert got == sorted(
        [("fails", "doc", 2, "direct"), ("man", "doc", 3, "direct"), ("man", "doc", 3, "direct"), ("man", "fail", 1, "direct"), ("man", "fail", 4, "direct"), ("man", "fail", 2, "inherited")], key=repr
    )
    report = rows(orphan_report(orphan_cascade(graph(spark))))
    assert ("man", "fail", "2025-01", 2, 1) in report


def test_chain_and_empty(spark, rows):
    t = spark.createDataFrame([(1, "a", None, T(1)), (2, "b", "missing", T(1)), (3, "c", "b", T(2)), (4, "d", "c", T(3)), (5, "e", "a", T(3))], "n long, k string, up string, at timestamp")
    src = {"t": Source(t, "n", "at", key="k", refs=(Ref("up", "t"),))}
    assert rows(orphan_cascade(src), "row_id", "kind") == sorted([(2, "direct"), (3, "inherited"), (4, "inherited")], key=repr)
    empty = {"t": Source(t.filter("n > 9"), "n", "at", key="k", refs=(Ref("up", "t"),))}
    assert rows(orphan_cascade(empty)) == [] and rows(direct_orphans(empty)) == []


def test_hot_reference(spark):
    man = spark.range(60_000).selectExpr("id as n", "cast(id as string) k", "case when id % 3 = 0 then 'HOT' else concat('d', id % 1000) end doc", "timestamp'2025-01-02' at")
    docs = spark.range(1000).selectExpr("id as n", "concat('d', id) k", "timestamp'2025-01-01' at")
    src = {"docs": Source(docs, "n", "at", key="k"), "man": Source(man, "n", "at", key="k", refs=(Ref("doc", "docs"),))}
    assert direct_orphans(src).filter("orphan").count() == 20_000


REPLAY = "row_id long, g long, v int, k string, title string, pdf_state string"


def changes(spark, data, values=("title", "pdf_state")):
    return snapshot_changes(spark.createDataFrame(data, REPLAY), "g", "v", "k", list(values), "row_id")


def test_changes(spark, rows):
    data = [
        (1, 1, 1, "a", "x", "p"), (2, 1, 1, "b", "x", "p"), (3, 1, 1, "c", None, "p"), (4, 1, 1, "gone", "x", "p"),
        (5, 1, 3, " A ", " x ", "p"), (6, 1, 3, "b", "y", "p"), (7, 1, 3, "c", "", "p"), (8, 1, 3, "new", "x", "p"), (9, 1, 3, "new", "z", "p"),
        (10, 1, 4, "B", "y", "p"), (11, 1, 4, None, "x", "p"), (12, 2, 2, "a", "x", "p"),
    ]
    got = rows(changes(spark, data), "g", "v", "k", "change_kind")
    assert got == sorted([(1, 3, "B", "changed"), (1, 3, "GONE", "removed"), (1, 3, "NEW", "added"), (1, 4, "A", "removed"), (1, 4, "C", "removed"), (1, 4, "NEW", "removed")], key=repr)
    assert rows(changes(spark, []), "g", "v", "k", "change_kind") == []
    keys = rows(changes(spark, data), "change_kind", "k", "old_id", "new_id")
    assert ("added", "NEW", None, 9) in keys and ("changed", "B", 2, 6) in keys


def test_snapshot_of_keyless_rows_counts(spark, rows):
    got = rows(changes(spark, [(1, 1, 1, "a", "x", "p"), (2, 1, 2, None, "x", "p"), (3, 1, 3, "a", "x", "p")]), "v", "k", "change_kind")
    assert got == [(2, "A", "removed"), (3, "A", "added")]


def test_against_brute_force(spark, rows):
    import random

    random.seed(4)
    data = [(i, random.randrange(3), random.choice([1, 2, 4]), random.choice("abcdefgh"), random.choice(["x", "y", None, ""]), "p") for i in range(300)]
    snap = {}
    for i, g, v, k, t, s in data:
        snap.setdefault(g, {}).setdefault(v, {})[k.upper()] = (t or None, s)
    want = []
    for g, vs in snap.items():
        order = sorted(vs)
        for a, b in zip(order, order[1:]):
            for k in vs[a].keys() | vs[b].keys():
                kind = "added" if k not in vs[a] else "removed" if k not in vs[b] else "changed" if vs[a][k] != vs[b][k] else None
                if kind:
                    want.append((g, b, k, kind))
    assert rows(changes(spark, data), "g", "v", "k", "change_kind") == sorted(want, key=repr)


def test_audit(spark):
    data = spark.createDataFrame([(1, 1, 1, "a", "x", "p"), (2, 1, 2, "a", "x", "p"), (3, 1, 2, "b", "x", "p")], REPLAY).withColumnsRenamed({"g": "replay_id", "v": "pass", "k": "identity_id"})
    passes = spark.createDataFrame([(1, 1, 1, 1, ["a"]), (1, 2, 2, 3, ["c"]), (1, 3, None, None, None)], "replay_id long, pass int, initial_total long, final_total long, expected_new_identities array<string>")
    ch = snapshot_changes(data, "replay_id", "pass", "identity_id", ["title"], "row_id")
    got = {r["pass"]: r for r in snapshot_audit(data, passes, ch).collect()}
    assert (got[1]["final_total_fits"], got[1]["declared_not_seen"], got[1]["seen_not_declared"]) == (True, 0, 0)
    assert (got[2]["final_total_fits"], got[2]["declared_not_seen"], got[2]["seen_not_declared"], got[2]["added"]) == (False, 1, 1, 1)
    assert (got[3]["final_total_fits"], got[3]["declared_not_seen"], got[3]["rows_seen"]) == (None, None, 0)


def test_chain_deeper_than_the_rounds_raises(spark):
    t = spark.createDataFrame([(k, f"K{k}", f"K{k - 1}", T(1)) for k in range(1, 7)], "n long, k string, up string, at timestamp")
    src = {"t": Source(t, "n", "at", key="k", refs=(Ref("up", "t"),))}
    assert orphan_cascade(src, max_rounds=6).count() == 6
    with pytest.raises(RuntimeError):
        orphan_cascade(src, max_rounds=3)
