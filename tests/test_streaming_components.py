import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.operators import components, coverage, limits, passes, regions, state
from cotejo.runtime import lookup, uuid_key
from cotejo.streaming.ingest import ingest, latest_state_stream, ledger_stream, repeat_until_quiet


def find(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(up)}


def test_components(spark):
    random.seed(2)
    for edges in ([(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)], [(random.randrange(300), random.randrange(300)) for _ in range(200)], [(1, 1)]):
        real = [(a, b) for a, b in edges if a != b]
        df = spark.createDataFrame(edges + [(None, 5), (7, None)], "a long, b long")
        assert {r["node"]: r["root"] for r in components.connected_components(df).collect()} == find(real)


def test_alias_namespaces(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "y", "X"), (3, "y", None), (4, None, None)], "id long, d string, p string")
    assert {r["id"]: r["root"] for r in components.alias_components(df, "id", ["d", "p"]).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    assert {r["id"]: r["root"] for r in components.alias_components(df, "id", ["d", "p"], shared_namespace=False).collect()} == {1: 1, 2: 2, 3: 2, 4: 4}


def test_lookup_keeps_hot_and_null_keys(spark):
    facts = spark.range(40_000).selectExpr("id", "case when id % 4 = 0 then null when id % 2 = 0 then 'hot' else concat('k', id % 50) end k")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k3", 3)], "k string, v int")
    got = lookup(facts, dim, ["k"])
    want = facts.join(dim, "k", "left")
    assert got.count() == 40_000 and got.groupBy("v").count().exceptAll(want.groupBy("v").count()).isEmpty()
    assert lookup(facts, dim, ["k"], how="inner").count() == want.filter("v is not null").count()


def test_uuid_key(spark):
    u = "0000ABCD-1111-4222-8333-444444444444"
    df = spark.createDataFrame([(u,), (f"{{{u}}}",), (f"urn:uuid:{u.lower()}",), (f"\t{u.replace('-', '')} ",), ("  ",), (None,), (" X9 ",)], "k string")
    assert [r[0] for r in df.select(uuid_key("k")).collect()] == ["0000abcd111142228333444444444444"] * 4 + [None, None, "x9"]


def test_stream_ingest_is_idempotent(spark, tmp_path):
    inbox, table, check = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    inbox.mkdir()
    schema = T.StructType([T.StructField("partition_id", T.StringType()), T.StructField("pass", T.IntegerType()), T.StructField("token", T.StringType())])

    def drop(name, rows):
        (inbox / name).write_text("".join(json.dumps(dict(zip(("partition_id", "pass", "token"), r))) + "\n" for r in rows))

    def run():
        ingest(ledger_stream(spark, str(inbox), schema), table, ["partition_id", "pass", "token"], check).awaitTermination()
        return spark.read.parquet(table).count()

    drop("a.json", [("A", 1, "x"), ("A", 1, "x"), ("A", 1, "y")])
    assert run() == 2 and run() == 2
    drop("b.json", [("A", 1, "x"), ("A", 2, "x")])
    assert run() == 3
    ingest(ledger_stream(spark, str(inbox), schema), table, ["partition_id", "pass", "token"], str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(table).count() == 3


def test_streamed_state_equals_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    random.seed(1)
    events = [(f"d{random.randrange(6)}", random.choice(["pending", "failed", "downloaded"]), n) for n in range(60)]
    random.shuffle(events)
    for k in range(3):
        (inbox / f"{k}.json").write_text("".join(json.dumps(dict(zip(("document", "state", "seq"), e))) + "\n" for e in events[k::3]))
    q = latest_state_stream(ledger_stream(spark, str(inbox), T.StructType.fromDDL("document string, state string, seq long"), 1)).writeStream.outputMode("update").format("memory").queryName("latest_state").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    streamed = {r["document"]: r["s"]["state"] for r in spark.sql("select document, max_by(struct(state), seq) s from latest_state group by document").collect()}
    batch = state.latest_by_key(spark.createDataFrame(events, "document string, state string, seq long"), ["document"], ["seq"], ["state"])
    assert streamed == {r["document"]: r["state"] for r in batch.collect()}


def test_repeat_until_quiet():
    left = [4, 2, 0]
    assert repeat_until_quiet(lambda n: left[n - 1]) == 3


def test_passes(spark, rows):
    seen = spark.createDataFrame([("A", 1, "x", False), ("A", 1, "y", False), ("A", 2, "x", False), ("A", 3, "z", True), ("B", 1, "x", False)], "p string, pass int, k string, open boolean")
    per = passes.new_per_pass(seen, "p", ["k"], unresolved="open")
    assert rows(per) == [("A", 1, 2, 2), ("A", 2, 1, 0), ("A", 3, 1, None), ("B", 1, 1, 1)]
    assert rows(passes.convergence(per, "p")) == [("A", 3, 3, None), ("B", 1, 1, False)]
    assert rows(passes.contiguity(spark.createDataFrame([("A", 1), ("A", 2), ("B", 2), ("C", 1), ("C", 1)], "p string, pass int"), "p")) == [("A", True), ("B", False), ("C", False)]
    drift = passes.drift(spark.createDataFrame([("A", 1, 5), ("A", 2, 7), ("A", 3, 5), ("B", 1, 5), ("B", 2, 6)], "p string, at int, v int"), ["p"], "at", "v")
    assert rows(drift, "p", "drifted") == [("A", False), ("B", True)]
    replay = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "a"), (1, 2, "c"), (1, 3, "c")], "g int, pass int, k string")
    assert rows(passes.replay_convergence(replay, "g", "pass", "k")) == [(1, 3, 1)]


def test_coverage_and_limits(spark, rows):
    left = spark.createDataFrame([("a", "pending"), ("b", "no_pdf"), ("b", "no_pdf"), ("c", "pending"), ("d", "no_pdf")], "k string, l string")
    right = spark.createDataFrame([("a", "downloaded"), ("b", "no_pdf"), ("d", "failed"), ("z", "pending")], "k string, r string")
    got = coverage.coverage(left, right, "k", (F.col("l") == "no_pdf") != (F.col("r") == "no_pdf"))
    assert rows(got) == [("a", "ok"), ("b", "duplicate"), ("c", "missing"), ("d", "contradiction"), ("z", "unknown")]
    n = spark.range(5)
    kept, more = limits.limited(n, 3, ["id"])
    assert (kept.count(), more, limits.limited(n, 5, ["id"])[1]) == (3, True, False)
    assert rows(limits.new_rows(n, n.filter("id < 2"), ["id"], 2, ["id"])) == [(2,), (3,)]
    pages = spark.createDataFrame([(1, 0), (2, 1), (2, 2), (3, 0)], "page int, row int")
    assert rows(limits.resume_from(pages, "page", "row", (2, 2))) == [(2, 2), (3, 0)]
    names = spark.createDataFrame([("Zeta",), ("alpha",), ("Ábaco",)], "n string")
    assert [r[0] for r in limits.collated(names, "n").collect()] == ["Ábaco", "alpha", "Zeta"]
    assert [r[0] for r in limits.collated(names, "n", False).collect()] == ["Zeta", "alpha", "Ábaco"]
    placed = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A"), (3, "C"), (3, "C")], "root int, p string")
    reg = regions.membership_regions(placed, "root", "p")
    assert rows(reg) == sorted([(["A", "B"], 1), (["A"], 1), (["C"], 1)], key=repr)
    assert rows(regions.intersections(reg)) == [("A", "B", 1), ("A", "C", 0), ("B", "C", 0)]


def test_partition_gap_and_provenance(spark, rows):
    totals = spark.createDataFrame([("A", 5), ("B", 7)], "p string, t long")
    assert rows(regions.partition_gap(totals, "p", "t", 20)) == sorted([("A", 5, None), ("B", 7, None), (None, 12, 8)], key=repr)
    unknown = totals.unionByName(spark.createDataFrame([("C", None)], "p string, t long"))
    assert (None, None, None) in rows(regions.partition_gap(unknown, "p", "t", 20))
    stored = spark.createDataFrame([("d1", "A", 1), ("d2", "A", None), ("d3", "B", 2), ("d4", None, 1)], "d string, p string, n int")
    source = spark.createDataFrame([("d1", "A", 1), ("d2", "A", None), ("d3", "A", 3)], "d string, p string, n int")
    assert rows(coverage.provenance_breaks(stored, source, "d", ["p", "n"])) == [("d3", "n"), ("d3", "p"), ("d4", "d")]


def test_resolve_all(spark, rows):
    opened = spark.createDataFrame([("f1", "detail", "x"), ("f2", "detail", "x"), ("f3", "download", "x"), ("f4", "detail", None)], "failure_id string, phase string, document_id string")
    docs = spark.createDataFrame([("detail", "x"), ("detail", "x"), ("detail", None)], "phase string, document_id string")
    got = state.resolve_all(opened, docs, F.lit("2026-01-01").cast("timestamp"))
    assert rows(got, "failure_id", "resolution") == [("f1", "resolved"), ("f2", "resolved")]
