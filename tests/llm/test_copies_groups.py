import random

import pytest

from cotejo.llm import copies
from cotejo.llm.copies import collapse, collisions, copy_members, identity_hashes
from cotejo.llm.groups import consolidate, membership_groups, seed_trees

SCHEMA = "record_id long, layout string, expediente string, sala string, tipo string, fecha string, payload string, copies int"


def test_formats_collapse(spark, rows):
    data = [
        (7, "fields", "001-2020", "Sala Única", "Auto", "01/02/2020", None, 0),
        (3, "json", None, None, None, None, '{"FECHA": "01-02-2020", "tipo": " AUTO ", "Sala": "sala  \\u00fanica.", "expediente": "001 2020"}', 0),
        (5, "labelled", None, None, None, None, "Tipo : (auto)\nEXPEDIENTE:001–2020 | sala: SALA Única\nFecha: 01022020", 0),
        (9, "fields", "001-2020", "Sala Única", "Auto", "０１/02/2020", None, 0),
        (11, "fields", "001-2020", "Sala Unica", "Auto", "01/02/2020", None, 0),
        (12, "json", None, None, None, None, "{broken", 0),
        (13, "fields", None, " - ", "", None, None, 0),
        (14, "fields", "x" * 50_000, "s", "t", "f", None, 0),
        (15, "fields", "X" * 50_000, "S.", "t", "f", None, 0),
        (7, "fields", "001-2020", "Sala Única", "Auto", "01/02/2020", None, 0),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    groups, hashed = collapse(df, "record_id")
    assert rows(copy_members(hashed, groups)) == sorted([(3, 5), (3, 7), (3, 7), (3, 9), (12, 13), (14, 15)], key=repr)
    assert rows(groups, "keep_id", "copies") == sorted([(3, 5), (11, 1), (12, 2), (14, 2)], key=repr)
    empty, none = collapse(df.filter("record_id < 0"), "record_id")
    assert rows(empty) == [] and rows(copy_members(none, empty)) == []


def test_hot_set(spark):
    df = spark.range(45_000).selectExpr("id record_id", "'fields' layout", "if(id % 3 = 0, 'HOT', cast(id as string)) expediente", "'s' sala", "'t' tipo", "'f' fecha", "cast(null as string) payload")
    groups, hashed = collapse(df, "record_id")
    got = copy_members(hashed, groups)
    assert got.count() == 14_999 and got.select("keep_id").distinct().count() == 1


def test_torn_hashes_are_decided_by_the_text(spark, rows, monkeypatch):
    from pyspark.sql import functions as F

    real = identity_hashes
    monkeypatch.setattr(copies, "identity_hashes", lambda *a: real(*a).withColumn("h128", F.unhex(F.lit("00" * 16))).withColumn("check", F.lit(1)))
    df = spark.createDataFrame([(1, "fields", "a", "s", "t", "f", None, 0), (2, "fields", "b", "s", "t", "f", None, 0), (3, "fields", "A.", "s", "t", "f", None, 0)], SCHEMA)
    assert collisions(copies.identity_hashes(df, "record_id")).count() == 1
    groups, hashed = collapse(df, "record_id")
    assert rows(copy_members(hashed, groups)) == [(1, 3)]


def find(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(up)}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "cliques", "none"])
def test_seed_trees(spark, shape):
    random.seed(3)
    edges = {
        "chain": [(i, i + 1) for i in range(90)],
        "star": [(500, i) for i in range(200)],
        "random": [(random.randrange(250), random.randrange(250)) for _ in range(180)],
        "cliques": [(10 * c + a, 10 * c + b) for c in range(5) for a in range(6) for b in range(6)],
        "none": [],
    }[shape]
    df = spark.createDataFrame([*edges, (None, 1), (4, 4)], "a long, b long")
    got = seed_trees(df).collect()
    assert len({r["node"] for r in got}) == len(got)
    assert {r["node"]: r["root"] for r in got} == find([e for e in edges if e[0] != e[1]])


def u(n):
    return f"{n:08x}-0000-4000-8000-{n:012x}"


def test_membership_groups(spark, rows):
    data = [
        (1, "A", 1, u(101), u(1), u(51), None),
        (2, "A", 2, "{" + u(101).upper() + "}", None, u(50), None),
        (3, "B", 1, u(101), "urn:uuid:" + u(50), None, None),
        (4, "B", 1, u(102), u(2), u(52), None),
        (5, "C", 1, u(103), " " + u(52).replace("-", "").upper(), " ", None),
        (6, "C", 1, u(104), u(9), None, None),
        (7, "C", 2, u(105), None, None, None),
        (1, "A", 1, u(101), u(1), u(51), None),
    ]
    df = spark.createDataFrame(data, "ledger_seq long, partition_id string, pass int, membership_token string, document_uuid string, pdf_uuid string, records string")
    got = rows(membership_groups(df))
    assert got == sorted([("A", u(101), u(1), 2), ("B", u(101), u(1), 2), ("B", u(102), u(2), 2), ("C", u(103), u(2), 2), ("C", u(104), u(9), 1)], key=repr)
    assert rows(membership_groups(df.filter("ledger_seq > 99"))) == []


def test_hub(spark):
    df = spark.range(40_000).selectExpr("'P' p", "cast(id as string) t", "if(id % 3 = 0, 'hub', concat('d', id)) d", "cast(null as string) f")
    got = consolidate(df, ["p", "t"], ["d", "f"], key_of=__import__("pyspark.sql.functions", fromlist=["col"]).col)
    assert got.filter("records > 1").count() == 13_334 and got.count() == 40_000


def test_equal_hashes_link_nothing(spark, rows, monkeypatch):
    """Two aliases with the same first hash stay two nodes: the second hash tells them apart."""
    from pyspark.sql import functions as F

    from cotejo.llm import groups

    real = F.xxhash64
    monkeypatch.setattr(groups.F, "xxhash64", lambda *c: real(F.lit("all the same")) if len(c) == 1 else real(*c))
    df = spark.createDataFrame([("P", "1", "a", "b"), ("P", "2", "b", None), ("P", "3", "c", "d"), ("P", "4", "d", None)], "p string, t string, d string, f string")
    got = rows(consolidate(df, ["p", "t"], ["d", "f"], key_of=F.col))
    assert [(r[1], r[2], r[3]) for r in got] == [("1", "a", 2), ("2", "a", 2), ("3", "c", 2), ("4", "c", 2)]
    ten = spark.range(1000).select(groups._node(F.col("id").cast("string")).alias("n"))
    assert ten.filter("n is null or n < 0").isEmpty() and ten.distinct().count() == 1000
