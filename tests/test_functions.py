import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cotejo.functions import identity, text, web


@pytest.fixture
def one(spark):
    def run(value, col):
        return spark.createDataFrame([(value,)], "x string").select(col(F.col("x")).alias("y")).first()["y"]

    return run


@pytest.mark.parametrize(("raw", "want"), [("  a\xa0 b\n\tc ", "a b c"), (None, None), ("", ""), ("﻿x y", "x y")])
def test_clean(one, raw, want):
    assert one(raw, text.clean) == want


def test_normalize(one):
    assert one("  Éxito\xa0 UNO ", text.normalize) == "éxito uno"
    assert one("Å", text.normalize) == "å"


def test_numbers_and_totals(one):
    assert one("151.191", text.locale_number) == 151191 and one("1,599", text.locale_number) == 1599 and one("x", text.locale_number) is None
    got = one("De un total de 670.050 resoluciones\n se obtuvieron 151,191 resultados", text.totals)
    assert (got["published_total"], got["query_total"]) == (670050, 151191)
    assert one("12 resultados", text.totals)["query_total"] == 12 and one("nada", text.totals)["query_total"] is None


def test_ids(one):
    assert one("formBuscador:repeat:7:link", text.record_index) == 7 and one("x", text.record_index) is None
    assert one(r"go('0000aaaa-1111\\u002d4222-8333-444444444444')", text.uuid_within) == "0000aaaa-1111-4222-8333-444444444444"


def test_redaction(one):
    assert one("Bearer abc.def and https://h/?token=xyz&b=1", text.redact) == "Bearer [REDACTED] and https://h/?token=[REDACTED]&b=1"
    got = json.loads(one(json.dumps({"a": {"Set-Cookie": "s", "n": [{"password": 1}, "Basic Zm9v"]}, "b": 2}), text.redact_json))
    assert got == {"a": {"Set-Cookie": "[REDACTED]", "n": [{"password": "[REDACTED]"}, "Basic [REDACTED]"]}, "b": 2}
    assert one("javax.faces.ViewState=abc token: zz", text.redact_error) == "javax.faces.ViewState=[REDACTED] [REDACTED]"


@pytest.mark.parametrize(("raw", "want"), [("a/b\\c: d", "a-b-c-d"), ("..\x00..", "x"), ("CON", "x"), ("com1.txt", "x"), ("  nº 5 ", "no-5"), (None, "x"), ("a" * 200, "a" * 32)])
def test_safe_segment(one, raw, want):
    assert one(raw, lambda c: text.safe_segment(c, "x", 32)) == want


def test_stable_json(one):
    assert one('{"b":1,"a":{"d":2,"c":3}}', text.stable_json) == '{"a":{"c":3,"d":2},"b":1}' and one("{", text.stable_json) is None


U = "00000000-0000-4000-8000-00000000000a"


@pytest.mark.parametrize(
    ("url", "ok"),
    [(f"https://h.pe/d?uuid={U}", True), (f"https://h.pe/d?uuid={U}&x=1", False), (f"http://h.pe/d?uuid={U}", False), (f"https://u@h.pe/d?uuid={U}", False), (f"https://h.pe/e?uuid={U}", False), (f"https://h.pe/d?uuid={U}#f", False), ("nonsense", False), (None, False)],
)
def test_safe_request(one, url, ok):
    assert one(url, lambda c: web.safe_request(c, "https://h.pe", "/d")) is ok


@pytest.mark.parametrize(
    ("url", "why"),
    [("https://h.pe/j/x", "ok"), ("http://h.pe/j/x", "ok"), ("https://h.pe/k", "path"), ("https://x.pe/j/", "origin"), ("https://10.0.0.1/j/", "private host"), ("https://172.20.0.1/j/", "private host"), ("https://localhost/j/", "private host"), ("https://a@h.pe/j/", "userinfo"), ("ftp://h.pe/j/", "scheme"), ("::", "invalid")],
)
def test_redirects(one, url, why):
    assert one(url, lambda c: web.redirect_verdict(c, "h.pe", "/j/")) == why


def test_controls(spark):
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), F.lit(v).alias("value"))
    base = F.array(pair("a", "1"), pair("b", "x y"), pair("a", "2"))
    df = spark.range(1)
    assert df.select(web.encode_pairs(base)).first()[0] == "a=1&b=x+y&a=2"
    assert df.select(web.encode_pairs(web.set_control(base, "a", "9"))).first()[0] == "a=9&b=x+y"
    assert df.select(web.encode_pairs(web.set_control(base, "c", "é"))).first()[0] == "a=1&b=x+y&a=2&c=%C3%A9"


def test_retry(spark, one):
    now = F.lit(datetime(2025, 1, 1))
    assert one("120", lambda c: web.retry_after_ms(c, now)) == 120_000
    assert one("Wed, 01 Jan 2025 00:00:30 GMT", lambda c: web.retry_after_ms(c, now)) == 30_000
    assert one("Tue, 31 Dec 2024 00:00:30 GMT", lambda c: web.retry_after_ms(c, now)) == 0
    assert one("soon", lambda c: web.retry_after_ms(c, now)) is None
    caps = [r[0] for r in spark.range(1, 9).select(web.backoff_cap_ms("id", 2000, 120_000)).collect()]
    assert caps == [2000, 4000, 8000, 16000, 32000, 64000, 120000, 120000]
    assert all(0 <= r[0] <= 2000 for r in spark.range(20).select(web.backoff_ms(F.lit(1), 2000, 9000, F.rand(1))).collect())
    assert [r[0] for r in spark.createDataFrame([(429,), (403,), (503,), (404,), (200,), (None,)], "s int").select(web.classify_status("s")).collect()] == ["rate_limit", "access", "http_transient", "http_permanent", None, None]


def test_fields(spark):
    df = spark.createDataFrame([(1, 0, "Sala", "uno"), (1, 1, "Ponente", "p"), (1, 2, "Instancia", "dos"), (1, 3, "Raro", "r"), (1, 4, "Sala", "tres")], "id int, at int, label string, value string")
    folded = identity.multi_map(df, ["id"], "label", "value", "at")
    assert folded.first()["fields"] == {"Sala": ["uno", "tres"], "Ponente": ["p"], "Instancia": ["dos"], "Raro": ["r"]}
    got = folded.select(identity.split_known("fields", {"Sala": "chamber", "Instancia": "chamber", "Ponente": "judge"}).alias("x")).first()["x"]
    assert got["known"] == {"chamber": ["uno", "tres", "dos"], "judge": ["p"]} and got["unknown"] == {"Raro": ["r"]}
    a, b = F.create_map(F.lit("x"), F.lit(1), F.lit("y"), F.lit(2)), F.create_map(F.lit("y"), F.lit(9))
    assert spark.range(1).select(identity.overlay(a, b)).first()[0] == {"x": 1, "y": 9}


def test_composite(one):
    assert one("A  b", lambda c: identity.composite_identity([c, F.lit("C")])) == "a b\x1fc"
    assert one(" ", lambda c: identity.composite_identity([c, F.lit("C")])) is None


def test_redaction_is_one_for_columns_and_texts(one):
    for raw in ("Bearer abc.def?token=x y", "a Basic Zm9v&access_token=1&b=2", "?javax.faces.ViewState=q", "nada", "bearer   x"):
        assert one(raw, text.redact) == text.redacted_text(raw)
    for raw in ("javax.faces.ViewState : abc token=zz", "Cookie: a=b c", " authorization=x"):
        assert one(raw, text.redact_error) == text.redacted_error(raw)


@pytest.mark.parametrize("raw", ["Bearer \tabc x", "a bearer   abc x", "Basic\n\nabc x", "Bearer abc x"])
def test_one_blank_before_a_redacted_credential(one, raw):
    want = raw.split()[: -2] + ["[REDACTED]", "x"]
    assert one(raw, text.redact) == text.redacted_text(raw) == " ".join(want)


def test_status_verdict(spark):
    rows = [(429, 1, False, False, False), (403, 1, False, False, False), (403, 2, False, False, False), (403, 1, True, False, False), (500, 1, False, True, False), (500, 1, False, False, False), (200, 1, False, False, True), (200, 1, False, False, False), (404, 1, None, None, None), (None, 1, False, False, False)]
    df = spark.createDataFrame(rows, "s int, a int, p boolean, e boolean, m boolean")
    got = [tuple(r["v"]) for r in df.select(web.status_verdict("s", "a", F.col("p"), F.col("e"), F.col("m")).alias("v")).collect()]
    assert got == [("rate_limit", True, False), ("access", True, True), ("access", False, False), ("access", False, False), ("session_invalid", True, True), ("http_transient", True, False), ("structural", True, True), (None, False, False), ("http_permanent", False, False), (None, False, False)]
