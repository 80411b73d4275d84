import json
import os

import pytest
from pyspark.sql import functions as F

from cotejo import schemas
from cotejo.sources import ledger, markup, paged, sinks

U = [f"00000000-0000-4000-8000-0000000000{n:02d}" for n in range(20)]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_jsonl(spark, tmp_path):
    good = '{"schemaVersion":1,"failureId":"a"}\n\n{"schemaVersion":1,"failureId":"b"}\n'
    df = ledger.read_jsonl(spark, write(tmp_path / "a.jsonl", good), schemas.FAILURE)
    assert [(r["line"], r["failureId"]) for r in df.orderBy("line").collect()] == [(1, "a"), (3, "b")]
    cut = write(tmp_path / "b.jsonl", good + '{"schemaVersion":1,"fail')
    assert ledger.read_jsonl(spark, cut, schemas.FAILURE).count() == 2 and ledger.truncated_tail(spark, cut)
    with pytest.raises(ledger.LineError, match="line 4"):
        ledger.read_jsonl(spark, cut, schemas.FAILURE, tolerate_tail=False)
    bad = write(tmp_path / "c.jsonl", '{"a":1} junk\n' + good)
    with pytest.raises(ledger.LineError, match="line 1"):
        ledger.read_jsonl(spark, bad, schemas.FAILURE)
    closed = write(tmp_path / "d.jsonl", good + '{"schemaVersion":1,"fail\n')
    with pytest.raises(ledger.LineError, match="line 4"):
        ledger.read_jsonl(spark, closed, schemas.FAILURE)
    assert ledger.read_jsonl(spark, str(tmp_path / "none.jsonl"), schemas.FAILURE).count() == 0
    assert ledger.read_jsonl(spark, write(tmp_path / "empty.jsonl", ""), schemas.FAILURE).count() == 0


def test_audit_lines_count_filled_ones(spark, tmp_path):
    with pytest.raises(ledger.LineError, match="line 2"):
        ledger.read_audit(spark, write(tmp_path / "x.ndjson", '\n{"type":"run"}\n\nnope\n'))


def test_ids_and_json(spark, tmp_path):
    path = write(tmp_path / "ids.txt", f"{U[1]}\n{U[2].upper()}\n{U[1].upper()}\n")
    assert sorted(r[0] for r in ledger.read_ids(spark, path).collect()) == [U[1], U[2]]
    with pytest.raises(ledger.LineError):
        ledger.read_ids(spark, write(tmp_path / "bad.txt", "x\n"))
    with pytest.raises(ledger.LineError, match="c.json"):
        ledger.read_json(write(tmp_path / "c.json", "{"))


def test_logs(spark, tmp_path):
    log = "x pass=1 complete=true new_memberships=5 partitions=2\npass=2 complete=true new_memberships=1 partitions=2\npass=2 complete=true new_memberships=0 partitions=2\nconverged=true pass=2\n"
    done, converged = ledger.supervisor_log(spark, write(tmp_path / "s.log", log))
    assert converged == 2 and {r["pass"]: r["new_memberships"] for r in done.collect()} == {1: 5, 2: 0}
    runs = ["noise", json.dumps({"command": "download"}), json.dumps({"command": "discover", "partitions": [{"partitionId": "A", "queryTotal": 3}], "globalTotal": {"initial": 9, "final": None}}), "{broken", json.dumps({"command": "discover", "partitions": [{"partitionId": "A", "initialQueryTotal": 4, "finalQueryTotal": 5}], "globalTotal": {"initial": 10, "final": 11}})]
    totals, overall = ledger.discovery_log(spark, write(tmp_path / "d.log", "\n".join(runs)))
    assert [tuple(r) for r in totals.collect()] == [("A", 3, 5)] and tuple(overall.first()) == (9, 11)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    out = str(tmp_path / "t")
    assert sinks.append_new(df, out, ["id"]) == 2 and sinks.append_new(df, out, ["id"]) == 0
    assert sinks.append_new(spark.createDataFrame([(2, "b"), (3, "c")], "id int, v string"), out, ["id"]) == 1
    assert spark.read.parquet(out).count() == 3
    f = tmp_path / "r.json"
    sinks.write_receipt(str(f), {"a": 1})
    assert json.loads(f.read_text()) == {"a": 1} and oct(f.stat().st_mode)[-3:] == "600"
    (tmp_path / ".r.json.old.tmp").write_text("")
    with pytest.raises(FileExistsError):
        sinks.replace_file(str(f), "x")
    assert sinks.contained(str(tmp_path), "a.pdf").endswith("/a.pdf")
    for bad in ("../a.pdf", "x/a.pdf", "/etc/passwd", ""):
        with pytest.raises(ValueError, match="out of"):
            sinks.contained(str(tmp_path), bad)
    plan = str(tmp_path / "new" / "plan.json")
    assert sinks.keep_plan(plan, {"p": 1}) == sinks.keep_plan(plan, {"p": 1})
    with pytest.raises(ValueError, match="another plan"):
        sinks.keep_plan(plan, {"p": 2})
    sinks.append_jsonl(df, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 3


LIST = """<html><body><p>De un total de 670.050 resoluciones se obtuvieron 12 resultados</p>
<div id="f:repeat:0:panel" class="rf-p"><span data-field="recurso">Casaci&oacute;n</span><span data-field="nroexp">1-2000</span><a id="d0" data-uuid="{u1}">ver</a><a data-file-type="pdf" href="/d?uuid={u1}">x</a></div>
<div id="f:repeat:1:panel" class="rf-p"><div id="h_header"><span>Queja</span><span> 2-2001 </span></div><div class="marginb"><b class="txtbold">Sumilla:</b><div class="col-md-12">Un  texto</div></div><a id="d1" onclick="go('{u2e}')">ver</a></div>
<span class="rf-ds" id="s"><script>x({{"currentPage":2,"maxValue":2}})</script></span></body></html>""".format(u1=U[1], u2e=U[2].replace("-", "\\u002d"))


def test_list_pages(spark):
    pages = spark.createDataFrame([("p", LIST), ("q", "<p>nada</p>"), ("r", None), ("s", LIST.replace("data-field", "x").replace("_header", ""))], "k string, html string")
    got = markup.page_rows(pages, "k", "html", "https://h.pe").filter("page_key = 'p'").orderBy("row").collect()
    assert [(r["native_id"], r["record_index"], r["pdf_url"]) for r in got] == [(U[1], 0, f"https://h.pe/d?uuid={U[1]}"), (U[2], 1, None)]
    assert got[0]["fields"] == {"recurso": ["Casación"], "nroexp": ["1-2000"]} and got[1]["fields"] == {"recurso": ["Queja"], "nroexp": ["2-2001"], "sumilla": ["Un texto"]}
    states = {r["page_key"]: r for r in markup.page_states(pages, "k", "html", "https://h.pe").collect()}
    assert (states["p"]["current_page"], states["p"]["max_pages"], states["p"]["end_signal"], states["p"]["query_total"], states["p"]["published_total"], states["p"]["rows"]) == (2, 2, "natural_end", 12, 670050, 2)
    assert states["r"]["error"] and states["s"]["error"] and states["q"]["rows"] == 0
    with pytest.raises(Exception, match="StructureError"):
        markup.page_rows(pages, "k", "html", "https://h.pe", strict=True).collect()


def test_historical_and_detail(spark):
    page = f'<table><tr><td>Laudo 5</td><td><a href="/d?uuid={U[3]}"><img src="pdf.png"></a><a href="/d?uuid={U[3].upper()}" title="PDF">again</a></td></tr></table>'
    got = markup.page_rows(spark.createDataFrame([("h", page)], "k string, html string"), "k", "html", "https://h.pe", historical=True).collect()
    assert [(r["native_id"], r["row"], r["fields"]["historicalRow"]) for r in got] == [(U[3], 0, ["Laudo 5again"])]
    detail = "<dl><dt>Sala:</dt><dd>Primera</dd><dt>Ponente</dt><dd> Uno </dd></dl><a href='/w?uuid=1'>Word</a>"
    panel = f'<?xml version="1.0"?><partial-response><changes><update id="pop"><![CDATA[{detail}]]></update><update id="javax.faces.ViewState"><![CDATA[v1]]></update></changes></partial-response>'
    grid = "<div class='panel-body'><b class='txtbold'>* Sala:</b><div class='marginb2'><span class='data'>Segunda</span></div></div>"
    rows = {r["page_key"]: r for r in markup.page_details(spark.createDataFrame([("a", detail), ("b", panel), ("c", grid), ("d", "<p>")], "k string, html string"), "k", "html", "https://h.pe").collect()}
    assert rows["a"]["fields"] == rows["b"]["fields"] == {"Sala": ["Primera"], "Ponente": ["Uno"]} and rows["a"]["word_url"] == "https://h.pe/w?uuid=1"
    assert rows["c"]["fields"] == {"Sala": ["Segunda"]} and rows["d"]["error"]


def test_detail_names(spark):
    page = "<dl><dt>Sala:</dt><dd>Primera</dd><dt>Instancia</dt><dd>Segunda</dd><dt>Nueva</dt><dd>x</dd></dl>"
    got = markup.detail_names(markup.page_details(spark.createDataFrame([("a", page)], "k string, html string"), "k", "html", "https://h.pe")).first()
    assert got["known"] == {"chamber": ["Primera", "Segunda"]} and got["unknown"] == {"Nueva": ["x"]}


def test_forms_and_updates(spark):
    form = """<form id="f" action="/go" method="post"><input name="a" value="1"><input name="a" value="2"><input type="checkbox" name="c"><input type="checkbox" name="d" checked>
    <select name="s"><option value="x">X</option><option selected>Y</option></select><textarea name="t">z</textarea><input type="submit" name="b"><input name="off" disabled><fieldset disabled><input name="in"></fieldset></form>"""
    got = [(r["name"], r["value"]) for r in markup.page_controls(spark.createDataFrame([("k", form)], "k string, html string"), "k", "html").orderBy("position").collect()]
    assert got == [("a", "1"), ("a", "2"), ("d", "on"), ("s", "Y"), ("t", "z")]
    with pytest.raises(markup.StructureError, match="more than one form"):
        markup.form_controls(markup.parse_html(form + form))
    xml = "<partial-response><changes><update id='a'>1</update><update id='a'>2</update></changes></partial-response>"
    assert markup.partial_response(xml)["updates"] == {"a": "2"}
    for bad in (xml, "<!DOCTYPE x>" + xml, "<other/>", "<partial-response>"):
        with pytest.raises(markup.StructureError):
            markup.partial_response(bad, strict=True)
    assert markup.partial_response("<partial-response><redirect url='/x'/></partial-response>")["url"] == "/x"
    assert markup.partial_response("<partial-response><error><error-name>E</error-name></error></partial-response>")["name"] == "E"
    assert markup.apply_updates('<div><p id="a">old<b>x</b></p></div>', {"a": '<p id="a">new</p>'}) == '<div><p id="a">new</p></div>'


def test_captured_pages(spark, tmp_path):
    for p in ("A", "B"):
        for n in (1, 2, 10):
            write(tmp_path / "cap" / p / f"page-{n}.html", f"{p}{n}")
    paged.register(spark)
    read = spark.read.format("captured_pages")
    assert [tuple(r) for r in read.load(str(tmp_path / "cap")).orderBy("partition_id", "page").collect()][:3] == [("A", 1, "A1"), ("A", 2, "A2"), ("A", 10, "A10")]
    assert read.option("partitions", "B").option("afterPage", "1").load(str(tmp_path / "cap")).count() == 2
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        q = spark.readStream.format("captured_pages").option("pagesPerTrigger", "2").load(str(tmp_path / "cap")).writeStream.format("parquet").option("checkpointLocation", check).option("path", out).trigger(processingTime="0 seconds").start()
        q.processAllAvailable()
        q.stop()
        return spark.read.parquet(out).count()

    assert run() == 6
    write(tmp_path / "cap" / "A" / "page-11.html", "A11")
    assert run() == 7
    # pages that come after higher ones, in a gap and below all
    write(tmp_path / "cap" / "A" / "page-5.html", "A5")
    write(tmp_path / "cap" / "B" / "page-0.html", "B0")
    assert run() == 9
    assert {r["body"] for r in spark.read.parquet(out).collect()} == {"A1", "A2", "A5", "A10", "A11", "B0", "B1", "B2", "B10"}
    tasks = read.option("pagesPerTask", "2").load(str(tmp_path / "cap"))
    assert tasks.count() == 2 and tasks.rdd.getNumPartitions() == 1


def test_binaries(spark, tmp_path):
    from cotejo.operators.validate import content_verdict

    for name, body in (("a", b"%PDF-1.4 xxxxxxxx"), ("b", b""), ("c", b"<html>no pdf here"), ("d", b"%PDF-")):
        (tmp_path / "f" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "f" / name).write_bytes(body)
    assert spark.range(1).select(content_verdict(F.lit(b""), 8, 1000).alias("v")).first()["v"]["code"] == "EMPTY"
    got = {os.path.basename(r["path"]): r["v"]["code"] for r in ledger.binaries(spark, str(tmp_path / "f")).withColumn("v", content_verdict(F.col("content"), 8, 1000)).collect()}
    assert got == {"a": None, "c": "INVALID_SIGNATURE", "d": "TOO_SMALL"}


def test_null_keys_are_appended_once(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, "b")], "id int, v string")
    out = str(tmp_path / "t")
    assert [sinks.append_new(df, out, ["id", "v"]) for _ in range(3)] == [3, 0, 0]
    assert spark.read.parquet(out).count() == 3


def test_resume_points(tmp_path):
    path, state = str(tmp_path / "c.json"), {"baseUrl": "https://h", "queryHash": "q", "partitionId": "A", "page": 7}
    assert sinks.load_checkpoint(path) is None and sinks.resume_place(None, "", "", []) is None
    sinks.save_checkpoint(path, state)
    assert sinks.load_checkpoint(path) == state and sinks.resume_place(state, "https://h", "q", ["A", "B"]) == ("A", 7)
    for args in (("https://x", "q", ["A"]), ("https://h", "r", ["A"]), ("https://h", "q", ["B"])):
        with pytest.raises(sinks.CheckpointError, match="another run"):
            sinks.resume_place(state, *args)
    for bad in ({**state, "page": 0}, {**state, "page": "7"}, {"page": 1}, [], None):
        with pytest.raises(sinks.CheckpointError):
            sinks.save_checkpoint(path, bad)
    (tmp_path / ".c.json.left.tmp").write_text("{")
    assert sinks.load_checkpoint(path) == state and not (tmp_path / ".c.json.left.tmp").exists()
    (tmp_path / "c.json").write_text("{")
    with pytest.raises(sinks.CheckpointError, match="JSON"):
        sinks.load_checkpoint(path)
    (tmp_path / "c.json").rename(tmp_path / ".c.json.left.tmp")
    with pytest.raises(sinks.CheckpointError, match="leftovers"):
        sinks.load_checkpoint(path)


def test_stored_content(spark, tmp_path):
    from cotejo.operators.coverage import file_verdicts

    home = tmp_path / "files"
    home.mkdir()
    good = b"%PDF-1.7 some body"
    kept = sinks.store_content(str(home), "a.pdf", good, 8, 100)
    assert kept["code"] is None and (home / "a.pdf").read_bytes() == good
    for body, code in ((b"", "EMPTY"), (b"%PDF-", "TOO_SMALL"), (b"%PDF-" + b"x" * 200, "TOO_LARGE"), (b"<html>no file</html>", "INVALID_SIGNATURE")):
        assert sinks.store_content(str(home), "a.pdf", body, 8, 100)["code"] == code
    assert sinks.store_content(str(home), "b.pdf", good, 8, 100, expected=5)["code"] == "INCOMPLETE"
    assert os.listdir(home) == ["a.pdf"] and (home / "a.pdf").read_bytes() == good
    with pytest.raises(ValueError, match="out of"):
        sinks.store_content(str(home), "../a.pdf", good, 8, 100)
    path = f"file:{home}/a.pdf"
    events = spark.createDataFrame([(1, path, len(good), kept["sha256"].upper()), (2, path, 5, kept["sha256"]), (3, path, len(good), "00"), (4, "file:/none", 1, ""), (5, None, None, None)], "document long, path string, bytes long, sha256 string")
    got = {r["document"]: r["verdict"] for r in file_verdicts(events, ledger.binaries(spark, str(home)), 8).collect()}
    assert got == {1: "ok", 2: "size", 3: "hash", 4: "missing", 5: "missing"}


def test_lenient_updates(spark):
    xml = "<partial-response><changes><update id='a'>1</update><update id='a'>2</update></changes></partial-response>"
    error = "<partial-response><error><error-name>E</error-name><error-message>lost token=abc</error-message></error></partial-response>"
    pages = spark.createDataFrame([("p", xml), ("q", error)], "k string, x string")
    strict, lenient = ({r["page_key"]: r for r in markup.page_updates(pages, "k", "x", lenient=on).collect()} for on in (False, True))
    assert strict["p"]["error"] and json.loads(lenient["p"]["updates"]) == {"a": "2"}
    assert lenient["q"]["message"] == "lost [REDACTED]"
