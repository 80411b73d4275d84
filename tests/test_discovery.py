import unicodedata

from cotejo.plans.discovery import discover, discovery_summary, file_name

U = [f"00000000-0000-4000-8000-0000000000{n:02d}" for n in range(10)]


def page(ids, total, current, last):
    rows = "".join(f'<div id="f:repeat:{k}:p" class="rf-p"><span data-field="recurso">R{i}</span><span data-field="nroexp">{i}</span><a id="d{k}" data-uuid="{U[i]}">v</a>' + (f'<a data-file-type="pdf" href="/d?uuid={U[i]}">f</a>' if i % 2 else "") + "</div>" for k, i in enumerate(ids))
    return f'<p>{total} resultados</p>{rows}<span class="rf-ds" data-current-page="{current}" data-max-value="{last}"></span>'


def test_two_passes(spark, tmp_path):
    pages = spark.createDataFrame([("A", 1, page([1, 2], 3, 1, 2)), ("A", 2, page([2, 3], 4, 2, 2)), ("B", 1, page([3], 1, 1, 1))], "partition_id string, page int, body string")
    out = str(tmp_path / "corpus")
    first = discover(spark, pages, out, "https://h.pe", 1)
    assert first == {"inserted": 3, "sightings": 4, "states": 3}
    assert discover(spark, pages, out, "https://h.pe", 1) == {"inserted": 0, "sightings": 0, "states": 0}
    assert discover(spark, pages, out, "https://h.pe", 2) == {"inserted": 0, "sightings": 4, "states": 0}
    docs = {r["document_id"]: r for r in spark.read.parquet(out + "/documents").collect()}
    assert (docs[U[2]]["pdf_state"], docs[U[3]]["pdf_state"], docs[U[1]]["title"], docs[U[3]]["partition_id"]) == ("no_pdf", "pending", "R1", "A")
    got = {r["partition_id"]: r for r in discovery_summary(pages, "https://h.pe").collect()}
    a = got["A"]
    assert (a["pages"], a["raw"], a["unique_rows"], a["duplicates"], a["drifted"], a["natural_end"], a["repeated_pages"]) == (2, 4, 3, 1, True, True, 0)
    assert (got["B"]["drifted"], got["B"]["natural_end"], got["B"]["counts_hold"], a["counts_hold"]) == (False, True, True, True)


def test_file_name(spark):
    df = spark.createDataFrame([("id1", "01/02/2020", None, "Casación N° 5"), ("id2", None, None, None)], "i string, d string, n string, c string")
    want = unicodedata.normalize("NFKD", "id1__01-02-2020__Casación-N°-5.pdf")
    assert [r[0] for r in df.select(file_name("i", "d", ("n", "c"))).collect()] == [want, "id2__sin-fecha__documento.pdf"]
