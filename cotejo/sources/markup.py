"""Captured pages and partial responses as rows. HTML is read with the standard library into a small tree; one Arrow pass, no shuffle."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import parse_qs, urljoin, urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import split_known
from ..functions.text import redacted_error

VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Labels of result lists and of detail panels, and the names they get.
LIST_LABELS = {"Pretensión/Delito": "pretensiones", "Tipo Resolución": "tipoResolucion", "Fecha Resolución": "fechaResolucion", "Sala Suprema": "sala", "Sala": "sala", "Norma de Derecho Interno": "normaDI", "Sumilla": "sumilla", "Palabras Clave": "palabras"}
DETAIL_LABELS = {
    "Fecha de la Resolución": "resolutionDate",
    "Tipo de Resolución": "resolutionType",
    "Fallo/Sentido de la Resolución": "decision",
    "Jueces Supremos": "judges",
    "Jueces": "judges",
    "Ponente": "reportingJudge",
    "Dirimente": "castingJudge",
    "Discordia": "dissent",
    "Voto Concordado": "concurringVote",
    "Fundamentos Adicionales": "additionalGrounds",
    "Sumilla": "summary",
    "Norma de Derecho Interno": "domesticLaw",
    "Jurisprudencia Nacional/Acuerdo Plenario": "nationalPrecedent",
    "Norma de Derecho Internacional": "internationalLaw",
    "Organismo Emisor de Jursiprudencia Internacional": "internationalIssuer",
    "Palabras Clave": "keywords",
    "Relevante": "relevant",
    "Vinculante": "binding",
    "Fecha de Publicación en El Peruano": "officialPublicationDate",
    "Especialidad": "specialty",
    "Sala": "chamber",
    "Instancia": "chamber",
    "Distrito Judicial de Procedencia": "district",
    "Distrito": "district",
    "Materia de la Causa": "subjectMatter",
    "Pretensión/Delito": "claimOrOffense",
    "Pretención/Delito": "claimOrOffense",
    "Régimen Procesal": "proceduralRegime",
    "Tipo de Proceso": "processType",
    "Proceso": "processType",
    "N° de Expediente de la Sala Superior": "superiorCaseNumber",
    "Archivo de la Resolución": "resolutionFile",
    "Fecha de Demanda": "filingDate",
    "Fecha de Calificación": "admissionDate",
    "Organo Jurisdiccional de procedencia": "originatingCourt",
    "Fallo": "lowerDecision",
    "Expediente de Procedencia": "lowerCaseNumber",
    "Fecha de Resolución de Procedencia": "lowerResolutionDate",
    "Organo Jurisdiccional de Origen": "originalCourt",
    "Fallo de Origen": "originalDecision",
    "Tipo de Resolución de Origen": "originalResolutionType",
    "Expediente de Origen": "originalCaseNumber",
    "Fecha de Resolución de Origen": "originalResolutionDate",
    "Fecha de Denuncia de Origen": "originalComplaintDate",
}
VIEW_STATE = "javax.faces.ViewState"


class StructureError(ValueError):
    """A page that lacks what its kind must have."""


class Node:
    """An element: tag, attributes, children (elements and texts)."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()

    def following(self) -> Node | None:
        """The next element beside this one."""
        if self.parent is None:
            return None
        beside = [c for c in self.parent.children if isinstance(c, Node)]
        k = beside.index(self)
        return beside[k + 1] if k + 1 < len(beside) else None

    def up(self) -> Iterator[Node]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.at = self.root

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        at = self.at
        while at.parent is not None and at.tag != tag:
            at = at.parent
        if at.parent is not None:
            self.at = at.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse_html(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def squeezed(text: str) -> str:
    return " ".join(re.sub("[ ﻿]", " ", text).split())


def find(root: Node, **by: str) -> list[Node]:
    return [n for n in root.walk() if all(n.attrs.get(k.replace("_", "-")) == v for k, v in by.items())]


def counts_in(text: str) -> tuple[int | None, int | None]:
    """(query total, published total) announced in a text."""
    text = squeezed(text)
    both = re.search(r"total de\s+([\d.,]+)\s+resoluciones.*?obtuvieron\s+([\d.,]+)\s+resultados", text, re.I)
    number = lambda s: int(re.sub("[.,]", "", s))
    if both:
        return number(both[2]), number(both[1])
    one = re.search(r"([\d.,]+)\s+resultados", text, re.I)
    return (number(one[1]) if one else None), None


def links(root: Node, kind: str) -> list[str]:
    """Addresses of download links of a kind ('pdf' or 'word'), told by type, text or icon."""
    out = []
    for a in root.walk():
        if a.tag != "a" or not a.attrs.get("href"):
            continue
        icons = " ".join(x.attrs.get("src", "") for x in a.walk() if x.tag in ("img", "input")).lower()
        if a.attrs.get("data-file-type", "").lower() == kind or squeezed(a.text()).lower() == kind or kind in icons:
            out.append(a.attrs["href"])
    return out


_UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.I)


def list_records(root: Node, base_url: str) -> list[dict]:
    """Rows of a result list: elements whose id ends in a row number, with data-field values or label groups, and a detail link."""
    out = []
    rows = [n for n in root.walk() if re.fullmatch(r".*:repeat:\d+:[^:]*", n.attrs.get("id", "")) and (n.has_class("rf-p") or n.has_class("panel") or "data-record" in n.attrs)]
    for at, row in enumerate(rows):
        fields: dict[str, list[str]] = {}
        for n in row.walk():
            if "data-field" in n.attrs:
                fields.setdefault(n.attrs["data-field"], []).append(squeezed(n.text()))
        if not fields:
            heads = [squeezed(s.text()) for h in row.walk() if h.attrs.get("id", "").endswith("_header") for s in h.walk() if s.tag == "span"]
            for name, value in zip(("recurso", "nroexp"), heads, strict=False):
                fields[name] = [value]
            for group in (n for n in row.walk() if n.has_class("marginb")):
                label = next((squeezed(n.text()).rstrip(": ") for n in group.walk() if n.has_class("txtbold")), "")
                if label:
                    value = next((squeezed(n.text()) for n in group.walk() if n.has_class("col-md-12") and not n.has_class("txtbold")), "")
                    fields.setdefault(LIST_LABELS.get(label, label), []).append(value)
        if not fields:
            raise StructureError("a row without fields")
        detail = next((a for a in row.walk() if a.tag == "a" and ("data-uuid" in a.attrs or _UUID.search(re.sub(r"\\+u002d", "-", a.attrs.get("onclick", ""), flags=re.I)))), None)
        if detail is None or not detail.attrs.get("id"):
            raise StructureError("a row without a detail link")
        native = detail.attrs.get("data-uuid") or _UUID.search(re.sub(r"\\+u002d", "-", detail.attrs["onclick"], flags=re.I))[0]
        pdf = links(row, "pdf")
        out.append({"native_id": native, "record_index": int(re.search(r":repeat:(\d+):", row.attrs["id"])[1]), "row": at, "fields": fields, "detail_source": detail.attrs["id"], "pdf_url": urljoin(base_url, pdf[0]) if pdf else None})
    return out


def historical_records(root: Node, base_url: str) -> list[dict]:
    """Rows of the historical list: one per file link, the first of each identifier counting; the row's text is kept as a field."""
    out, seen = [], set()
    for a in root.walk():
        if a.tag != "a" or "href" not in a.attrs:
            continue
        about = " ".join([a.attrs.get("title", ""), a.attrs.get("data-file-type", ""), squeezed(a.text()), *(" ".join((n.attrs.get("src", ""), n.attrs.get("alt", ""), n.attrs.get("title", ""))) for n in a.walk() if n.tag in ("img", "input"))]).lower()
        url = urljoin(base_url, a.attrs["href"])
        ids = parse_qs(urlsplit(url).query).get("uuid", [])
        if "pdf" not in about or not ids:
            continue
        if len(ids) != 1 or not _UUID.fullmatch(ids[0]):
            raise StructureError("a file link without a valid identifier")
        if (key := ids[0].lower()) in seen:
            continue
        seen.add(key)
        box = next((n for n in a.up() if n.tag == "tr" or n.has_class("row") or "repeat" in n.attrs.get("id", "")), a.parent)
        words = squeezed(box.text())
        out.append({"native_id": key, "record_index": None, "row": len(out), "fields": {"historicalRow": [words]} if words else {}, "detail_source": None, "pdf_url": url})
    return out


def pagination(root: Node, html: str, rows: int, total: int | None, page_size: int, requested: int = 1, strict_end: bool = True) -> dict:
    """Current page, number of pages and end signal: from attributes, else from script text, else inferred from the total."""
    scroller = next((n for n in root.walk() if "data-max-value" in n.attrs or "data-current-page" in n.attrs or n.has_class("rf-ds")), None)
    inferred = max(1, -(-total // page_size)) if total is not None else 1

    def number(attr: str, name: str, default: int) -> int:
        raw = (scroller.attrs.get(attr) if scroller is not None else None) or next(iter(re.findall(rf"[\"']?{name}[\"']?\s*:\s*(\d+)", html)), None)
        return int(raw) if raw is not None and raw.isdigit() else default

    current, pages = number("data-current-page", "currentPage", requested), number("data-max-value", "maxValue", inferred)
    if current < 1 or pages < 1 or current > pages:
        raise StructureError("the current page lies behind the last")
    ids = [n.attrs.get("id", "") for n in root.walk()]
    has_next, has_last = any(i.endswith("_ds_next") for i in ids), any(i.endswith("_ds_l") for i in ids)
    end = current == pages and 1 <= rows <= page_size and (not strict_end or not (has_next or has_last))
    return {"current_page": current, "max_pages": pages, "has_next": has_next, "has_last": has_last, "end_signal": "natural_end" if end else "more"}


def detail_fields(root: Node) -> dict[str, list[str]]:
    """Label-value pairs of a detail panel: dt and dd, or bold labels beside their data."""
    out: dict[str, list[str]] = {}
    for n in root.walk():
        if n.tag == "dt":
            beside = n.following()
            out.setdefault(squeezed(n.text()).rstrip(": "), []).append(squeezed(beside.text()) if beside is not None and beside.tag == "dd" else "")
    if not out:
        for n in root.walk():
            if n.has_class("txtbold"):
                label = re.sub(r"^\*+\s*", "", squeezed(n.text())).rstrip(": ")
                beside = n.following()
                if label:
                    out.setdefault(label, []).append(next((squeezed(x.text()) for x in beside.walk() if x.has_class("data")), "") if beside is not None else "")
    if not out:
        raise StructureError("a detail without labelled values")
    return out


def form_controls(root: Node, form_id: str | None = None) -> tuple[dict, list[tuple[str, str]]]:
    """A form's action, method and successful controls in document order, repeats kept. Exactly one form, at most one view state."""
    forms = [n for n in root.walk() if n.tag == "form" and (form_id is None or n.attrs.get("id") == form_id)]
    if len(forms) != 1:
        raise StructureError("no form" if not forms else "more than one form")
    form, out = forms[0], []
    for n in form.walk():
        name = n.attrs.get("name")
        if not name or n.tag not in ("input", "select", "textarea") or "disabled" in n.attrs or any(u.tag in ("fieldset", "optgroup", "select") and "disabled" in u.attrs for u in n.up()):
            continue
        kind = n.attrs.get("type", "text").lower()
        if n.tag == "select":
            options = [o for o in n.walk() if o.tag == "option"]
            chosen = [o for o in options if "selected" in o.attrs] or ([] if "multiple" in n.attrs else options[:1])
            out += [(name, o.attrs.get("value", o.text())) for o in chosen if "disabled" not in o.attrs and not (o.parent.tag == "optgroup" and "disabled" in o.parent.attrs)]
        elif n.tag == "textarea":
            out.append((name, n.text()))
        elif kind in ("checkbox", "radio"):
            if "checked" in n.attrs:
                out.append((name, n.attrs.get("value", "on")))
        elif kind not in ("button", "file", "image", "reset", "submit"):
            out.append((name, n.attrs.get("value", "")))
    if sum(n == VIEW_STATE for n, _ in out) > 1:
        raise StructureError("more than one view state")
    return {"action": form.attrs.get("action", ""), "method": "POST" if form.attrs.get("method", "").upper() == "POST" else "GET", "id": form.attrs.get("id")}, out


def partial_response(xml: str, strict: bool = False) -> dict:
    """{kind, updates, url, name, message} of a partial response. Strict: no document type, no repeated update."""
    if strict and re.search("<!DOCTYPE", xml, re.I):
        raise StructureError("a document type is not allowed")
    try:
        root = ElementTree.fromstring(xml.strip().encode())
    except ElementTree.ParseError as e:
        raise StructureError("no valid XML") from e
    if root.tag != "partial-response":
        raise StructureError("no partial response")
    if (redirect := root.find("redirect")) is not None:
        if not redirect.get("url"):
            raise StructureError("a redirect without address")
        return {"kind": "redirect", "url": redirect.get("url"), "updates": {}, "name": None, "message": None}
    if (error := root.find("error")) is not None:
        return {"kind": "error", "name": squeezed(error.findtext("error-name") or "") or "unknown", "message": redacted_error(squeezed(error.findtext("error-message") or "")), "updates": {}, "url": None}
    updates: dict[str, str] = {}
    for u in root.findall("changes/update"):
        if u.get("id") is None:
            if strict:
                raise StructureError("an update without id")
            continue
        if strict and u.get("id") in updates:
            raise StructureError("a repeated update")
        updates[u.get("id")] = "".join(u.itertext())
    if not updates:
        raise StructureError("no updates")
    return {"kind": "updates", "updates": updates, "url": None, "name": None, "message": None}


def body_html(body: str, panel: str | None = None) -> str:
    """The HTML of a captured body: itself, or the updates of a partial response (one panel of it)."""
    if not re.match(r"\s*(?:<\?xml[^>]*>\s*)?(?:<!--.*?-->\s*)*<partial-response[\s>]", body, re.I | re.S):
        return body
    got = partial_response(body)
    if got["kind"] != "updates":
        raise StructureError(f"unexpected {got['kind']}")
    if panel is not None:
        if not got["updates"].get(panel):
            raise StructureError("the panel is missing")
        return got["updates"][panel]
    return "\n".join(v for i, v in got["updates"].items() if VIEW_STATE not in i)


ROWS = "page_key string, native_id string, record_index int, row int, fields map<string,array<string>>, detail_source string, pdf_url string, error string"
PAGES = "page_key string, current_page int, max_pages int, has_next boolean, has_last boolean, end_signal string, query_total long, published_total long, rows int, ids array<string>, error string"
DETAILS = "page_key string, fields map<string,array<string>>, pdf_url string, word_url string, error string"
CONTROLS = "page_key string, action string, method string, position int, name string, value string, error string"


def _over(pages: DataFrame, key: str, html: str, schema: str, one, strict: bool) -> DataFrame:  # noqa: ANN001
    names = [p.split()[0] for p in re.sub(r"<[^>]*>+", "", schema).split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[dict] = []
            for page, body in zip(pdf["page_key"], pdf["html"], strict=True):
                try:
                    if body is None:
                        raise StructureError("no body")
                    rows += [{"page_key": page, **r} for r in one(body)]
                except StructureError as e:
                    if strict:
                        raise
                    rows.append({"page_key": page, "error": str(e)})
            yield pd.DataFrame(rows, columns=names).astype(object).where(lambda x: x.notna(), None) if rows else pd.DataFrame({n: pd.Series(dtype=object) for n in names})

    return pages.select(F.col(key).cast("string").alias("page_key"), F.col(html).alias("html")).mapInPandas(run, schema)


def page_rows(pages: DataFrame, key: str, html: str, base_url: str, historical: bool = False, strict: bool = False) -> DataFrame:
    """The records of captured list pages. A page without the structure fails (strict) or gives one row with the error."""
    return _over(pages, key, html, ROWS, lambda b: (historical_records if historical else list_records)(parse_html(body_html(b)), base_url), strict)


def page_states(pages: DataFrame, key: str, html: str, base_url: str, page_size: int = 10, historical: bool = False, strict: bool = False) -> DataFrame:
    """Totals, pagination and end signal of captured list pages."""

    def one(body: str) -> list[dict]:
        markup = body_html(body)
        root = parse_html(markup)
        total, published = counts_in(root.text())
        rows = (historical_records if historical else list_records)(root, base_url)
        if total and not rows:
            raise StructureError("results without rows")
        return [{**pagination(root, markup, len(rows), total, page_size, strict_end=not historical), "query_total": total, "published_total": published, "rows": len(rows), "ids": [r["native_id"] for r in rows]}]

    return _over(pages, key, html, PAGES, one, strict)


def page_details(pages: DataFrame, key: str, html: str, base_url: str, panel: str | None = None, strict: bool = False) -> DataFrame:
    """Label-value pairs and file links of captured detail pages."""

    def one(body: str) -> list[dict]:
        root = parse_html(body_html(body, panel))
        pdf, word = links(root, "pdf"), links(root, "word")
        return [{"fields": detail_fields(root), "pdf_url": urljoin(base_url, pdf[0]) if pdf else None, "word_url": urljoin(base_url, word[0]) if word else None}]

    return _over(pages, key, html, DETAILS, one, strict)


def detail_names(details: DataFrame) -> DataFrame:
    """(page_key, known, unknown): the fields of details by their semantic names, and labels without one, which are never lost."""
    split = split_known("fields", DETAIL_LABELS).alias("_s")
    return details.filter("error is null").select("page_key", split).select("page_key", "_s.known", "_s.unknown")


def page_controls(pages: DataFrame, key: str, html: str, form_id: str | None = None, strict: bool = False) -> DataFrame:
    """One row per successful control of a page's form, in document order."""

    def one(body: str) -> list[dict]:
        form, pairs = form_controls(parse_html(body), form_id)
        return [{"action": form["action"], "method": form["method"], "position": k, "name": n, "value": v} for k, (n, v) in enumerate(pairs)]

    return _over(pages, key, html, CONTROLS, one, strict)


def page_updates(pages: DataFrame, key: str, xml: str, strict: bool = False, lenient: bool = False) -> DataFrame:
    """(page_key, kind, updates as JSON, url, name, message, error) of captured partial responses.

    lenient: document types and updates without id are passed over, of repeated updates the last counts.
    """

    def one(body: str) -> list[dict]:
        got = partial_response(body, strict=not lenient)
        return [{**got, "updates": json.dumps(got["updates"], ensure_ascii=False)}]

    return _over(pages, key, xml, "page_key string, kind string, updates string, url string, name string, message string, error string", one, strict)


def apply_updates(document: str, updates: dict[str, str]) -> str:
    """A stored page with the elements of partial updates replaced by id; an update without an element is an error."""
    for ident, markup in updates.items():
        if VIEW_STATE in ident:
            document, n = re.subn(rf'(name="{re.escape(VIEW_STATE)}"[^>]*value=")[^"]*', lambda m, v=markup: m[1] + v.strip(), document)
            continue
        start = re.search(rf'<(\w+)[^>]*\bid="{re.escape(ident)}"[^>]*>', document)
        if start is None:
            raise StructureError(f"nothing to update: {ident}")
        depth, end = 1, start.end()
        for t in re.finditer(rf"<(/?){start[1]}\b[^>]*?(/?)>", document[start.end() :]):
            depth += -1 if t[1] else (0 if t[2] else 1)
            if depth == 0:
                end = start.end() + t.end()
                break
        document = document[: start.start()] + markup + document[end:]
    return document
