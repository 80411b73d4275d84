"""Text functions as columns. What the JVM has stays there; Unicode normal forms and nested redaction go through Arrow."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Device names no file may have, keys whose values are secret.
RESERVED_NAME = r"(?i)^(?:con|prn|aux|nul|com[1-9]|lpt[1-9])(?:\.|$)"
SECRET_KEYS = "cookie cookies setcookie authorization proxyauthorization credential credentials password passwd token accesstoken refreshtoken idtoken viewstate javaxfacesviewstate".split()
REDACTED = "[REDACTED]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """White space of every kind, and the byte-order mark, collapsed to single blanks and trimmed."""
    return F.regexp_replace(F.regexp_replace(_col(c), r"(?U)[\s\x{FEFF}]+", " "), "^ | $", "")


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFC", v) if isinstance(v, str) else None)


@F.pandas_udf(T.StringType())
def _nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFKD", v) if isinstance(v, str) else None)


def compose(c: Column | str) -> Column:
    """Canonical composition. Only texts with combining marks, or letters that may have to be reordered, are sent to Python."""
    c = _col(c)
    return F.coalesce(_nfc(F.when(c.rlike(r"[\p{M}\x{0340}-\x{0374}\x{0F00}-\x{0FFF}\x{1100}-\x{11FF}\x{2126}-\x{212B}\x{F900}-\x{FAFF}]"), c)), c)


def normalize(c: Column | str) -> Column:
    """Composed, clean, in lower case: the form in which identities are compared."""
    return F.lower(clean(compose(c)))


def locale_number(c: Column | str) -> Column:
    """A count with thousands separators of either kind; null where it is none."""
    return F.regexp_replace(_col(c), "[.,]", "").try_cast("long")


def totals(c: Column | str) -> Column:
    """{published_total, query_total} announced by a result page's text."""
    text = clean(c)
    both = r"(?is)total de\s+([\d.,]+)\s+resoluciones.*?obtuvieron\s+([\d.,]+)\s+resultados"
    one = r"(?i)([\d.,]+)\s+resultados"
    got = lambda p, g: F.nullif(F.regexp_extract(text, p, g), F.lit(""))
    return F.struct(locale_number(got(both, 1)).alias("published_total"), locale_number(F.coalesce(got(both, 2), got(one, 1))).alias("query_total"))


def record_index(c: Column | str) -> Column:
    """Row number inside an element id of the form ``...:repeat:N:...``."""
    return F.nullif(F.regexp_extract(_col(c), r":repeat:(\d+):", 1), F.lit("")).try_cast("int")


def uuid_within(c: Column | str) -> Column:
    """The first UUID of a text; hyphens may be written as escapes."""
    plain = F.regexp_replace(_col(c), r"(?i)\\+u002d", "-")
    return F.nullif(F.regexp_extract(plain, r"(?i)([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})", 1), F.lit(""))


def first_filled(c: Column | str) -> Column:
    """First value of a list that is not empty."""
    return F.try_element_at(F.filter(_col(c), lambda x: x.isNotNull() & (x != "")), F.lit(1))


#: Schemes that introduce a credential and the characters it may have; parameters of an address and names in an error
#: text whose values are secret.
SCHEMES = ("Bearer", "Basic")
CREDENTIAL = "[A-Za-z0-9._~+/=-]+"
SECRET_PARAMETERS = ("access_token", "accesstoken", "token", "javax.faces.ViewState")
SECRET_STATE = ("javax.faces.ViewState",)
SECRET_NAMES = ("token", "cookie", "authorization")


def _told(lead: str, names: Sequence[str], gap: str, value: str, keep: str = "name and gap") -> tuple[str, str]:
    """A pattern for a value behind one of some names, and what replaces what stands behind its first group: the name and the gap stay
    as they are, the name stays and the gap becomes one blank, or nothing stays. Java and Python read it alike."""
    name = f"{lead}(?:{'|'.join(re.escape(n) for n in names)})"
    return {"name and gap": (f"(?i)({name}{gap}){value}", REDACTED), "name": (f"(?i)({name}){gap}{value}", " " + REDACTED), "nothing": (f"(?i)(){name}{gap}{value}", REDACTED)}[keep]


_IN_TEXT = (_told(r"\b", SCHEMES, r"\s+", CREDENTIAL, keep="name"), _told("[?&]", SECRET_PARAMETERS, "=", r"[^&\s]+"))
_IN_ERRORS = (_told("", SECRET_STATE, r"\s*[=:]\s*", r"\S+"), _told(r"\b", SECRET_NAMES, r"\s*[=:]\s*", r"\S+", keep="nothing"))


def redact(c: Column | str, rules: Sequence[tuple[str, str]] = _IN_TEXT) -> Column:
    """Credentials in running text replaced."""
    return reduce(lambda out, rule: F.regexp_replace(out, rule[0], "$1" + rule[1]), rules, _col(c))


def redact_error(c: Column | str, most: int = 500) -> Column:
    """Error texts of a response: view state and secrets replaced, at most ``most`` characters; blank becomes null."""
    return F.nullif(F.substring(redact(F.trim(_col(c)), _IN_ERRORS), 1, most), F.lit(""))


def redacted_text(v: str, rules: Sequence[tuple[str, str]] = _IN_TEXT) -> str:
    """The same for one text in Python."""
    for pattern, instead in rules:
        v = re.sub(pattern, r"\1" + instead, v)
    return v


def redacted_error(v: str, most: int = 500) -> str:
    """redact_error for one text in Python."""
    return redacted_text(v.strip(), _IN_ERRORS)[:most]


def _redact_value(v: object) -> object:
    if isinstance(v, str):
        return redacted_text(v)
    if isinstance(v, list):
        return [_redact_value(x) for x in v]
    if isinstance(v, dict):
        return {k: REDACTED if re.sub("[^a-z0-9]", "", k.lower()) in SECRET_KEYS else _redact_value(x) for k, x in v.items()}
    return v


@F.pandas_udf(T.StringType())
def redact_json(s: pd.Series) -> pd.Series:
    """A JSON text with secrets replaced by key name at any depth; text that is no JSON is redacted as text."""

    def one(v: str | None) -> str | None:
        if v is None:
            return None
        try:
            return json.dumps(_redact_value(json.loads(v)), ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return _redact_value(v)

    return s.map(one)


#: What may not stand in a file name, by itself or in runs: reserved characters, white space of every kind, hyphens, several dots.
_NAME_BREAK = r'(?U)(?:[\s\x{FEFF}\-\\/:*?"<>|]|\.{2,})+'


def safe_segment(c: Column | str, fallback: str, most: int) -> Column:
    """A file-name part: compatibility-decomposed, without control characters, one hyphen for each run that may not stand in a name,
    no dot, blank or hyphen at its ends, cut to ``most`` characters; the fallback where nothing or a device name is left."""
    c = _col(c)
    plain = F.coalesce(_nfkd(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)
    hyphened = F.regexp_replace(F.regexp_replace(plain, r"\p{Cc}+", ""), _NAME_BREAK, "-")
    part = F.left(F.btrim(hyphened, F.lit(".- ")), F.lit(most))
    usable = (F.length(part) > 0) & ~part.rlike(RESERVED_NAME)
    return F.when(usable, part).otherwise(F.lit(fallback))


def diagnostic_sample(c: Column | str, most: int = 200) -> Column:
    """What a log may show of a body: control characters as blanks, white space collapsed, at most ``most`` characters."""
    return F.substring(clean(F.regexp_replace(_col(c), r"\p{Cc}", " ")), 1, most)


@F.pandas_udf(T.StringType())
def stable_json(s: pd.Series) -> pd.Series:
    """JSON with the keys of every object in order, so that equal values have equal text; null where the text is no JSON."""

    def one(v: str | None) -> str | None:
        try:
            return None if v is None else json.dumps(json.loads(v), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        except ValueError:
            return None

    return s.map(one)
