"""Requests, redirects, form controls and retry timing as columns over logged attempts and captured pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

#: Response codes that may pass by themselves.
TRANSIENT_STATUSES = (408, 425, 500, 502, 503, 504)
_PAIR = "name"


def url_part(c: Column | str, part: str, key: str | None = None) -> Column:
    """Part of a URL, null where it is none."""
    return F.try_parse_url(_col(c), F.lit(part), F.lit(key)) if key else F.try_parse_url(_col(c), F.lit(part))


def url_uuid(c: Column | str) -> Column:
    """The uuid parameter of a download address, in lower case."""
    return F.lower(url_part(c, "QUERY", "uuid"))


def safe_request(c: Column | str, origin: str, path: str) -> Column:
    """True where the address has this origin and path, no user, no fragment and exactly one parameter, a uuid."""
    query = url_part(c, "QUERY")
    ok = (
        (F.concat(F.lower(url_part(c, "PROTOCOL")), F.lit("://"), F.lower(url_part(c, "AUTHORITY"))) == origin.lower())
        & (url_part(c, "PATH") == path)
        & url_part(c, "REF").isNull()
        & query.rlike(r"(?i)^uuid=[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
    )
    return F.coalesce(ok, F.lit(False))


def private_host(host: Column) -> Column:
    """Loopback, link-local and private addresses, and localhost by any name."""
    h = F.regexp_replace(F.lower(host), r"\.$", "")
    return h.rlike(r"^(?:.*\.)?localhost$|^(?:0|10|127)(?:\.\d+){3}$|^169\.254(?:\.\d+){2}$|^192\.168(?:\.\d+){2}$|^172\.(?:1[6-9]|2\d|3[01])(?:\.\d+){2}$|^\[(?:::1|f[cd].*|fe80:.*)\]$")


def redirect_verdict(target: Column | str, host: str, prefix: str) -> Column:
    """Why a redirect is refused ('ok' where it is not): invalid, userinfo, scheme, private host, path or origin. http counts as https."""
    scheme, authority = F.lower(url_part(target, "PROTOCOL")), F.lower(url_part(target, "AUTHORITY"))
    name = F.lower(url_part(target, "HOST"))
    return (
        F.when(scheme.isNull() | authority.isNull(), "invalid")
        .when(authority.contains("@"), "userinfo")
        .when(~scheme.isin("http", "https"), "scheme")
        .when(private_host(name), "private host")
        .when(~F.coalesce(url_part(target, "PATH").startswith(prefix), F.lit(False)), "path")
        .when(authority != host.lower(), "origin")
        .otherwise("ok")
    )


def encode_pairs(pairs: Column | str) -> Column:
    """Ordered name-value pairs as a form body; repeated names stay."""
    return F.array_join(F.transform(_col(pairs), lambda p: F.concat(F.url_encode(p["name"]), F.lit("="), F.url_encode(p["value"]))), "&")


def set_control(pairs: Column | str, name: str, value: Column | str) -> Column:
    """The pairs with one control set: in its first place, other pairs of the name dropped; at the end where it is new."""
    pairs, value = _col(pairs), F.lit(value) if isinstance(value, str) else value
    made = F.struct(F.lit(name).alias("name"), value.alias("value"))
    at = F.array_position(F.transform(pairs, lambda p: p["name"]), name)
    numbered = F.transform(pairs, lambda p, i: F.struct(p.alias("p"), (i + 1).alias("i")))
    kept = F.filter(numbered, lambda x: (x["p"]["name"] != name) | (x["i"] == at))
    swapped = F.transform(kept, lambda x: F.when(x["i"] == at, made).otherwise(F.struct(x["p"]["name"].alias("name"), x["p"]["value"].alias("value"))))
    return F.when(at > 0, swapped).otherwise(F.concat(pairs, F.array(made)))


def retry_after_ms(header: Column | str, now: Column) -> Column:
    """Milliseconds to wait by a Retry-After header: seconds, or a date held against ``now``; null where it is neither."""
    text = F.trim(_col(header))
    when = F.try_to_timestamp(F.substring(text, 6, 64), F.lit("dd MMM yyyy HH:mm:ss zzz"))
    seconds = text.rlike(r"^\d+$")
    return F.when(seconds, text.try_cast("long") * 1000).when(when.isNotNull(), F.greatest(F.lit(0), F.unix_millis(when) - F.unix_millis(now)))


def backoff_cap_ms(attempt: Column | str, base_ms: int, most_ms: int) -> Column:
    """Largest delay of an attempt: doubled each time, up to a cap."""
    doubled = F.lit(float(base_ms)) * F.pow(F.lit(2.0), F.greatest(F.lit(0), _col(attempt) - 1).cast("double"))
    return F.least(F.lit(float(most_ms)), doubled).cast("long")


def backoff_ms(attempt: Column | str, base_ms: int, most_ms: int, draw: Column) -> Column:
    """Full jitter: a share ``draw`` from 0 up to 1 of the cap; pass F.rand(seed) or a logged number."""
    return F.floor(draw * (backoff_cap_ms(attempt, base_ms, most_ms) + 1)).cast("long")


def classify_status(status: Column | str) -> Column:
    """Class of a response code; null for success."""
    s = _col(status)
    return F.when(s == 429, "rate_limit").when(s == 403, "access").when(s.isin(*TRANSIENT_STATUSES), "http_transient").when(s >= 400, "http_permanent")


def status_verdict(status: Column | str, attempt: Column | str, preflight: Column, empty_body: Column | None = None, panel_missing: Column | None = None) -> Column:
    """{class, retryable, restart} of a logged response; the class is null for success.

    A refused access is worth one more try with a new session, except before the session began; an empty server error and a success
    without the expected panel mean that the session is gone. Null conditions count as false.
    """
    s, first = _col(status), ~F.coalesce(preflight, F.lit(False)) & (_col(attempt) == 1)
    holds = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    gone, lacking = (s == 500) & holds(empty_body), (s == 200) & holds(panel_missing)
    kind = F.when(gone, "session_invalid").when(lacking, "structural").otherwise(classify_status(s))
    restart = gone | lacking | ((s == 403) & first)
    return F.struct(kind.alias("class"), F.coalesce(restart | kind.isin("rate_limit", "http_transient"), F.lit(False)).alias("retryable"), F.coalesce(restart, F.lit(False)).alias("restart"))
