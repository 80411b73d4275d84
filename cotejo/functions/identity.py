"""Keys, fingerprints and multi-valued fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col, normalize

UUID_PATTERN = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
#: List fields and the names they get.
LIST_FIELDS = {"recurso": "title", "nroexp": "caseNumber", "tipoResolucion": "resolutionType", "fechaResolucion": "resolutionDate", "sumilla": "summary"}


def logical_key(partition: Column | str, token: Column | str, fold_case: bool = True) -> Column:
    """Key of a membership: a struct, so no separator can be forged; tokens compared with or without their case."""
    token = _col(token)
    return F.struct(_col(partition).alias("partition"), (F.lower(token) if fold_case else token).alias("token"))


def composite_identity(fields: Sequence[Column | str]) -> Column:
    """Normalised fields in one text; null where one is missing or blank."""
    parts = [normalize(c) for c in fields]
    filled = F.lit(True)
    for p in parts:
        filled = filled & F.coalesce(p != "", F.lit(False))
    return F.when(filled, F.concat_ws("\x1f", *parts))


def json_hash(value: Column) -> Column:
    """SHA-256 of a value's JSON with the fields in their order and nulls written."""
    return F.sha2(F.to_json(value, {"ignoreNullFields": "false"}), 256)


def page_fingerprints(rows: DataFrame, page: Sequence[str], row: str, parts: Sequence[str]) -> DataFrame:
    """(page..., fingerprint, rows): hash over the parts of a page's rows in row order. Pages have a fixed size, so the list is short."""
    picked = F.struct(F.col(row).alias("_at"), *[F.col(p) for p in parts])
    inner = F.transform(F.array_sort(F.collect_list(picked)), lambda x: x[parts[0]] if len(parts) == 1 else F.struct(*[x[p].alias(p) for p in parts]))
    return rows.groupBy(*page).agg(json_hash(inner).alias("fingerprint"), F.count(F.lit(1)).alias("rows"))


def multi_map(df: DataFrame, keys: Sequence[str], name: str, value: str, order: str) -> DataFrame:
    """(keys..., fields): name-value rows folded to a map of lists, values in order."""
    per = df.groupBy(*keys, name).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(value)))), lambda x: x[value]).alias("_v"), F.min(order).alias("_o"))
    return per.groupBy(*keys).agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("_o", F.col(name).alias("k"), F.col("_v").alias("v")))), lambda x: F.struct(x["k"], x["v"]))).alias("fields"))


def renamed_fields(fields: Column | str, names: Mapping[str, str] = LIST_FIELDS) -> Column:
    """First filled value of each known field under its new name, as a map; missing ones are left out."""
    fields = _col(fields)
    entries = F.array(*[F.struct(F.lit(new).alias("key"), F.nullif(F.try_element_at(F.try_element_at(fields, F.lit(old)), F.lit(1)), F.lit("")).alias("value")) for old, new in names.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def split_known(fields: Column | str, aliases: Mapping[str, str]) -> Column:
    """{known, unknown}: fields whose label has a semantic name under that name (labels of one name put together), and the rest."""
    entries = F.map_entries(_col(fields))
    names = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    named = F.transform(entries, lambda e: F.struct(F.try_element_at(names, e["key"]).alias("n"), e["value"].alias("v")))
    known = F.filter(named, lambda e: e["n"].isNotNull())
    keys = F.array_distinct(F.transform(known, lambda e: e["n"]))
    merged = F.transform(keys, lambda k: F.struct(k.alias("key"), F.flatten(F.transform(F.filter(known, lambda e: e["n"] == k), lambda e: e["v"])).alias("value")))
    rest = F.filter(entries, lambda e: F.try_element_at(names, e["key"]).isNull())
    return F.struct(F.map_from_entries(merged).alias("known"), F.map_from_entries(rest).alias("unknown"))


def overlay(base: Column | str, over: Column | str) -> Column:
    """Two maps as one; where both have a key the second counts."""
    base, over = _col(base), _col(over)
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)
