"""Queries of the text and identity problems and their SQL, where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialize, table
from .copies import collapse, copy_members
from .groups import membership_groups
from .history import history_pairs
from .languages import document_languages, mislabelled, passages
from .lookalikes import judged_fields, repaired_fields
from .mixing import mix, share_report
from .packing import fill_report, pack
from .tokens import token_sizes


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = history_pairs(table(spark, d, "documents"))
    return pairs.select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    groups, hashed = collapse(table(spark, d, "composite_records"), "record_id")
    return copy_members(hashed, groups)


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """One row per identity with the number of its copies."""
    groups, _ = collapse(table(spark, d, "composite_records"), "record_id")
    return groups.select("keep_id", "copies")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return judged_fields(table(spark, d, "list_records"), "record_id", ("sala", "sumilla"), table(spark, d, "chambers")).filter("is_case").select("record_id", "field_name")


def p5_chambers(spark: SparkSession, d: str) -> DataFrame:
    """Every record's chamber by its repaired name; null where no clean name is equal."""
    names = table(spark, d, "chambers")
    clean = repaired_fields(table(spark, d, "list_records"), "record_id", ("sala",), names)
    known = names.select("chamber_id", F.upper(F.trim(F.regexp_replace("sala", r"\s+", " "))).alias("match_key"))
    return clean.join(known, "match_key", "left").select("record_id", "clean_text", "chamber_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return membership_groups(table(spark, d, "corpus_memberships")).filter("records > 1").select("partition_id", "membership_token", "group_key")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every text in containers of every capacity."""
    return pack(token_sizes(table(spark, d, "documents")), table(spark, d, "container_capacities"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    return fill_report(p8_containers(spark, d), table(spark, d, "container_capacities"))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return materialize(token_sizes(table(spark, d, "documents")), "token-sizes")


def p9_selection(spark: SparkSession, d: str) -> DataFrame:
    """The mixture, one row per copy of a document."""
    return mix(_sizes(spark, d), table(spark, d, "mixture_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares wanted and reached."""
    sizes, targets = _sizes(spark, d), table(spark, d, "mixture_targets")
    return share_report(mix(sizes, targets), sizes, targets)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return mislabelled(passages(table(spark, d, "documents")))


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every document's languages with their shares and confidence."""
    return document_languages(passages(table(spark, d, "documents")))


def p10_passages(spark: SparkSession, d: str) -> DataFrame:
    """Every passage in one language with its place and confidence."""
    return passages(table(spark, d, "documents")).drop("named")


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_counts": p2_counts, "p5_found": p5_found, "p5_chambers": p5_chambers, "p6_found": p6_found, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_selection": p9_selection, "p9_shares": p9_shares, "p10_found": p10_found, "p10_documents": p10_documents, "p10_passages": p10_passages}


def _field(f: str) -> str:
    raw = f"coalesce({f}, CASE WHEN layout = 'json' THEN coalesce(payload ->> '$.{f}', payload ->> '$.{f.upper()}', payload ->> '$.{f.capitalize()}') ELSE regexp_extract(payload, '(?i)(?:^|[\\n|])\\s*{f}\\s*:([^\\n|]*)', 1) END)"
    return f"lower(regexp_replace(coalesce({raw}, ''), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"


_COPIES = f"WITH c AS (SELECT record_id, concat_ws(chr(31), {', '.join(map(_field, ('expediente', 'sala', 'tipo', 'fecha')))}) AS k FROM composite_records), g AS (SELECT record_id, min(record_id) OVER (PARTITION BY k) AS keep_id FROM c)"

_KEY = "right(regexp_replace(lower({0}), '[^0-9a-f]', '', 'g'), 32)"
_DASHED = "regexp_replace({0}, '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5')"

SQL = {
    "p6_found": f"""WITH RECURSIVE s AS (SELECT DISTINCT partition_id || '|' || {_KEY.format("membership_token")} AS r, unnest([{_KEY.format("document_uuid")}, {_KEY.format("pdf_uuid")}]) AS u FROM corpus_memberships),
e AS (SELECT r, u FROM s WHERE u IS NOT NULL), m AS (SELECT r, u, min(u) OVER (PARTITION BY r) AS f FROM e),
n AS (SELECT f AS a, u AS b FROM m UNION SELECT u, f FROM m),
c(node, label) USING KEY (node) AS (SELECT DISTINCT a, a FROM n UNION SELECT n.b, min(c.label) FROM c JOIN n ON n.a = c.node JOIN recurring.c AS o ON o.node = n.b WHERE c.label < o.label GROUP BY n.b),
g AS (SELECT DISTINCT m.r, c.label FROM m JOIN c ON c.node = m.f), k AS (SELECT *, count(*) OVER (PARTITION BY label) AS n FROM g)
SELECT split_part(r, '|', 1) AS partition_id, {_DASHED.format("split_part(r, '|', 2)")} AS membership_token, {_DASHED.format("label")} AS group_key FROM k WHERE n > 1""",
    "p2_found": f"{_COPIES} SELECT keep_id, record_id AS dup_id FROM g WHERE record_id <> keep_id",
    "p2_counts": f"{_COPIES} SELECT keep_id, count(*) AS copies FROM g GROUP BY keep_id",
}
