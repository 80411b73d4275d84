"""One pass over captured pages into the corpus tables, and the counts that follow from it."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, text, web
from ..operators import passes
from ..sources.markup import page_rows, page_states
from ..sources.sinks import append_new


def page_documents(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents from list rows: scalar fields are first values; a row without file link has no file."""
    names = identity.renamed_fields("fields")
    return rows.filter("error is null").join(pages, "page_key").select(
        F.lower("native_id").alias("document_id"), "partition_id", F.col("page").alias("source_page"), F.col("row").alias("source_row"), F.try_element_at(names, F.lit("title")).alias("title"), F.try_element_at(names, F.lit("caseNumber")).alias("case_number"),
        F.try_element_at(names, F.lit("resolutionDate")).alias("resolution_date"), F.when(F.col("pdf_url").isNull(), "no_pdf").otherwise("pending").alias("pdf_state"), web.url_uuid("pdf_url").alias("pdf_uuid"), "pdf_url", "fields",
    )


def discover(spark: SparkSession, pages: DataFrame, folder: str, base_url: str, number: int, page_size: int = 10, historical: bool = False) -> dict[str, Any]:
    """Appends the pages' documents and sightings; only new ones are written. A second run over the same pages adds nothing.

    pages: partition_id, page, body.
    """
    keyed = pages.select(F.concat_ws("/", "partition_id", F.col("page").cast("string")).alias("page_key"), "partition_id", "page", "body")
    rows = page_rows(keyed, "page_key", "body", base_url, historical=historical)
    docs = page_documents(rows, keyed.select("page_key", "partition_id", "page"))
    firsts = passes.first_rows(docs, ["document_id"], ["partition_id", "source_page", "source_row"]).drop("occurrences")
    inserted = append_new(firsts, f"{folder}/documents", ["document_id"])
    sightings = docs.select("partition_id", F.lit(number).alias("pass"), F.col("document_id").alias("membership_token"), F.col("document_id").alias("document_uuid"), "pdf_uuid")
    seen = append_new(sightings, f"{folder}/memberships", ["partition_id", "pass", "membership_token"])
    manifest = firsts.select("document_id", "pdf_state")
    states = append_new(manifest, f"{folder}/manifest", ["document_id"])
    return {"inserted": inserted, "sightings": seen, "states": states}


def discovery_summary(pages: DataFrame, base_url: str, page_size: int = 10, historical: bool = False) -> DataFrame:
    """(partition_id, pages, raw, unique_rows, duplicates, initial_total, final_total, drifted, counts_hold,
    repeated_pages, natural_end, errors). counts_hold: without drift the rows seen are the announced total; null where none was announced."""
    keyed = pages.select(F.concat_ws("/", "partition_id", F.col("page").cast("string")).alias("page_key"), "partition_id", "page", "body")
    states = page_states(keyed, "page_key", "body", base_url, page_size, historical).join(keyed.select("page_key", "partition_id", "page"), "page_key")
    ids = states.select("partition_id", "page", F.explode_outer("ids").alias("id"))
    per = states.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("rows"), F.lit(0)).alias("raw"), F.min_by("query_total", F.when(F.col("query_total").isNotNull(), F.col("page"))).alias("initial_total"),
        F.max_by("query_total", F.when(F.col("query_total").isNotNull(), F.col("page"))).alias("final_total"), F.max_by(F.col("end_signal") == "natural_end", "page").alias("natural_end"), F.count("error").alias("errors"),
        (F.count("ids") - F.countDistinct(F.to_json("ids"))).alias("repeated_pages"),
    )
    unique = ids.groupBy("partition_id").agg(F.countDistinct("id").alias("unique_rows"))
    return per.join(unique, "partition_id").select("partition_id", "pages", "raw", "unique_rows", (F.col("raw") - F.col("unique_rows")).alias("duplicates"), "initial_total", "final_total", (~F.col("initial_total").eqNullSafe(F.col("final_total"))).alias("drifted"), (~F.col("initial_total").eqNullSafe(F.col("final_total")) | (F.col("raw") == F.col("final_total"))).alias("counts_hold"), "repeated_pages", "natural_end", "errors")


def file_name(document_id: str, date: str, human: tuple[str, ...]) -> Any:
    """Name of a stored file: id, date and the first filled of some columns, each made safe."""
    return F.concat(F.col(document_id), F.lit("__"), text.safe_segment(date, "sin-fecha", 32), F.lit("__"), text.safe_segment(F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in human]), "documento", 96), F.lit(".pdf"))
