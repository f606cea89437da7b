"""Links between records: pipelines and contacts, deals, guest edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.functions import text as T
from contactloom.operators.matching import key_index


def pipeline_contact_ids(opps: DataFrame, pipeline_id: str, statuses: list[str] | None = None) -> DataFrame:
    """Distinct contact ids having an opportunity in the pipeline."""
    hit = opps.where(F.col("pipelineId") == pipeline_id)
    if statuses:
        hit = hit.where(F.col("status").isin(statuses))
    return hit.select("contactId").where(F.col("contactId").isNotNull()).distinct()


def pipeline_contacts(contacts: DataFrame, opps: DataFrame, pipeline_id: str, statuses=None) -> DataFrame:
    ids = pipeline_contact_ids(opps, pipeline_id, statuses).withColumnRenamed("contactId", "id")
    return contacts.join(ids, "id", "left_semi")


def dangling_contacts(contacts: DataFrame, opps: DataFrame) -> DataFrame:
    """Opportunity contact ids with no contact row, with their number of opportunities."""
    per_id = (
        opps.where(F.col("contactId").isNotNull())
        .groupBy("contactId")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_id.join(contacts.select(F.col("id").alias("contactId")), "contactId", "left_anti")


def opportunities_per_pipeline(pipelines: DataFrame, opps: DataFrame) -> DataFrame:
    """Every pipeline with its opportunity count, zero included."""
    counts = opps.groupBy(F.col("pipelineId").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return pipelines.join(counts, "id", "left").select(
        "id", "name", F.coalesce("n", F.lit(0)).alias("n")
    )


def opportunities_of_contacts(contacts: DataFrame, opps: DataFrame) -> DataFrame:
    """Set-wise opportunity lookup; a contact with very many opportunities is split by AQE."""
    return contacts.join(opps, contacts["id"] == opps["contactId"])


def explode_stages(pipelines: DataFrame) -> DataFrame:
    return pipelines.select(
        F.col("id").alias("pipeline_id"), F.explode("stages").alias("s")
    ).select("pipeline_id", F.col("s.id").alias("stage_id"), F.col("s.name").alias("stage_name"))


def map_deals(opps: DataFrame, pipeline_map: DataFrame, stage_map: DataFrame) -> DataFrame:
    """Opportunity -> deal with target pipeline and stage ids; unmapped ids stay null."""
    return (
        opps.join(pipeline_map.select("pipelineId", "deal_pipeline"), "pipelineId", "left")
        .join(stage_map.select("status", "deal_stage"), "status", "left")
        .select(
            F.col("id").alias("opportunity_id"),
            F.col("name").alias("dealname"),
            F.col("monetaryValue").alias("amount"),
            F.col("deal_stage").alias("dealstage"),
            F.col("deal_pipeline").alias("pipeline"),
            F.col("createdAt").alias("createdate"),
            F.col("source").alias("deal_source"),
            "contactId",
        )
    )


def guest_edges(mapped: DataFrame, target: DataFrame, existing: DataFrame) -> DataFrame:
    """Missing guest -> host edges.

    The guest reference is a host e-mail, else a host source id.  The guest's
    own record is found by its source id.  ``existing(from_id, to_id)``.
    Stage ``mapped`` first: the filter and two joins on the reference would
    otherwise decode the custom fields again for each use.
    """
    index = key_index(target)
    guests = mapped.where(F.col("guest_group_ref").isNotNull()).select(
        T.phone_key(F.col("id")).alias("_g"),
        T.trim(F.lower("guest_group_ref")).alias("_he"),
        T.trim(F.col("guest_group_ref")).alias("_hs"),
    )
    edges = (
        guests.join(index.toDF("_g", "from_id"), "_g")
        .join(index.toDF("_he", "_by_email"), "_he", "left")
        .join(index.toDF("_hs", "_by_source"), "_hs", "left")
        .select("from_id", F.coalesce("_by_email", "_by_source").alias("to_id"))
        .where(F.col("to_id").isNotNull() & (F.col("from_id") != F.col("to_id")))
        .distinct()
    )
    return edges.join(existing.select("from_id", "to_id"), ["from_id", "to_id"], "left_anti")
