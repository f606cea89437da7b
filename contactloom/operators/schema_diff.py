"""Target property catalog: what to create, which options to append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators.conflict import enum_options
from contactloom.operators.rows import number_within


def desired_properties(spark: SparkSession) -> DataFrame:
    """The 53 properties the mapping writes and a target may lack, with their field types and options."""
    numbers = {"integer", "decimal"}
    kinds = {p: ("number" if t in numbers else "date" if t == "date" else "string") for _, p, t in rules.CUSTOM_FIELDS}
    names = ["engager_contact_id", "utm_source", "utm_medium", "eventtag", *enum_options(), *rules.CUSTOM_PROPERTIES]
    rows = []
    for n in names:
        kind = "enumeration" if n in enum_options() else kinds.get(n, "string")
        options = [(v, v, i, False) for i, v in enumerate(enum_options().get(n, []))]
        field = rules.FIELD_TYPES.get(n, {"number": "number", "date": "date", "enumeration": "select"}.get(kind, "text"))
        rows.append((n, n.replace("_", " ").title(), kind, field, "contactinformation", options))
    return spark.createDataFrame(
        rows,
        "name string, label string, type string, fieldType string, groupName string, "
        "options array<struct<label:string,value:string,displayOrder:int,hidden:boolean>>",
    )


def desired_options(spark: SparkSession) -> DataFrame:
    """(name, value, ord): options to add to properties the target has already, as ``append_options`` takes them."""
    rows = [(name, value, i) for name, values in rules.NEW_OPTIONS.items() for i, value in enumerate(values)]
    return spark.createDataFrame(rows, "name string, value string, ord bigint")


def diff_properties(desired: DataFrame, existing: DataFrame) -> DataFrame:
    """Status per desired property: ``created`` (missing) or ``skipped`` (exists)."""
    have = existing.select("name").distinct().withColumn("_have", F.lit(True))
    return desired.join(have, "name", "left").select(
        *desired.columns,
        F.when(F.col("_have"), F.lit("skipped")).otherwise(F.lit("created")).alias("status"),
    )


def append_options(existing: DataFrame, new: DataFrame, chunk: int = 1_000_000) -> DataFrame:
    """Options to add per property, numbered after the highest existing order.

    ``existing(name, value, displayOrder)``, ``new(name, value, ord)``; values
    already present are left alone.
    """
    last = existing.groupBy("name").agg(
        F.greatest(F.max(F.coalesce("displayOrder", F.lit(0))), F.lit(0)).alias("_max")
    )
    missing = new.join(existing.select("name", "value"), ["name", "value"], "left_anti")
    numbered = number_within(missing, "name", "ord", "_rn", chunk)
    return numbered.join(last, "name").select(
        "name", "value", (F.col("_max") + F.col("_rn")).cast("bigint").alias("displayOrder")
    )


def custom_properties(existing: DataFrame) -> DataFrame:
    """Properties that are not built in, sorted by name."""
    return existing.where(~F.col("hubspotDefined")).orderBy("name")


def type_counts(existing: DataFrame) -> DataFrame:
    """Properties per type, split into built-in and custom."""
    return existing.groupBy("type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("hubspotDefined")).alias("built_in"),
        F.count_if(~F.col("hubspotDefined")).alias("custom"),
    )
