"""Owner lookup: build the user -> owner map and assign owners to contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.functions import text as T


def owner_index(owners: DataFrame) -> DataFrame:
    """Owner per lower-case e-mail; of duplicate e-mails the last one counts."""
    return (
        owners.where(F.col("email") != "")
        .groupBy(F.lower("email").alias("owner_email"))
        .agg(F.max_by("id", "ord").alias("owner_id"))
    )


def build_owner_map(users: DataFrame, owners: DataFrame) -> DataFrame:
    """Every user with its ``owner_id``; null owner = unmatched user."""
    keyed = users.withColumn("owner_email", T.blank_to_null(F.lower("email")))
    return keyed.join(owner_index(owners), "owner_email", "left").select(
        F.col("id").alias("user_id"), "name", "email", "owner_id"
    )


def assign_owners(mapped: DataFrame, owner_map: DataFrame) -> DataFrame:
    """Left join on ``assignedTo``.

    The map is no larger than the staff list, but its size is not assumed:
    Spark broadcasts it only when the measured size is below its threshold, and
    splits a hot ``assignedTo`` otherwise.
    """
    lookup = owner_map.where(F.col("owner_id").isNotNull()).select(
        F.col("user_id").alias("assignedTo"), F.col("owner_id").alias("_owner")
    )
    joined = mapped.join(lookup, "assignedTo", "left")
    return joined.select(
        *[
            F.coalesce("_owner", "hubspot_owner_id").alias(c) if c == "hubspot_owner_id" else F.col(c)
            for c in mapped.columns
        ]
    )
