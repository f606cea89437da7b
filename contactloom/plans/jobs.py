"""User-level jobs: the operators composed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators import conflict, links, matching, profile, upsert, windows
from contactloom.operators.clean import clean_contacts
from contactloom.operators.mapping import map_contacts
from contactloom.operators.owners import assign_owners
from contactloom.operators.rows import keep_first
from contactloom.sources.staging import stage


def prepare(contacts: DataFrame, owner_map: DataFrame | None = None) -> DataFrame:
    """Clean, map and assign owners.

    Every pick of a first or last row needs the input order, so a null ``ord`` ends the
    job instead of blanking rows.
    """
    if "ord" not in contacts.columns:
        raise ValueError("contacts need a column ord, their place in the input; the file readers make one")
    told = F.raise_error(F.lit("a contact has no ord; read files with contactloom.sources.contacts")).cast("bigint")
    placed = contacts.withColumn("ord", F.coalesce("ord", told))
    mapped = map_contacts(clean_contacts(placed, keep_issues=False, keep_fields=True), strip=True)
    return mapped if owner_map is None else assign_owners(mapped, owner_map)


def plan_updates(
    contacts: DataFrame,
    target: DataFrame,
    owner_map: DataFrame | None = None,
    allowlist: list[str] | None = None,
    check_enums: bool = True,
    small_delta: bool = False,
    catalog: DataFrame | None = None,
) -> DataFrame:
    """Planned writes (action, target id, properties to write) for raw contacts.

    ``target`` needs ``hs_id, ord`` and the identity columns only.  With a ``catalog`` of the target's properties all
    values are checked against it, else the derived properties against their own options.
    """
    mapped = prepare(contacts, owner_map)
    if small_delta:
        mapped = stage(mapped, wide=True)
    matched = matching.match_to_target(mapped, target, small_delta=small_delta)
    planned = conflict.plan_writes(matched, allowlist)
    if catalog is not None:
        return conflict.check_catalog(stage(planned, wide=True), catalog)
    return conflict.check_options(planned, conflict.enum_options()) if check_enums else planned


def migrate(
    contacts: DataFrame, target: DataFrame, owner_map: DataFrame | None, stage_path: str, failed_path: str | None = None,
    catalog: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One-time migration: (new snapshot, counters).

    The plan is written to ``stage_path`` once; snapshot and counters read it back.
    Rows that could not be written as given go to ``failed_path`` with their reasons.
    """
    writes = stage(plan_updates(contacts, target, owner_map, catalog=catalog), stage_path, wide=True)
    if failed_path is not None:
        upsert.failed_records(target, writes).write.mode("overwrite").parquet(failed_path)
    return upsert.upsert(target, writes), upsert.write_counts(target, writes)


def extract_tier(
    tier: int,
    contacts: DataFrame,
    opportunities: DataFrame | None = None,
    pipeline_id: str | None = None,
    statuses: list[str] | None = None,
    tags: list[str] | None = None,
) -> DataFrame:
    """Contacts of a migration tier, one row per id.

    Tier 1: contacts of a pipeline; tier 2: contacts with a tag; tier 3: all.
    """
    if tier == 1:
        found = links.pipeline_contacts(contacts, opportunities, pipeline_id, statuses)
    elif tier == 2:
        found = windows.tagged(contacts, include=tags)
    elif tier == 3:
        found = contacts
    else:
        raise ValueError(f"tier must be one of {sorted(rules.TIER_NAMES)}")
    return keep_first(found, "id")


def profile_contacts(contacts: DataFrame, fields: list[str]) -> dict[str, DataFrame]:
    """The profiling reports of a contact table."""
    return {
        "field_coverage": profile.field_coverage(contacts, fields),
        "top_tags": profile.top_tags(contacts),
        "custom_fields": profile.custom_field_population(contacts),
        "sample": profile.sample_rows(contacts),
    }


def count_reconciliation(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target row counts and whether they agree within tolerance."""
    counted = source.select(F.lit("s").alias("side")).unionAll(target.select(F.lit("t").alias("side")))
    from contactloom.operators.runs import reconcile_counts

    return counted.agg(
        F.count_if(F.col("side") == "s").alias("source_rows"),
        F.count_if(F.col("side") == "t").alias("target_rows"),
    ).select(
        "source_rows", "target_rows",
        reconcile_counts(F.col("source_rows"), F.col("target_rows")).alias("within_tolerance"),
    )
