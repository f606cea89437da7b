"""What an update may write: identity fields never, owned fields only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.sources.staging import stage


def plan_writes(
    matched: DataFrame, allowlist: list[str] | None = rules.UPDATE_ALLOWLIST
) -> DataFrame:
    """Null out what an update must not write; inserts stay untouched.

    Adds ``withheld`` (names of suppressed properties) and ``no_change`` (an
    update with nothing left).  ``allowlist=None`` is the one-time migration:
    only identity fields are held back and nothing is reported as withheld.
    """
    columns = matched.columns
    props = [p for p in rules.PROPERTIES if p in columns]
    is_update = F.col("action") == "update"
    writable = [
        p
        for p in props
        if p not in rules.IDENTITY_PROPERTIES and (allowlist is None or p in allowlist)
    ]
    suppressed = [p for p in props if p not in writable and p not in rules.IDENTITY_PROPERTIES]
    kept = [
        c if c in writable or c not in props else F.expr(f"CASE WHEN action <> 'update' THEN {c} END AS {c}")
        for c in columns
    ]
    withheld = F.array_compact(
        F.array(
            *[F.expr(f"CASE WHEN action = 'update' AND {p} IS NOT NULL THEN '{p}' END") for p in suppressed],
            F.lit(None).cast("string"),
        )
    )
    nothing_left = F.expr(" AND ".join(f"{p} IS NULL" for p in writable))
    # without an allowlist even an empty payload is sent, as in the migration
    no_change = is_update & nothing_left & F.lit(allowlist is not None)
    return matched.select(*kept, withheld.alias("withheld"), no_change.alias("no_change"))


def without_fields(df: DataFrame, bad_fields: str) -> DataFrame:
    """Null every property named in the array column ``bad_fields``."""
    return df.selectExpr(
        *[
            f"CASE WHEN NOT array_contains({bad_fields}, '{c}') THEN {c} END AS {c}"
            if c in rules.PROPERTIES
            else c
            for c in df.columns
        ]
    )


def _one_of(legal: list[str]):
    return lambda member: member.isin(*legal)


def invalid_fields(options: dict[str, list[str]], multi: set[str] = frozenset()):
    """Array of enumeration properties whose value is not a legal option."""
    checks = []
    for prop, legal in options.items():
        if prop in multi:
            ok = F.forall(F.split(F.col(prop), ";"), _one_of(legal))
        else:
            ok = F.col(prop).isin(*legal)
        checks.append(F.when(F.col(prop).isNotNull() & ~ok, F.lit(prop)))
    return F.array_compact(F.array(*checks))


def check_options(
    writes: DataFrame, options: dict[str, list[str]], multi: set[str] = frozenset()
) -> DataFrame:
    """Null illegal enumeration values, keep the row, list the fields cleared."""
    flagged = writes.withColumn("invalid_fields", invalid_fields(options, multi))
    checked = [c for c in flagged.columns if c in options]
    return flagged.selectExpr(
        *[
            f"CASE WHEN NOT array_contains(invalid_fields, '{c}') THEN {c} END AS {c}"
            if c in checked
            else c
            for c in flagged.columns
        ]
    )


def enum_options() -> dict[str, list[str]]:
    return {
        "buyer_tier": rules.TIER_OPTIONS,
        "cancellation_status": rules.CANCELLATION_OPTIONS,
        "fulfillment_status": rules.FULFILLMENT_OPTIONS,
    }


MULTI = "checkbox"  # fixed value: field type of a property that holds several options
CHECKED_TYPES = ("enumeration", "number", "date")  # fixed values: property types that limit their values


def catalog_violations(writes: DataFrame, catalog: DataFrame) -> DataFrame:
    """(ord, name, reason): values the target's property catalogue does not allow.

    ``catalog`` has ``name, type, fieldType, options`` (structs with ``value``).  Written values are unpivoted to (property,
    member), members of multi-select properties one by one; what has no partner among the options is illegal.  Numbers
    and dates must read as such.  Only limited properties are unpivoted; their names are few, whatever the rows.
    """
    rules_of = stage(catalog.where(F.col("type").isin(*CHECKED_TYPES)).select("name", "type", F.coalesce("fieldType", F.lit("")).alias("fieldType")).distinct())
    limited = {r["name"] for r in rules_of.select("name").distinct().collect()}
    props = [p for p in rules.PROPERTIES if p in writes.columns and p in limited]
    if not props:
        return writes.select("ord", F.lit("").alias("name"), F.lit("").alias("reason")).limit(0)
    options = stage(catalog.where("type = 'enumeration'").select("name", F.explode("options.value").alias("member")).distinct())
    values = writes.select("ord", *[F.col(p).cast("string").alias(p) for p in props]).unpivot(["ord"], props, "name", "value")
    typed = values.where("value IS NOT NULL").join(rules_of, "name")
    members = F.when(F.col("fieldType") == MULTI, F.split("value", ";")).otherwise(F.array("value"))
    listed = typed.where("type = 'enumeration'").select("ord", "name", F.explode(members).alias("member"))
    illegal = listed.join(options, ["name", "member"], "left_anti").select("ord", "name", F.lit("value not among the options").alias("reason"))
    readable = F.when(F.col("type") == "number", F.col("value").try_cast("double").isNotNull()).otherwise(F.col("value").try_cast("date").isNotNull())
    unreadable = typed.where((F.col("type") != "enumeration") & ~readable).select(
        "ord", "name", F.concat(F.lit("value is no "), "type").alias("reason")
    )
    return illegal.unionByName(unreadable)


def check_catalog(writes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Null values the catalogue does not allow, keep the row, list the fields cleared.

    ``writes`` is read twice; a row is known by its ``ord``.
    """
    bad = catalog_violations(writes, catalog).groupBy("ord").agg(F.array_sort(F.collect_set("name")).alias("invalid_fields"))
    flagged = writes.join(bad, "ord", "left")
    none = F.array().cast("array<string>")
    return without_fields(flagged.withColumn("invalid_fields", F.coalesce("invalid_fields", none)), "invalid_fields").select(*writes.columns, "invalid_fields")
