"""Turn planned writes into a new target snapshot plus run counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators import rows

PROPS = rules.PROPERTIES
NON_IDENTITY = [p for p in PROPS if p not in rules.IDENTITY_PROPERTIES]
NEW_ID = "new:"  # fixed value: prefix of ids given to inserted records
NEW_ROW = "new#"  # the same for records without a source id, followed by their place


def collapse_updates(writes: DataFrame, mode: str = "collapse") -> DataFrame:
    """One update per target record.

    ``collapse`` keeps the last row (one batch of the reference behaviour),
    ``overlay`` lets later rows overlay earlier ones property by property.
    """
    updates = writes.where((F.col("action") == "update") & ~F.col("no_change"))
    narrow = updates.select("hs_id", "ord", *NON_IDENTITY)
    if mode == "overlay":
        return rows.overlay(narrow, "hs_id", NON_IDENTITY)
    return rows.keep_last(narrow, "hs_id")


def _fold(df: DataFrame, key: str) -> DataFrame:
    """Rows sharing ``key`` become one: identity of the first, latest other values."""
    identity = F.min_by(F.struct("id", *rules.IDENTITY_PROPERTIES), "ord").alias("_who")
    return (
        df.groupBy(key)
        .agg(identity, F.min("ord").alias("ord"), *[rows.last_value(p) for p in NON_IDENTITY])
        .select("_who.*", "ord", *NON_IDENTITY)
    )


def fold_inserts(writes: DataFrame) -> DataFrame:
    """Inserts that would collide on e-mail, then on source id, become one record."""
    inserts = writes.where(F.col("action") == "insert").select("id", "ord", *PROPS)
    by_email = _fold(
        inserts.withColumn("_k", rows.spread_nulls(F.col("email"), F.col("ord"))), "_k"
    )
    by_source = _fold(by_email.withColumn("_k", rows.spread_nulls(F.col("id"), F.col("ord"))), "_k")
    return by_source.select(
        F.coalesce(F.concat(F.lit(NEW_ID), "id"), F.concat(F.lit(NEW_ROW), F.col("ord").cast("string"))).alias("hs_id"),
        "ord",
        *PROPS,
    )


def apply_updates(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Overlay non-null update values on the target; blanks never overwrite."""
    changes = updates.selectExpr("hs_id", *[f"{p} AS _u_{p}" for p in NON_IDENTITY])
    overlaid = [
        f"coalesce(CAST(_u_{c} AS {rules.property_type(c)}), {c}) AS {c}" if c in NON_IDENTITY else c
        for c in target.columns
    ]
    return target.join(changes, "hs_id", "left").selectExpr(*overlaid)


def upsert(target: DataFrame, writes: DataFrame, mode: str = "collapse") -> DataFrame:
    """New snapshot: updated target rows plus inserted rows.

    ``writes`` is read twice (updates, inserts); hand in a persisted or written
    DataFrame when its lineage is expensive.
    """
    updated = apply_updates(target, collapse_updates(writes, mode))
    return updated.unionByName(fold_inserts(writes), allowMissingColumns=True)


def unknown_targets(target: DataFrame, writes: DataFrame) -> DataFrame:
    """Updates whose directly given id is not in the target: rejected with a reason."""
    updates = writes.where((F.col("action") == "update") & ~F.col("no_change"))
    return updates.join(target.select("hs_id"), "hs_id", "left_anti").select(
        "id", "hs_id", F.lit("target record not found").alias("reason")
    )


def failed_records(target: DataFrame, writes: DataFrame) -> DataFrame:
    """Every row that was not written as given: ``id, ord, stage, reason, fields``.

    Rows without any key, updates of records the target does not hold, and rows
    whose listed values were cleared because no option allows them.
    """
    def told(rows: DataFrame, stage: str, reason: str, fields=F.lit("")) -> DataFrame:
        return rows.select("id", "ord", F.lit(stage).alias("stage"), F.lit(reason).alias("reason"), fields.alias("fields"))

    keyless = writes.where(F.col("action") == "unresolvable")
    updates = writes.where((F.col("action") == "update") & ~F.col("no_change"))
    unknown = updates.join(target.select("hs_id"), "hs_id", "left_anti")
    out = told(keyless, "match", "no id, e-mail or phone").unionByName(told(unknown, "write", "target record not found"))
    if "invalid_fields" not in writes.columns:
        return out
    cleared = writes.where(F.size("invalid_fields") > 0)
    return out.unionByName(told(cleared, "check", "value not among the options", F.concat_ws(",", "invalid_fields")))


def reject_invalid(df: DataFrame, valid) -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted, rejected with key and reason); null counts as invalid."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)


def write_counts(target: DataFrame, writes: DataFrame) -> DataFrame:
    """One row of counters.

    ``collapsed`` are updates overwritten by a later row for the same record or
    inserts folded into another; ``no_change`` had nothing to write.
    """
    per_kind = writes.agg(
        F.count(F.lit(1)).alias("input"),
        F.count_if(F.col("action") == "unresolvable").alias("skipped"),
        F.count_if(F.col("no_change")).alias("no_change"),
        F.coalesce(F.sum(F.size("withheld")), F.lit(0)).alias("withheld"),
    )
    known = target.select("hs_id", F.lit(1).alias("_known"))
    touched = (
        writes.where((F.col("action") == "update") & ~F.col("no_change"))
        .groupBy("hs_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(known, "hs_id", "left")
        .agg(
            F.count_if(F.col("_known") == 1).alias("updated"),
            F.count_if(F.col("_known").isNull()).alias("failed"),
        )
    )
    created = fold_inserts(writes).agg(F.count(F.lit(1)).alias("inserted"))
    names = ["input", "updated", "inserted", "failed", "skipped", "withheld", "no_change"]
    stacked = per_kind.unionByName(touched, allowMissingColumns=True).unionByName(
        created, allowMissingColumns=True
    )
    total = stacked.agg(*[F.sum(n).cast("bigint").alias(n) for n in names])
    rest = sum((F.col(n) for n in names[2:5] + ["no_change"]), F.col("updated"))
    return total.select(*names, (F.col("input") - rest).alias("collapsed"))
