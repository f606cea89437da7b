"""Match mapped records to target records by id, e-mail, then phone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import text as T
from contactloom.operators.rows import spread_nulls

KEY_KINDS = ["email", "phone", "engager_contact_id"]  # fixed value: tie order per row


def wanted_keys(mapped: DataFrame) -> DataFrame:
    """Distinct keys the mapped records will look up."""
    keys = F.array(T.email_key(F.col("email")), T.phone_key(F.col("phone")), T.phone_key(F.col("id")))
    return mapped.select(F.explode(keys).alias("key")).where(F.col("key").isNotNull()).distinct()


def key_index(target: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``key -> hs_id`` over e-mails, phones and source ids in one namespace.

    Of several target rows with the same key the one with the highest ``ord``
    counts.  Each target row is read once and exploded to its keys.  With
    ``wanted`` (a small delta against a large target) only those keys are kept
    before anything is shuffled, provided Spark measures them small enough to
    broadcast.
    """
    keys = F.array(
        *[
            F.struct(k.alias("key"), F.lit(i).alias("kind"))
            for i, k in enumerate(
                [
                    T.email_key(F.col("email")),
                    T.phone_key(F.col("phone")),
                    T.phone_key(F.col("engager_contact_id")),
                ]
            )
        ]
    )
    exploded = (
        target.select("hs_id", "ord", F.explode(keys).alias("k"))
        .select("hs_id", "ord", "k.*")
        .where(F.col("key").isNotNull())
    )
    if wanted is not None:
        exploded = exploded.join(wanted, "key", "left_semi")
    return exploded.groupBy("key").agg(F.max_by("hs_id", F.struct("ord", "kind")).alias("hs_id"))


def match_chain(direct: Column, by_email: Column, by_phone: Column, reachable: Column):
    """Action, target id and the key that matched."""
    action = (
        F.when(direct.isNotNull() | by_email.isNotNull() | by_phone.isNotNull(), F.lit("update"))
        .when(reachable, F.lit("insert"))
        .otherwise(F.lit("unresolvable"))
    )
    hs_id = F.coalesce(direct, by_email, by_phone)
    matched_on = (
        F.when(direct.isNotNull(), F.lit(rules.MATCHED_ON[0]))
        .when(by_email.isNotNull(), F.lit(rules.MATCHED_ON[1]))
        .when(by_phone.isNotNull(), F.lit(rules.MATCHED_ON[2]))
    )
    return action, hs_id, matched_on


def match_to_target(
    mapped: DataFrame, target: DataFrame, use_source_id: bool = False, small_delta: bool = False
) -> DataFrame:
    """Add ``action``, ``hs_id``, ``matched_on`` and ``reason``.

    Two left joins against the key index (one row per key).  Rows without a key
    get a private join value, so missing e-mails do not pile up in one task.
    ``small_delta`` narrows the index to the keys of ``mapped`` (stage it first:
    it is then read twice).
    """
    index = key_index(target, wanted_keys(mapped) if small_delta else None)
    email = T.email_key(F.col("email"))
    phone = T.phone_key(F.col("phone"))
    joined = (
        mapped.withColumn("_ek", spread_nulls(email, F.col("ord")))
        .withColumn("_pk", spread_nulls(phone, F.col("ord")))
        .join(index.select(F.col("key").alias("_ek"), F.col("hs_id").alias("_by_email")), "_ek", "left")
        .join(index.select(F.col("key").alias("_pk"), F.col("hs_id").alias("_by_phone")), "_pk", "left")
    )
    by_phone = F.col("_by_phone")
    if use_source_id:
        joined = joined.withColumn("_sk", spread_nulls(T.phone_key(F.col("id")), F.col("ord"))).join(
            index.select(F.col("key").alias("_sk"), F.col("hs_id").alias("_by_source")), "_sk", "left"
        )
    reachable = email.isNotNull() | phone.isNotNull()
    action, hs_id, matched_on = match_chain(
        F.col("hs_contact_id"), F.col("_by_email"), by_phone, reachable
    )
    if use_source_id:
        late = F.col("_by_source").isNotNull() & hs_id.isNull()
        matched_on = F.when(late, F.lit("engager_contact_id")).otherwise(matched_on)
        action = F.when(late, F.lit("update")).otherwise(action)
        hs_id = F.coalesce(hs_id, F.col("_by_source"))
    return joined.select(
        *mapped.columns,
        action.alias("action"),
        hs_id.alias("hs_id"),
        matched_on.alias("matched_on"),
        F.when(action == "unresolvable", F.lit(rules.UNRESOLVABLE_REASON)).alias("reason"),
    )


def action_counts(matched: DataFrame) -> DataFrame:
    return matched.groupBy("action", F.coalesce("matched_on", F.lit("-")).alias("matched_on")).agg(
        F.count(F.lit(1)).alias("n")
    )


def rows_for_keys(target: DataFrame, keys: DataFrame, key_col: str, columns: list[str]) -> DataFrame:
    """Target rows whose ``key_col`` is among ``keys`` (distinct, blanks dropped)."""
    wanted = keys.select(T.blank_to_null(F.col(keys.columns[0])).alias(key_col)).where(
        F.col(key_col).isNotNull()
    )
    return target.select(*dict.fromkeys([key_col, *columns])).join(wanted, key_col, "left_semi")
