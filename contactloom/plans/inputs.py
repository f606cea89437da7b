"""The views as typed contact, target and lookup DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.plans.views import table, view
from contactloom.sources.staging import stage

FIELD_ID = {prop: field_id for field_id, prop, _ in rules.CUSTOM_FIELDS}


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, tags``: distinct tags per contact in first-seen order.

    Tags are reduced to (contact, tag) first, so the list per contact is bounded
    by the number of different tags, not by its events.
    """
    first = view(spark, sf_dir, "tag_first_v")
    return first.groupBy(F.concat(F.lit("c"), "user_id").alias("id")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "tag"))), lambda s: s["tag"]
        ).alias("tags")
    )


def custom_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, customFields``: one bounded array per customer with orders."""
    def text(col: str):
        return F.col(col).cast("variant")

    def field(prop: str, value):
        return F.struct(F.lit(FIELD_ID[prop]).alias("id"), value.alias("value"))

    products = F.concat(
        F.when(F.col("p1") == 1, F.lit("1-URGENT")).otherwise(F.lit("")), F.lit(", "),
        F.when(F.col("p2") == 1, F.lit("2-HIGH")).otherwise(F.lit("")), F.lit(","),
        F.when(F.col("p5") == 1, F.lit(" 5-LOW")).otherwise(F.lit("")),
    )
    as_list = F.array(
        F.when(F.col("p1") == 1, F.lit("1-URGENT")),
        F.when(F.col("p2") == 1, F.lit("2-HIGH")).otherwise(F.lit("")),
        F.when(F.col("p5") == 1, F.lit("5-LOW")),
    )
    date_value = F.coalesce(F.col("date_text").cast("variant"), F.col("date_ms").cast("variant"))
    fields = [
        field("workshop_paid", F.lit("1").cast("variant")),
        field("workshop_total", text("total_text")),
        field("sms_engmt_score", text("score_text")),
        field("workshop_purchase_date", date_value),
        field("preview_purchase_date", text("first_text")),
        field("market_name", text("market_text")),
        field("workshop_payment_status", text("status_text")),
        field("products_purchased", F.when(F.col("k") % 2 == 0, products.cast("variant")).otherwise(as_list.cast("variant"))),
        field("number_of_coaching_sessions_purchased", F.col("n").cast("variant")),
        field("_hubspot_contact_id", text("hs_ref")),
        field("_guest_group_ref", text("guest_ref")),
        field("assigned_coach", F.concat(F.lit("Coach "), (F.col("n") % 16).cast("string")).cast("variant")),
        field("workshop_paid", F.col("total").cast("variant")),
    ]
    return view(spark, sf_dir, "custom_v").select(
        F.concat(F.lit("c"), "k").alias("id"), F.array(*fields).alias("customFields")
    )


def plain_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts without tags and custom fields."""
    c = view(spark, sf_dir, "contacts_v")
    first = F.struct(
        F.lit(True).alias("isFirst"), F.col("utm_raw").alias("utmSource"),
        F.col("session_raw").alias("sessionSource"), F.col("medium_raw").alias("medium"),
    )
    later = F.struct(
        F.lit(False).alias("isFirst"), F.lit("later").alias("utmSource"),
        F.lit("later").alias("sessionSource"), F.lit("later").alias("medium"),
    )
    return c.select(
        *rules.CONTACT_STRING_FIELDS, "ord", F.array(later, first).alias("attributionSource")
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full contacts: strings, attribution, tags, custom fields."""
    return (
        plain_contacts(spark, sf_dir)
        .join(tags(spark, sf_dir), "id", "left")
        .join(custom_fields(spark, sf_dir), "id", "left")
    )


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target snapshot with every property column."""
    t = view(spark, sf_dir, "target_v")
    given = set(t.columns)
    return t.select(
        "hs_id", "ord", "createdate", "hs_last_activity_date",
        *[
            p if p in given else F.expr(f"CAST(NULL AS {rules.property_type(p)}) AS {p}")
            for p in rules.PROPERTIES
        ],
    )


def duplicate_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned contacts as target records (for pair detection).

    They are staged: a condition on a cleaned value would otherwise move below the cleaning and repeat it many times over.
    """
    from contactloom.operators.clean import clean_contacts

    needed = ["firstName", "lastName", "email", "phone", "companyName", "website", "ord"]
    cleaned = clean_contacts(plain_contacts(spark, sf_dir).select(*needed), keep_issues=False)
    second = F.lit(1577836800) + F.col("ord") * 86400
    active = F.lit(1609459200) + (F.col("ord") % 9) * 86400
    return stage(cleaned.select(
        F.concat(F.lit("h"), "ord").alias("hs_id"), "ord", "email", "phone",
        F.col("firstName").alias("firstname"), F.col("lastName").alias("lastname"),
        F.timestamp_seconds(second).alias("createdate"),
        F.when(F.col("ord") % 4 != 0, F.timestamp_seconds(active)).alias("hs_last_activity_date"),
        F.col("companyName").alias("company"), F.col("website").alias("website"),
    ))


def owner_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contactloom.operators.owners import build_owner_map

    return build_owner_map(view(spark, sf_dir, "users_v"), view(spark, sf_dir, "owners_v"))


def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed contacts: one row per event, its type as the only tag."""
    return view(spark, sf_dir, "delta_v").select(
        "ord", "id", F.array("event_type").alias("tags"), "dateUpdated", "event_type", "user_id"
    )


def hot_name_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a target record of one and the same name (for pair detection).

    Two customers share a stem of 8 to 30 characters; the second one's e-mail has an edit, another domain, or the
    @ sign moved.  Some share a phone, some have no e-mail, some domains are near others.  They are dealt to tasks by key.
    """
    stem = F.md5(F.floor(F.col("c_custkey") / 2).cast("bigint").cast("string"))
    g = F.floor(F.col("c_custkey") / 2).cast("bigint")
    local = F.expr("substring(h, 1, cast(8 + g % 23 as int))")
    domain = F.expr("CASE g % 7 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'mail.com' WHEN 2 THEN 'yahoo.com' WHEN 3 THEN 'ymail.com' ELSE 'gmail.com' END")
    second = F.expr("""CASE g % 6 WHEN 0 THEN concat(l, 'x@', d) WHEN 1 THEN concat(substring(l, 2), '@', d)
        WHEN 2 THEN concat(l, 'g@', 'mail.com') WHEN 3 THEN concat(l, '@corp.example') WHEN 4 THEN concat('ab', substring(l, 3), 'c@', d) ELSE concat('zz', l, 'zz@', d) END""")
    phone = F.expr("CASE WHEN g % 11 = 0 THEN concat('+1555', 1000000 + g % 40) END")
    return (
        spark.read.parquet(f"{sf_dir}/customer.parquet").repartition("c_custkey").select("c_custkey", g.alias("g"), stem.alias("h"))
        .select("c_custkey", "g", local.alias("l"), domain.alias("d"))
        .select(
            F.concat(F.lit("h"), "c_custkey").alias("hs_id"), F.col("c_custkey").alias("ord"),
            F.when(F.col("g") % 13 == 5, F.lit(None).cast("string")).when(F.col("c_custkey") % 2 == 0, F.concat("l", F.lit("@"), "d")).otherwise(second).alias("email"),
            phone.alias("phone"), F.lit("Ann").alias("firstname"), F.lit("Lee").alias("lastname"),
            F.timestamp_seconds(F.lit(1577836800) + F.col("c_custkey") * 86400 % 100000000).alias("createdate"),
            F.lit(None).cast("timestamp").alias("hs_last_activity_date"),
        )
    )
