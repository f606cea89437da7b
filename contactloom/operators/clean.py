"""Clean raw contact rows (one projection, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import text as T


def _clean_custom_fields(fields: Column) -> Column:
    """Strip placeholders inside text values; other value types stay as they are."""

    def one(cf: Column) -> Column:
        as_text = F.variant_get(cf["value"], "$", "string")
        is_text = F.schema_of_variant(cf["value"]) == "STRING"
        changed = is_text & F.coalesce(T.strip_placeholder(as_text) != as_text, F.lit(False))
        stripped = T.blank_to_null(T.strip_placeholder(as_text)).cast("variant")
        return F.struct(
            cf["id"].alias("id"), F.when(changed, stripped).otherwise(cf["value"]).alias("value")
        )

    return F.transform(fields, one)


def clean_contacts(df: DataFrame, keep_issues: bool = True, keep_fields: bool = False) -> DataFrame:
    """Add cleaned values and an ``issues`` array of codes, in rule order.

    ``keep_fields`` leaves the custom fields as they are, for a mapping that strips the values it looks up.
    """
    columns = df.columns
    present = [c for c in rules.CONTACT_STRING_FIELDS if c in columns]
    others = [c for c in columns if c not in present and c != "customFields"]
    fields = (
        [_clean_custom_fields(F.col("customFields")).alias("customFields")]
        if "customFields" in columns and not keep_fields
        else [F.col(c) for c in columns if c == "customFields"]
    )
    # each stage names its results, so no later rule repeats an earlier expression
    bare = df.select(
        *others, *present, *fields,
        *[T.strip_placeholder(F.col(c)).alias(f"_s_{c}") for c in present],
    )
    issues = [F.when(F.col(f"_s_{c}") != F.col(c), F.lit(f"placeholder:{c}")) for c in present]
    unchanged = {
        c: F.when(F.col(f"_s_{c}") == F.col(c), F.col(c)).otherwise(T.blank_to_null(F.col(f"_s_{c}")))
        for c in present
    }
    stage = bare.select(
        *others,
        *[v.alias(c) for c, v in unchanged.items()],
        *[c for c in columns if c == "customFields"],
        F.array_compact(F.array(*issues)).alias("_placeholder_issues"),
    )
    html = [c for c in rules.HTML_FIELDS if c in present]
    email = [T.normal_email(F.col("email")).alias("_email")] if "email" in present else []
    phone = [T.salvage_phone(F.col("phone")).alias("_salvaged")] if "phone" in present else []
    stage = stage.select(
        *[T.strip_html(F.col(c)).alias(c) if c in html else F.col(c) for c in stage.columns],
        *email,
        *phone,
    )

    # names, e-mail, phone
    out: dict[str, Column] = {c: F.col(c) for c in present}
    codes: list[Column] = []
    for c in rules.NAME_FIELDS:
        if c in out:
            phone_like = T.looks_like_phone(F.col(c))
            out[c] = F.when(~phone_like, F.col(c))
            codes.append(F.when(phone_like, F.lit(f"phone_as_name:{c}")))
    if "email" in out:
        email_ok = T.is_email(F.col("_email"))
        filled = F.col("email") != ""
        out["email"] = F.when(~filled, F.col("email")).when(email_ok, F.col("_email"))
        codes.append(F.when(filled & ~email_ok, F.lit("invalid_email")))
    if "phone" in out:
        phone = F.col("phone")
        filled = phone != ""
        ok = T.is_e164(phone)
        salvaged = F.col("_salvaged")
        out["phone"] = F.when(~filled | ok, phone).when(filled, salvaged)
        codes.append(
            F.when(filled & ~ok & salvaged.isNotNull(), F.lit("phone_normalized")).when(
                filled & ~ok, F.lit("phone_unparseable")
            )
        )
    result = [out[c].alias(c) if c in out else F.col(c) for c in columns]
    if keep_issues:
        result.append(
            F.concat(F.col("_placeholder_issues"), F.array_compact(F.array(*codes))).alias("issues")
        )
    return stage.select(*result)


def issue_counts(cleaned: DataFrame) -> DataFrame:
    """Rows per cleaning rule.

    A plain ``explode`` makes Spark filter on the size of ``issues`` below the cleaning, where every rule is spelled out
    again; the outer one leaves it to the codes.
    """
    return (
        cleaned.select(F.explode_outer("issues").alias("code"))
        .where("code IS NOT NULL")
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
