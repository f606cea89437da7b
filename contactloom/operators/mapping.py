"""Map cleaned contacts to target properties in one projection.

Output: ``id, ord, hs_contact_id, guest_group_ref`` and one column per target
property (``rules.PROPERTIES``); an absent value is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import tags as G
from contactloom.functions import text as T
from contactloom.functions import values as V


def transform_value(name: str, text: str, kind: str, items: str) -> Column:
    """Apply a named transform; arguments are the columns with text, kind and list members."""
    if name == "integer":
        return V.to_integer(text)
    if name == "decimal":
        return V.to_decimal(text)
    if name == "date":
        return V.to_iso_date(text, kind)
    if name == "multi_select":
        return V.to_multi_select(text, kind, items)
    return F.col(text)


def custom_properties(df: DataFrame, fields_col: str = "customFields", strip: bool = False) -> DataFrame:
    """Decode custom fields into property columns; keeps all other columns.

    ``strip`` removes placeholders and outer white space from text values first, as ``clean_contacts`` does.
    Known ids differ in their hashes and others are left out before, so long numbers are compared instead of text; the
    lists run backwards, so the last one of repeated ids is found first.
    """
    keep = [F.col(c) for c in df.columns if c != fields_col]
    ids = [i for i, _, _ in rules.CUSTOM_FIELDS]
    known = F.reverse(F.filter(F.col(fields_col), lambda cf: cf["id"].isin(*ids)))
    listed = df.select(*keep, known.alias("_known"))
    hashed = listed.select(
        *keep, F.transform("_known", lambda cf: F.xxhash64(cf["id"])).alias("_ids"), F.col("_known.value").alias("_values")
    )

    # value, text and kind are named columns, so nothing is looked up or parsed twice
    found = hashed.select(
        *keep, *[F.expr(f"get(_values, CAST(array_position(_ids, xxhash64('{i}')) AS INT) - 1) AS _v_{p}") for i, p, _ in rules.CUSTOM_FIELDS]
    )
    typed = [p for _, p, t in rules.CUSTOM_FIELDS if t in ("date", "multi_select")]
    lists = [p for _, p, t in rules.CUSTOM_FIELDS if t == "multi_select"]
    texts = {p: V.scalar_text(f"_v_{p}") for _, p, _ in rules.CUSTOM_FIELDS}
    if strip:
        texts = {p: F.when(V.is_text(f"_v_{p}"), T.strip_placeholder(V.plain_text(f"_v_{p}"))).otherwise(t) for p, t in texts.items()}
    parsed = found.select(
        *keep,
        *[t.alias(f"_t_{p}") for p, t in texts.items()],
        *[V.value_kind(f"_v_{p}").alias(f"_k_{p}") for p in typed],
        *[V.list_members(f"_v_{p}").alias(f"_a_{p}") for p in lists],
    )
    outs = []
    for _, prop, name in rules.CUSTOM_FIELDS:
        text = f"_t_{prop}"
        filled = F.expr(f"{text} NOT IN ('', ' ')")
        value = F.when(filled, transform_value(name, text, f"_k_{prop}", f"_a_{prop}"))
        if prop.startswith("_"):
            value = T.blank_to_null(T.trim(value))
        outs.append(value.alias(prop))
    return parsed.select(*keep, *outs)


def standard_properties(df: DataFrame) -> list[Column]:
    """Renamed standard fields, timezone, lifecycle stage and first attribution."""
    cols = [T.blank_to_null(F.col(src)).alias(dst) for src, dst in rules.STANDARD_FIELDS]
    cols.append(V.to_timezone(F.col("timezone")).alias("hs_timezone"))
    cols.append(F.lower(T.blank_to_null(F.col("type"))).alias("lifecyclestage"))
    if "attributionSource" in df.columns:
        first = F.try_element_at(
            F.filter(F.col("attributionSource"), lambda a: F.coalesce(a["isFirst"], F.lit(False))),
            F.lit(1),
        )
        cols.append(
            T.blank_to_null(F.coalesce(first["utmSource"], first["sessionSource"])).alias("utm_source")
        )
        cols.append(T.blank_to_null(first["medium"]).alias("utm_medium"))
    return cols


def map_contacts(cleaned: DataFrame, strip: bool = False) -> DataFrame:
    """Cleaned contacts -> wide mapped records; ``strip`` if their custom fields are not cleaned yet."""
    decoded = custom_properties(cleaned, strip=strip)
    tags = F.col("tags")
    props = {c: F.col(c) for c in rules.CUSTOM_PROPERTIES}
    props["market_name"] = V.alias_market(F.col("market_name"), rules.MARKET_ALIASES)
    named = decoded.select(
        "id",
        "ord",
        "assignedTo",
        F.col("_hubspot_contact_id").alias("hs_contact_id"),
        F.col("_guest_group_ref").alias("guest_group_ref"),
        *standard_properties(decoded),
        G.buyer_tier(tags).alias("buyer_tier"),
        G.cancellation_status(tags).alias("cancellation_status"),
        G.fulfillment_status(tags).alias("fulfillment_status"),
        G.event_cities(tags).alias("eventtag"),
        *[v.alias(c) for c, v in props.items()],
        F.lit(None).cast("string").alias("hubspot_owner_id"),
    )
    given = set(named.columns)
    missing = [
        F.expr(f"CAST(NULL AS {rules.property_type(p)}) AS {p}") for p in rules.PROPERTIES if p not in given
    ]
    return named.select(
        "id", "ord", "assignedTo", "hs_contact_id", "guest_group_ref",
        *[p for p in rules.PROPERTIES if p in given], *missing,
    )


def custom_fields_long(df: DataFrame, lookup: DataFrame, fields_col: str = "customFields") -> DataFrame:
    """Generic path: explode fields and join a lookup table ``(id, property)``.

    Used for field sets that are data rather than code; equals the projection of
    ``custom_properties`` before the value transforms.
    """
    one = df.select(
        F.col("id").alias("contact_id"), F.posexplode(fields_col).alias("pos", "cf")
    ).select("contact_id", "pos", F.col("cf.id").alias("id"), F.col("cf.value").alias("value"))
    text = V.scalar_text("value")
    last = one.groupBy("contact_id", "id").agg(
        F.max_by(F.struct(text.alias("text"), V.value_kind("value").alias("kind")), "pos").alias("v")
    )
    return (
        last.join(lookup, "id")
        .select("contact_id", "property", F.col("v.text").alias("text"), F.col("v.kind").alias("kind"))
        .where(F.col("text").isNotNull() & ~F.col("text").isin("", " "))
    )
