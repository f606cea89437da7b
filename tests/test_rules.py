"""Hand-made rows per rule."""

import pytest
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import tags as G
from contactloom.functions import text as T
from contactloom.functions import values as V
from contactloom.operators.clean import clean_contacts
from contactloom.operators.mapping import map_contacts
from contactloom.sources.contacts import CONTACT_SCHEMA, normalise_attribution


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, want", [
    ("{{ad.name}}", None), (" a ", "a"), ("", ""), ("a {{x}} b", "a  b"), ("\t a　\n", "a"), ("plain", "plain"),
])
def test_placeholder(spark, raw, want):
    assert one(spark, raw, T.clean_placeholder) == want


@pytest.mark.parametrize("raw, want", [("555-1234", True), ("55-123", False), ("Ann", False), ("+1 (555) 010.9", True)])
def test_phone_as_name(spark, raw, want):
    assert one(spark, raw, T.looks_like_phone) is want


@pytest.mark.parametrize("raw, want", [(" A@B.co ", True), ("a@b", False), ("a@b.co\n.", False), ("a b@c.de", False)])
def test_email(spark, raw, want):
    assert one(spark, raw, lambda c: T.is_email(T.normal_email(c))) is want


@pytest.mark.parametrize("raw, want", [
    ("(555) 010-1234", "+15550101234"), ("1-555-010-1234", "+15550101234"),
    ("+44 20 7946 0958", None), ("12345", None),
])
def test_phone(spark, raw, want):
    assert one(spark, raw, T.salvage_phone) == want


@pytest.mark.parametrize("raw, want", [("3.7", 37), ("12-34", 12), ("--5", None), ("abc", None), ("9" * 30, None)])
def test_integer(spark, raw, want):
    assert one(spark, raw, lambda c: V.to_integer("x")) == want


def test_integer_strict(spark):
    assert one(spark, "3.7", lambda c: V.to_integer("x", strict=True)) == 3


@pytest.mark.parametrize("raw, want", [("$1,234.50", 1234.5), ("1.2.3", 1.2), ("-", None), (".5", 0.5), ("5.", 5.0)])
def test_decimal(spark, raw, want):
    assert one(spark, raw, lambda c: V.to_decimal("x")) == want


@pytest.mark.parametrize("raw, kind, want", [
    ("1650000000000", "number", "2022-04-15"), ("1650000000000", "string", None),
    ("2022-07-22T00:00:00.000Z", "string", "2022-07-22"), ("1/5/2024", "string", "2024-01-05"),
    ("13/45/2020", "string", "2020-13-45"), ("2024-02-30", "string", "2024-02-30"), ("soon", "string", None),
    ("-1", "number", "1969-12-31"),
])
def test_date(spark, raw, kind, want):
    df = spark.createDataFrame([(raw, kind)], "t string, k string")
    row = df.select(V.to_iso_date("t", "k").alias("y")).select("y", V.is_calendar_date(F.col("y")).alias("ok")).first()
    assert row["y"] == want
    assert row["ok"] is (want in ("2022-04-15", "2022-07-22", "2024-01-05", "1969-12-31"))


@pytest.mark.parametrize("doc, want", [
    ('["a","",null," b"]', "a; b"), ('"a, b,,c"', "a;b;c"), ('"a;b"', "a;b"), ("5", None), ("[]", None), ('["x",0,3]', "x;3"),
])
def test_multi_select(spark, doc, want):
    df = spark.createDataFrame([(doc,)], "d string").select(F.parse_json("d").alias("v"))
    df = df.select(V.scalar_text("v").alias("t"), V.value_kind("v").alias("k"), V.list_members("v").alias("a"))
    assert df.select(V.to_multi_select("t", "k", "a")).first()[0] == want


@pytest.mark.parametrize("raw, want", [("America/Denver", "america_slash_denver"), ("gmt", "gmt"), ("prince", None), ("", None)])
def test_timezone(spark, raw, want):
    assert one(spark, raw, V.to_timezone) == want


@pytest.mark.parametrize("raw, want", [("1650000000000", 1650000000000), ("1970-01-01T00:00:01Z", 1000), ("x", None)])
def test_epoch_ms(spark, raw, want):
    assert one(spark, raw, V.to_epoch_ms) == want


def test_tags(spark):
    def run(tags, fn):
        return one(spark, tags, fn, "array<string>")

    assert run(["pna", "wb"], G.buyer_tier) == "Workshop Buyer"
    assert run(["telesales_diamond"], G.buyer_tier) == "Telesales Diamond Buyer"
    assert run([], G.buyer_tier) is None and run(None, G.buyer_tier) is None
    assert run(["cancel", "foundations_cancel_reg"], G.cancellation_status) == "Foundations Cancelled"
    assert run(["user_subscribed", "user_created"], G.fulfillment_status) == "Portal Active"
    cities = ["20260330_aus", "x", "20250101_AUS_attended", "20250101_bhm", "20240101_bmh"]
    assert run(cities, G.event_cities) == "Austin;Birmingham;Birmingham"
    assert run(cities, lambda c: G.event_cities(c, True)) == "Austin;Birmingham"
    assert run(["20260330_austin"], G.unknown_city_codes) == ["austi"]
    assert run(["20260330_austin"], G.event_cities) is None
    assert run([None, "hs-to-hl"], lambda c: G.has_any(c, ["hs-to-hl"])) is True
    assert run([None, "a"], lambda c: G.has_any(c, ["hs-to-hl"])) is False


@pytest.mark.parametrize("ms, want", [(45000, "45s"), (83000, "1m 23s"), (-1, "n/a"), (None, "n/a"), (59500, "1m 0s")])
def test_duration(spark, ms, want):
    assert one(spark, ms, T.duration_ms_text, "bigint") == want


def contact(spark, **fields):
    docs = fields.pop("customFields", "[]")
    df = spark.createDataFrame([(1,)], "n int").select(
        F.from_json(F.lit(docs), "array<struct<id:string,value:variant>>").alias("customFields"),
        F.lit(fields.pop("ord", 0)).cast("bigint").alias("ord"),
    )
    for c in rules.CONTACT_STRING_FIELDS:
        df = df.withColumn(c, F.lit(fields.get(c)).cast("string"))
    tags = F.array(*[F.lit(t) for t in fields.get("tags", [])]).cast("array<string>")
    attribution = normalise_attribution("a")
    return df.withColumn("tags", tags).withColumn("a", F.lit(fields.get("attributionSource", "[]"))).withColumn(
        "attributionSource", attribution
    ).drop("a")


def test_clean_order_and_issues(spark):
    c = contact(spark, id="c1", firstName="<b>555-123-4567</b>", lastName=" {{x}}", email="bad", phone="(555) 010-1234", city="<i></i>")
    row = clean_contacts(c).first()
    assert row["firstName"] is None and row["lastName"] is None and row["email"] is None and row["city"] is None
    assert row["phone"] == "+15550101234"
    assert row["issues"] == ["placeholder:lastName", "phone_as_name:firstName", "invalid_email", "phone_normalized"]


def test_custom_fields(spark):
    f = {p: i for i, p, _ in rules.CUSTOM_FIELDS}
    docs = (
        f'[{{"id":"{f["workshop_paid"]}","value":"1"}},{{"id":"{f["workshop_paid"]}","value":2}},'
        f'{{"id":"{f["market_name"]}","value":" "}},{{"id":"{f["preview_sales_rep"]}","value":["a",""," b"]}},'
        f'{{"id":"{f["_hubspot_contact_id"]}","value":" 77 "}},{{"id":"{f["assigned_coach"]}","value":"{{{{c}}}}"}},'
        f'{{"id":"{f["community_join_date"]}","value":1650000000000}},{{"id":"other","value":"z"}}]'
    )
    row = map_contacts(clean_contacts(contact(spark, id="c1", customFields=docs))).first()
    assert row["workshop_paid"] == 2.0 and row["market_name"] is None and row["assigned_coach"] is None
    assert row["preview_sales_rep"] == "a; b" and row["hs_contact_id"] == "77"
    assert row["community_join_date"] == "2022-04-15"


def test_attribution_object_or_array(spark):
    single = map_contacts(clean_contacts(contact(spark, id="a", attributionSource='{"isFirst":true,"sessionSource":"s","medium":"m"}'))).first()
    assert (single["utm_source"], single["utm_medium"]) == ("s", "m")
    many = '[{"isFirst":false,"utmSource":"no"},{"isFirst":true,"utmSource":"","sessionSource":"s"}]'
    assert map_contacts(clean_contacts(contact(spark, id="a", attributionSource=many))).first()["utm_source"] is None


def test_rule_table_sizes():
    assert len(rules.CUSTOM_FIELDS) == 48 and len(rules.UPDATE_ALLOWLIST) == 49 and len(rules.CITY_CODES) == 79
    assert "dateUpdated timestamp" in CONTACT_SCHEMA
