"""Registered queries: one callable per operator and its DuckDB restatement."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import tags as G
from contactloom.functions import text as T
from contactloom.functions import values as V
from contactloom.operators import (
    conflict, dedupe, elimination, links, mapping, matching, merge, owners, profile, rows, runs,
    schema_diff, upsert, validate, windows,
)
from contactloom.operators.clean import clean_contacts, issue_counts
from contactloom.plans import inputs, jobs
from contactloom.plans import oracle_views as O
from contactloom.plans.views import oracle, table, view
from contactloom.sources import contacts as reader
from contactloom.sources import sinks
from contactloom.sources.staging import shared_folder, stage
from contactloom.streaming.manifest import WindowedMigration

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql, O.ORACLE_VIEWS)
        return fn

    return register


def flag(c) -> "F.Column":
    return c.cast("bigint")


# --- cleaning ---------------------------------------------------------------
CLEAN_COLS = ["id", "firstName", "lastName", "email", "phone", "companyName", "address1", "city", "country", "website", "timezone", "type"]


@query("clean_names_emails_phones", f"SELECT {', '.join(CLEAN_COLS)}, issues FROM clean_v")
def clean_names_emails_phones(spark, sf):
    return clean_contacts(inputs.plain_contacts(spark, sf)).select(
        *CLEAN_COLS, F.array_join("issues", ",").alias("issues")
    )


@query("issue_counts", "SELECT code, count(*) AS n FROM (SELECT unnest(string_split(issues, ',')) AS code FROM clean_v WHERE issues <> '') GROUP BY code")
def issue_counts_q(spark, sf):
    return issue_counts(clean_contacts(inputs.plain_contacts(spark, sf)))


@query("contact_display_names", """
    SELECT id, trim(concat(firstName, ' ', lastName)) AS name,
      CASE WHEN coalesce(firstName, '') <> '' OR coalesce(lastName, '') <> ''
           THEN lower(coalesce(firstName, '')) || '|' || lower(coalesce(lastName, '')) END AS name_key
    FROM clean_v""")
def contact_display_names(spark, sf):
    c = clean_contacts(inputs.plain_contacts(spark, sf), keep_issues=False)
    return c.select(
        "id",
        T.full_name(F.col("firstName"), F.col("lastName")).alias("name"),
        T.name_key(F.col("firstName"), F.col("lastName")).alias("name_key"),
    )


@query("strip_html_pages", "SELECT page_id, nullif(trim(regexp_replace(html, '<[^>]+>', '', 'g'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), '') AS text FROM pages")
def strip_html_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.strip_html(F.col("html")).alias("text"))


MENTION = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query("contact_mentions", f"""
    SELECT origin, email, count(*) AS n FROM (
      SELECT 'document' AS origin, unnest(regexp_extract_all(text, '{MENTION}')) AS raw FROM documents
      UNION ALL SELECT 'conversation', unnest(regexp_extract_all(text, '{MENTION}')) FROM conversations
    ), LATERAL (SELECT lower(trim(raw)) AS email) WHERE regexp_full_match(email, '[^\\s@]+@[^\\s@]+\\.[^\\s@]+')
    GROUP BY origin, email""")
def contact_mentions(spark, sf):
    """E-mail addresses in free text, normalised and validated by the contact rules."""
    texts = table(spark, sf, "documents").select(F.lit("document").alias("origin"), "text").unionByName(
        table(spark, sf, "conversations").select(F.lit("conversation").alias("origin"), "text")
    )
    found = texts.select("origin", F.explode(F.regexp_extract_all("text", F.lit(MENTION), F.lit(0))).alias("raw"))
    email = T.normal_email(F.col("raw"))
    return (
        found.select("origin", email.alias("email"))
        .where(T.is_email(F.col("email")))
        .groupBy("origin", "email")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- mapping ----------------------------------------------------------------
STANDARD = ["engager_contact_id", "firstname", "lastname", "email", "phone", "company", "address", "city", "state", "zip", "country", "website", "hs_timezone", "lifecyclestage", "utm_source", "utm_medium"]


@query("map_standard_fields", f"SELECT id, {', '.join(STANDARD)} FROM mapped_v")
def map_standard_fields(spark, sf):
    c = clean_contacts(inputs.plain_contacts(spark, sf), keep_issues=False)
    return c.select("id", *mapping.standard_properties(c)).select("id", *STANDARD)


DECODED = ["workshop_paid", "workshop_total", "sms_engmt_score", "workshop_purchase_date", "market_name", "workshop_payment_status", "products_purchased", "number_of_coaching_sessions_purchased", "assigned_coach", "hs_contact_id", "guest_group_ref"]


def _decoded(spark, sf):
    from contactloom.operators.clean import _clean_custom_fields

    cf = inputs.custom_fields(spark, sf)
    cleaned = cf.select("id", _clean_custom_fields(F.col("customFields")).alias("customFields"))
    d = mapping.custom_properties(cleaned)
    return d.withColumnsRenamed({"_hubspot_contact_id": "hs_contact_id", "_guest_group_ref": "guest_group_ref"})


@query("decode_custom_fields", f"""
    SELECT id, {', '.join(DECODED)}, preview_purchase_date_raw AS preview_purchase_date,
      CAST(preview_purchase_date_raw IS NOT NULL AND preview_purchase_date_raw <> '2020-13-45' AS BIGINT) AS preview_purchase_date_valid
    FROM decoded_v""")
def decode_custom_fields(spark, sf):
    d = _decoded(spark, sf)
    return d.select(
        "id",
        *[V.alias_market(F.col(c), rules.MARKET_ALIASES).alias(c) if c == "market_name" else F.col(c) for c in DECODED],
        "preview_purchase_date",
        flag(V.is_calendar_date(F.col("preview_purchase_date"))).alias("preview_purchase_date_valid"),
    )


@query("custom_field_lookup_join", """
    SELECT property, count(*) AS n, count(DISTINCT text) AS n_values FROM (
      SELECT 'workshop_paid' AS property, CAST(total AS STRING) AS text FROM custom_v
      UNION ALL SELECT 'workshop_total', total_text FROM custom_v
      UNION ALL SELECT 'sms_engmt_score', score_text FROM custom_v
      UNION ALL SELECT 'market_name', trim(market_text) FROM custom_v
      UNION ALL SELECT 'workshop_payment_status', 'Paid in Full' FROM custom_v WHERE k % 6 > 1
      UNION ALL SELECT '_hubspot_contact_id', trim(hs_ref) FROM custom_v
      UNION ALL SELECT '_guest_group_ref', guest_ref FROM custom_v
      UNION ALL SELECT 'assigned_coach', 'Coach ' || (n % 16) FROM custom_v
      UNION ALL SELECT 'number_of_coaching_sessions_purchased', CAST(n AS STRING) FROM custom_v
    ) WHERE text IS NOT NULL AND text <> '' GROUP BY property""")
def custom_field_lookup_join(spark, sf):
    """Generic path: the id -> property table is data and joined."""
    from contactloom.operators.clean import _clean_custom_fields

    wanted = ["workshop_paid", "workshop_total", "sms_engmt_score", "market_name", "workshop_payment_status",
              "_hubspot_contact_id", "_guest_group_ref", "assigned_coach", "number_of_coaching_sessions_purchased"]
    lookup = spark.createDataFrame([(i, p) for i, p, _ in rules.CUSTOM_FIELDS if p in wanted], "id string, property string")
    cf = inputs.custom_fields(spark, sf).select("id", _clean_custom_fields(F.col("customFields")).alias("customFields"))
    long = mapping.custom_fields_long(cf, lookup)
    return long.groupBy("property").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("text").alias("n_values")
    )


@query("market_alias", "SELECT n_nationkey AS nation, CASE WHEN n_nationkey % 3 = 0 THEN 'San Francisco' ELSE n_name END AS market, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def market_alias(spark, sf):
    n = table(spark, sf, "nation").withColumn(
        "raw", F.when(F.col("n_nationkey") % 3 == 0, F.lit("San FRAN ")).otherwise(F.col("n_name"))
    )
    per_nation = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return n.join(per_nation, n["n_nationkey"] == per_nation["c_nationkey"], "left").select(
        F.col("n_nationkey").alias("nation"),
        V.alias_market(F.col("raw"), rules.MARKET_ALIASES).alias("market"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _tag_query(name, sql, column):
    @query(name, sql)
    def run(spark, sf):
        return inputs.tags(spark, sf).select("id", column(F.col("tags")).alias(name))

    return run


_tag_query("buyer_tier", "SELECT 'c' || f.user_id AS id, t.buyer_tier FROM (SELECT DISTINCT user_id FROM events) f LEFT JOIN tier_v t USING (user_id)", G.buyer_tier)
_tag_query("cancellation", "SELECT 'c' || f.user_id AS id, t.cancellation_status AS cancellation FROM (SELECT DISTINCT user_id FROM events) f LEFT JOIN cancel_v t USING (user_id)", G.cancellation_status)
_tag_query("fulfillment", "SELECT 'c' || f.user_id AS id, t.fulfillment_status AS fulfillment FROM (SELECT DISTINCT user_id FROM events) f LEFT JOIN fulfil_v t USING (user_id)", G.fulfillment_status)
_tag_query("event_cities", "SELECT 'c' || f.user_id AS id, t.eventtag AS event_cities FROM (SELECT DISTINCT user_id FROM events) f LEFT JOIN cities_v t USING (user_id)", G.event_cities)
_tag_query("engagement_actions", f"""
    SELECT 'c' || f.user_id AS id, t.v AS engagement_actions FROM (SELECT DISTINCT user_id FROM events) f LEFT JOIN
    (SELECT user_id, arg_min(value, rank) AS v FROM tag_first_v JOIN {O.ranked(rules.ENGAGEMENT_ACTIONS)} USING (tag) GROUP BY user_id) t USING (user_id)""", G.engagement_action)
_tag_query("event_type_tags", """
    SELECT 'c' || user_id AS id,
      CASE WHEN max(CAST(regexp_matches(tag, '^(phase_preview-|preview_app_)') AS INT)) = 1 THEN 'Preview'
           WHEN max(CAST(regexp_matches(tag, '^wb(_|$)|workshop') AS INT)) = 1 THEN 'Workshop'
           WHEN max(CAST(contains(tag, 'expo') AS INT)) = 1 THEN 'Expo' END AS event_type_tags
    FROM tag_first_v GROUP BY user_id""", G.event_type)


@query("unknown_city_codes", f"SELECT code, count(*) AS contacts FROM codes_v WHERE code NOT IN (SELECT code FROM {O.CITIES}) GROUP BY code")
def unknown_city_codes(spark, sf):
    return (
        inputs.tags(spark, sf)
        .select(F.explode(G.unknown_city_codes(F.col("tags"))).alias("code"))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("contacts"))
    )


@query("system_tags_removed", f"""
    SELECT 'c' || user_id AS id, count(*) FILTER (WHERE NOT sys) AS kept, count(*) FILTER (WHERE sys) AS removed FROM (
      SELECT user_id, regexp_matches(tag, '{'|'.join(rules.SYSTEM_TAG_PATTERNS)}') AS sys FROM tag_first_v) GROUP BY user_id""")
def system_tags_removed(spark, sf):
    kept = G.without_system_tags(F.col("tags"))
    return inputs.tags(spark, sf).select(
        "id", F.size(kept).cast("bigint").alias("kept"), (F.size("tags") - F.size(kept)).cast("bigint").alias("removed")
    )


# --- owners, keys, matching -------------------------------------------------
@query("owner_map_build", "SELECT user_id, name, email, owner_id FROM owner_map_v")
def owner_map_build(spark, sf):
    return inputs.owner_map(spark, sf)


@query("owner_assignment", "SELECT id, owner_id AS hubspot_owner_id FROM contacts_v LEFT JOIN owner_map_v ON assignedTo = user_id")
def owner_assignment(spark, sf):
    c = inputs.plain_contacts(spark, sf).select("id", "assignedTo", F.lit(None).cast("string").alias("hubspot_owner_id"))
    return owners.assign_owners(c, inputs.owner_map(spark, sf)).select("id", "hubspot_owner_id")


@query("key_index", "SELECT key, hs_id FROM index_v")
def key_index(spark, sf):
    return matching.key_index(inputs.target(spark, sf))


def _matched(spark, sf):
    mapped = jobs.prepare(inputs.contacts(spark, sf), inputs.owner_map(spark, sf))
    return matching.match_to_target(mapped, inputs.target(spark, sf))


@query("match_actions", f"SELECT id, action, hs_id, matched_on, CASE WHEN action = 'unresolvable' THEN '{rules.UNRESOLVABLE_REASON}' END AS reason FROM matched_v")
def match_actions(spark, sf):
    return _matched(spark, sf).select("id", "action", "hs_id", "matched_on", "reason")


@query("match_action_counts", "SELECT action, coalesce(matched_on, '-') AS matched_on, count(*) AS n FROM matched_v GROUP BY ALL")
def match_action_counts(spark, sf):
    return matching.action_counts(_matched(spark, sf))


@query("target_projection", "SELECT hs_id, firstname, lastname, email, phone FROM target_v")
def target_projection(spark, sf):
    return inputs.target(spark, sf).select("hs_id", "firstname", "lastname", "email", "phone")


@query("target_by_key", "SELECT hs_id, email, phone, engager_contact_id FROM target_v WHERE email IN (SELECT nullif(email, '') FROM clean_v)")
def target_by_key(spark, sf):
    keys = clean_contacts(inputs.plain_contacts(spark, sf), keep_issues=False).select("email")
    return matching.rows_for_keys(
        inputs.target(spark, sf), keys, "email", ["hs_id", "email", "phone", "engager_contact_id"]
    ).select("hs_id", "email", "phone", "engager_contact_id")


# --- conflict filter and writes ---------------------------------------------
@query("conflict_filtered_updates", f"""
    SELECT id, hs_id, {', '.join(O.OWNED)}, concat_ws(',', {', '.join(f"CASE WHEN {p} IS NOT NULL THEN '{p}' END" for p in O.WITHHELD)}) AS withheld,
      CAST(coalesce({', '.join(f'CAST({p} AS STRING)' for p in O.OWNED)}) IS NULL AS BIGINT) AS no_change
    FROM matched_v WHERE action = 'update'""")
def conflict_filtered_updates(spark, sf):
    planned = conflict.plan_writes(_matched(spark, sf))
    return planned.where(F.col("action") == "update").select(
        "id", "hs_id", *O.OWNED, F.array_join("withheld", ",").alias("withheld"), flag(F.col("no_change")).alias("no_change")
    )


@query("enum_domain_violations", """
    SELECT o_orderkey AS k,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS buyer_tier,
      CASE WHEN o_orderstatus IN ('O', 'F') THEN o_orderstatus END AS cancellation_status,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'O;' || o_orderstatus END AS products_purchased,
      concat_ws(',', CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 'buyer_tier' END,
        CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'cancellation_status' END,
        CASE WHEN o_orderstatus = 'P' THEN 'products_purchased' END) AS invalid_fields
    FROM orders""")
def enum_domain_violations(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("buyer_tier"),
        F.col("o_orderstatus").alias("cancellation_status"),
        F.concat(F.lit("O;"), "o_orderstatus").alias("products_purchased"),
    )
    options = {"buyer_tier": ["1-URGENT", "2-HIGH"], "cancellation_status": ["O", "F"], "products_purchased": ["O", "F"]}
    checked = conflict.check_options(o, options, multi={"products_purchased"})
    return checked.withColumn("invalid_fields", F.array_join("invalid_fields", ","))


@query("rejected_records", "SELECT id, email AS value, 'invalid email' AS reason FROM contacts_v WHERE email IS NULL OR NOT regexp_full_match(lower(trim(email)), '[^\\s@]+@[^\\s@]+\\.[^\\s@]+')")
def rejected_records(spark, sf):
    c = inputs.plain_contacts(spark, sf)
    _, bad = upsert.reject_invalid(c, T.is_email(T.normal_email(F.col("email"))))
    return bad.select("id", F.col("email").alias("value"), F.lit("invalid email").alias("reason"))


@query("unknown_target_updates", "SELECT id, hs_id, 'target record not found' AS reason FROM matched_v WHERE action = 'update' AND hs_id NOT IN (SELECT hs_id FROM target_v)")
def unknown_target_updates(spark, sf):
    return upsert.unknown_targets(inputs.target(spark, sf), _planned(spark, sf, None))


SNAPSHOT_COLS = ["hs_id", "email", "phone", "engager_contact_id", *O.FILLED]


def _planned(spark, sf, allowlist):
    return stage(
        jobs.plan_updates(
            inputs.contacts(spark, sf), inputs.target(spark, sf), inputs.owner_map(spark, sf), allowlist
        )
    )


@query("upsert_snapshot", O.snapshot(O.FILLED))
def upsert_snapshot(spark, sf):
    """Snapshot after a migration without a conflict filter."""
    writes = _planned(spark, sf, None)
    return upsert.upsert(inputs.target(spark, sf), writes).select(*SNAPSHOT_COLS)


@query("conflict_safe_snapshot", O.snapshot(O.OWNED))
def conflict_safe_snapshot(spark, sf):
    """Clean, map, match, conflict filter, upsert chained."""
    writes = _planned(spark, sf, rules.UPDATE_ALLOWLIST)
    return upsert.upsert(inputs.target(spark, sf), writes).select(*SNAPSHOT_COLS)


@query("migrate_all", O.snapshot(O.FILLED))
def migrate_all(spark, sf):
    """Migration job with its plan written once to the shared folder."""
    snapshot, _ = jobs.migrate(
        inputs.contacts(spark, sf), inputs.target(spark, sf), inputs.owner_map(spark, sf),
        f"{shared_folder(spark)}/planned",
    )
    return snapshot.select(*SNAPSHOT_COLS)


@query("resumed_migration", O.snapshot(O.FILLED))
def resumed_migration(spark, sf):
    """Migration by monthly windows that stops half-way and is taken up again from its manifest."""
    day = F.timestamp_seconds(F.lit(1577836800) + F.col("ord") % 700 * 86400)
    c = stage(inputs.contacts(spark, sf).withColumn("dateAdded", F.when(F.col("ord") % 29 != 0, day)))
    target, owners_ = inputs.target(spark, sf), inputs.owner_map(spark, sf)
    root = shared_folder(spark)
    first = WindowedMigration(spark, root)
    half = max(len(first.open_windows(c)) // 2, 1)
    first.run(c, target, owners_, per_step=half, max_steps=1)
    again = WindowedMigration(spark, root)
    while not again.run(c, target, owners_, per_step=half + 1):
        pass
    return again.result(target)[0].select(*SNAPSHOT_COLS)


@query("file_migration", O.snapshot(O.FILLED))
def file_migration(spark, sf):
    """Migration of contacts as their source writes them: line JSON without ``ord``, attribution also as an object."""
    c = inputs.contacts(spark, sf)
    names = [n for n in c.columns if n not in ("ord", "attributionSource")]
    first = F.try_element_at("attributionSource", F.lit(2)).dropFields("isFirst")
    single = F.to_json(F.struct(*names, first.alias("attributionSource")))
    line = F.when(F.col("ord") % 3 == 0, single).otherwise(F.to_json(F.struct(*names, "attributionSource")))
    root = shared_folder(spark)
    # part files of a sort stand in name order, so files by path and lines within them are the input order
    c.select("ord", line.alias("value")).orderBy("ord").select("value").write.text(f"{root}/lines")
    good, _ = reader.split_corrupt(reader.read_ndjson(spark, f"{root}/lines"))
    snapshot, _ = jobs.migrate(good, inputs.target(spark, sf), inputs.owner_map(spark, sf), f"{root}/planned")
    return snapshot.select(*SNAPSHOT_COLS)


@query("failed_records", """
    SELECT id, ord, 'match' AS stage, 'no id, e-mail or phone' AS reason, '' AS fields FROM matched_v WHERE action = 'unresolvable'
    UNION ALL
    SELECT id, ord, 'write', 'target record not found', '' FROM matched_v WHERE action = 'update' AND hs_id NOT IN (SELECT hs_id FROM target_v)""")
def failed_records(spark, sf):
    """What a migration could not write, with the reasons."""
    root = shared_folder(spark)
    jobs.migrate(
        inputs.contacts(spark, sf), inputs.target(spark, sf), inputs.owner_map(spark, sf), f"{root}/planned", f"{root}/failed"
    )
    return spark.read.parquet(f"{root}/failed")


@query("write_counters", f"""
    SELECT count(*) AS input,
      (SELECT count(DISTINCT hs_id) FROM matched_v WHERE action = 'update' AND hs_id IN (SELECT hs_id FROM target_v)) AS updated,
      (SELECT count(DISTINCT coalesce(email, '~' || ord)) FROM matched_v WHERE action = 'insert') AS inserted,
      (SELECT count(DISTINCT hs_id) FROM matched_v WHERE action = 'update' AND hs_id NOT IN (SELECT hs_id FROM target_v)) AS failed,
      count(*) FILTER (WHERE action = 'unresolvable') AS skipped,
      CAST(coalesce(sum({' + '.join(f"CASE WHEN action = 'update' AND {p} IS NOT NULL THEN 1 ELSE 0 END" for p in O.WITHHELD)}), 0) AS BIGINT) AS withheld,
      0::BIGINT AS no_change,
      count(*) FILTER (WHERE action <> 'unresolvable')
        - (SELECT count(DISTINCT hs_id) FROM matched_v WHERE action = 'update')
        - (SELECT count(DISTINCT coalesce(email, '~' || ord)) FROM matched_v WHERE action = 'insert') AS collapsed
    FROM matched_v""")
def write_counters(spark, sf):
    return upsert.write_counts(inputs.target(spark, sf), _planned(spark, sf, rules.UPDATE_ALLOWLIST))


# --- duplicates -------------------------------------------------------------
@query("name_blocks", "SELECT name_key, count(*) AS n FROM dup_v GROUP BY name_key")
def name_blocks(spark, sf):
    return dedupe.name_blocks(inputs.duplicate_source(spark, sf))


@query("duplicate_pairs", "SELECT primary_id, duplicate_id, reason, classification FROM found_v")
def duplicate_pairs(spark, sf):
    return dedupe.duplicate_pairs(inputs.duplicate_source(spark, sf)).select(
        F.col("primary.hs_id").alias("primary_id"), F.col("to_merge.hs_id").alias("duplicate_id"), "reason", "classification"
    )


@query("pair_reason_counts", "SELECT classification, reason, count(*) AS n FROM found_v GROUP BY ALL")
def pair_reason_counts(spark, sf):
    return dedupe.profile_pair_counts(inputs.duplicate_source(spark, sf))


@query("duplicate_profiles", "SELECT classification, reason, CAST(count(*) AS BIGINT) AS n_pairs FROM found_v GROUP BY ALL")
def duplicate_profiles(spark, sf):
    d = dedupe.duplicate_profiles(inputs.duplicate_source(spark, sf))
    return d.groupBy("classification", "reason").agg(F.sum("n_pairs").alias("n_pairs"))


@query("review_pairs", f"SELECT {', '.join(rules.REVIEW_COLUMNS)} FROM found_v WHERE classification = 'manual-review'")
def review_pairs(spark, sf):
    return dedupe.review_rows(dedupe.duplicate_pairs(inputs.duplicate_source(spark, sf)))


_HOT_NAME = """WITH s AS (
      SELECT c_custkey AS k, c_custkey // 2 AS g, substr(md5(CAST(c_custkey // 2 AS VARCHAR)), 1, CAST(8 + (c_custkey // 2) % 23 AS INT)) AS l,
        CASE (c_custkey // 2) % 7 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'mail.com' WHEN 2 THEN 'yahoo.com' WHEN 3 THEN 'ymail.com' ELSE 'gmail.com' END AS d
      FROM customer),
    r AS MATERIALIZED (
      SELECT k, coalesce(CASE WHEN g % 13 = 5 THEN NULL WHEN k % 2 = 0 THEN l || '@' || d ELSE
        CASE g % 6 WHEN 0 THEN l || 'x@' || d WHEN 1 THEN substr(l, 2) || '@' || d WHEN 2 THEN l || 'g@' || 'mail.com'
          WHEN 3 THEN l || '@corp.example' WHEN 4 THEN 'ab' || substr(l, 3) || 'c@' || d ELSE 'zz' || l || 'zz@' || d END END, '') AS e,
        CASE WHEN g % 11 = 0 THEN '1555' || (1000000 + g % 40) ELSE '' END AS p FROM s),
    x AS (SELECT k, e, p, split_part(e, '@', 1) AS l, split_part(e, '@', 2) AS d FROM r)
    SELECT 'h' || a.k AS id_a, 'h' || b.k AS id_b,
      CASE WHEN a.e = '' OR b.e = '' THEN CASE WHEN a.p = b.p AND length(a.p) >= 10 THEN 'same_phone_one_no_email' END
        WHEN a.e = b.e THEN NULL
        WHEN a.l = b.l AND levenshtein(a.d, b.d) <= 2 THEN 'domain_typo'
        WHEN a.d = b.d AND levenshtein(a.l, b.l) <= 1 THEN 'local_typo'
        WHEN levenshtein(a.e, b.e) <= 2 THEN 'email_typo'
        WHEN a.p = b.p AND length(a.p) >= 10 THEN 'same_phone_different_email'
        WHEN a.l = b.l AND length(a.l) >= 4 THEN 'same_local_different_domain'
        WHEN levenshtein(a.e, b.e) <= 4 THEN 'possible_email_typo' END AS reason
    FROM x a JOIN x b ON a.k < b.k WHERE reason IS NOT NULL"""


@query("hot_name_pairs", _HOT_NAME)
def hot_name_pairs(spark, sf):
    """Duplicate pairs where all records bear one name: no block of the name is compared with itself."""
    found = dedupe.duplicate_pairs(inputs.hot_name_source(spark, sf))
    first = F.col("primary.ord") < F.col("to_merge.ord")
    ids = F.col("primary.hs_id"), F.col("to_merge.hs_id")
    return found.select(F.when(first, ids[0]).otherwise(ids[1]).alias("id_a"), F.when(first, ids[1]).otherwise(ids[0]).alias("id_b"), "reason")


_MERGES = """WITH RECURSIVE p AS (
      SELECT name_key, primary_id, duplicate_id, reason,
        row_number() OVER (PARTITION BY name_key ORDER BY ord_a, ord_b) AS i
      FROM found_v WHERE classification = 'auto-merge'),
    s AS (
      SELECT name_key, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS gone, '' AS p, '' AS m, '' AS reason, false AS merged
      FROM (SELECT DISTINCT name_key FROM p)
      UNION ALL
      SELECT p.name_key, p.i,
        CASE WHEN list_contains(s.gone, p.primary_id) OR list_contains(s.gone, p.duplicate_id)
             THEN s.gone ELSE list_append(s.gone, p.duplicate_id) END,
        p.primary_id, p.duplicate_id, p.reason,
        NOT (list_contains(s.gone, p.primary_id) OR list_contains(s.gone, p.duplicate_id))
      FROM s JOIN p ON p.name_key = s.name_key AND p.i = s.i + 1)"""


@query("merge_survivors", f"""
{_MERGES}
    SELECT p, m, reason, CAST(merged AS BIGINT) AS merged FROM s WHERE i > 0""")
def merge_survivors(spark, sf):
    """Outcome of applying all auto-merge pairs in order."""
    found = elimination.outcomes(inputs.duplicate_source(spark, sf))
    return found.select("p", "m", "reason", flag(F.col("merged")).alias("merged"))


@query("merge_failures", f"""
{_MERGES},
    f AS (
      SELECT p.i, p.name_key, p.reason, f.primary_id, f.primary_email, trim(f.primary_name) AS primary_name,
        f.duplicate_id, f.duplicate_email, trim(f.duplicate_name) AS duplicate_name
      FROM p JOIN found_v f ON f.name_key = p.name_key AND f.primary_id = p.primary_id AND f.duplicate_id = p.duplicate_id),
    lost AS (SELECT name_key, m, min(i) AS i FROM s WHERE merged GROUP BY ALL)
    SELECT f.reason, f.primary_id, f.primary_email, f.primary_name, f.duplicate_id, f.duplicate_email, f.duplicate_name,
      CASE WHEN a.i < f.i AND b.i < f.i THEN 'both merged before' WHEN a.i < f.i THEN 'primary merged before' ELSE 'duplicate merged before' END AS error
    FROM f LEFT JOIN lost a ON a.name_key = f.name_key AND a.m = f.primary_id LEFT JOIN lost b ON b.name_key = f.name_key AND b.m = f.duplicate_id
    WHERE a.i < f.i OR b.i < f.i""")
def merge_failures(spark, sf):
    """Automatic pairs that could not be merged any more, with names and reason."""
    return elimination.failures(inputs.duplicate_source(spark, sf))


@query("merge_counts", f"""
{_MERGES}
    SELECT count(*) FILTER (merged) AS merged, count(*) FILTER (NOT merged) AS failed,
      (SELECT count(*) FROM found_v WHERE classification = 'manual-review') AS skipped FROM s WHERE i > 0""")
def merge_counts(spark, sf):
    return elimination.merge_counts(inputs.duplicate_source(spark, sf))


FILL = ["email", "phone", "firstname", "lastname", "company", "website"]


@query("merged_target", f"""
{_MERGES},
    e AS (SELECT m, p, i FROM s WHERE merged),
    r AS (
      SELECT m AS rec, p AS root, [i] AS path FROM e
      UNION ALL SELECT r.rec, e.p, list_prepend(e.i, r.path) FROM r JOIN e ON e.m = r.root),
    f AS (SELECT * FROM r WHERE root NOT IN (SELECT m FROM e)),
    members AS (
      SELECT rec AS hs_id, root, path FROM f
      UNION ALL SELECT DISTINCT root, root, CAST([] AS BIGINT[]) FROM f),
    filled AS (
      SELECT root, {', '.join(f'arg_min(d.{c}, path) AS {c}' for c in FILL)}
      FROM members JOIN dup_v d ON d.hs_id = members.hs_id GROUP BY root)
    SELECT d.hs_id, {', '.join(f'coalesce(d.{c}, filled.{c}) AS {c}' for c in FILL)}
    FROM dup_v d LEFT JOIN filled ON d.hs_id = filled.root WHERE d.hs_id NOT IN (SELECT m FROM e)""")
def merged_target(spark, sf):
    """Target after the merges: survivors with blanks filled."""
    source = inputs.duplicate_source(spark, sf)
    return merge.merge_duplicates(source, stage(elimination.merges(source))).select("hs_id", "email", "phone", "firstname", "lastname", "company", "website")


# --- windows, deltas --------------------------------------------------------
@query("weekly_windows", """
    SELECT CAST(DATE '2020-01-01' + CAST(floor(date_diff('day', DATE '2020-01-01', CAST(o_orderdate AS DATE)) / 7) * 7 AS INT) AS DATE) AS window_start,
      count(*) AS total, count(DISTINCT o_custkey) AS collected, CAST(count(*) >= 10000 AS BIGINT) AS capped
    FROM orders GROUP BY 1""")
def weekly_windows(spark, sf):
    stats = windows.window_stats(table(spark, sf, "orders"), windows.week_start(F.col("o_orderdate")), "o_custkey")
    return stats.withColumn("capped", flag(F.col("capped")))


@query("monthly_windows", """
    SELECT CAST(date_trunc('month', ts) AS DATE) AS window_start, count(*) AS total,
      count(DISTINCT user_id) AS collected, CAST(count(*) >= 10000 AS BIGINT) AS capped FROM events GROUP BY 1""")
def monthly_windows(spark, sf):
    stats = windows.window_stats(table(spark, sf, "events"), windows.month_start(F.col("ts")), "user_id")
    return stats.withColumn("capped", flag(F.col("capped")))


@query("window_skew", """
    WITH w AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
    SELECT day, n, round(n / (SELECT avg(n) FROM w), 4) AS vs_mean FROM w""")
def window_skew(spark, sf):
    w = stage(table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    return w.select("day", "n", F.round(F.col("n") / w.agg(F.avg("n")).scalar(), 4).alias("vs_mean"))


SINCE, UNTIL = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
GUARD = ["error"]


WINDOW_ROWS = 64


@query("adaptive_windows", f"""
    WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', ts) ELSE ts END AS ts FROM events),
    m AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM e WHERE ts IS NOT NULL GROUP BY 1),
    p AS (SELECT *, n > {WINDOW_ROWS // 2} AS big,
        coalesce(sum(CAST(n > {WINDOW_ROWS // 2} AS INT)) OVER w, 0) AS b,
        coalesce(sum(CASE WHEN n > {WINDOW_ROWS // 2} THEN 0 ELSE n END) OVER w, 0) // {WINDOW_ROWS // 2} AS s
      FROM m WINDOW w AS (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    g AS (SELECT min(minute) AS window_start, max(minute) AS last, sum(n)::BIGINT AS n FROM p GROUP BY b, s, big)
    SELECT window_start, coalesce(lead(window_start) OVER (ORDER BY window_start), last + INTERVAL 1 MINUTE) AS window_end, n FROM g""")
def adaptive_windows(spark, sf):
    """Windows of unequal length over the event times, a third of them moved to the full hour."""
    ts = F.when(F.col("event_id") % 3 == 0, F.date_trunc("hour", "ts")).otherwise(F.col("ts"))
    return windows.adaptive_windows(table(spark, sf, "events").select(ts.alias("ts")), "ts", WINDOW_ROWS)


@query("delta_since", f"""
    SELECT id, arg_min(ord, ord) AS ord, arg_min(event_type, ord) AS event_type FROM delta_v
    WHERE dateUpdated BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}' AND event_type <> 'error' GROUP BY id""")
def delta_since(spark, sf):
    return windows.changed_since(inputs.delta(spark, sf), SINCE, UNTIL, GUARD).select("id", "ord", "event_type")


@query("delta_counts", f"""
    SELECT count(*) AS scanned, count(DISTINCT id) FILTER (WHERE event_type <> 'error') AS collected,
      count(*) FILTER (WHERE event_type <> 'error') - count(DISTINCT id) FILTER (WHERE event_type <> 'error') AS duplicates
    FROM delta_v WHERE dateUpdated BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}'""")
def delta_counts(spark, sf):
    return windows.delta_counts(inputs.delta(spark, sf), SINCE, UNTIL, GUARD)


@query("late_edit_metric", f"""
    WITH p AS (SELECT user_id, min(ts) AS added, max(ts) AS updated FROM events GROUP BY user_id)
    SELECT count(*) FILTER (WHERE updated BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}') AS updated_in_window,
      count(*) FILTER (WHERE added < TIMESTAMP '{SINCE}') AS created_before_window,
      count(*) FILTER (WHERE added < TIMESTAMP '{SINCE}' AND updated BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}') AS late_edits
    FROM p""")
def late_edit_metric(spark, sf):
    per_user = table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("dateAdded"), F.max("ts").alias("dateUpdated")
    )
    return windows.late_edits(per_user, SINCE, UNTIL)


@query("tag_diff", f"""
    WITH o AS (SELECT DISTINCT id, event_type FROM delta_v WHERE dateUpdated < TIMESTAMP '{SINCE}'),
         n AS (SELECT DISTINCT id, event_type FROM delta_v WHERE dateUpdated >= TIMESTAMP '{SINCE}')
    SELECT ids.id, a.added, r.removed FROM (SELECT DISTINCT id FROM n) ids
    LEFT JOIN (SELECT id, string_agg(event_type, ',' ORDER BY event_type) AS added FROM n ANTI JOIN o USING (id, event_type) GROUP BY id) a USING (id)
    LEFT JOIN (SELECT id, string_agg(event_type, ',' ORDER BY event_type) AS removed FROM o ANTI JOIN n USING (id, event_type) GROUP BY id) r USING (id)
    WHERE a.added IS NOT NULL OR r.removed IS NOT NULL""")
def tag_diff(spark, sf):
    d = inputs.delta(spark, sf)
    split = F.col("dateUpdated") < windows.instant(windows.utc_time(SINCE), d.schema["dateUpdated"].dataType)

    def version(part):
        return part.groupBy("id").agg(F.collect_set("event_type").alias("tags"))  # at most one entry per event type

    diff = windows.tag_diff(version(d.where(split)), version(d.where(~split)))
    return diff.select(
        "id",
        F.nullif(F.array_join("added", ","), F.lit("")).alias("added"),
        F.nullif(F.array_join("removed", ","), F.lit("")).alias("removed"),
    )


@query("resume_windows", """
    WITH w AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start FROM orders),
         done AS (SELECT DISTINCT window_start FROM w WHERE month(window_start) <= 6)
    SELECT window_start, count(*) AS n FROM w WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.window_start = w.window_start) GROUP BY 1""")
def resume_windows(spark, sf):
    o = table(spark, sf, "orders")
    month = windows.month_start(F.col("o_orderdate"))
    done = o.select(month.alias("window_start")).where(F.month("window_start") <= 6).distinct()
    return windows.pending(o, month, done).groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))


@query("tag_filtered_scan", """
    SELECT 'c' || user_id AS id, count(*) AS n_tags FROM tag_first_v GROUP BY user_id
    HAVING max(CASE WHEN tag IN ('wb', 'wb_diamond', 'telesales_sold') THEN 1 ELSE 0 END) = 1
       AND max(CASE WHEN tag IN ('cancel', 'hs_transfer') THEN 1 ELSE 0 END) = 0""")
def tag_filtered_scan(spark, sf):
    found = windows.tagged(inputs.tags(spark, sf), include=["wb", "wb_diamond", "telesales_sold"], exclude=["cancel", "hs_transfer"])
    return found.select("id", F.size("tags").cast("bigint").alias("n_tags"))


@query("first_n", "SELECT id, ord, trim(concat(firstName, ' ', lastName)) AS name FROM contacts_v ORDER BY ord LIMIT 100")
def first_n(spark, sf):
    """First rows of a source (a sampling operator; the limit is the feature)."""
    c = rows.first_n(inputs.plain_contacts(spark, sf), 100)
    return c.select("id", "ord", T.full_name(F.col("firstName"), F.col("lastName")).alias("name"))


@query("tier_union", """
    SELECT tier, count(*) AS n, count(DISTINCT id) AS n_ids, sum(ord) AS ord_sum FROM (
      SELECT 1 AS tier, id, ord FROM contacts_v WHERE id IN (SELECT contactId FROM opportunities_v WHERE pipelineId = 'p2')
      UNION ALL SELECT 2, id, ord FROM contacts_v WHERE id IN (SELECT 'c' || user_id FROM tag_first_v WHERE tag IN ('phase-preview-buyer', 'pna'))
      UNION ALL SELECT 3, id, ord FROM contacts_v) GROUP BY tier""")
def tier_union(spark, sf):
    c = inputs.plain_contacts(spark, sf).join(inputs.tags(spark, sf), "id", "left").select("id", "ord", "tags")
    opps = view(spark, sf, "opportunities_v")
    parts = [
        jobs.extract_tier(1, c, opportunities=opps, pipeline_id="p2"),
        jobs.extract_tier(2, c, tags=["phase-preview-buyer", "pna"]),
        jobs.extract_tier(3, c),
    ]
    out = None
    for tier, part in enumerate(parts, 1):
        labelled = part.select(F.lit(tier).alias("tier"), "id", "ord")
        out = labelled if out is None else out.unionByName(labelled)
    return out.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"), F.sum("ord").alias("ord_sum")
    )


@query("keep_last_by_key", "SELECT o_custkey AS k, arg_max(o_orderkey, o_orderkey) AS ord, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey")
def keep_last_by_key(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("price"))
    return rows.keep_last(o, "k")


@query("overlay_updates", """
    SELECT o_custkey AS k, max(o_orderkey) AS ord,
      arg_max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END, o_orderkey) AS last_filled,
      arg_max(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END, o_orderkey) AS last_open
    FROM orders GROUP BY o_custkey""")
def overlay_updates(spark, sf):
    """Later rows overlay earlier ones property by property."""
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("last_filled"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("last_open"),
    )
    return rows.overlay(o, "k", ["last_filled", "last_open"])


@query("keep_first_by_key", "SELECT o_custkey AS k, min(o_orderkey) AS ord, arg_min(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey")
def keep_first_by_key(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("price"))
    return rows.keep_first(o, "k")


@query("monthly_tag_windows", """
    SELECT CAST(date_trunc('month', dateUpdated) AS DATE) AS window_start, count(*) AS total,
      count(DISTINCT id) AS collected, CAST(count(*) >= 10000 AS BIGINT) AS capped
    FROM delta_v WHERE event_type IN ('purchase', 'click') GROUP BY 1""")
def monthly_tag_windows(spark, sf):
    """Calendar-month windows of the rows carrying any of two tags."""
    found = windows.tagged(inputs.delta(spark, sf), include=["purchase", "click"])
    stats = windows.window_stats(found, windows.month_start(F.col("dateUpdated")))
    return stats.withColumn("capped", flag(F.col("capped")))


@query("epoch_values", """
    SELECT k, CASE WHEN k % 5 = 1 THEN NULL ELSE date_diff('day', DATE '1970-01-01', CAST(first_date AS DATE)) * 86400000 END AS ms FROM custom_v""")
def epoch_values(spark, sf):
    """Epoch digits and ISO dates in text form as milliseconds."""
    return view(spark, sf, "custom_v").select("k", V.to_epoch_ms(F.col("first_text")).alias("ms"))


# --- profiling --------------------------------------------------------------
@query("tag_topk", "SELECT tag, count(*) AS n FROM tag_rows_v GROUP BY tag ORDER BY n DESC, tag LIMIT 30")
def tag_topk(spark, sf):
    r = view(spark, sf, "tag_rows_v").select(F.array("tag").alias("tags"))
    return profile.top_tags(r)


@query("tag_ranking", "SELECT tag, count(*) AS n, round(100.0 * count(*) / (SELECT count(DISTINCT user_id) FROM events), 1) AS pct FROM tag_first_v GROUP BY tag")
def tag_ranking(spark, sf):
    return profile.tag_ranking(inputs.tags(spark, sf))


@query("selected_tag_counts", f"SELECT w.tag, count(t.tag) AS n FROM {O.values([(t,) for t in rules.CHECKED_TAGS], 'w', 'tag')} LEFT JOIN tag_first_v t ON w.tag = t.tag GROUP BY w.tag")
def selected_tag_counts(spark, sf):
    return profile.selected_tag_counts(inputs.tags(spark, sf))


COVERED = ["id", "firstName", "email", "phone", "companyName", "country", "website", "timezone", "type"]


@query("field_coverage", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(nullif({c}, '')) AS filled, CAST(floor(100.0 * count(nullif({c}, '')) / count(*) + 0.5) AS BIGINT) AS pct FROM contacts_v" for c in COVERED) + ") WHERE filled > 0")
def field_coverage(spark, sf):
    return profile.field_coverage(inputs.plain_contacts(spark, sf), COVERED)


@query("key_presence", """
    SELECT 'k' AS field, count(*) FILTER (WHERE json_exists(props, '$.k')) AS n,
           arg_min(props ->> '$.k', event_id) AS example FROM events
    UNION ALL SELECT 'missing', count(*) FILTER (WHERE json_exists(props, '$.missing')), arg_min(props ->> '$.missing', event_id) FROM events""")
def key_presence(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    return profile.key_presence(e, "doc", ["k", "missing"], "event_id")


@query("discovered_keys", """
    WITH d AS (SELECT event_id, TRY_CAST(props ->> '$.k' AS BIGINT) AS k, event_type, user_id FROM events)
    SELECT 'props' AS path, 'OBJECT<k: BIGINT>' AS type, count(*) AS n, 0::BIGINT AS nulls, '{"k":' || arg_min(k, event_id) || '}' AS example FROM d
    UNION ALL SELECT 'props.k', 'BIGINT', count(*), 0, CAST(arg_min(k, event_id) AS VARCHAR) FROM d
    UNION ALL SELECT 'who', 'OBJECT<id: BIGINT, tags: ARRAY<STRING>>', count(*), 0,
      arg_min('{"id":' || CASE WHEN user_id % 3 = 0 THEN 'null' ELSE CAST(user_id AS VARCHAR) END || ',"tags":["' || event_type || '","x"]}', event_id) FROM d
    UNION ALL SELECT 'who.id', 'BIGINT', count(*), count(*) FILTER (WHERE user_id % 3 = 0), CAST(arg_min(user_id, event_id) FILTER (WHERE user_id % 3 <> 0) AS VARCHAR) FROM d
    UNION ALL SELECT 'who.tags', 'ARRAY<STRING>', count(*), 0, arg_min('["' || event_type || '","x"]', event_id) FROM d
    UNION ALL SELECT 'who.tags[]', 'STRING', count(*), 0, arg_min('"' || least(event_type, 'x') || '"', event_id) FROM d""")
def discovered_keys(spark, sf):
    """Keys of the event properties and of a nested document around them, found in the data."""
    whole = F.concat(
        F.lit('{"props":'), "props", F.lit(',"who":{"id":'), F.when(F.col("user_id") % 3 == 0, F.lit("null")).otherwise(F.col("user_id").cast("string")),
        F.lit(',"tags":["'), "event_type", F.lit('","x"]}}'),
    )
    return profile.discovered_keys(table(spark, sf, "events").select("event_id", F.try_parse_json(whole).alias("doc")), "doc", "event_id")


@query("custom_field_population", f"""
    SELECT field_id, count(*) AS n, CAST(floor(100.0 * count(*) / (SELECT count(*) FROM custom_v) + 0.5) AS BIGINT) AS pct FROM (
      SELECT '{inputs.FIELD_ID['workshop_total']}' AS field_id, total_text AS v FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['workshop_paid']}', '1' FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['workshop_paid']}', '2' FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['sms_engmt_score']}', score_text FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['workshop_purchase_date']}', coalesce(date_text, CAST(date_ms AS STRING)) FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['preview_purchase_date']}', first_text FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['market_name']}', market_text FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['workshop_payment_status']}', status_text FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['products_purchased']}', 'x' FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['number_of_coaching_sessions_purchased']}', CAST(n AS STRING) FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['_hubspot_contact_id']}', hs_ref FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['_guest_group_ref']}', guest_ref FROM custom_v
      UNION ALL SELECT '{inputs.FIELD_ID['assigned_coach']}', 'x' FROM custom_v
    ) WHERE v IS NOT NULL AND v <> '' GROUP BY field_id""")
def custom_field_population(spark, sf):
    return profile.custom_field_population(inputs.custom_fields(spark, sf))


@query("sample_contacts", """
    SELECT c.id, trim(concat(c.firstName, ' ', c.lastName)) AS name, coalesce(t.tags, '') AS tags FROM
      (SELECT * FROM contacts_v ORDER BY ord LIMIT 5) c LEFT JOIN
      (SELECT user_id, string_agg(tag, ',' ORDER BY pos) AS tags FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS rn FROM tag_first_v) WHERE rn <= 5 GROUP BY user_id) t
      ON c.k = t.user_id""")
def sample_contacts(spark, sf):
    c = inputs.plain_contacts(spark, sf).join(inputs.tags(spark, sf), "id", "left")
    return profile.sample_rows(c).withColumn("tags", F.array_join("tags", ","))


# --- pipelines, deals, guests ------------------------------------------------
@query("pipeline_contacts", "SELECT id, email FROM contacts_v WHERE id IN (SELECT contactId FROM opportunities_v WHERE pipelineId = 'p3' AND status IN ('open', 'won'))")
def pipeline_contacts(spark, sf):
    return links.pipeline_contacts(
        inputs.plain_contacts(spark, sf), view(spark, sf, "opportunities_v"), "p3", ["open", "won"]
    ).select("id", "email")


@query("pipeline_contact_ids", "SELECT DISTINCT contactId FROM opportunities_v WHERE pipelineId = 'p5'")
def pipeline_contact_ids(spark, sf):
    return links.pipeline_contact_ids(view(spark, sf, "opportunities_v"), "p5")


@query("pipeline_counts", "SELECT p.id, p.name, count(o.id) AS n FROM (SELECT 'p' || n_nationkey AS id, n_name AS name FROM nation) p LEFT JOIN opportunities_v o ON o.pipelineId = p.id GROUP BY p.id, p.name")
def pipeline_counts(spark, sf):
    p = table(spark, sf, "nation").select(F.concat(F.lit("p"), "n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return links.opportunities_per_pipeline(p, view(spark, sf, "opportunities_v"))


@query("dangling_contacts", "SELECT contactId, count(*) AS n FROM opportunities_v WHERE contactId NOT IN (SELECT id FROM contacts_v) GROUP BY contactId")
def dangling_contacts(spark, sf):
    return links.dangling_contacts(inputs.plain_contacts(spark, sf), view(spark, sf, "opportunities_v"))


@query("contact_opportunities", "SELECT c.id, count(*) AS n, round(sum(o.monetaryValue), 2) AS amount FROM contacts_v c JOIN opportunities_v o ON o.contactId = c.id GROUP BY c.id")
def contact_opportunities(spark, sf):
    c = inputs.plain_contacts(spark, sf).select("id")
    o = view(spark, sf, "opportunities_v").select("contactId", "monetaryValue")
    joined = links.opportunities_of_contacts(c, o)
    return joined.groupBy(c["id"]).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("monetaryValue"), 2).alias("amount"))


@query("pipeline_stages", "SELECT r_name AS pipeline_id, CAST(n_nationkey AS STRING) AS stage_id, n_name AS stage_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def pipeline_stages(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    nested = n.join(r, n["n_regionkey"] == r["r_regionkey"]).groupBy(F.col("r_name").alias("id")).agg(
        F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))).alias("stages")
    )
    return links.explode_stages(nested)


@query("deal_mapping", """
    SELECT o.id AS opportunity_id, o.name AS dealname, o.monetaryValue AS amount,
      CASE o.status WHEN 'open' THEN 'active' WHEN 'lost' THEN 'closedlost' END AS dealstage,
      n.n_name AS pipeline, o.source AS deal_source, o.contactId
    FROM opportunities_v o LEFT JOIN nation n ON o.pipelineId = 'p' || n.n_nationkey""")
def deal_mapping(spark, sf):
    pipelines = table(spark, sf, "nation").select(F.concat(F.lit("p"), "n_nationkey").alias("pipelineId"), F.col("n_name").alias("deal_pipeline"))
    stages = spark.createDataFrame([("open", "active"), ("lost", "closedlost")], "status string, deal_stage string")
    return links.map_deals(view(spark, sf, "opportunities_v"), pipelines, stages).drop("createdate")


@query("guest_edges", """
    WITH e AS (
      SELECT DISTINCT g.hs_id AS from_id, coalesce(x.hs_id, y.hs_id) AS to_id FROM mapped_v m
      JOIN index_v g ON g.key = m.id
      LEFT JOIN index_v x ON x.key = lower(m.guest_group_ref) LEFT JOIN index_v y ON y.key = m.guest_group_ref
      WHERE m.guest_group_ref IS NOT NULL AND coalesce(x.hs_id, y.hs_id) IS NOT NULL)
    SELECT from_id, to_id FROM e WHERE from_id <> to_id
      AND NOT EXISTS (SELECT 1 FROM target_v t WHERE t.k % 5 = 0 AND t.hs_id = e.from_id AND e.to_id = 'h' || (t.k - t.r))""")
def guest_edges(spark, sf):
    mapped = stage(_decoded(spark, sf).select("id", "guest_group_ref"))
    t = inputs.target(spark, sf)
    # edges already present: every fifth record to the first record of its block
    existing = t.select(
        F.col("hs_id").alias("from_id"),
        F.when(F.col("ord") % 5 == 0, F.concat(F.lit("h"), (F.col("ord") - F.col("ord") % 12).cast("string"))).alias("to_id"),
    ).where(F.col("to_id").isNotNull())
    return links.guest_edges(mapped, t, existing)


# --- schema catalog ---------------------------------------------------------
def _new_options(spark, sf):
    """Options wanted per brand: every part type, twenty-five names among them new."""
    p = table(spark, sf, "part")
    return p.groupBy(F.col("p_brand").alias("name"), F.concat("p_type", F.lit("-"), F.col("p_size").cast("string")).alias("value")).agg(
        F.min("p_partkey").alias("ord")
    )


@query("schema_diff_create", """
    SELECT d.name, CASE WHEN e.name IS NULL THEN 'created' ELSE 'skipped' END AS status FROM
      (SELECT DISTINCT p_type AS name FROM part UNION SELECT DISTINCT n_name FROM nation) d
      LEFT JOIN (SELECT DISTINCT p_type AS name FROM part WHERE p_size > 25) e ON d.name = e.name""")
def schema_diff_create(spark, sf):
    p = table(spark, sf, "part")
    desired = p.select(F.col("p_type").alias("name")).distinct().unionByName(
        table(spark, sf, "nation").select(F.col("n_name").alias("name")).distinct()
    )
    existing = p.where(F.col("p_size") > 25).select(F.col("p_type").alias("name"))
    return schema_diff.diff_properties(desired, existing).select("name", "status")


@query("schema_diff_options", """
    WITH new AS (SELECT p_brand AS name, p_type || '-' || p_size AS value, min(p_partkey) AS ord FROM part GROUP BY ALL),
         old AS (SELECT p_brand AS name, p_type || '-' || p_size AS value, p_size AS displayOrder FROM part WHERE p_size <= 20)
    SELECT n.name, n.value, m.mx + row_number() OVER (PARTITION BY n.name ORDER BY n.ord) AS displayOrder
    FROM new n JOIN (SELECT name, max(displayOrder) AS mx FROM old GROUP BY name) m ON m.name = n.name
    WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.name = n.name AND o.value = n.value)""")
def schema_diff_options(spark, sf):
    p = table(spark, sf, "part")
    existing = p.where(F.col("p_size") <= 20).select(
        F.col("p_brand").alias("name"), F.concat("p_type", F.lit("-"), F.col("p_size").cast("string")).alias("value"),
        F.col("p_size").alias("displayOrder"),
    )
    return schema_diff.append_options(existing, _new_options(spark, sf), chunk=100)


@query("schema_types", "SELECT p_type AS type, count(*) AS n, count(*) FILTER (WHERE p_size > 25) AS built_in, count(*) FILTER (WHERE p_size <= 25) AS custom FROM part GROUP BY p_type")
def schema_types(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_type").alias("type"), (F.col("p_size") > 25).alias("hubspotDefined"))
    return schema_diff.type_counts(p)


@query("custom_property_list", "SELECT DISTINCT p_brand || '/' || p_type AS name, p_type AS type FROM part WHERE p_size <= 25 ORDER BY name")
def custom_property_list(spark, sf):
    p = table(spark, sf, "part").select(
        F.concat("p_brand", F.lit("/"), "p_type").alias("name"), F.col("p_type").alias("type"),
        (F.col("p_size") > 25).alias("hubspotDefined"),
    )
    return schema_diff.custom_properties(p.distinct()).select("name", "type")


# --- validation -------------------------------------------------------------
CHECKED = ["firstname", "lastname", "utm_source"]
_EXPECTED_LAST = "SELECT email, arg_max_null(firstname, ord) AS firstname, arg_max_null(lastname, ord) AS lastname, arg_max_null(utm_source, ord) AS utm_source FROM mapped_v WHERE email IS NOT NULL GROUP BY email"
_VALIDATED = f"""
    v AS (SELECT x.email, y.e IS NOT NULL AS found,
        CASE WHEN x.firstname IS NOT NULL AND lower(x.firstname) IS DISTINCT FROM lower(y.firstname) THEN 'fail:firstname' END AS m1,
        CASE WHEN x.lastname IS NOT NULL AND lower(x.lastname) IS DISTINCT FROM lower(y.lastname) THEN 'fail:lastname' END AS m2,
        CASE WHEN x.utm_source IS NOT NULL THEN 'warn:utm_source' END AS m3
      FROM ({_EXPECTED_LAST}) x LEFT JOIN (SELECT lower(email) AS e, arg_max_null(firstname, ord) AS firstname, arg_max_null(lastname, ord) AS lastname FROM target_v WHERE email IS NOT NULL GROUP BY lower(email)) y ON x.email = y.e),
    s AS (SELECT email, CASE WHEN NOT found THEN 'NOT_FOUND' WHEN m1 IS NOT NULL OR m2 IS NOT NULL THEN 'FAIL' WHEN m3 IS NOT NULL THEN 'WARN' ELSE 'PASS' END AS status,
        CASE WHEN found THEN concat_ws(',', m1, m2, m3) ELSE '' END AS mismatches FROM v)"""


def _validated(spark, sf):
    c = clean_contacts(inputs.plain_contacts(spark, sf), keep_issues=False)
    expected = c.select("ord", *mapping.standard_properties(c))
    return validate.validate(expected, inputs.target(spark, sf), CHECKED)


@query("validation_status", f"WITH {_VALIDATED} SELECT email, status, mismatches FROM s")
def validation_status(spark, sf):
    return _validated(spark, sf).withColumn("mismatches", F.array_join("mismatches", ","))


@query("validation_counts", f"WITH {_VALIDATED} SELECT status, count(*) AS n FROM s GROUP BY status")
def validation_counts(spark, sf):
    return validate.status_counts(_validated(spark, sf))


@query("validation_verdict", f"WITH {_VALIDATED} SELECT count(*) AS checked, CAST(count(*) FILTER (WHERE status IN ('FAIL', 'NOT_FOUND')) = 0 AS BIGINT) AS passed FROM s")
def validation_verdict(spark, sf):
    return validate.verdict(_validated(spark, sf)).withColumn("passed", flag(F.col("passed")))


# --- run metrics ------------------------------------------------------------
_RUNS = """
    r AS (SELECT date_trunc('month', o_orderdate) AS started_at, count(*) AS changed,
      count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority NOT LIKE '5%') AS updated,
      count(*) FILTER (WHERE o_orderstatus = 'O') AS inserted,
      count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '5%') AS failed,
      count(*) FILTER (WHERE o_orderstatus = 'P') AS skipped
      FROM orders GROUP BY 1)"""


def _run_rows(spark, sf):
    """Orders per month as sync runs."""
    o = table(spark, sf, "orders")
    status, low = F.col("o_orderstatus"), F.startswith("o_orderpriority", F.lit("5"))
    per_day = o.groupBy(
        F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("started_at"),
        F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("batch"),
    ).agg(
        F.count(F.lit(1)).alias("changed"),
        F.count_if((status == "F") & ~low).alias("updated"), F.count_if(status == "O").alias("inserted"),
        F.count_if((status == "F") & low).alias("failed"), F.count_if(status == "P").alias("skipped"),
    )
    totals = runs.batch_rollup(per_day, ["started_at"])
    changed = per_day.groupBy("started_at").agg(F.sum("changed").cast("bigint").alias("changed"))
    return totals.join(changed, "started_at")


@query("run_metrics", f"WITH {_RUNS} SELECT CAST(started_at AS DATE) AS run, changed, updated, inserted, failed, skipped, updated + inserted + failed + skipped AS processed FROM r")
def run_metrics(spark, sf):
    return runs.judged(_run_rows(spark, sf)).select(
        F.col("started_at").cast("date").alias("run"), "changed", "updated", "inserted", "failed", "skipped", "processed"
    )


@query("failure_rate", f"""WITH {_RUNS} SELECT CAST(started_at AS DATE) AS run, failed,
    round(failed / (updated + inserted + failed + skipped), 4) AS failure_rate,
    CAST(failed / (updated + inserted + failed + skipped) <= 0.1 AS BIGINT) AS ok FROM r""")
def failure_rate(spark, sf):
    return runs.judged(_run_rows(spark, sf)).select(
        F.col("started_at").cast("date").alias("run"), "failed", "failure_rate", flag(F.col("ok")).alias("ok")
    )


@query("run_history", f"WITH {_RUNS} SELECT CAST(started_at AS DATE) AS run, updated FROM r ORDER BY started_at DESC LIMIT 30")
def run_history(spark, sf):
    return runs.newest(_run_rows(spark, sf)).select(F.col("started_at").cast("date").alias("run"), "updated")


@query("failed_sample", """
    SELECT o_orderkey AS k, o_custkey AS cust, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '5%') - 10 AS more
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '5%' ORDER BY o_orderkey LIMIT 10""")
def failed_sample(spark, sf):
    o = table(spark, sf, "orders").where((F.col("o_orderstatus") == "F") & F.startswith("o_orderpriority", F.lit("5")))
    return runs.failed_sample(o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust")), ["k"])


@query("run_summary", f"""WITH {_RUNS}, j AS (SELECT *, round(failed / (updated + inserted + failed + skipped), 4) AS rate,
      failed / (updated + inserted + failed + skipped) <= 0.1 AS ok FROM r)
    SELECT strftime(started_at, '%Y-%m') AS run_id, CASE WHEN ok THEN 'OK' ELSE 'FAILED' END AS status,
      CASE WHEN changed >= 60 THEN (changed // 60) || 'm ' || (changed % 60) || 's' ELSE changed || 's' END AS duration,
      CAST(round(CAST(rate AS DECIMAL(10, 4)) * 100, 1) AS DECIMAL(10, 1)) || '%' AS rate_text,
      CASE WHEN NOT ok THEN failed || ' of ' || changed || ' changed' END AS alert FROM j""")
def run_summary(spark, sf):
    """Summary rows; a run is taken to last one second per changed row."""
    r = runs.judged(_run_rows(spark, sf)).select(
        "*",
        F.date_format("started_at", "yyyy-MM").alias("run_id"), F.lit(False).alias("dry_run"),
        F.timestamp_seconds(F.unix_seconds("started_at") + F.col("changed")).alias("finished_at"),
    )
    return runs.sync_summary(r)


@query("migration_report", f"""WITH {_RUNS}, q AS (SELECT year(started_at) AS tier, count(*) AS last_batch, sum(updated) AS u, sum(inserted) AS i, sum(failed) AS f, sum(skipped) AS s FROM r GROUP BY 1)
    SELECT tier, CASE WHEN last_batch = 12 THEN 'complete' ELSE 'in-progress' END AS status,
      printf('%.1f', round(100.0 * last_batch / 12, 1)) || '%' AS progress,
      CASE WHEN last_batch = 12 THEN '2h ' || (u % 60) || 'm' ELSE '-' END AS duration,
      CAST(u + i AS BIGINT) AS succeeded, CAST(u AS BIGINT) AS updated, CAST(i AS BIGINT) AS inserted, CAST(f AS BIGINT) AS failed, CAST(s AS BIGINT) AS skipped,
      CAST(u + i + f + s AS BIGINT) AS processed FROM q""")
def migration_report(spark, sf):
    """Years as migration tiers, months as batches; complete with twelve of them."""
    per_year = _run_rows(spark, sf).groupBy(F.year("started_at").alias("tier")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("bigint").alias(c) for c in runs.COUNTERS]
    )
    start = F.timestamp_seconds(F.lit(1577836800))
    r = per_year.select(
        F.col("tier").cast("bigint").alias("tier"), (F.col("n") - 1).alias("last_batch"), F.lit(12).alias("total_batches"),
        start.alias("started_at"),
        F.when(F.col("n") == 12, F.timestamp_seconds(F.lit(1577836800 + 7200) + (F.col("updated") % 60) * 60)).alias("completed_at"),
        *runs.COUNTERS,
    )
    return runs.migration_summary(r)


@query("count_reconciliation", """
    SELECT (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM orders WHERE o_totalprice > 0) AS target_rows,
      CAST(abs((SELECT count(*) FROM orders WHERE o_totalprice > 0) - (SELECT count(*) FROM orders)) <= (SELECT count(*) FROM orders) * 0.001 AS BIGINT) AS within_tolerance""")
def count_reconciliation(spark, sf):
    o = table(spark, sf, "orders")
    return jobs.count_reconciliation(o, o.where(F.col("o_totalprice") > 0)).withColumn(
        "within_tolerance", flag(F.col("within_tolerance"))
    )


# --- files ------------------------------------------------------------------
FILE_COLS = ["id", "firstName", "lastName", "email", "phone", "companyName", "city", "ord"]
_FILE_SQL = f"SELECT {', '.join(FILE_COLS)} FROM contacts_v"
_FILE_SCHEMA = ", ".join(f"{c} {'bigint' if c == 'ord' else 'string'}" for c in FILE_COLS)


@query("json_roundtrip", _FILE_SQL)
def json_roundtrip(spark, sf):
    """Line JSON written and read back with an explicit schema."""
    path = f"{shared_folder(spark)}/contacts"
    sinks.append_ndjson(inputs.plain_contacts(spark, sf).select(*FILE_COLS), path)
    good, _ = reader.split_corrupt(reader.read_ndjson(spark, path, _FILE_SCHEMA))
    return good.select(*FILE_COLS)


@query("array_lines_roundtrip", _FILE_SQL)
def array_lines_roundtrip(spark, sf):
    """A JSON-array style text (brackets, trailing commas, blank lines) read line by line."""
    path = f"{shared_folder(spark)}/lines"
    c = inputs.plain_contacts(spark, sf).select(*FILE_COLS)
    line = F.concat(F.to_json(F.struct(*FILE_COLS)), F.lit(","))
    extra = F.when(F.col("ord") == 0, F.array(F.lit("["), line, F.lit(""), F.lit("]"))).otherwise(F.array(line))
    c.select(F.explode(extra).alias("value")).write.mode("overwrite").text(path)
    good, _ = reader.split_corrupt(reader.read_array_lines(spark, path, _FILE_SCHEMA))
    return good.select(*FILE_COLS)


@query("array_file_roundtrip", f"SELECT count(*) AS written, sum(ord) AS ord_sum FROM contacts_v")
def array_file_roundtrip(spark, sf):
    """Line JSON converted to a columnar table; rows counted while writing."""
    root = shared_folder(spark)
    sinks.append_ndjson(inputs.plain_contacts(spark, sf).select(*FILE_COLS), f"{root}/lines")
    good, _ = reader.split_corrupt(reader.read_ndjson(spark, f"{root}/lines", _FILE_SCHEMA))
    written = sinks.write_counted(good, f"{root}/table")
    return spark.read.parquet(f"{root}/table").agg(F.lit(written).cast("bigint").alias("written"), F.sum("ord").alias("ord_sum"))


@query("corrupt_lines", "SELECT count(*) FILTER (WHERE k % 10 <> 0) AS readable, count(*) FILTER (WHERE k % 10 = 0) AS corrupt FROM contacts_v")
def corrupt_lines(spark, sf):
    """Every tenth line is cut in half; readable and unreadable lines are both counted."""
    path = f"{shared_folder(spark)}/broken"
    c = inputs.plain_contacts(spark, sf).select(*FILE_COLS)
    line = F.to_json(F.struct(*FILE_COLS))
    broken = F.when(F.col("ord") % 10 == 0, F.substring(line, F.lit(1), F.floor(F.length(line) / F.lit(2)).cast("int"))).otherwise(line)
    c.select(broken.alias("value")).write.mode("overwrite").text(path)
    good, bad = reader.split_corrupt(reader.read_array_lines(spark, path, _FILE_SCHEMA))
    both = good.select(F.lit(True).alias("ok")).unionAll(bad.select(F.lit(False).alias("ok")))
    return both.agg(F.count_if(F.col("ok")).alias("readable"), F.count_if(~F.col("ok")).alias("corrupt"))


@query("csv_roundtrip", "SELECT id, nullif(trim(firstName), '') AS firstName, lastName, nullif(trim(email), '') AS email, phone, nullif(companyName, '') AS companyName, city, CAST(ord AS STRING) AS ord FROM contacts_v")
def csv_roundtrip(spark, sf):
    path = f"{shared_folder(spark)}/csv"
    inputs.plain_contacts(spark, sf).select(*FILE_COLS).write.option("header", True).option("sep", ";").option("emptyValue", "").csv(path)
    return reader.read_csv_export(spark, path, ";").select(*FILE_COLS)


@query("owner_map_file", "SELECT user_id, owner_id FROM owner_map_v")
def owner_map_file(spark, sf):
    """The owner lookup written as one object and read back as rows."""
    path = f"{shared_folder(spark)}/owner-map"
    sinks.write_object(inputs.owner_map(spark, sf), path, "user_id", "owner_id")
    return reader.optional_object(spark, path, "user_id", "owner_id")


@query("merge_report_file", f"""
{_MERGES}
    SELECT count(*) FILTER (merged) AS merged, count(*) FILTER (NOT merged) AS failed,
      (SELECT count(*) FROM found_v WHERE classification = 'manual-review') AS skipped FROM s WHERE i > 0""")
def merge_report_file(spark, sf):
    """The report of a merge run on disk, read back."""
    path = f"{shared_folder(spark)}/report"
    sinks.write_report(elimination.merge_counts(inputs.duplicate_source(spark, sf)), path)
    return spark.read.schema("merged bigint, failed bigint, skipped bigint").json(path)


@query("review_csv", f"SELECT primary_id, nullif(primary_email, '') AS primary_email, trim(primary_name) AS primary_name, duplicate_id, nullif(duplicate_email, '') AS duplicate_email, trim(duplicate_name) AS duplicate_name, reason FROM found_v WHERE classification = 'manual-review'")
def review_csv(spark, sf):
    path = f"{shared_folder(spark)}/review"
    sinks.write_review_csv(review_pairs(spark, sf), path)
    return reader.read_csv_export(spark, path)


# --- incremental sync -------------------------------------------------------
_CHECKED = {
    "state": "state NOT IN ('S0', 'S1', 'S2')",
    "city": "city NOT IN (SELECT n_name FROM nation WHERE n_nationkey % 2 = 0)",
    "market_name": "market_name <> 'Denver'",
    "assigned_coach": "assigned_coach NOT IN (SELECT 'Coach ' || n_nationkey FROM nation WHERE n_nationkey < 9)",
    "products_purchased": "len(list_filter(string_split(products_purchased, ';'), lambda m: m NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'))) > 0",
    "hs_timezone": "hs_timezone <> 'utc'",
    "utm_medium": "true",
    "zip": "false",
}


@query("catalog_checked_updates", f"""
    SELECT ord, {', '.join(f"CASE WHEN NOT ({bad}) THEN {p} END AS {p}" for p, bad in _CHECKED.items())},
      array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN {p} IS NOT NULL AND ({bad}) THEN '{p}' END" for p, bad in _CHECKED.items())}],
        lambda f: f IS NOT NULL)), ',') AS invalid_fields
    FROM matched_v""")
def catalog_checked_updates(spark, sf):
    """Planned writes after a check against a catalogue of the target's properties, made from the given tables."""
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")

    def listed(name, values, kind="enumeration", field="select"):
        options = F.collect_list(F.struct("value"))
        return values.agg(options.alias("options")).select(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.lit(field).alias("fieldType"), "options")

    def fixed(*values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    catalog = [
        listed("state", regions.where("r_regionkey < 3").select(F.concat(F.lit("S"), "r_regionkey").alias("value"))),
        listed("city", nations.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("value"))),
        listed("market_name", fixed("Denver")),
        listed("assigned_coach", nations.where("n_nationkey < 9").select(F.concat(F.lit("Coach "), "n_nationkey").alias("value"))),
        listed("products_purchased", table(spark, sf, "orders").select(F.col("o_orderpriority").alias("value")).distinct().where("value <> '5-LOW'"), field="checkbox"),
        listed("hs_timezone", fixed("utc")),
        listed("utm_medium", fixed(), "number", "number"),
        listed("zip", fixed(), "number", "number"),
    ]
    whole = catalog[0]
    for part in catalog[1:]:
        whole = whole.unionByName(part)
    writes = jobs.plan_updates(
        inputs.contacts(spark, sf), inputs.target(spark, sf), inputs.owner_map(spark, sf), allowlist=None, catalog=stage(whole)
    )
    return writes.select("ord", *_CHECKED, F.concat_ws(",", "invalid_fields").alias("invalid_fields"))


@query("sync_runs", """
    WITH d AS (SELECT ord % 2 AS day, count(*) AS n FROM matched_v GROUP BY ALL)
    SELECT * FROM (VALUES
      (1, 'dry', true, true, false, 1), (1, 'held', false, false, false, 1), (2, 'replayed', true, false, true, 1),
      (3, 'empty', true, false, true, 9), (4, 'ok', true, false, true, 0)) AS v(seq, run, ok, dry_run, advanced, day)
    LEFT JOIN (SELECT day, n AS changed FROM d) USING (day)""".replace("SELECT * FROM (VALUES", "SELECT CAST(seq AS BIGINT) AS seq, run, ok, dry_run, advanced, coalesce(changed, 0) AS changed FROM (VALUES"))
def sync_runs(spark, sf):
    """Run history of a dry run, a held one, its replay, an empty window and a plain run."""
    from contactloom.streaming.state import SyncState
    from contactloom.streaming.sync import run_once

    state = SyncState(spark, shared_folder(spark))
    state.publish_base(inputs.target(spark, sf), datetime(2024, 1, 1))
    changed = F.timestamp_seconds(F.unix_seconds(F.lit(datetime(2024, 1, 1, 12))) + (1 - F.col("ord") % 2) * 86400 * 4)
    source = stage(inputs.contacts(spark, sf).withColumn("dateUpdated", changed))
    lookup = stage(inputs.owner_map(spark, sf))
    runs_ = [("dry", 2, {"dry_run": True}), ("held", 2, {"max_failure_rate": -1.0}), ("replayed", 2, {}), ("empty", 4, {}), ("ok", 6, {})]
    for _, day, options in runs_:
        run_once(state, source, datetime(2024, 1, day), lookup, **options)
    names = F.array(*[F.lit(n) for n, _, _ in runs_])
    number = F.col("seq") - 1  # the base took the first number
    name = F.get(names, F.when(F.col("dry_run"), 0).otherwise(number.cast("int")))
    return state.runs().where("seq > 1").unionByName(state.dry_runs()).select(
        number.alias("seq"), name.alias("run"), "ok", "dry_run", F.col("advance_to").isNotNull().alias("advanced"), "changed"
    )


@query("incremental_sync", O.snapshot(O.OWNED))
def incremental_sync(spark, sf):
    """Two nightly runs over contacts changed on two days; returns the final target."""
    from contactloom.streaming.state import SyncState
    from contactloom.streaming.sync import run_once

    state = SyncState(spark, shared_folder(spark))
    state.publish_base(inputs.target(spark, sf), datetime(2024, 1, 1))
    changed = F.timestamp_seconds(F.unix_seconds(F.lit(datetime(2024, 1, 1, 12))) + (F.col("ord") % 2) * 86400)
    source = inputs.contacts(spark, sf).withColumn("dateUpdated", changed)
    lookup = inputs.owner_map(spark, sf)
    for day in (2, 3):
        run_once(state, source, datetime(2024, 1, day), lookup)
    return state.target().select(*SNAPSHOT_COLS)


@query("stream_sync", O.snapshot(O.OWNED))
def stream_sync(spark, sf):
    """The same through Structured Streaming over a folder of changed contacts."""
    from contactloom.streaming.state import SyncState
    from contactloom.streaming.sync import sync_stream

    root = shared_folder(spark)
    state = SyncState(spark, f"{root}/state")
    state.publish_base(inputs.target(spark, sf), datetime(2024, 1, 1))
    changed = F.timestamp_seconds(F.unix_seconds(F.lit(datetime(2024, 1, 1, 12))) + (F.col("ord") % 2) * 86400)
    source = inputs.contacts(spark, sf).withColumn("dateUpdated", changed)
    source.write.parquet(f"{root}/changes")
    stream = spark.readStream.schema(source.schema).parquet(f"{root}/changes")
    sync_stream(state, stream, f"{root}/checkpoint", inputs.owner_map(spark, sf)).awaitTermination()
    return state.target().select(*SNAPSHOT_COLS)


@query(
    "stream_dedup",
    """SELECT id, count(*) AS n_changes, min(epoch_us(dateUpdated)) AS first_us, max(epoch_us(dateUpdated)) AS last_us
       FROM (SELECT DISTINCT id, dateUpdated FROM delta_v) GROUP BY id""",
)
def stream_dedup(spark, sf):
    """Change rows that arrive twice in one micro-batch and again after a restart reach the step once."""
    from contactloom.streaming.repeats import without_repeats

    root = shared_folder(spark)
    rows = inputs.delta(spark, sf).select("ord", "id", "tags", "dateUpdated")

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/seen/batch={batch_id}")

    for wave in (rows.where("ord % 3 <> 0").unionByName(rows.where("ord % 5 = 1")), rows):
        wave.write.mode("append").parquet(f"{root}/changes")
        stream = without_repeats(spark.readStream.schema(rows.schema).parquet(f"{root}/changes"))
        stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    micros = F.unix_micros(F.col("dateUpdated").cast("timestamp"))
    return spark.read.schema(rows.schema).parquet(f"{root}/seen").groupBy("id").agg(
        F.count(F.lit(1)).alias("n_changes"), F.min(micros).alias("first_us"), F.max(micros).alias("last_us")
    )
