"""DuckDB views that restate the rules independently, for the result check."""

from __future__ import annotations

from contactloom import rules

WS = " "


def values(rows: list[tuple], alias: str, cols: str) -> str:
    def lit(v):
        return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) {alias}({cols})"


def ranked(table: list[tuple[str, str]]) -> str:
    return values([(i, t, v) for i, (t, v) in enumerate(table)], "t", "rank, tag, value")


def bare(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\{{\\{{[^}}]*\\}}\\}}', '', 'g'))"


STRINGS = rules.CONTACT_STRING_FIELDS

STRIPPED = ", ".join(
    f"CASE WHEN {bare(c)} = {c} THEN {c} ELSE nullif({bare(c)}, '') END AS {c}" for c in STRINGS
)
PLACEHOLDERS = ", ".join(
    f"CASE WHEN {bare(c)} <> {c} THEN 'placeholder:{c}' END" for c in STRINGS
)
HTML = ", ".join(
    f"nullif(trim(regexp_replace({c}, '<[^>]+>', '', 'g')), '') AS {c}" for c in rules.HTML_FIELDS
)
PHONEY = "regexp_full_match({}, '[+0-9\\s\\-().]{{7,}}')"
MAIL_OK = "regexp_full_match(lower(trim(email)), '[^\\s@]+@[^\\s@]+\\.[^\\s@]+')"
E164_OK = "regexp_full_match(phone, '\\+[0-9]{7,15}')"
DIGITS = "regexp_replace(phone, '[^0-9]', '', 'g')"
SALVAGED = (
    f"CASE WHEN length({DIGITS}) = 10 THEN '+1' || {DIGITS} "
    f"WHEN length({DIGITS}) = 11 AND {DIGITS} LIKE '1%' THEN '+' || {DIGITS} END"
)

TIER = ranked(rules.BUYER_TIERS)
CANCEL = ranked(rules.CANCELLATIONS)
FULFIL = ranked(rules.FULFILLMENTS)
CITIES = values(list(rules.CITY_CODES.items()), "c", "code, city")

# populated properties of the test views, in property order
FILLED = [
    "firstname", "lastname", "company", "address", "city", "state", "zip", "country",
    "website", "hs_timezone", "utm_source", "utm_medium", "buyer_tier",
    "cancellation_status", "fulfillment_status", "eventtag", "sms_engmt_score",
    "market_name", "workshop_payment_status", "workshop_paid", "workshop_total",
    "workshop_purchase_date", "preview_purchase_date", "products_purchased",
    "number_of_coaching_sessions_purchased", "assigned_coach", "lifecyclestage",
    "hubspot_owner_id",
]
WITHHELD = ["fulfillment_status", "assigned_coach", "lifecyclestage", "hubspot_owner_id"]
OWNED = [p for p in FILLED if p not in WITHHELD]
IN_TARGET = {
    "firstname", "lastname", "company", "city", "assigned_coach", "lifecyclestage",
    "hubspot_owner_id", "buyer_tier",
}


def snapshot(props: list[str]) -> str:
    """Target after applying updates (limited to ``props``) and inserts."""
    def old(p):
        return f"t.{p}" if p in IN_TARGET else "NULL"

    updated = ", ".join(
        f"coalesce(u.{p}, {old(p)}) AS {p}" if p in props else f"{old(p)} AS {p}" for p in FILLED
    )
    changes = ", ".join(f"arg_max_null({p}, ord) AS {p}" for p in props)
    folded = ", ".join(f"arg_max({p}, ord) AS {p}" for p in FILLED)
    return f"""
        SELECT t.hs_id, t.email, t.phone, t.engager_contact_id, {updated}
        FROM target_v t LEFT JOIN (
          SELECT hs_id, {changes} FROM matched_v WHERE action = 'update' GROUP BY hs_id
        ) u ON t.hs_id = u.hs_id
        UNION ALL
        SELECT 'new:' || arg_min(id, ord) AS hs_id, arg_min_null(email, ord) AS email,
          arg_min_null(phone, ord) AS phone, arg_min(id, ord) AS engager_contact_id, {folded}
        FROM matched_v WHERE action = 'insert'
        GROUP BY coalesce(email, '~' || ord)"""


ORACLE_VIEWS = {
    "bare_v": f"SELECT * REPLACE ({STRIPPED}), concat_ws(',', {PLACEHOLDERS}) AS found FROM contacts_v",
    "tidy_v": f"SELECT * REPLACE ({HTML}) FROM bare_v",
    "clean_v": f"""
        SELECT * REPLACE (
          CASE WHEN {PHONEY.format('firstName')} THEN NULL ELSE firstName END AS firstName,
          CASE WHEN {PHONEY.format('lastName')} THEN NULL ELSE lastName END AS lastName,
          CASE WHEN email = '' THEN '' WHEN {MAIL_OK} THEN lower(trim(email)) END AS email,
          CASE WHEN phone = '' OR {E164_OK} THEN phone ELSE {SALVAGED} END AS phone),
          concat_ws(',', nullif(found, ''),
            CASE WHEN {PHONEY.format('firstName')} THEN 'phone_as_name:firstName' END,
            CASE WHEN {PHONEY.format('lastName')} THEN 'phone_as_name:lastName' END,
            CASE WHEN email <> '' AND NOT {MAIL_OK} THEN 'invalid_email' END,
            CASE WHEN phone <> '' AND NOT {E164_OK} THEN
              CASE WHEN {SALVAGED} IS NULL THEN 'phone_unparseable' ELSE 'phone_normalized' END END
          ) AS issues
        FROM tidy_v""",
    "tier_v": f"SELECT user_id, arg_min(value, rank) AS buyer_tier FROM tag_first_v JOIN {TIER} USING (tag) GROUP BY user_id",
    "cancel_v": f"SELECT user_id, arg_min(value, rank) AS cancellation_status FROM tag_first_v JOIN {CANCEL} USING (tag) GROUP BY user_id",
    "fulfil_v": f"SELECT user_id, arg_min(value, rank) AS fulfillment_status FROM tag_first_v JOIN {FULFIL} USING (tag) GROUP BY user_id",
    "codes_v": """
        SELECT user_id, code, min(pos) AS pos FROM (
          SELECT user_id, pos, lower(regexp_extract(tag, '^[0-9]{8}_([a-zA-Z]{2,5})', 1)) AS code FROM tag_first_v
        ) WHERE code <> '' GROUP BY user_id, code""",
    "cities_v": f"SELECT user_id, string_agg(city, ';' ORDER BY pos) AS eventtag FROM codes_v JOIN {CITIES} USING (code) GROUP BY user_id",
    "decoded_v": """
        SELECT 'c' || k AS id,
          CAST(total AS DOUBLE) AS workshop_paid,
          total + 0.5::DOUBLE AS workshop_total,
          CAST(n || '7' AS BIGINT) AS sms_engmt_score,
          strftime(last_date, '%Y-%m-%d') AS workshop_purchase_date,
          CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN '2020-13-45'
               ELSE strftime(first_date, '%Y-%m-%d') END AS preview_purchase_date_raw,
          CASE k % 4 WHEN 2 THEN 'Denver' WHEN 3 THEN NULL ELSE 'San Francisco' END AS market_name,
          CASE WHEN k % 6 < 2 THEN NULL ELSE 'Paid in Full' END AS workshop_payment_status,
          nullif(concat_ws(';', CASE WHEN p1 = 1 THEN '1-URGENT' END, CASE WHEN p2 = 1 THEN '2-HIGH' END,
            CASE WHEN p5 = 1 THEN '5-LOW' END), '') AS products_purchased,
          n AS number_of_coaching_sessions_purchased,
          'Coach ' || (n % 16) AS assigned_coach,
          trim(hs_ref) AS hs_contact_id, guest_ref AS guest_group_ref
        FROM custom_v""",
    "owner_map_v": """
        SELECT u.id AS user_id, u.name, u.email, o.owner_id FROM users_v u LEFT JOIN (
          SELECT lower(email) AS e, arg_max(id, ord) AS owner_id FROM owners_v GROUP BY lower(email)
        ) o ON lower(u.email) = o.e""",
    "mapped_v": """
        SELECT c.id, c.ord, c.k, c.r, d.hs_contact_id, d.guest_group_ref,
          c.id AS engager_contact_id, nullif(c.email, '') AS email, nullif(c.phone, '') AS phone,
          c.firstName AS firstname, c.lastName AS lastname, nullif(c.companyName, '') AS company,
          c.address1 AS address, c.city, c.state, c.postalCode AS zip, c.country, c.website,
          CASE WHEN contains(c.timezone, '/') OR upper(c.timezone) IN ('UTC', 'GMT')
               THEN replace(lower(c.timezone), '/', '_slash_') END AS hs_timezone,
          nullif(coalesce(c.utm_raw, c.session_raw), '') AS utm_source, nullif(c.medium_raw, '') AS utm_medium,
          tier_v.buyer_tier, cancel_v.cancellation_status, fulfil_v.fulfillment_status, cities_v.eventtag,
          d.sms_engmt_score, d.market_name, d.workshop_payment_status, d.workshop_paid, d.workshop_total,
          d.workshop_purchase_date,
          d.preview_purchase_date_raw AS preview_purchase_date,
          d.products_purchased, d.number_of_coaching_sessions_purchased, d.assigned_coach,
          lower(c.type) AS lifecyclestage, m.owner_id AS hubspot_owner_id
        FROM clean_v c
        LEFT JOIN decoded_v d ON c.id = d.id
        LEFT JOIN tier_v ON c.k = tier_v.user_id
        LEFT JOIN cancel_v ON c.k = cancel_v.user_id
        LEFT JOIN fulfil_v ON c.k = fulfil_v.user_id
        LEFT JOIN cities_v ON c.k = cities_v.user_id
        LEFT JOIN owner_map_v m ON c.assignedTo = m.user_id""",
    "index_v": """
        SELECT key, arg_max(hs_id, ord * 10 + kind) AS hs_id FROM (
          SELECT nullif(lower(trim(email)), '') AS key, 0 AS kind, hs_id, ord FROM target_v
          UNION ALL SELECT nullif(trim(phone), ''), 1, hs_id, ord FROM target_v
          UNION ALL SELECT nullif(trim(engager_contact_id), ''), 2, hs_id, ord FROM target_v
        ) WHERE key IS NOT NULL GROUP BY key""",
    "matched_v": """
        SELECT m.*,
          CASE WHEN coalesce(hs_contact_id, e.hs_id, p.hs_id) IS NOT NULL THEN 'update'
               WHEN email IS NOT NULL OR phone IS NOT NULL THEN 'insert' ELSE 'unresolvable' END AS action,
          coalesce(hs_contact_id, e.hs_id, p.hs_id) AS hs_id,
          CASE WHEN hs_contact_id IS NOT NULL THEN 'hubspot_contact_id' WHEN e.hs_id IS NOT NULL THEN 'email'
               WHEN p.hs_id IS NOT NULL THEN 'phone' END AS matched_on
        FROM mapped_v m LEFT JOIN index_v e ON m.email = e.key LEFT JOIN index_v p ON m.phone = p.key""",
    "dup_v": """
        SELECT 'h' || ord AS hs_id, ord, email, phone, companyName AS company, website, firstName AS firstname, lastName AS lastname,
          lower(coalesce(firstName, '')) || '|' || lower(coalesce(lastName, '')) AS name_key,
          coalesce(email, '') AS e, regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g') AS p,
          split_part(coalesce(email, ''), '@', 1) AS l, split_part(coalesce(email, ''), '@', 2) AS d,
          CASE WHEN ord % 4 <> 0 THEN 1609459200 + (ord % 9) * 86400 ELSE 1577836800 + ord * 86400 END AS seen
        FROM clean_v WHERE coalesce(firstName, '') <> '' OR coalesce(lastName, '') <> ''""",
    "pair_v": """
        SELECT a.ord AS ord_a, b.ord AS ord_b, a.name_key,
          CASE WHEN a.e = '' OR b.e = '' THEN
                 CASE WHEN a.p = b.p AND length(a.p) >= 10 THEN 'same_phone_one_no_email' END
               WHEN a.e = b.e THEN NULL
               WHEN a.l = b.l AND levenshtein(a.d, b.d) <= 2 THEN 'domain_typo'
               WHEN a.d = b.d AND levenshtein(a.l, b.l) <= 1 THEN 'local_typo'
               WHEN levenshtein(a.e, b.e) <= 2 THEN 'email_typo'
               WHEN a.p = b.p AND length(a.p) >= 10 THEN 'same_phone_different_email'
               WHEN a.l = b.l AND length(a.l) >= 4 THEN 'same_local_different_domain'
               WHEN levenshtein(a.e, b.e) <= 4 THEN 'possible_email_typo' END AS reason,
          CASE WHEN (a.d IN (""" + ", ".join(f"'{d}'" for d in rules.COMMON_MAIL_DOMAINS) + """)) <>
                    (b.d IN (""" + ", ".join(f"'{d}'" for d in rules.COMMON_MAIL_DOMAINS) + """))
                 THEN a.d IN (""" + ", ".join(f"'{d}'" for d in rules.COMMON_MAIL_DOMAINS) + """)
               WHEN (a.e <> '') <> (b.e <> '') THEN a.e <> ''
               ELSE a.seen >= b.seen END AS keep_a,
          a.hs_id AS id_a, b.hs_id AS id_b, a.email AS email_a, b.email AS email_b,
          concat(a.firstname, ' ', a.lastname) AS name_a, concat(b.firstname, ' ', b.lastname) AS name_b
        FROM dup_v a JOIN dup_v b ON a.name_key = b.name_key AND a.ord < b.ord""",
    "found_v": """
        SELECT name_key, ord_a, ord_b, CASE WHEN keep_a THEN id_a ELSE id_b END AS primary_id,
          coalesce(CASE WHEN keep_a THEN email_a ELSE email_b END, '') AS primary_email,
          CASE WHEN keep_a THEN name_a ELSE name_b END AS primary_name,
          CASE WHEN keep_a THEN id_b ELSE id_a END AS duplicate_id,
          coalesce(CASE WHEN keep_a THEN email_b ELSE email_a END, '') AS duplicate_email,
          CASE WHEN keep_a THEN name_b ELSE name_a END AS duplicate_name,
          reason,
          CASE WHEN reason IN ('same_local_different_domain', 'possible_email_typo')
               THEN 'manual-review' ELSE 'auto-merge' END AS classification
        FROM pair_v WHERE reason IS NOT NULL""",
}
