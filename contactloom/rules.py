"""Fixed rule tables of the migration.

Everything in this module is a FIXED VALUE: names, codes, patterns and lists
that results depend on.  Logic lives in ``functions`` and ``operators``.
"""

# --- fixed values: source contact columns -----------------------------------
CONTACT_STRING_FIELDS = [
    "id", "firstName", "lastName", "email", "phone", "companyName",
    "address1", "city", "state", "postalCode", "country", "website",
    "timezone", "type", "assignedTo",
]

HTML_FIELDS = ["firstName", "lastName", "address1", "city", "companyName"]

NAME_FIELDS = ["firstName", "lastName"]

# --- fixed values: source column -> target property, plain renames ----------
STANDARD_FIELDS = [
    ("id", "engager_contact_id"),
    ("firstName", "firstname"),
    ("lastName", "lastname"),
    ("email", "email"),
    ("phone", "phone"),
    ("companyName", "company"),
    ("address1", "address"),
    ("city", "city"),
    ("state", "state"),
    ("postalCode", "zip"),
    ("country", "country"),
    ("website", "website"),
]

IDENTITY_PROPERTIES = ["engager_contact_id", "email", "phone"]

# --- fixed values: custom field id, target property, transform --------------
# A property starting with "_" is routed to a side column, not written.
CUSTOM_FIELDS = [
    ("plLjgTFOde5EUxJWWDLl", "_hubspot_contact_id", "text"),
    ("0F0eNZMequj4JEf4AdgC", "_guest_group_ref", "text"),
    ("agPOPXVU1qhYnjJxPz7V", "sms_engmt_score", "integer"),
    ("dW752RjWvFrfBjpeSoTt", "email_engmt_score", "integer"),
    ("XbsASg0C5TDPgSDV2ELo", "market_name", "text"),
    ("ZwJCtoQ4rG7eqZCJap0e", "community_join_date", "date"),
    ("1rnHjHmUbV5XkqyEVVHx", "workshop_payment_status", "text"),
    ("242BK1r5mwKE4NDdEspk", "workshop_payment_balance", "decimal"),
    ("2xvxtcUmOpov38NTSDCK", "workshop_payment_history", "text"),
    ("eDlnaObiYujDnYMw8JWh", "workshop_paid", "decimal"),
    ("YZh2Mu66sJeJGrLstXv7", "workshop_total", "decimal"),
    ("fIDq2FxIMPoE2S6pSdiz", "workshop_purchase_date", "date"),
    ("kTLTRPGnknC02980X6t9", "workshop_payment_type", "multi_select"),
    ("lQyCkSrBQtsO5nOxGgCP", "payment_transaction_id", "text"),
    ("crA7d9feEZgISV16vIVs", "preview_payment_status", "text"),
    ("NAVv2mYKtw0dUjaECJDa", "preview_payment_balance", "decimal"),
    ("5tSC6RTUtYNvLeH3yqSy", "preview_paid", "decimal"),
    ("oModmzrZ6Xb6Zi3q4SAq", "preview_purchase_date", "date"),
    ("7XwHuqb1U7MqSw4D3YLt", "preview_payment_methods", "multi_select"),
    ("el6MOEH09mMT291Ouhez", "preview_sales_total", "decimal"),
    ("0b6zq88gXLBCNzDP325l", "preview_invoice_id_payment_id", "text"),
    ("1AhH8EKwizmtvm2gw45U", "preview_attendance_status", "text"),
    ("GbGvpdfbVyeGAvCI1PpX", "workshop_product_package", "text"),
    ("WuVyUtalsgS5TPA3OhIF", "products_purchased", "multi_select"),
    ("LBzOL7RhOiZMgaveKGor", "number_of_coaching_sessions_purchased", "integer"),
    ("tJH0BERoeDzTDFZpFIZW", "assigned_coach", "text"),
    ("5ltkMoMxesQAoJzpScck", "coaching_sessions_fulfilled", "multi_select"),
    ("bmw20X9pY8b8FKwEu3ur", "workshop_team", "multi_select"),
    ("sPkhkhdYIas4n3iTuNql", "preview_sales_rep", "multi_select"),
    ("XH1v6DpEIkJiC2VEvlDb", "telesales_repteam", "multi_select"),
    ("Rq7cnsHuFoM5ToszZoMN", "workshop_attendance_status", "text"),
    ("AslBpu7YJRTEWxGG5Vac", "foundations_attendance_status", "text"),
    ("8C4y1RyeYLG3fpywBSfP", "auction_attendance_status", "text"),
    ("27987mgyDDic9Bs6KZEI", "commercial_attendance_status", "text"),
    ("m5BMgHBqYfwBvs77U31A", "expo_attendance_status", "text"),
    ("O1g8LKalb7jsHSPb5Oyo", "summit_attendance_status", "text"),
    ("R9yZyQMKm8bZKMvqAXrB", "symposium_attendance_status", "text"),
    ("fDwc1oHV1sQu0mKQoQOJ", "workshop_date_fulfilled", "date"),
    ("tIjqcLNkPtmYw7JEeQYE", "foundations_date_fulfilled", "date"),
    ("O2oSJOjyWViP5lPQaXSa", "expo_bootcamp_date_fulfilled", "date"),
    ("S1HYJJQkGdiWQoeGM6bN", "auction_date_fulfilled", "date"),
    ("UpGbVgWeCs8sxpNp4oNF", "commercial_bootcamp_date_fulfilled", "date"),
    ("45sELBoFlhUH7h7onvh9", "flyout_date_fulfilled", "date"),
    ("0Sdv3wgHiYzgqeALpW8a", "summit_date_fulfilled", "date"),
    ("6BYevZMMUOPFRvNuzFfE", "propstream_date_fulfilled", "date"),
    ("8HRVUMTBzK0jS9XBJGxV", "tlc_events_attended", "multi_select"),
    ("8BtsfPuijoeNPdROqu2c", "taxentitytrust_setup_date_fulfilled", "date"),
    ("UN0xwHvklPrQEvYbnFtj", "taxentitytrust_setup", "text"),
]

# --- fixed values: tag -> buyer tier, highest priority first ----------------
BUYER_TIERS = [
    ("wb_diamond", "Workshop Buyer - Diamond"),
    ("wb", "Workshop Buyer"),
    ("telesales_diamond-elite-program", "Telesales Diamond Buyer"),
    ("telesales_diamond", "Telesales Diamond Buyer"),
    ("telesales_sold", "Telesales Buyer"),
    ("phase-preview-buyer", "Preview Buyer"),
    ("phase_preview-attendee", "Preview Attendee"),
    ("phase_preview-reg", "Preview Registrant"),
    ("phase_preview-non-attendee", "Preview Non-Attendee"),
    ("pna", "Preview Non-Attendee"),
    ("community_newmember_directsignup", "Registrant"),
    ("community_newmember", "Registrant"),
]

# --- fixed values: tag -> cancellation status, first match wins -------------
CANCELLATIONS = [
    ("workshop_cancel_reg", "Workshop Cancelled"),
    ("foundations_cancel_reg", "Foundations Cancelled"),
    ("all_products_cancelled", "All Cancelled"),
    ("cancel", "All Cancelled"),
]

# --- fixed values: tag -> fulfillment status, first match wins --------------
FULFILLMENTS = [
    ("coaching_user_created_in_tlc", "Coaching Active"),
    ("coaching_sessions_purchased", "Coaching Purchased"),
    ("community-assign-space", "Community Active"),
    ("marketplace_account", "Marketplace Active"),
    ("user_created", "Portal Active"),
    ("user_subscribed", "Subscribed"),
]

# --- fixed values: event-tag city code -> city ------------------------------
CITY_CODES = {
    "aus": "Austin", "cae": "Columbia", "ccr": "Concord", "cle": "Cleveland",
    "dtw": "Detroit", "fre": "Fresno", "hnl": "Honolulu", "ind": "Indianapolis",
    "jfk": "New York", "lax": "Los Angeles", "lbb": "Lubbock", "mdt": "Harrisburg",
    "mnh": "Manhasset", "ord": "Chicago", "orf": "Norfolk", "phl": "Philadelphia",
    "phx": "Phoenix", "pit": "Pittsburgh", "san": "San Diego", "sat": "San Antonio",
    "sba": "Santa Barbara", "spo": "Spokane", "wbs": "West Palm Beach", "tpa": "Tampa",
    "mia": "Miami", "rdu": "Raleigh", "atl": "Atlanta", "bhm": "Birmingham",
    "boi": "Boise", "knx": "Knoxville", "roc": "Rochester", "mob": "Mobile",
    "dfw": "Dallas", "ftw": "Fort Worth", "dca": "Washington DC", "oma": "Omaha",
    "mem": "Memphis", "bos": "Boston", "ods": "Odessa", "ewr": "Newark",
    "sea": "Seattle", "anc": "Anchorage", "ftm": "Fort Myers", "bwi": "Baltimore",
    "mco": "Orlando", "jax": "Jacksonville", "ftl": "Fort Lauderdale", "cmh": "Columbus",
    "ric": "Richmond", "clt": "Charlotte", "mci": "Kansas City", "ken": "Kennewick",
    "gsb": "Greensboro", "bmh": "Birmingham", "har": "Hartford", "gsp": "Greenville",
    "iah": "Houston", "okc": "Oklahoma City", "lit": "Little Rock", "las": "Las Vegas",
    "bna": "Nashville", "den": "Denver", "tus": "Tucson", "lou": "Louisville",
    "mke": "Milwaukee", "mlw": "Milwaukee", "ont": "Ontario", "sfo": "San Francisco",
    "bur": "Burbank", "pdx": "Portland OR", "pwm": "Portland ME", "elp": "El Paso",
    "smf": "Sacramento", "alb": "Albany", "stl": "St. Louis", "shv": "Shreveport",
    "grb": "Green Bay", "dsm": "Des Moines", "mca": "Mcallen",
}

# --- fixed values: market-name aliases --------------------------------------
MARKET_ALIASES = {"san fran": "San Francisco", "sf": "San Francisco"}

# --- fixed values: field ownership on updates -------------------------------
STANDARD_PROPERTIES = [
    "firstname", "lastname", "company", "address", "city", "state", "zip",
    "country", "website", "hs_timezone", "utm_source", "utm_medium",
    "buyer_tier", "cancellation_status", "fulfillment_status", "eventtag",
]

PROTECTED_PROPERTIES = [
    "assigned_coach",
    "workshop_team", "preview_sales_rep", "telesales_repteam",
    "fulfillment_status",
    "preview_attendance_status", "workshop_attendance_status",
    "foundations_attendance_status", "auction_attendance_status",
    "commercial_attendance_status", "expo_attendance_status",
    "summit_attendance_status", "symposium_attendance_status",
]

# --- fixed values: reasons and match labels ---------------------------------
MATCHED_ON = ["hubspot_contact_id", "email", "phone"]
UNRESOLVABLE_REASON = "No hubspotContactId, email, or phone — cannot match or create safely"

# --- fixed values: duplicate detection --------------------------------------
COMMON_MAIL_DOMAINS = [
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com",
    "aol.com", "icloud.com", "me.com", "live.com", "msn.com",
]

REVIEW_COLUMNS = [
    "primary_id", "primary_email", "primary_name",
    "duplicate_id", "duplicate_email", "duplicate_name", "reason",
]

# --- fixed values: validation field classes ---------------------------------
NUMERIC_FIELDS = [
    "workshop_paid", "workshop_total", "workshop_payment_balance",
    "preview_sales_total", "sms_engmt_score", "email_engmt_score",
]
SKIPPED_FIELDS = ["email", "phone", "engager_contact_id", "hubspot_owner_id"]
WARN_ONLY_FIELDS = ["utm_source", "utm_medium", "cancellation_status"]
CASELESS_FIELDS = ["firstname", "lastname"]

# --- fixed values: sync defaults --------------------------------------------
LOOP_GUARD_TAGS = ["hs-to-hl", "hs-transfer"]
DEFAULT_LOOKBACK_HOURS = 24
MAX_FAILURE_RATE = 0.1
RUN_HISTORY = 30
WINDOW_CAP = 10000
WINDOW_ANCHOR = "2020-01-01"
COUNT_TOLERANCE = 0.001

# --- fixed values: enumeration domains --------------------------------------
TIER_OPTIONS = [
    "Workshop Buyer - Diamond", "Workshop Buyer", "Telesales Diamond Buyer",
    "Telesales Buyer", "Preview Buyer", "Preview Attendee",
    "Preview Registrant", "Preview Non-Attendee", "Registrant",
]
CANCELLATION_OPTIONS = ["Workshop Cancelled", "Foundations Cancelled", "All Cancelled"]
FULFILLMENT_OPTIONS = [
    "Coaching Purchased", "Coaching Active", "Community Active",
    "Portal Active", "Marketplace Active", "Subscribed",
]

# --- fixed values: options appended to existing enumerations ----------------
#: Field type of a property where its type does not say it.
FIELD_TYPES = {"fulfillment_status": "checkbox"}
NEW_OPTIONS = {
    "event_type": ["Foundations", "Commercial", "Expo", "Fly Out"],
    "eventtag": ["West Palm Beach", "New York", "Manhasset"],
}

# --- fixed values: tags reported by the selected-tag check ------------------
CHECKED_TAGS = [
    "wb", "wb_diamond", "WB", "WB_DIAMOND", "phase-preview-buyer",
    "phase_preview-buyer", "telesales_sold", "telesales_diamond",
    "community_newmember",
]

# --- fixed values: tag patterns that never reach the target -----------------
SYSTEM_TAG_PATTERNS = [
    r"^hs_transfer$",
    r"^pb$",
    r"^pb_",
    r"^202[0-9]{3,5}_phoneburner_",
    r"^removed_from_ot$",
    r"^sent-post-event-survey$",
    r"^addressform_nothanks$",
    r"^reg_confirm_sms_test$",
    r"^fbla-messenger-sequence-v1",
]

# --- fixed values: tag pattern -> event type, first match wins --------------
EVENT_TYPES = [
    (r"^(phase_preview-|preview_app_)", "Preview"),
    (r"^wb(_|$)|workshop", "Workshop"),
    (r"advanced[-_ ]?camp", "Advanced Camp"),
    (r"foundations", "Foundations"),
    (r"commercial", "Commercial"),
    (r"expo", "Expo"),
    (r"fly[-_ ]?out", "Fly Out"),
]

# --- fixed values: engagement tag -> action, first match wins ---------------
ENGAGEMENT_ACTIONS = [
    ("e2i-email unsubscribe", "opt_out"),
    ("e2i-email unengaged", "suppress_email"),
    ("e2i-sms unengaged", "suppress_sms"),
    ("e2i-email engaged", "none"),
    ("e2i-sms engaged", "none"),
]

# --- fixed values: migration tiers ------------------------------------------
TIER_NAMES = {1: "Workshop Buyers", 2: "Preview Buyers", 3: "General Registrants"}


# --- derived lists ----------------------------------------------------------
CUSTOM_PROPERTIES = [p for _, p, _ in CUSTOM_FIELDS if not p.startswith("_")]

UPDATE_ALLOWLIST = [
    p for p in STANDARD_PROPERTIES + CUSTOM_PROPERTIES if p not in PROTECTED_PROPERTIES
]

# every property column of a mapped record, in output order
PROPERTIES = (
    IDENTITY_PROPERTIES
    + STANDARD_PROPERTIES
    + CUSTOM_PROPERTIES
    + ["lifecyclestage", "hubspot_owner_id"]
)

NUMBER_TRANSFORMS = {"integer": "bigint", "decimal": "double"}
PROPERTY_TYPES = {
    p: NUMBER_TRANSFORMS.get(t, "string") for _, p, t in CUSTOM_FIELDS if not p.startswith("_")
}


def property_type(name):
    return PROPERTY_TYPES.get(name, "string")
