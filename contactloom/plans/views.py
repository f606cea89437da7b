"""Contact, target, opportunity and catalog views derived from the given tables.

Each view is one SQL text that Spark and DuckDB both run; ``$x`` marks the few
places where the dialects differ and the table names.  Every row of the base
table appears in its view; values vary by key so that each rule is exercised.
"""

from __future__ import annotations

import re
from string import Template

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

DIALECT = {
    "spark": {
        "ymd": "date_format(ts, 'yyyyMMdd')",
        "epoch_days": "CAST(datediff(CAST({} AS DATE), DATE '1970-01-01') AS BIGINT)",
        "at_second": "timestamp_seconds({})",
        "day_text": "date_format({}, 'yyyy-MM-dd')",
    },
    "duckdb": {
        "ymd": "strftime(ts, '%Y%m%d')",
        "epoch_days": "date_diff('day', DATE '1970-01-01', CAST({} AS DATE))",
        "at_second": "make_timestamp(({}) * 1000000)",
        "day_text": "strftime({}, '%Y-%m-%d')",
    },
}

VIEWS = {
    # customers as raw source contacts: blocks of twelve share a last name
    "keys_v": """
        SELECT c_custkey AS k, CAST(floor(c_custkey / 12) AS BIGINT) AS b, c_custkey % 12 AS r,
               c_nationkey, c_mktsegment, c_acctbal, n_name, n_regionkey
        FROM $customer JOIN $nation ON c_nationkey = n_nationkey""",
    "phones_v": """
        SELECT keys_v.*, lpad(CAST(CASE WHEN r IN (0, 5, 9) THEN 12 * b ELSE k END AS STRING), 7, '0') AS p7
        FROM keys_v""",
    "contacts_v": """
        SELECT k, b, r, k AS ord, 'c' || k AS id,
          CASE WHEN k % 23 = 0 THEN '555-123-' || lpad(CAST(k AS STRING), 7, '0')
               WHEN k % 19 = 0 THEN '<b>Ann</b>'
               WHEN k % 17 = 0 THEN '{{contact.first_name}}'
               ELSE ' Ann' END AS firstName,
          'Lee' || b AS lastName,
          CASE WHEN r = 0 THEN 'usr' || b || '@gmail.com'
               WHEN r = 1 THEN 'Usr' || b || '@gmsil.com '
               WHEN r = 2 THEN 'us' || b || '@gmail.com'
               WHEN r = 3 THEN 'usr' || b || '@yahoo.com'
               WHEN r = 4 THEN 'usr' || b || '@corp.example.com'
               WHEN r = 5 THEN NULL
               WHEN r = 6 THEN 'bad-email'
               WHEN r = 7 THEN 'User' || b || 'X@gmail.com'
               WHEN r = 8 THEN 'usr' || CAST(floor(b / 2) AS BIGINT) || 'xyz@gmail.com'
               WHEN r = 9 THEN 'other' || b || '@live.com'
               WHEN r = 10 THEN ' usr' || b || '@gmail.com'
               ELSE 'usrr' || b || '@gmal.com' END AS email,
          CASE WHEN r = 6 THEN NULL
               WHEN k % 13 = 0 THEN '12345'
               WHEN k % 5 = 0 THEN '(555) ' || substr(p7, 1, 3) || '-' || substr(p7, 4, 4)
               WHEN k % 11 = 0 THEN '1-555-' || p7
               ELSE '+1555' || p7 END AS phone,
          CASE WHEN k % 9 = 0 THEN '' ELSE c_mktsegment || ' Co' END AS companyName,
          CASE WHEN k % 10 = 0 THEN '<p>' || k || ' Main</p>' ELSE k || ' Main St' END AS address1,
          n_name AS city, 'S' || n_regionkey AS state,
          lpad(CAST(k AS STRING), 7, '0') AS postalCode,
          CASE WHEN k % 8 = 0 THEN '{{country}}' ELSE 'US' END AS country,
          CASE WHEN k % 6 = 0 THEN NULL ELSE 'http://www' || b || '.example.com' END AS website,
          CASE k % 4 WHEN 0 THEN 'America/Denver' WHEN 1 THEN 'UTC' WHEN 2 THEN 'prince' END AS timezone,
          CASE k % 2 WHEN 0 THEN 'Customer' ELSE 'lead' END AS type,
          'u' || c_nationkey AS assignedTo,
          CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'src' || (k % 5) END AS utm_raw,
          'session' || (k % 3) AS session_raw,
          CASE k % 4 WHEN 0 THEN '' ELSE 'm' || (k % 4) END AS medium_raw
        FROM phones_v""",
    # the event log as tags per contact
    "tag_rows_v": """
        SELECT user_id, event_id * 2 AS pos,
          CASE event_type
            WHEN 'purchase' THEN CASE user_id % 5 WHEN 0 THEN 'wb' WHEN 1 THEN 'wb_diamond'
                 WHEN 2 THEN 'telesales_sold' WHEN 3 THEN 'pna' ELSE 'phase_preview-reg' END
            WHEN 'signup' THEN CASE user_id % 7 WHEN 0 THEN 'e2i-email unsubscribe'
                 WHEN 1 THEN 'e2i-sms unengaged' ELSE 'community_newmember' END
            WHEN 'click' THEN CASE user_id % 3 WHEN 0 THEN 'preview_app_opened'
                 WHEN 1 THEN 'expo_2024' ELSE 'phase-preview-buyer' END
            WHEN 'error' THEN CASE user_id % 4 WHEN 0 THEN 'cancel' WHEN 1 THEN 'workshop_cancel_reg'
                 WHEN 2 THEN 'pb_20240101_x' ELSE 'removed_from_ot' END
            ELSE CASE user_id % 4 WHEN 0 THEN 'user_created' WHEN 1 THEN 'marketplace_account'
                 WHEN 2 THEN 'user_subscribed' ELSE 'coaching_sessions_purchased' END
          END AS tag
        FROM $events
        UNION ALL
        SELECT user_id, event_id * 2 + 1 AS pos,
          $ymd || '_' || CASE event_id % 7 WHEN 0 THEN 'aus' WHEN 1 THEN 'PHL' WHEN 2 THEN 'bhm_attended'
             WHEN 3 THEN 'bmh' WHEN 4 THEN 'mke' WHEN 5 THEN 'mlw' ELSE 'zzz' END AS tag
        FROM $events""",
    "tag_first_v": """
        SELECT user_id, tag, min(pos) AS pos, count(*) AS n FROM tag_rows_v GROUP BY user_id, tag""",
    # orders per customer as raw custom-field values
    "order_facts_v": """
        SELECT o_custkey AS k, CAST(floor(max(o_totalprice)) AS BIGINT) AS total,
               max(o_orderdate) AS last_date, min(o_orderdate) AS first_date, count(*) AS n,
               max(CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END) AS p1,
               max(CASE WHEN o_orderpriority LIKE '2%' THEN 1 ELSE 0 END) AS p2,
               max(CASE WHEN o_orderpriority LIKE '5%' THEN 1 ELSE 0 END) AS p5,
               max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS open_order
        FROM $orders GROUP BY o_custkey""",
    "custom_v": """
        SELECT k, n, total, last_date, first_date, p1, p2, p5,
          '$$' || CAST(floor(total / 1000) AS BIGINT) || ',' || lpad(CAST(total % 1000 AS STRING), 3, '0') || '.50 USD' AS total_text,
          n || '.7' AS score_text,
          CASE k % 3 WHEN 0 THEN month(last_date) || '/' || day(last_date) || '/' || year(last_date)
                     WHEN 1 THEN $day_last || 'T00:00:00.000Z' END AS date_text,
          CASE WHEN k % 3 = 2 THEN $days_last * 86400000 END AS date_ms,
          CASE WHEN k % 5 = 0 THEN CAST($days_first * 86400000 AS STRING)
               WHEN k % 5 = 1 THEN '13/45/2020' ELSE $day_first END AS first_text,
          CASE k % 4 WHEN 0 THEN 'San Fran' WHEN 1 THEN ' SF' WHEN 2 THEN 'Denver' ELSE ' ' END AS market_text,
          CASE WHEN k % 6 = 0 THEN '{{contact.status}}' WHEN k % 6 = 1 THEN '' ELSE ' Paid in Full' END AS status_text,
          CASE k % 40 WHEN 7 THEN 'h' || k WHEN 9 THEN 'gone' || k WHEN 18 THEN ' h' || k || ' ' END AS hs_ref,
          CASE WHEN k % 12 = 2 THEN 'Usr' || CAST(floor(k / 12) AS BIGINT) || '@gmail.com'
               WHEN k % 12 = 3 THEN 'c' || (k - 3) WHEN k % 12 = 4 THEN 'nobody' END AS guest_ref
        FROM order_facts_v""",
    # what the target system already holds
    "target_v": """
        SELECT 'h' || k AS hs_id, k AS ord, k, r,
          CASE WHEN r = 0 THEN 'usr' || b || '@gmail.com'
               WHEN r = 1 THEN 'USR' || b || '@gmsil.com'
               WHEN r = 2 THEN 'us' || b || '@gmail.com'
               WHEN r = 4 THEN 'usr' || b || '@corp.example.com'
               WHEN r IN (7, 8, 11) THEN NULL
               ELSE 'old' || k || '@old.example.com' END AS email,
          CASE WHEN r IN (0, 7, 9) THEN '+1555' || p7 END AS phone,
          CASE WHEN k % 4 = 0 OR r IN (2, 3) THEN 'c' || k END AS engager_contact_id,
          CASE WHEN k % 5 = 0 THEN NULL ELSE 'ANN' END AS firstname,
          'Lee' || b AS lastname,
          CASE WHEN k % 3 = 0 THEN 'Old Co' END AS company,
          'Old Town' AS city,
          CASE WHEN k % 7 = 0 THEN 'Coach ' || (k % 16) END AS assigned_coach,
          'lead' AS lifecyclestage,
          CASE WHEN k % 2 = 0 THEN 'o' || c_nationkey END AS hubspot_owner_id,
          CASE WHEN k % 6 = 0 THEN 'Registrant' END AS buyer_tier,
          $created AS createdate,
          CASE WHEN k % 4 <> 0 THEN $active END AS hs_last_activity_date
        FROM phones_v""",
    "opportunities_v": """
        SELECT 'o' || o_orderkey AS id, o_orderkey AS ord, 'Deal ' || o_orderkey AS name,
          o_totalprice AS monetaryValue,
          CASE o_orderstatus WHEN 'P' THEN 'open' WHEN 'F' THEN 'won' ELSE 'lost' END AS status,
          o_orderpriority AS source, o_orderdate AS createdAt, 'p' || (o_orderkey % 11) AS pipelineId,
          CASE WHEN o_orderkey % 97 = 0 THEN 'x' || o_orderkey ELSE 'c' || o_custkey END AS contactId
        FROM $orders""",
    "users_v": """
        SELECT 'u' || n_nationkey AS id, n_name AS name,
          CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE 'Rep' || n_nationkey || '@Corp.example.com' END AS email
        FROM $nation""",
    "owners_v": """
        SELECT 'o' || s_suppkey AS id, s_suppkey AS ord,
          'rep' || CASE WHEN s_nationkey >= 20 THEN 100 + s_nationkey ELSE s_nationkey END || '@corp.EXAMPLE.com' AS email
        FROM $supplier""",
    # parts as a property catalog: brand = property, types = its options
    "options_v": """
        SELECT p_brand AS name, p_type AS value, min(p_partkey) AS ord, min(p_size) AS displayOrder
        FROM $part GROUP BY p_brand, p_type""",
    # events as changed contacts
    "delta_v": """
        SELECT event_id AS ord, 'c' || user_id AS id, event_type, ts AS dateUpdated, user_id
        FROM $events""",
}


def _fill(text: str, engine: str, names: dict[str, str]) -> str:
    d = DIALECT[engine]
    return Template(text).substitute(
        names,
        ymd=d["ymd"],
        day_last=d["day_text"].format("last_date"),
        day_first=d["day_text"].format("first_date"),
        days_last=d["epoch_days"].format("last_date"),
        days_first=d["epoch_days"].format("first_date"),
        created=d["at_second"].format("1577836800 + k * 86400"),
        active=d["at_second"].format("1609459200 + (k % 9) * 86400"),
    )


def _needed(text: str, known: dict[str, str]) -> list[str]:
    """Views a text reads, in definition order."""
    wanted: set[str] = set()

    def visit(t: str) -> None:
        for name in known:
            if name not in wanted and re.search(rf"\b{name}\b", t):
                wanted.add(name)
                visit(known[name])

    visit(text)
    return [n for n in known if n in wanted]


def oracle(text: str, extra: dict[str, str] | None = None) -> str:
    """DuckDB statement: the views a query reads, then the query."""
    known = {n: _fill(v, "duckdb", {t: t for t in TABLES}) for n, v in VIEWS.items()} | (extra or {})
    names = _needed(text, known)
    if not names:
        return text
    ctes = ",\n".join(f"{n} AS ({known[n]})" for n in names)
    body = text.strip()
    # a query with CTEs of its own continues the list
    for head in ("WITH RECURSIVE", "WITH"):
        if body.startswith(head):
            return f"{head} {ctes},\n{body[len(head):]}"
    return f"WITH {ctes}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables whose rows the views turn into contacts, by key.  A file of one row group is one task, however many rows it has,
#: and cleaning costs far more per row than the shuffle.
SPREAD = {"customer": "c_custkey"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the tables in ``sf_dir``; tables in ``SPREAD`` are dealt to tasks by their key."""
    tag = "cl_" + re.sub(r"[^a-z0-9]", "_", sf_dir.lower())
    names = {t: f"{tag}_{t}" for t in TABLES}
    parts = _needed(f"SELECT * FROM {name}", VIEWS)
    body = " ".join(VIEWS[n] for n in parts)
    for t in TABLES:
        if re.search(rf"\${t}\b", body):
            rows = table(spark, sf_dir, t)
            (rows.repartition(SPREAD[t]) if t in SPREAD else rows).createOrReplaceTempView(names[t])
    ctes = ", ".join(f"{n} AS ({_fill(VIEWS[n], 'spark', names)})" for n in parts)
    return spark.sql(f"WITH {ctes} SELECT * FROM {name}")
