"""SQL each registered query is checked with, over the given tables.

`VIEWS` holds the source-shaped views as SQL text; `with_views` puts those a query names in front.
"""

from __future__ import annotations

import re

from harness import generated

VIEWS: dict[str, str] = {}

VIEWS["f_markets"] = """
    SELECT printf('PLAT-%03d', n_nationkey) AS "PlatCode", n_name AS "PlatName",
           if(n_nationkey % 3 = 0, 'marketplace', 'specialized') AS "PlatformType",
           '{"status":"compliant","region":' || n_regionkey || '}' AS platform_compliance
    FROM nation"""
VIEWS["f_vendors"] = """
    SELECT printf('SELLER-%06d', s_suppkey) AS "SellerKey",
           if(s_suppkey % 7 = 0, '', (s_suppkey % 5000)::varchar) AS "TotalTxns",
           s_suppkey % 4900 AS "CompletedTxns", TIMESTAMP '2024-01-01' AS "LastActiveDt"
    FROM supplier"""
VIEWS["f_buyers"] = """
    SELECT printf('BUYER-%07d', c_custkey) AS "AcqCode", c_custkey % 100 AS "PurchaseCount",
           c_mktsegment AS "AuthLevel",
           '{"score":' || c_acctbal || ',"segment":' || c_nationkey || '}' AS buyer_risk_profile
    FROM customer"""
VIEWS["f_lines"] = """
    SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, p_type AS "ProdCat",
           p_brand AS "Subcategory", p_size::bigint AS "ListingAge",
           printf('SELLER-%06d', l_suppkey) AS "SellerPointer"
    FROM lineitem JOIN part ON p_partkey = l_partkey"""
VIEWS["f_products"] = """
    SELECT "ProdCat", "Subcategory", "ListingAge", "SellerPointer",
           '{"stock":' || (max(l_partkey) % 500) || ',"available":true}' AS product_availability
    FROM f_lines GROUP BY ALL"""
VIEWS["f_items"] = """
    SELECT printf('EVT-HIST-%014d', l_orderkey) AS "EventLink", "ProdCat", "Subcategory",
           "ListingAge", "SellerPointer", max(l_extendedprice)::real AS "PriceAmt",
           sum(l_quantity)::bigint AS "QtySold"
    FROM f_lines GROUP BY ALL"""
VIEWS["f_transactions"] = """
    SELECT printf('EVT-HIST-%014d', o_orderkey) AS "EventCode", o_orderdate AS "EventTimestamp",
           printf('PLAT-%03d', o_orderkey % 25) AS "PlatformKey",
           CASE WHEN sk % 10 <> 9 THEN printf('SELLER-%06d', sk) END AS "VendorLink",
           printf('BUYER-%07d', o_custkey) AS "AcqLink",
           ro.r_name AS "OriginRegion", rd.r_name AS "DestRegion",
           (ro.r_name <> rd.r_name)::bigint AS "CrossBorder",
           CASE WHEN ro.r_name <> rd.r_name THEN 'multi-hop' ELSE 'direct' END AS "RouteComplex",
           CASE WHEN ro.r_name <> rd.r_name THEN 'cross-border' ELSE 'domestic' END
               AS "Border_cross_border_pre",
           CASE WHEN o_orderkey % 11 = 0 THEN '{"amount":"n/a"}'
                ELSE '{"amount":' || o_totalprice || ',"currency":"USD","status":"'
                     || o_orderstatus || '"}' END AS transaction_financials
    FROM orders
    LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    LEFT JOIN supplier ON s_suppkey = sk
    LEFT JOIN nation no ON no.n_nationkey = s_nationkey
    LEFT JOIN region ro ON ro.r_regionkey = no.n_regionkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation nd ON nd.n_nationkey = c_nationkey
    LEFT JOIN region rd ON rd.r_regionkey = nd.n_regionkey"""
VIEWS["f_sessions"] = """
    SELECT printf('BSA-HIST-%014d', event_id) AS "BSA_id", printf('BUYER-%07d', user_id) AS acq_ref,
           ts AS session_start_time, floor(value)::integer AS session_duration_seconds,
           event_type IN ('click', 'purchase') AS checkout_initiated,
           CASE WHEN event_type <> 'error' THEN event_type = 'purchase' END AS checkout_completed
    FROM events"""
VIEWS["f_payments"] = """
    SELECT printf('PPE-HIST-%014d', l_orderkey * 1000 + n) AS "PPE_id",
           printf('EVT-HIST-%014d', l_orderkey) AS transaction_ref, l_shipdate AS event_timestamp,
           CASE l_returnflag || l_linestatus
               WHEN 'RF' THEN 'declined' WHEN 'RO' THEN 'declined'
               WHEN 'AF' THEN 'failed' WHEN 'AO' THEN 'authorized' ELSE 'settled'
           END AS processing_stage,
           n::integer AS retry_count, l_quantity::integer AS processing_time_ms
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
              l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
              l_linestatus, l_shipdate) AS n FROM lineitem)"""
VIEWS["f_risk"] = """
    SELECT printf('EVT-HIST-%014d', o_orderkey) AS "TxnLink",
           ((o_orderkey * 17) % 1000 / 1000.0)::real AS "FraudProb",
           CASE WHEN (o_orderkey * 17) % 1000 >= 700 THEN 'high'
                WHEN (o_orderkey * 17) % 1000 >= 300 THEN 'medium' ELSE 'low' END AS "ML_Risk"
    FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'"""
VIEWS["f_predictions"] = """
    SELECT printf('RMP-HIST-%014d', o_orderkey) AS "RMP_id",
           printf('EVT-HIST-%014d', o_orderkey) AS txn_link_ref,
           o_orderdate + if(o_orderstatus = 'P', -1, 1) * INTERVAL 1 DAY AS prediction_timestamp
    FROM orders"""
VIEWS["f_changes"] = """
    SELECT '0/' || hex(event_id + 256) AS lsn, (event_id // 5)::varchar AS xid,
           ts + to_hours((if(hour(ts) < 12, 18, 30) - hour(ts))::int) AS ingested_at,
           '{"action":"' || act || '"' || coalesce(',"schema":"public","table":"' || tab || '"', '')
           || if(act = 'D', ',"identity":', ',"columns":')
           || '[{"name":"id","type":"bigint","value":' || user_id
           || '},{"name":"amount","type":"numeric","value":' || value::decimal(18, 2) || '}]}' AS raw,
           event_id, user_id, value::decimal(18, 2) AS amount, act, tab
    FROM (SELECT *, CASE WHEN event_id % 17 = 0 THEN 'D' WHEN event_id % 10 = 0 THEN 'U' ELSE 'I' END AS act,
                 CASE event_type WHEN 'purchase' THEN 'transactions' WHEN 'view' THEN 'BuyerSessionAnalytics'
                      WHEN 'click' THEN 'PaymentProcessingEvents' WHEN 'signup' THEN 'buyers' END AS tab
          FROM events),
         LATERAL (SELECT unnest(range(if(event_type = 'purchase', 2, 1))))"""


def with_views(body: str) -> str:
    """Body with the views it names (and those they name) as leading CTEs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[len('WITH '):]}"
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {}

# gold ---------------------------------------------------------------------------------------

VIEWS["o_amounts"] = """
    SELECT *, try_cast(json_extract_string(transaction_financials, '$.amount') AS double) AS amount
    FROM f_transactions"""
ORACLE["daily_market_metrics"] = """
SELECT t."EventTimestamp"::date AS metric_date, t."PlatformKey" AS platform_key,
       count(*) AS transaction_count, count(DISTINCT t."AcqLink") AS unique_buyers,
       count(DISTINCT t."VendorLink") AS unique_vendors,
       round(sum(t.amount), 2) AS gross_merchandise_value,
       sum(t."CrossBorder")::bigint AS cross_border_transactions,
       sum(CASE WHEN r."ML_Risk" = 'high' THEN 1 ELSE 0 END)::bigint AS high_risk_transactions,
       coalesce(sum(bad), 0)::bigint AS payment_failed_events
FROM o_amounts t
LEFT JOIN f_risk r ON r."TxnLink" = t."EventCode"
LEFT JOIN (SELECT transaction_ref,
                  sum((processing_stage = 'declined' OR processing_stage = 'failed')::int) AS bad
           FROM f_payments GROUP BY 1) p ON p.transaction_ref = t."EventCode"
GROUP BY 1, 2"""
ORACLE["vendor_risk_summary"] = """
SELECT "SellerKey" AS seller_key, count("EventCode") AS transaction_count,
       count(DISTINCT "AcqLink") AS unique_buyers,
       round(coalesce(sum(amount), 0), 2) AS gross_merchandise_value,
       sum(CASE WHEN "ML_Risk" = 'high' THEN 1 ELSE 0 END)::bigint AS high_risk_transactions,
       round(avg("FraudProb"::double), 6) AS average_fraud_probability,
       max("EventTimestamp") AS last_transaction_at
FROM f_vendors LEFT JOIN o_amounts ON "VendorLink" = "SellerKey"
LEFT JOIN f_risk ON "TxnLink" = "EventCode"
GROUP BY 1"""
ORACLE["buyer_360"] = """
SELECT "AcqCode" AS buyer_key, coalesce(n, 0) AS transaction_count, coalesce(visits, 0) AS session_count,
       coalesce(done, 0)::bigint AS completed_checkouts, round(coalesce(spent, 0), 2) AS lifetime_value,
       round(seconds, 6) AS average_session_seconds, last_at AS last_purchase_at,
       "AuthLevel" AS auth_level, buyer_risk_profile
FROM f_buyers
LEFT JOIN (SELECT "AcqLink", count(*) AS n, sum(amount) AS spent, max("EventTimestamp") AS last_at
           FROM o_amounts GROUP BY 1) ON "AcqLink" = "AcqCode"
LEFT JOIN (SELECT acq_ref, count(*) AS visits, sum(if(checkout_completed, 1, 0)) AS done,
                  avg(session_duration_seconds) AS seconds
           FROM f_sessions GROUP BY 1) ON acq_ref = "AcqCode" """
ORACLE["product_performance"] = """
SELECT p."ProdCat" AS product_category, p."Subcategory" AS subcategory, p."ListingAge" AS listing_age,
       p."SellerPointer" AS seller_key, count("EventLink") AS transaction_count,
       coalesce(sum("QtySold"), 0)::bigint AS units_sold,
       round(coalesce(sum(("PriceAmt" * "QtySold"::real)::double), 0), 2) AS gross_revenue,
       product_availability
FROM f_products p
LEFT JOIN f_items i ON (i."ProdCat", i."Subcategory", i."ListingAge", i."SellerPointer")
                     = (p."ProdCat", p."Subcategory", p."ListingAge", p."SellerPointer")
GROUP BY ALL"""

# synthesis ----------------------------------------------------------------------------------
# Each takes its row numbers from a given table; `at` is the moment of a row, `h` a text digest.

VIEWS |= generated.history_views() | generated.seed_views() | generated.live_views()

for _name in ("markets", "vendors", "buyers", "products", "transactions", "items", "sessions",
              "payments", "risk", "predictions"):
    ORACLE[f"synth_{_name}"] = f"SELECT * FROM h_{_name}"

for _name in ("markets", "vendors", "buyers", "products"):
    ORACLE[f"seed_{_name}"] = f"SELECT * FROM s_{_name}"

# operational events -------------------------------------------------------------------------


VIEWS["e_purchases"] = f"""
    SELECT {generated.live_key("EVT", "purchase", "o_orderkey")} AS code, {generated.live_key("PPE", "payment", "o_orderkey")} AS pay,
           o_orderdate + to_seconds(o_orderkey % 86400) AS moment, o_orderkey AS k, o_custkey AS c,
           printf('SELLER-%06d', sk + 1) AS vendor, printf('BUYER-%07d', o_custkey + 1) AS buyer,
           {generated.REGIONS.sql("o_orderkey")} AS a, {generated.REGIONS.sql("o_custkey")} AS b,
           o_totalprice AS amount, least(0.99::double, (o_orderkey * 17) % 1000 / 1000.0) AS fraud
    FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY 1)
         ON l_orderkey = o_orderkey"""
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || if(microsecond({0}) % 1000000 = 0, '', strftime({0}, '.%f')) || 'Z'"
VIEWS["l_pairs"] = """
    SELECT *, row_number() OVER (PARTITION BY "SellerPointer"
                                 ORDER BY "ListingAge", "ProdCat", "Subcategory") AS line
    FROM s_products QUALIFY line <= 2"""
VIEWS["l_items"] = """
    SELECT code AS "EventLink", "ProdCat", "Subcategory", "ListingAge", "SellerPointer",
           (amount * if(line = 1, 0.45::double, 0.55::double))::real AS "PriceAmt", 1::bigint AS "QtySold"
    FROM e_purchases JOIN l_pairs ON "SellerPointer" = vendor"""
for _name in ("transactions", "items", "payments", "risk"):
    ORACLE[f"purchase_{_name}"] = f"SELECT * FROM l_{_name}"
ORACLE["session_features"] = "SELECT * FROM l_sessions"
ORACLE["risk_bucket"] = "SELECT * FROM l_predictions"
ORACLE["vendor_first_products"] = """
SELECT "ProdCat", "Subcategory", "ListingAge", "SellerPointer", line::int AS line FROM l_pairs"""
ORACLE["purchase_fanout"] = """
SELECT 'transactions' AS "table", 'I' AS action, code AS row_key FROM e_purchases
UNION ALL SELECT 'transaction_products', 'I', code || '#' || n FROM e_purchases, (VALUES (1), (2)) AS l(n)
UNION ALL SELECT 'PaymentProcessingEvents', 'I', pay FROM e_purchases
UNION ALL SELECT 'risk_analytics', 'I', code FROM e_purchases
UNION ALL SELECT 'buyers', 'U', buyer FROM e_purchases
UNION ALL SELECT 'vendors', 'U', vendor FROM e_purchases"""
ORACLE["insert_if_absent"] = """
SELECT * FROM h_vendors
UNION ALL SELECT n.* FROM s_vendors_next n
WHERE NOT EXISTS (SELECT 1 FROM h_vendors h WHERE h."SellerKey" = n."SellerKey")"""
VIEWS["s_vendors_next"] = VIEWS["s_vendors"].replace("s_suppkey + 1 AS i", "s_suppkey + 6 AS i")
ORACLE["buyer_counter_update"] = f"""
SELECT "AcqCode", "ProfileAge", "PurchaseCount" + coalesce(n, 0) AS "PurchaseCount", "AuthLevel",
       json_extract_string(buyer_risk_profile, '$.fingerprint') AS fingerprint,
       json_extract_string(buyer_risk_profile, '$.score')::double AS score,
       last_purchase_at
FROM h_buyers LEFT JOIN (
    SELECT buyer, count(*) AS n, {_ISO.format("max(moment)")} AS last_purchase_at FROM e_purchases GROUP BY 1
) ON buyer = "AcqCode" """
ORACLE["vendor_counter_update"] = """
SELECT "SellerKey", if(n IS NULL, "TotalTxns", (if("TotalTxns" = '', '0', "TotalTxns")::bigint + n)::varchar)
           AS "TotalTxns",
       "CompletedTxns" + coalesce(n, 0) AS "CompletedTxns", coalesce(moment, "LastActiveDt") AS "LastActiveDt"
FROM f_vendors LEFT JOIN (SELECT vendor, count(*) AS n, max(moment) AS moment FROM e_purchases GROUP BY 1)
     ON vendor = "SellerKey" """
ORACLE["payment_settle"] = """
SELECT "PPE_id", transaction_ref, coalesce(moment, event_timestamp) AS event_timestamp,
       if(n IS NULL, processing_stage, 'settled') AS processing_stage,
       (retry_count + coalesce(n, 0))::int AS retry_count,
       (processing_time_ms + coalesce(late, 0))::int AS processing_time_ms
FROM f_payments LEFT JOIN (
    SELECT printf('PPE-HIST-%014d', user_id * 1000 + 1) AS id, count(*) AS n, max(ts) AS moment,
           sum(event_id % 116 + 5) AS late
    FROM events GROUP BY 1) ON id = "PPE_id" """
ORACLE["transaction_status_patch"] = f"""
SELECT "EventCode", json_extract_string(transaction_financials, '$.amount') AS amount,
       json_extract_string(transaction_financials, '$.currency') AS currency,
       if(moment IS NULL, json_extract_string(transaction_financials, '$.status'), 'completed') AS status,
       moment AS updated_at
FROM f_transactions LEFT JOIN (
    SELECT printf('EVT-HIST-%014d', user_id) AS id, {_ISO.format("max(ts)")} AS moment FROM events GROUP BY 1
) ON id = "EventCode" """
ORACLE["json_merge"] = """
SELECT "EventCode", json_extract_string(m, '$.amount') AS amount, json_extract_string(m, '$.currency') AS currency,
       json_extract_string(m, '$.status') AS status, json_extract_string(m, '$.trace') AS trace
FROM (SELECT "EventCode", json_merge_patch(transaction_financials::json,
             json_object('status', 'reviewed', 'trace', md5("EventCode"))) AS m FROM f_transactions)"""
ORACLE["recent_payments"] = """
SELECT "EventCode", "PPE_id", "EventTimestamp" FROM f_transactions JOIN f_payments ON transaction_ref = "EventCode"
ORDER BY "EventTimestamp" DESC, "EventCode", "PPE_id" LIMIT 1000"""

# change feed --------------------------------------------------------------------------------

VIEWS["c_events"] = """
    SELECT 1 AS schema_version, sha256('market|' || lsn || '|' || xid || '|' || raw) AS event_id,
           ingested_at, 'postgresql-wal2json' AS connector, 'postgres-source' AS service,
           'market' AS database, lsn, xid, raw AS change, coalesce(tab, '_metadata') AS "table",
           f_changes.event_id + 256 AS position, act, user_id, amount
    FROM f_changes"""
ORACLE["cdc_envelope"] = """
SELECT schema_version, event_id, ingested_at, connector, service, database, lsn, xid, change, "table"
FROM c_events"""
ORACLE["cdc_route"] = """SELECT "table", count(*) AS changes FROM c_events GROUP BY 1"""
ORACLE["cdc_batch_stats"] = """
SELECT "table", '0/' || hex(min(position)) AS first_lsn, '0/' || hex(max(position)) AS last_lsn,
       count(*) AS event_count FROM c_events GROUP BY 1"""
ORACLE["landed_tags"] = ORACLE["cdc_batch_stats"]
ORACLE["landing_quarantine"] = """
SELECT if(xid::bigint % 7 = 0 OR xid::bigint % 11 = 0, 'broken', 'envelopes') AS kind, "table", count(*) AS lines
FROM c_events GROUP BY ALL"""
ORACLE["cdc_dedup"] = """
SELECT event_id, "table", min(ingested_at) AS ingested_at, any_value(lsn) AS lsn, any_value(change) AS change
FROM c_events GROUP BY 1, 2"""
ORACLE["cdc_flatten"] = """
SELECT event_id, "table", act AS action, position,
       CASE WHEN act <> 'D' THEN user_id END AS new_id, CASE WHEN act <> 'D' THEN amount END AS new_amount,
       CASE WHEN act = 'D' THEN user_id END AS old_id, CASE WHEN act = 'D' THEN amount END AS old_amount
FROM c_events"""
ORACLE["cdc_current_state"] = """
SELECT "table", user_id AS id, amount
FROM (SELECT *, row_number() OVER (PARTITION BY "table", user_id ORDER BY position DESC) AS n FROM c_events)
WHERE n = 1 AND act <> 'D' """

# A feed with truncates, deletes, key changes (two images) and left-out columns (read from the old image).
VIEWS["c_eventful"] = """
    SELECT *, '0/' || hex(event_id + 256) AS lsn, value::decimal(18, 2) AS amount,
           CASE event_type WHEN 'purchase' THEN 'transactions' WHEN 'view' THEN 'BuyerSessionAnalytics'
                WHEN 'click' THEN 'PaymentProcessingEvents' WHEN 'signup' THEN 'buyers' ELSE 'vendors' END AS tab,
           CASE WHEN event_id % 1000 = 500 THEN 'T' WHEN event_id % 17 = 0 THEN 'D' WHEN event_id % 10 = 0 THEN 'U' ELSE 'I' END AS act
    FROM events"""
VIEWS["c_images"] = """
    SELECT tab, event_id, user_id AS id, amount, act = 'I' AS alive FROM c_eventful WHERE act IN ('I', 'D') OR act = 'U' AND event_id % 20 = 0
    UNION ALL SELECT tab, event_id, user_id + 100000, amount, true FROM c_eventful WHERE act = 'U' AND event_id % 20 = 0
    UNION ALL SELECT tab, event_id, user_id, (amount + 1)::decimal(18, 2), true FROM c_eventful WHERE act = 'U' AND event_id % 20 = 10"""
ORACLE["cdc_replay_state"] = """
SELECT tab AS "table", id, amount FROM (
    SELECT *, row_number() OVER (PARTITION BY tab, id ORDER BY event_id DESC) AS n FROM c_images)
LEFT JOIN (SELECT tab, max(event_id) AS cut FROM c_eventful WHERE act = 'T' GROUP BY tab) USING (tab)
WHERE n = 1 AND alive AND event_id > coalesce(cut, -1)"""
ORACLE["cdc_exact_dedup"] = """
SELECT tab AS "table", lsn, (event_id // 5)::varchar AS xid, date_trunc('month', ts)::timestamp AS ingested_at FROM c_eventful"""
for _stored, _once in (("stored_payment_settle", "payment_settle"), ("stored_vendor_counters", "vendor_counter_update"),
                       ("stored_transaction_status", "transaction_status_patch")):
    ORACLE[_stored] = ORACLE[_once]

# silver -------------------------------------------------------------------------------------

for _name, _history in (("transactions", "h"), ("items", "h"), ("sessions", "h"), ("payments", "h"),
                        ("risk", "h"), ("predictions", "h")):
    ORACLE[f"silver_{_name}"] = f"SELECT * FROM h_{_name} UNION ALL SELECT * FROM l_{_name}"
for _name in ("markets", "vendors", "buyers", "products"):
    ORACLE[f"silver_{_name}"] = f"SELECT * FROM c_{_name}"
# Canonical JSON: the seed documents with their keys in order.
for _name, _column, _text in (
    ("markets", "platform_compliance", """'{"review_cycle_days":90,"status":"compliant"}'"""),
    ("vendors", "vendor_compliance_ratings",
     """'{"reviewed":true,"score":' || json_extract_string(vendor_compliance_ratings, '$.score') || '}'"""),
    ("buyers", "buyer_risk_profile", "buyer_risk_profile"),
    ("products", "product_availability",
     """'{"available":true,"stock":' || json_extract_string(product_availability, '$.stock') || '}'"""),
):
    VIEWS[f"c_{_name}"] = f"SELECT * REPLACE ({_text} AS {_column}) FROM s_{_name}"
ORACLE["silver_json_as_text"] = "SELECT * FROM h_risk"
ORACLE["silver_gate"] = """
SELECT "table", expected_rows, expected_rows AS actual_rows, true AS passed FROM (
    SELECT 'markets' AS "table", count(*) AS expected_rows FROM s_markets
    UNION ALL SELECT 'vendors', count(*) FROM s_vendors
    UNION ALL SELECT 'buyers', count(*) FROM s_buyers
    UNION ALL SELECT 'products', count(*) FROM s_products
    UNION ALL SELECT 'transactions', (SELECT count(*) FROM h_transactions) + count(*) FROM l_transactions
    UNION ALL SELECT 'transaction_products', (SELECT count(*) FROM h_items) + count(*) FROM l_items
    UNION ALL SELECT 'BuyerSessionAnalytics', (SELECT count(*) FROM h_sessions) + count(*) FROM l_sessions
    UNION ALL SELECT 'PaymentProcessingEvents', (SELECT count(*) FROM h_payments) + count(*) FROM l_payments
    UNION ALL SELECT 'risk_analytics', (SELECT count(*) FROM h_risk) + count(*) FROM l_risk
    UNION ALL SELECT 'RiskModelPredictions', (SELECT count(*) FROM h_predictions) + count(*) FROM l_predictions)"""

# sources and sinks --------------------------------------------------------------------------


def _counts(tables: dict[str, str], columns: str = "count(*) AS rows") -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "table", {columns} FROM {source}""" for name, source in tables.items()
    )


_TABLE_VIEWS = {
    "markets": "markets", "vendors": "vendors", "buyers": "buyers", "products": "products",
    "transactions": "transactions", "transaction_products": "items", "BuyerSessionAnalytics": "sessions",
    "PaymentProcessingEvents": "payments", "risk_analytics": "risk", "RiskModelPredictions": "predictions",
}
_FACTS = list(_TABLE_VIEWS)[4:]
for _view in list(_TABLE_VIEWS.values())[4:]:
    VIEWS[f"b_{_view}"] = f"SELECT * FROM h_{_view} UNION ALL SELECT * FROM l_{_view}"

ORACLE["row_counts"] = _counts({t: t for t in
    ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")})
ORACLE["file_footers"] = "\nUNION ALL ".join(
    f"""SELECT '{t}' AS "table", (SELECT string_agg(column_name, ',') FROM (DESCRIBE SELECT * FROM h_{v})) AS columns,
       1::bigint AS layouts, count(*) AS rows FROM h_{v}""" for t, v in _TABLE_VIEWS.items())
ORACLE["parquet_roundtrip"] = "SELECT * FROM f_transactions"
ORACLE["snapshot_scan"] = "SELECT * FROM l_payments"
ORACLE["scan_bronze"] = "SELECT * FROM h_items"
ORACLE["manifest_rows"] = _counts({t: f"h_{v}" for t, v in _TABLE_VIEWS.items()})
VIEWS["o_scored"] = """
    SELECT t.*, (transaction_financials::json ->> 'amount')::double AS amount FROM b_transactions t"""
ORACLE["published_gold"] = """
SELECT "EventTimestamp"::date AS metric_date, "PlatformKey" AS platform_key, count(*) AS transaction_count,
       count(DISTINCT "AcqLink") AS unique_buyers, count(DISTINCT "VendorLink") AS unique_vendors,
       round(sum(amount), 2) AS gross_merchandise_value,
       sum("CrossBorder")::bigint AS cross_border_transactions,
       count(CASE WHEN "ML_Risk" = 'high' THEN 1 END) AS high_risk_transactions,
       0::bigint AS payment_failed_events
FROM o_scored LEFT JOIN b_risk ON "TxnLink" = "EventCode" GROUP BY 1, 2"""
ORACLE["batch_lineage"] = f"""
SELECT *, 'zstd' AS codec FROM (
{_counts({t: f"s_{v}" for t, v in _TABLE_VIEWS.items() if t not in _FACTS},
         "count(*) AS rows, 'silver' AS layer, 'snapshot' AS source")}
UNION ALL {_counts({t: f"b_{_TABLE_VIEWS[t]}" for t in _FACTS},
                   "count(*) AS rows, 'silver' AS layer, 'bronze-history+snapshot' AS source")}
UNION ALL {_counts({"daily_market_metrics":
                    '(SELECT DISTINCT "EventTimestamp"::date, "PlatformKey" FROM b_transactions)',
                    "vendor_risk_summary": "s_vendors", "buyer_360": "s_buyers",
                    "product_performance": "s_products"},
                   "count(*) AS rows, 'gold' AS layer, 'silver-batch' AS source")})"""
ORACLE["publish_swap"] = """
SELECT * EXCLUDE (vendor, n, moment)
         REPLACE (if(n IS NULL, "TotalTxns", ("TotalTxns"::bigint + n)::varchar) AS "TotalTxns",
                  "CompletedTxns" + coalesce(n, 0) AS "CompletedTxns",
                  coalesce(moment, "LastActiveDt") AS "LastActiveDt")
FROM h_vendors LEFT JOIN (SELECT vendor, count(*) AS n, max(moment) AS moment FROM e_purchases GROUP BY 1)
     ON vendor = "SellerKey" """
ORACLE["synth_resume"] = """
SELECT 'transactions' AS "table", count(*) AS rows, count(*) * 40 AS bytes, max(o_orderkey) + 2 AS next_row
FROM orders
UNION ALL SELECT 'BuyerSessionAnalytics', count(*), count(*) * 40, max(event_id) + 2 FROM events"""
_KEYS = {"markets": "PlatCode", "vendors": "SellerKey", "buyers": "AcqCode", "products": "ProdCat",
         "transactions": "EventCode", "items": "EventLink", "sessions": "BSA_id", "payments": "PPE_id",
         "risk": "TxnLink", "predictions": "RMP_id"}


def _width(view: str) -> str:
    return f'(SELECT sum(length("{_KEYS[view]}")) * 10.0::double / count(*) FROM h_{view})'


_SHARES = {"markets": (0.005, 10), "vendors": (0.02, 1000), "buyers": (0.02, 10000), "products": (0.08, 4000),
           "transactions": (0.25, None), "transaction_products": (0.25, None),
           "BuyerSessionAnalytics": (0.12, None), "PaymentProcessingEvents": (0.12, None),
           "risk_analytics": (0.055, None)}
ORACLE["synth_plan"] = (
    "WITH planned AS (\n"
    + "\nUNION ALL ".join(
        f"""SELECT '{t}' AS "table", {_width(_TABLE_VIEWS[t])} AS w,
       floor((SELECT count(*) FROM lineitem) * 1024 * {share}::double)::bigint AS target_bytes,
       {f"{fixed}::bigint" if fixed else "NULL::bigint"} AS fixed"""
        for t, (share, fixed) in _SHARES.items()
    )
    + """), sized AS (
    SELECT "table", w, target_bytes, coalesce(fixed,
        CASE WHEN "table" = 'transaction_products'
             THEN 2 * (SELECT ceil(target_bytes / w)::bigint FROM planned WHERE "table" = 'transactions')
             ELSE ceil(target_bytes / w)::bigint END) AS target_rows
    FROM planned), rest AS (
    SELECT (SELECT count(*) FROM lineitem) * 1024 - ceil(sum(target_rows * w))::bigint AS target_bytes FROM sized)
SELECT "table", target_bytes, target_rows FROM sized
UNION ALL SELECT 'RiskModelPredictions', target_bytes,
                 greatest(0, ceil(target_bytes / """
    + _width("predictions")
    + """)::bigint) FROM rest"""
)

# landing ------------------------------------------------------------------------------------

_LANDED = """
SELECT schema_version, event_id, ingested_at, lsn, xid, change, "table" FROM c_events"""
ORACLE["cdc_drain"] = _LANDED
ORACLE["scan_landing"] = _LANDED
ORACLE["land_changes"] = """
SELECT "table", strftime(ingested_at, '%Y-%m-%d') AS ingest_date, strftime(ingested_at, '%H') AS hour,
       count(*) AS changes FROM c_events GROUP BY 1, 2, 3"""
ORACLE["cdc_retry"] = """SELECT "table", count(*) AS changes FROM c_events GROUP BY 1"""
ORACLE["cdc_stream_dedup"] = """SELECT DISTINCT event_id, "table", ingested_at FROM c_events"""

# validation ---------------------------------------------------------------------------------


def _rules(**counts: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{rule}' AS rule, ({sql})::bigint AS violations" for rule, sql in counts.items()
    )


def _universe(table: str, columns: str, keys: str, size: int) -> dict[str, str]:
    real = f"SELECT {columns} FROM h_{table}"
    ideal = f"SELECT {keys} FROM range(1, {size + 1}) AS n(i)"
    return {
        f"{table} missing": f"SELECT count(*) FROM ({ideal} EXCEPT {real})",
        f"{table} unexpected": f"SELECT count(*) FROM ({real} EXCEPT {ideal})",
    }


_PRODUCT = '"ProdCat", "Subcategory", "ListingAge", "SellerPointer"'
ORACLE["check_universe"] = _rules(
    **_universe("markets", '"PlatCode"', "printf('PLAT-%03d', i)", 10),
    **_universe("vendors", '"SellerKey"', "printf('SELLER-%06d', i)", 1000),
    **_universe("buyers", '"AcqCode"', "printf('BUYER-%07d', i)", 10000),
    **_universe(
        "products", _PRODUCT,
        "printf('CAT-%03d', i % 20), printf('SUB-%05d', i % 100), i % 4, printf('SELLER-%06d', (i + 3) // 4)",
        4000,
    ),
)


def _misformed(source: str, column: str, pattern: str) -> str:
    return f"""SELECT count(*) FROM {source} WHERE NOT regexp_full_match("{column}", '{pattern}')"""


ORACLE["check_id_format"] = _rules(
    **{
        "markets id format": _misformed("s_markets", "PlatCode", "PLAT-[0-9]{3}"),
        "vendors id format": _misformed("s_vendors", "SellerKey", "SELLER-[0-9]{6}"),
        "buyers id format": _misformed("s_buyers", "AcqCode", "BUYER-[0-9]{7}"),
        "transactions id format": _misformed("b_transactions", "EventCode", "EVT-HIST-[0-9]{14}"),
        "transactions id domain": """SELECT count(*) FROM h_transactions
            WHERE "EventCode"[10:]::bigint NOT BETWEEN 1 AND (SELECT count(*) FROM customer)""",
        "BuyerSessionAnalytics id format": _misformed("b_sessions", "BSA_id", "BSA-HIST-[0-9]{14}"),
        "PaymentProcessingEvents id format": _misformed("b_payments", "PPE_id", "PPE-HIST-[0-9]{14}"),
        "RiskModelPredictions id format": _misformed("b_predictions", "RMP_id", "RMP-HIST-[0-9]{14}"),
    }
)
_PRIMARY = {
    "markets": '"PlatCode"', "vendors": '"SellerKey"', "buyers": '"AcqCode"', "products": _PRODUCT,
    "transactions": '"EventCode"', "transaction_products": f'"EventLink", {_PRODUCT}',
    "BuyerSessionAnalytics": '"BSA_id"', "PaymentProcessingEvents": '"PPE_id"',
    "risk_analytics": '"TxnLink"', "RiskModelPredictions": '"RMP_id"',
}
ORACLE["check_primary_keys"] = _rules(
    **{
        f"{t} primary key": f"SELECT count(*) FROM (SELECT {key} FROM f_{_TABLE_VIEWS[t]} GROUP BY ALL HAVING count(*) > 1)"
        for t, key in _PRIMARY.items()
    }
)
ORACLE["check_item_vendor"] = _rules(**{"item vendor": """SELECT count(*) FROM f_items, f_transactions
    WHERE "EventLink" = "EventCode" AND "SellerPointer" <> "VendorLink" """})
ORACLE["check_two_items"] = _rules(**{"two items": """SELECT count(*) FROM (
    SELECT "EventCode" FROM f_transactions LEFT JOIN f_items ON "EventLink" = "EventCode"
    GROUP BY 1 HAVING count("EventLink") <> 2)"""})
ORACLE["check_payment_order"] = _rules(**{"payment predates transaction": """
    SELECT count(*) FROM f_payments, f_transactions
    WHERE transaction_ref = "EventCode" AND event_timestamp < "EventTimestamp" """})
ORACLE["check_prediction_order"] = _rules(**{"prediction predates transaction": """
    SELECT count(*) FROM f_predictions, f_transactions
    WHERE txn_link_ref = "EventCode" AND prediction_timestamp < "EventTimestamp" """})


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return f"""SELECT count(*) FROM {child} c WHERE NOT EXISTS (
        SELECT 1 FROM {parent} p WHERE ({key.format(a="p")}) = ({column.format(a="c")}))"""


_PRODUCT_OF = '{a}."ProdCat", {a}."Subcategory", {a}."ListingAge", {a}."SellerPointer"'
ORACLE["check_references"] = _rules(
    **{
        "transactions.PlatformKey -> markets":
            _orphans("f_transactions", '{a}."PlatformKey"', "f_markets", '{a}."PlatCode"'),
        "transactions.VendorLink -> vendors":
            _orphans("f_transactions", '{a}."VendorLink"', "f_vendors", '{a}."SellerKey"'),
        "transactions.AcqLink -> buyers":
            _orphans("f_transactions", '{a}."AcqLink"', "f_buyers", '{a}."AcqCode"'),
        "transaction_products.EventLink -> transactions":
            _orphans("f_items", '{a}."EventLink"', "f_transactions", '{a}."EventCode"'),
        "transaction_products.SellerPointer -> products":
            _orphans("f_items", _PRODUCT_OF, "f_products", _PRODUCT_OF),
        "BuyerSessionAnalytics.acq_ref -> buyers":
            _orphans("f_sessions", "{a}.acq_ref", "f_buyers", '{a}."AcqCode"'),
        "PaymentProcessingEvents.transaction_ref -> transactions":
            _orphans("f_payments", "{a}.transaction_ref", "f_transactions", '{a}."EventCode"'),
        "risk_analytics.TxnLink -> transactions":
            _orphans("f_risk", '{a}."TxnLink"', "f_transactions", '{a}."EventCode"'),
        "RiskModelPredictions.txn_link_ref -> risk_analytics":
            _orphans("f_predictions", "{a}.txn_link_ref", "f_risk", '{a}."TxnLink"'),
    }
)
_CROSSES = '"OriginRegion" IS DISTINCT FROM "DestRegion"'
ORACLE["check_relations"] = "\nUNION ALL ".join(
    ORACLE[f"check_{name}"] for name in ("item_vendor", "two_items", "payment_order", "prediction_order", "references")
)
ORACLE["check_border"] = _rules(
    **{
        "border flag": f"""SELECT count(*) FROM f_transactions
            WHERE "CrossBorder" IS DISTINCT FROM ({_CROSSES})::bigint""",
        "border route": f"""SELECT count(*) FROM f_transactions
            WHERE "RouteComplex" IS DISTINCT FROM if({_CROSSES}, 'multi-hop', 'direct')""",
        "border label": f"""SELECT count(*) FROM f_transactions
            WHERE "Border_cross_border_pre" IS DISTINCT FROM if({_CROSSES}, 'cross-border', 'domestic')""",
    }
)
# Live items have no history number, so each of them breaks every rule; history items break none.
ORACLE["check_item_price"] = """
SELECT rule, (SELECT count(*) FROM l_items) AS violations
FROM (VALUES ('item id'), ('item product'), ('item vendor number'), ('item price')) AS r(rule)"""
ORACLE["check_cardinality"] = _rules(
    **{
        f"{t} cardinality": f"SELECT (count(*) <> {n})::int FROM h_{t}"
        for t, n in (("markets", 10), ("vendors", 1000), ("buyers", 10000), ("products", 4000))
    },
    **{
        "items per transaction": "SELECT (count(*) <> 2 * (SELECT count(*) FROM h_transactions))::int FROM h_items",
        "transaction domain": "SELECT (count(*) < 1000000)::int FROM h_transactions",
        "risk domain": "SELECT (count(*) < 1000000)::int FROM h_risk",
        "risk within transactions": "SELECT (count(*) > (SELECT count(*) FROM h_transactions))::int FROM h_risk",
    },
)
ORACLE["check_deltas"] = "\nUNION ALL ".join(
    f"""SELECT '{t}' AS "table", count(*) AS new_rows, {"count(*)" if live else "NULL::bigint"} AS new_live_ids
        FROM l_{_TABLE_VIEWS[t]}"""
    for t, live in zip(_FACTS, (True, False, True, True, False, True), strict=True)
)
ORACLE["check_event_mix"] = """
SELECT event, count(*) AS events, count(*) * if(event = 'purchase', 7, 1) AS row_changes
FROM (SELECT CASE event_type WHEN 'view' THEN 'buyer_session' WHEN 'click' THEN 'payment_update'
                  WHEN 'signup' THEN 'risk_prediction' WHEN 'error' THEN 'transaction_status_update'
                  ELSE event_type END AS event FROM events)
GROUP BY 1"""
ORACLE["check_deliveries"] = """
SELECT count(*) AS changes, count(DISTINCT event_id) AS event_ids,
       count(CASE WHEN "table" = '_metadata' THEN 1 END) AS unknown_table FROM c_events"""
ORACLE["check_envelope"] = _rules(
    **{
        "envelope keys": "0",
        "event id": "0",
        "change table": """SELECT count(*) FROM c_events WHERE "table" = '_metadata'""",
        "source position": "0",
    }
)
ORACLE["gold_reconcile"] = _rules(
    **{
        "vendor cardinality": "0",
        "buyer cardinality": "0",
        "product cardinality": "0",
        "daily_market_metrics transactions": "0",
        "vendor_risk_summary transactions":
            """SELECT count(*) FROM f_transactions
               WHERE "VendorLink" IS NULL OR "VendorLink" NOT IN (SELECT "SellerKey" FROM f_vendors)""",
        "buyer_360 transactions":
            """SELECT count(*) FROM f_transactions
               WHERE "AcqLink" IS NULL OR "AcqLink" NOT IN (SELECT "AcqCode" FROM f_buyers)""",
        "product units": """SELECT abs(sum("QtySold") - count(*)) FROM f_items""",
    }
)


# Rules on stored files, layers and records of a sound batch: every rule is there, with no violation.
# Damaged cases are in tests/test_lake.py and tests/test_streaming.py.
_SCHEMA_RULES = ["table set", *(f"{t} {part}" for t in _TABLE_VIEWS for part in ("columns", "types"))]
_MODELS = ("daily_market_metrics", "vendor_risk_summary", "buyer_360", "product_performance")
ORACLE["check_schema"] = _rules(**dict.fromkeys(_SCHEMA_RULES, "0"))
ORACLE["check_manifest"] = _rules(**dict.fromkeys(("bronze size", "manifest bytes", "bronze tables", "manifest tables"), "0"))
ORACLE["check_silver"] = _rules(**dict.fromkeys([*_SCHEMA_RULES, "silver counts", "silver manifest"], "0"))
ORACLE["check_gold"] = _rules(
    **dict.fromkeys(["gold models", "staged batches", "one batch", *(f"{m} {part}" for m in _MODELS for part in ("columns", "empty"))], "0")
)
# The given documents are written with blanks and their keys from last to first; canonical they are as before.
ORACLE["json_canonical"] = 'SELECT "EventCode", transaction_financials FROM h_transactions'


def oracle_sql() -> dict[str, str]:
    return {name: with_views(body) for name, body in ORACLE.items()}
