"""SQL of the generated tables: history `h_*`, seeds `s_*` and operational rows `l_*`.

`VALUES` holds the numbers and labels of every column that depends on nothing but a row's number;
`view` forms their SQL and adds it to the columns that are written out (keys, moments, documents).
"""

from __future__ import annotations

from typing import NamedTuple

from souklake.schemas import SCHEMAS


class Cycle(NamedTuple):
    """offset + number % modulus"""

    offset: int
    modulus: int
    type: str = "bigint"

    def sql(self, number: str) -> str:
        return f"({self.offset} + {number} % {self.modulus})::{self.type}"


class Line(NamedTuple):
    """offset + number * step"""

    offset: int
    step: int
    type: str = "bigint"

    def sql(self, number: str) -> str:
        return f"({self.offset} + {number} * {self.step})::{self.type}"


class Share(NamedTuple):
    """offset + ((number * factor) % modulus) / divisor"""

    offset: float
    factor: int
    modulus: int
    divisor: int
    type: str = "real"

    def sql(self, number: str) -> str:
        return f"({self.offset}::double + ({number} * {self.factor}) % {self.modulus} / {self.divisor}.0)::{self.type}"


class Every(NamedTuple):
    """`hit` where the number is divisible by step, else `miss`"""

    step: int
    hit: str
    miss: str | None

    def sql(self, number: str) -> str:
        return f"CASE WHEN {number} % {self.step} = 0 THEN '{self.hit}'" + (f" ELSE '{self.miss}' END" if self.miss else " END")


class Divides(NamedTuple):
    """Whether step divides the number"""

    step: int
    expected: bool = True

    def sql(self, number: str) -> str:
        return f"(({number} % {self.step} = 0) = {self.expected})"


class Pick(NamedTuple):
    """One label after another"""

    labels: tuple[str, ...]

    def sql(self, number: str) -> str:
        return f"{list(self.labels)}[1 + {number} % {len(self.labels)}]"


class Same(NamedTuple):
    """One value for all rows"""

    value: str | int | float | bool
    type: str = "varchar"

    def sql(self, number: str) -> str:
        return f"'{self.value}'::{self.type}"


# Fixed values ---------------------------------------------------------------------------------
HISTORY_START = "2024-01-01"
YEAR_SECONDS = 31_536_000
SEEDED_AT = "2025-06-01"
AMOUNT = Share(5, 1, 250_000, 100, "double")
LINE_SHARES = (0.45, 0.55)
FEE_RATE = 0.021
MARKETS, VENDORS, BUYERS, REFERENCE_ROWS, PRODUCTS_PER_VENDOR = 10, 1000, 10_000, 1000, 4
RISK_MEDIUM, RISK_HIGH = 0.3, 0.7
MOST_FRAUD = 0.99
REGIONS = Pick(("NA", "EU", "APAC", "LATAM"))
REFERRALS = Pick(("direct", "search", "affiliate", "social"))
METHODS = Pick(("card", "wallet", "bank_transfer"))
PROCESSORS = Pick(("nova-pay", "orbit-pay"))
FACTORS = Pick(("velocity", "amount", "device", "behavior"))

VALUES: dict[str, dict[str, NamedTuple]] = {
    "h_markets": {
        "PlatformType": Every(3, "marketplace", "specialized"),
        "AgeDays": Cycle(365, 8000),
        "OperStatus": Same("active"),
        "RepScore": Cycle(60, 40, "varchar"),
        "ConfidenceLevel": Same("high"),
        "SizeCat": Every(3, "large", "medium"),
        "DayTxnVol": Cycle(1000, 50_000, "real"),
        "ActiveUsersMo": Cycle(10_000, 900_000, "varchar"),
        "SellerCount": Cycle(100, 50_000),
        "AcqCount": Cycle(1000, 500_000),
        "ItemListings": Cycle(1000, 1_000_000),
        "RefreshHrs": Same(24, "bigint"),
    },
    "h_vendors": {
        "DaysActive": Cycle(30, 3000),
        "PerformanceRating": Share(3, 1, 20, 10),
        "TotalTxns": Cycle(0, 50_000, "varchar"),
        "CompletedTxns": Cycle(0, 49_000),
        "DisputedEvents": Cycle(0, 25),
        "VerTier": Every(10, "enhanced", "standard"),
        "AccessLevel": Same("active"),
        "InvestigationFlag": Every(97, "review", "none"),
        "LE_Interest": Every(53, "medium", "low"),
        "ComplianceRisk": Same("low"),
        "RegStandeff": Same("verified"),
    },
    "h_buyers": {
        "ProfileAge": Cycle(0, 2500),
        "PurchaseCount": Cycle(0, 500),
        "AuthLevel": Every(3, "mfa", "standard"),
    },
    "h_products": {},
    "h_transactions": {
        "RecordTag": Same("purchase"),
        "Transaction_Velocity": Every(5, "burst", "normal"),
        "GeoDistScore": Share(0, 37, 10_000, 100, "varchar"),
    },
    "h_items": {"QtySold": Same(1, "bigint")},
    "h_sessions": {
        "session_duration_seconds": Cycle(10, 1800, "int"),
        "pages_viewed_count": Cycle(1, 30, "int"),
        "products_viewed_count": Cycle(0, 15, "int"),
        "cart_additions_count": Cycle(0, 5, "int"),
        "cart_removals_count": Cycle(0, 3, "int"),
        "search_queries_count": Cycle(0, 8, "int"),
        "checkout_initiated": Divides(3),
        "checkout_completed": Divides(5),
        "bounce_indicator": Divides(7),
        "referral_source": REFERRALS,
        "device_category": Pick(("desktop", "mobile", "tablet")),
        "geo_region": REGIONS,
        "avg_time_per_page_seconds": Cycle(5, 120, "real"),
        "click_through_rate": Share(0, 1, 1000, 1000),
        "scroll_depth_pct": Cycle(0, 101, "real"),
        "error_encounters_count": Cycle(0, 3, "int"),
        "session_value_estimate": Share(0, 13, 100_000, 100),
    },
    "h_payments": {
        "payment_method_type": METHODS,
        "processing_stage": Same("settled"),
        "currency_code": Same("USD"),
        "processor_name": PROCESSORS,
        "processing_fee_pct": Same(2.1, "real"),
        "fraud_check_passed": Divides(100, False),
        "fraud_score": Share(0, 17, 1000, 1000),
        "avs_response_code": Same("Y"),
        "cvv_verification_passed": Divides(50, False),
        "three_ds_authenticated": Divides(4, False),
        "decline_reason": Every(100, "risk_decline", None),
        "retry_count": Cycle(0, 3, "int"),
        "processing_time_ms": Cycle(25, 900, "int"),
    },
    "h_risk": {
        "RiskIndicatorCount": Cycle(0, 6),
        "FraudProb": Share(0, 17, 1000, 1000),
        "LinkedEvents": Cycle(0, 9),
        "ChainLength": Cycle(1, 5),
    },
    "h_predictions": {
        "model_name": Same("cyber-risk-lite"),
        "model_version": Same("1.0.0"),
        "fraud_probability": Share(0, 17, 1000, 1000),
        "confidence_score": Share(0.6, 1, 400, 1000),
        "top_risk_factor": FACTORS,
        "risk_factors_count": Cycle(1, 8, "int"),
        "feature_importance_velocity": Share(0, 3, 1000, 1000),
        "feature_importance_amount": Share(0, 5, 1000, 1000),
        "feature_importance_device": Share(0, 7, 1000, 1000),
        "feature_importance_behavior": Share(0, 11, 1000, 1000),
        "actual_outcome": Every(3, "fraud", "legitimate"),
        "prediction_latency_ms": Cycle(2, 95, "int"),
        "ensemble_agreement_rate": Share(0.6, 1, 400, 1000),
        "model_drift_indicator": Share(0, 1, 200, 1000),
    },
    "s_markets": {
        "PlatformType": Every(3, "marketplace", "specialized"),
        "AgeDays": Line(365, 30),
        "OperStatus": Same("active"),
        "RepScore": Cycle(70, 30, "varchar"),
        "ConfidenceLevel": Every(4, "medium", "high"),
        "DayTxnVol": Line(1000, 125, "real"),
        "ActiveUsersMo": Line(10_000, 900, "varchar"),
        "SellerCount": Same(VENDORS, "bigint"),
        "AcqCount": Same(BUYERS, "bigint"),
        "ItemListings": Same(VENDORS * PRODUCTS_PER_VENDOR, "bigint"),
        "lastUpdated": Same(SEEDED_AT, "timestamp"),
        "RefreshHrs": Same(24, "bigint"),
        "platform_compliance": Same('{"status":"compliant","review_cycle_days":90}'),
    },
    "s_vendors": {
        "DaysActive": Cycle(30, 2000),
        "PerformanceRating": Share(3, 1, 20, 10),
        "TotalTxns": Cycle(0, 5000, "varchar"),
        "CompletedTxns": Cycle(0, 4900),
        "DisputedEvents": Cycle(0, 20),
        "VerTier": Every(10, "enhanced", "standard"),
        "AccessLevel": Same("active"),
        "InvestigationFlag": Every(97, "review", "none"),
        "LE_Interest": Every(53, "medium", "low"),
        "ComplianceRisk": Every(41, "medium", "low"),
        "RegStandeff": Same("verified"),
    },
    "s_buyers": {
        "ProfileAge": Cycle(0, 2500),
        "PurchaseCount": Cycle(0, 100),
        "AuthLevel": Every(3, "mfa", "standard"),
    },
    "s_products": {},
    "l_transactions": {
        "RecordTag": Same("purchase"),
        "Transaction_Velocity": Pick(("normal", "elevated", "burst")),
        "GeoDistScore": Share(0, 37, 10_000, 100, "varchar"),
    },
    "l_payments": {
        "processing_stage": Same("authorized"),
        "currency_code": Same("USD"),
        "processor_name": PROCESSORS,
        "processing_fee_pct": Same(2.1, "real"),
        "avs_response_code": Same("Y"),
        "cvv_verification_passed": Same(True, "boolean"),
        "retry_count": Same(0, "int"),
        "processing_time_ms": Cycle(25, 876, "int"),
    },
    "l_risk": {
        "RiskIndicatorCount": Cycle(0, 6),
        "LinkedEvents": Cycle(0, 9),
        "ChainLength": Cycle(1, 5),
    },
    "l_sessions": {
        "session_duration_seconds": Cycle(8, 1793, "int"),
        "search_queries_count": Cycle(0, 9, "int"),
        "referral_source": REFERRALS,
        "device_category": Pick(("mobile", "desktop", "tablet")),
        "geo_region": REGIONS,
        "error_encounters_count": Cycle(0, 3, "int"),
    },
    "l_predictions": {
        "model_name": Same("cyber-risk-lite"),
        "model_version": Same("1.0.0"),
        "confidence_score": Share(0.65, 1, 340, 1000),
        "top_risk_factor": FACTORS,
        "risk_factors_count": Cycle(1, 8, "int"),
        "feature_importance_velocity": Share(0, 3, 1000, 1000),
        "feature_importance_amount": Share(0, 5, 1000, 1000),
        "feature_importance_device": Share(0, 7, 1000, 1000),
        "feature_importance_behavior": Share(0, 11, 1000, 1000),
        "prediction_latency_ms": Cycle(2, 94, "int"),
        "ensemble_agreement_rate": Share(0.6, 1, 400, 1000),
        "model_drift_indicator": Share(0, 2, 1000, 1000),
    },
}
# ----------------------------------------------------------------------------------------------


def moment(number: str) -> str:
    return f"TIMESTAMP '{HISTORY_START}' + to_seconds({number} % {YEAR_SECONDS})"


def bucket(score: str) -> str:
    return f"CASE WHEN {score} < {RISK_MEDIUM} THEN 'low' WHEN {score} < {RISK_HIGH} THEN 'medium' ELSE 'high' END"


def live_key(prefix: str, kind: str, number: str) -> str:
    return (
        f"'{prefix}-LIVE-' || regexp_replace(md5('{kind}:' || {number}), "
        "'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5')"
    )


def markets(i: str) -> str:
    return f"printf('PLAT-%03d', {i})"


def vendors(i: str) -> str:
    return f"printf('SELLER-%06d', {i})"


def buyers(i: str) -> str:
    return f"printf('BUYER-%07d', {i})"


def past_key(prefix: str, i: str) -> str:
    return f"printf('{prefix}-HIST-%014d', {i})"


def product(i: str, vendor: str) -> dict[str, str]:
    return {
        "ProdCat": f"printf('CAT-%03d', {i} % 20)",
        "Subcategory": f"printf('SUB-%05d', {i} % 100)",
        "ListingAge": f"{i} % {PRODUCTS_PER_VENDOR}",
        "SellerPointer": vendors(vendor),
    }


def turn(i: str, count: int) -> str:
    """1 … count, again and again, from row 1 on."""
    return f"(1 + ({i} - 1) % {count})"


def document(**members: str) -> str:
    """JSON text of members whose SQL already gives JSON values."""
    return "'{' || " + " || ',' || ".join(f"'\"{name}\":' || {value}" for name, value in members.items()) + " || '}'"


def quoted(value: str) -> str:
    return f"'\"' || {value} || '\"'"


def border(origin: str, target: str) -> dict[str, str]:
    crosses = f"{origin} <> {target}"
    return {
        "OriginRegion": origin,
        "DestRegion": target,
        "CrossBorder": f"({crosses})::bigint",
        "RouteComplex": f"if({crosses}, 'multi-hop', 'direct')",
        "Border_cross_border_pre": f"if({crosses}, 'cross-border', 'domestic')",
    }


TABLES = {
    "markets": "markets", "vendors": "vendors", "buyers": "buyers", "products": "products", "transactions": "transactions",
    "items": "transaction_products", "sessions": "BuyerSessionAnalytics", "payments": "PaymentProcessingEvents",
    "risk": "risk_analytics", "predictions": "RiskModelPredictions",
}


def view(name: str, source: str, written: dict[str, str], number: str = "i") -> str:
    """Columns in the order of the table, so that views of one table can be united."""
    formed = written | {column: rule.sql(number) for column, rule in VALUES[name].items()}
    columns = {column: formed[column] for column in SCHEMAS[TABLES[name[2:]]].names}
    return "SELECT " + ",\n       ".join(f'{sql} AS "{column}"' for column, sql in columns.items()) + f"\nFROM ({source})"


def _rows(key: str, table: str) -> str:
    return f"SELECT {key} + 1 AS i FROM {table}"


def _line_share(line: str) -> str:
    first, second = LINE_SHARES
    return f"CASE WHEN {line} = 1 THEN {first} ELSE {second} END::double"


def history_views() -> dict[str, str]:
    orders = _rows("o_orderkey", "orders")
    judged = "recommendation_action", "manual_review_triggered"
    review = {judged[0]: "if(bucket = 'high', 'manual_review', 'approve')", judged[1]: "bucket = 'high'"}
    found = {
        "h_markets": ("SELECT n_nationkey::bigint + 1 AS i FROM nation", {
            "PlatCode": markets("i"), "PlatName": "'Market ' || i || ' ' || md5(i::varchar)", "lastUpdated": moment("i"),
            "platform_compliance": document(status="'\"compliant\"'", audit=quoted("md5('market:' || i)"))}),
        "h_vendors": (_rows("s_suppkey", "supplier"), {
            "SellerKey": vendors("i"), "LastActiveDt": moment("i"),
            "vendor_compliance_ratings": document(rating_id=quoted("md5('vendor:' || i)"), reviewed="(i % 2 = 0)")}),
        "h_buyers": (_rows("c_custkey", "customer"), {
            "AcqCode": buyers("i"),
            "buyer_risk_profile": document(fingerprint=quoted("md5('buyer:' || i)"), score="(i % 1000 / 1000.0)")}),
        "h_products": (_rows("p_partkey", "part"), product("i", f"1 + (i - 1) // {PRODUCTS_PER_VENDOR}") | {
            "product_availability": document(stock="i % 500", sku_hash=quoted("md5('product:' || i)"))}),
        "h_transactions": (f"SELECT i, {REGIONS.sql('i')} AS origin, {REGIONS.sql('(i // 3)')} AS target FROM ({orders})", {
            "EventCode": past_key("EVT", "i"), "EventTimestamp": moment("i"), "PlatformKey": markets(turn("i", MARKETS)),
            "VendorLink": vendors(turn("i", VENDORS)), "AcqLink": buyers(turn("i", BUYERS)), **border("origin", "target"),
            "transaction_financials": document(
                amount=AMOUNT.sql("i"), currency="'\"USD\"'", status="'\"settled\"'", trace=quoted("md5('txn:' || i)"))}),
        "h_items": (
            f"SELECT i, line, {turn('i', VENDORS)} AS v, ({turn('i', VENDORS)} - 1) * {PRODUCTS_PER_VENDOR} + line AS p"
            f" FROM ({orders}), (VALUES (1), (2)) AS lines(line)", {
                "EventLink": past_key("EVT", "i"), **product("p", "v"),
                "PriceAmt": f"({AMOUNT.sql('i')} * {_line_share('line')})::real"}),
        "h_sessions": (_rows("event_id", "events"), {
            "BSA_id": past_key("BSA", "i"), "acq_ref": buyers(turn("i", BUYERS)), "session_start_time": moment("i")}),
        "h_payments": (f"SELECT i, {turn('i', REFERENCE_ROWS)} AS t, {AMOUNT.sql('i')} AS due FROM ({orders})", {
            "PPE_id": past_key("PPE", "i"), "transaction_ref": past_key("EVT", "t"),
            "event_timestamp": f"{moment('t')} + to_milliseconds(10 + i % 900)",
            "amount_requested": "due::real", "amount_processed": "due::real",
            "authorization_code": "upper(md5('auth:' || i)[:12])", "processing_fee": f"(due * {FEE_RATE}::double)::real"}),
        "h_risk": (orders, {
            "TxnLink": past_key("EVT", "i"), "ML_Risk": bucket("i % 1000 / 1000.0"),
            "wallet_risk_assessment": document(wallet_hash=quoted("md5('wallet:' || i)"), age_days="i % 2500")}),
        "h_predictions": (
            f"SELECT i, {turn('i', REFERENCE_ROWS)} AS t, {bucket('i % 1000 / 1000.0')} AS bucket FROM ({orders})", {
                "RMP_id": past_key("RMP", "i"), "txn_link_ref": past_key("EVT", "t"),
                "prediction_timestamp": f"{moment('t')} + to_seconds(1 + i % 300)", "risk_category_predicted": "bucket", **review}),
    }
    return {name: view(name, source, written) for name, (source, written) in found.items()}


def seed_views() -> dict[str, str]:
    listings = f"SELECT s_suppkey + 1 AS v, s_suppkey * {PRODUCTS_PER_VENDOR} + n AS i FROM supplier, range(1, {PRODUCTS_PER_VENDOR + 1}) AS l(n)"
    found = {
        "s_markets": ("SELECT n_nationkey::bigint + 1 AS i FROM nation", {
            "PlatCode": markets("i"), "PlatName": "'Market ' || i", "SizeCat": "if(i < 4, 'large', 'medium')"}),
        "s_vendors": (_rows("s_suppkey", "supplier"), {
            "SellerKey": vendors("i"), "LastActiveDt": f"TIMESTAMP '{SEEDED_AT}' - to_days((i % 30)::int)",
            "vendor_compliance_ratings": document(score="(60 + i % 40)", reviewed="true")}),
        "s_buyers": (_rows("c_custkey", "customer"), {
            "AcqCode": buyers("i"), "buyer_risk_profile": document(score="(i % 1000 / 1000.0)", segment="i % 20")}),
        "s_products": (listings, product("i", "v") | {
            "product_availability": document(stock="(50 + i % 450)", available="true")}),
    }
    return {name: view(name, source, written) for name, (source, written) in found.items()}


def live_views() -> dict[str, str]:
    """Rows of the operational events of `e_purchases` (k its order, c its customer), `events` and `orders`."""
    added = "SELECT *, 1 + event_id % 35 AS pages, least(1 + event_id % 35, event_id % 15) AS seen FROM events"
    carts = f"SELECT *, least(seen, user_id % 5) AS added, event_type IN ('purchase', 'view') AS ends FROM ({added})"
    starts = f"SELECT *, added > 0 AND event_type IN ('click', 'purchase', 'view') AS starts FROM ({carts})"
    scored = f"SELECT *, o_orderkey AS k, least({MOST_FRAUD}::double, {Share(0, 13, 1000, 1000, 'double').sql('o_orderkey')}) AS p FROM orders"
    purchases = "SELECT * FROM e_purchases"
    found = {
        "l_transactions": (purchases, "k", {
            "EventCode": "code", "EventTimestamp": "moment", "PlatformKey": markets(f"1 + k % {MARKETS}"),
            "VendorLink": "vendor", "AcqLink": "buyer", **border("a", "b"),
            "transaction_financials": document(
                amount="amount", currency="'\"USD\"'", status="'\"authorized\"'",
                updated_at=quoted("strftime(moment, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"))}),
        "l_payments": (purchases, "k", {
            "PPE_id": "pay", "transaction_ref": "code", "event_timestamp": "moment + to_milliseconds(10)",
            "payment_method_type": METHODS.sql("c"), "amount_requested": "amount::real", "amount_processed": "amount::real",
            "authorization_code": "upper(md5(k::varchar)[:12])",
            "processing_fee": f"round(amount * {FEE_RATE}::double, 2)::real", "fraud_check_passed": "fraud < 0.8",
            "fraud_score": "fraud::real", "three_ds_authenticated": "c % 4 <> 0", "decline_reason": "NULL::varchar"}),
        "l_risk": (purchases, "k", {
            "TxnLink": "code", "FraudProb": "fraud::real", "ML_Risk": bucket("fraud"),
            "wallet_risk_assessment": document(score="fraud", wallet_age_days="(1 + k % 2500)")}),
        "l_sessions": (starts, "event_id", {
            "BSA_id": live_key("BSA", "session", "event_id"), "acq_ref": buyers("user_id + 1"), "session_start_time": "ts",
            "pages_viewed_count": "pages::int", "products_viewed_count": "seen::int", "cart_additions_count": "added::int",
            "cart_removals_count": "greatest(0, added - if(starts AND ends, 1, 0))::int", "checkout_initiated": "starts",
            "checkout_completed": "starts AND ends", "bounce_indicator": "pages = 1",
            "avg_time_per_page_seconds": "((8 + event_id % 1793) / pages)::real", "click_through_rate": "(seen / pages)::real",
            "scroll_depth_pct": "value::real", "session_value_estimate": "(seen * (8 + event_id % 113))::real"}),
        "l_predictions": (scored, "k", {
            "RMP_id": live_key("RMP", "prediction", "k"), "txn_link_ref": live_key("EVT", "purchase", "k"),
            "prediction_timestamp": "o_orderdate + to_seconds(60 + k % 86400)", "fraud_probability": "p::real",
            "risk_category_predicted": bucket("p"), "recommendation_action": f"if(p >= {RISK_HIGH}, 'manual_review', 'approve')",
            "manual_review_triggered": f"p >= {RISK_HIGH}", "actual_outcome": "NULL::varchar"}),
    }
    return {name: view(name, source, written, number) for name, (source, number, written) in found.items()}
