"""Table synthesis: a row of any table is a function of its number.

`history_rows` and `seed_rows` project a DataFrame of row numbers (`spark.range`, or numbers
taken from another table) into full-width rows: one map-only stage, no shuffle, and any part can
be produced again from its range alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.functions import documents, keys, values
from souklake.schemas import SCHEMAS, Domain

# Fixed values of the generated history.
HISTORY_START = "2024-01-01"
YEAR_SECONDS = 31_536_000
REGIONS = ("NA", "EU", "APAC", "LATAM")
REFERRALS = ("direct", "search", "affiliate", "social")
DEVICES = ("desktop", "mobile", "tablet")
PAYMENT_METHODS = ("card", "wallet", "bank_transfer")
PROCESSORS = ("nova-pay", "orbit-pay")
RISK_FACTORS = ("velocity", "amount", "device", "behavior")
LINE_SHARES = (0.45, 0.55)
AMOUNT_BASE, AMOUNT_CENTS = 5, 250_000
FEE_RATE, FEE_PERCENT = 0.021, 2.1
MODEL = ("cyber-risk-lite", "1.0.0")
RISK_POINTS_MEDIUM, RISK_POINTS_HIGH = 300, 700

# The market label is free text of the deployment.
MARKET_LABEL = "Market"

Columns = dict[str, Column]


def _digest(kind: str, number: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{kind}:"), number.cast("string")))


def _moment(number: Column) -> Column:
    return F.timestamp_add("SECOND", number % YEAR_SECONDS, values.timestamp(HISTORY_START))


def _one_in(number: Column, step: int, hit: str, miss: str | None) -> Column:
    return F.when(number % step == 0, hit).otherwise(F.lit(miss))


def amount(number: Column) -> Column:
    """Amount of history transaction `number`."""
    return AMOUNT_BASE + values.ratio(number % AMOUNT_CENTS, 100)


def _permille(number: Column, factor: int = 1) -> Column:
    return values.real(values.ratio((number * factor) % 1000, 1000))


def _points_bucket(number: Column) -> Column:
    return values.risk_bucket(number % 1000, RISK_POINTS_MEDIUM, RISK_POINTS_HIGH)


def _markets(i: Column, domain: Domain) -> Columns:
    return {
        "PlatCode": keys.market_key(i),
        "PlatName": F.concat_ws(" ", F.lit(MARKET_LABEL), i.cast("string"), F.md5(i.cast("string"))),
        "PlatformType": _one_in(i, 3, "marketplace", "specialized"),
        "AgeDays": 365 + i % 8000,
        "OperStatus": F.lit("active"),
        "RepScore": 60 + i % 40,
        "ConfidenceLevel": F.lit("high"),
        "SizeCat": _one_in(i, 3, "large", "medium"),
        "DayTxnVol": 1000 + i % 50_000,
        "ActiveUsersMo": 10_000 + i % 900_000,
        "SellerCount": 100 + i % 50_000,
        "AcqCount": 1000 + i % 500_000,
        "ItemListings": 1000 + i % 1_000_000,
        "lastUpdated": _moment(i),
        "RefreshHrs": F.lit(24),
        "platform_compliance": documents.build(status=F.lit("compliant"), audit=_digest("market", i)),
    }


def _vendors(i: Column, domain: Domain) -> Columns:
    return {
        "SellerKey": keys.vendor_key(i),
        "DaysActive": 30 + i % 3000,
        "PerformanceRating": 3 + values.ratio(i % 20, 10),
        "TotalTxns": i % 50_000,
        "CompletedTxns": i % 49_000,
        "DisputedEvents": i % 25,
        "VerTier": _one_in(i, 10, "enhanced", "standard"),
        "LastActiveDt": _moment(i),
        "AccessLevel": F.lit("active"),
        "InvestigationFlag": _one_in(i, 97, "review", "none"),
        "LE_Interest": _one_in(i, 53, "medium", "low"),
        "ComplianceRisk": F.lit("low"),
        "RegStandeff": F.lit("verified"),
        "vendor_compliance_ratings": documents.build(
            rating_id=_digest("vendor", i), reviewed=i % 2 == 0
        ),
    }


def _buyers(i: Column, domain: Domain) -> Columns:
    return {
        "AcqCode": keys.buyer_key(i),
        "ProfileAge": i % 2500,
        "PurchaseCount": i % 500,
        "AuthLevel": _one_in(i, 3, "mfa", "standard"),
        "buyer_risk_profile": documents.build(
            fingerprint=_digest("buyer", i), score=values.ratio(i % 1000, 1000)
        ),
    }


def _products(i: Column, domain: Domain) -> Columns:
    return {
        **keys.product_key(i, domain.products_per_vendor),
        "product_availability": documents.build(stock=i % 500, sku_hash=_digest("product", i)),
    }


def _transactions(i: Column, domain: Domain) -> Columns:
    third = keys.whole(i, 3)
    crosses = i % len(REGIONS) != third % len(REGIONS)
    return {
        "EventCode": keys.history_key("EVT", i),
        "RecordTag": F.lit("purchase"),
        "EventTimestamp": _moment(i),
        "PlatformKey": keys.market_key(keys.cycle(i, domain.markets)),
        "VendorLink": keys.vendor_key(keys.cycle(i, domain.vendors)),
        "AcqLink": keys.buyer_key(keys.cycle(i, domain.buyers)),
        "OriginRegion": keys.pick(i, *REGIONS),
        "DestRegion": keys.pick(third, *REGIONS),
        "CrossBorder": crosses,
        "RouteComplex": values.route(crosses),
        "Transaction_Velocity": _one_in(i, 5, "burst", "normal"),
        "Border_cross_border_pre": values.border_label(crosses),
        "GeoDistScore": values.ratio((i * 37) % 10_000, 100),
        "transaction_financials": documents.build(
            amount=amount(i),
            currency=F.lit("USD"),
            status=F.lit("settled"),
            trace=_digest("txn", i),
        ),
    }


def history_products(transaction: Column, line: Column, domain: Domain) -> Column:
    """Number of the product on line 1 or 2 of a history transaction: its vendor's first two."""
    vendor = keys.cycle(transaction, domain.vendors)
    return (vendor - 1) * domain.products_per_vendor + line


def _transaction_products(i: Column, domain: Domain) -> Columns:
    lines = len(LINE_SHARES)
    transaction = 1 + keys.whole(i - 1, lines)
    line = keys.cycle(i, lines)
    share = F.when(line == 1, LINE_SHARES[0]).otherwise(LINE_SHARES[1])
    return {
        "EventLink": keys.history_key("EVT", transaction),
        **keys.product_key(history_products(transaction, line, domain), domain.products_per_vendor),
        "PriceAmt": amount(transaction) * share,
        "QtySold": F.lit(1),
    }


def _sessions(i: Column, domain: Domain) -> Columns:
    return {
        "BSA_id": keys.history_key("BSA", i),
        "acq_ref": keys.buyer_key(keys.cycle(i, domain.buyers)),
        "session_start_time": _moment(i),
        "session_duration_seconds": 10 + i % 1800,
        "pages_viewed_count": 1 + i % 30,
        "products_viewed_count": i % 15,
        "cart_additions_count": i % 5,
        "cart_removals_count": i % 3,
        "search_queries_count": i % 8,
        "checkout_initiated": i % 3 == 0,
        "checkout_completed": i % 5 == 0,
        "bounce_indicator": i % 7 == 0,
        "referral_source": keys.pick(i, *REFERRALS),
        "device_category": keys.pick(i, *DEVICES),
        "geo_region": keys.pick(i, *REGIONS),
        "avg_time_per_page_seconds": 5 + i % 120,
        "click_through_rate": _permille(i),
        "scroll_depth_pct": i % 101,
        "error_encounters_count": i % 3,
        "session_value_estimate": values.ratio((i * 13) % 100_000, 100),
    }


def _payments(i: Column, domain: Domain) -> Columns:
    transaction = keys.cycle(i, domain.reference_rows)
    due = amount(i)
    return {
        "PPE_id": keys.history_key("PPE", i),
        "transaction_ref": keys.history_key("EVT", transaction),
        "event_timestamp": F.timestamp_add("MILLISECOND", 10 + i % 900, _moment(transaction)),
        "payment_method_type": keys.pick(i, *PAYMENT_METHODS),
        "processing_stage": F.lit("settled"),
        "amount_requested": due,
        "amount_processed": due,
        "currency_code": F.lit("USD"),
        "processor_name": keys.pick(i, *PROCESSORS),
        "authorization_code": F.upper(F.substring(_digest("auth", i), 1, 12)),
        "processing_fee": due * FEE_RATE,
        "processing_fee_pct": F.lit(FEE_PERCENT),
        "fraud_check_passed": i % 100 != 0,
        "fraud_score": _permille(i, 17),
        "avs_response_code": F.lit("Y"),
        "cvv_verification_passed": i % 50 != 0,
        "three_ds_authenticated": i % 4 != 0,
        "decline_reason": _one_in(i, 100, "risk_decline", None),
        "retry_count": i % 3,
        "processing_time_ms": 25 + i % 900,
    }


def _risk(i: Column, domain: Domain) -> Columns:
    return {
        "TxnLink": keys.history_key("EVT", i),
        "RiskIndicatorCount": i % 6,
        "FraudProb": _permille(i, 17),
        "ML_Risk": _points_bucket(i),
        "LinkedEvents": i % 9,
        "ChainLength": 1 + i % 5,
        "wallet_risk_assessment": documents.build(
            wallet_hash=_digest("wallet", i), age_days=i % 2500
        ),
    }


def _predictions(i: Column, domain: Domain) -> Columns:
    transaction = keys.cycle(i, domain.reference_rows)
    bucket = _points_bucket(i)
    agreement = 0.6 + values.ratio(i % 400, 1000)
    return {
        "RMP_id": keys.history_key("RMP", i),
        "txn_link_ref": keys.history_key("EVT", transaction),
        "prediction_timestamp": F.timestamp_add("SECOND", 1 + i % 300, _moment(transaction)),
        "model_name": F.lit(MODEL[0]),
        "model_version": F.lit(MODEL[1]),
        "fraud_probability": _permille(i, 17),
        "risk_category_predicted": bucket,
        "confidence_score": agreement,
        "top_risk_factor": keys.pick(i, *RISK_FACTORS),
        "risk_factors_count": 1 + i % 8,
        "feature_importance_velocity": _permille(i, 3),
        "feature_importance_amount": _permille(i, 5),
        "feature_importance_device": _permille(i, 7),
        "feature_importance_behavior": _permille(i, 11),
        "recommendation_action": values.recommendation(bucket),
        "actual_outcome": _one_in(i, 3, "fraud", "legitimate"),
        "prediction_latency_ms": 2 + i % 95,
        "ensemble_agreement_rate": agreement,
        "manual_review_triggered": bucket == "high",
        "model_drift_indicator": values.ratio(i % 200, 1000),
    }


_HISTORY: dict[str, Callable[[Column, Domain], Columns]] = {
    "markets": _markets,
    "vendors": _vendors,
    "buyers": _buyers,
    "products": _products,
    "transactions": _transactions,
    "transaction_products": _transaction_products,
    "BuyerSessionAnalytics": _sessions,
    "PaymentProcessingEvents": _payments,
    "risk_analytics": _risk,
    "RiskModelPredictions": _predictions,
}


def _shape(numbers: DataFrame, table: str, columns: Columns) -> DataFrame:
    """Columns in schema order, cast to the schema's types."""
    return numbers.select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in SCHEMAS[table]]
    )


def row_numbers(spark: SparkSession, start: int, rows: int, parts: int | None = None) -> DataFrame:
    """Numbers start … start+rows-1 as column `i`."""
    return spark.range(start, start + rows, 1, parts).withColumnRenamed("id", "i")


def history_rows(numbers: DataFrame, table: str, domain: Domain = Domain()) -> DataFrame:
    """History rows of a table for the numbers in column `i` (counted from 1)."""
    return _shape(numbers, table, _HISTORY[table](F.col("i").cast("bigint"), domain))


def seed_rows(numbers: DataFrame, table: str, now: Column, domain: Domain = Domain()) -> DataFrame:
    """Operational rows of a dimension; the formulas differ from those of its history."""
    return _shape(numbers, table, _SEED[table](F.col("i").cast("bigint"), domain, now))


def _seed_markets(i: Column, domain: Domain, now: Column) -> Columns:
    return {
        "PlatCode": keys.market_key(i),
        "PlatName": F.concat_ws(" ", F.lit(MARKET_LABEL), i.cast("string")),
        "PlatformType": _one_in(i, 3, "marketplace", "specialized"),
        "AgeDays": 365 + i * 30,
        "OperStatus": F.lit("active"),
        "RepScore": 70 + i % 30,
        "ConfidenceLevel": _one_in(i, 4, "medium", "high"),
        "SizeCat": F.when(i < 4, "large").otherwise("medium"),
        "DayTxnVol": 1000 + i * 125,
        "ActiveUsersMo": 10_000 + i * 900,
        "SellerCount": F.lit(domain.vendors),
        "AcqCount": F.lit(domain.buyers),
        "ItemListings": F.lit(domain.products),
        "lastUpdated": now,
        "RefreshHrs": F.lit(24),
        "platform_compliance": documents.build(
            status=F.lit("compliant"), review_cycle_days=F.lit(90)
        ),
    }


def _seed_vendors(i: Column, domain: Domain, now: Column) -> Columns:
    return {
        "SellerKey": keys.vendor_key(i),
        "DaysActive": 30 + i % 2000,
        "PerformanceRating": 3 + values.ratio(i % 20, 10),
        "TotalTxns": i % 5000,
        "CompletedTxns": i % 4900,
        "DisputedEvents": i % 20,
        "VerTier": _one_in(i, 10, "enhanced", "standard"),
        "LastActiveDt": F.timestamp_add("DAY", -(i % 30), now),
        "AccessLevel": F.lit("active"),
        "InvestigationFlag": _one_in(i, 97, "review", "none"),
        "LE_Interest": _one_in(i, 53, "medium", "low"),
        "ComplianceRisk": _one_in(i, 41, "medium", "low"),
        "RegStandeff": F.lit("verified"),
        "vendor_compliance_ratings": documents.build(score=60 + i % 40, reviewed=F.lit(True)),
    }


def _seed_buyers(i: Column, domain: Domain, now: Column) -> Columns:
    return {
        "AcqCode": keys.buyer_key(i),
        "ProfileAge": i % 2500,
        "PurchaseCount": i % 100,
        "AuthLevel": _one_in(i, 3, "mfa", "standard"),
        "buyer_risk_profile": documents.build(score=values.ratio(i % 1000, 1000), segment=i % 20),
    }


def _seed_products(i: Column, domain: Domain, now: Column) -> Columns:
    return {
        **keys.product_key(i, domain.products_per_vendor),
        "product_availability": documents.build(stock=50 + i % 450, available=F.lit(True)),
    }


_SEED: dict[str, Callable[[Column, Domain, Column], Columns]] = {
    "markets": _seed_markets,
    "vendors": _seed_vendors,
    "buyers": _seed_buyers,
    "products": _seed_products,
}

