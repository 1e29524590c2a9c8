"""Source-shaped tables: columns, keys, references and identifier domains."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "bigint": LongType(),
    "int": IntegerType(),
    "float": FloatType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _schema(columns: str) -> StructType:
    """Schema of "name type" pairs; unlike StructType.fromDDL it needs no running session."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


# Column names, order and types of the ten source-shaped tables.
_DDL = {
    "markets": """
        PlatCode string, PlatName string, PlatformType string, AgeDays bigint,
        OperStatus string, RepScore string, ConfidenceLevel string, SizeCat string,
        DayTxnVol float, ActiveUsersMo string, SellerCount bigint, AcqCount bigint,
        ItemListings bigint, lastUpdated timestamp_ntz, RefreshHrs bigint,
        platform_compliance string""",
    "vendors": """
        SellerKey string, DaysActive bigint, PerformanceRating float, TotalTxns string,
        CompletedTxns bigint, DisputedEvents bigint, VerTier string,
        LastActiveDt timestamp_ntz, AccessLevel string, InvestigationFlag string,
        LE_Interest string, ComplianceRisk string, RegStandeff string,
        vendor_compliance_ratings string""",
    "buyers": """
        AcqCode string, ProfileAge bigint, PurchaseCount bigint, AuthLevel string,
        buyer_risk_profile string""",
    "products": """
        ProdCat string, Subcategory string, ListingAge bigint, SellerPointer string,
        product_availability string""",
    "transactions": """
        EventCode string, RecordTag string, EventTimestamp timestamp_ntz,
        PlatformKey string, VendorLink string, AcqLink string, OriginRegion string,
        DestRegion string, CrossBorder bigint, RouteComplex string,
        Transaction_Velocity string, Border_cross_border_pre string,
        GeoDistScore string, transaction_financials string""",
    "transaction_products": """
        EventLink string, ProdCat string, Subcategory string, ListingAge bigint,
        SellerPointer string, PriceAmt float, QtySold bigint""",
    "BuyerSessionAnalytics": """
        BSA_id string, acq_ref string, session_start_time timestamp_ntz,
        session_duration_seconds int, pages_viewed_count int,
        products_viewed_count int, cart_additions_count int,
        cart_removals_count int, search_queries_count int,
        checkout_initiated boolean, checkout_completed boolean,
        bounce_indicator boolean, referral_source string, device_category string,
        geo_region string, avg_time_per_page_seconds float,
        click_through_rate float, scroll_depth_pct float,
        error_encounters_count int, session_value_estimate float""",
    "PaymentProcessingEvents": """
        PPE_id string, transaction_ref string, event_timestamp timestamp_ntz,
        payment_method_type string, processing_stage string,
        amount_requested float, amount_processed float, currency_code string,
        processor_name string, authorization_code string, processing_fee float,
        processing_fee_pct float, fraud_check_passed boolean, fraud_score float,
        avs_response_code string, cvv_verification_passed boolean,
        three_ds_authenticated boolean, decline_reason string, retry_count int,
        processing_time_ms int""",
    "risk_analytics": """
        TxnLink string, RiskIndicatorCount bigint, FraudProb float, ML_Risk string,
        LinkedEvents bigint, ChainLength bigint, wallet_risk_assessment string""",
    "RiskModelPredictions": """
        RMP_id string, txn_link_ref string, prediction_timestamp timestamp_ntz,
        model_name string, model_version string, fraud_probability float,
        risk_category_predicted string, confidence_score float,
        top_risk_factor string, risk_factors_count int,
        feature_importance_velocity float, feature_importance_amount float,
        feature_importance_device float, feature_importance_behavior float,
        recommendation_action string, actual_outcome string,
        prediction_latency_ms int, ensemble_agreement_rate float,
        manual_review_triggered boolean, model_drift_indicator float""",
}

SCHEMAS: dict[str, StructType] = {name: _schema(columns) for name, columns in _DDL.items()}
TABLES = tuple(SCHEMAS)

# Kinds of tables, JSON columns, keys and references.
DIMENSIONS = ("markets", "vendors", "buyers", "products")
FACTS = tuple(name for name in TABLES if name not in DIMENSIONS)

JSON_COLUMNS = {
    "markets": "platform_compliance",
    "vendors": "vendor_compliance_ratings",
    "buyers": "buyer_risk_profile",
    "products": "product_availability",
    "transactions": "transaction_financials",
    "risk_analytics": "wallet_risk_assessment",
}

PRODUCT_KEY = ("ProdCat", "Subcategory", "ListingAge", "SellerPointer")
PRIMARY_KEYS = {
    "markets": ("PlatCode",),
    "vendors": ("SellerKey",),
    "buyers": ("AcqCode",),
    "products": PRODUCT_KEY,
    "transactions": ("EventCode",),
    "transaction_products": ("EventLink", *PRODUCT_KEY),
    "BuyerSessionAnalytics": ("BSA_id",),
    "PaymentProcessingEvents": ("PPE_id",),
    "risk_analytics": ("TxnLink",),
    "RiskModelPredictions": ("RMP_id",),
}

# (child table, child columns, parent table, parent columns)
REFERENCES = (
    ("transactions", ("PlatformKey",), "markets", ("PlatCode",)),
    ("transactions", ("VendorLink",), "vendors", ("SellerKey",)),
    ("transactions", ("AcqLink",), "buyers", ("AcqCode",)),
    ("transaction_products", ("EventLink",), "transactions", ("EventCode",)),
    ("transaction_products", PRODUCT_KEY, "products", PRODUCT_KEY),
    ("BuyerSessionAnalytics", ("acq_ref",), "buyers", ("AcqCode",)),
    ("PaymentProcessingEvents", ("transaction_ref",), "transactions", ("EventCode",)),
    ("risk_analytics", ("TxnLink",), "transactions", ("EventCode",)),
    ("RiskModelPredictions", ("txn_link_ref",), "risk_analytics", ("TxnLink",)),
)

# Facts whose own identifier carries HIST or LIVE: table -> (column, prefix)
FACT_IDS = {
    "transactions": ("EventCode", "EVT"),
    "BuyerSessionAnalytics": ("BSA_id", "BSA"),
    "PaymentProcessingEvents": ("PPE_id", "PPE"),
    "RiskModelPredictions": ("RMP_id", "RMP"),
}

# Columns of the gold models.
GOLD_SCHEMAS: dict[str, StructType] = {
    name: _schema(columns)
    for name, columns in {
        "daily_market_metrics": """
            metric_date date, platform_key string, transaction_count bigint,
            unique_buyers bigint, unique_vendors bigint, gross_merchandise_value double,
            cross_border_transactions bigint, high_risk_transactions bigint,
            payment_failed_events bigint""",
        "vendor_risk_summary": """
            seller_key string, transaction_count bigint, unique_buyers bigint,
            gross_merchandise_value double, high_risk_transactions bigint,
            average_fraud_probability double, last_transaction_at timestamp_ntz""",
        "buyer_360": """
            buyer_key string, transaction_count bigint, session_count bigint,
            completed_checkouts bigint, lifetime_value double,
            average_session_seconds double, last_purchase_at timestamp_ntz,
            auth_level string, buyer_risk_profile string""",
        "product_performance": """
            product_category string, subcategory string, listing_age bigint,
            seller_key string, transaction_count bigint, units_sold bigint,
            gross_revenue double, product_availability string""",
    }.items()
}

# View name of each silver table, as the gold models know it.
SILVER_VIEWS = {
    "markets": "silver_markets",
    "vendors": "silver_vendors",
    "buyers": "silver_buyers",
    "products": "silver_products",
    "transactions": "silver_transactions",
    "transaction_products": "silver_transaction_products",
    "BuyerSessionAnalytics": "silver_sessions",
    "PaymentProcessingEvents": "silver_payments",
    "risk_analytics": "silver_risk",
    "RiskModelPredictions": "silver_predictions",
}

# `ordinal` is the capture order of changes that share an LSN; NULL when the capture has none.
SOURCE = _schema(
    "connector string, service string, database string, lsn string, xid string, ordinal bigint"
)
ENVELOPE = (
    StructType()
    .add("schema_version", IntegerType())
    .add("event_id", StringType())
    .add("ingested_at", TimestampNTZType())
    .add("source", SOURCE)
    .add("change", StringType())
)


@dataclass(frozen=True)
class Domain:
    """Sizes of the identifier domains; the defaults are the standard universe."""

    markets: int = 10
    vendors: int = 1_000
    buyers: int = 10_000
    products_per_vendor: int = 4
    reference_rows: int = 1_000_000

    @property
    def products(self) -> int:
        return self.vendors * self.products_per_vendor

    def dimension_rows(self) -> dict[str, int]:
        return {
            "markets": self.markets,
            "vendors": self.vendors,
            "buyers": self.buyers,
            "products": self.products,
        }
