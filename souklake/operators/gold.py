"""Gold models.

Every many-to-one input is aggregated to its join key before it is joined, so both sides of
each join are unique on the key: a transaction, vendor or product that holds a third of all
rows is folded map-side and never reaches one task whole. Joins carry no broadcast hint; the
sizes of dimensions are left to the run-time statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.functions import documents
from souklake.functions.keys import key_hash
from souklake.schemas import PRODUCT_KEY

# Payment stages that count as failed.
FAILED_STAGES = ("declined", "failed")


def risk_by_transaction(risk: DataFrame) -> DataFrame:
    """One row per TxnLink. `copies` keeps what a plain join would multiply a transaction by."""
    return risk.groupBy(key_hash("TxnLink").alias("TxnLink_hash"), "TxnLink").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(F.col("ML_Risk") == "high").alias("high_risk"),
        F.sum(F.col("FraudProb").cast("double")).alias("fraud_sum"),
        F.count("FraudProb").alias("fraud_rows"),
    )


def failures_by_transaction(payments: DataFrame) -> DataFrame:
    """Failed payment events per transaction; transactions without one are left out."""
    return (
        payments.where(F.col("processing_stage").isin(*FAILED_STAGES))
        .groupBy(key_hash("transaction_ref").alias("transaction_ref_hash"), "transaction_ref")
        .agg(F.count(F.lit(1)).alias("failed_events"))
    )


def scored_transactions(
    transactions: DataFrame, risk: DataFrame, payments: DataFrame | None = None
) -> DataFrame:
    """Narrow transactions with amount, risk and (when given) failed payments.

    Both joins use the transaction key, so the second one reuses the partitioning of the first.
    The batch plan writes this table once and derives three models from it.
    """
    narrow = transactions.select(
        key_hash("EventCode").alias("EventCode_hash"),
        "EventCode",
        "EventTimestamp",
        "PlatformKey",
        "VendorLink",
        "AcqLink",
        "CrossBorder",
        documents.number_at(F.col("transaction_financials"), "$.amount").alias("amount"),
    )

    def joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        same = (F.col("EventCode_hash") == F.col(f"{key}_hash")) & (F.col("EventCode") == F.col(key))
        return left.join(right, same, "left").drop(f"{key}_hash", key)

    scored = joined(narrow, risk_by_transaction(risk), "TxnLink")
    if payments is not None:
        scored = joined(scored, failures_by_transaction(payments), "transaction_ref")
    scored = scored.drop("EventCode_hash")
    return scored.withColumn("copies", F.coalesce("copies", F.lit(1)))


def daily_market_metrics(scored: DataFrame) -> DataFrame:
    """Date and platform. GMV and cross-border stay NULL when every input is NULL."""
    return scored.groupBy(
        F.to_date("EventTimestamp").alias("metric_date"), F.col("PlatformKey").alias("platform_key")
    ).agg(
        F.sum("copies").alias("transaction_count"),
        F.count_distinct("AcqLink").alias("unique_buyers"),
        F.count_distinct("VendorLink").alias("unique_vendors"),
        F.sum(F.col("amount") * F.col("copies")).alias("gross_merchandise_value"),
        F.sum(F.col("CrossBorder") * F.col("copies")).alias("cross_border_transactions"),
        F.coalesce(F.sum("high_risk"), F.lit(0)).alias("high_risk_transactions"),
        F.coalesce(F.sum(F.col("failed_events") * F.col("copies")), F.lit(0)).alias(
            "payment_failed_events"
        ),
    )


def vendor_risk_summary(vendors: DataFrame, scored: DataFrame) -> DataFrame:
    """Vendor. An idle vendor counts 0; its fraud average and last time stay NULL."""
    activity = (
        scored.where(F.col("VendorLink").isNotNull())
        .groupBy("VendorLink")
        .agg(
            F.sum(F.when(F.col("EventCode").isNotNull(), F.col("copies"))).alias("rows"),
            F.count_distinct("AcqLink").alias("buyers"),
            F.sum(F.col("amount") * F.col("copies")).alias("gmv"),
            F.sum("high_risk").alias("high"),
            F.sum("fraud_sum").alias("fraud_sum"),
            F.sum("fraud_rows").alias("fraud_rows"),
            F.max("EventTimestamp").alias("last_at"),
        )
    )
    return vendors.select("SellerKey").join(
        activity, F.col("SellerKey") == F.col("VendorLink"), "left"
    ).select(
        F.col("SellerKey").alias("seller_key"),
        F.coalesce("rows", F.lit(0)).alias("transaction_count"),
        F.coalesce("buyers", F.lit(0)).alias("unique_buyers"),
        F.coalesce("gmv", F.lit(0.0)).alias("gross_merchandise_value"),
        F.coalesce("high", F.lit(0)).alias("high_risk_transactions"),
        F.try_divide("fraud_sum", "fraud_rows").alias("average_fraud_probability"),
        F.col("last_at").alias("last_transaction_at"),
    )


def buyer_360(buyers: DataFrame, purchases: DataFrame, sessions: DataFrame) -> DataFrame:
    """Buyer. `purchases` needs AcqLink, EventTimestamp and amount, one row per transaction."""
    bought = purchases.groupBy("AcqLink").agg(
        F.count(F.lit(1)).alias("purchases"),
        F.sum("amount").alias("spent"),
        F.max("EventTimestamp").alias("last_purchase_at"),
    )
    visited = sessions.groupBy("acq_ref").agg(
        F.count(F.lit(1)).alias("visits"),
        F.count_if("checkout_completed").alias("completed"),
        F.avg("session_duration_seconds").alias("average_session_seconds"),
    )
    return (
        buyers.select("AcqCode", "AuthLevel", "buyer_risk_profile")
        .join(bought, F.col("AcqCode") == F.col("AcqLink"), "left")
        .join(visited, F.col("AcqCode") == F.col("acq_ref"), "left")
        .select(
            F.col("AcqCode").alias("buyer_key"),
            F.coalesce("purchases", F.lit(0)).alias("transaction_count"),
            F.coalesce("visits", F.lit(0)).alias("session_count"),
            F.coalesce("completed", F.lit(0)).alias("completed_checkouts"),
            F.coalesce("spent", F.lit(0.0)).alias("lifetime_value"),
            "average_session_seconds",
            "last_purchase_at",
            F.col("AuthLevel").alias("auth_level"),
            "buyer_risk_profile",
        )
    )


def purchases(transactions: DataFrame) -> DataFrame:
    """What `buyer_360` needs of the transactions."""
    return transactions.select(
        "AcqLink",
        "EventTimestamp",
        documents.number_at(F.col("transaction_financials"), "$.amount").alias("amount"),
    )


def product_performance(products: DataFrame, items: DataFrame) -> DataFrame:
    """Product key. Revenue multiplies in single precision and sums in double."""
    number = key_hash(*PRODUCT_KEY).alias("_hash")
    sold = items.groupBy(number, *PRODUCT_KEY).agg(
        F.count("EventLink").alias("lines"),
        F.sum("QtySold").alias("units"),
        F.sum((F.col("PriceAmt") * F.col("QtySold").cast("float")).cast("double")).alias("revenue"),
    )
    return products.withColumn("_hash", number).join(sold, ["_hash", *PRODUCT_KEY], "left").select(
        F.col("ProdCat").alias("product_category"),
        F.col("Subcategory").alias("subcategory"),
        F.col("ListingAge").alias("listing_age"),
        F.col("SellerPointer").alias("seller_key"),
        F.coalesce("lines", F.lit(0)).alias("transaction_count"),
        F.coalesce("units", F.lit(0)).alias("units_sold"),
        F.coalesce("revenue", F.lit(0.0)).alias("gross_revenue"),
        "product_availability",
    )


GOLD_ORDER = {
    "daily_market_metrics": ("metric_date", "platform_key"),
    "vendor_risk_summary": ("seller_key",),
    "buyer_360": ("buyer_key",),
    "product_performance": ("seller_key", "product_category", "subcategory", "listing_age"),
}


def gold_models(silver: dict[str, DataFrame], scored: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four models over the ten silver tables.

    `scored` may be a stored `scored_transactions` with payments. It has one row per transaction,
    so the buyer model reads it as well and the JSON amounts are parsed once.
    """
    if scored is None:
        scored = scored_transactions(
            silver["transactions"], silver["risk_analytics"], silver["PaymentProcessingEvents"]
        )
    return {
        "daily_market_metrics": daily_market_metrics(scored),
        "vendor_risk_summary": vendor_risk_summary(silver["vendors"], scored),
        "buyer_360": buyer_360(silver["buyers"], scored, silver["BuyerSessionAnalytics"]),
        "product_performance": product_performance(
            silver["products"], silver["transaction_products"]
        ),
    }
