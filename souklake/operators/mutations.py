"""Operational inserts and updates over whole batches of events.

Updates are folded per key first (sums, counts and maxima combine map-side), so the side that is
joined to a table has one row per key and a key with a third of all events costs no more than any
other. Plain Parquet has no MERGE: an update is a join and a rewrite.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from souklake.functions import documents, values
from souklake.operators.synth import FEE_PERCENT, FEE_RATE, LINE_SHARES, MODEL
from souklake.schemas import PRODUCT_KEY, SCHEMAS

# Fixed values of live events.
FRAUD_CHECK_LIMIT = 0.8
PAYMENT_DELAY_MS = 10
RECENT = 1_000
CHANGES_PER_PURCHASE = 7


def _shape(rows: DataFrame, table: str, columns: dict[str, Column]) -> DataFrame:
    return rows.select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in SCHEMAS[table]]
    )


# inserts ------------------------------------------------------------------------------------


def absent_rows(
    target: DataFrame, incoming: DataFrame, key: tuple[str, ...], order: tuple[str, ...] = ()
) -> DataFrame:
    """Incoming rows whose key the target lacks, one per key: what an append has to write.

    Of several incoming rows of a key the first by `order` is taken, and of those that tie, or
    without an order, the first by all other columns: the same row in every run.
    """
    columns = incoming.columns
    ranked = W.partitionBy(*key).orderBy(*order, *[c for c in columns if c not in (*key, *order)])
    alone = len(columns) == len(key) and not order
    one = (
        incoming.dropDuplicates()
        if alone
        else incoming.withColumn("_n", F.row_number().over(ranked)).where("_n = 1")
    )
    return one.join(target.select(*key), list(key), "left_anti").select(*columns)


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, key: tuple[str, ...], order: tuple[str, ...] = ()
) -> DataFrame:
    return target.unionByName(absent_rows(target, incoming, key, order))


def vendor_first_products(products: DataFrame, count: int = 2) -> DataFrame:
    """The `count` youngest listings of each vendor, numbered by age."""
    order = W.partitionBy("SellerPointer").orderBy("ListingAge", "ProdCat", "Subcategory")
    return (
        products.select(*PRODUCT_KEY)
        .withColumn("line", F.row_number().over(order))
        .where(F.col("line") <= count)
    )


def purchase_transactions(purchases: DataFrame) -> DataFrame:
    crosses = F.col("origin") != F.col("destination")
    return _shape(
        purchases,
        "transactions",
        {
            "EventCode": F.col("event_code"),
            "RecordTag": F.lit("purchase"),
            "EventTimestamp": F.col("purchased_at"),
            "PlatformKey": F.col("platform_key"),
            "VendorLink": F.col("vendor_key"),
            "AcqLink": F.col("buyer_key"),
            "OriginRegion": F.col("origin"),
            "DestRegion": F.col("destination"),
            "CrossBorder": crosses,
            "RouteComplex": values.route(crosses),
            "Transaction_Velocity": F.col("velocity"),
            "Border_cross_border_pre": values.border_label(crosses),
            "GeoDistScore": F.col("geo_score"),
            "transaction_financials": documents.build(
                amount=F.col("amount"),
                currency=F.lit("USD"),
                status=F.lit("authorized"),
                updated_at=values.iso_instant(F.col("purchased_at"), millis=True),
            ),
        },
    )


def purchase_items(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """Two lines per purchase; fails when a vendor has fewer than two listings.

    The vendor's two listings travel as one row, so the join has a unique side and adaptive
    execution can split a hot vendor's purchases.
    """
    first = vendor_first_products(products, len(LINE_SHARES))
    pair = first.groupBy("SellerPointer").agg(
        *[
            F.max(F.when(F.col("line") == n, F.struct("ProdCat", "Subcategory", "ListingAge"))).alias(f"_{n}")
            for n in range(1, len(LINE_SHARES) + 1)
        ]
    )
    lines = F.array(
        *[
            F.struct(F.col(f"_{n}").alias("product"), F.lit(share).alias("share"))
            for n, share in enumerate(LINE_SHARES, start=1)
        ]
    )
    sold = purchases.select("event_code", "vendor_key", "amount").join(
        pair, F.col("vendor_key") == F.col("SellerPointer"), "left"
    )
    missing = F.raise_error(F.concat(F.lit("fewer than two products for "), F.col("vendor_key")))
    listed = F.when(F.col(f"_{len(LINE_SHARES)}").isNotNull(), lines).otherwise(missing)
    return _shape(
        sold.withColumn("_line", F.explode(listed)),
        "transaction_products",
        {
            "EventLink": F.col("event_code"),
            "ProdCat": F.col("_line.product.ProdCat"),
            "Subcategory": F.col("_line.product.Subcategory"),
            "ListingAge": F.col("_line.product.ListingAge"),
            "SellerPointer": F.col("vendor_key"),
            "PriceAmt": F.col("amount") * F.col("_line.share"),
            "QtySold": F.lit(1),
        },
    )


def purchase_payments(purchases: DataFrame) -> DataFrame:
    return _shape(
        purchases,
        "PaymentProcessingEvents",
        {
            "PPE_id": F.col("payment_id"),
            "transaction_ref": F.col("event_code"),
            "event_timestamp": F.timestamp_add(
                "MILLISECOND", F.lit(PAYMENT_DELAY_MS), F.col("purchased_at")
            ),
            "payment_method_type": F.col("payment_method"),
            "processing_stage": F.lit("authorized"),
            "amount_requested": F.col("amount"),
            "amount_processed": F.col("amount"),
            "currency_code": F.lit("USD"),
            "processor_name": F.col("processor"),
            "authorization_code": F.col("authorization_code"),
            "processing_fee": F.round(F.col("amount") * FEE_RATE, 2),
            "processing_fee_pct": F.lit(FEE_PERCENT),
            "fraud_check_passed": F.col("fraud_probability") < FRAUD_CHECK_LIMIT,
            "fraud_score": F.col("fraud_probability"),
            "avs_response_code": F.lit("Y"),
            "cvv_verification_passed": F.lit(True),
            "three_ds_authenticated": F.col("three_ds"),
            "decline_reason": F.lit(None),
            "retry_count": F.lit(0),
            "processing_time_ms": F.col("processing_time_ms"),
        },
    )


def purchase_risk(purchases: DataFrame) -> DataFrame:
    return _shape(
        purchases,
        "risk_analytics",
        {
            "TxnLink": F.col("event_code"),
            "RiskIndicatorCount": F.col("risk_indicators"),
            "FraudProb": F.col("fraud_probability"),
            "ML_Risk": values.risk_bucket(F.col("fraud_probability")),
            "LinkedEvents": F.col("linked_events"),
            "ChainLength": F.col("chain_length"),
            "wallet_risk_assessment": documents.build(
                score=F.col("fraud_probability"), wallet_age_days=F.col("wallet_age_days")
            ),
        },
    )


def purchase_changes(purchases: DataFrame) -> DataFrame:
    """The seven row changes of each purchase: table, action and the key of the changed row."""

    def change(table: str, action: str, key: Column) -> Column:
        return F.struct(F.lit(table).alias("table"), F.lit(action).alias("action"), key.alias("row_key"))

    code = F.col("event_code")
    fan_out = F.array(
        change("transactions", "I", code),
        change("transaction_products", "I", F.concat(code, F.lit("#1"))),
        change("transaction_products", "I", F.concat(code, F.lit("#2"))),
        change("PaymentProcessingEvents", "I", F.col("payment_id")),
        change("risk_analytics", "I", code),
        change("buyers", "U", F.col("buyer_key")),
        change("vendors", "U", F.col("vendor_key")),
    )
    return purchases.select(F.explode(fan_out).alias("_c")).select("_c.*")


def session_rows(visits: DataFrame) -> DataFrame:
    """Sessions from raw visit counts: viewed products never exceed pages, additions never exceed
    products, and a completed checkout takes one item out of the cart."""
    pages = F.col("pages")
    products = F.least(pages, F.col("products_wanted"))
    additions = F.least(products, F.col("additions_wanted"))
    started = (additions > 0) & F.col("wants_checkout")
    completed = started & F.col("completes_checkout")
    return _shape(
        visits,
        "BuyerSessionAnalytics",
        {
            "BSA_id": F.col("session_id"),
            "acq_ref": F.col("buyer_key"),
            "session_start_time": F.col("started_at"),
            "session_duration_seconds": F.col("duration"),
            "pages_viewed_count": pages,
            "products_viewed_count": products,
            "cart_additions_count": additions,
            "cart_removals_count": F.greatest(F.lit(0), additions - F.when(completed, 1).otherwise(0)),
            "search_queries_count": F.col("searches"),
            "checkout_initiated": started,
            "checkout_completed": completed,
            "bounce_indicator": pages == 1,
            "referral_source": F.col("referral"),
            "device_category": F.col("device"),
            "geo_region": F.col("region"),
            "avg_time_per_page_seconds": F.col("duration").cast("double") / pages,
            "click_through_rate": products.cast("double") / pages,
            "scroll_depth_pct": F.col("scroll_depth"),
            "error_encounters_count": F.col("errors"),
            "session_value_estimate": F.round(products * F.col("value_per_product"), 2),
        },
    )


def prediction_rows(scores: DataFrame) -> DataFrame:
    """Predictions from scored transactions: bucket, recommendation and review flag follow."""
    bucket = values.risk_bucket(F.col("probability"))
    return _shape(
        scores,
        "RiskModelPredictions",
        {
            "RMP_id": F.col("prediction_id"),
            "txn_link_ref": F.col("event_code"),
            "prediction_timestamp": F.col("predicted_at"),
            "model_name": F.lit(MODEL[0]),
            "model_version": F.lit(MODEL[1]),
            "fraud_probability": F.col("probability"),
            "risk_category_predicted": bucket,
            "confidence_score": F.col("confidence"),
            "top_risk_factor": F.col("top_factor"),
            "risk_factors_count": F.col("factors"),
            "feature_importance_velocity": F.col("velocity_weight"),
            "feature_importance_amount": F.col("amount_weight"),
            "feature_importance_device": F.col("device_weight"),
            "feature_importance_behavior": F.col("behavior_weight"),
            "recommendation_action": values.recommendation(bucket),
            "actual_outcome": F.lit(None),
            "prediction_latency_ms": F.col("latency_ms"),
            "ensemble_agreement_rate": F.col("agreement"),
            "manual_review_triggered": bucket == "high",
            "model_drift_indicator": F.col("drift"),
        },
    )


# updates ------------------------------------------------------------------------------------


def _updated(target: DataFrame, folded: DataFrame, on: Column, new: dict[str, Column]) -> DataFrame:
    """Target with the given columns replaced where the folded side matches."""
    joined = target.join(folded, on, "left")
    hit = F.col("_n").isNotNull()
    return joined.select(
        *[F.when(hit, new[c]).otherwise(target[c]).alias(c) if c in new else target[c] for c in target.columns]
    )


def count_buyer_purchases(buyers: DataFrame, purchases: DataFrame) -> DataFrame:
    """Purchase counter and time of the last purchase inside the risk profile."""
    folded = purchases.groupBy("buyer_key").agg(
        F.count(F.lit(1)).alias("_n"), F.max("purchased_at").alias("_last")
    )
    patch = documents.build(last_purchase_at=values.iso_instant(F.col("_last")))
    return _updated(
        buyers,
        folded,
        buyers["AcqCode"] == F.col("buyer_key"),
        {
            "PurchaseCount": buyers["PurchaseCount"] + F.col("_n"),
            "buyer_risk_profile": documents.merge(buyers["buyer_risk_profile"], patch),
        },
    )


def count_vendor_sales(vendors: DataFrame, purchases: DataFrame) -> DataFrame:
    """Text counter, completed counter and last activity."""
    folded = purchases.groupBy("vendor_key").agg(
        F.count(F.lit(1)).alias("_n"), F.max("purchased_at").alias("_last")
    )
    return _updated(
        vendors,
        folded,
        vendors["SellerKey"] == F.col("vendor_key"),
        {
            "TotalTxns": (values.text_count(vendors["TotalTxns"]) + F.col("_n")).cast("string"),
            "CompletedTxns": vendors["CompletedTxns"] + F.col("_n"),
            "LastActiveDt": F.col("_last"),
        },
    )


def settle_payments(payments: DataFrame, settlements: DataFrame) -> DataFrame:
    """Settle payments; k settlements of one payment add their latency and count k retries."""
    folded = settlements.groupBy("payment_id").agg(
        F.count(F.lit(1)).cast("int").alias("_n"),
        F.max("settled_at").alias("_last"),
        F.sum("latency_ms").cast("int").alias("_latency"),
    )
    return _updated(
        payments,
        folded,
        payments["PPE_id"] == F.col("payment_id"),
        {
            "event_timestamp": F.col("_last"),
            "processing_stage": F.lit("settled"),
            "processing_time_ms": payments["processing_time_ms"] + F.col("_latency"),
            "retry_count": payments["retry_count"] + F.col("_n"),
        },
    )


def complete_transactions(transactions: DataFrame, completions: DataFrame) -> DataFrame:
    """Patch status and update time into the financials; of several completions the last counts."""
    folded = completions.groupBy("event_code").agg(
        F.count(F.lit(1)).alias("_n"), F.max("completed_at").alias("_last")
    )
    patch = documents.build(
        status=F.lit("completed"), updated_at=values.iso_instant(F.col("_last"))
    )
    return _updated(
        transactions,
        folded,
        transactions["EventCode"] == F.col("event_code"),
        {"transaction_financials": documents.merge(transactions["transaction_financials"], patch)},
    )


def recent_payments(transactions: DataFrame, payments: DataFrame, count: int = RECENT) -> DataFrame:
    """The newest transaction-payment pairs; ids break ties. A top-k, not a global sort."""
    return (
        transactions.select("EventCode", "EventTimestamp")
        .join(
            payments.select("PPE_id", "transaction_ref"),
            F.col("EventCode") == F.col("transaction_ref"),
        )
        .orderBy(F.desc("EventTimestamp"), "EventCode", "PPE_id")
        .limit(count)
        .select("EventCode", "PPE_id", "EventTimestamp")
    )
