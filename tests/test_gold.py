"""Gold semantics on edge cases, against the joins written out in SQL."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from souklake.operators import gold

T0 = dt.datetime(2024, 5, 1, 10)


@pytest.fixture(scope="module")
def tables(spark):
    """A third of the transactions on one vendor, buyer and day; repeated risk rows; NULLs."""
    def txn(n):
        hot = n % 3 == 0
        return (
            f"E{n}",
            T0 + dt.timedelta(days=0 if hot else n % 5),
            None if n % 17 == 0 else f"P{0 if hot else n % 4}",
            None if n % 13 == 0 else ("V0" if hot else f"V{n % 7}"),
            "B0" if hot else f"B{n % 11}",
            None if n % 5 == 0 else n % 2,
            '{"amount":"n/a"}' if n % 7 == 0 else ("{oops" if n % 19 == 0 else f'{{"amount":{n}.25}}'),
        )

    transactions = spark.createDataFrame(
        [txn(n) for n in range(300)],
        "EventCode string, EventTimestamp timestamp_ntz, PlatformKey string, VendorLink string, "
        "AcqLink string, CrossBorder bigint, transaction_financials string",
    )
    links = [f"E{n}" for n in range(0, 300, 2)] + ["E0"] * 150 + ["E4", "missing", None]
    risk = spark.createDataFrame(
        [(e, None if i % 9 == 0 else (i % 10) / 10, ("high", "low", None)[i % 3]) for i, e in enumerate(links)],
        "TxnLink string, FraudProb float, ML_Risk string",
    )
    payments = spark.createDataFrame(
        [(f"E{n % 90}", ("declined", "failed", "settled", None)[n % 4]) for n in range(400)] + [("E0", "failed")] * 200,
        "transaction_ref string, processing_stage string",
    )
    vendors = spark.createDataFrame([(f"V{n}",) for n in range(9)], "SellerKey string")
    return {"transactions": transactions, "risk": risk, "payments": payments, "vendors": vendors}


@pytest.fixture(scope="module")
def db(tables):
    db = duckdb.connect()
    for name, frame in tables.items():
        db.register(f"t_{name}", frame.toArrow())
    db.execute("""
        CREATE VIEW txn AS SELECT *, CASE WHEN json_valid(transaction_financials)
            THEN try_cast(json_extract_string(transaction_financials, '$.amount') AS double) END AS amount
        FROM t_transactions""")
    return db


def same(frame, db, sql):
    expected = db.sql(sql).to_arrow_table().to_pylist()
    actual = frame.toArrow().to_pylist()

    def order(rows):
        return sorted(tuple(sorted((k, repr(v)) for k, v in row.items())) for row in rows)

    assert order(actual) == order(expected)


def test_daily_market_metrics(tables, db):
    scored = gold.scored_transactions(tables["transactions"], tables["risk"], tables["payments"])
    model = gold.daily_market_metrics(scored).withColumn(
        "gross_merchandise_value", F.round("gross_merchandise_value", 2)
    )
    same(model, db, """
        SELECT "EventTimestamp"::date AS metric_date, "PlatformKey" AS platform_key,
               count(*) AS transaction_count, count(DISTINCT "AcqLink") AS unique_buyers,
               count(DISTINCT "VendorLink") AS unique_vendors, round(sum(amount), 2) AS gross_merchandise_value,
               sum("CrossBorder")::bigint AS cross_border_transactions,
               count(*) FILTER ("ML_Risk" = 'high') AS high_risk_transactions,
               coalesce(sum(bad), 0)::bigint AS payment_failed_events
        FROM txn LEFT JOIN t_risk ON "TxnLink" = "EventCode"
        LEFT JOIN (SELECT transaction_ref, count(*) FILTER (processing_stage IN ('declined', 'failed')) AS bad
                   FROM t_payments GROUP BY 1) ON transaction_ref = "EventCode"
        GROUP BY 1, 2""")


def test_vendor_risk_summary(tables, db):
    scored = gold.scored_transactions(tables["transactions"], tables["risk"])
    model = gold.vendor_risk_summary(tables["vendors"], scored).withColumns(
        {
            "gross_merchandise_value": F.round("gross_merchandise_value", 2),
            "average_fraud_probability": F.round("average_fraud_probability", 6),
        }
    )
    same(model, db, """
        SELECT "SellerKey" AS seller_key, count("EventCode") AS transaction_count,
               count(DISTINCT "AcqLink") AS unique_buyers,
               round(coalesce(sum(amount), 0), 2) AS gross_merchandise_value,
               count(*) FILTER ("ML_Risk" = 'high') AS high_risk_transactions,
               round(avg("FraudProb"::double), 6) AS average_fraud_probability,
               max("EventTimestamp") AS last_transaction_at
        FROM t_vendors LEFT JOIN txn ON "VendorLink" = "SellerKey"
        LEFT JOIN t_risk ON "TxnLink" = "EventCode" GROUP BY 1""")


def test_buyer_without_activity(spark, tables):
    buyers = spark.createDataFrame([("B0", "mfa", "{}"), ("B99", "none", None)], "AcqCode string, AuthLevel string, buyer_risk_profile string")
    sessions = spark.createDataFrame(
        [("B0", None, 10), ("B0", True, 20), ("B0", False, None)],
        "acq_ref string, checkout_completed boolean, session_duration_seconds int",
    )
    rows = {r["buyer_key"]: r for r in gold.buyer_360(buyers, gold.purchases(tables["transactions"]), sessions).collect()}
    idle, busy = rows["B99"], rows["B0"]
    assert (idle["transaction_count"], idle["session_count"], idle["completed_checkouts"], idle["lifetime_value"]) == (0, 0, 0, 0.0)
    assert idle["average_session_seconds"] is None and idle["last_purchase_at"] is None
    assert (busy["session_count"], busy["completed_checkouts"], busy["average_session_seconds"]) == (3, 1, 15.0)


def test_product_without_sales_and_single_precision(spark):
    products = spark.createDataFrame(
        [("C", "S", 1, "V", "{}"), ("C", "S", 2, "V", None)],
        "ProdCat string, Subcategory string, ListingAge bigint, SellerPointer string, product_availability string",
    )
    items = spark.createDataFrame(
        [("E1", "C", "S", 1, "V", 0.1, 3), ("E2", "C", "S", 1, "V", 0.2, 7), ("E3", None, "S", 1, "V", 9.0, 1)],
        "EventLink string, ProdCat string, Subcategory string, ListingAge bigint, SellerPointer string, PriceAmt float, QtySold bigint",
    )
    rows = {r["listing_age"]: r for r in gold.product_performance(products, items).collect()}
    expected = duckdb.sql("SELECT sum((p * q)::double) FROM (VALUES (0.1::real, 3::real), (0.2::real, 7::real)) t(p, q)").to_arrow_table().to_pylist()[0]
    assert (rows[1]["transaction_count"], rows[1]["units_sold"]) == (2, 10)
    assert rows[1]["gross_revenue"] == pytest.approx(next(iter(expected.values())))
    assert (rows[2]["transaction_count"], rows[2]["units_sold"], rows[2]["gross_revenue"]) == (0, 0, 0.0)
