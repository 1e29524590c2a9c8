"""Mutations, and the property that replaying their change feed gives the mutated tables."""

import pytest
from pyspark.sql import functions as F

from harness.fixtures import Given
from souklake.functions import values
from souklake.operators import changes, mutations, synth
from souklake.schemas import PRIMARY_KEYS, SCHEMAS, Domain

SF_DIR = "/root/testdata/sf0.001"
DOMAIN = Domain(vendors=60, buyers=200)


@pytest.fixture(scope="module")
def purchases(spark):
    return Given(spark, SF_DIR).purchases().cache()


def dimension(spark, table):
    numbers = synth.row_numbers(spark, 1, DOMAIN.dimension_rows()[table])
    return synth.seed_rows(numbers, table, values.timestamp("2020-01-01"), DOMAIN)


def as_changes(frame, action, base):
    """Rows as raw changes, with log positions from `base` on."""
    fields = [
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).cast("string").alias("value"))
        for f in frame.schema
    ]
    return frame, fields, action, base


def feed_of(frame, table, action, base):
    frame, fields, action, base = as_changes(frame, action, base)
    image = "identity" if action == "D" else "columns"
    raw = F.to_json(
        F.struct(F.lit(action).alias("action"), F.lit("public").alias("schema"), F.lit(table).alias("table"), F.array(*fields).alias(image))
    )
    return frame.select(
        F.concat(F.lit("0/"), F.hex(F.monotonically_increasing_id() % 2**30 + F.lit(base))).alias("lsn"),
        F.lit("1").alias("xid"),
        raw.alias("raw"),
    )


def equal(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def replay(feeds, table):
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed)
    envelopes = changes.envelope(union.unionByName(feeds[0]), "db", F.lit("2024-01-01").cast("timestamp_ntz"))
    only = changes.deduplicate(envelopes).where(F.col("table") == table)
    return changes.current_rows(only, SCHEMAS[table], PRIMARY_KEYS[table])


@pytest.mark.parametrize("table", ["buyers", "vendors"])
def test_replay_of_updates_equals_the_updated_dimension(spark, purchases, table):
    before = dimension(spark, table)
    update = {"buyers": mutations.count_buyer_purchases, "vendors": mutations.count_vendor_sales}[table]
    after = update(before, purchases)
    assert not equal(before, after)
    feeds = [feed_of(before, table, "I", 1), feed_of(after, table, "U", 2**31)]
    assert equal(replay(feeds, table), after)


@pytest.mark.parametrize("table", ["transactions", "transaction_products", "PaymentProcessingEvents", "risk_analytics"])
def test_replay_of_inserts_equals_the_fan_out(spark, purchases, table):
    rows = {
        "transactions": mutations.purchase_transactions,
        "transaction_products": lambda p: mutations.purchase_items(p, dimension(spark, "products")),
        "PaymentProcessingEvents": mutations.purchase_payments,
        "risk_analytics": mutations.purchase_risk,
    }[table](purchases)
    assert rows.schema.names == SCHEMAS[table].names
    assert equal(replay([feed_of(rows, table, "I", 1)], table), rows)


def test_seven_changes_per_purchase(spark, purchases):
    fan_out = mutations.purchase_changes(purchases)
    assert fan_out.count() == mutations.CHANGES_PER_PURCHASE * purchases.count()


def test_missing_products_fail(spark, purchases):
    few = dimension(spark, "products").where("ListingAge = 0")
    with pytest.raises(Exception, match="fewer than two products"):
        mutations.purchase_items(purchases, few).count()


def test_insert_if_absent_takes_one_of_repeated_rows(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", 2), ("b", 3), ("b", 3)], "k string, v int")
    rows = sorted(tuple(r) for r in mutations.insert_if_absent(target, incoming, ("k",)).collect())
    assert rows == [("a", 1), ("b", 3)]


def test_text_counter(spark):
    vendors = spark.createDataFrame(
        [("V1", "", 1), ("V2", None, 2), ("V3", "41", 3), ("V4", "7", 4)], "SellerKey string, TotalTxns string, CompletedTxns bigint"
    ).withColumn("LastActiveDt", values.timestamp("2020-01-01"))
    sold = spark.createDataFrame([("V1",)] * 1000 + [("V2",), ("V3",)], "vendor_key string").withColumn("purchased_at", values.timestamp("2024-02-02"))
    rows = {r["SellerKey"]: r for r in mutations.count_vendor_sales(vendors, sold).collect()}
    assert [rows[k]["TotalTxns"] for k in ("V1", "V2", "V3", "V4")] == ["1000", "1", "42", "7"]
    assert [rows[k]["CompletedTxns"] for k in ("V1", "V2", "V3", "V4")] == [1001, 3, 4, 4]
    assert rows["V1"]["LastActiveDt"].year == 2024 and rows["V4"]["LastActiveDt"].year == 2020


def test_repeated_settlements_fold(spark):
    payments = spark.createDataFrame(
        [("P1", "authorized", 0, 100), ("P2", "authorized", 1, 50)],
        "PPE_id string, processing_stage string, retry_count int, processing_time_ms int",
    ).withColumn("event_timestamp", values.timestamp("2024-01-01"))
    settled = spark.createDataFrame([("P1", 10, 2), ("P1", 20, 5), ("P1", 30, 3)], "payment_id string, latency_ms int, day int").select(
        "payment_id", "latency_ms", F.make_timestamp_ntz(F.lit(2024), F.lit(3), "day", F.lit(0), F.lit(0), F.lit(0)).alias("settled_at")
    )
    rows = {r["PPE_id"]: r for r in mutations.settle_payments(payments, settled).collect()}
    assert (rows["P1"]["processing_stage"], rows["P1"]["retry_count"], rows["P1"]["processing_time_ms"]) == ("settled", 3, 160)
    assert rows["P1"]["event_timestamp"].day == 5
    assert (rows["P2"]["processing_stage"], rows["P2"]["retry_count"]) == ("authorized", 1)


def test_sessions_keep_their_limits(spark):
    rows = mutations.session_rows(Given(spark, SF_DIR).visits())
    broken = rows.where(
        "products_viewed_count > pages_viewed_count or cart_additions_count > products_viewed_count "
        "or (checkout_completed and not checkout_initiated) or cart_removals_count < 0"
    )
    assert broken.count() == 0 and rows.where("checkout_completed").count() > 0
