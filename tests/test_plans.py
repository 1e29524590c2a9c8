"""Physical plans: what is read, what is shuffled, and what happens to a hot key."""

import re

import pytest
from pyspark.sql import functions as F

from harness.fixtures import Given
from harness.queries import QUERIES, history
from souklake.operators import checks, gold, silver, synth
from souklake.schemas import TABLES, Domain
from souklake.sources.tables import spread

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


@pytest.mark.parametrize("table", ["transactions", "PaymentProcessingEvents", "RiskModelPredictions"])
def test_synthesis_and_silver_do_not_shuffle(spark, table):
    history = synth.history_rows(synth.row_numbers(spark, 1, 1000), table)
    assert "Exchange" not in plan(history)
    assert "Exchange" not in plan(silver.silver_table(table, history, history))


def test_gold_reads_only_its_columns_and_filters_payments_at_the_scan(spark, tmp_path):
    domain = Domain(reference_rows=100)
    numbers = synth.row_numbers(spark, 1, 100)
    tables = {}
    for table in ("transactions", "risk_analytics", "PaymentProcessingEvents"):
        synth.history_rows(numbers, table, domain).write.parquet(f"{tmp_path}/{table}")
        tables[table] = spark.read.parquet(f"{tmp_path}/{table}")
    scored = gold.scored_transactions(*tables.values())
    text = plan(gold.daily_market_metrics(scored))
    assert "In(processing_stage, [declined,failed])" in text
    reads = [line.split("ReadSchema:")[1] for line in text.splitlines() if "ReadSchema:" in line]
    assert len(reads) == 3 and not any("authorization_code" in r or "RouteComplex" in r for r in reads)


def test_both_joins_share_one_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        given = Given(spark, SF_DIR)
        scored = gold.scored_transactions(given.transactions(), given.risk(), given.payments())
        text = plan(scored)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("hashpartitioning(EventCode") == 1


def test_hot_child_key_is_split_by_adaptive_execution(spark):
    """A third of the payments belong to one transaction."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        number = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000)
        micros = (F.col("id") * 7919) % 1_000_000
        moment = F.timestamp_add("MICROSECOND", micros, F.lit("2024-01-01").cast("timestamp_ntz"))
        payments = spark.range(0, 60_000, 1, 8).select(
            F.concat(F.lit("E"), number.cast("string")).alias("transaction_ref"), moment.alias("event_timestamp")
        )
        transactions = spark.range(0, 20_000, 1, 8).select(
            F.concat(F.lit("E"), F.col("id").cast("string")).alias("EventCode"),
            F.timestamp_add(
                "MICROSECOND", 500_000 + F.col("id") % 1000, F.lit("2024-01-01").cast("timestamp_ntz")
            ).alias("EventTimestamp"),
        )
        rule = checks.payment_order_rule(payments, transactions)
        text = final_plan(rule)
        keys = [7 if n % 3 == 0 else n % 20_000 for n in range(60_000)]
        expected = sum((n * 7919) % 1_000_000 < 500_000 + k % 1000 for n, k in enumerate(keys))
        assert rule.first()["violations"] == expected
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in text


def test_counts_come_from_footers(spark):
    from souklake.sources.tables import footer_counts

    text = plan(footer_counts(spark, {"orders": f"{SF_DIR}/orders.parquet"}))
    assert "PushedAggregation: [COUNT(*)]" in text


def test_relation_rules_shuffle_transactions_once(spark, tmp_path):
    domain, tables = Domain(vendors=3, buyers=5, reference_rows=20), {}
    for table in TABLES:
        rows = synth.row_numbers(spark, 1, {**domain.dimension_rows(), "transaction_products": 40}.get(table, 20))
        synth.history_rows(rows, table, domain).write.parquet(f"{tmp_path}/{table}")
        tables[table] = spark.read.parquet(f"{tmp_path}/{table}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rules = checks.relation_rules(tables)
        text = plan(rules)
        found = {r["rule"]: r["violations"] for r in rules.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows meet once; what the transactions refer to is folded per value before its exchange.
    assert text.count("hashpartitioning(EventCode") == 1 and text.count("hashpartitioning(ref") == 1
    assert len(found) == 13 and not any(found.values())


def related(spark):
    """Small tables with orphans, NULL keys, repeated parents and repeated children."""
    made = {
        "markets": ("PlatCode string", [("P1",), ("P1",), (None,)]),
        "vendors": ("SellerKey string", [("V1",), ("V2",)]),
        "buyers": ("AcqCode string", [("B1",), (None,)]),
        "products": ("ProdCat string, Subcategory string, ListingAge bigint, SellerPointer string", [("a", "b", 1, "V1"), ("a", "b", None, "V1")]),
        "transactions": (
            "EventCode string, PlatformKey string, VendorLink string, AcqLink string, EventTimestamp timestamp_ntz",
            [("E1", "P1", "V1", "B1", None), ("E1", "P1", "V3", "B1", None), ("E2", "P9", None, None, None), (None, None, "V2", "B9", None)],
        ),
        "transaction_products": (
            "EventLink string, ProdCat string, Subcategory string, ListingAge bigint, SellerPointer string",
            [("E1", "a", "b", 1, "V1"), ("E1", "a", "b", 2, "V1"), ("E2", "a", "b", None, "V1"), ("E9", "a", "b", 1, "V1"), (None, "a", "b", 1, "V1")],
        ),
        "BuyerSessionAnalytics": ("acq_ref string", [("B1",), ("B2",), ("B2",), (None,)]),
        "PaymentProcessingEvents": ("transaction_ref string, event_timestamp timestamp_ntz", [("E1", None), ("E8", None), (None, None)]),
        "risk_analytics": ("TxnLink string", [("E1",), ("E1",), ("E7",), (None,)]),
        "RiskModelPredictions": ("txn_link_ref string, prediction_timestamp timestamp_ntz", [("E7", None), ("E6", None), (None, None)]),
    }
    return {table: spark.createDataFrame(rows, schema) for table, (schema, rows) in made.items()}


def test_references_meet_their_parents_in_one_aggregate(spark):
    tables = related(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rules = checks.relation_rules(tables)
        text = plan(rules)
        found = {r["rule"]: r["violations"] for r in rules.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # No second shuffle and no sort of the keys; what meets the transactions is sorted by a number.
    assert len(re.findall(r"hashpartitioning\(parent#\d+, key", text)) == 1 and "LeftAnti" not in text
    assert "Sort [ref_hash" in text
    separate = [
        checks.item_vendor_rule(tables["transaction_products"], tables["transactions"]),
        checks.two_items_rule(tables["transaction_products"], tables["transactions"]),
        checks.payment_order_rule(tables["PaymentProcessingEvents"], tables["transactions"]),
        checks.prediction_order_rule(tables["RiskModelPredictions"], tables["transactions"]),
        checks.reference_rules(tables),
    ]
    assert found == {r["rule"]: r["violations"] for r in checks.union(separate).collect()}
    assert found["transactions.AcqLink -> buyers"] == 2 and found["RiskModelPredictions.txn_link_ref -> risk_analytics"] == 2


def test_relations_and_totals_build_each_table_once(spark):
    """Lines are read for items, products and payments, not again for every rule."""
    for name, most in (("check_relations", 2), ("check_references", 3), ("gold_reconcile", 7)):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert text.count("lineitem.parquet") <= most, name


def test_reconcile_reads_each_model_once(spark, tmp_path):
    tables = {}
    for table in TABLES:
        synth.history_rows(synth.row_numbers(spark, 1, 20), table, Domain(vendors=3, buyers=5, reference_rows=20)).write.parquet(f"{tmp_path}/{table}")
        tables[table] = spark.read.parquet(f"{tmp_path}/{table}")
    rules = checks.reconcile_rules(tables, gold.gold_models(tables))
    reads = [line for line in plan(rules).splitlines() if "FileScan" in line]
    # Seven tables and models are counted; the rules that compare them do not count them again.
    assert len(reads) <= 14
    assert len(rules.collect()) == 7


def test_keys_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(checks, "KEYS_PER_TASK", 100)
    keys = spark.range(900).selectExpr("if(id < 3, null, concat('k', id % 890)) AS EventCode")
    rules = checks.primary_key_rules({"transactions": keys}, {"transactions": 900})
    assert "hashpartitioning(EventCode" in plan(rules) and ", 9), REPARTITION_BY_NUM" in plan(rules)
    assert rules.first()["violations"] == 1 + 7 == checks.primary_key_rules({"transactions": keys}).first()["violations"]


def test_lines_are_folded_to_items_in_tasks_of_few(spark, monkeypatch):
    monkeypatch.setattr("harness.fixtures.ROWS_PER_FOLD", 1_000)
    given = Given(spark, SF_DIR)
    text = plan(given.items())
    assert f", {-(-given.rows('lineitem') // 1_000)}), REPARTITION_BY_NUM" in text
    assert text.count("hashpartitioning(l_orderkey") == 1
    assert plan(given.products()).count("REPARTITION_BY_NUM") == 1


def test_universe_rules_shuffle_no_key(spark):
    dimensions = {
        "vendors": spark.createDataFrame([("SELLER-000001",), ("SELLER-000001",), ("SELLER-000009",), ("SELLER-1",), (None,)], "SellerKey string"),
        "products": synth.history_rows(synth.row_numbers(spark, 1, 8), "products", Domain(vendors=2)).select("ProdCat", "Subcategory", "ListingAge", "SellerPointer"),
    }
    rules = checks.universe_rules(spark, dimensions, Domain(vendors=2))
    exchanges = [line for line in plan(rules).splitlines() if "hashpartitioning" in line]
    assert exchanges and all("hashpartitioning(page" in line for line in exchanges)
    found = {r["rule"]: r["violations"] for r in rules.collect()}
    assert found == {"vendors missing": 1, "vendors unexpected": 3, "products missing": 0, "products unexpected": 0}


def test_narrow_single_file_tables_are_dealt_to_tasks(spark, tmp_path):
    """The scan of a small file is one task; what is derived from its rows must not be."""
    keys = spark.range(100_000).selectExpr("id AS o_orderkey")
    keys.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    events = spark.range(60_000).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "timestamp_ntz'2024-01-01 05:00:00' AS ts", "'click' AS event_type", "1.5D AS value"
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    given = Given(spark, str(tmp_path))
    for frame, rows in ((history(given, "risk_analytics"), 100_000), (given.sessions(), 60_000), (given.changes(), 60_000)):
        assert frame.rdd.getNumPartitions() >= 6
        assert frame.count() == rows
    assert history(given, "risk_analytics").select("TxnLink").distinct().count() == 100_000


def test_spread_leaves_tiny_tables_alone(spark):
    frame = spark.range(0, 25, 1, 1)
    assert spread(frame, 25) is frame
