"""History, batch, publish and validation as whole jobs on small synthesised data."""

import glob
import json
import math
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from souklake.functions import values
from souklake.operators import checks, synth
from souklake.plans import batch, history, publish, validate
from souklake.schemas import DIMENSIONS, FACTS, GOLD_SCHEMAS, SCHEMAS, TABLES, Domain
from souklake.sources import bronze
from souklake.sources.snapshot import exported_footers, exported_schemas, exported_snapshot, jdbc_buckets, quoting
from souklake.sources.tables import file_footers, read_table, write_packed, write_table

DOMAIN = Domain(markets=10, vendors=40, buyers=150, reference_rows=400)
BUDGET = 1_500_000


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze"))
    history.build_history(spark, path, BUDGET, DOMAIN, probe_rows=2_000)
    return path


@pytest.fixture(scope="module")
def snapshot(spark):
    def read(table):
        if table in DIMENSIONS:
            numbers = synth.row_numbers(spark, 1, DOMAIN.dimension_rows()[table])
            return synth.seed_rows(numbers, table, values.timestamp("2025-06-01"), DOMAIN)
        return spark.createDataFrame([], SCHEMAS[table])

    return read


def counts(snapshot):
    return checks.union(
        [snapshot(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows") for t in TABLES]
    )


def broken(rules):
    return {r["rule"]: r["violations"] for r in rules.collect() if r["violations"]}


def test_history_keeps_every_rule(spark, root):
    assert broken(validate.history_rules(spark, root, DOMAIN)) == {}


def test_history_goes_on_where_it_stopped(spark, root, tmp_path):
    path = str(tmp_path)
    history.build_history(spark, path, BUDGET // 3, DOMAIN, probe_rows=2_000)
    first = {r["table"]: r["next_row"] for r in bronze.progress(bronze.read_ledger(spark, path)).collect()}
    history.build_history(spark, path, BUDGET // 2, DOMAIN, probe_rows=2_000)
    second = {r["table"]: r["next_row"] for r in bronze.progress(bronze.read_ledger(spark, path)).collect()}
    assert all(second[t] > first[t] for t in FACTS) and all(second[t] == first[t] for t in DIMENSIONS)
    ids = bronze.read_bronze(spark, path, "transactions").select("EventCode")
    assert ids.count() == ids.distinct().count() == second["transactions"] - 1


def test_an_unrecorded_segment_is_written_again(spark, tmp_path):
    path = str(tmp_path)
    synth_rows = synth.history_rows(synth.row_numbers(spark, 1, 50), "buyers", DOMAIN)
    write_table(synth_rows, bronze.segment_path(path, "buyers", 1))  # lost before the ledger entry
    history.write_rows(spark, path, "buyers", 1, 150, 60.0, DOMAIN)
    assert bronze.read_bronze(spark, path, "buyers").count() == 150


def test_rules_find_damage(spark, root):
    items = bronze.read_bronze(spark, root, "transaction_products")
    transactions = bronze.read_bronze(spark, root, "transactions")
    first = F.col("EventLink") == "EVT-HIST-00000000000001"
    dearer = items.withColumn("PriceAmt", F.when(first, F.col("PriceAmt") + 1).otherwise(F.col("PriceAmt")))
    assert broken(checks.history_item_rules(dearer, DOMAIN)) == {"item price": 2}
    assert broken(checks.two_items_rule(items.where(~first), transactions)) == {"two items": 1}
    moved = items.withColumn("SellerPointer", F.when(first, F.lit("SELLER-000099")).otherwise(F.col("SellerPointer")))
    assert broken(checks.item_vendor_rule(moved, transactions)) == {"item vendor": 2}
    newline = transactions.select(F.concat("EventCode", F.lit("\n")).alias("EventCode"))
    rules = checks.format_rules({"transactions": newline}, ("history",))
    assert broken(rules) == {"transactions id format": transactions.count()}
    orphan = transactions.withColumn("VendorLink", F.when(F.col("EventCode") == "EVT-HIST-00000000000001", F.lit(None)).otherwise(F.col("VendorLink")))
    frames = {"transactions": orphan, "vendors": bronze.read_bronze(spark, root, "vendors")}
    assert broken(checks.reference_rules(frames)) == {"transactions.VendorLink -> vendors": 1}


def test_batch_publishes_both_layers(spark, root, snapshot, tmp_path):
    lake = str(tmp_path)
    audit = batch.run_batch(spark, root, snapshot, lake)
    assert broken(validate.batch_rules(spark, lake, root, counts(snapshot))) == {}
    assert publish.register_views(spark, lake) == audit["batch_id"]
    assert spark.table("silver_transactions").count() == audit["silver_rows"]["transactions"]
    stored = spark.read.text(f"{lake}/_audits").first()["value"]
    assert json.loads(stored) == audit
    # History is read where it is: the batch holds no copy of it.
    assert not glob.glob(f"{lake}/batches/*/silver/transactions/history")


def test_failed_batch_changes_nothing(spark, root, snapshot, tmp_path, monkeypatch):
    lake = str(tmp_path)
    good = batch.run_batch(spark, root, snapshot, lake)["batch_id"]
    monkeypatch.setattr(batch.gold, "product_performance", lambda *_: spark.createDataFrame([], "x int"))
    with pytest.raises(Exception):
        batch.run_batch(spark, root, snapshot, lake)
    assert publish.current_batch(spark, lake) == good
    assert publish.batches(spark, lake) == [good]


def test_wrong_manifest_stops_the_batch(spark, root, snapshot, tmp_path, monkeypatch):
    real = bronze.manifest_rows
    monkeypatch.setattr(batch.bronze, "manifest_rows", lambda m: real(m).withColumn("rows", F.col("rows") + 1))
    with pytest.raises(batch.GateError, match="silver transactions"):
        batch.run_batch(spark, root, snapshot, str(tmp_path))
    assert publish.current_batch(spark, str(tmp_path)) is None


def test_second_batch_replaces_the_first(spark, root, snapshot, tmp_path):
    lake = str(tmp_path)
    first = batch.run_batch(spark, root, snapshot, lake)["batch_id"]
    second = batch.run_batch(spark, root, snapshot, lake)["batch_id"]
    assert publish.current_batch(spark, lake) == second
    with pytest.raises(ValueError):
        publish.discard(spark, lake, second)
    assert publish.discard_replaced(spark, lake) == [first]
    assert publish.read_layer(spark, lake, "silver")["vendors"].count() == DOMAIN.vendors


def test_parsed_history_json_is_rewritten(spark, tmp_path):
    rows = synth.history_rows(synth.row_numbers(spark, 1, 20), "risk_analytics", DOMAIN)
    parsed = rows.withColumn("wallet_risk_assessment", F.from_json("wallet_risk_assessment", "wallet_hash string, age_days bigint"))
    parsed.write.parquet(bronze.segment_path(str(tmp_path), "risk_analytics", 1))
    bronze.record_segment(spark, str(tmp_path), "risk_analytics", 1, 20)
    paths = batch.history_paths(spark, str(tmp_path), "risk_analytics", f"{tmp_path}/stage", bronze.read_ledger(spark, str(tmp_path)))
    assert paths == [f"{tmp_path}/stage/history"]
    stored = read_table(spark, SCHEMAS["risk_analytics"], paths)
    assert stored.exceptAll(rows).count() == 0 and stored.count() == 20


def test_missing_bronze_table_stops_the_batch(spark, root, tmp_path):
    path = str(tmp_path)
    write_table(bronze.read_bronze(spark, root, "vendors"), bronze.segment_path(path, "vendors", 1))
    with pytest.raises(ValueError, match="bronze tables differ"):
        bronze.require_tables(bronze.bronze_files(spark, path))


def test_manifest_rules_find_foreign_bytes(spark, tmp_path):
    path = str(tmp_path)
    history.build_history(spark, path, BUDGET // 3, DOMAIN, probe_rows=2_000)
    assert broken(validate.manifest_rules(spark, path)) == {}
    bronze.read_bronze(spark, path, "buyers").write.parquet(f"{path}/buyers/from-extra")
    assert "manifest bytes" in broken(validate.manifest_rules(spark, path))


def test_complete_history_stays_as_it_is(spark, root):
    before = sorted(bronze.read_ledger(spark, root).collect())
    history.build_history(spark, root, BUDGET, DOMAIN, probe_rows=2_000)
    assert sorted(bronze.read_ledger(spark, root).collect()) == before
    assert broken(validate.manifest_rules(spark, root)) == {}


def test_snapshot_query_is_quoted_and_partitioned(spark):
    quote = quoting(spark, "jdbc:postgresql://host/db")
    assert quote("BuyerSessionAnalytics") == '"BuyerSessionAnalytics"'
    assert jdbc_buckets("vendors", 2, quote) == [
        '(hashtext("SellerKey") & 2147483647) % 2 = 0',
        '(hashtext("SellerKey") & 2147483647) % 2 = 1',
    ]


def test_segments_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "SEGMENT_FILES", 2)
    history.write_rows(spark, str(tmp_path), "buyers", 1, 5_000, 50.0, DOMAIN, file_bytes=30_000)
    ledger = bronze.read_ledger(spark, str(tmp_path))
    assert bronze.progress(ledger).first()["rows"] == 5_000 and ledger.count() > 1
    assert bronze.read_bronze(spark, str(tmp_path), "buyers").select("AcqCode").distinct().count() == 5_000


def test_files_follow_the_target_size(spark, tmp_path):
    widths = history.measured_widths(spark, str(tmp_path), DOMAIN, 2_000)
    width = widths.where("table = 'transactions'").first()["bytes_per_row"]
    history.write_rows(spark, str(tmp_path), "transactions", 1, int(700_000 / width), width, DOMAIN, file_bytes=100_000)
    done = bronze.progress(bronze.read_ledger(spark, str(tmp_path))).first()
    files = glob.glob(f"{tmp_path}/transactions/*/*.parquet")
    assert done["bytes"] >= 600_000 and len(files) >= 6
    assert max(os.path.getsize(f) for f in files) < 130_000


def without_column(path, column):
    """Rewrite one stored file without one of its columns."""
    table = pq.ParquetFile(path).read()
    os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    pq.write_table(table.drop_columns([column]).replace_schema_metadata(None), path)  # Spark keeps the schema there too


def one_file(folder):
    return sorted(glob.glob(f"{folder}/**/*.parquet", recursive=True))[-1]


def test_one_file_without_a_column_breaks_the_rules_of_every_layer(spark, snapshot, tmp_path):
    bronze_root, lake, exported = (str(tmp_path / name) for name in ("bronze", "lake", "snapshot"))
    history.build_history(spark, bronze_root, BUDGET // 3, DOMAIN, probe_rows=2_000)
    batch.run_batch(spark, bronze_root, snapshot, lake)
    for table in TABLES:
        write_table(snapshot(table).repartition(2), f"{exported}/{table}")

    def setup():
        read = {table: exported_snapshot(spark, exported, table) for table in TABLES}
        return broken(validate.setup_rules(spark, read, DOMAIN, exported_schemas(spark, exported), exported_footers(spark, exported)))

    assert setup() == {} and broken(validate.gold_rules(spark, lake)) == {}
    without_column(one_file(f"{exported}/vendors"), "SellerKey")
    assert setup()["vendors files"] == 1
    for left in glob.glob(f"{exported}/vendors/*.parquet"):  # the column gone in every file
        if "SellerKey" in pq.ParquetFile(left).schema_arrow.names:
            without_column(left, "SellerKey")
    assert setup()["vendors columns"] == 1
    without_column(one_file(f"{lake}/batches/*/gold/buyer_360"), GOLD_SCHEMAS["buyer_360"].names[-1])
    assert broken(validate.gold_rules(spark, lake))["buyer_360 files"] == 1
    without_column(one_file(f"{lake}/batches/*/silver/vendors"), "SellerKey")
    damaged = broken(validate.silver_rules(spark, lake, counts(snapshot), bronze.read_manifest(spark, bronze_root)))
    assert damaged["vendors files"] == 1
    without_column(one_file(f"{bronze_root}/transactions"), "VendorLink")
    assert broken(validate.history_rules(spark, bronze_root, DOMAIN))["transactions files"] == 1
    with pytest.raises(batch.GateError, match="1 files of transactions.*VendorLink"):
        batch.run_batch(spark, bronze_root, snapshot, lake)


def test_footers_name_columns_and_rows_of_each_file(spark, tmp_path):
    path = f"{tmp_path}/a folder"
    spark.range(10).repartition(2).write.parquet(f"{path}/one")
    spark.range(5).select("id", F.lit(1).alias("more")).coalesce(1).write.parquet(f"{path}/two")
    found = file_footers(spark, [f"{path}/one", f"{path}/two"]).collect()
    assert sorted((r.columns, r.rows) for r in found if r.rows)[-1] == (["id", "more"], 5)
    assert sum(r.rows for r in found) == 15 and len({r.path for r in found}) == len(found)


def test_stored_files_have_about_the_target_size(spark, tmp_path):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    target = 400_000
    for name, tasks in (("small", 64), ("large", 1)):
        count, path = write_packed(rows.repartition(tasks), f"{tmp_path}/{name}", ["id"], target=target)
        sizes = [os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet")]
        assert count == 60_000 and path.endswith("packed") and not os.path.exists(f"{tmp_path}/{name}/parts")
        if name == "small":  # packed; one row group cannot be cut by the scan, only by its records
            assert len(sizes) <= 2 * math.ceil(sum(sizes) / target)
        assert max(sizes) < 1.6 * target
        stored = read_table(spark, rows.schema, path)
        assert stored.exceptAll(rows).count() == 0 and stored.count() == 60_000
        for file in glob.glob(f"{path}/*.parquet"):
            ids = pq.read_table(file, columns=["id"]).column("id").to_pylist()
            assert ids == sorted(ids)
    assert write_packed(rows.repartition(2), f"{tmp_path}/fits", target=1 << 27)[1].endswith("parts")
    assert write_packed(rows.limit(0), f"{tmp_path}/empty", target=target)[0] == 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(target)
