import glob
import os

import pytest
from pyspark.sql import functions as F

from harness.fixtures import Given
from souklake.operators import changes, checks
from souklake.plans import validate
from souklake.sources.landing import batch_tags, broken_lines, read_landing, read_landing_lines, write_landing
from souklake.streaming.landing import distinct_events, drain, land, stop_when_idle

SF_DIR = "/root/testdata/sf0.001"
FEED = "lsn string, xid string, raw string"


@pytest.fixture(scope="module")
def feed(spark):
    return Given(spark, SF_DIR).changes().select("lsn", "xid", "raw").cache()


def stream(spark, folder, files=1):
    return spark.readStream.schema(FEED).option("maxFilesPerTrigger", str(files)).parquet(folder)


def test_drain_in_several_batches_and_go_on(spark, feed, tmp_path):
    source, zone, checkpoint = f"{tmp_path}/in", f"{tmp_path}/zone", f"{tmp_path}/cp"
    feed.where("lsn < '0/2'").repartition(3).write.parquet(source)
    first = drain(stream(spark, source), zone, checkpoint, "db")
    assert first == feed.where("lsn < '0/2'").count()
    assert drain(stream(spark, source), zone, checkpoint, "db") == 0
    feed.where("lsn >= '0/2'").repartition(2).write.mode("append").parquet(source)
    drain(stream(spark, source), zone, checkpoint, "db")
    landed = read_landing(spark, zone)
    assert landed.count() == feed.count()
    assert landed.select("batch").distinct().count() == 5
    expected = changes.envelope(feed, "db").select("event_id", "change", "table")
    assert expected.exceptAll(landed.select("event_id", "change", "table")).count() == 0


def test_retry_leaves_no_copy(spark, feed, tmp_path):
    """A sink that fails after storing a batch: the batch is stored again under its number."""
    source, zone, checkpoint = f"{tmp_path}/in", f"{tmp_path}/zone", f"{tmp_path}/cp"
    feed.repartition(2).write.parquet(source)
    failures = []

    def store_then_fail(batch, number):
        write_landing(batch, zone, f"feed-{number}")
        if number == 1 and not failures:
            failures.append(number)
            raise RuntimeError("lost after the write")

    def start():
        enveloped = changes.envelope(stream(spark, source), "db")
        return enveloped.writeStream.foreachBatch(store_then_fail).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    with pytest.raises(Exception, match="lost after the write"):
        start().awaitTermination()
    start().awaitTermination()
    landed = read_landing(spark, zone)
    assert failures and landed.count() == feed.count()
    # The ingest time of a batch is part of its offsets, so a retry keeps its folder as well.
    assert landed.groupBy("batch").agg(F.count_distinct("ingested_at").alias("n")).where("n > 1").count() == 0


def test_follow_stops_when_idle(spark, feed, tmp_path):
    feed.repartition(1).write.parquet(f"{tmp_path}/in")
    query = land(stream(spark, f"{tmp_path}/in"), f"{tmp_path}/zone", f"{tmp_path}/cp", "db", follow=True, poll="200 milliseconds")
    stop_when_idle(query, 8)
    assert not query.isActive and read_landing(spark, f"{tmp_path}/zone").count() == feed.count()


def test_stream_deduplication_across_batches(spark, feed, tmp_path):
    zone = f"{tmp_path}/zone"
    moment = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    enveloped = changes.envelope(feed, "db", moment)
    for number in range(3):
        write_landing(enveloped, zone, f"delivery-{number}")
    query = distinct_events(spark, zone, "1 hour", files_per_batch=4).select("event_id", "table")
    query.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out")
    distinct = enveloped.select("event_id").distinct().count()
    assert rows.count() == distinct == rows.select("event_id").distinct().count()
    assert changes.deduplicate(read_landing(spark, zone)).count() == distinct


def test_stream_deduplication_keeps_late_first_deliveries(spark, tmp_path):
    """Four events of four hours, read one file a batch, the newest hour first; one is delivered twice."""
    zone = f"{tmp_path}/zone"
    for number, (lsn, hour) in enumerate([("0/4", "20"), ("0/1", "01"), ("0/3", "12"), ("0/2", "05"), ("0/4", "20")]):
        one = spark.createDataFrame([(lsn, "1", '{"table":"buyers"}')], FEED)
        moment = F.lit(f"2024-01-01 {hour}:00:00").cast("timestamp_ntz")
        write_landing(changes.envelope(one, "db", moment), zone, f"b{number}")
    for number, path in enumerate(sorted(glob.glob(f"{zone}/*/*/*/*/*.gz"), key=lambda p: p.split("batch=")[1])):
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    query = distinct_events(spark, zone, "1 hour", files_per_batch=1).select("event_id")
    query.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert rows.count() == 4 == rows.distinct().count()


def test_changes_with_line_ends_and_json_strings_survive(spark, tmp_path):
    texts = ['{"table":\n"buyers","n":1}', '"just text"', "[1,\r\n2]"]
    odd = spark.createDataFrame([(f"0/{n}", "1", text) for n, text in enumerate(texts)], FEED)
    write_landing(changes.envelope(odd, "db"), f"{tmp_path}/zone", "b")
    assert {r["change"] for r in read_landing(spark, f"{tmp_path}/zone").collect()} == set(texts)


def test_landing_layout_and_rules(spark, feed, tmp_path):
    zone = f"{tmp_path}/zone"
    moment = F.lit("2024-03-05 07:30:00").cast("timestamp_ntz")
    routed = changes.envelope(feed, "db", moment).where("table != '_metadata'")
    write_landing(routed, zone, "b1")
    assert glob.glob(f"{zone}/table=buyers/ingest_date=2024-03-05/hour=07/batch=b1/*.gz")
    found = {r["rule"]: r["violations"] for r in validate.landing_rules(spark, zone).collect()}
    assert set(found.values()) == {0}
    lines = read_landing_lines(spark, zone)
    damaged = lines.withColumn("value", F.regexp_replace("value", '"event_id":"[0-9a-f]', '"event_id":"X'))
    rules = {r["rule"]: r["violations"] for r in checks.envelope_rules(damaged).collect()}
    assert rules["event id"] == lines.count() and rules["envelope keys"] == 0


def test_change_that_is_not_json_is_kept(spark, tmp_path):
    odd = spark.createDataFrame([("0/1", "1", 'no "json"'), ("0/2", "1", '{"table":"buyers","n":12.50}')], FEED)
    write_landing(changes.envelope(odd, "db"), f"{tmp_path}/zone", "b")
    texts = {r["change"] for r in read_landing(spark, f"{tmp_path}/zone").collect()}
    assert texts == {'no "json"', '{"table":"buyers","n":12.50}'}


def test_hot_table_is_split_into_files(spark, tmp_path):
    """A table with most of a batch is written by several tasks when its bytes ask for it."""
    rows = spark.range(20_000).select(
        F.concat(F.lit("0/"), F.hex("id")).alias("lsn"),
        F.lit("1").alias("xid"),
        F.concat(F.lit('{"table":"buyers","pad":"'), F.sha2(F.col("id").cast("string"), 512), F.lit('"}')).alias("raw"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_landing(changes.envelope(rows.repartition(8), "db", F.lit("2024-01-01").cast("timestamp_ntz")), f"{tmp_path}/zone", "b")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = glob.glob(f"{tmp_path}/zone/table=buyers/**/*.gz", recursive=True)
    assert len(files) > 1 and all(os.path.getsize(f) > 0 for f in files)
    assert read_landing(spark, f"{tmp_path}/zone").count() == 20_000


def test_broken_lines_are_kept_and_the_rest_is_read(spark, feed, tmp_path):
    """A line cut short, one of other bytes, a JSON line without an event and an empty object."""
    zone = f"{tmp_path}/zone"
    write_landing(changes.envelope(feed.limit(5), "db"), zone, "b")
    folder = glob.glob(f"{zone}/table=*/ingest_date=*/hour=*/batch=b")[0]
    with open(f"{folder}/more.txt", "wb") as out:
        out.write(b'{"schema_version":1,"event_id":"ab\n\xff\xfe\x00\x80{\n{"other": 1}\n{}\n')
    assert read_landing(spark, zone).count() == 5
    assert read_landing(spark, zone).where("event_id IS NULL").count() == 0
    broken = broken_lines(spark, zone)
    assert broken.count() == 4 and broken.select("batch").distinct().count() == 1
    rules = {r["rule"]: r["violations"] for r in validate.landing_rules(spark, zone).collect()}
    assert rules["broken line"] == 4 and rules["batch tags"] == 0
    os.remove(f"{zone}/_batches/b.json")
    assert {r["rule"]: r["violations"] for r in validate.tag_rule(spark, zone).collect()} == {"batch tags": 1}


def test_an_empty_batch_leaves_empty_tags(spark, feed, tmp_path):
    zone = f"{tmp_path}/zone"
    assert write_landing(changes.envelope(feed.where("length(lsn) > 99"), "db"), zone, "none") == 0
    assert write_landing(changes.envelope(feed.limit(3), "db"), zone, "some") == 3
    assert {r["batch"] for r in batch_tags(spark, zone).collect()} == {"some"}
    assert read_landing(spark, zone).count() == 3
