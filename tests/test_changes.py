import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from souklake.operators import changes

IMAGE = StructType().add("id", LongType()).add("name", StringType()).add("price", DoubleType())
FEED = "lsn string, xid string, raw string, ingested_at timestamp_ntz, ordinal bigint"


def change(action, new=None, old=None, table="t"):
    def image(row):
        return [{"name": k, "type": "x", "value": v} for k, v in row.items()]

    body = {"action": action, "schema": "public", "table": table}
    if new is not None:
        body["columns"] = image(new)
    if old is not None:
        body["identity"] = image(old)
    return json.dumps(body)


def feed(spark, *rows):
    """(lsn, raw[, ordinal]) rows as envelopes."""
    filled = [(r[0], "7", r[1], None, r[2] if len(r) > 2 else None) for r in rows]
    frame = spark.createDataFrame(filled, FEED).withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    return changes.envelope(frame, "db", F.col("ingested_at"))


def state(frame):
    return sorted(tuple(r) for r in changes.current_rows(frame, IMAGE, ("id",)).collect())


def test_event_id_is_the_digest_of_its_source(spark):
    raw = change("I", {"id": 1})
    row = feed(spark, ("16/B374D848", raw)).first()
    assert row["event_id"] == hashlib.sha256(f"db|16/B374D848|7|{raw}".encode()).hexdigest()
    assert row["change"] == raw and row["table"] == "t"


def test_lsn_sorts_as_a_number(spark):
    frame = spark.createDataFrame([("F/FFFFFFFF",), ("10/0",), ("0/A",), ("0/9",)], "lsn string")
    numbers = frame.select("lsn", changes.lsn_number(F.col("lsn")).alias("n")).orderBy("n")
    assert [r["lsn"] for r in numbers.collect()] == ["0/9", "0/A", "F/FFFFFFFF", "10/0"]
    back = numbers.select(changes.lsn_text(F.col("n")).alias("t")).collect()
    assert [r["t"] for r in back] == ["0/9", "0/A", "F/FFFFFFFF", "10/0"]


def test_unrouted_and_malformed_changes(spark):
    rows = feed(spark, ("0/1", '{"action":"B"}'), ("0/2", "no json")).collect()
    assert [r["table"] for r in rows] == ["_metadata", "_metadata"]


def test_replay_insert_update_delete(spark):
    frame = feed(
        spark,
        ("0/1", change("I", {"id": 1, "name": "a", "price": 1.5})),
        ("0/F", change("U", {"id": 1, "name": "b", "price": 2.5}, {"id": 1, "name": "a", "price": 1.5})),
        ("0/2", change("I", {"id": 2, "name": "c", "price": None})),
        ("0/3", change("I", {"id": 3, "name": "d", "price": 1})),
        ("0/10", change("D", old={"id": 3, "name": "d", "price": 1})),
    )
    assert state(frame) == [(1, "b", 2.5), (2, "c", None)]


def test_replay_is_stable_under_redelivery_and_order(spark):
    rows = [("0/1", change("I", {"id": 1, "name": "a", "price": 1})), ("0/2", change("D", old={"id": 1, "name": "a", "price": 1}))]
    assert state(feed(spark, *rows, *reversed(rows))) == []


def test_key_change_ends_the_old_key(spark):
    frame = feed(
        spark,
        ("0/1", change("I", {"id": 1, "name": "a", "price": 1})),
        ("0/2", change("U", {"id": 9, "name": "a", "price": 1}, {"id": 1, "name": "a", "price": 1})),
    )
    assert state(frame) == [(9, "a", 1.0)]


def test_truncate_ends_the_rows_before_it(spark):
    frame = feed(
        spark,
        ("0/1", change("I", {"id": 1, "name": "a", "price": 1})),
        ("0/2", change("I", {"id": 2, "name": "b", "price": 1})),
        ("0/9", change("T")),
        ("0/9", change("T", table="other")),
        ("0/A", change("I", {"id": 2, "name": "c", "price": 1})),
    )
    assert state(frame) == [(2, "c", 1.0)]


def test_truncate_of_another_table(spark):
    frame = feed(spark, ("0/1", change("I", {"id": 1, "name": "a", "price": 1})), ("0/9", change("T", table="other")))
    assert state(frame) == [(1, "a", 1.0)]


def test_left_out_column_and_digits(spark):
    exact = StructType().add("id", LongType()).add("name", StringType()).add("price", "decimal(38,10)")
    digits = "12345678901234567890.1234567891"
    raw = change("I", {"id": 1, "name": "a", "price": "PRICE"}).replace('"PRICE"', digits)
    update = change("U", {"id": 1, "name": "b"}, {"id": 1, "name": "a", "price": "PRICE"}).replace('"PRICE"', digits)
    for rows in ([("0/1", raw)], [("0/1", raw), ("0/2", update)]):
        row = changes.current_rows(feed(spark, *rows), exact, ("id",)).first()
        assert str(row["price"]) == digits and row["name"] == ("b" if len(rows) == 2 else "a")


def test_ordinal_orders_changes_of_one_lsn(spark):
    first, second = change("I", {"id": 1, "name": "old", "price": 1}), change("U", {"id": 1, "name": "new", "price": 1})
    assert state(feed(spark, ("0/1", second, 2), ("0/1", first, 1))) == [(1, "new", 1.0)]


def test_hot_key_and_hot_event(spark):
    """A third of the changes are of one key, a third are deliveries of one event."""
    frame = spark.range(3000).select(
        F.concat(F.lit("0/"), F.hex(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))).alias("lsn"),
        F.lit("1").alias("xid"),
        F.concat(
            F.lit('{"action":"I","table":"t","columns":[{"name":"id","type":"x","value":'),
            F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 1).otherwise(F.col("id")).cast("string"),
            F.lit("}]}"),
        ).alias("raw"),
    )
    envelopes = changes.envelope(frame, "db", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert changes.deduplicate(envelopes).count() == 2001
    assert changes.current_rows(envelopes, IMAGE, ("id",)).count() == 1002


@pytest.mark.parametrize("operator", ["deduplicate", "current_rows"])
def test_groups_are_limited_before_the_shuffle(spark, operator):
    envelopes = feed(spark, ("0/1", change("I", {"id": 1})))
    frame = changes.deduplicate(envelopes) if operator == "deduplicate" else changes.current_rows(envelopes, IMAGE, ("id",))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
