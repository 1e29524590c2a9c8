import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from souklake.operators import changes
from souklake.schemas import SCHEMAS
from souklake.sources.buckets import Buckets
from souklake.sources.deliveries import Deliveries
from souklake.sources.landing import write_landing
from souklake.streaming import replay
from tests.test_changes import change, feed

ROW = StructType().add("id", LongType()).add("name", StringType()).add("price", DoubleType())
TABLES = {"t": (ROW, ("id",)), "u": (ROW, ("id",))}


def files(root):
    return {path: (os.stat(path).st_mtime_ns, os.path.getsize(path)) for path in glob.glob(f"{root}/**/part-*", recursive=True)}


def log(count, seed=7):
    """(lsn, raw) changes with deletes, key changes, left-out columns and truncates."""
    draw, made = random.Random(seed), []
    for place in range(256, 256 + count):
        key, table = draw.randrange(25), draw.choice("tu")
        row = {"id": key, "name": f"n{place}", "price": place / 4}
        kind = draw.randrange(12)
        if kind == 0:
            raw = change("D", old={"id": key}, table=table)
        elif kind == 1:
            raw = change("U", new=row | {"id": key + 100}, old={"id": key}, table=table)
        elif kind == 2:
            raw = change("U", new={"id": key, "price": 0.5}, old={"id": key, "name": f"kept{place}", "price": 1.0}, table=table)
        elif kind == 3 and place % 5 == 0:
            raw = json.dumps({"action": "T", "schema": "public", "table": table})
        else:
            raw = change(draw.choice("IU"), new=row, table=table)
        made.append((f"0/{place:X}", raw))
    return made


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_replay_in_any_order_and_number_of_batches_equals_the_batch_form(spark, tmp_path):
    """One file a batch, hours out of order, repeats in later batches, a repeated batch."""
    envelopes, zone = feed(spark, *log(300)).persist(), f"{tmp_path}/zone"
    shuffled = envelopes.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    for part in (2, 0, 3, 1):
        own = shuffled.where(F.col("part") == part).drop("part").withColumn("ingested_at", F.col("ingested_at") + F.expr(f"interval {5 - part} days"))
        write_landing(own, zone, f"b{part}")
    write_landing(envelopes.where("source.lsn < '0/140'").withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 90 days")), zone, "repeat")
    state = replay.State(spark, f"{tmp_path}/state", TABLES, buckets=5, segment_bits=6)
    replay.replay(state, zone, f"{tmp_path}/cp", files_per_batch=1).awaitTermination()
    assert state.table("t").last_update() >= 3
    for name in TABLES:
        wanted = changes.current_rows(envelopes.where(F.col("table") == name), ROW, ("id",))
        assert rows(state.current(name)) == rows(wanted) != []
    events = state.deliveries.events()
    assert events.count() == events.select("event_id").distinct().count() == 300
    assert events.where("ingested_at >= '2024-03-01'").count() == 0
    before = files(f"{tmp_path}/state/state")
    replay.replay(state, zone, f"{tmp_path}/cp").awaitTermination()
    assert files(f"{tmp_path}/state/state") == before


def test_lost_batch_is_done_again(spark, tmp_path, monkeypatch):
    """A batch that is lost between its events and its state leaves nothing twice and nothing out."""
    envelopes, zone = feed(spark, *log(80)), f"{tmp_path}/zone"
    write_landing(envelopes, zone, "b")
    state = replay.State(spark, f"{tmp_path}/state", TABLES, buckets=3)
    merge, lost = replay.State._merge, []

    def lose(self, name, new, batch):
        if name == "u" and not lost:
            lost.append(batch)
            raise RuntimeError("lost")
        return merge(self, name, new, batch)

    monkeypatch.setattr(replay.State, "_merge", lose)
    with pytest.raises(Exception, match="lost"):
        replay.replay(state, zone, f"{tmp_path}/cp").awaitTermination()
    replay.replay(state, zone, f"{tmp_path}/cp").awaitTermination()
    assert lost == [0]
    for name in TABLES:
        assert rows(state.current(name)) == rows(changes.current_rows(envelopes.where(F.col("table") == name), ROW, ("id",)))
    assert state.deliveries.events().count() == 80


def test_only_stretches_of_the_batch_are_compared(spark, tmp_path):
    store = Deliveries(spark, str(tmp_path), segment_bits=4)
    first = feed(spark, *[(f"0/{place:X}", change("I", {"id": place})) for place in range(256, 320)])
    assert store.store(first, 0).count() == 64
    again = first.where("source.lsn in ('0/100', '0/101', '0/120')").unionByName(first.where("source.lsn = '0/100'"))
    known = store.known([16, 18], 1)
    assert known.count() == 32
    assert {p.split("segment=")[1].split("/")[0] for p in known.inputFiles()} == {"16", "18"}
    assert store.store(again, 1).count() == 0
    assert store.store(feed(spark, (None, change("I", {"id": 1})), (None, change("I", {"id": 1}))), 2).count() == 1


def test_a_long_batch_spreads_its_ids_over_few_folders(spark, tmp_path):
    """Segments grow with the log, folders do not; narrower and wider stretches of other batches are found."""
    def part(*places):
        return feed(spark, *[(f"0/{place:X}", change("I", {"id": place})) for place in places])

    store = Deliveries(spark, str(tmp_path), segment_bits=2)
    assert store.store(part(*range(256, 276), *range(4000, 4010)), 0).count() == 30
    long = part(*range(256, 4352)).unionByName(feed(spark, (None, change("I", {"id": 1}))))
    assert store.store(long, 1).count() == 4097 - 30
    assert len(glob.glob(f"{tmp_path}/ids*/*/batch=1")) <= 128
    assert store.known([64], 2).count() == 4 + 44 and store.known([64], 1).count() == 4  # 256 … 303 lie in one stretch of 16 segments
    assert store.store(part(255, 300, 5000), 2).count() == 2
    assert store.store(long, 1).count() == 4097 - 30 and store.store(long, 3).count() == 0
    assert store.events().count() == 4097 + 2


def test_an_update_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    schema = StructType().add("id", LongType()).add("n", LongType())
    table = Buckets(spark, str(tmp_path), schema, ("id",), buckets=8)
    assert table.read().count() == 0 and table.last_update() == -1
    table.replace(0, spark.range(1000).selectExpr("id", "0L AS n"))
    before = files(tmp_path)
    more = spark.createDataFrame([(5,), (5,), (7,)], "id long")

    def add(old, incoming):
        folded = incoming.groupBy("id").agg(F.count(F.lit(1)).alias("k"))
        return old.join(folded, "id", "left").select("id", (F.col("n") + F.coalesce("k", F.lit(0))).alias("n"))

    touched = table.update(1, more, [F.col("id")], add)
    assert 1 <= len(touched) <= 2
    assert table.update(1, more, [F.col("id")], add) == []
    assert rows(table.read().where("n > 0")) == [(5, 2), (7, 1)] and table.read().count() == 1000
    assert {p: v for p, v in files(tmp_path).items() if p in before} == before
    current = {p.removeprefix('file://') for p in table.read().inputFiles()}
    assert len(current & set(before)) == 8 - len(touched)
    assert table.discard_replaced() == [] and Buckets(spark, str(tmp_path), schema, ("id",), buckets=99).buckets == 8
    table.replace(2, table.read().where("id < 3"))
    assert table.discard_replaced() == ["v=0", "v=1"] and table.read().count() == 3
    with pytest.raises(ValueError, match="did not read"):
        table.update(3, more, [F.col("id")], lambda old, new: old.unionByName(spark.range(900, 990).selectExpr("id", "0L AS n")))
    assert table.read().count() == 3


def test_replayed_state_is_a_snapshot(spark, tmp_path):
    """Typed columns come back from the text of the changes; a table without changes is empty."""
    vendor = {"SellerKey": "SELLER-000001", "DaysActive": 12, "PerformanceRating": 4.5, "TotalTxns": "7", "LastActiveDt": "2024-02-03 04:05:06.5", "vendor_compliance_ratings": '{"score": 0.50}'}
    state = replay.State(spark, f"{tmp_path}/state", buckets=2)
    state.apply(feed(spark, ("0/100", change("I", vendor, table="vendors"))), 0)
    assert state.current("vendors").schema.names == SCHEMAS["vendors"].names
    row = state.current("vendors").first().asDict()
    assert {k: str(row[k]) for k in vendor} == {k: str(v) for k, v in vendor.items()} | {"LastActiveDt": "2024-02-03 04:05:06.500000"}
    assert state.current("buyers").count() == 0
