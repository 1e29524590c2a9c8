"""Replay job: landing zone -> every event once -> current rows of every table.

Each micro-batch is stored in the delivery store, then merged into the tables' state. State lies in
hash buckets of the key, and a batch rewrites only the buckets that its keys fall into. A state row
keeps its place in the log and whether it is alive, so changes may come in any order and any number
of times: the last in log order wins, and a deleted key is not brought back by an older change. A
truncate rewrites nothing: its place is recorded, and rows that lie before it are left out on reading.

A repeated micro-batch finds the same new events and the same numbers: what it has already stored
stays as it is. The checkpoint belongs to the state folder; a new checkpoint needs a new one.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructType
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from souklake.operators import changes
from souklake.schemas import PRIMARY_KEYS, SCHEMAS
from souklake.sources.buckets import BUCKETS, Buckets
from souklake.sources.deliveries import SEGMENT_BITS, Deliveries
from souklake.sources.landing import stream_landing
from souklake.sources.tables import create_once, list_names

#: Tables that are replayed: schema and key.
Tables = dict[str, tuple[StructType, tuple[str, ...]]]
MARKET: Tables = {table: (SCHEMAS[table], PRIMARY_KEYS[table]) for table in SCHEMAS}

_PLACE = ("position", "ordinal", "event_id", "alive")


class State:
    """Current rows of the replayed tables below a folder."""

    def __init__(self, spark: SparkSession, root: str, tables: Tables = MARKET, buckets: int = BUCKETS, segment_bits: int = SEGMENT_BITS):
        self.spark, self.root, self.tables, self.buckets = spark, root, tables, buckets
        self.deliveries = Deliveries(spark, root, segment_bits)

    def table(self, name: str) -> Buckets:
        """Stored state of a table: its columns, and where in the log each row is from."""
        schema, key = self.tables[name]
        stored = StructType(list(schema.fields))
        for column, kind in zip(_PLACE, (LongType(), LongType(), StringType(), BooleanType())):
            stored = stored.add(f"_{column}", kind)
        return Buckets(self.spark, f"{self.root}/state/{name}", stored, key, self.buckets)

    def apply(self, envelopes: DataFrame, batch: int) -> dict[str, list[int]]:
        """Store and merge one micro-batch; returns the buckets rewritten of each table."""
        envelopes = envelopes.persist(StorageLevel.DISK_ONLY)  # read for its segments and its events
        try:
            new = self.deliveries.store(envelopes, batch)
        finally:
            envelopes.unpersist()
        self._note_truncates(new, batch)
        present = [r["table"] for r in new.select("table").distinct().collect()]
        names = sorted(set(present) & set(self.tables))
        merge = inheritable_thread_target(self.spark)(lambda name: self._merge(name, new, batch))
        with ThreadPoolExecutor(max_workers=max(1, len(names))) as jobs:  # the tables' jobs share the cluster
            return dict(zip(names, jobs.map(merge, names)))

    def _merge(self, name: str, new: DataFrame, batch: int) -> list[int]:
        schema, key = self.tables[name]
        flat = changes.flatten(new.where(F.col("table") == name), schema)
        images = changes.row_images(flat, schema, key).drop("table")
        images = images.withColumnsRenamed({c: f"_{c}" for c in _PLACE})

        def merged(old: DataFrame, incoming: DataFrame) -> DataFrame:
            both = old.unionByName(incoming).withColumnsRenamed({f"_{c}": c for c in _PLACE})
            return changes.newest_images(both, list(key)).withColumnsRenamed({c: f"_{c}" for c in _PLACE})

        return self.table(name).update(batch, images, [F.col(k) for k in key], merged)

    def _note_truncates(self, new: DataFrame, batch: int) -> None:
        """One small record for a batch that truncates: at most one entry a table."""
        found = [row.asDict() for row in changes.truncates(new).collect()]
        if found:
            create_once(self.spark, f"{self.root}/truncates/{batch:012d}.json", "".join(json.dumps(f) + "\n" for f in found))

    def _truncated(self, name: str) -> tuple[int, int | None] | None:
        """Place of the table's last truncate."""
        path = f"{self.root}/truncates"
        if not list_names(self.spark, path):
            return None
        places = self.spark.read.schema("`table` string, position bigint, ordinal bigint").json(path)
        last = places.where(F.col("table") == name).agg(F.max(F.struct("position", "ordinal")).alias("place")).first()["place"]
        return (last["position"], last["ordinal"]) if last else None

    def current(self, name: str) -> DataFrame:
        """Rows of a table as of the last micro-batch."""
        rows = self.table(name).read().where("_alive")
        if place := self._truncated(name):
            position, ordinal = F.lit(place[0]), F.lit(place[1]).cast("bigint")
            last = F.struct(position.alias("_position"), ordinal.alias("_ordinal"))
            rows = rows.where(F.struct("_position", "_ordinal") >= last)
        return rows.select(*self.tables[name][0].names)

    def discard_replaced(self) -> int:
        """Remove state that later batches replaced; returns the folders removed."""
        return sum(len(self.table(name).discard_replaced()) for name in self.tables)


def replay(
    state: State, landing: str, checkpoint: str, follow: bool = False, poll: str = "1 second", files_per_batch: int | None = None
) -> StreamingQuery:
    """Start replaying a landing zone: what there is, or follow it."""
    stream = stream_landing(state.spark, landing, files_per_batch)

    def apply(batch: DataFrame, number: int) -> None:
        state.apply(batch, number)

    trigger = {"processingTime": poll} if follow else {"availableNow": True}
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
