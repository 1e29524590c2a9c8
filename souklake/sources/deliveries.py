"""Store of first deliveries: which events of the change feed are known, without a time limit.

An event id is a digest that covers the event's place in the log, so a repeat has the LSN of the
first delivery, however late it comes. Known ids lie in one folder for each stretch of the log
(`segment=`), and a batch is compared with the folders of its own stretches only. Below, one folder
a batch (`batch=`): a batch that is done again sees what the batches before it stored, so it finds
the same events and overwrites its own folders.

A batch with many segments stores its ids in wider stretches (`ids_wide<bits>/stretch=`), each of them
2^bits segments, so that its folders do not grow in number with its length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.operators import changes
from souklake.schemas import ENVELOPE
from souklake.sources.tables import list_names, path_exists, write_partitions

#: Fixed value: bits of log position in a segment (1 GiB of log; a few million changes).
SEGMENT_BITS = 30
#: Folders that a batch spreads its ids over at most, and the bits by which stretches become wider until then.
MOST_STRETCHES, WIDEN_BITS = 128, 4
_WIDE = "ids_wide"
_IDS = "id binary, segment bigint, batch bigint"
_EVENTS = "`table` string, batch bigint"


def segment_of(lsn: Column, bits: int = SEGMENT_BITS) -> Column:
    """Stretch of the log; -1 of a change without a place."""
    return F.coalesce(F.shiftright(changes.lsn_number(lsn), bits), F.lit(-1))


class Deliveries:
    """`<root>/ids` and `ids_wide<bits>` as above, and `<root>/events/table=/batch=` with the first deliveries themselves."""

    def __init__(self, spark: SparkSession, root: str, segment_bits: int = SEGMENT_BITS):
        self.spark, self.root, self.bits = spark, root, segment_bits

    def known(self, stretches: list[int], before: int, widened: int = 0) -> DataFrame:
        """Ids that earlier batches stored in the given stretches, each of 2^widened segments; others are not listed.

        Folders of wider stretches that hold a given one are read, and those of narrower ones in it.
        """
        found = []
        for name in list_names(self.spark, self.root):
            bits = 0 if name == "ids" else int(name.removeprefix(_WIDE)) if name.startswith(_WIDE) else None
            if bits is None:
                continue
            asked = {s >> max(0, bits - widened) for s in stretches}
            stored = list_names(self.spark, f"{self.root}/{name}")
            own = [n for n in stored if "=" in n and int(n.split("=")[1]) >> max(0, widened - bits) in asked]
            if own:
                reader = self.spark.read.schema(_IDS if bits == 0 else f"{_IDS}, stretch bigint").option("basePath", f"{self.root}/{name}")
                found.append(reader.parquet(*[f"{self.root}/{name}/{n}" for n in own]).select("id", "segment", "batch"))
        if not found:
            return self.spark.createDataFrame([], _IDS)
        return reduce(DataFrame.unionByName, found).where(F.col("batch") < before)

    def _stretches(self, placed: DataFrame) -> tuple[int, list[int]]:
        """The least widening that leaves a batch `MOST_STRETCHES` stretches, and these: no more numbers come to the driver."""
        for widened in range(0, 64, WIDEN_BITS):
            stretch = F.shiftright("segment", widened).alias("stretch")
            found = [r["stretch"] for r in placed.select(stretch).distinct().limit(MOST_STRETCHES + 1).collect()]
            if len(found) <= MOST_STRETCHES:
                break
        return widened, found

    def store(self, envelopes: DataFrame, batch: int) -> DataFrame:
        """Store what of a batch is new, each event once (its earliest delivery), and return it."""
        placed = envelopes.select(*[f.name for f in ENVELOPE], "table").withColumn("segment", segment_of(F.col("source.lsn"), self.bits))
        widened, touched = self._stretches(placed)
        known = self.known(touched, batch, widened).select("segment", "id")
        new = (
            changes.deduplicate(placed)
            .withColumn("id", F.unhex("event_id"))
            .join(known, ["segment", "id"], "left_anti")
            .drop("segment", "id")
            .withColumn("batch", F.lit(batch).cast("bigint"))
        )
        write_partitions(new, f"{self.root}/events", "table", "batch", keep_others=True)
        stored = self.batch(batch)
        ids = stored.select(F.unhex("event_id").alias("id"), segment_of(F.col("source.lsn"), self.bits).alias("segment"), "batch")
        if widened:
            wide = ids.withColumn("stretch", F.shiftright("segment", widened))
            write_partitions(wide, f"{self.root}/{_WIDE}{widened}", "stretch", "batch", keep_others=True)
        else:
            write_partitions(ids, f"{self.root}/ids", "segment", "batch", keep_others=True)
        return stored

    def _read(self, paths: list[str]) -> DataFrame:
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in ENVELOPE)}, {_EVENTS}"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/events").parquet(*paths)

    def batch(self, batch: int) -> DataFrame:
        """Events that a batch was the first to bring; only its folders are listed."""
        tables = list_names(self.spark, f"{self.root}/events")
        folders = [f"{self.root}/events/{t}/batch={batch}" for t in tables if t.startswith("table=")]
        return self._read([f for f in folders if path_exists(self.spark, f)])

    def events(self) -> DataFrame:
        """Every event once."""
        root = f"{self.root}/events"
        return self._read([root] if path_exists(self.spark, root) else [])
