"""Tables in hash buckets of their key: an update rewrites the buckets it touches and no other file.

`<root>/v=<number>/_bucket=<n>/` holds what update `number` wrote, `<root>/_versions/<number>.json`
which version of each bucket is current from then on. Readers follow the last record, so they see an
update whole or not at all, and a bucket that was not touched keeps its files. An update that is
repeated after its record was written does nothing; one that was lost before overwrites its folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from souklake.sources.tables import create_once, delete_path, list_names, read_table, write_partitions

#: Fixed value: buckets of a new table. A bucket is what one touched key costs to rewrite.
BUCKETS = 64
BUCKET = "_bucket"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class Buckets:
    """A keyed table below a folder. One writer at a time; readers at any time."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: tuple[str, ...], buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.key = spark, root, schema, key
        record = self._record()
        self.buckets = record["of"] if record else buckets  # a table keeps the number it began with

    def _record(self) -> dict | None:
        """The last version record: small, one entry a bucket."""
        names = [n for n in list_names(self.spark, f"{self.root}/_versions") if n.endswith(".json")]
        if not names:
            return None
        lines = self.spark.read.text(f"{self.root}/_versions/{names[-1]}")
        return json.loads(lines.first()["value"])

    def last_update(self) -> int:
        """Number of the last update, -1 of none."""
        record = self._record()
        return record["number"] if record else -1

    def bucket_of(self, columns: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    def paths(self, buckets: list[int] | None = None) -> list[str]:
        """Folders of the current version of the given (or all) buckets that have rows."""
        current = (self._record() or {"current": {}})["current"]
        return [
            f"{self.root}/v={version}/{BUCKET}={bucket}"
            for bucket, version in sorted(current.items(), key=lambda entry: int(entry[0]))
            if buckets is None or int(bucket) in buckets
        ]

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the given (or all) buckets; no other bucket's files are listed."""
        paths = self.paths(buckets)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return read_table(self.spark, self.schema, paths)

    def update(self, number: int, incoming: DataFrame, key: list[Column], merge: Merge) -> list[int]:
        """Replace the buckets that the incoming rows' keys fall into by merge(their rows, incoming).

        Returns the buckets touched: at most as many numbers as the table has buckets come to the
        driver. Updates are numbered upwards; a number that is not new changes nothing.
        """
        if number <= self.last_update():
            return []
        incoming = incoming.persist(StorageLevel.DISK_ONLY)  # read for the buckets and for the merge
        try:
            touched = sorted(r["b"] for r in incoming.select(self.bucket_of(key).alias("b")).distinct().collect())
            merged = merge(self.read(touched), incoming).select(*self.schema.names)
            return self._store(number, merged, touched)
        finally:
            incoming.unpersist()

    def replace(self, number: int, rows: DataFrame) -> list[int]:
        """Replace the whole table."""
        if number <= self.last_update():
            return []
        return self._store(number, rows.select(*self.schema.names), list(range(self.buckets)))

    def _store(self, number: int, rows: DataFrame, touched: list[int]) -> list[int]:
        folder = f"{self.root}/v={number}"
        placed = rows.withColumn(BUCKET, self.bucket_of([F.col(k) for k in self.key]))
        write_partitions(placed, folder, BUCKET)
        written = {name.split("=")[1] for name in list_names(self.spark, folder) if name.startswith(f"{BUCKET}=")}
        if foreign := written - {str(b) for b in touched}:
            raise ValueError(f"update {number} of {self.root} moves rows into buckets {sorted(foreign)}, which it did not read")
        current = (self._record() or {"current": {}})["current"]
        current = {b: v for b, v in current.items() if int(b) not in touched} | {b: number for b in written}
        record = json.dumps({"number": number, "of": self.buckets, "current": current}, sort_keys=True)
        if not create_once(self.spark, f"{self.root}/_versions/{number:012d}.json", record + "\n"):
            raise RuntimeError(f"update {number} of {self.root} was written by another job")
        return touched

    def discard_replaced(self) -> list[str]:
        """Remove version folders that the last record does not name; call it when no reader needs them.

        A folder goes once none of its buckets is current, so old rows of a folder of which one
        bucket is still current stay on disk until that bucket is rewritten.
        """
        record = self._record()
        if record is None:
            return []
        living = {f"v={v}" for v in record["current"].values()}
        gone = [n for n in list_names(self.spark, self.root) if n.startswith("v=") and n not in living and int(n[2:]) <= record["number"]]
        for name in gone:
            delete_path(self.spark, f"{self.root}/{name}")
        return gone
