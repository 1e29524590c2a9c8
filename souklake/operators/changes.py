"""Change feed: envelope, routing, deduplication, flattening and replay.

Everything here is row-wise or a window over a key, so it runs on batches and, but for replay, on
streams alike. The raw change stays text: the event id is a digest of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souklake.functions import values

# Fixed values of the envelope.
SCHEMA_VERSION = 1
CONNECTOR = "postgresql-wal2json"
SERVICE = "postgres-source"
UNROUTED = "_metadata"

# A variant keeps the digits of a number; text would be read through a double.
_IMAGE = "array<struct<name: string, type: string, value: variant>>"
CHANGE = f"action string, schema string, table string, columns {_IMAGE}, identity {_IMAGE}"
_LSN_HALF = 2**32


def lsn_number(lsn: Column) -> Column:
    """'16/B374D848' as a number; the text form does not sort."""
    high = F.conv(F.substring_index(lsn, "/", 1), 16, 10).cast("bigint")
    low = F.conv(F.substring_index(lsn, "/", -1), 16, 10).cast("bigint")
    return high * F.lit(_LSN_HALF) + low


def lsn_text(number: Column) -> Column:
    high = F.call_function("div", number, F.lit(_LSN_HALF))
    return F.concat(F.hex(high), F.lit("/"), F.hex(number % F.lit(_LSN_HALF)))


def event_id(database: str, lsn: Column, xid: Column, raw: Column) -> Column:
    """Digest of where a change is from and what it says, the same on every delivery."""
    return F.sha2(F.concat_ws("|", F.lit(database), lsn, xid, raw), 256)


def routed_table(raw: Column) -> Column:
    return F.coalesce(F.get_json_object(raw, "$.table"), F.lit(UNROUTED))


def envelope(changes: DataFrame, database: str, ingested_at: Column | None = None) -> DataFrame:
    """Envelope of (lsn, xid, raw[, ordinal]) rows, plus the `table` it is routed to.

    The default ingest time is the batch time, which a streaming query keeps when it retries.
    """
    if ingested_at is None:
        local = F.current_timestamp().cast("timestamp_ntz")
        ingested_at = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    ordinal = F.col("ordinal") if "ordinal" in changes.columns else F.lit(None).cast("bigint")
    return changes.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        event_id(database, F.col("lsn"), F.col("xid"), F.col("raw")).alias("event_id"),
        ingested_at.cast("timestamp_ntz").alias("ingested_at"),
        F.struct(
            F.lit(CONNECTOR).alias("connector"),
            F.lit(SERVICE).alias("service"),
            F.lit(database).alias("database"),
            F.col("lsn").alias("lsn"),
            F.col("xid").alias("xid"),
            ordinal.alias("ordinal"),
        ).alias("source"),
        F.col("raw").alias("change"),
        routed_table(F.col("raw")).alias("table"),
    )


def with_hour(envelopes: DataFrame) -> DataFrame:
    """Partition columns of the landing zone."""
    text = values.iso_text(F.col("ingested_at"))
    return envelopes.withColumns(
        {"ingest_date": F.substring(text, 1, 10), "hour": F.substring(text, 12, 2)}
    )


def batch_stats(envelopes: DataFrame) -> DataFrame:
    """First and last LSN and event count per table; fixed-width sums, combined map-side."""
    position = lsn_number(F.col("source.lsn"))
    return envelopes.groupBy("table").agg(
        lsn_text(F.min(position)).alias("first_lsn"),
        lsn_text(F.max(position)).alias("last_lsn"),
        F.count(F.lit(1)).alias("event_count"),
    )


def deduplicate(envelopes: DataFrame) -> DataFrame:
    """One envelope per event id, the earliest delivery.

    Spark limits each group before the shuffle (row_number = 1), so an id delivered a million
    times leaves one row per task.
    """
    order = W.partitionBy("event_id").orderBy("ingested_at")
    return (
        envelopes.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    )


def deduplicate_stream(envelopes: DataFrame, delay: str) -> DataFrame:
    """Streaming form: exact among deliveries that the stream reads at most `delay` apart.

    The watermark follows the time of the micro-batch, not the event's, so a first delivery is
    never late, however old; a repeat that is read after `delay` may stay.
    """
    return (
        envelopes.withColumn("_seen", F.current_timestamp())
        .withWatermark("_seen", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
        .drop("_seen")
    )


def _by_name(image: Column) -> Column:
    return F.map_from_entries(F.transform(image, lambda c: F.struct(c["name"], c["value"])))


def _typed(values_by_name: str, schema: StructType) -> Column:
    """Typed row of an image's values, NULL without an image."""
    fields = [
        F.try_variant_get(
            F.try_element_at(F.col(values_by_name), F.lit(f.name)), "$", f.dataType.simpleString()
        ).alias(f.name)
        for f in schema
    ]
    return F.when(F.col(values_by_name).isNotNull(), F.struct(*fields))


def flatten(envelopes: DataFrame, schema: StructType) -> DataFrame:
    """Typed new and old image per change, with its position in the log.

    Each change is parsed once and each image becomes a map once, in projections of their own.
    """
    parsed = envelopes.withColumn("_c", F.from_json("change", CHANGE))
    mapped = parsed.withColumns(
        {"_new": _by_name(F.col("_c.columns")), "_old": _by_name(F.col("_c.identity"))}
    )
    # An update leaves out large values that did not change; the old image has them.
    left_out = F.map_filter("_old", lambda name, _: ~F.array_contains(F.map_keys("_new"), name))
    updated = (F.col("_c.action") == "U") & F.col("_old").isNotNull() & F.col("_new").isNotNull()
    mapped = mapped.withColumn("_new", F.when(updated, F.map_concat(left_out, "_new")).otherwise(F.col("_new")))
    return mapped.select(
        "event_id",
        F.coalesce("_c.table", F.lit(UNROUTED)).alias("table"),
        F.col("_c.action").alias("action"),
        lsn_number(F.col("source.lsn")).alias("position"),
        F.col("source.ordinal").alias("ordinal"),
        _typed("_new", schema).alias("new"),
        _typed("_old", schema).alias("old"),
    )


def _last_truncates(envelopes: DataFrame) -> Column:
    """Map of table to the place of its last truncate: one entry a table, whatever the log holds."""
    last = truncates(envelopes).select("table", F.struct("position", "ordinal").alias("place"))
    return last.agg(F.map_from_entries(F.collect_list(F.struct("table", "place")))).scalar()


def current_rows(
    envelopes: DataFrame, schema: StructType, key: tuple[str, ...], by_table: bool = False
) -> DataFrame:
    """Replay: the last image of every key in log order, deleted keys left out.

    An update that changes the key ends the old one; a truncate ends all rows that lie before it
    in the log (a change at the very place of the truncate stays). With `by_table` the table name
    is part of the key and of the result.
    """
    flat = flatten(envelopes, schema)
    truncated = F.try_element_at(_last_truncates(envelopes), F.col("table"))
    flat = flat.where(F.coalesce(F.struct("position", "ordinal") >= truncated, F.lit(True)))
    images = row_images(flat, schema, key)
    kept = ["table"] if by_table else []
    return (
        newest_images(images, (["table"] if by_table else []) + list(key))
        .where("alive")
        .select(*kept, *[field.name for field in schema])
    )


def row_images(flat: DataFrame, schema: StructType, key: tuple[str, ...]) -> DataFrame:
    """What each flattened change makes of its rows: the row it leaves, and the row it ends.

    An update that changes the key does both. Columns: table, position, ordinal, event_id, alive
    and those of the schema (of an ended row, what its old image has).
    """
    moved = F.lit(False)
    for name in key:
        moved = moved | ~F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}"))
    ended = F.struct(F.lit(False).alias("alive"), F.col("old").alias("row"))
    living = F.struct(F.lit(True).alias("alive"), F.col("new").alias("row"))
    outcome = (
        F.when(F.col("action") == "D", F.array(ended))
        .when((F.col("action") == "U") & F.col("old").isNotNull() & moved, F.array(ended, living))
        .when(F.col("action").isin("I", "U"), F.array(living))
        .otherwise(F.array().cast(f"array<struct<alive: boolean, row: {schema.simpleString()}>>"))
    )
    return flat.select("table", "position", "ordinal", "event_id", F.explode(outcome).alias("_o")).select(
        "table", "position", "ordinal", "event_id", "_o.alive", "_o.row.*"
    )


def newest_images(images: DataFrame, keys: list[str]) -> DataFrame:
    """The last image of every key in log order."""
    newest = W.partitionBy(*keys).orderBy(
        F.desc("position"), F.desc("ordinal"), F.desc("alive"), F.desc("event_id")
    )
    return images.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def truncates(envelopes: DataFrame) -> DataFrame:
    """(table, position, ordinal) of each table's last truncate: at most one row a table."""
    parsed = envelopes.where(F.get_json_object("change", "$.action") == "T")
    place = F.struct(lsn_number(F.col("source.lsn")).alias("position"), F.col("source.ordinal").alias("ordinal"))
    last = parsed.groupBy(routed_table(F.col("change")).alias("table")).agg(F.max(place).alias("_p"))
    return last.select("table", "_p.position", "_p.ordinal")
