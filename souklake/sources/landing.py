"""Landing zone: gzip JSON lines under table=/ingest_date=/hour=/batch=.

Each batch leaves a record of its tags below `_batches`: changes, first and last place in the log of
every table, observed while the lines were written. A line that is no envelope is never a row of
NULLs: readers leave it out, `broken_lines` has it as it is stored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from souklake.functions import values
from souklake.operators.changes import UNROUTED, lsn_number, lsn_text, with_hour
from souklake.schemas import ENVELOPE, TABLES
from souklake.sources.tables import path_exists, replace_file

PARTITIONS = ("table", "ingest_date", "hour", "batch")
#: What a batch's tags are kept for; changes of any other table share one entry.
TAGGED = (*TABLES, UNROUTED)
OTHER = "_other"
TAGS = "batch string, `table` string, first_lsn string, last_lsn string, event_count bigint"
BROKEN = "_broken"
# The stored ingest time ends in +00:00, which a zone-less timestamp is not read from directly.
_STORED = StructType(
    [StructField(f.name, StringType() if f.name == "ingested_at" else f.dataType) for f in ENVELOPE]
)


def _partitioned(schema: StructType) -> StructType:
    """Partition columns as text: inference would read hour=07 as a number."""
    result = StructType(list(schema.fields))
    for name in PARTITIONS:
        result = result.add(name, StringType())
    return result


def envelope_line() -> Column:
    """One JSON object per envelope. A change that is a JSON object on one line is embedded as it came,
    so its text survives; anything else is stored as a JSON string, which keeps its line ends and quotes."""
    moment = F.concat(values.iso_text(F.col("ingested_at"), 6), F.lit("+00:00"))
    head = F.to_json(F.struct("event_id", moment.alias("ingested_at"), "schema_version", "source"))
    as_text = F.to_json(F.struct(F.col("change").alias("change")))
    whole = F.try_parse_json("change").isNotNull() & F.col("change").rlike(r"^[ \t]*\{") & ~F.col("change").rlike(r"[\r\n]")
    change = F.when(
        whole, F.concat(F.lit('{"change":'), F.col("change"), F.lit("}"))
    ).otherwise(as_text)
    # {"change":…} and {"event_id":…} become one object.
    return F.concat(F.substr(change, F.lit(1), F.length(change) - 1), F.lit(","), F.substr(head, F.lit(2)))


def _tag_metrics() -> list[Column]:
    """Changes, first and last place of each table: three fixed-size aggregates a table."""
    place, table, found = F.col("_place"), F.col("table"), []
    named = {name: table == name for name in TAGGED}
    named[OTHER] = ~F.coalesce(table.isin(*TAGGED), F.lit(False))
    for n, mine in enumerate(named.values()):
        own = F.when(mine, place)
        found += [F.count_if(mine).alias(f"n{n}"), F.min(own).alias(f"first{n}"), F.max(own).alias(f"last{n}")]
    return found


def _tag_record(metrics: dict, batch: str) -> str:
    rows = [
        {"batch": batch, "table": name, "first": metrics[f"first{n}"], "last": metrics[f"last{n}"], "event_count": metrics[f"n{n}"]}
        for n, name in enumerate((*TAGGED, OTHER))
        if metrics[f"n{n}"]
    ]
    return "".join(json.dumps(row, sort_keys=True) + "\n" for row in rows)


def write_landing(envelopes: DataFrame, root: str, batch: str) -> int:
    """Store one batch; returns the changes written. The batch is part of the path and its partitions are overwritten, so a
    retried batch replaces what a lost attempt left, its tags too. Rebalancing by table keeps small
    tables in one file and lets adaptive execution split a table that holds most of the batch."""
    seen = Observation()
    place = lsn_number(F.col("source.lsn")).alias("_place")
    lines = with_hour(envelopes).select(
        envelope_line().alias("value"), "table", "ingest_date", "hour", F.lit(batch).alias("batch"), place
    )
    (
        lines.hint("rebalance", "table")
        # Above the exchange: adaptive execution drops an empty stage with all that it observed.
        .observe(seen, F.count(F.lit(1)).alias("rows"), *_tag_metrics())
        .drop("_place")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy(*PARTITIONS)
        .text(root)
    )
    metrics = seen.get
    replace_file(envelopes.sparkSession, f"{root}/_batches/{batch}.json", _tag_record(metrics, batch))
    return metrics["rows"]


def batch_tags(spark: SparkSession, root: str) -> DataFrame:
    """(batch, table, first_lsn, last_lsn, event_count) of every stored batch; reads no change."""
    path = f"{root}/_batches"
    if not path_exists(spark, path):
        return spark.createDataFrame([], TAGS)
    stored = spark.read.schema("batch string, `table` string, first bigint, last bigint, event_count bigint").json(path)
    return stored.select("batch", "table", lsn_text(F.col("first")).alias("first_lsn"), lsn_text(F.col("last")).alias("last_lsn"), "event_count")


def _parsed(reader) -> DataFrame:
    """Lines as the columns of the envelope, and the text of a line that is no JSON object."""
    schema = _partitioned(StructType([*_STORED.fields, StructField(BROKEN, StringType())]))
    return reader.schema(schema).option("columnNameOfCorruptRecord", BROKEN)


def _envelopes(raw: DataFrame) -> DataFrame:
    """Rows of whole lines: JSON that names its event."""
    moment = F.col("ingested_at").cast(TimestampNTZType())
    return raw.where(F.col(BROKEN).isNull() & F.col("event_id").isNotNull()).drop(BROKEN).withColumn("ingested_at", moment)


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    """Envelopes with their partition columns; filters on those prune folders."""
    return _envelopes(_parsed(spark.read).json(root))


def broken_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines that `read_landing` leaves out, as they are stored, with their partition columns."""
    line = F.col("value")
    envelope = F.get_json_object(line, "$.event_id").isNotNull() & F.try_parse_json(line).isNotNull()
    return read_landing_lines(spark, root).where(~envelope)


def read_landing_lines(spark: SparkSession, root: str) -> DataFrame:
    """Raw lines with their partition columns."""
    return spark.read.schema(_partitioned(StructType().add("value", StringType()))).text(root)


def stream_landing(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    reader = _parsed(spark.readStream)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return _envelopes(reader.json(root))
