"""Publishing: both layers of a batch become current with one appended record.

`<lake>/batches/<id>/` holds a batch with its metadata; `<lake>/_published` is a log whose last
record names the current batch. Readers resolve tables through it, so they see all old tables or
all new ones, never a mixture.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souklake.schemas import GOLD_SCHEMAS, SCHEMAS, SILVER_VIEWS
from souklake.sources.tables import (
    create_once,
    delete_path,
    file_footers,
    list_names,
    path_exists,
    read_records,
    read_table,
    stored_schema,
)

PUBLISHED = "batch_id string, published_at timestamp, sequence bigint"
TABLE_RECORD = (
    "batch_id string, manifest_sha256 string, layer string, table string, rows bigint, "
    "source string, paths array<string>, properties map<string,string>"
)
LAYERS = {"silver": SCHEMAS, "gold": GOLD_SCHEMAS}


def batch_root(lake: str, batch_id: str) -> str:
    return f"{lake}/batches/{batch_id}"


def publication_log(spark: SparkSession, lake: str) -> DataFrame:
    path = f"{lake}/_published"
    if not path_exists(spark, path):
        return spark.createDataFrame([], PUBLISHED)
    return read_records(spark, path, PUBLISHED)


def current_batch(spark: SparkSession, lake: str) -> str | None:
    last = publication_log(spark, lake).orderBy(F.desc("sequence"), F.desc("published_at")).first()
    return last["batch_id"] if last else None


def publish(spark: SparkSession, lake: str, batch_id: str) -> None:
    """Make a finished batch the current one.

    A record's file is named by its number and never replaced: of two publishers that saw the same
    last number, one takes it and the other goes on to the next.
    """
    number = (publication_log(spark, lake).agg(F.max("sequence").alias("n")).first()["n"] or 0) + 1
    while True:
        moment = datetime.now(timezone.utc).isoformat()
        record = {"batch_id": batch_id, "published_at": moment, "sequence": number}
        if create_once(spark, f"{lake}/_published/{number:012d}.json", json.dumps(record) + "\n"):
            return
        number += 1


def discard(spark: SparkSession, lake: str, batch_id: str) -> None:
    """Remove a batch that is not current, a failed one or a replaced one."""
    if batch_id == current_batch(spark, lake):
        raise ValueError(f"batch {batch_id} is current")
    delete_path(spark, batch_root(lake, batch_id))


def batches(spark: SparkSession, lake: str) -> list[str]:
    return list_names(spark, f"{lake}/batches")


def discard_replaced(spark: SparkSession, lake: str) -> list[str]:
    """Remove every batch but the current one; call it when no reader uses an older one."""
    current = current_batch(spark, lake)
    gone = [batch for batch in batches(spark, lake) if batch != current]
    for batch in gone:
        discard(spark, lake, batch)
    return gone


def table_records(spark: SparkSession, lake: str, batch_id: str) -> DataFrame:
    return read_records(spark, f"{batch_root(lake, batch_id)}/_tables", TABLE_RECORD)


def read_layer(
    spark: SparkSession, lake: str, layer: str, batch_id: str | None = None
) -> dict[str, DataFrame]:
    """Tables of a layer as the given (or the current) batch has them."""
    batch_id = batch_id or current_batch(spark, lake)
    if batch_id is None:
        raise ValueError(f"nothing is published in {lake}")
    schemas: dict[str, StructType] = LAYERS[layer]
    records = table_records(spark, lake, batch_id).where(F.col("layer") == layer).collect()
    return {r["table"]: read_table(spark, schemas[r["table"]], r["paths"]) for r in records}


def stored_schemas(spark: SparkSession, lake: str, layer: str, batch_id: str) -> dict[str, StructType]:
    """Columns as the files of a layer hold them, whatever they should be."""
    records = table_records(spark, lake, batch_id).where(F.col("layer") == layer).collect()
    return {r["table"]: stored_schema(spark, r["paths"]) for r in records}


def stored_footers(spark: SparkSession, lake: str, layer: str, batch_id: str) -> dict[str, DataFrame]:
    """Footers of the files of a layer, those of adopted history too."""
    records = table_records(spark, lake, batch_id).where(F.col("layer") == layer).collect()
    return {r["table"]: file_footers(spark, r["paths"]) for r in records}


def register_views(spark: SparkSession, lake: str) -> str:
    """Temporary views of the current batch (silver_* and the gold names); returns its id."""
    batch_id = current_batch(spark, lake)
    for table, frame in read_layer(spark, lake, "silver", batch_id).items():
        frame.createOrReplaceTempView(SILVER_VIEWS[table])
    for model, frame in read_layer(spark, lake, "gold", batch_id).items():
        frame.createOrReplaceTempView(model)
    return batch_id
