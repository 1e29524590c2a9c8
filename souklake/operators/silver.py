"""Silver: source-shaped tables from bronze history and the operational snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, VariantType

from souklake.functions import documents
from souklake.schemas import DIMENSIONS, FACTS, JSON_COLUMNS, SCHEMAS, TABLES


def stored_schema(schema: StructType) -> StructType:
    """Schema as stored: semi-structured columns become text, names and nullability stay."""

    def stored(kind: DataType) -> DataType:
        return StringType() if isinstance(kind, VariantType | StructType) else kind

    return StructType([StructField(f.name, stored(f.dataType), f.nullable) for f in schema])


def conform(frame: DataFrame, table: str) -> DataFrame:
    """Columns in order with the silver types; fails when one is missing."""
    return frame.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in SCHEMAS[table]]
    )


def json_as_text(frame: DataFrame, table: str) -> DataFrame:
    """History JSON as plain text, every other column unchanged."""
    column = JSON_COLUMNS.get(table)
    if column is None:
        return frame
    kind = frame.schema[column].dataType
    if isinstance(kind, StringType):
        return frame
    value = F.col(column)
    text = F.to_json(value) if isinstance(kind, StructType | VariantType) else value.cast("string")
    return frame.withColumn(column, text)


def canonical_snapshot(frame: DataFrame, table: str) -> DataFrame:
    """Snapshot JSON with sorted keys and no blanks; text that is not JSON stays as it is."""
    column = JSON_COLUMNS.get(table)
    if column is None:
        return frame
    return frame.withColumn(column, F.coalesce(documents.canonical(F.col(column)), F.col(column)))


def silver_table(table: str, history: DataFrame | None, snapshot: DataFrame) -> DataFrame:
    """Dimensions are the snapshot; facts are history and snapshot together.

    History and live identifiers are disjoint, so the union needs no deduplication (and no
    shuffle).
    """
    current = conform(canonical_snapshot(snapshot, table), table)
    if table in DIMENSIONS:
        return current
    return conform(json_as_text(history, table), table).unionByName(current)


def silver_tables(
    history: dict[str, DataFrame], snapshot: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    return {table: silver_table(table, history.get(table), snapshot[table]) for table in TABLES}


def expected_counts(snapshot_counts: DataFrame, history_counts: DataFrame) -> DataFrame:
    """Rows each silver table must have: the snapshot's, and for facts the history's too."""
    history = history_counts.select("table", F.col("rows").alias("_history"))
    is_fact = F.col("table").isin(*FACTS)
    return snapshot_counts.join(history, "table", "left").select(
        "table",
        (
            F.col("rows") + F.when(is_fact, F.coalesce("_history", F.lit(0))).otherwise(0)
        ).alias("expected_rows"),
    )


def count_gate(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected against written rows per table (both sides have one row per table)."""
    return expected.join(actual.select("table", F.col("rows").alias("actual_rows")), "table", "left").select(
        "table",
        "expected_rows",
        F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
        (F.coalesce("actual_rows", F.lit(0)) == F.col("expected_rows")).alias("passed"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; each count scans no column."""
    counted = None
    for name, frame in tables.items():
        row = frame.groupBy().agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows"
        )
        counted = row if counted is None else counted.unionByName(row)
    return counted
