"""Bronze history: `<root>/<table>/<segment>/*.parquet`, a ledger of segments and a manifest.

A segment is one Spark write of a contiguous range of row numbers. Its folder is named after the
first number, so a lost write is repeated into the same folder. The ledger holds one row per
finished segment; what is not in it does not exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souklake.functions import documents
from souklake.schemas import SCHEMAS, TABLES
from souklake.sources.tables import (
    CODEC,
    append_record,
    file_footers,
    path_exists,
    read_records,
    read_table,
    stored_bytes,
    stored_files,
    stored_schema,
)

LEDGER = "table string, row_start bigint, row_count bigint, bytes bigint, path string"
MANIFEST = (
    "schema_version int, generated_at string, format string, compression string, "
    "tables map<string,bigint>, rows map<string,bigint>, "
    "total_parquet_bytes bigint, requested_bytes bigint"
)


def segment_path(root: str, table: str, start: int) -> str:
    return f"{root}/{table}/from-{start:014d}"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/_ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return read_records(spark, path, LEDGER)


def record_segment(spark: SparkSession, root: str, table: str, start: int, rows: int) -> int:
    """Enter a written segment into the ledger; returns its bytes."""
    path = segment_path(root, table, start)
    size = stored_bytes(spark, path)
    row = (table, start, rows, size, path)
    append_record(spark.createDataFrame([row], LEDGER), f"{root}/_ledger")
    return size


def progress(ledger: DataFrame) -> DataFrame:
    """Per table: bytes and rows so far, and the row number to go on from."""
    return ledger.groupBy("table").agg(
        F.sum("bytes").alias("bytes"),
        F.sum("row_count").alias("rows"),
        F.max(F.col("row_start") + F.col("row_count")).alias("next_row"),
    )


def build_manifest(totals: DataFrame, requested_bytes: int, generated_at: Column) -> DataFrame:
    """One row from (table, bytes, rows) totals; ten tables, so the maps are small."""

    def as_map(column: str) -> Column:
        entries = F.array_sort(F.collect_list(F.struct("table", column)))
        return F.map_from_entries(entries)

    return totals.agg(
        F.lit(1).alias("schema_version"),
        F.first(generated_at).alias("generated_at"),
        F.lit("parquet").alias("format"),
        F.lit(CODEC).alias("compression"),
        as_map("bytes").alias("tables"),
        as_map("rows").alias("rows"),
        F.sum("bytes").alias("total_parquet_bytes"),
        F.lit(requested_bytes).alias("requested_bytes"),
    )


def write_manifest(manifest: DataFrame, root: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").json(f"{root}/_manifest")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return read_records(spark, f"{root}/_manifest", MANIFEST)


def manifest_sha(manifest: DataFrame) -> DataFrame:
    """Identity of a manifest: digest of its canonical JSON."""
    text = documents.canonical(F.to_json(F.struct(*manifest.columns)))
    return manifest.select(F.sha2(text, 256).alias("manifest_sha256"))


def manifest_rows(manifest: DataFrame) -> DataFrame:
    """(table, rows, bytes) of a manifest."""
    return manifest.select(F.explode("rows").alias("table", "rows"), "tables").select(
        "table", "rows", F.try_element_at("tables", F.col("table")).alias("bytes")
    )


def bronze_files(spark: SparkSession, root: str) -> DataFrame:
    """(table, path, length) of the stored files; the first folder below the root is the table."""
    name = F.regexp_extract("path", r"/([^/_][^/]*)/(?:from-[0-9]+/)?[^/]+\.parquet$", 1)
    return stored_files(spark, root).select(name.alias("table"), "path", "length")


def require_tables(files: DataFrame) -> None:
    """Every table has files, and no file belongs to another; the message counts foreign files, however many."""
    known = F.col("table").isin(*TABLES)
    row = files.agg(
        F.collect_set(F.when(known, F.col("table"))).alias("found"),
        F.count_if(~F.coalesce(known, F.lit(False))).alias("foreign"),
        F.min(F.when(~F.coalesce(known, F.lit(False)), F.col("path"))).alias("example"),
    ).first()
    missing = sorted(set(TABLES) - set(row["found"]))
    if missing or row["foreign"]:
        raise ValueError(f"bronze tables differ: missing {missing}; {row['foreign']} files of no table, such as {row['example']}")


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table's finished segments; files of a lost write are in no ledger row and are not read."""
    paths = bronze_paths(read_ledger(spark, root), table)
    if not paths:
        raise ValueError(f"{root} has no finished segment of {table}")
    return read_table(spark, SCHEMAS[table], paths)


def stored_schemas(spark: SparkSession, root: str) -> dict[str, StructType]:
    """Columns of each table's finished segments as their files hold them."""
    ledger = read_ledger(spark, root)
    found = {table: bronze_paths(ledger, table) for table in TABLES}
    return {table: stored_schema(spark, paths) for table, paths in found.items() if paths}


def segment_footers(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Footers of the files of each table's finished segments."""
    ledger = read_ledger(spark, root)
    found = {table: bronze_paths(ledger, table) for table in TABLES}
    return {table: file_footers(spark, paths) for table, paths in found.items() if paths}


def bronze_paths(ledger: DataFrame, table: str) -> list[str]:
    """Folders of a table's finished segments: a few per table, however many files they hold."""
    rows = ledger.where(F.col("table") == table).select("path").distinct().orderBy("path").collect()
    return [row["path"] for row in rows]
