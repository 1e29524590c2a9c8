"""Operational snapshots: the current rows of the ten tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from souklake.schemas import PRIMARY_KEYS, SCHEMAS, TABLES
from souklake.sources.tables import file_footers, path_exists, read_table, stored_schema


def quoting(spark: SparkSession, url: str) -> Callable[[str], str]:
    """How the database of a URL quotes a name, by its Spark dialect; nothing is connected."""
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier


def jdbc_buckets(table: str, parts: int, quote: Callable[[str], str]) -> list[str]:
    """One predicate per partition. Keys are text, so ranges would be uneven; a hash is not."""
    key = quote(PRIMARY_KEYS[table][0])
    return [f"(hashtext({key}) & 2147483647) % {parts} = {part}" for part in range(parts)]


def jdbc_snapshot(
    spark: SparkSession, table: str, url: str, properties: dict[str, str], parts: int
) -> DataFrame:
    """A table over JDBC, read by `parts` tasks side by side; its columns in schema order.

    The projection is pushed into the query, with names (mixed case) quoted by the dialect.
    """
    quote = quoting(spark, url)
    options = {"fetchsize": "10000", "preferTimestampNTZ": "true", **properties}
    stored = spark.read.jdbc(url, quote(table), predicates=jdbc_buckets(table, parts, quote), properties=options)
    return stored.select(*SCHEMAS[table].names)


def exported_schemas(spark: SparkSession, root: str) -> dict[str, StructType]:
    """Columns of an exported copy as its files hold them; a table without a folder is left out."""
    return {table: stored_schema(spark, f"{root}/{table}") for table in TABLES if path_exists(spark, f"{root}/{table}")}


def exported_footers(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Footers of the files of an exported copy."""
    return {table: file_footers(spark, f"{root}/{table}") for table in TABLES if path_exists(spark, f"{root}/{table}")}


def exported_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of one exported, mutually consistent copy (`<root>/<table>/*.parquet`)."""
    return read_table(spark, SCHEMAS[table], f"{root}/{table}")
