"""Parquet tables and small JSON records."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Codec and sizes of stored tables.
CODEC = "zstd"
CODEC_LEVEL = 1
FILE_TARGET_BYTES = 128 * 1024**2
ROW_GROUP_BYTES = 128 * 1024**2


def write_table(frame: DataFrame, path: str, max_records: int | None = None) -> int:
    """Overwrite a Parquet table; returns the rows written, counted during the write."""
    seen = Observation()
    writer = (
        frame.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", CODEC)
        .option("parquet.compression.codec.zstd.level", str(CODEC_LEVEL))
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
    )
    if max_records:
        writer = writer.option("maxRecordsPerFile", str(max_records))
    writer.parquet(path)
    return seen.get["rows"]


def store_table(frame: DataFrame, path: str) -> DataFrame:
    """The frame's rows as a Parquet table at a new path, for what reads them more than once."""
    frame.write.option("compression", CODEC).option("parquet.compression.codec.zstd.level", str(CODEC_LEVEL)).parquet(path)
    return read_table(frame.sparkSession, frame.schema, path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def write_packed(
    frame: DataFrame, folder: str, order: Sequence[str] = (), max_records: int | None = None, target: int = FILE_TARGET_BYTES
) -> tuple[int, str]:
    """Write a table below a folder in files of about the target size; returns its rows and where it lies.

    What the tasks wrote stays if it is at most twice as many files as needed, none twice too large.
    Otherwise it is read again with scan tasks of the target size and written one file a task: the
    scan packs small files and cuts large ones by their bytes, so no row is shuffled, and the first
    files go. Rows are sorted within each file. An empty table is one file without rows.
    """
    spark, parts = frame.sparkSession, f"{folder}/parts"

    def placed(rows: DataFrame) -> DataFrame:
        return rows.sortWithinPartitions(*order) if order else rows

    count = write_table(placed(frame), parts, max_records)
    found = stored_files(spark, parts).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.max("length").alias("longest")
    ).first()
    if found["files"] <= 2 * max(1, math.ceil(found["bytes"] / target)) and (found["longest"] or 0) <= 2 * target:
        return count, parts
    per_file = max(1, 5 * target * count // (4 * max(1, found["bytes"])))
    packing = {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    with settings(spark, packing):
        write_table(placed(read_table(spark, frame.schema, parts)), f"{folder}/packed", per_file)
    delete_path(spark, parts)
    return count, f"{folder}/packed"


def write_partitions(frame: DataFrame, path: str, *columns: str, keep_others: bool = False) -> None:
    """Write a Parquet table partitioned by columns, small partitions in one file and large ones split.

    The folder is replaced, or with `keep_others` only the partitions that the frame has.
    """
    (
        frame.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if keep_others else "static")
        .option("compression", CODEC)
        .option("parquet.compression.codec.zstd.level", str(CODEC_LEVEL))
        .partitionBy(*columns)
        .parquet(path)
    )


#: Rows that one task of `spread` takes, and how few are worth a task of their own while cores are idle.
ROWS_PER_TASK, LEAST_ROWS_PER_TASK = 250_000, 10_000


def spread(frame: DataFrame, rows: int) -> DataFrame:
    """The frame's rows, about `rows` of them, dealt evenly to tasks by their number.

    A scan is cut by bytes and row groups. A compressed file of narrow rows is then one task,
    however much each row costs behind it; dealing the narrow rows is cheap against that.
    """
    idle = min(frame.sparkSession.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS_PER_TASK))
    tasks = max(idle, -(-rows // ROWS_PER_TASK))
    return frame.repartition(tasks) if tasks > 1 else frame


def read_table(spark: SparkSession, schema: StructType, paths: str | Sequence[str]) -> DataFrame:
    """Every Parquet file below the paths, with a declared schema (no inference)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
    )


def stored_schema(spark: SparkSession, paths: str | Sequence[str]) -> StructType:
    """Columns that the files below the paths hold: those of all footers, read by tasks."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.option("mergeSchema", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
        .schema
    )


def stored_files(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """(path, length) of the files below the paths; reads the listing, not the files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(paths)
        .select("path", "length")
    )


def _summary(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, from the file system's summary; no task runs."""
    return _summary(spark, path).getLength()


#: Files whose footers one task reads.
FOOTERS_PER_TASK = 1_000


def file_footers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, columns, rows) of every Parquet file below the paths, each from its own footer, read by tasks.

    A merged schema hides a file that lacks a column: it reads as NULL there. Names are in the order
    of the file; files that are no Parquet fail the job.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.column(0).to_pylist()
            footers = []
            for name in named:
                local = name.startswith("file:")  # such a name may hold characters that no URI has
                system, place = (fs.LocalFileSystem(), name[5:]) if local else fs.FileSystem.from_uri(name)
                with system.open_input_file(place) as file:
                    footers.append(pq.ParquetFile(file).metadata)
            columns = [footer.schema.to_arrow_schema().names for footer in footers]
            rows = [footer.num_rows for footer in footers]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns, pa.list_(pa.string())), pa.array(rows, pa.int64())], names=["path", "columns", "rows"]
            )

    tasks = max(spark.sparkContext.defaultParallelism, sum(_summary(spark, path).getFileCount() for path in paths) // FOOTERS_PER_TASK)
    return stored_files(spark, paths).select("path").coalesce(tasks).mapInArrow(task, "path string, columns array<string>, rows long")


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count per table from Parquet footers alone: count(*) is pushed into the V2 source.

    Leaves the session setting for that pushdown on; it is read when the result is executed.
    """
    v1_sources = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(v1_sources)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(v1_sources, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        counts = [
            spark.read.parquet(path)
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(table).alias("table"), "rows")
            for table, path in paths.items()
        ]
    finally:
        spark.conf.set(v1_sources, before)
    return reduce(DataFrame.unionByName, counts)


def append_record(records: DataFrame, path: str) -> None:
    """Append rows to a log of JSON records; each append is one file and appears whole."""
    records.coalesce(1).write.mode("append").json(path)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one of that name; tells whether it did."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = system.create(target, False)
    except Py4JJavaError:
        if system.exists(target):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in place of any of that name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))
