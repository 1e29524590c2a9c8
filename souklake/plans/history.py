"""History job: measure widths, plan the rows of every table once, write them, write the manifest."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from souklake.operators.synth import history_rows, row_numbers
from souklake.schemas import TABLES, Domain
from souklake.session import run_folder
from souklake.sources import bronze
from souklake.sources.tables import FILE_TARGET_BYTES, delete_path, path_exists, stored_bytes, write_table

# Share of the byte budget per table, budget, probe, accepted overshoot.
TABLE_WEIGHTS = {
    "markets": 0.005,
    "vendors": 0.02,
    "buyers": 0.02,
    "products": 0.08,
    "transactions": 0.25,
    "transaction_products": 0.25,
    "BuyerSessionAnalytics": 0.12,
    "PaymentProcessingEvents": 0.12,
    "risk_analytics": 0.055,
    "RiskModelPredictions": 0.08,
}
DEFAULT_BUDGET = 5 * 1024**3
PROBE_ROWS = 100_000
OVERSHOOT = 1.05
LAST = TABLES[-1]

# Sizes are aimed at the middle of the accepted range, so that an estimate may err to both sides.
AIM = (1 + OVERSHOOT) / 2

# A segment is one Spark write and the unit of resumption, so it is bounded.
SEGMENT_FILES = 10_000


def plan_sizes(widths: DataFrame, budget: int, domain: Domain = Domain()) -> DataFrame:
    """Target bytes and rows per table from measured bytes per row (`table`, `bytes_per_row`).

    Dimensions have fixed rows, items are two per transaction, the last table takes what the
    others leave.
    """
    fixed = domain.dimension_rows()
    width = {t: F.max(F.when(F.col("table") == t, F.col("bytes_per_row"))) for t in TABLES}
    one = widths.agg(*[width[t].alias(t) for t in TABLES])

    def rows_for(size: Column, table: str) -> Column:
        return F.ceil(size / F.col(table)).cast("bigint")

    target: dict[str, Column] = {}
    rows: dict[str, Column] = {}
    for table, weight in TABLE_WEIGHTS.items():
        target[table] = F.lit(int(budget * weight)).cast("bigint")
        if table in fixed:
            rows[table] = F.lit(fixed[table]).cast("bigint")
        elif table == "transaction_products":
            rows[table] = 2 * rows["transactions"]
        else:
            rows[table] = rows_for(target[table], table)
    used = sum((rows[t] * F.col(t) for t in TABLES if t != LAST), F.lit(0.0))
    target[LAST] = (F.lit(budget) - F.ceil(used)).cast("bigint")
    rows[LAST] = F.greatest(F.lit(0).cast("bigint"), rows_for(target[LAST], LAST))
    lines = [
        F.struct(F.lit(t).alias("table"), target[t].alias("target_bytes"), rows[t].alias("target_rows"))
        for t in TABLES
    ]
    return one.select(F.explode(F.array(*lines)).alias("_p")).select("_p.*")


def measured_widths(spark: SparkSession, root: str, domain: Domain, probe_rows: int = PROBE_ROWS) -> DataFrame:
    """Bytes per row of each table: what the ledger has, else a small write that is not kept."""
    stored = bronze.progress(bronze.read_ledger(spark, root))
    known = stored.select("table", (F.col("bytes") / F.col("rows")).alias("bytes_per_row"))
    begun = {row["table"] for row in known.select("table").collect()}  # at most ten rows
    folder, fixed, probed = run_folder(spark, "probe"), domain.dimension_rows(), []
    for table in (t for t in TABLES if t not in begun):
        rows = min(probe_rows, fixed.get(table, probe_rows))
        write_table(history_rows(row_numbers(spark, 1, rows, 1), table, domain), f"{folder}/{table}")
        probed.append((table, stored_bytes(spark, f"{folder}/{table}") / rows))
    delete_path(spark, folder)
    return known.unionByName(spark.createDataFrame(probed, known.schema))


def write_rows(
    spark: SparkSession, root: str, table: str, first: int, last: int, per_row: float, domain: Domain, file_bytes: int = FILE_TARGET_BYTES
) -> None:
    """Rows first … last as recorded segments of at most `SEGMENT_FILES` files of about `file_bytes`."""
    per_file = max(1, int(file_bytes / per_row))
    step = per_file * SEGMENT_FILES
    for start in range(first, last + 1, step):
        rows = min(step, last + 1 - start)
        numbers = row_numbers(spark, start, rows, math.ceil(rows / per_file))
        write_table(history_rows(numbers, table, domain), bronze.segment_path(root, table, start))
        bronze.record_segment(spark, root, table, start, rows)


def written(spark: SparkSession, root: str) -> dict[str, Row]:
    """Bytes, rows and next row of the tables begun: at most ten rows."""
    found = {row["table"]: row for row in bronze.progress(bronze.read_ledger(spark, root)).collect()}
    if set(found) - set(TABLES):
        raise ValueError(f"the ledger names tables that there are not: {sorted(set(found) - set(TABLES))}")
    return found


def build_history(
    spark: SparkSession,
    root: str,
    budget: int = DEFAULT_BUDGET,
    domain: Domain = Domain(),
    file_bytes: int = FILE_TARGET_BYTES,
    probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """Synthesise all tables below `root`, going on from what the ledger has; returns the manifest.

    A history that has its manifest for this budget is complete. The last table takes what the
    others left, so it is written when their bytes are known.
    """
    if path_exists(spark, f"{root}/_manifest"):
        manifest = bronze.read_manifest(spark, root)
        if manifest.where(F.col("requested_bytes") == budget).count():
            return manifest
    done = written(spark, root)
    widths = measured_widths(spark, root, domain, probe_rows)
    width = {row["table"]: row["bytes_per_row"] for row in widths.collect()}  # ten rows
    plan = plan_sizes(widths, int(budget * AIM), domain)
    rows = {row["table"]: row["target_rows"] for row in plan.collect()}  # ten rows
    rows |= {table: max(rows[table], row["rows"]) for table, row in done.items()}
    rows["transaction_products"] = 2 * rows["transactions"]
    for table in TABLES[:-1]:
        first = done[table]["next_row"] if table in done else 1
        write_rows(spark, root, table, first, rows[table], width[table], domain, file_bytes)
    # Long ranges compress better than the probe, so the last table is planned anew from its own
    # stored width until the budget is filled.
    while True:
        done = written(spark, root)
        stored, last = sum(row["bytes"] for row in done.values()), done.get(LAST)
        if stored >= budget:
            break
        per_row = last["bytes"] / last["rows"] if last else width[LAST]
        start = last["next_row"] if last else 1
        more = math.ceil((budget * AIM - stored) / per_row)
        write_rows(spark, root, LAST, start, start + more - 1, per_row, domain, file_bytes)
    totals = bronze.progress(bronze.read_ledger(spark, root))
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    bronze.write_manifest(bronze.build_manifest(totals, budget, stamp), root)
    return bronze.read_manifest(spark, root)
