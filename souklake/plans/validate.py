"""Validation by lifecycle phase: which rules apply to which state.

setup: operational tables; history: bronze; cdc: landing; batch: the published lake. Every phase
returns (rule, violations); `require_clean` raises on the first state that is not clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souklake.operators import checks
from souklake.plans import publish
from souklake.plans.history import OVERSHOOT
from souklake.schemas import DIMENSIONS, FACTS, GOLD_SCHEMAS, TABLES, Domain
from souklake.sources import bronze
from souklake.sources.landing import batch_tags, broken_lines, read_landing, read_landing_lines

RULE = "rule string, violations long"


class ValidationError(AssertionError):
    """A phase has violations."""


def _constant(spark: SparkSession, found: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(found.items()), RULE)


def setup_rules(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    domain: Domain = Domain(),
    stored: dict[str, StructType] | None = None,
    footers: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Operational state: schema, entity universe, live ids, relations between facts.

    `stored` and `footers` are what the files of an exported copy hold. Tables read over JDBC show
    the database's own schema, so they need neither.
    """
    dimensions = {table: tables[table] for table in DIMENSIONS}
    transactions = tables["transactions"]
    return checks.union(
        [
            checks.schema_rules(spark, stored or {table: frame.schema for table, frame in tables.items()}),
            *([checks.file_rules(footers)] if footers else []),
            checks.universe_rules(spark, dimensions, domain),
            checks.format_rules(tables, kinds=("live",)),
            checks.item_vendor_rule(tables["transaction_products"], transactions),
            checks.two_items_rule(tables["transaction_products"], transactions),
            checks.payment_order_rule(tables["PaymentProcessingEvents"], transactions),
            checks.prediction_order_rule(tables["RiskModelPredictions"], transactions),
        ]
    )


def manifest_rules(spark: SparkSession, root: str) -> DataFrame:
    """Stored bytes lie within the budget and its overshoot, and agree with the manifest."""
    stored = bronze.bronze_files(spark, root).agg(
        F.sum("length").alias("bytes"),
        F.array_sort(F.collect_set("table")).alias("stored_tables"),
    )
    claimed = bronze.read_manifest(spark, root).select(
        "requested_bytes",
        "total_parquet_bytes",
        F.array_sort(F.map_keys("rows")).alias("claimed_tables"),
    )
    both = stored.unionByName(claimed, allowMissingColumns=True)
    one = both.agg(*[F.max(name).alias(name) for name in both.columns])
    expected = F.array_sort(F.array(*[F.lit(t) for t in TABLES]))
    requested = F.col("requested_bytes")
    return checks.tally(
        one,
        {
            "bronze size": ~F.col("bytes").between(requested, requested * OVERSHOOT),
            "manifest bytes": ~F.col("bytes").eqNullSafe(F.col("total_parquet_bytes")),
            "bronze tables": ~F.col("stored_tables").eqNullSafe(expected),
            "manifest tables": ~F.col("claimed_tables").eqNullSafe(expected),
        },
    )


def history_rules(spark: SparkSession, root: str, domain: Domain = Domain()) -> DataFrame:
    """Bronze: manifest, cardinalities, formats, references and relations over whole tables."""
    tables = {table: bronze.read_bronze(spark, root, table) for table in TABLES}
    counts = bronze.manifest_rows(bronze.read_manifest(spark, root))
    rows = {row["table"]: row["rows"] for row in counts.collect()}  # ten rows
    transactions = tables["transactions"]
    return checks.union(
        [
            manifest_rules(spark, root),
            checks.schema_rules(spark, bronze.stored_schemas(spark, root)),
            checks.file_rules(bronze.segment_footers(spark, root)),
            checks.cardinality_rules(counts, domain),
            checks.universe_rules(spark, {t: tables[t] for t in DIMENSIONS}, domain),
            checks.format_rules(tables, kinds=("history",), history_rows=rows),
            checks.relation_rules(tables),
            checks.border_rules(transactions),
            checks.history_item_rules(tables["transaction_products"], domain),
        ]
    )


def tag_rule(spark: SparkSession, root: str) -> DataFrame:
    """Batches whose stored lines are not as many as their tags say."""
    said = batch_tags(spark, root).groupBy("batch").agg(F.sum("event_count").alias("said"))
    stored = read_landing(spark, root).groupBy("batch").agg(F.count(F.lit(1)).alias("stored"))
    both = said.join(stored, "batch", "full")
    return checks.tally(both, {"batch tags": ~F.col("said").eqNullSafe(F.col("stored"))})


def landing_rules(spark: SparkSession, root: str) -> DataFrame:
    """Landing: envelopes are whole, and every table is one of the ten."""
    lines = read_landing_lines(spark, root)
    some = lines.agg((F.count(F.lit(1)) == 0).cast("bigint").alias("violations"))
    return checks.union(
        [
            some.select(F.lit("landing is empty").alias("rule"), "violations"),
            checks.tally(lines, {"landing table": ~F.col("table").isin(*TABLES)}),
            checks.count_rows("broken line", broken_lines(spark, root)),
            tag_rule(spark, root),
            checks.envelope_rules(lines),
        ]
    )


def silver_rules(
    spark: SparkSession, lake: str, snapshot_counts: DataFrame, manifest: DataFrame
) -> DataFrame:
    """Published silver: table set, columns, counts and the manifest it was built from."""
    batch_id = publish.current_batch(spark, lake)
    tables = publish.read_layer(spark, lake, "silver", batch_id)
    records = publish.table_records(spark, lake, batch_id).where("layer = 'silver'")
    history = bronze.manifest_rows(manifest).select("table", "rows")
    is_fact = F.col("table").isin(*FACTS)
    expected = snapshot_counts.join(history.withColumnRenamed("rows", "_h"), "table", "left").select(
        "table", (F.col("rows") + F.when(is_fact, F.coalesce("_h", F.lit(0))).otherwise(0)).alias("expected")
    )
    counted = checks.union(
        [frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows") for t, frame in tables.items()]
    )
    compared = expected.join(counted, "table", "left").join(
        records.select("table", "manifest_sha256"), "table", "left"
    )
    sha = bronze.manifest_sha(manifest).first()["manifest_sha256"]
    return checks.union(
        [
            checks.schema_rules(spark, publish.stored_schemas(spark, lake, "silver", batch_id)),
            checks.file_rules(publish.stored_footers(spark, lake, "silver", batch_id)),
            checks.tally(
                compared,
                {
                    "silver counts": ~F.col("rows").eqNullSafe(F.col("expected")),
                    "silver manifest": ~F.col("manifest_sha256").eqNullSafe(F.lit(sha)),
                },
            ),
        ]
    )


def gold_rules(spark: SparkSession, lake: str) -> DataFrame:
    """Published gold: models, columns, rows, one batch id, no unpublished batch left over."""
    batch_id = publish.current_batch(spark, lake)
    records = publish.table_records(spark, lake, batch_id)
    gold = publish.read_layer(spark, lake, "gold", batch_id)
    found = {"gold models": len(set(GOLD_SCHEMAS) ^ set(gold))}
    for model, stored in publish.stored_schemas(spark, lake, "gold", batch_id).items():
        found[f"{model} columns"] = int(stored.names != GOLD_SCHEMAS[model].names)
    left = spark.createDataFrame([(name,) for name in publish.batches(spark, lake)], "batch_id string")
    staged = left.join(publish.publication_log(spark, lake), "batch_id", "left_anti")
    empty = [
        checks.count_rows(f"{model} empty", frame.agg(F.count(F.lit(1)).alias("n")).where("n = 0"))
        for model, frame in gold.items()
    ]
    # Gold lies in the batch whole; silver also reads history where it is.
    inside = F.exists("paths", lambda p: F.contains(p, F.lit(f"{publish.batch_root(lake, batch_id)}/")))
    other = ~F.col("batch_id").eqNullSafe(F.lit(batch_id)) | ((F.col("layer") == "gold") & ~inside)
    one = checks.tally(records, {"one batch": F.coalesce(other, F.lit(True))})
    files = checks.file_rules(publish.stored_footers(spark, lake, "gold", batch_id), GOLD_SCHEMAS)
    return checks.union([_constant(spark, found), files, checks.count_rows("staged batches", staged), *empty, one])


def batch_rules(
    spark: SparkSession, lake: str, bronze_root: str, snapshot_counts: DataFrame
) -> DataFrame:
    """The published lake as a whole."""
    silver, gold = publish.read_layer(spark, lake, "silver"), publish.read_layer(spark, lake, "gold")
    return checks.union(
        [
            silver_rules(spark, lake, snapshot_counts, bronze.read_manifest(spark, bronze_root)),
            gold_rules(spark, lake),
            checks.reconcile_rules(silver, gold),
        ]
    )


def require_clean(rules: DataFrame) -> int:
    """Raise with the broken rules, else return how many rules were checked."""
    checked = rules.collect()  # one row per rule
    broken = {row["rule"]: row["violations"] for row in checked if row["violations"]}
    if broken:
        raise ValidationError(f"violations: {broken}")
    return len(checked)

