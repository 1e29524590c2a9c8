"""Registered queries: library operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StructType

from harness.fixtures import Given, change_feed, eventful_feed
from souklake.functions import documents, values
from souklake.operators import changes, checks, gold, mutations, silver, synth
from souklake.plans import batch, publish, validate
from souklake.plans.operations import KINDS, Operations
from souklake.plans.history import plan_sizes
from souklake.schemas import DIMENSIONS, FACTS, PRIMARY_KEYS, PRODUCT_KEY, TABLES, Domain
from souklake.session import run_folder
from souklake.sources import bronze
from souklake.sources.landing import PARTITIONS, batch_tags, broken_lines, read_landing, read_landing_lines, write_landing
from souklake.sources.snapshot import exported_snapshot
from souklake.sources.tables import append_record, footer_counts, read_table, spread, store_table, stored_files, write_table
from souklake.streaming.landing import distinct_events, drain
from souklake.streaming.replay import State, replay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Given], DataFrame]], Callable[[Given], DataFrame]]:
    """Register a function of the given tables under a name."""

    def register(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Given(spark, sf_dir))
        return build

    return register


def rounded(frame: DataFrame, **digits: int) -> DataFrame:
    """Sums of doubles depend on the order of addition; compare them at a fixed precision."""
    return frame.withColumns({name: F.round(name, places) for name, places in digits.items()})


# gold ---------------------------------------------------------------------------------------


@query("daily_market_metrics")
def _(given: Given) -> DataFrame:
    scored = gold.scored_transactions(given.transactions(), given.risk(), given.payments())
    return rounded(gold.daily_market_metrics(scored), gross_merchandise_value=2)


@query("vendor_risk_summary")
def _(given: Given) -> DataFrame:
    scored = gold.scored_transactions(given.transactions(), given.risk())
    summary = gold.vendor_risk_summary(given.vendors(), scored)
    return rounded(summary, gross_merchandise_value=2, average_fraud_probability=6)


@query("buyer_360")
def _(given: Given) -> DataFrame:
    model = gold.buyer_360(given.buyers(), gold.purchases(given.transactions()), given.sessions())
    return rounded(model, lifetime_value=2, average_session_seconds=6)


@query("product_performance")
def _(given: Given) -> DataFrame:
    return rounded(gold.product_performance(given.products(), given.items()), gross_revenue=2)


# synthesis ----------------------------------------------------------------------------------
# Row numbers come from the keys of a given table, so the work grows with it.

NUMBERS: dict[str, tuple[str, str]] = {
    "markets": ("nation", "n_nationkey"),
    "vendors": ("supplier", "s_suppkey"),
    "buyers": ("customer", "c_custkey"),
    "products": ("part", "p_partkey"),
    "transactions": ("orders", "o_orderkey"),
    "transaction_products": ("orders", "o_orderkey"),
    "BuyerSessionAnalytics": ("events", "event_id"),
    "PaymentProcessingEvents": ("orders", "o_orderkey"),
    "risk_analytics": ("orders", "o_orderkey"),
    "RiskModelPredictions": ("orders", "o_orderkey"),
}
SHORT = {
    "markets": "markets",
    "vendors": "vendors",
    "buyers": "buyers",
    "products": "products",
    "transactions": "transactions",
    "transaction_products": "items",
    "BuyerSessionAnalytics": "sessions",
    "PaymentProcessingEvents": "payments",
    "risk_analytics": "risk",
    "RiskModelPredictions": "predictions",
}
# Payments and predictions go round the first 1,000 transactions here, so that they repeat.
SMALL_CYCLE = Domain(reference_rows=1_000)


def numbers(given: Given, table: str) -> DataFrame:
    source, key = NUMBERS[table]
    number = F.col(key).cast("bigint") + 1
    if table == "transaction_products":
        return given.dealt(source).select(
            F.explode(F.array(2 * number - 1, 2 * number)).alias("i")
        )
    return given.dealt(source).select(number.alias("i"))


def history(given: Given, table: str) -> DataFrame:
    return synth.history_rows(numbers(given, table), table, SMALL_CYCLE)


def seeds(given: Given, table: str) -> DataFrame:
    if table == "products":
        vendor = F.col("s_suppkey").cast("bigint")
        rows = given.raw("supplier").select(
            F.explode(F.sequence(4 * vendor + 1, 4 * vendor + 4)).alias("i")
        )
    else:
        rows = numbers(given, table)
    return synth.seed_rows(rows, table, values.timestamp("2025-06-01"))


for _table, _short in SHORT.items():
    query(f"synth_{_short}")(lambda given, table=_table: history(given, table))
for _table in ("markets", "vendors", "buyers", "products"):
    query(f"seed_{_table}")(lambda given, table=_table: seeds(given, table))


# operational events -------------------------------------------------------------------------


@query("vendor_first_products")
def _(given: Given) -> DataFrame:
    return mutations.vendor_first_products(seeds(given, "products"))


@query("purchase_fanout")
def _(given: Given) -> DataFrame:
    return mutations.purchase_changes(given.purchases())


def live(given: Given, table: str) -> DataFrame:
    """Operational facts: what the live events insert."""
    if table == "transaction_products":
        return mutations.purchase_items(given.purchases(), seeds(given, "products"))
    build, events = {
        "transactions": (mutations.purchase_transactions, given.purchases),
        "BuyerSessionAnalytics": (mutations.session_rows, given.visits),
        "PaymentProcessingEvents": (mutations.purchase_payments, given.purchases),
        "risk_analytics": (mutations.purchase_risk, given.purchases),
        "RiskModelPredictions": (mutations.prediction_rows, given.scores),
    }[table]
    return build(events())


for _table in ("transactions", "transaction_products", "PaymentProcessingEvents", "risk_analytics"):
    query(f"purchase_{SHORT[_table]}")(lambda given, table=_table: live(given, table))
query("session_features")(lambda given: live(given, "BuyerSessionAnalytics"))
query("risk_bucket")(lambda given: live(given, "RiskModelPredictions"))


@query("insert_if_absent")
def _(given: Given) -> DataFrame:
    """Seed vendors 6 … n+5 into the vendors 1 … n that history has."""
    shifted = given.raw("supplier").select((F.col("s_suppkey") + 6).alias("i"))
    incoming = synth.seed_rows(shifted, "vendors", values.timestamp("2025-06-01"))
    return mutations.insert_if_absent(history(given, "vendors"), incoming, ("SellerKey",))


@query("buyer_counter_update")
def _(given: Given) -> DataFrame:
    updated = mutations.count_buyer_purchases(history(given, "buyers"), given.purchases())
    profile = F.col("buyer_risk_profile")
    return updated.select(
        "AcqCode",
        "ProfileAge",
        "PurchaseCount",
        "AuthLevel",
        F.get_json_object(profile, "$.fingerprint").alias("fingerprint"),
        documents.number_at(profile, "$.score").alias("score"),
        F.get_json_object(profile, "$.last_purchase_at").alias("last_purchase_at"),
    )


@query("vendor_counter_update")
def _(given: Given) -> DataFrame:
    return mutations.count_vendor_sales(given.vendors(), given.purchases())


@query("payment_settle")
def _(given: Given) -> DataFrame:
    return mutations.settle_payments(given.payments(), given.settlements())


def _financials(frame: DataFrame, document: str, *fields: str) -> DataFrame:
    return frame.select(
        "EventCode", *[F.get_json_object(document, f"$.{field}").alias(field) for field in fields]
    )


@query("transaction_status_patch")
def _(given: Given) -> DataFrame:
    patched = mutations.complete_transactions(given.transactions(), given.completions())
    return _financials(
        patched, "transaction_financials", "amount", "currency", "status", "updated_at"
    )


@query("json_merge")
def _(given: Given) -> DataFrame:
    patch = documents.build(status=F.lit("reviewed"), trace=F.md5("EventCode"))
    merged = given.transactions().withColumn(
        "merged", documents.merge(F.col("transaction_financials"), patch)
    )
    return _financials(merged, "merged", "amount", "currency", "status", "trace")


@query("recent_payments")
def _(given: Given) -> DataFrame:
    return mutations.recent_payments(given.transactions(), given.payments())


# change feed --------------------------------------------------------------------------------

DATABASE = "market"
IMAGE = StructType().add("id", LongType()).add("amount", DecimalType(18, 2))


def envelopes(given: Given) -> DataFrame:
    return changes.envelope(given.changes(), DATABASE, F.col("ingested_at"))


@query("cdc_envelope")
def _(given: Given) -> DataFrame:
    return envelopes(given).select(
        "schema_version",
        "event_id",
        "ingested_at",
        "source.connector",
        "source.service",
        "source.database",
        "source.lsn",
        "source.xid",
        "change",
        "table",
    )


@query("cdc_route")
def _(given: Given) -> DataFrame:
    return envelopes(given).groupBy("table").agg(F.count(F.lit(1)).alias("changes"))


query("cdc_batch_stats")(lambda given: changes.batch_stats(envelopes(given)))


@query("cdc_dedup")
def _(given: Given) -> DataFrame:
    return changes.deduplicate(envelopes(given)).select(
        "event_id", "table", "ingested_at", "source.lsn", "change"
    )


@query("cdc_flatten")
def _(given: Given) -> DataFrame:
    return changes.flatten(envelopes(given), IMAGE).select(
        "event_id",
        "table",
        "action",
        "position",
        F.col("new.id").alias("new_id"),
        F.col("new.amount").alias("new_amount"),
        F.col("old.id").alias("old_id"),
        F.col("old.amount").alias("old_amount"),
    )


@query("cdc_current_state")
def _(given: Given) -> DataFrame:
    return changes.current_rows(envelopes(given), IMAGE, ("id",), by_table=True)


# silver -------------------------------------------------------------------------------------


def snapshot(given: Given, table: str) -> DataFrame:
    return seeds(given, table) if table in DIMENSIONS else live(given, table)


def silver_tables(given: Given) -> dict[str, DataFrame]:
    return silver.silver_tables(
        {table: history(given, table) for table in FACTS},
        {table: snapshot(given, table) for table in TABLES},
    )


for _table in TABLES:
    query(f"silver_{SHORT[_table]}")(
        lambda given, table=_table: silver.silver_table(
            table, history(given, table), snapshot(given, table)
        )
    )


@query("silver_json_as_text")
def _(given: Given) -> DataFrame:
    """History whose JSON column arrives parsed."""
    parsed = history(given, "risk_analytics").withColumn(
        "wallet_risk_assessment",
        F.from_json("wallet_risk_assessment", "wallet_hash string, age_days bigint"),
    )
    return silver.json_as_text(parsed, "risk_analytics")


@query("json_canonical")
def _(given: Given) -> DataFrame:
    """Snapshot documents that were stored with blanks and their keys from last to first."""
    document = F.col("transaction_financials")
    parts = [
        F.concat(F.lit(f' "{name}" :  {quote}'), F.get_json_object(document, f"$.{name}"), F.lit(quote))
        for name, quote in (("trace", '"'), ("status", '"'), ("currency", '"'), ("amount", ""))
    ]
    loose = F.concat(F.lit("{"), F.concat_ws(",\n", *parts), F.lit(" }"))
    stored = history(given, "transactions").withColumn("transaction_financials", loose)
    return silver.canonical_snapshot(stored, "transactions").select("EventCode", "transaction_financials")


@query("silver_gate")
def _(given: Given) -> DataFrame:
    tables = silver_tables(given)
    snapshots = silver.table_counts({table: snapshot(given, table) for table in TABLES})
    histories = silver.table_counts({table: history(given, table) for table in FACTS})
    return silver.count_gate(
        silver.table_counts(tables), silver.expected_counts(snapshots, histories)
    )


# sources and sinks --------------------------------------------------------------------------
# These write what Spark derives from the given tables and read it back.

GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


@query("row_counts")
def _(given: Given) -> DataFrame:
    paths = {table: f"{given.sf_dir}/{table}.parquet" for table in GIVEN_TABLES}
    return footer_counts(given.spark, paths)


@query("parquet_roundtrip")
def _(given: Given) -> DataFrame:
    path = run_folder(given.spark, "roundtrip")
    frame = given.transactions()
    write_table(frame, path)
    return read_table(given.spark, frame.schema, path)


@query("snapshot_scan")
def _(given: Given) -> DataFrame:
    root = run_folder(given.spark, "snapshot")
    write_table(live(given, "PaymentProcessingEvents"), f"{root}/PaymentProcessingEvents")
    return exported_snapshot(given.spark, root, "PaymentProcessingEvents")


_built: dict[tuple[str, str, str], str] = {}


def once(given: Given, purpose: str, build: Callable[[Given, str], None]) -> str:
    """A folder that `build` fills once per session and directory."""
    key = (given.spark.sparkContext.applicationId, given.sf_dir, purpose)
    if key not in _built:
        root = run_folder(given.spark, purpose)
        build(given, root)
        _built[key] = root
    return _built[key]


def bronze_of(given: Given, root: str) -> None:
    """Bronze history in its stored layout, with ledger and manifest."""
    spark = given.spark
    for table in TABLES:
        rows = write_table(history(given, table), bronze.segment_path(root, table, 1))
        bronze.record_segment(spark, root, table, 1, rows)
    totals = bronze.progress(bronze.read_ledger(spark, root))
    total = totals.agg(F.sum("bytes")).first()[0]
    bronze.write_manifest(bronze.build_manifest(totals, total, F.lit("2025-06-01")), root)


def published(given: Given) -> tuple[str, str]:
    """Bronze root and lake of one batch."""

    def build(given: Given, root: str) -> None:
        bronze_of(given, f"{root}/bronze")
        batch.run_batch(
            given.spark, f"{root}/bronze", lambda table: snapshot(given, table), f"{root}/lake"
        )

    root = once(given, "published", build)
    return f"{root}/bronze", f"{root}/lake"


@query("scan_bronze")
def _(given: Given) -> DataFrame:
    root, _ = published(given)
    bronze.require_tables(bronze.bronze_files(given.spark, root))
    return bronze.read_bronze(given.spark, root, "transaction_products")


@query("manifest_rows")
def _(given: Given) -> DataFrame:
    root, _ = published(given)
    return bronze.manifest_rows(bronze.read_manifest(given.spark, root)).select("table", "rows")


@query("batch_lineage")
def _(given: Given) -> DataFrame:
    """Audit record of the batch, one row per published table."""
    _, lake = published(given)
    records = publish.table_records(given.spark, lake, publish.current_batch(given.spark, lake))
    return records.select(
        "layer", "table", "rows", "source", F.element_at("properties", "codec").alias("codec")
    )


@query("published_gold")
def _(given: Given) -> DataFrame:
    """The daily model as readers of the published lake see it."""
    _, lake = published(given)
    model = publish.read_layer(given.spark, lake, "gold")["daily_market_metrics"]
    return rounded(model, gross_merchandise_value=2)


@query("publish_swap")
def _(given: Given) -> DataFrame:
    """Two batches are published one after the other; readers see the second."""
    spark, lake = given.spark, run_folder(given.spark, "swap")
    before = history(given, "vendors")
    after = mutations.count_vendor_sales(before, given.purchases())
    for batch_id, frame in (("first", before), ("second", after)):
        path = f"{publish.batch_root(lake, batch_id)}/silver/vendors"
        rows = write_table(frame, path)
        record = batch.table_record(batch_id, "", "silver", "vendors", rows, "snapshot", [path])
        append_record(
            spark.createDataFrame([record], publish.TABLE_RECORD),
            f"{publish.batch_root(lake, batch_id)}/_tables",
        )
        publish.publish(spark, lake, batch_id)
    return publish.read_layer(spark, lake, "silver")["vendors"]


@query("synth_resume")
def _(given: Given) -> DataFrame:
    """Where synthesis goes on, from a ledger with a segment per thousand rows."""
    ledgers = []
    for table, (source, key) in (("transactions", NUMBERS["transactions"]),
                                 ("BuyerSessionAnalytics", NUMBERS["BuyerSessionAnalytics"])):
        number = F.col(key) + 1
        ledgers.append(
            given.raw(source)
            .groupBy(F.floor(F.col(key) / 1000).alias("segment"))
            .agg(
                F.lit(table).alias("table"),
                F.min(number).alias("row_start"),
                F.count(F.lit(1)).alias("row_count"),
                (F.count(F.lit(1)) * 40).alias("bytes"),
            )
        )
    return bronze.progress(checks.union(ledgers))


@query("synth_plan")
def _(given: Given) -> DataFrame:
    """Sizes for a budget of 1 KiB per line item; a row is taken as ten times its key."""
    widths = [
        history(given, table)
        .agg((F.sum(F.length(F.col(PRIMARY_KEYS[table][0]))) * 10.0 / F.count(F.lit(1))).alias("bytes_per_row"))
        .select(F.lit(table).alias("table"), "bytes_per_row")
        for table in TABLES
    ]
    return plan_sizes(checks.union(widths), given.raw("lineitem").count() * 1024)


# landing ------------------------------------------------------------------------------------


def event_stream(given: Given) -> DataFrame:
    """The events table as a stream of changes."""
    events = (
        given.spark.readStream.schema(given.raw("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(given.sf_dir)
    )
    return change_feed(spread(events, given.rows("events")))


def landed(given: Given) -> str:
    """Landing zone that a stream has drained the change feed into."""

    def build(given: Given, root: str) -> None:
        moment = F.col("ingested_at")
        drain(event_stream(given), f"{root}/zone", f"{root}/checkpoint", DATABASE, ingested_at=moment)

    return f"{once(given, 'drained', build)}/zone"


def landed_batch(given: Given) -> str:
    """Landing zone with one batch that was stored twice, as a retry does."""

    def build(given: Given, root: str) -> None:
        for _attempt in range(2):
            write_landing(envelopes(given), root, "retried")

    return once(given, "retried", build)


@query("land_changes")
def _(given: Given) -> DataFrame:
    return (
        read_landing(given.spark, landed(given))
        .groupBy("table", "ingest_date", "hour")
        .agg(F.count(F.lit(1)).alias("changes"))
    )


@query("cdc_drain")
def _(given: Given) -> DataFrame:
    return read_landing(given.spark, landed(given)).select(
        "schema_version", "event_id", "ingested_at", "source.lsn", "source.xid", "change", "table"
    )


@query("scan_landing")
def _(given: Given) -> DataFrame:
    return read_landing(given.spark, landed_batch(given)).select(
        "schema_version", "event_id", "ingested_at", "source.lsn", "source.xid", "change", "table"
    )


@query("cdc_retry")
def _(given: Given) -> DataFrame:
    """A batch that is stored twice under its number is there once."""
    envelopes_read = read_landing(given.spark, landed_batch(given))
    return envelopes_read.groupBy("table").agg(F.count(F.lit(1)).alias("changes"))


@query("landed_tags")
def _(given: Given) -> DataFrame:
    """Tags that the landed batch left, of the batch that was stored twice."""
    return batch_tags(given.spark, landed_batch(given)).drop("batch")


@query("landing_quarantine")
def _(given: Given) -> DataFrame:
    """Envelopes and broken lines per table of a zone where lines are cut short or are no text."""

    def build(given: Given, root: str) -> None:
        transaction = F.get_json_object("value", "$.source.xid").cast("bigint")
        half = F.substr("value", F.lit(1), F.length("value") / 2)
        noise = F.concat(F.lit("\u0000\ufffd"), F.reverse("value"))
        damaged = F.when(transaction % 7 == 0, half).when(transaction % 11 == 0, noise).otherwise(F.col("value"))
        lines = read_landing_lines(given.spark, landed_batch(given)).withColumn("value", damaged)
        lines.write.partitionBy(*PARTITIONS).option("compression", "gzip").text(root)

    root = once(given, "damaged", build)
    kinds = {"envelopes": read_landing(given.spark, root), "broken": broken_lines(given.spark, root)}
    counts = [
        frame.groupBy("table").agg(F.count(F.lit(1)).alias("lines")).select(F.lit(kind).alias("kind"), "table", "lines")
        for kind, frame in kinds.items()
    ]
    return checks.union(counts)


@query("cdc_stream_dedup")
def _(given: Given) -> DataFrame:
    """Landed deliveries, deduplicated by a stream; deliveries of one event share their time."""
    zone, out = landed(given), run_folder(given.spark, "distinct")
    stream = distinct_events(given.spark, zone, "1 hour").select("event_id", "table", "ingested_at")
    writer = stream.writeStream.format("parquet").option("path", f"{out}/events")
    writer.option("checkpointLocation", f"{out}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return given.spark.read.schema(stream.schema).parquet(f"{out}/events")


#: Tables of the eventful feed, all of one shape.
REPLAYED = {t: (IMAGE, ("id",)) for t in ("transactions", "BuyerSessionAnalytics", "PaymentProcessingEvents", "buyers", "vendors")}


def replayed(given: Given) -> State:
    """State after replaying a landing zone in about four micro-batches.

    The first changes are landed last, and the purchases once more, forty days later.
    """

    def build(given: Given, root: str) -> None:
        feed = eventful_feed(given.dealt("events"))
        late = feed.where("raw LIKE '%\"transactions\"%'").withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 40 days"))
        by_place = F.length("lsn") > 5
        for name, part in (("later", feed.where(by_place)), ("earlier", feed.where(~by_place)), ("repeats", late)):
            write_landing(changes.envelope(part, DATABASE, F.col("ingested_at")), f"{root}/zone", name)
        files = stored_files(given.spark, f"{root}/zone", "*.gz").count()
        state = State(given.spark, f"{root}/state", REPLAYED, buckets=8, segment_bits=10)
        replay(state, f"{root}/zone", f"{root}/checkpoint", files_per_batch=max(1, -(-files // 4))).awaitTermination()

    return State(given.spark, f"{once(given, 'replayed', build)}/state", REPLAYED, buckets=8, segment_bits=10)


@query("cdc_replay_state")
def _(given: Given) -> DataFrame:
    """Stored state of all tables after several micro-batches."""
    state = replayed(given)
    return checks.union([state.current(t).select(F.lit(t).alias("table"), "id", "amount") for t in REPLAYED])


@query("cdc_exact_dedup")
def _(given: Given) -> DataFrame:
    """Every event once, repeats forty days later left out."""
    return replayed(given).deliveries.events().select("table", "source.lsn", "source.xid", "ingested_at")


# stored operations --------------------------------------------------------------------------


def in_two_batches(given: Given, name: str, table: DataFrame, kind: str, events: DataFrame, moment: str) -> DataFrame:
    """A stored table after the earlier and then the later half of the events."""
    operations = Operations(given.spark, run_folder(given.spark, "operations"), {name: table.schema}, buckets=16)
    operations.load({name: table})
    ends = events.agg(F.min(moment).alias("low"), F.max(moment).alias("high")).first()
    middle = F.lit(ends["low"] + (ends["high"] - ends["low"]) / 2)
    change = next(c for c in KINDS[kind] if c.table == name)
    for number, half in enumerate((F.col(moment) < middle, F.col(moment) >= middle), start=1):
        operations.table(name).update(number, change.rows(events.where(half)), [F.col(k) for k in change.key], change.merge)
    return operations.read(name)


@query("stored_payment_settle")
def _(given: Given) -> DataFrame:
    return in_two_batches(given, "PaymentProcessingEvents", given.payments(), "settlements", given.settlements(), "settled_at")


@query("stored_vendor_counters")
def _(given: Given) -> DataFrame:
    return in_two_batches(given, "vendors", given.vendors(), "purchases", given.purchases(), "purchased_at")


@query("stored_transaction_status")
def _(given: Given) -> DataFrame:
    patched = in_two_batches(given, "transactions", given.transactions(), "completions", given.completions(), "completed_at")
    return _financials(patched, "transaction_financials", "amount", "currency", "status", "updated_at")


# validation ---------------------------------------------------------------------------------


def fixture(given: Given) -> dict[str, DataFrame]:
    return {
        "markets": given.markets(),
        "vendors": given.vendors(),
        "buyers": given.buyers(),
        "products": given.products(),
        "transactions": given.transactions(),
        "transaction_products": given.items(),
        "BuyerSessionAnalytics": given.sessions(),
        "PaymentProcessingEvents": given.payments(),
        "risk_analytics": given.risk(),
        "RiskModelPredictions": given.predictions(),
    }


def stored(given: Given, frames: dict[str, DataFrame], **columns: tuple[str, ...]) -> dict[str, DataFrame]:
    """The frames, those named written once with the columns named (all, if none), for rules that read them several times."""
    root = run_folder(given.spark, "stored")
    found = dict(frames)
    for table, names in columns.items():
        found[table] = store_table(frames[table].select(*names or ("*",)), f"{root}/{table}")
    return found


#: What the rules on references and relations read of the tables that they read several times.
RELATED = {
    "transactions": ("EventCode", "PlatformKey", "VendorLink", "AcqLink", "EventTimestamp"),
    "transaction_products": ("EventLink", *PRODUCT_KEY),
}


@query("check_schema")
def _(given: Given) -> DataFrame:
    """Schemas as the files of the bronze history hold them."""
    root, _ = published(given)
    return checks.schema_rules(given.spark, bronze.stored_schemas(given.spark, root))


@query("file_footers")
def _(given: Given) -> DataFrame:
    """Per table of the bronze history: columns and rows as the footers of its files say, and their layouts."""
    root, _ = published(given)
    each = [files.select(F.lit(table).alias("table"), "columns", "rows") for table, files in bronze.segment_footers(given.spark, root).items()]
    found = checks.union(each).withColumn("columns", F.array_join("columns", ","))
    return found.groupBy("table").agg(
        F.max("columns").alias("columns"), F.count_distinct("columns").alias("layouts"), F.sum("rows").alias("rows")
    )


@query("check_universe")
def _(given: Given) -> DataFrame:
    tables = {table: history(given, table) for table in DIMENSIONS}
    return checks.universe_rules(given.spark, tables)


@query("check_id_format")
def _(given: Given) -> DataFrame:
    """History ids are wanted; half the facts are live, and numbers go up to the orders."""
    tables = silver_tables(given)
    rows = {"transactions": given.raw("customer").count()}
    return checks.format_rules(tables, kinds=("history",), history_rows=rows)


@query("check_primary_keys")
def _(given: Given) -> DataFrame:
    sources = {"orders": ("transactions", "risk_analytics", "RiskModelPredictions"), "events": ("BuyerSessionAnalytics",),
               "lineitem": ("products", "transaction_products", "PaymentProcessingEvents"), "customer": ("buyers",)}
    rows = {table: given.rows(source) for source, tables in sources.items() for table in tables}
    return checks.primary_key_rules(fixture(given), rows)


query("check_item_vendor")(lambda given: checks.item_vendor_rule(given.items(), given.transactions()))
query("check_two_items")(lambda given: checks.two_items_rule(given.items(), given.transactions()))
query("check_payment_order")(
    lambda given: checks.payment_order_rule(given.payments(), given.transactions())
)
query("check_prediction_order")(
    lambda given: checks.prediction_order_rule(given.predictions(), given.transactions())
)
query("check_references")(lambda given: checks.reference_rules(stored(given, fixture(given), **RELATED)))
query("check_relations")(lambda given: checks.relation_rules(stored(given, fixture(given), **RELATED)))
query("check_border")(lambda given: checks.border_rules(given.transactions()))


@query("check_item_price")
def _(given: Given) -> DataFrame:
    """History items keep the rules, live items have no history number."""
    return checks.history_item_rules(silver_tables(given)["transaction_products"])


@query("check_cardinality")
def _(given: Given) -> DataFrame:
    counts = silver.table_counts({table: history(given, table) for table in TABLES})
    return checks.cardinality_rules(counts)


@query("check_deltas")
def _(given: Given) -> DataFrame:
    """Rows and live ids that the live events add to the history."""
    before = {table: history(given, table) for table in FACTS}
    return checks.state_deltas(
        checks.state_counts(before),
        checks.state_counts({table: f.unionByName(live(given, table)) for table, f in before.items()}),
    )


@query("check_event_mix")
def _(given: Given) -> DataFrame:
    kinds = {
        "purchase": "purchase",
        "view": "buyer_session",
        "click": "payment_update",
        "signup": "risk_prediction",
        "error": "transaction_status_update",
    }
    names = F.create_map(*[F.lit(v) for pair in kinds.items() for v in pair])
    events = given.raw("events").select(F.element_at(names, F.col("event_type")).alias("event"))
    return checks.event_mix(events)


query("check_deliveries")(lambda given: checks.delivery_totals(envelopes(given)))


@query("check_envelope")
def _(given: Given) -> DataFrame:
    return checks.envelope_rules(read_landing_lines(given.spark, landed_batch(given)))


@query("check_manifest")
def _(given: Given) -> DataFrame:
    root, _ = published(given)
    return validate.manifest_rules(given.spark, root)


@query("check_silver")
def _(given: Given) -> DataFrame:
    root, lake = published(given)
    counts = silver.table_counts({table: snapshot(given, table) for table in TABLES})
    return validate.silver_rules(
        given.spark, lake, counts, bronze.read_manifest(given.spark, root)
    )


@query("check_gold")
def _(given: Given) -> DataFrame:
    _, lake = published(given)
    return validate.gold_rules(given.spark, lake)


@query("gold_reconcile")
def _(given: Given) -> DataFrame:
    tables = stored(given, fixture(given), transaction_products=())
    return checks.reconcile_rules(tables, gold.gold_models(tables))
