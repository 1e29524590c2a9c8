"""Given tables -> source-shaped views (see FIXTURES.md). Whole tables, built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from souklake.functions.keys import padded, pick
from souklake.functions.values import ratio
from souklake.sources.tables import spread


#: Fixed value: lines that one task folds to items or products.
ROWS_PER_FOLD = 500_000


def live_id(prefix: str, kind: str, number: Column) -> Column:
    """A live identifier: uuid-shaped digest of the number."""
    digest = F.md5(F.concat(F.lit(f"{kind}:"), number.cast("string")))
    places = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    uuid = F.concat_ws("-", *[F.substring(digest, start, length) for start, length in places])
    return F.concat(F.lit(f"{prefix}-LIVE-"), uuid)


class Given:
    """Lazy views over one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}

    def raw(self, table: str) -> DataFrame:
        if table not in self._read:
            self._read[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self._read[table]

    def rows(self, table: str) -> int:
        """Rows of a table, counted from its footers."""
        if table not in self._rows:
            self._rows[table] = self.raw(table).count()
        return self._rows[table]

    def dealt(self, table: str) -> DataFrame:
        """A table whose rows are dealt evenly to tasks, for row-wise work that costs more than the scan."""
        return spread(self.raw(table), self.rows(table))

    # dimensions -----------------------------------------------------------------------------

    def markets(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            padded("PLAT-", key, 3).alias("PlatCode"),
            F.col("n_name").alias("PlatName"),
            F.when(key % 3 == 0, "marketplace").otherwise("specialized").alias("PlatformType"),
            F.to_json(
                F.struct(F.lit("compliant").alias("status"), F.col("n_regionkey").alias("region"))
            ).alias("platform_compliance"),
        )

    def vendors(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            padded("SELLER-", key, 6).alias("SellerKey"),
            F.when(key % 7 == 0, "").otherwise((key % 5000).cast("string")).alias("TotalTxns"),
            (key % 4900).alias("CompletedTxns"),
            F.lit("2024-01-01").cast("timestamp_ntz").alias("LastActiveDt"),
        )

    def buyers(self) -> DataFrame:
        return self.raw("customer").select(
            padded("BUYER-", F.col("c_custkey"), 7).alias("AcqCode"),
            (F.col("c_custkey") % 100).alias("PurchaseCount"),
            F.col("c_mktsegment").alias("AuthLevel"),
            F.to_json(
                F.struct(F.col("c_acctbal").alias("score"), F.col("c_nationkey").alias("segment"))
            ).alias("buyer_risk_profile"),
        )

    def _lines(self, *columns: str) -> DataFrame:
        """Lines with the product names of their part; suppliers stay numbers until rows are grouped.

        A task holds what it folds, so lines are dealt by order, not folded in a scan task of any size.
        """
        tasks = max(1, -(-self.rows("lineitem") // ROWS_PER_FOLD))
        part = self.raw("part").select("p_partkey", "p_type", "p_brand", "p_size")
        lines = self.raw("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            *columns,
            "l_orderkey",
            "l_suppkey",
            F.col("p_type").alias("ProdCat"),
            F.col("p_brand").alias("Subcategory"),
            F.col("p_size").cast("bigint").alias("ListingAge"),
        )
        return lines.repartition(tasks, "l_orderkey")

    def products(self) -> DataFrame:
        return (
            self._lines("l_partkey")
            .groupBy("ProdCat", "Subcategory", "ListingAge", "l_suppkey")
            .agg(F.max("l_partkey").alias("top"))
            .select(
                "ProdCat",
                "Subcategory",
                "ListingAge",
                padded("SELLER-", F.col("l_suppkey"), 6).alias("SellerPointer"),
                F.to_json(
                    F.struct((F.col("top") % 500).alias("stock"), F.lit(True).alias("available"))
                ).alias("product_availability"),
            )
        )

    # facts ----------------------------------------------------------------------------------

    def order_vendor(self) -> DataFrame:
        """Lowest supplier per order."""
        return self.raw("lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("sk"))

    def transactions(self) -> DataFrame:
        orders = self.raw("orders")
        region = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        origin = (
            self.raw("supplier")
            .join(region, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select("s_suppkey", F.col("r_name").alias("origin"))
        )
        destination = (
            self.raw("customer")
            .join(region, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", F.col("r_name").alias("destination"))
        )
        joined = (
            orders.join(self.order_vendor(), F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .join(origin, F.col("sk") == F.col("s_suppkey"), "left")
            .join(destination, F.col("o_custkey") == F.col("c_custkey"), "left")
        )
        key = F.col("o_orderkey")
        amount = F.to_json(
            F.struct(
                F.col("o_totalprice").alias("amount"),
                F.lit("USD").alias("currency"),
                F.col("o_orderstatus").alias("status"),
            )
        )
        crosses = F.col("origin") != F.col("destination")
        return joined.select(
            padded("EVT-HIST-", key, 14).alias("EventCode"),
            F.col("o_orderdate").alias("EventTimestamp"),
            padded("PLAT-", key % 25, 3).alias("PlatformKey"),
            F.when(F.col("sk") % 10 != 9, padded("SELLER-", F.col("sk"), 6)).alias("VendorLink"),
            padded("BUYER-", F.col("o_custkey"), 7).alias("AcqLink"),
            F.col("origin").alias("OriginRegion"),
            F.col("destination").alias("DestRegion"),
            crosses.cast("bigint").alias("CrossBorder"),
            F.when(crosses, "multi-hop").otherwise("direct").alias("RouteComplex"),
            F.when(crosses, "cross-border").otherwise("domestic").alias("Border_cross_border_pre"),
            F.when(key % 11 == 0, '{"amount":"n/a"}').otherwise(amount).alias(
                "transaction_financials"
            ),
        )

    def items(self) -> DataFrame:
        """Lines of one order and product, folded where the lines of an order are."""
        return (
            self._lines("l_quantity", "l_extendedprice")
            .groupBy("l_orderkey", "ProdCat", "Subcategory", "ListingAge", "l_suppkey")
            .agg(F.max("l_extendedprice").alias("price"), F.sum("l_quantity").alias("qty"))
            .select(
                padded("EVT-HIST-", F.col("l_orderkey"), 14).alias("EventLink"),
                "ProdCat",
                "Subcategory",
                "ListingAge",
                padded("SELLER-", F.col("l_suppkey"), 6).alias("SellerPointer"),
                F.col("price").cast("float").alias("PriceAmt"),
                F.col("qty").cast("bigint").alias("QtySold"),
            )
        )

    def sessions(self) -> DataFrame:
        kind = F.col("event_type")
        return self.dealt("events").select(
            padded("BSA-HIST-", F.col("event_id"), 14).alias("BSA_id"),
            padded("BUYER-", F.col("user_id"), 7).alias("acq_ref"),
            F.col("ts").alias("session_start_time"),
            F.floor("value").cast("int").alias("session_duration_seconds"),
            kind.isin("click", "purchase").alias("checkout_initiated"),
            F.when(kind != "error", kind == "purchase").alias("checkout_completed"),
        )

    def payments(self) -> DataFrame:
        lines = self.raw("lineitem")
        order = W.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        )
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        return lines.withColumn("n", F.row_number().over(order)).select(
            padded("PPE-HIST-", F.col("l_orderkey") * 1000 + F.col("n"), 14).alias("PPE_id"),
            padded("EVT-HIST-", F.col("l_orderkey"), 14).alias("transaction_ref"),
            F.col("l_shipdate").alias("event_timestamp"),
            F.when(flag == "R", "declined")
            .when(flag == "N", "settled")
            .when(status == "F", "failed")
            .otherwise("authorized")
            .alias("processing_stage"),
            F.col("n").alias("retry_count"),
            F.col("l_quantity").cast("int").alias("processing_time_ms"),
        )

    def risk(self) -> DataFrame:
        """Orders without a stated priority have not been assessed."""
        score = (F.col("o_orderkey") * 17) % 1000
        return self.dealt("orders").where(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
            padded("EVT-HIST-", F.col("o_orderkey"), 14).alias("TxnLink"),
            ratio(score, 1000).cast("float").alias("FraudProb"),
            F.when(score >= 700, "high").when(score >= 300, "medium").otherwise("low").alias("ML_Risk"),
        )

    def predictions(self) -> DataFrame:
        """One prediction per order; pending orders were predicted the day before."""
        key = F.col("o_orderkey")
        day = F.expr("interval 1 day")
        return self.dealt("orders").select(
            padded("RMP-HIST-", key, 14).alias("RMP_id"),
            padded("EVT-HIST-", key, 14).alias("txn_link_ref"),
            F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") - day)
            .otherwise(F.col("o_orderdate") + day)
            .alias("prediction_timestamp"),
        )

    # operational events ---------------------------------------------------------------------

    def purchases(self) -> DataFrame:
        """A live purchase per order that has lines; its lowest supplier is the vendor."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        probability = F.least(F.lit(0.99), ratio((key * 17) % 1000, 1000))
        return self.raw("orders").join(
            self.order_vendor(), F.col("o_orderkey") == F.col("l_orderkey")
        ).select(
            live_id("EVT", "purchase", key).alias("event_code"),
            live_id("PPE", "payment", key).alias("payment_id"),
            F.timestamp_add("SECOND", key % 86400, F.col("o_orderdate")).alias("purchased_at"),
            padded("PLAT-", 1 + key % 10, 3).alias("platform_key"),
            padded("SELLER-", F.col("sk") + 1, 6).alias("vendor_key"),
            padded("BUYER-", customer + 1, 7).alias("buyer_key"),
            pick(key, "NA", "EU", "APAC", "LATAM").alias("origin"),
            pick(customer, "NA", "EU", "APAC", "LATAM").alias("destination"),
            F.col("o_totalprice").alias("amount"),
            probability.alias("fraud_probability"),
            pick(key, "normal", "elevated", "burst").alias("velocity"),
            ratio((key * 37) % 10_000, 100).cast("string").alias("geo_score"),
            pick(customer, "card", "wallet", "bank_transfer").alias("payment_method"),
            pick(key, "nova-pay", "orbit-pay").alias("processor"),
            F.upper(F.substring(F.md5(key.cast("string")), 1, 12)).alias("authorization_code"),
            (customer % 4 != 0).alias("three_ds"),
            (25 + key % 876).alias("processing_time_ms"),
            (key % 6).alias("risk_indicators"),
            (key % 9).alias("linked_events"),
            (1 + key % 5).alias("chain_length"),
            (1 + key % 2500).alias("wallet_age_days"),
        )

    def visits(self) -> DataFrame:
        key, kind = F.col("event_id"), F.col("event_type")
        return self.dealt("events").select(
            live_id("BSA", "session", key).alias("session_id"),
            padded("BUYER-", F.col("user_id") + 1, 7).alias("buyer_key"),
            F.col("ts").alias("started_at"),
            (8 + key % 1793).alias("duration"),
            (1 + key % 35).alias("pages"),
            (key % 15).alias("products_wanted"),
            (F.col("user_id") % 5).alias("additions_wanted"),
            kind.isin("click", "purchase", "view").alias("wants_checkout"),
            kind.isin("purchase", "view").alias("completes_checkout"),
            (key % 9).alias("searches"),
            pick(key, "direct", "search", "affiliate", "social").alias("referral"),
            pick(key, "mobile", "desktop", "tablet").alias("device"),
            pick(key, "NA", "EU", "APAC", "LATAM").alias("region"),
            F.col("value").alias("scroll_depth"),
            (key % 3).alias("errors"),
            (8 + key % 113).cast("double").alias("value_per_product"),
        )

    def scores(self) -> DataFrame:
        """Scores of the live purchases."""
        key = F.col("o_orderkey")

        def share(factor: int) -> Column:
            return ratio((key * factor) % 1000, 1000)

        return self.dealt("orders").select(
            live_id("RMP", "prediction", key).alias("prediction_id"),
            live_id("EVT", "purchase", key).alias("event_code"),
            F.timestamp_add("SECOND", key % 86400 + 60, F.col("o_orderdate")).alias("predicted_at"),
            F.least(F.lit(0.99), share(13)).alias("probability"),
            (0.65 + ratio(key % 340, 1000)).alias("confidence"),
            pick(key, "velocity", "amount", "device", "behavior").alias("top_factor"),
            (1 + key % 8).alias("factors"),
            share(3).alias("velocity_weight"),
            share(5).alias("amount_weight"),
            share(7).alias("device_weight"),
            share(11).alias("behavior_weight"),
            (2 + key % 94).alias("latency_ms"),
            (0.6 + ratio(key % 400, 1000)).alias("agreement"),
            share(2).alias("drift"),
        )

    def settlements(self) -> DataFrame:
        """Payment updates: the first line of the order numbered like the user."""
        return self.raw("events").select(
            padded("PPE-HIST-", F.col("user_id") * 1000 + 1, 14).alias("payment_id"),
            F.col("ts").alias("settled_at"),
            (5 + F.col("event_id") % 116).alias("latency_ms"),
        )

    def completions(self) -> DataFrame:
        return self.raw("events").select(
            padded("EVT-HIST-", F.col("user_id"), 14).alias("event_code"),
            F.col("ts").alias("completed_at"),
        )

    # change feed ----------------------------------------------------------------------------

    def changes(self) -> DataFrame:
        """Row changes as a log decoder hands them over; purchases are delivered twice."""
        return change_feed(self.dealt("events"))


def change_feed(events: DataFrame) -> DataFrame:
    """Change rows (lsn, xid, raw, ingested_at) from event rows; works on streams as well."""
    key, kind = F.col("event_id"), F.col("event_type")
    table = (
        F.when(kind == "purchase", "transactions")
        .when(kind == "view", "BuyerSessionAnalytics")
        .when(kind == "click", "PaymentProcessingEvents")
        .when(kind == "signup", "buyers")
    )
    action = F.when(key % 17 == 0, "D").when(key % 10 == 0, "U").otherwise("I")

    def column(name: str, kind_name: str, value: Column) -> Column:
        return F.concat(
            F.lit(f'{{"name":"{name}","type":"{kind_name}","value":'), value.cast("string"), F.lit("}")
        )

    images = F.concat(
        F.lit("["),
        column("id", "bigint", F.col("user_id")),
        F.lit(","),
        column("amount", "numeric", F.col("value").cast("decimal(18,2)")),
        F.lit("]"),
    )
    place = F.when(table.isNull(), "").otherwise(
        F.concat(F.lit(',"schema":"public","table":"'), table, F.lit('"'))
    )
    field = F.when(action == "D", "identity").otherwise("columns")
    raw = F.concat(
        F.lit('{"action":"'), action, F.lit('"'), place, F.lit(',"'), field, F.lit('":'), images, F.lit("}")
    )
    deliveries = F.when(kind == "purchase", 2).otherwise(1)
    # Changes are captured twice a day: the morning's in the hour of 18, the rest in that of 6.
    until_capture = F.when(F.hour("ts") < 12, 18).otherwise(30) - F.hour("ts")
    return events.select(
        F.concat(F.lit("0/"), F.hex(key + 256)).alias("lsn"),
        F.call_function("div", key, F.lit(5)).cast("string").alias("xid"),
        raw.alias("raw"),
        F.timestamp_add("HOUR", until_capture, F.col("ts")).alias("ingested_at"),
        F.explode(F.sequence(F.lit(1), deliveries)).alias("delivery"),
    ).drop("delivery")


def eventful_feed(events: DataFrame) -> DataFrame:
    """Change rows with truncates, deletes, key changes and left-out columns, one delivery each."""
    key, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")
    amount = F.col("value").cast("decimal(18,2)")
    table = (
        F.when(kind == "purchase", "transactions")
        .when(kind == "view", "BuyerSessionAnalytics")
        .when(kind == "click", "PaymentProcessingEvents")
        .when(kind == "signup", "buyers")
        .otherwise("vendors")
    )
    action = F.when(key % 1000 == 500, "T").when(key % 17 == 0, "D").when(key % 10 == 0, "U").otherwise("I")
    moves, leaves_out = (action == "U") & (key % 20 == 0), (action == "U") & (key % 20 == 10)

    def image(name: str, *columns: Column) -> Column:
        return F.struct(F.array(*columns).alias(name))

    def column(name: str, kind_name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(kind_name).alias("type"), value.cast("decimal(18,2)").alias("value"))

    whole = column("amount", "numeric", amount)
    new = F.when(leaves_out, F.array(column("id", "bigint", user))).otherwise(
        F.array(column("id", "bigint", F.when(moves, user + 100_000).otherwise(user)), whole)
    )
    old = F.when(
        leaves_out, F.array(column("id", "bigint", user), column("amount", "numeric", amount + 1))
    ).when(moves | (action == "D"), F.array(column("id", "bigint", user), whole))
    raw = F.to_json(
        F.struct(
            action.alias("action"),
            F.lit("public").alias("schema"),
            table.alias("table"),
            F.when(action.isin("I", "U"), new).alias("columns"),
            old.alias("identity"),
        )
    )
    return events.select(
        F.concat(F.lit("0/"), F.hex(key + 256)).alias("lsn"),
        F.call_function("div", key, F.lit(5)).cast("string").alias("xid"),
        raw.alias("raw"),
        F.date_trunc("MONTH", F.col("ts")).cast("timestamp_ntz").alias("ingested_at"),  # captured once a month
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

