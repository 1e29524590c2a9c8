"""Data-quality rules over whole tables.

Every rule is an aggregation that returns (rule, violations); nothing is sampled. Rules on one
table share one pass. Foreign keys are counted per value before the anti join, so a value that a
third of the rows hold is one row there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souklake.functions import keys, values
from souklake.operators import synth
from souklake.schemas import (
    FACT_IDS,
    PRIMARY_KEYS,
    PRODUCT_KEY,
    REFERENCES,
    SCHEMAS,
    TABLES,
    Domain,
)

# Row changes each business event causes, and one second of events.
ROW_CHANGES = {
    "purchase": 7,
    "buyer_session": 1,
    "payment_update": 1,
    "risk_prediction": 1,
    "transaction_status_update": 1,
}
SECOND_OF_EVENTS = {
    "purchase": 6,
    "buyer_session": 8,
    "payment_update": 3,
    "risk_prediction": 2,
    "transaction_status_update": 1,
}
PRICE_TOLERANCE = 0.01
ENVELOPE_KEYS = ("schema_version", "event_id", "ingested_at", "source", "change")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def tally(frame: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Several rules over one table in one pass; NULL conditions are no violation."""
    counted = frame.agg(
        *[F.count_if(condition).alias(f"_{n}") for n, condition in enumerate(conditions.values())]
    )
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.col(f"_{n}").alias("violations"))
            for n, rule in enumerate(conditions)
        ]
    )
    return counted.select(F.explode(rows).alias("_r")).select("_r.*")


def count_rows(rule: str, offending: DataFrame) -> DataFrame:
    return offending.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(rule).alias("rule"), "violations"
    )


# schemas and identifiers --------------------------------------------------------------------


def schema_rules(
    spark: SparkSession, actual: dict[str, StructType], wanted: dict[str, StructType] = SCHEMAS
) -> DataFrame:
    """Table set, column names in order, column types, given the schemas as they are stored.

    A frame that was read with a declared schema shows that schema, so its own says nothing here.
    """
    found = [("table set", len(set(wanted) ^ set(actual)))]
    for table, expected in wanted.items():
        if table in actual:
            stored = actual[table]
            types = [f.dataType for f in stored] != [f.dataType for f in expected]
            found.append((f"{table} columns", int(stored.names != expected.names)))
            found.append((f"{table} types", int(types)))
    return spark.createDataFrame(found, "rule string, violations long")


def file_rules(footers: dict[str, DataFrame], wanted: dict[str, StructType] = SCHEMAS) -> DataFrame:
    """Per table, the files whose own columns are not the table's, of (path, columns, rows) a file.

    The merged schema of `schema_rules` shows a column as soon as one file has it.
    """
    return union(
        [
            tally(files, {f"{table} files": ~F.col("columns").eqNullSafe(F.array(*[F.lit(name) for name in wanted[table].names]))})
            for table, files in footers.items()
        ]
    )


def _universe_number(table: str, domain: Domain) -> Column:
    """Number of a dimension row in the generated domain, NULL of a key that no number has."""
    if table == "products":
        vendor = keys.key_number(F.col("SellerPointer"), keys.VENDOR_KEY)
        age = F.col("ListingAge")
        place = F.when(age == 0, domain.products_per_vendor).otherwise(age)
        number = (vendor - 1) * domain.products_per_vendor + place
        made = keys.product_key(number, domain.products_per_vendor)
    else:
        column, key = _KEY_FORMATS[table]
        number = keys.key_number(F.col(column), key)
        made = {column: keys.padded(key[0], number, key[1])}
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(value) for c, value in made.items()])
    return F.when(same & (number > 0), number)


def universe_rules(
    spark: SparkSession, dimensions: dict[str, DataFrame], domain: Domain = Domain()
) -> DataFrame:
    """Dimension keys equal the generated domain, in both directions.

    A key is a number of the domain, so a table is a bitmap of 4 KiB for 32,768 numbers, built
    map-side: no key is shuffled, and repeated keys count once. Keys that no number has count by
    row.
    """
    found = []
    for table, frame in dimensions.items():
        size = domain.dimension_rows()[table]
        numbers = frame.select(_universe_number(table, domain).alias("i"))
        placed = numbers.select(
            F.coalesce(F.bitmap_bucket_number("i"), F.lit(-1)).alias("page"),
            F.coalesce(F.col("i").between(1, size), F.lit(False)).alias("inside"),
            F.coalesce(F.bitmap_bit_position("i"), F.lit(0)).alias("bit"),
        )
        pages = placed.groupBy("page", "inside").agg(
            F.bitmap_construct_agg("bit").alias("bits"), F.count(F.lit(1)).alias("rows")
        )
        distinct = F.when(F.col("page") == -1, F.col("rows")).otherwise(F.bitmap_count("bits"))
        totals = pages.agg(
            (F.lit(size) - F.coalesce(F.sum(F.when(F.col("inside"), distinct)), F.lit(0))).alias("missing"),
            F.coalesce(F.sum(F.when(~F.col("inside"), distinct)), F.lit(0)).alias("unexpected"),
        )
        rows = F.array(
            *[F.struct(F.lit(f"{table} {side}").alias("rule"), F.col(side).alias("violations")) for side in ("missing", "unexpected")]
        )
        found.append(totals.select(F.explode(rows).alias("_r")).select("_r.*"))
    return union(found)


_KEY_FORMATS = {
    "markets": ("PlatCode", keys.MARKET_KEY),
    "vendors": ("SellerKey", keys.VENDOR_KEY),
    "buyers": ("AcqCode", keys.BUYER_KEY),
}


def format_rules(
    frames: dict[str, DataFrame],
    kinds: tuple[str, ...] = ("history", "live"),
    history_rows: dict[str, int] | None = None,
) -> DataFrame:
    """Ids match their pattern as a whole; history numbers lie in 1 … rows when rows are given."""
    patterns = {"history": keys.history_pattern, "live": keys.live_pattern}
    found = []
    for table, (column, key) in _KEY_FORMATS.items():
        if table in frames:
            wrong = ~keys.matches(F.col(column), keys.key_pattern(key))
            found.append(tally(frames[table], {f"{table} id format": F.coalesce(wrong, F.lit(True))}))
    for table, (column, prefix) in FACT_IDS.items():
        if table not in frames:
            continue
        allowed = "|".join(patterns[kind](prefix) for kind in kinds)
        wrong = F.coalesce(~keys.matches(F.col(column), allowed), F.lit(True))
        rules = {f"{table} id format": wrong}
        if history_rows and table in history_rows:
            number = keys.history_number(F.col(column), prefix)
            rules[f"{table} id domain"] = ~number.between(1, history_rows[table])
        found.append(tally(frames[table], rules))
    return union(found)


#: Fixed value: keys that one task holds at once where the number of rows is known.
KEYS_PER_TASK = 500_000


def primary_key_rules(frames: dict[str, DataFrame], rows: dict[str, int] | None = None) -> DataFrame:
    """Keys that occur more than once.

    A task holds the keys it counts, and a shuffle is cut by its compressed bytes, which say little of
    their number. With the `rows` of a table (or more) its keys are dealt so that a task has few.
    """

    def dealt(table: str, frame: DataFrame) -> DataFrame:
        tasks = -(-(rows or {}).get(table, 0) // KEYS_PER_TASK)
        keyed = frame.select(*PRIMARY_KEYS[table])
        return keyed.repartition(tasks, *PRIMARY_KEYS[table]) if tasks > 1 else keyed

    return union(
        [
            count_rows(
                f"{table} primary key",
                dealt(table, frame).groupBy(*PRIMARY_KEYS[table]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"),
            )
            for table, frame in frames.items()
        ]
    )


# relations between facts --------------------------------------------------------------------


def item_vendor_rule(items: DataFrame, transactions: DataFrame) -> DataFrame:
    """Item vendor differs from the transaction's."""
    joined = items.select("EventLink", "SellerPointer").join(
        transactions.select("EventCode", "VendorLink"), F.col("EventLink") == F.col("EventCode")
    )
    return count_rows("item vendor", joined.where(F.col("SellerPointer") != F.col("VendorLink")))


def two_items_rule(items: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions with other than two items; items are counted before the join."""
    lines = items.groupBy("EventLink").agg(F.count(F.lit(1)).alias("lines"))
    joined = transactions.select("EventCode").join(
        lines, F.col("EventCode") == F.col("EventLink"), "left"
    )
    return count_rows("two items", joined.where(F.coalesce("lines", F.lit(0)) != 2))


def _predates(
    rule: str, events: DataFrame, reference: str, moment: str, transactions: DataFrame
) -> DataFrame:
    joined = events.select(reference, moment).join(
        transactions.select("EventCode", "EventTimestamp"), F.col(reference) == F.col("EventCode")
    )
    return count_rows(rule, joined.where(F.col(moment) < F.col("EventTimestamp")))


def payment_order_rule(payments: DataFrame, transactions: DataFrame) -> DataFrame:
    return _predates(
        "payment predates transaction", payments, "transaction_ref", "event_timestamp", transactions
    )


def prediction_order_rule(predictions: DataFrame, transactions: DataFrame) -> DataFrame:
    return _predates(
        "prediction predates transaction",
        predictions,
        "txn_link_ref",
        "prediction_timestamp",
        transactions,
    )


def reference_rules(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows whose foreign key (NULL included) has no parent, per reference."""
    found = []
    for child, columns, parent, parent_columns in REFERENCES:
        if child not in frames or parent not in frames:
            continue
        used = frames[child].groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        known = frames[parent].select(
            *[F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True)]
        )
        orphans = used.join(known, list(columns), "left_anti")
        found.append(
            orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
                F.lit(f"{child}.{columns[-1]} -> {parent}").alias("rule"), "violations"
            )
        )
    return union(found)


def _dimension_references(frames: dict[str, DataFrame]) -> DataFrame:
    """References to other parents than transactions, all in one aggregate and one shuffle.

    Referring rows and parents meet in the group of their parent table and key, folded map-side; a
    group without a parent is all orphans. A reference is a counter, the first, second … of its parent.
    """
    references = [r for r in REFERENCES if r[2] != "transactions"]
    parents = list(dict.fromkeys((parent, columns) for _, _, parent, columns in references))
    places, rules = {}, {}
    for reference in references:
        parent = parents.index(reference[2:])
        places[reference] = (parent, sum(p == parent for p, _ in places.values()))
        rules[places[reference]] = f"{reference[0]}.{reference[1][-1]} -> {reference[2]}"
    slots = 1 + max(slot for _, slot in places.values())

    def value(columns: tuple[str, ...]) -> Column:
        whole = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])
        return F.when(whole, F.concat_ws("\u0001", *[F.col(c).cast("string") for c in columns]))

    def row(parent: int, slot: int | None, columns: tuple[str, ...]) -> Column:
        return F.struct(F.lit(parent).alias("parent"), F.lit(slot).cast("int").alias("slot"), value(columns).alias("key"))

    rows = []
    for child in dict.fromkeys(child for child, *_ in references):  # a table is read once, whatever it refers to
        named = [row(*places[r], r[1]) for r in references if r[0] == child]
        rows.append(frames[child].select(F.explode(F.array(*named)).alias("_r")).select("_r.*"))
    for number, (parent, columns) in enumerate(parents):  # no reference equals a key that is not whole
        rows.append(frames[parent].select(row(number, None, columns).alias("_r")).select("_r.*").where("key IS NOT NULL"))
    counters = [F.count_if(F.col("slot") == slot).alias(f"_n{slot}") for slot in range(slots)]
    met = union(rows).groupBy("parent", "key").agg(F.count_if(F.col("slot").isNull()).alias("_known"), *counters)
    orphans = met.where("_known = 0").groupBy("parent").agg(*[F.sum(f"_n{slot}").alias(f"_n{slot}") for slot in range(slots)])
    counts = [
        F.struct(F.lit(rule).alias("rule"), F.col(f"_n{slot}").alias("violations"), F.lit(parent).alias("of"))
        for (parent, slot), rule in rules.items()
    ]
    return orphans.select("parent", F.explode(F.array(*counts)).alias("_r")).where("parent = _r.of").select("_r.rule", "_r.violations")


def relation_rules(frames: dict[str, DataFrame]) -> DataFrame:
    """References, vendors, item counts and order of times, with one shuffle of the transactions.

    What names a transaction is one narrow row: the number of its kind, the transaction, and the vendor or
    time that the rules compare. The rows, with the item count of each transaction among them, join the
    transactions once (adaptive execution splits a hot transaction, no aggregate stands between),
    and all rules are counted in one aggregate. The values are those of the separate rules.
    """
    kinds = {
        "transaction_products": ("EventLink", "SellerPointer", None),
        "PaymentProcessingEvents": ("transaction_ref", None, "event_timestamp"),
        "RiskModelPredictions": ("txn_link_ref", None, "prediction_timestamp"),
        "risk_analytics": ("TxnLink", None, None),
    }
    numbers = {kind: n for n, kind in enumerate((*kinds, "lines"))}

    def narrow(frame: DataFrame, kind: str, ref: str, vendor: str | None, moment: str | None, lines: Column) -> DataFrame:
        return frame.select(
            F.lit(numbers[kind]).cast("tinyint").alias("kind"),
            keys.key_hash(ref).alias("ref_hash"),
            F.col(ref).alias("ref"),
            (F.col(vendor) if vendor else F.lit(None).cast("string")).alias("vendor"),
            (F.col(moment) if moment else F.lit(None).cast("timestamp_ntz")).alias("moment"),
            lines.cast("bigint").alias("lines"),
        )

    children = [narrow(frames[t], t, *columns, F.lit(None)) for t, columns in kinds.items()]
    counted = frames["transaction_products"].groupBy("EventLink").agg(F.count(F.lit(1)).alias("_lines"))
    children.append(narrow(counted, "lines", "EventLink", None, None, F.col("_lines")))
    transactions = frames["transactions"].select(keys.key_hash("EventCode").alias("EventCode_hash"), "EventCode", "VendorLink", "EventTimestamp")
    same = (F.col("ref_hash") == F.col("EventCode_hash")) & (F.col("ref") == F.col("EventCode"))
    joined = union(children).join(transactions, same, "left")
    orphan = F.col("EventCode").isNull()
    early = F.col("moment") < F.col("EventTimestamp")

    def of(kind: str) -> Column:
        return F.col("kind") == numbers[kind]

    rules = {
        "item vendor": of("transaction_products") & (F.col("vendor") != F.col("VendorLink")),
        "payment predates transaction": of("PaymentProcessingEvents") & early,
        "prediction predates transaction": of("RiskModelPredictions") & early,
    }
    for child, columns, parent, _ in REFERENCES:
        if parent == "transactions":
            rules[f"{child}.{columns[-1]} -> {parent}"] = of(child) & orphan
    # Transactions with two items, taken off all of them: the rest, those without an item too, break the rule.
    pairs = of("lines") & (F.col("lines") == 2) & ~orphan
    found = tally(joined, rules | {"two items": pairs}).select(
        "rule", F.when(F.col("rule") == "two items", -F.col("violations")).otherwise(F.col("violations")).alias("violations")
    )
    every = count_rows("two items", frames["transactions"])
    names = [f"{c}.{columns[-1]} -> {parent}" for c, columns, parent, _ in REFERENCES if parent != "transactions"]
    quiet = every.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("rule"), F.lit(0).cast("bigint").alias("violations")
    )
    parts = union([found, every, quiet, _dimension_references(frames)])
    return parts.groupBy("rule").agg(F.sum("violations").alias("violations"))


def border_rules(transactions: DataFrame) -> DataFrame:
    """Border flag, route and label agree with the region pair; an unknown region is a region."""
    crosses = ~F.col("OriginRegion").eqNullSafe(F.col("DestRegion"))
    return tally(
        transactions,
        {
            "border flag": ~F.col("CrossBorder").eqNullSafe(crosses.cast("bigint")),
            "border route": ~F.col("RouteComplex").eqNullSafe(values.route(crosses)),
            "border label": ~F.col("Border_cross_border_pre").eqNullSafe(values.border_label(crosses)),
        },
    )


def history_item_rules(items: DataFrame, domain: Domain = Domain()) -> DataFrame:
    """Product, quantity and price of history items, worked out from the transaction number.

    Row-wise: the number fixes vendor, products and amount, so no join is needed.
    """
    number = keys.history_number(F.col("EventLink"), "EVT")
    expected = [
        keys.product_key(
            synth.history_products(number, F.lit(line), domain), domain.products_per_vendor
        )
        for line in (1, 2)
    ]
    is_line = [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(key[c]) for c in PRODUCT_KEY])
        for key in expected
    ]
    share = F.when(is_line[0], synth.LINE_SHARES[0]).otherwise(synth.LINE_SHARES[1])
    price = synth.amount(number) * share
    off = F.abs(F.col("PriceAmt").cast("double") - price) > PRICE_TOLERANCE
    vendor = keys.vendor_key(keys.cycle(number, domain.vendors))
    return tally(
        items,
        {
            "item id": number.isNull(),
            "item product": ~(is_line[0] | is_line[1]),
            "item vendor number": ~F.col("SellerPointer").eqNullSafe(vendor),
            "item price": F.coalesce((F.col("QtySold") != 1) | off, F.lit(True)),
        },
    )


# counts -------------------------------------------------------------------------------------


def _as_one_row(counts: DataFrame) -> DataFrame:
    """(table, rows) as one row with a column per table."""
    return counts.agg(
        *[F.max(F.when(F.col("table") == t, F.col("rows"))).alias(t) for t in TABLES]
    )


def cardinality_rules(counts: DataFrame, domain: Domain = Domain()) -> DataFrame:
    """Dimension sizes, two items per transaction, risk within transactions, minimum domain."""
    conditions = {
        f"{table} cardinality": F.col(table) != rows
        for table, rows in domain.dimension_rows().items()
    }
    conditions |= {
        "items per transaction": F.col("transaction_products") != 2 * F.col("transactions"),
        "transaction domain": F.col("transactions") < domain.reference_rows,
        "risk domain": F.col("risk_analytics") < domain.reference_rows,
        "risk within transactions": F.col("risk_analytics") > F.col("transactions"),
    }
    failed = {rule: F.coalesce(condition, F.lit(True)) for rule, condition in conditions.items()}
    return tally(_as_one_row(counts), failed)


def state_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and live identifiers per table."""
    found = []
    for table, frame in tables.items():
        column, prefix = FACT_IDS.get(table, (None, None))
        live = F.count_if(F.col(column).like(f"{prefix}-LIVE-%")) if column else F.lit(None).cast("bigint")
        found.append(
            frame.agg(F.count(F.lit(1)).alias("rows"), live.alias("live_ids")).select(
                F.lit(table).alias("table"), "rows", "live_ids"
            )
        )
    return union(found)


def state_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    old = before.select("table", F.col("rows").alias("_rows"), F.col("live_ids").alias("_live"))
    return after.join(old, "table").select(
        "table",
        (F.col("rows") - F.col("_rows")).alias("new_rows"),
        (F.col("live_ids") - F.col("_live")).alias("new_live_ids"),
    )


def event_mix(events: DataFrame) -> DataFrame:
    """Business events by kind and the row changes they must cause."""
    weights = F.create_map(*[F.lit(v) for pair in ROW_CHANGES.items() for v in pair])
    return events.groupBy("event").agg(F.count(F.lit(1)).alias("events")).select(
        "event",
        "events",
        (F.col("events") * F.try_element_at(weights, F.col("event")).cast("bigint")).alias("row_changes"),
    )


def delivery_totals(envelopes: DataFrame) -> DataFrame:
    """Landed changes, distinct event ids, and changes outside the known tables."""
    return envelopes.agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_distinct("event_id").alias("event_ids"),
        F.count_if(~F.col("table").isin(*TABLES)).alias("unknown_table"),
    )


# landing ------------------------------------------------------------------------------------


def envelope_rules(lines: DataFrame) -> DataFrame:
    """Raw landing lines (`value`) with the `table` of their path."""
    line = F.col("value")
    names = F.json_object_keys(line)
    expected = F.array(*[F.lit(name) for name in ENVELOPE_KEYS])
    wrong_keys = ~F.sort_array(names).eqNullSafe(F.sort_array(expected))

    def text(path: str) -> Column:
        return F.coalesce(F.get_json_object(line, path), F.lit(""))

    inner = F.get_json_object(text("$.change"), "$.table")
    return tally(
        lines,
        {
            "envelope keys": wrong_keys,
            "event id": ~keys.matches(text("$.event_id"), "[0-9a-f]{64}"),
            "change table": ~inner.eqNullSafe(F.col("table")),
            "source position": (text("$.source.lsn") == "") | (text("$.source.xid") == ""),
        },
    )


# silver and gold ----------------------------------------------------------------------------


def reconcile_rules(silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> DataFrame:
    """Gold cardinalities and totals against silver; a violation is the absolute difference.

    Each table and each model is read once, for all rules that it takes part in.
    """
    rows = F.count(F.lit(1))

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    counted = ("daily_market_metrics", "vendor_risk_summary", "buyer_360")
    amounts = {model: {f"{model} transactions": total("transaction_count")} for model in counted}
    amounts["vendor_risk_summary"]["vendor cardinality"] = rows
    amounts["buyer_360"]["buyer cardinality"] = rows
    amounts["product_performance"] = {"product cardinality": rows, "product units": total("units_sold")}
    expected = {
        "transactions": {f"{model} transactions": rows for model in counted},
        "vendors": {"vendor cardinality": rows},
        "buyers": {"buyer cardinality": rows},
        "products": {"product cardinality": rows},
        "transaction_products": {"product units": rows},
    }

    def signed(frame: DataFrame, sides: dict[str, Column], sign: int) -> DataFrame:
        found = frame.agg(*[amount.alias(f"_{n}") for n, amount in enumerate(sides.values())])
        parts = [F.struct(F.lit(rule).alias("rule"), (F.col(f"_{n}") * sign).alias("n")) for n, rule in enumerate(sides)]
        return found.select(F.explode(F.array(*parts)).alias("_r")).select("_r.*")

    parts = [signed(gold[model], sides, 1) for model, sides in amounts.items()]
    parts += [signed(silver[table], sides, -1) for table, sides in expected.items()]
    return union(parts).groupBy("rule").agg(F.abs(F.sum("n")).alias("violations"))
