"""Operational inserts and updates applied to stored tables, batch after batch.

Tables lie in hash buckets of their key (`souklake.sources.buckets`). A batch of events is folded
per key by the operators in `mutations`, and only the buckets that its keys fall into are rewritten.
Batches are numbered, the same for all tables that a kind of event changes: a batch that was lost
between two tables is applied again under its number and changes the second table only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.operators import mutations
from souklake.schemas import PRIMARY_KEYS, SCHEMAS
from souklake.sources.buckets import BUCKETS, Buckets, Merge


@dataclass(frozen=True)
class Change:
    """What a kind of event does to one table: how its rows name the table's key, and the merge."""

    table: str
    key: tuple[str, ...]
    merge: Merge
    rows: Callable[[DataFrame], DataFrame] = lambda events: events


def _inserted(table: str, rows: Callable[[DataFrame], DataFrame]) -> Change:
    key = PRIMARY_KEYS[table]
    return Change(table, key, lambda old, new: mutations.insert_if_absent(old, new, key), rows)


#: Tables that each kind of event changes. Items of purchases need the products: see `purchase_items`.
KINDS: dict[str, tuple[Change, ...]] = {
    "purchases": (
        _inserted("transactions", mutations.purchase_transactions),
        _inserted("PaymentProcessingEvents", mutations.purchase_payments),
        _inserted("risk_analytics", mutations.purchase_risk),
        Change("buyers", ("buyer_key",), mutations.count_buyer_purchases),
        Change("vendors", ("vendor_key",), mutations.count_vendor_sales),
    ),
    "visits": (_inserted("BuyerSessionAnalytics", mutations.session_rows),),
    "scores": (_inserted("RiskModelPredictions", mutations.prediction_rows),),
    "settlements": (Change("PaymentProcessingEvents", ("payment_id",), mutations.settle_payments),),
    "completions": (Change("transactions", ("event_code",), mutations.complete_transactions),),
}


class Operations:
    """The operational tables below a folder."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict = SCHEMAS, buckets: int = BUCKETS):
        self.spark, self.root, self.schemas, self.buckets = spark, root, schemas, buckets

    def table(self, name: str) -> Buckets:
        return Buckets(self.spark, f"{self.root}/{name}", self.schemas[name], PRIMARY_KEYS[name], self.buckets)

    def load(self, tables: dict[str, DataFrame]) -> None:
        """Store the tables as update 0, unless they have one."""
        for name, frame in tables.items():
            self.table(name).replace(0, frame)

    def apply(self, number: int, kind: str, events: DataFrame) -> dict[str, list[int]]:
        """Apply one numbered batch of events; returns the buckets rewritten of each table.

        Numbers count upwards over all kinds of events.
        """
        return {
            change.table: self.table(change.table).update(
                number, change.rows(events), [F.col(k) for k in change.key], change.merge
            )
            for change in KINDS[kind]
        }

    def apply_items(self, number: int, purchases: DataFrame) -> list[int]:
        """Insert the two items of each purchase; the vendors' products come from the stored table."""
        change = _inserted("transaction_products", lambda events: mutations.purchase_items(events, self.read("products")))
        return self.table(change.table).update(number, change.rows(purchases), [F.col(k) for k in change.key], change.merge)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()
