"""Small numeric, time and risk expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the risk bucket and what follows from it.
RISK_HIGH = 0.7
RISK_MEDIUM = 0.3


def ratio(number: Column, by: float) -> Column:
    """Division in double, whatever the inputs are."""
    return number.cast("double") / F.lit(float(by))


def real(value: Column) -> Column:
    return value.cast("float")


def timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def risk_bucket(probability: Column, medium: float = RISK_MEDIUM, high: float = RISK_HIGH) -> Column:
    return F.when(probability >= high, "high").when(probability >= medium, "medium").otherwise("low")


def recommendation(bucket: Column) -> Column:
    return F.when(bucket == "high", "manual_review").otherwise("approve")


def iso_text(ts: Column, fraction_digits: int | None = None) -> Column:
    """ISO text of a zone-less timestamp, with a fixed count of fraction digits or, by default,
    with microseconds only when there are any.

    Works on the text of the value: `date_format` would pass through the session time zone.
    """
    text = ts.cast("string")
    base = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    digits = F.rpad(F.substring(text, 21, 6), fraction_digits or 6, "0")
    dotted = F.concat(base, F.lit("."), digits)
    return dotted if fraction_digits else F.when(F.length(text) > 19, dotted).otherwise(base)


def iso_instant(ts: Column, millis: bool = False) -> Column:
    """ISO text with a trailing Z."""
    return F.concat(iso_text(ts, 3 if millis else None), F.lit("Z"))


def route(crosses: Column) -> Column:
    return F.when(crosses, "multi-hop").otherwise("direct")


def border_label(crosses: Column) -> Column:
    return F.when(crosses, "cross-border").otherwise("domestic")


def text_count(value: Column) -> Column:
    """Numeric-looking text as a count; NULL and '' are 0."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("0")).cast("bigint")
