"""Identifiers: zero-padded keys, full-match patterns, cyclic picks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix and number width of each identifier.
MARKET_KEY = ("PLAT-", 3)
VENDOR_KEY = ("SELLER-", 6)
BUYER_KEY = ("BUYER-", 7)
CATEGORY_KEY = ("CAT-", 3)
SUBCATEGORY_KEY = ("SUB-", 5)
HISTORY_WIDTH = 14
CATEGORIES = 20
SUBCATEGORIES = 100
UUID_PATTERN = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def padded(prefix: str, number: Column, width: int) -> Column:
    """Prefix and zero-padded number; a wider number keeps all its digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def market_key(number: Column) -> Column:
    return padded(MARKET_KEY[0], number, MARKET_KEY[1])


def vendor_key(number: Column) -> Column:
    return padded(VENDOR_KEY[0], number, VENDOR_KEY[1])


def buyer_key(number: Column) -> Column:
    return padded(BUYER_KEY[0], number, BUYER_KEY[1])


def history_key(prefix: str, number: Column) -> Column:
    return padded(f"{prefix}-HIST-", number, HISTORY_WIDTH)


def product_key(number: Column, products_per_vendor: int) -> dict[str, Column]:
    """The four key columns of product `number` (counted from 1)."""
    return {
        "ProdCat": padded(CATEGORY_KEY[0], number % CATEGORIES, CATEGORY_KEY[1]),
        "Subcategory": padded(SUBCATEGORY_KEY[0], number % SUBCATEGORIES, SUBCATEGORY_KEY[1]),
        "ListingAge": number % products_per_vendor,
        "SellerPointer": vendor_key(1 + whole(number - 1, products_per_vendor)),
    }


def whole(number: Column, by: int) -> Column:
    """Integer division."""
    return F.call_function("div", number, F.lit(by))


def cycle(number: Column, size: int) -> Column:
    """1..size, round and round, for 1, 2, 3, …"""
    return 1 + (number - 1) % size


def pick(number: Column, *options: str) -> Column:
    """Option number `number` modulo the count of options."""
    slot = number % len(options)
    choice = F.lit(options[-1])
    for position in reversed(range(len(options) - 1)):
        choice = F.when(slot == position, options[position]).otherwise(choice)
    return choice


def matches(value: Column, pattern: str) -> Column:
    """True when the whole value, line ends included, matches."""
    return value.rlike(rf"\A(?:{pattern})\z")


def key_pattern(key: tuple[str, int]) -> str:
    return rf"{key[0]}\d{{{key[1]}}}"


def key_number(value: Column, key: tuple[str, int]) -> Column:
    """Number of a key, NULL when the key has another form (or more digits than a number holds)."""
    digits = F.regexp_extract(value, rf"\A{key[0]}(\d{{{key[1]},18}})\z", 1)
    return F.nullif(digits, F.lit("")).cast("bigint")


def history_pattern(prefix: str) -> str:
    return rf"{prefix}-HIST-\d{{{HISTORY_WIDTH}}}"


def live_pattern(prefix: str) -> str:
    return f"{prefix}-LIVE-{UUID_PATTERN}"


def history_number(value: Column, prefix: str) -> Column:
    """Number inside a history id, NULL when the id has another form."""
    digits = F.regexp_extract(value, rf"\A{prefix}-HIST-(\d{{{HISTORY_WIDTH}}})\z", 1)
    return F.nullif(digits, F.lit("")).cast("bigint")


def key_hash(*columns: str) -> Column:
    """Number of a key, to be joined on before the key itself.

    A merge join sorts by its first key, and only eight bytes of that are at hand; keys that begin
    alike would be compared whole, row by row.
    """
    return F.xxhash64(*[F.col(c).cast("string") for c in columns])
