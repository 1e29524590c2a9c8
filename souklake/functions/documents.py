"""JSON text: canonical form, shallow merge, amounts.

The text of a number is part of a stored document, but every JSON parser here turns numbers into
numbers. Numbers are therefore quoted and marked before a document is parsed, and unquoted in the
result. The mark is a control character, which JSON text can only hold as an escape.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
# From where the last match ended: strings and anything else without digits, then one number.
_TO_NUMBER = rf'(?s)\G([^"0-9-]*+(?:{_STRING}[^"0-9-]*+)*+)({_NUMBER})'
_OPEN = r'"\u0001'

_NUMERIC_TEXT = (
    r"(?i)\A\s*([-+]?(?:[0-9]+\.?[0-9]*(?:e[-+]?[0-9]+)?|\.[0-9]+(?:e[-+]?[0-9]+)?|inf|infinity|nan))\s*\z"
)


def _marked(document: Column) -> Column:
    return F.regexp_replace(document, F.lit(_TO_NUMBER), F.lit('$1"\\\\u0001$2"'))


def _unmarked(document: Column) -> Column:
    return F.regexp_replace(document, F.lit(r'"\\u0001([^"]*+)"'), F.lit("$1"))


def _quoted(text: Column) -> Column:
    boxed = F.to_json(F.array(text))
    return F.substr(boxed, F.lit(2), F.length(boxed) - 2)


def _members(document: Column) -> Column:
    """Map of member name to the marked text of its value; NULL if the text is no JSON object."""
    variants = F.from_json(_marked(document), "map<string,variant>")
    return F.transform_values(variants, lambda _name, v: F.coalesce(F.to_json(v), F.lit("null")))


def _float_text(text: Column) -> Column:
    """Shortest text of a double, with an exponent from 1e16 on and below 1e-4."""
    shortest = text.try_cast("double").cast("string")
    exponent = F.regexp_extract(shortest, r"E(-?[0-9]+)\z", 1).try_cast("int")
    plain = F.regexp_replace(shortest.try_cast("decimal(38,21)").cast("string"), r"(?<=[0-9])0+\z", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(shortest, "E", 1), r"\.0\z", "")
    digits = F.abs(exponent).cast("string")
    digits = F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)
    sign = F.when(exponent < 0, F.lit("-")).otherwise(F.lit("+"))
    # Nearly every text has no exponent, so its parts are only worked out where there is one.
    written = F.when(exponent.between(-4, 15), plain).otherwise(F.concat(mantissa, F.lit("e"), sign, digits))
    return F.when(shortest.contains("E"), written).otherwise(shortest)


def _plain_number(text: Column) -> Column:
    """Whole numbers as they are, others as the shortest text of their double."""
    whole = text.rlike(r"\A-?[0-9]+\z")
    return F.when(text == "-0", F.lit("0")).when(whole, text).otherwise(_float_text(text))


def canonical(document: Column) -> Column:
    """Sorted keys and no blanks, numbers at any depth in one form; NULL for NULL or malformed text."""
    pieces = F.split(F.to_json(F.try_parse_json(_marked(document))), r'"\\u0001')

    def numbered(piece: Column, place: Column) -> Column:
        number = F.substring_index(piece, '"', 1)
        rest = F.substr(piece, F.length(number) + 2)
        return F.when(place == 0, piece).otherwise(F.concat(_plain_number(number), rest))

    return F.array_join(F.transform(pieces, numbered), "")


def merge(left: Column, right: Column) -> Column:
    """Shallow merge of two JSON objects; the right side wins, NULL if either is NULL.

    Members keep the place they have on the left, new ones follow, and numbers keep their digits.
    A left side that is no JSON object has nothing to merge into and stays as it is.
    """
    merged = F.map_zip_with(
        _members(left), _members(right), lambda _name, old, new: F.coalesce(new, old)
    )
    written = F.transform(F.map_entries(merged), lambda m: F.concat(_quoted(m["key"]), F.lit(":"), m["value"]))
    whole = _unmarked(F.concat(F.lit("{"), F.array_join(written, ","), F.lit("}")))
    return F.when(right.isNotNull() & _members(left).isNull(), left).otherwise(whole)


def number_at(document: Column, path: str) -> Column:
    """Number (or numeric text) at a path as double, NULL when it is neither.

    Only the text of a number is cast: a cast alone also takes Java forms such as "1d" and "2f".
    """
    text = F.regexp_extract(F.get_json_object(document, path), _NUMERIC_TEXT, 1)
    return text.try_cast("double")


def build(**fields: Column) -> Column:
    """JSON object with the fields in the given order."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
