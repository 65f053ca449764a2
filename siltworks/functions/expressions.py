"""Column expressions shared by the layers. All are Spark built-ins; no Python runs per row."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "NULL"

# Patterns of the format rules (fixed values). ``\z`` because ``$`` would also accept a
# text that ends in a newline.
UNSIGNED_INTEGER = r"^[0-9]+\z"
SIGNED_INTEGER = r"^-?[0-9]+\z"
MONEY_TEXT = r"^[0-9]+(\.[0-9]{1,2})?\z"
UNSIGNED_NUMBER = r"^[0-9]+(\.[0-9]+)?\z"
SIGNED_NUMBER = r"^-?[0-9]+(\.[0-9]+)?\z"
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?\z"
HEX_TEXT = r"^(0x)?([0-9A-Fa-f]{2})*\z"
NOT_PRINTABLE_ASCII = r"[^\x20-\x7E]"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def null_token(value: Column | str, token: str = NULL_TOKEN) -> Column:
    """The staging text ``NULL`` becomes a real null."""
    return F.nullif(as_column(value), F.lit(token))


def empty_to_null(value: Column | str) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(as_column(value)), F.lit(""))


def strip_characters(value: Column | str, characters: str) -> Column:
    """Remove every listed symbol (thousands separator, percent or currency sign), then trim."""
    return F.trim(F.translate(as_column(value), characters, ""))


def flag_to_int(value: Column | str, cast=None) -> Column:
    """``TRUE``/``FALSE`` text or digits to 1/0."""
    column = as_column(value)
    convert = cast or (lambda c: c.cast("int"))
    # The spelled-out flags are blanked before the cast, so that an ANSI cast never sees them.
    digits = F.when(~column.isin("TRUE", "FALSE"), column)
    return (
        F.when(column == "TRUE", F.lit(1))
        .when(column == "FALSE", F.lit(0))
        .otherwise(convert(digits))
    )


def is_one(value: Column | str) -> Column:
    """1 is true; every other value, null included, is false."""
    return F.coalesce(as_column(value) == 1, F.lit(False))


def full_name(first: Column | str, last: Column | str) -> Column:
    """Null when either part is null, unlike ``concat_ws``."""
    return F.concat(as_column(first), F.lit(" "), as_column(last))


def date_key(value: Column | str) -> Column:
    """Calendar day as the integer YYYYMMDD."""
    day = as_column(value)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def line_amount(price: Column | str, quantity: Column | str, discount: Column | str) -> Column:
    """Price times quantity less discount, rounded once, half away from zero."""
    net = as_column(price) * as_column(quantity) * (F.lit(1) - as_column(discount))
    return net.cast("decimal(12,2)")


def hex_to_binary(value: Column | str, strict: bool = False) -> Column:
    """Decode ``0x…`` text. Malformed text gives null, or fails the job when strict."""
    column = as_column(value)
    digits = F.unhex(F.replace(column, F.lit("0x"), F.lit("")))
    decoded = F.when(column.rlike(HEX_TEXT), digits)
    if not strict:
        return decoded
    bad = F.raise_error(F.concat(F.lit("not hexadecimal: "), column)).cast("binary")
    return F.when(column.isNull(), F.lit(None).cast("binary")).when(column.rlike(HEX_TEXT), digits).otherwise(bad)


def normalised_name(value: Column | str) -> Column:
    """Join key for names: surrounding spaces and letter case do not count."""
    return F.lower(F.trim(as_column(value)))


def is_blank(value: Column | str) -> Column:
    """Null or only spaces, whatever the type."""
    column = as_column(value)
    return column.isNull() | (F.trim(column.cast("string")) == "")


def is_missing(value: Column | str) -> Column:
    """Null or empty text; spaces count as content."""
    column = as_column(value)
    return column.isNull() | (column.cast("string") == "")


def guarded_number(value: Column | str, pattern: str = UNSIGNED_NUMBER, target: str = "decimal(38,10)") -> Column:
    """Number where the text has the pattern, null elsewhere; safe under ANSI casts in any order."""
    column = as_column(value)
    return F.when(column.rlike(pattern), column.try_cast(target))


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality: null equals null."""
    return ~left.eqNullSafe(right)
