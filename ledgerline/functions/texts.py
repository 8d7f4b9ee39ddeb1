"""Text to number and number to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = "decimal(38,10)"


def strict_cast(value: Column, data_type: str, what: str, required: bool = False) -> Column:
    """Cast that raises on text that does not fit, whatever the session's ANSI setting."""
    converted = value.try_cast(data_type)
    bad = value.isNotNull() & converted.isNull()
    if required:
        bad = value.isNull() | bad
    message = F.concat(F.lit(f"{what}: cannot use "), F.coalesce(value.cast("string"), F.lit("null")))
    return F.when(bad, F.raise_error(message).cast(data_type)).otherwise(converted)


def parse_locale_decimal(text: Column, strict: bool = True) -> Column:
    """Number written with "." for thousands and "," for decimals; null is 0.

    Text that is no number raises, or gives null with ``strict=False``.
    """
    plain = F.replace(F.replace(F.coalesce(text, F.lit("0")), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    if strict:
        return strict_cast(plain, NUMBER, "locale number")
    return plain.try_cast(NUMBER)


def tolerant_number(value: Column) -> Column:
    """Number of a text or numeric column; null or anything unreadable is 0."""
    return F.coalesce(value.try_cast(NUMBER), F.lit(0).cast(NUMBER))


def format_brl(units: Column) -> Column:
    """``R$ 1.234,56`` from units; null is 0."""
    number = F.format_number(F.coalesce(units.cast("double"), F.lit(0.0)), 2)
    return F.concat(F.lit("R$ "), F.translate(number, ",.", ".,"))


def format_brl_cents(cents: Column) -> Column:
    """``R$ 1.234,56`` from cents; null is 0."""
    return format_brl(cents.cast("double") / 100)


def format_quantity(quantity: Column) -> Column:
    """No decimals and no thousands mark, half to even."""
    return F.replace(F.format_number(F.coalesce(quantity.cast("double"), F.lit(0.0)), 0), F.lit(","), F.lit(""))


def format_units(quantity: Column, unit: str) -> Column:
    """Whole part of the quantity and its unit."""
    whole = F.coalesce(quantity, F.lit(0)).cast("bigint")
    return F.concat(whole.cast("string"), F.lit(f" {unit}"))


def format_day(moment: Column) -> Column:
    return F.date_format(moment, "dd/MM/yyyy")


def format_moment(moment: Column) -> Column:
    return F.date_format(moment, "dd/MM/yyyy HH:mm:ss")
