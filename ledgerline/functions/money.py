"""Amount expressions. All are decimal, so that no sum depends on the order of its rows; too large an amount is an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.fixed_values import CENTS, RATIO_EPSILON

# Narrow enough that a product with a row count (decimal(10,0)) still keeps all decimals.
AMOUNT = "decimal(27,8)"
UNIT_AMOUNT = "decimal(27,10)"


def in_units(cents: Column) -> Column:
    """Cents as units; null stays null."""
    return cents / F.lit(CENTS)


def cents_to_units(cents: Column) -> Column:
    """Cents as units, exact; null counts as 0."""
    return in_units(F.coalesce(cents, F.lit(0)))


def net_line(quantity: Column, unit_price: Column, discount_cents: Column) -> Column:
    """Line value: quantity times price, less the line discount."""
    return (quantity * unit_price - cents_to_units(discount_cents)).cast(AMOUNT)


def net_unit(quantity: Column, unit_price: Column, discount_cents: Column) -> Column:
    """Line value per unit; a zero quantity is an error."""
    return (net_line(quantity, unit_price, discount_cents) / quantity).cast(UNIT_AMOUNT)


def repeated(amount: Column, rows: Column, scale: int = 8) -> Column:
    """What an amount adds to a sum when its row occurs ``rows`` times.

    The product has 38 digits and all ``scale`` decimals for any number of repeats: amounts of
    22 digits and counts of 15. Larger ones are an error.
    """
    return amount.cast(f"decimal(22,{scale})") * rows.cast("decimal(15,0)")


def freight_rate(freight_cents: Column, product_total: Column) -> Column:
    """Freight in units per unit of goods value, to 23 decimals.

    The epsilon keeps the division defined for a zero total and is part of the result.
    """
    total = (product_total + F.lit(RATIO_EPSILON)) * F.lit(CENTS)
    return freight_cents.cast("decimal(15,4)") / total.cast("decimal(20,4)")


def goods_share(document_value: Column, freight: Column) -> Column:
    """One over the document's value without freight, with the same epsilon, to 29 decimals."""
    goods = document_value - freight + F.lit(RATIO_EPSILON)
    return F.lit(1).cast("decimal(11,10)") / goods.cast("decimal(18,4)")


def freight_share(net: Column, rate: Column, rows: Column | None = None) -> Column:
    """A line's part of the document freight, to 13 decimals; ``rows``: how often it occurs."""
    rows = F.lit(1) if rows is None else rows
    repeated_rate = rate.cast("decimal(27,21)") * rows.cast("decimal(10,0)")
    return net.cast("decimal(22,8)") * repeated_rate.cast("decimal(31,21)")


def goods_before_discount_pct(quantity: Column, unit_price: Column, discount_cents: Column) -> Column:
    """Line value with the discount taken per unit, exact; sums of it are lines too."""
    per_unit = (unit_price - cents_to_units(discount_cents)).cast("decimal(18,6)")
    return (quantity.cast("decimal(18,4)") * per_unit).cast("decimal(26,10)")


def extra_freight_share(goods: Column, discount_pct: Column, share: Column, extra: Column) -> Column:
    """The part of the sale's extra freight that falls to goods, to 16 decimals; the sale's percentage discount applies."""
    kept_pct = (F.lit(100) - F.coalesce(discount_pct, F.lit(0))).cast("decimal(9,4)")
    kept = goods.cast("decimal(26,10)") * kept_pct
    charged = kept.cast("decimal(26,12)") * extra.cast("decimal(20,10)")
    return charged.cast("decimal(28,12)") * share.cast("decimal(34,29)")


def order_unit_value(price: Column, discount_cents: Column) -> Column:
    return (F.coalesce(price, F.lit(0)) - cents_to_units(discount_cents)).cast(AMOUNT)


def order_final_value(price: Column, quantity: Column, discount_cents: Column, freight_cents: Column) -> Column:
    """Price times quantity, less the line discount, plus the freight of the whole order."""
    goods = F.coalesce(price, F.lit(0)) * F.coalesce(quantity, F.lit(0))
    return (goods - cents_to_units(discount_cents) + cents_to_units(freight_cents)).cast(AMOUNT)


def rounded_count(quantity: Column) -> Column:
    """Quantity as a whole number, half away from zero (a plain cast would cut)."""
    return F.round(quantity, 0).cast("bigint")
