"""Bands, tiers and segments.

The three discount-band flavours agree on whole multiples of five and differ between them; they are
three functions on purpose. Every band has an order number so that results sort the natural way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom.functions.ratios import nonzero, round_half_up

# Labels and limits that reports rely on.
DISCOUNT_LABELS = ["0%", "1-10%", "11-20%", "21-30%", "30%+"]
NO_DISCOUNT = "No Discount"
ORDER_TIERS = [(5, "Platinum"), (3, "Gold"), (2, "Silver")]
ORDER_TIER_ELSE = "Bronze"
VALUE_SEGMENTS = [(50000, "High"), (10000, "Medium")]
VALUE_SEGMENT_ELSE = "Low"
REVENUE_SEGMENTS = [(50000, "Platinum"), (10000, "Gold"), (5000, "Silver")]
REVENUE_SEGMENT_ELSE = "Bronze"
MARGIN_COLOURS = [(30, "dark green"), (20, "green"), (10, "yellow"), (0, "orange")]
MARGIN_COLOUR_ELSE = "red"
RETURN_LEVELS = [(20, "high"), (10, "medium")]
RETURN_LEVEL_ELSE = "low"
MARGIN_TIERS = [(35, "Profit Engines"), (15, "Volume Drivers"), (0, "Margin Squeeze")]
MARGIN_TIER_ELSE = "Loss Leaders"


def at_least(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose limit the value reaches."""
    out = None
    for limit, label in steps:
        out = F.when(value >= limit, label) if out is None else out.when(value >= limit, label)
    return out.otherwise(otherwise)


def above(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose limit the value exceeds."""
    out = None
    for limit, label in steps:
        out = F.when(value > limit, label) if out is None else out.when(value > limit, label)
    return out.otherwise(otherwise)


def discount_band_sql(discount: Column) -> Column:
    """Closed whole-number ranges; anything between or outside them lands in the last band."""
    zero, ten, twenty, thirty, rest = DISCOUNT_LABELS
    return (
        F.when(discount == 0, zero)
        .when(discount.between(1, 10), ten)
        .when(discount.between(11, 20), twenty)
        .when(discount.between(21, 30), thirty)
        .otherwise(rest)
    )


def discount_band_bins(discount: Column) -> Column:
    """Right-closed bins over (-1, 100]; NULL outside."""
    zero, ten, twenty, thirty, rest = DISCOUNT_LABELS
    return F.when(discount > -1, (
        F.when(discount <= 0, zero).when(discount <= 10, ten).when(discount <= 20, twenty)
        .when(discount <= 30, thirty).when(discount <= 100, rest)
    ))


def discount_band_bi(discount: Column) -> Column:
    """Cascade of upper limits after an exact zero."""
    _, ten, twenty, thirty, rest = DISCOUNT_LABELS
    return (
        F.when(discount == 0, NO_DISCOUNT).when(discount <= 10, ten).when(discount <= 20, twenty)
        .when(discount <= 30, thirty).otherwise(rest)
    )


def band_order(band: Column) -> Column:
    """Position of a discount-band label."""
    out = F.when(band == NO_DISCOUNT, 0)
    for position, label in enumerate(DISCOUNT_LABELS):
        out = out.when(band == label, position)
    return out


def order_tier(orders: Column) -> Column:
    return at_least(orders, ORDER_TIERS, ORDER_TIER_ELSE)


def value_segment(total: Column) -> Column:
    return at_least(total, VALUE_SEGMENTS, VALUE_SEGMENT_ELSE)


def revenue_segment(total: Column) -> Column:
    return at_least(total, REVENUE_SEGMENTS, REVENUE_SEGMENT_ELSE)


def order_frequency(orders: Column) -> Column:
    return (
        F.when(orders == 1, "1 order")
        .when(orders == 2, "2 orders")
        .when(orders.between(3, 4), "3-4 orders")
        .when(orders.between(5, 9), "5-9 orders")
        .otherwise("10+ orders")
    )


def annual_value(total: Column, days: Column) -> Column:
    """Revenue scaled to a year; one-day customers keep their revenue."""
    return F.when(days == 0, total.cast("double")).otherwise(
        round_half_up(total.cast("double") * 365.0 / nonzero(days.cast("double")))
    )


def margin_colour(margin: Column) -> Column:
    return above(margin, MARGIN_COLOURS, MARGIN_COLOUR_ELSE)


def return_level(rate: Column) -> Column:
    return above(rate, RETURN_LEVELS, RETURN_LEVEL_ELSE)


def margin_tier(margin: Column) -> Column:
    """> 35, 15-35, 0-15 and negative realised margin."""
    high, volume, squeeze = MARGIN_TIERS
    return (
        F.when(margin > high[0], high[1]).when(margin >= volume[0], volume[1])
        .when(margin >= squeeze[0], squeeze[1]).otherwise(MARGIN_TIER_ELSE)
    )
