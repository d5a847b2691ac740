"""Calculated fields of an order line."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.ratios import pct
from salesloom.schemas import IMPACT, MONEY


def revenue() -> Column:
    """quantity x selling price; the price is already net of the discount."""
    return (F.col("quantity") * F.col("selling_price")).cast(MONEY)


def cost_total() -> Column:
    return (F.col("quantity") * F.col("cost_price")).cast(MONEY)


def with_line_measures(lines: DataFrame) -> DataFrame:
    """Add revenue, cost_total, profit and discount_impact; profit is NULL where the cost is unknown."""
    return (
        lines.withColumns({"revenue": revenue(), "cost_total": cost_total()})
        .withColumns({
            "profit": (F.col("revenue") - F.col("cost_total")).cast(MONEY),
            # percent points x revenue / 100, as a product so that decimals stay exact
            "discount_impact": (F.col("discount") * F.col("revenue") * F.lit(Decimal("0.01"))).cast(IMPACT),
        })
    )


def line_margin_pct() -> Column:
    return pct("profit", "revenue")


def unit_margin_pct() -> Column:
    return pct(F.col("selling_price") - F.col("cost_price"), F.col("selling_price"))
