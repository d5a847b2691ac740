"""Cleaning rules (C1-C9, C17) and the five cleaned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.functions.dates import parse_date
from salesloom.schemas import PRICE
from salesloom.sources.raw_csv import POSITION

# Fill-in texts, the loss-leader repair factor and the limits of quantity and discount.
UNKNOWN = "Unknown"
NO_REASON = "Not specified"
REPAIR_FACTOR = Decimal("0.7")
MIN_QUANTITY = 1
DISCOUNT_RANGE = (0, 100)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in a total order.

    The order defaults to the place in the files, where the rows carry it (read_raw(ordered=True)), which is then dropped; else to all remaining
    columns, ascending with NULLs last. Spark keeps only the first row per key on the map side already (WindowGroupLimit), so a hot
    key never travels as a whole.
    """
    placed = not order_by and POSITION in df.columns
    order_by = list(order_by) if order_by else [POSITION] if placed else [c for c in df.columns if c not in set(keys)]
    window = W.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn", *[POSITION] * placed)


def at_least(c: Column | str, low) -> Column:
    """Clip from below; NULL stays NULL (``greatest`` would drop it)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < low, F.lit(low)).otherwise(c)


def within(c: Column | str, low, high) -> Column:
    """Clip on both sides; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def not_after(c: Column | str, limit: dt.date) -> Column:
    """Dates after ``limit`` become ``limit`` (C5); NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > F.lit(limit), F.lit(limit)).otherwise(c)


def fill_age(customers: DataFrame) -> DataFrame:
    """Missing age becomes the median age, cut to a whole number.

    The median comes from an age histogram, so what meets in one task is one row per distinct age.
    """
    median = customers.agg(F.median("age").alias("m"))
    return customers.withColumn("age", F.coalesce(F.col("age"), median.scalar()).cast("int"))


def repair_cost(products: DataFrame) -> DataFrame:
    """Clip prices at 0, then set the cost of products sold at or below cost to 70 % of the price."""
    clipped = products.withColumns({"cost_price": at_least("cost_price", 0), "selling_price": at_least("selling_price", 0)})
    return clipped.withColumns({
        "cost_price": F.when(
            F.col("cost_price") >= F.col("selling_price"), F.col("selling_price") * F.lit(REPAIR_FACTOR)
        ).otherwise(F.col("cost_price")).cast(PRICE),
        "selling_price": F.col("selling_price").cast(PRICE),
    })


def repair_shipping(orders: DataFrame) -> DataFrame:
    """Shipping before ordering becomes the day after the order."""
    return orders.withColumn(
        "shipping_date",
        F.when(F.col("shipping_date") < F.col("order_date"), F.date_add("order_date", 1)).otherwise(F.col("shipping_date")),
    )


def strip_quotes(df: DataFrame, column: str) -> DataFrame:
    """Remove single quotes from a text column (C17). Typed writers need no escaping."""
    return df.withColumn(column, F.replace(F.col(column), F.lit("'"), F.lit("")))


def clean_customers(customers: DataFrame, as_of: dt.date) -> DataFrame:
    unique = keep_first(customers, ["customer_id"])
    return (
        fill_age(unique)
        .na.fill({"gender": UNKNOWN})
        .withColumn("signup_date", not_after(parse_date("signup_date"), as_of))
    )


def clean_products(products: DataFrame) -> DataFrame:
    return repair_cost(keep_first(products, ["product_id"]))


def clean_orders(orders: DataFrame) -> DataFrame:
    parsed = keep_first(orders, ["order_id"]).withColumns(
        {c: parse_date(c) for c in ("order_date", "shipping_date")}
    )
    return repair_shipping(parsed).na.fill({"region": UNKNOWN, "payment_mode": UNKNOWN})


def clean_order_items(items: DataFrame) -> DataFrame:
    low, high = DISCOUNT_RANGE
    return items.withColumns({
        "quantity": at_least("quantity", MIN_QUANTITY),
        "selling_price": at_least("selling_price", 0).cast(PRICE),
        "discount": within("discount", low, high).cast("decimal(5,2)"),
    })


def clean_returns(returns: DataFrame) -> DataFrame:
    return keep_first(returns, ["order_id", "product_id"]).na.fill({"return_reason": NO_REASON})
