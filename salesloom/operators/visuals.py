"""Data sets behind the dashboard visuals (V0-V18); drawing is left to the BI tool."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.functions import dates, geo
from salesloom.functions.ratios import divide0, pct, round_half_up
from salesloom.operators.catalog import PRODUCT, product_totals
from salesloom.operators.measures import measures
from salesloom.operators.summaries import customer_revenue, flagged, headline_totals, monthly, overview, total


def slicers(fact: DataFrame) -> DataFrame:
    """Distinct years, quarters and regions to choose from."""
    d = F.col("order_date")
    choices = fact.select(F.year(d).alias("y"), F.quarter(d).alias("q"), F.col("region").alias("r")).distinct()
    pairs = F.explode(F.array(
        F.struct(F.lit("year").alias("slicer"), F.col("y").cast("string").alias("value")),
        F.struct(F.lit("quarter").alias("slicer"), F.col("q").cast("string").alias("value")),
        F.struct(F.lit("region").alias("slicer"), F.col("r").alias("value")),
    ))
    return choices.select(pairs.alias("p")).select("p.slicer", "p.value").filter("value IS NOT NULL").distinct()


def kpi_cards(fact: DataFrame, where: Column | None = None) -> DataFrame:
    """V1 under a slicer selection."""
    return overview(fact if where is None else fact.filter(where)).select("revenue", "profit", "orders", "margin_pct")


def revenue_over_time(fact: DataFrame) -> DataFrame:
    """V2, by day."""
    return fact.filter("order_date IS NOT NULL").groupBy("order_date").agg(
        total("revenue").alias("revenue"), total("profit").alias("profit")
    )


def revenue_by(fact: DataFrame, key: str) -> DataFrame:
    """V3."""
    return fact.filter(F.col(key).isNotNull()).groupBy(key).agg(total("revenue").alias("revenue"))


def region_map(fact: DataFrame, coords: Mapping[str, tuple[float, float]] = geo.REGION_COORDS) -> DataFrame:
    """V4."""
    return revenue_by(fact, "region").withColumns(
        {"latitude": geo.latitude(F.col("region"), coords), "longitude": geo.longitude(F.col("region"), coords)}
    )


def top_products_by_revenue(fact: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """V5."""
    return (
        product_totals(fact).join(products.select(*PRODUCT), "product_id")
        .orderBy(F.desc("total_revenue"), "product_id").limit(k)
        .select(*PRODUCT, "units_sold", "total_revenue", "total_profit")
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """V6."""
    return monthly(fact).select(F.col("order_date").alias("month"), "revenue")


def region_by_year(fact: DataFrame) -> DataFrame:
    """V7."""
    known = fact.filter("region IS NOT NULL AND order_date IS NOT NULL")
    return known.groupBy("region", F.year("order_date").alias("year")).agg(total("revenue").alias("revenue"))


def category_by_month(fact: DataFrame) -> DataFrame:
    """V8."""
    known = fact.filter("category IS NOT NULL AND order_date IS NOT NULL")
    return known.groupBy(dates.month_label("order_date").alias("month"), "category").agg(total("revenue").alias("revenue"))


def revenue_waterfall(fact: DataFrame) -> DataFrame:
    """V9: revenue change against the calendar month before."""
    number = F.year(F.to_date("month", "yyyy-MM")) * 12 + F.month(F.to_date("month", "yyyy-MM"))
    before = F.sum("revenue").over(W.orderBy("_no").rangeBetween(-1, -1))
    return monthly_revenue(fact).withColumn("_no", number).select(
        "month", "revenue", (F.col("revenue") - F.coalesce(before, F.lit(0))).alias("delta")
    )


def top_customers_by_revenue(fact: DataFrame, k: int = 10) -> DataFrame:
    """V10b."""
    return customer_revenue(fact).orderBy(F.desc("revenue"), "customer_id").limit(k)


def customer_cards(fact: DataFrame) -> DataFrame:
    """V10e: CLV, repeat rate and average order value."""
    return headline_totals(fact).select(
        divide0("profit", "customers").alias("clv"), pct("repeaters", "customers").alias("repeat_rate_pct"),
        divide0("revenue", "orders").alias("average_order_value"),
    )


def category_matrix(fact: DataFrame) -> DataFrame:
    """Category x sub-category with subtotals; ``level`` is 0 for cells, 1 for categories, 3 for the total
    (the numbers GROUPING_ID gives in a rollup).

    Distinct orders do not add up over cells. Each level therefore folds the level below to one row per order
    of its own: cells to categories to the total. ROLLUP would copy every (cell, order) row once per level
    and shuffle all copies; here each fold starts from the smaller result before it.
    """
    sums = ("revenue", "profit", "returns")

    def fold(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys, "order_id").agg(*[F.sum(c).alias(c) for c in sums])

    def summary(df: DataFrame, level: int, *keys: str) -> DataFrame:
        missing = [F.lit(None).cast("string").alias(k) for k in ("category", "sub_category") if k not in keys]
        added = df.groupBy(*keys).agg(F.count("order_id").alias("orders"), *[F.sum(c).alias(c) for c in sums])
        return added.select(
            *keys, *missing, F.lit(level).alias("level"), "revenue", pct("profit", "revenue").alias("margin_pct"),
            pct("returns", "orders").alias("return_rate"),
        )

    cells = fact.groupBy("category", "sub_category", "order_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"), flagged().alias("returns"))
    categories = fold(cells, "category")
    return (
        summary(cells, 0, "category", "sub_category")
        .unionByName(summary(categories, 1, "category")).unionByName(summary(fold(categories), 3))
    )


def discount_scatter(fact: DataFrame) -> DataFrame:
    """Margin per discount value."""
    return fact.groupBy("discount").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit")
    ).select("discount", "line_count", "revenue", pct("profit", "revenue").alias("margin_pct"))


def negative_margin_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Products that lost money."""
    return (
        product_totals(fact).filter("total_profit < 0").join(products.select(*PRODUCT), "product_id")
        .select(*PRODUCT, "units_sold", "total_revenue", "total_profit", pct("total_profit", "total_revenue").alias("margin_pct"))
    )


def return_gauge(fact: DataFrame, target: float = 0.10) -> DataFrame:
    """Return rate (flagged lines per order) against a target."""
    return measures(fact, ["return_rate"]).select(
        round_half_up(F.col("return_rate"), 6).alias("return_rate"), F.lit(target).alias("target"),
        (F.col("return_rate") > target).alias("above_target"),
    )


def return_rate_trend(fact: DataFrame) -> DataFrame:
    """Flagged lines per order by month."""
    return monthly(fact).select(
        F.col("order_date").alias("month"), "orders", "returns", pct("returns", "orders").alias("return_rate")
    )


def returns_by_payment_mode(fact: DataFrame) -> DataFrame:
    """V18."""
    return measures(fact.filter("payment_mode IS NOT NULL"), ["total_returns", "total_orders", "return_rate"], ["payment_mode"]).select(
        "payment_mode", "total_returns", "total_orders", round_half_up(F.col("return_rate"), 6).alias("return_rate")
    )
