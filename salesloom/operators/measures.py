"""BI measures (B1-B28): named values under group columns and filters.

``measures(fact, names, by, where)`` plays the part of a visual: ``by`` are its axes, ``where`` its filter
context. "ALL" means: compute before filtering. Ratios give 0 where the denominator is 0 or missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.functions import bands
from salesloom.functions.ratios import divide0, pct
from salesloom.operators.summaries import orders_and_customers
from salesloom.plans.ordered import global_rank
from salesloom.session import shared_dir

def _additive() -> dict[str, Column]:
    return {
        "total_revenue": F.sum("revenue"), "total_profit": F.sum("profit"), "units_sold": F.sum("quantity"),
        "total_returns": F.count_if("is_return"), "discount_impact": F.sum("discount_impact"),
        "discount_sum": F.sum("discount"), "discount_lines": F.count("discount"),
    }


def slicer(
    years: Sequence[int] = (), quarters: Sequence[int] = (), months: Sequence[int] = (), regions: Sequence[str] = ()
) -> Column:
    """Filter context of the report slicers.

    The date parts are taken from ``order_month``, the partition column of the published fact: the filter then
    prunes partitions instead of reading every month and dropping rows.
    """
    parts = {F.year: years, F.quarter: quarters, F.month: months}
    out = F.lit(True)
    for part, values in parts.items():
        if values:
            out = out & part("order_month").isin(list(values))
    return out & F.col("region").isin(list(regions)) if regions else out


# measure -> (numerator, denominator)
RATIOS = {
    "profit_margin": ("total_profit", "total_revenue"),
    "average_order_value": ("total_revenue", "total_orders"),
    "return_rate": ("total_returns", "total_orders"),
    "revenue_per_customer": ("total_revenue", "total_customers"),
    "avg_discount": ("discount_sum", "discount_lines"),
    "clv": ("total_profit", "total_customers"),
}
DISTINCT = {"total_orders": "order_id", "total_customers": "customer_id"}


def measures(
    fact: DataFrame, names: Sequence[str], by: Sequence[str | Column] = (), where: Column | None = None
) -> DataFrame:
    """The named measures per group; a measure has the same value alone and with others."""
    needed = {part for n in names for part in RATIOS.get(n, (n,))}
    rows = fact if where is None else fact.filter(where)
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    additive = {n: c for n, c in _additive().items() if n in needed}
    if needed >= set(DISTINCT):
        counted = orders_and_customers(rows, keys, additive).withColumnsRenamed(
            {"orders": "total_orders", "customers": "total_customers"})
    else:
        distinct = [F.count_distinct(c).alias(n) for n, c in DISTINCT.items() if n in needed]
        counted = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in additive.items()], *distinct)
    values = [divide0(*RATIOS[n]).alias(n) if n in RATIOS else F.col(n) for n in names]
    return counted.select(*counted.columns[: len(keys)], *values)


CORE = ["total_revenue", "total_profit", "total_orders", "total_customers", "total_returns", "units_sold"]


def core(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """B1-B6."""
    return measures(fact, CORE, by)


def ratios(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """B7-B12, B27."""
    return measures(fact, [*RATIOS, "discount_impact"], by)


# ---- time intelligence ------------------------------------------------------------------------------------


def by_day(fact: DataFrame) -> DataFrame:
    return fact.filter("order_date IS NOT NULL").groupBy("order_date").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit")
    )


def previous_periods(fact: DataFrame) -> DataFrame:
    """B13-B16 per month. The previous period is the *calendar* month or year before: a RANGE frame over the
    month number finds it in the same pass and gives NULL where that month has no sales."""
    months = (
        fact.filter("order_date IS NOT NULL").groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(F.sum("revenue").alias("revenue"))
        .withColumn("_no", F.col("year") * 12 + F.col("month"))
    )

    def ago(n: int) -> Column:
        return F.sum("revenue").over(W.orderBy("_no").rangeBetween(-n, -n))

    return months.withColumns({"revenue_prev_month": ago(1), "revenue_prev_year": ago(12)}).select(
        "year", "month", "revenue", "revenue_prev_month",
        divide0(F.col("revenue") - F.col("revenue_prev_month"), "revenue_prev_month").alias("revenue_mom"),
        "revenue_prev_year",
        divide0(F.col("revenue") - F.col("revenue_prev_year"), "revenue_prev_year").alias("revenue_yoy"),
    )


def period_to_date(fact: DataFrame) -> DataFrame:
    """B17-B20 per day (W11). Windows hold one row per day of a month, quarter or year."""
    year, quarter, month = (f(F.col("order_date")) for f in (F.year, F.quarter, F.month))

    def todate(column: str, *period: Column) -> Column:
        return F.sum(column).over(W.partitionBy(*period).orderBy("order_date"))

    return by_day(fact).select(
        "order_date", "revenue",
        todate("revenue", year, month).alias("revenue_mtd"), todate("revenue", year, quarter).alias("revenue_qtd"),
        todate("revenue", year).alias("revenue_ytd"), todate("profit", year).alias("profit_ytd"),
    )


# ---- ranks and segments -----------------------------------------------------------------------------------


def _all_members(dim: DataFrame, key: str, totals: DataFrame) -> DataFrame:
    """Every member of the dimension; members without sales count as 0."""
    return dim.select(key).join(totals, key, "left").na.fill(0)


def product_ranks(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Rank of each product among all products."""
    totals = fact.groupBy("product_id").agg(F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"))
    shared_dir(fact.sparkSession)
    everyone = _all_members(products, "product_id", totals).checkpoint()  # both ranks read it; the fact is scanned once
    return global_rank(global_rank(everyone, "revenue", "revenue_rank"), "profit", "profit_rank")


def customer_ranks(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """B23."""
    totals = fact.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"))
    shared_dir(fact.sparkSession)
    return global_rank(_all_members(customers, "customer_id", totals).checkpoint(), "revenue", "revenue_rank")


def customer_segments(fact: DataFrame) -> DataFrame:
    """B24, M15."""
    return fact.filter("customer_id IS NOT NULL").groupBy("customer_id").agg(F.sum("revenue").alias("revenue")).withColumn(
        "segment", bands.revenue_segment(F.col("revenue"))
    )


def discount_bands(fact: DataFrame) -> DataFrame:
    """Measures per BI discount band, in band order."""
    band = bands.discount_band_bi(F.col("discount")).alias("discount_band")
    return measures(fact, ["total_revenue", "total_profit", "profit_margin", "total_orders"], [band]).withColumn(
        "band_order", bands.band_order(F.col("discount_band"))
    ).orderBy("band_order")


def reason_list(returns: DataFrame) -> DataFrame:
    """All return reasons in one text, in alphabetical order. Reasons are made distinct in parallel first."""
    return returns.select("return_reason").filter("return_reason IS NOT NULL").distinct().agg(
        F.concat_ws(", ", F.sort_array(F.collect_list("return_reason"))).alias("return_reasons")
    )


def report_title(fact: DataFrame, where: Column | None = None, month: bool = False, prefix: str = "Sales Analytics | ") -> DataFrame:
    """The selected year, "All Years" if there is more than one; with ``month`` also the selected month."""
    rows = fact if where is None else fact.filter(where)
    year = F.year("order_date")
    seen = rows.agg(
        F.min(year).alias("y0"), F.max(year).alias("y1"),
        F.min(F.date_format("order_date", "MMMM")).alias("m0"), F.max(F.date_format("order_date", "MMMM")).alias("m1"),
    )
    title = F.concat(F.lit(prefix), F.when(F.col("y0") == F.col("y1"), F.col("y0").cast("string")).otherwise("All Years"))
    if month:
        title = F.concat(title, F.lit(" - "), F.when(F.col("m0") == F.col("m1"), F.col("m0")).otherwise(""))
    return seen.select(title.alias("title"))


def segment_distribution(fact: DataFrame) -> DataFrame:
    """Customers per segment with their share."""
    counted = customer_segments(fact).groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    return counted.withColumn("share_pct", pct("customers", F.sum("customers").over(W.partitionBy())))
