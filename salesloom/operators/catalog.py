"""Report catalogue over the clean star (Q1-Q13 and the windows W1-W6 in them).

Joins with a dimension are inner joins in every report. Those that only need attributes the fact carries
are filters (``has_product``, ``has_customer``); those that need more join after the aggregation, when one
row per product or customer is left. Every top-k ends in a limit over a total order, which Spark runs as a
top-k per partition and a merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.functions import bands, dates
from salesloom.functions.ratios import div, mean, pct, per, round_half_up
from salesloom.operators.star import daily_sales
from salesloom.plans.ordered import Ordered, Store, checkpointed, ordered

PRODUCT = ["product_id", "category", "sub_category", "brand"]


def revenue_by_region(fact: DataFrame) -> DataFrame:
    """Q1. Region of the customer; avg_order_value is the mean revenue of a line."""
    return (
        fact.filter("has_customer").groupBy(F.col("customer_region").alias("region"))
        .agg(
            F.count_distinct("order_id").alias("total_orders"), F.sum("revenue").alias("total_revenue"),
            F.sum("profit").alias("total_profit"), F.count("revenue").alias("_n"),
        )
        .select(
            "region", "total_orders", "total_revenue", "total_profit",
            pct("total_profit", "total_revenue").alias("margin_pct"), per("total_revenue", "_n").alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "region")
    )


def sales_by_day(fact: DataFrame) -> DataFrame:
    """One row per order date. An order has one date, so its count adds up over any longer period."""
    return fact.groupBy("order_date").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit")
    )


def monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Q2. The calendar joins days, not lines; the window runs over one row per month."""
    months = (
        sales_by_day(fact).join(dim_date, F.col("order_date") == F.col("date_key"))
        .groupBy("year", "month", "month_name")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"))
    )
    previous = F.lag("revenue").over(W.orderBy("year", "month"))
    return (
        months.withColumn("prev_month_revenue", previous)
        .withColumns({
            "margin_pct": pct("profit", "revenue"),
            "revenue_mom_change_pct": pct(F.col("revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")),
        })
        .select("year", "month", "month_name", "orders", "revenue", "profit", "margin_pct",
                "prev_month_revenue", "revenue_mom_change_pct")
        .orderBy("year", "month")
    )


def product_totals(fact: DataFrame, *extra) -> DataFrame:
    """Units, revenue and profit per product; one row per product leaves the fact scan's partial aggregation."""
    return fact.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"), F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"), *extra,
    )


def top_products(fact: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Q3. The rank needs only the k best rows: whoever ranks higher is among them."""
    margin = div("profit", "revenue")
    best = (
        product_totals(fact, F.sum(margin).alias("_m"), F.count(margin).alias("_n"))
        .join(products.select(*PRODUCT), "product_id")
        .orderBy(F.desc("total_profit"), "product_id").limit(k)
    )
    return best.select(
        *PRODUCT, "units_sold", "total_revenue", "total_profit",
        round_half_up(mean(F.col("_m"), F.col("_n")) * 100).alias("avg_margin_pct"),
        F.rank().over(W.orderBy(F.desc("total_profit"))).alias("profit_rank"),
    ).orderBy("profit_rank", "product_id")


def customer_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"), F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"), F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    )


def customer_value(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """All customers with tier, segment and annualised revenue."""
    days = F.datediff("last_order", "first_order")
    return (
        customer_totals(fact).join(customers.select("customer_id", "name", "region"), "customer_id")
        .select(
            "customer_id", "name", "region", "total_orders",
            F.round("total_revenue", 2).alias("total_revenue"), F.round("total_profit", 2).alias("total_profit"),
            per("total_revenue", "total_orders").alias("aov"),
            bands.annual_value(F.col("total_revenue"), days).alias("annual_value"),
            bands.order_tier(F.col("total_orders")).alias("customer_tier"),
            bands.value_segment(F.col("total_revenue")).alias("value_segment"),
            per("total_revenue", "total_orders").alias("avg_revenue_per_order"),
        )
    )


def top_customers(fact: DataFrame, customers: DataFrame, k: int = 20) -> DataFrame:
    """Q4."""
    return customer_value(fact, customers).orderBy(F.desc("total_revenue"), "customer_id").limit(k)


def orders_per_customer(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(F.count_distinct("order_id").alias("order_count"))


def repeat_purchases(fact: DataFrame) -> DataFrame:
    """Q5. Windows run over at most five rows, one per frequency bucket."""
    buckets = (
        orders_per_customer(fact)
        .groupBy(bands.order_frequency(F.col("order_count")).alias("order_frequency"))
        .agg(F.count(F.lit(1)).alias("customer_count"), F.min("order_count").alias("_lo"), F.max("order_count").alias("_hi"))
    )
    down = W.orderBy(F.desc("_hi")).rangeBetween(W.unboundedPreceding, W.currentRow)
    return (
        buckets.withColumns({
            "pct_of_customers": pct("customer_count", F.sum("customer_count").over(W.partitionBy())),
            "cumulative_customers_desc": F.sum("customer_count").over(down),
        })
        .orderBy("_lo")
        .select("order_frequency", "customer_count", "pct_of_customers", "cumulative_customers_desc")
    )


def returned_lines():
    return F.count_if("is_return")


def return_rate_by_category(fact: DataFrame) -> DataFrame:
    """Q6. Returned lines per unit sold."""
    return (
        fact.filter("has_product").groupBy("category")
        .agg(
            F.count_distinct("order_id").alias("total_orders"), F.sum("quantity").alias("units_sold"),
            returned_lines().alias("return_units"),
            F.sum(F.when(F.col("is_return"), F.col("revenue")).otherwise(F.lit(0))).alias("return_revenue_loss"),
        )
        .select("category", "total_orders", "units_sold", "return_units",
                pct("return_units", "units_sold").alias("return_rate_pct"), "return_revenue_loss")
        .orderBy(F.desc("return_rate_pct"), "category")
    )


def product_margins(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Unit and realised margin of every product with revenue."""
    return (
        product_totals(fact).filter("total_revenue > 0")
        .join(products.select(*PRODUCT, "cost_price", "selling_price"), "product_id")
        .select(
            *PRODUCT, "cost_price", "selling_price",
            pct(F.col("selling_price") - F.col("cost_price"), F.col("selling_price")).alias("unit_margin_pct"),
            "units_sold", "total_revenue", "total_profit", pct("total_profit", "total_revenue").alias("realized_margin_pct"),
        )
    )


def lowest_margin_products(fact: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    """Q7."""
    return product_margins(fact, products).orderBy(F.col("realized_margin_pct").asc_nulls_last(), "product_id").limit(k)


def cohort_retention(fact: DataFrame, max_offset: int = 12) -> DataFrame:
    """Q8. Lines fold to (customer, day) before the per-customer window, so the window holds at most one
    row per calendar day even for the largest customer."""
    days = fact.filter("customer_id IS NOT NULL").select("customer_id", "order_date").distinct()
    activity = days.withColumn("first_date", F.min("order_date").over(W.partitionBy("customer_id")))
    offsets = activity.select(
        "customer_id", dates.month_label("first_date").alias("cohort_month"),
        dates.elapsed_months(F.col("first_date"), F.col("order_date")).alias("month_offset"),
    )
    counted = offsets.groupBy("cohort_month", "month_offset").agg(F.count_distinct("customer_id").alias("active_customers"))
    # every member of a cohort is active at offset 0, on the day of the first order
    size = F.max(F.when(F.col("month_offset") == 0, F.col("active_customers"))).over(W.partitionBy("cohort_month"))
    return (
        counted.filter("cohort_month IS NOT NULL").withColumn("cohort_size", size)
        .filter(F.col("month_offset") <= max_offset)
        .select("cohort_month", "month_offset", "active_customers", "cohort_size",
                pct("active_customers", "cohort_size").alias("retention_pct"))
        .orderBy("cohort_month", "month_offset")
    )


JOURNEY = ["customer_id", "name", "order_id", "product_id", "order_date", "revenue"]
JOURNEY_ORDER = ["order_date", "order_id", "product_id"]
JOURNEY_COLUMNS = ["customer_id", "name", "order_id", "product_id", "order_date", "next_order_date",
                   "days_between_orders", "running_total_revenue"]


def journey_index(fact: DataFrame, store: Store) -> Ordered:
    """Lines of known customers in the order of their journeys, with running revenue and next date; written once."""
    lines = fact.filter("has_customer").select(*JOURNEY)
    return ordered(lines, JOURNEY_ORDER, {"running_total_revenue": F.col("revenue")}, store, keys=["customer_id"], following={"next_order_date": "order_date"})


def customer_journey(fact: DataFrame, journeys: Ordered | None = None) -> DataFrame:
    """Next purchase and running revenue of every line of every customer.

    One customer with a third of all lines spreads over many ranges. Reading ``journeys``, the index of ``fact``, exchanges no lines; without it one is
    made for this call.
    """
    return (journeys or journey_index(fact, checkpointed)).read().withColumn("days_between_orders", F.datediff("next_order_date", "order_date")).select(*JOURNEY_COLUMNS)


def next_purchases(fact: DataFrame, k: int = 50) -> DataFrame:
    """Q9. The first k lines in (customer, date) order, each with the next date and the running revenue.

    The report is a prefix of the global order: its windows see nothing but the prefix and one line more, so
    the k + 1 first lines are selected before the windows are taken.
    """
    order = ["customer_id", *JOURNEY_ORDER]
    prefix = fact.filter("has_customer").select(*JOURNEY).orderBy(*order).limit(k + 1)
    in_order = W.partitionBy("customer_id").orderBy(*JOURNEY_ORDER)
    return (
        prefix.withColumns({
            "next_order_date": F.lead("order_date").over(in_order),
            "running_total_revenue": F.sum("revenue").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)),
        })
        .orderBy(*order).limit(k)
        .withColumn("days_between_orders", F.datediff("next_order_date", "order_date"))
        .select(*JOURNEY_COLUMNS)
    )


def discount_bands(fact: DataFrame) -> DataFrame:
    """Q10. Sorted by the smallest discount in the band."""
    return (
        fact.groupBy(bands.discount_band_sql(F.col("discount")).alias("discount_band"))
        .agg(
            F.count(F.lit(1)).alias("transactions"), F.sum("revenue").alias("total_revenue"),
            F.sum("profit").alias("total_profit"), F.sum("discount").alias("_d"), F.count("discount").alias("_n"),
            F.min("discount").alias("_lo"),
        )
        .orderBy("_lo")
        .select("discount_band", "transactions", "total_revenue", "total_profit",
                pct("total_profit", "total_revenue").alias("margin_pct"), per("_d", "_n").alias("avg_discount_pct"))
    )


def payment_modes(fact: DataFrame) -> DataFrame:
    """Q11. avg_order_value is the mean revenue of a line."""
    return (
        fact.groupBy("payment_mode")
        .agg(
            F.count_distinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"), F.count("revenue").alias("_n"), F.count(F.lit(1)).alias("transactions"),
        )
        .select("payment_mode", "orders", "revenue", "profit", per("revenue", "_n").alias("avg_order_value"), "transactions")
        .orderBy(F.desc("revenue"), "payment_mode")
    )


def worst_products(fact: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Q12."""
    return (
        product_totals(fact).join(products.select(*PRODUCT), "product_id")
        .orderBy(F.col("total_profit").asc_nulls_last(), "product_id").limit(k)
        .select(*PRODUCT, "units_sold", "total_revenue", "total_profit")
    )


__all__ = [
    "cohort_retention", "customer_journey", "customer_totals", "customer_value", "daily_sales", "discount_bands",
    "lowest_margin_products", "monthly_trend", "next_purchases", "orders_per_customer", "payment_modes",
    "product_margins", "product_totals", "repeat_purchases", "return_rate_by_category", "revenue_by_region",
    "sales_by_day", "top_customers", "top_products", "worst_products",
]
