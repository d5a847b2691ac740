"""Star schema: fact builders, calendars, daily aggregate.

Join plan of the fact, chosen for a fact of hundreds of terabytes:

1. lines are deduplicated on (order_id, product_id); the hash of both columns spreads even one giant order;
2. the return flag joins on the same two columns, so it reuses that shuffle;
3. products join next, as their few columns make the lines little wider;
4. customers join the (much smaller) orders first, then the enriched orders join the lines once on order_id, last of all: the wide
   columns travel no more than once, and lines of an order come out side by side, so what they share packs well in the shuffle
   that follows. No join carries a broadcast hint: Spark broadcasts a side only when its size,
   estimated or measured at run time, is under the session's threshold, and splits hot keys otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions import dates
from salesloom.functions.lines import with_line_measures
from salesloom.functions.ratios import pct
from salesloom.operators import cleaning
from salesloom.sources.tables import RawTables

ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "shipping_date", "region", "payment_mode"]
PRODUCT_COLUMNS = ["product_id", "category", "sub_category", "brand", "cost_price"]
CUSTOMER_COLUMNS = ["customer_id", "name", "gender", "age", "city"]
LINE_KEY = ["order_id", "product_id"]
LINE_COLUMNS = ["quantity", "selling_price", "discount"]


def flag_returns(lines: DataFrame, returns: DataFrame) -> DataFrame:
    """is_return = the line's (order, product) occurs in the returns."""
    returned = returns.select(*LINE_KEY).distinct().withColumn("_hit", F.lit(True))
    return (
        lines.join(returned, LINE_KEY, "left")
        .withColumn("is_return", F.col("_hit").isNotNull())
        .drop("_hit")
    )


def parse_order_dates(orders: DataFrame) -> DataFrame:
    return orders.withColumns({c: dates.parse_date(c) for c in ("order_date", "shipping_date")})


def build_raw_fact(raw: RawTables, keep: Sequence[str] = (), how: str = "left") -> DataFrame:
    """Fact over the raw tables: no dedup, no repairs (J1, J2, M1-M4, M7). ``how='inner'`` is the strict variant.

    ``keep`` names extra line columns to carry along.
    """
    lines = raw.order_items.select(*LINE_KEY, *LINE_COLUMNS, *keep)
    orders = parse_order_dates(raw.orders).select(*ORDER_COLUMNS)
    joined = (
        flag_returns(lines, raw.returns)
        .join(raw.products.select(*PRODUCT_COLUMNS), "product_id", how)
        .join(orders, "order_id", how)
    )
    return with_line_measures(joined.select("product_id", "order_id", *LINE_COLUMNS, *keep, "is_return", *ORDER_COLUMNS[1:], *PRODUCT_COLUMNS[1:]))


def build_clean_fact(
    raw: RawTables,
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    returns: DataFrame,
    file_order: Sequence[str] | None = None,
) -> DataFrame:
    """Fact over cleaned tables, one row per (order, product).

    Every order belongs to one customer, so customer attributes join the orders before the lines do.
    ``customer_region``, ``has_customer`` and ``has_product`` record the outcome of the dimension joins;
    an inner join with a dimension is then a filter on the fact, not another join.
    """
    items = cleaning.keep_first(cleaning.clean_order_items(raw.order_items), LINE_KEY, file_order)
    lines = items.select(*LINE_KEY, *LINE_COLUMNS)
    who = customers.select(
        *CUSTOMER_COLUMNS, F.col("region").alias("customer_region"), F.lit(True).alias("has_customer")
    )
    order_header = orders.select(*ORDER_COLUMNS).join(who, "customer_id", "left")
    joined = (
        flag_returns(lines, returns)
        .join(products.select(*PRODUCT_COLUMNS, F.lit(True).alias("has_product")), "product_id", "left")
        .join(order_header, "order_id", "left")
        .na.fill({"has_customer": False, "has_product": False})
    )
    return with_line_measures(joined.select("product_id", "order_id", *LINE_COLUMNS, "is_return",
                                            *[c for c in order_header.columns if c != "order_id"], *PRODUCT_COLUMNS[1:], "has_product"))


def date_spine(bounds: DataFrame, name: str = "ds") -> DataFrame:
    """One row per day between the columns ``lo`` and ``hi`` of a one-row frame."""
    return bounds.filter("lo IS NOT NULL AND hi IS NOT NULL").select(
        F.explode(F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))).alias(name)
    )


def dim_date_warehouse(bounds: DataFrame, padded: bool = False) -> DataFrame:
    """Warehouse calendar: Sunday = 0, weekend is Sunday or Saturday, ISO week.

    ``padded`` blanks month and day names to nine characters, as some warehouses store them.
    """
    d = F.col("date_key")
    dow = dates.dow_sunday0(d)
    month_name, day_name = F.date_format(d, "MMMM"), F.date_format(d, "EEEE")
    if padded:
        month_name, day_name = F.rpad(month_name, 9, " "), F.rpad(day_name, 9, " ")
    return date_spine(bounds, "date_key").select(
        d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        month_name.alias("month_name"), F.weekofyear(d).alias("week"), dow.alias("day_of_week"),
        day_name.alias("day_name"), dow.isin(0, 6).alias("is_weekend"),
    )


def order_date_bounds(orders: DataFrame) -> DataFrame:
    """First order date .. last order or shipping date."""
    return orders.agg(
        F.min("order_date").alias("lo"),
        F.greatest(F.max("order_date"), F.max("shipping_date")).alias("hi"),
    )


def dim_date_bi(bounds: DataFrame) -> DataFrame:
    """BI calendar: Monday = 0, weekend is 5 or 6."""
    d = F.col("Date")
    dow = dates.dow_monday0(d)
    return date_spine(bounds, "Date").select(
        d, F.year(d).alias("Year"), F.quarter(d).alias("Quarter"), F.month(d).alias("Month"),
        F.date_format(d, "MMM").alias("MonthName"), F.weekofyear(d).alias("Week"), dow.alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"), (dow >= 5).alias("IsWeekend"),
        dates.month_label(d).alias("MonthYear"), dates.quarter_label(d).alias("QuarterLabel"),
    )


DAILY_KEYS = ["order_date", "category", "sub_category", "brand", "customer_region"]


def daily_sales(fact: DataFrame) -> DataFrame:
    """Daily aggregate over date, category, sub-category, brand and customer region.

    Two distinct counts: lines fold into one row per order first, then only customers need a distinct
    aggregate; that avoids Spark's Expand, which would double the rows before the shuffle.
    """
    known = fact.filter("has_product AND has_customer")
    per_order = known.groupBy(*DAILY_KEYS, "order_id").agg(
        F.first("customer_id").alias("customer_id"),
        F.sum("quantity").alias("units"), F.sum("revenue").alias("rev"), F.sum("profit").alias("pro"),
        F.sum("cost_total").alias("cost"), F.count_if("is_return").alias("ret"),
    )
    return per_order.groupBy(*DAILY_KEYS).agg(
        F.count("order_id").alias("orders"), F.count_distinct("customer_id").alias("customers"),
        F.sum("units").alias("units_sold"), F.sum("rev").cast("decimal(28,4)").alias("revenue"),
        F.sum("pro").cast("decimal(28,4)").alias("profit"), F.sum("cost").cast("decimal(28,4)").alias("total_cost"),
        F.sum("ret").alias("returns_count"),
    ).select(
        F.col("order_date").alias("date_key"), "category", "sub_category", "brand",
        F.col("customer_region").alias("region"), "orders", "customers", "units_sold", "revenue", "profit",
        "total_cost", pct("profit", "revenue").alias("profit_margin_pct"), "returns_count",
    )
