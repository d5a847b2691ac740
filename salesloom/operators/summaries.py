"""Exploratory summaries, export tables and chart data over the raw fact.

Null groups are left out and empty sums count as 0, as data-frame users expect. "return_rate" here means
flagged lines per distinct order; "line_return_rate" is the share of flagged lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.functions import bands, dates, geo
from salesloom.functions.lines import line_margin_pct, unit_margin_pct
from salesloom.functions.ratios import div, pct, per
from salesloom.plans.ordered import Ordered, Store, checkpointed, ordered


def total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def flagged() -> Column:
    return F.count_if("is_return")


def line_return_rate() -> Column:
    """Share of returned lines in percent."""
    return pct(flagged(), F.count("is_return"))


def orders_and_customers(fact: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, Column]) -> DataFrame:
    """Per group: ``sums`` of line expressions by name, distinct orders, distinct customers, and customers with several orders.

    Sums come straight from the lines. For the counts lines fold to (order, customer): an order may come under two customers, and both count whatever else
    is asked for. Orders and customers are then counted apart on folded rows that carry nothing but keys, so Spark never expands the lines once per distinct
    column, a customer or order that holds very many lines shrinks before the shuffle, and what is shuffled stays narrow.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    summed = fact.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias("_lines")).where("_lines > 0").drop("_lines")
    lines = fact.select(*keys, "order_id", "customer_id").distinct()
    keys = [F.col(c) for c in lines.columns[: len(keys)]]
    orders = lines.select(*keys, "order_id").distinct().groupBy(*keys).agg(F.count("order_id").alias("orders"))
    known = F.col("customer_id").isNotNull()
    customers = lines.groupBy(*keys, "customer_id").agg(F.count("order_id").alias("own")).groupBy(*keys).agg(
        F.count("customer_id").alias("customers"), F.count_if(known & (F.col("own") > 1)).alias("repeaters"))
    both = summed.unionByName(orders, allowMissingColumns=True).unionByName(customers, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums], *[total(n).alias(n) for n in ("orders", "customers", "repeaters")])


def headline_totals(fact: DataFrame, **extra: Column) -> DataFrame:
    """One row of totals. ``extra`` adds sums of further line expressions by name."""
    sums = {"revenue": F.sum("revenue"), "profit": F.sum("profit"), "discount": F.sum("discount"), **{n: F.sum(c) for n, c in extra.items()},
            "returns": flagged(), "lines": F.count(F.lit(1)), "discounted_lines": F.count("discount")}
    one = orders_and_customers(fact, [], sums)
    return one.select(*[F.coalesce(n, F.lit(0)).alias(n) for n in sums], "orders", "customers", "repeaters")


def overview(fact: DataFrame) -> DataFrame:
    """A1."""
    return headline_totals(fact).select(
        "revenue", "profit", pct("profit", "revenue").alias("margin_pct"), "orders", "customers",
        per("revenue", "orders").alias("aov"), pct("returns", "lines").alias("return_rate_pct"),
    )


def by_category(fact: DataFrame) -> DataFrame:
    """A2."""
    return (
        fact.filter("category IS NOT NULL").groupBy("category")
        .agg(total("revenue").alias("revenue"), total("profit").alias("profit"),
             F.count_distinct("order_id").alias("orders"), flagged().alias("returns"))
        .withColumns({"margin": pct("profit", "revenue"), "return_rate": pct("returns", "orders")})
        .orderBy(F.desc("revenue"), "category")
    )


def by_region(fact: DataFrame) -> DataFrame:
    """A3. Region of the order."""
    return (
        fact.filter("region IS NOT NULL").groupBy("region")
        .agg(total("revenue").alias("revenue"), total("profit").alias("profit"),
             F.count_distinct("order_id").alias("orders"))
        .withColumn("margin", pct("profit", "revenue"))
        .orderBy(F.desc("revenue"), "region")
    )


def by_discount_band(fact: DataFrame) -> DataFrame:
    """A4. Right-closed bins; lines outside (-1, 100] are left out."""
    return (
        fact.groupBy(bands.discount_band_bins(F.col("discount")).alias("disc_band"))
        .agg(F.count("revenue").alias("transactions"), total("revenue").alias("revenue"), total("profit").alias("profit"))
        .filter("disc_band IS NOT NULL")
        .withColumns({"margin": pct("profit", "revenue"), "band_order": bands.band_order(F.col("disc_band"))})
        .orderBy("band_order")
    )


def customer_profiles(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """A5. Buyers with their attributes; customers who never bought drop out."""
    spent = (
        fact.filter("customer_id IS NOT NULL").groupBy("customer_id")
        .agg(
            total("revenue").alias("total_revenue"), total("profit").alias("total_profit"),
            F.count_distinct("order_id").alias("orders"), div(F.sum("discount"), F.count("discount")).alias("avg_discount"),
            flagged().alias("return_count"), F.max("order_date").alias("last_order"), F.min("order_date").alias("first_order"),
        )
        .withColumns({
            "clv": F.col("total_profit"), "aov": div("total_revenue", "orders"),
            "return_rate": pct("return_count", "orders"),
            "customer_lifetime_days": F.datediff("last_order", "first_order"),
        })
    )
    return customers.join(spent, "customer_id")


def region_category(fact: DataFrame, coords: Mapping[str, tuple[float, float]] = geo.REGION_COORDS) -> DataFrame:
    """A6 with map coordinates of the region."""
    known = fact.filter("region IS NOT NULL AND category IS NOT NULL")
    return (
        orders_and_customers(known, ["region", "category"], {
            "revenue": total("revenue"), "profit": total("profit"), "returns": flagged()})
        .select("region", "category", "revenue", "profit", "orders", "returns", "customers")
        .withColumns({
            "margin_pct": pct("profit", "revenue"), "return_rate": pct("returns", "orders"),
            "latitude": geo.latitude(F.col("region"), coords), "longitude": geo.longitude(F.col("region"), coords),
        })
        .orderBy("region", "category")
    )


def monthly(fact: DataFrame) -> DataFrame:
    """A7."""
    return (
        fact.filter("order_date IS NOT NULL").groupBy(dates.month_label("order_date").alias("order_date"))
        .agg(total("revenue").alias("revenue"), total("profit").alias("profit"),
             F.count_distinct("order_id").alias("orders"), flagged().alias("returns"))
        .withColumn("margin_pct", pct("profit", "revenue"))
        .orderBy("order_date")
    )


def sales_detail(fact: DataFrame) -> DataFrame:
    """The 17 columns of the detail export."""
    d = F.col("order_date")
    return fact.select(
        "order_id", "order_date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        "region", "payment_mode", "category", "sub_category", "brand", "product_id", "quantity", "revenue", "profit",
        "discount", line_margin_pct().alias("margin_pct"), "is_return",
    )


def products_per_category(products: DataFrame) -> DataFrame:
    """A9."""
    return products.filter("category IS NOT NULL").groupBy("category").agg(F.count(F.lit(1)).alias("product_count"))


def line_return_rate_by(fact: DataFrame, key: str) -> DataFrame:
    """A10: share of returned lines per group."""
    return fact.filter(F.col(key).isNotNull()).groupBy(key).agg(line_return_rate().alias("line_return_rate_pct"))


def bi_customers(customers: DataFrame) -> DataFrame:
    """Customers with the signup date as ISO text, NULL where it does not parse."""
    return customers.withColumn("signup_date", F.date_format(dates.parse_date("signup_date"), "yyyy-MM-dd"))


def bi_products(products: DataFrame) -> DataFrame:
    """A11, M6."""
    return products.withColumn("unit_margin_pct", unit_margin_pct())


def bi_fact(fact: DataFrame) -> DataFrame:
    """Fact without the shipping date, with the line margin."""
    return fact.select(
        "order_id", "product_id", "quantity", "selling_price", "discount", "customer_id", "order_date", "region",
        "payment_mode", "category", "sub_category", "brand", "cost_price", "revenue", "cost_total", "profit",
        "discount_impact", "is_return", line_margin_pct().alias("margin_pct"),
    )


def table_head(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """L4: the first rows of a table for a printed report, as a top-k per partition."""
    return df.orderBy(*order).limit(rows)


# ---- chart data -------------------------------------------------------------------------------------------


def kpi_strip(fact: DataFrame) -> DataFrame:
    """K1."""
    return overview(fact).select("revenue", "profit", "margin_pct", "orders", "aov")


def category_chart(fact: DataFrame) -> DataFrame:
    """K2, smallest revenue first."""
    return by_category(fact).select("category", "revenue", "margin", "return_rate").orderBy("revenue", "category")


def region_chart(fact: DataFrame) -> DataFrame:
    """K3."""
    return by_region(fact).select("region", "revenue", "margin").orderBy("revenue", "region")


def discount_chart(fact: DataFrame) -> DataFrame:
    """K4: margin per band with a colour class."""
    return by_discount_band(fact).select(
        "disc_band", "band_order", "revenue", "margin", bands.margin_colour(F.col("margin")).alias("colour")
    ).orderBy("band_order")


def customer_revenue(fact: DataFrame) -> DataFrame:
    return fact.filter("customer_id IS NOT NULL").groupBy("customer_id").agg(total("revenue").alias("revenue"))


def pareto_index(fact: DataFrame, store: Store) -> Ordered:
    """Customers from the largest down with running revenue; written once."""
    return ordered(customer_revenue(fact), [F.desc("revenue"), "customer_id"], {"cum_revenue": F.col("revenue")}, store, position="position", overall="_all")


def pareto_curve(fact: DataFrame, customers: Ordered | None = None) -> DataFrame:
    """Customers from the largest down with their percentile and the cumulative revenue share; ``customers`` is the index of ``fact``, if there is one."""
    return (customers or pareto_index(fact, checkpointed)).read().select(
        "customer_id", "revenue", "position", "cum_revenue",
        F.col("position_all").alias("customers"), F.col("cum_revenue_all").alias("total_revenue"),
        pct("position", "position_all", 6).alias("customer_pct"), pct("cum_revenue", "cum_revenue_all", 6).alias("revenue_pct"),
    )


def monthly_peaks(fact: DataFrame) -> DataFrame:
    """K6: months with the best and the worst marked (ties: the earliest)."""
    down = F.row_number().over(W.orderBy(F.desc("revenue"), "order_date"))
    up = F.row_number().over(W.orderBy("revenue", "order_date"))
    return monthly(fact).select(
        F.col("order_date").alias("month"), "revenue", "profit", (down == 1).alias("is_peak"), (up == 1).alias("is_low")
    )


def return_benchmark(fact: DataFrame, benchmark: float = 10.0) -> DataFrame:
    """K7: return rate per category against a benchmark."""
    return by_category(fact).select(
        "category", "return_rate", bands.return_level(F.col("return_rate")).alias("level"),
        F.lit(benchmark).alias("benchmark"), F.round(F.col("return_rate") - benchmark, 2).alias("gap"),
    ).orderBy("return_rate", "category")


def return_reasons(returns: DataFrame) -> DataFrame:
    """K9: returns per reason with their share."""
    known = returns.filter("return_reason IS NOT NULL")
    everything = known.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = known.groupBy("return_reason").agg(F.count(F.lit(1)).alias("returns"))
    return counted.withColumn("share_pct", pct("returns", everything)).orderBy(F.desc("returns"), "return_reason")


def order_value_by_region(fact: DataFrame) -> DataFrame:
    """Revenue per distinct order."""
    return by_region(fact).select("region", "revenue", "orders", per("revenue", "orders").alias("aov")).orderBy(F.desc("aov"))


def payment_returns(fact: DataFrame) -> DataFrame:
    """Share of returned lines and distinct orders per payment mode."""
    return (
        fact.filter("payment_mode IS NOT NULL").groupBy("payment_mode")
        .agg(line_return_rate().alias("line_return_rate_pct"), F.count_distinct("order_id").alias("orders"))
        .orderBy("line_return_rate_pct", "payment_mode")
    )


def filter_profile(fact: DataFrame, filters: Mapping[str, Column]) -> DataFrame:
    """Lines and revenue under each named filter, all in one scan."""
    names = list(filters)
    counted = fact.agg(*[
        F.struct(F.count_if(cond).alias("line_count"),
                 F.coalesce(F.sum(F.when(cond, F.col("revenue"))), F.lit(0)).alias("revenue")).alias(name)
        for name, cond in filters.items()
    ])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("filter_name"), F.col(n).alias("v")) for n in names]))
    return counted.select(rows.alias("r")).select("r.filter_name", "r.v.line_count", "r.v.revenue")


def line_filters() -> dict[str, Column]:
    """The row filters of the reports."""
    mode, c = F.col("payment_mode"), F.col
    return {
        "p01_cod": mode == "COD",
        "p01_not_cod": ~mode.eqNullSafe("COD"),  # rows without a payment mode stay in
        "p03_discount_from_20": c("discount") >= 20,
        "p06_returned": c("is_return"),
        "p08_cost_at_or_above_price": c("cost_price") >= c("selling_price"),
        "p08_shipped_before_order": c("shipping_date") < c("order_date"),
        "p09_discount_11_to_20": c("discount").between(11, 20),
        "p10_payment_mode_known": mode.isNotNull(),
    }


def segment_filters(category: str, region: str, years: Sequence[int]) -> dict[str, Column]:
    """Equality, membership and slicer filters."""
    band = bands.discount_band_bins(F.col("discount"))
    return {
        "p02_category": F.col("category") == category,
        "p02_region": F.col("region") == region,
        "p07_deep_discount": band.isin(bands.DISCOUNT_LABELS[3:]),
        "p11_slicer": F.year("order_month").isin(list(years)) & (F.quarter("order_month") == 1) & (F.col("region") == region),
    }
