"""Insights and scenario metrics (I1-I22) over the raw fact.

Single figures that meet in one result are combined as scalar subqueries, never by a cross join.
Scenario factors are parameters; their defaults are the reports' fixed values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.functions import bands
from salesloom.functions.ratios import div, nonzero, pct, per, round_half_up
from salesloom.operators.catalog import PRODUCT, orders_per_customer, product_totals
from salesloom.operators.summaries import (
    by_discount_band, by_region, headline_totals, line_return_rate, monthly, overview, pareto_curve, total,
)

# Factors of the scenarios.
COD_RETURN_RATE = 0.272
RESTOCKING_SHARE = 0.25
MIN_RETURN_RATE = 14.15
RETURN_PROFIT_SHARE = 0.18
REACTIVATION_RATE = 0.20
CHURN_SHARE = 0.25
DEEP_BANDS = ("21-30%", "30%+")
INITIATIVE_COSTS = {"Discount Governance": 50000, "COD-to-Prepaid Conversion": 120000,
                    "High-Value Customer Retention": 300000, "Category Mix Optimization": 100000}
FIXED_IMPACTS = {"High-Value Customer Retention": 2400000, "Category Mix Optimization": 850000}
REVENUE_GROWTH = 1.15
KPI_TARGETS = {"profit": 5.0e6, "margin_pct": 28.0, "aov": 1800.0, "clv": 15000.0, "return_rate_pct": 10.0,
               "repeat_rate_pct": 75.0, "revenue_per_customer": 12000.0, "avg_discount": 8.0}


def _value(frame: DataFrame, column: str) -> Column:
    """Scalar subquery: one column of a one-row frame."""
    return frame.select(column).scalar()


def concentration(fact: DataFrame, top: Sequence[float] = (0.2,), bottom: Sequence[float] = (), curve: DataFrame | None = None) -> DataFrame:
    """Revenue share of the largest (or smallest) floor(fraction x n) customers; ``curve`` is the Pareto curve, if there is one."""
    curve = pareto_curve(fact) if curve is None else curve
    n, position = F.col("customers"), F.col("position")
    cuts = [(f"top {f:g}", position <= F.floor(n * f), F.floor(n * f)) for f in top]
    cuts += [(f"bottom {f:g}", position > n - F.floor(n * f), F.floor(n * f)) for f in bottom]
    one = curve.agg(
        F.max("total_revenue").alias("total_revenue"),
        *[F.struct(F.coalesce(F.sum(F.when(cond, F.col("revenue"))), F.lit(0)).alias("revenue"), F.max(size).alias("customers"))
          .alias(name) for name, cond, size in cuts],
    )
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("cutoff"), F.col(f"`{name}`").alias("v")) for name, _, _ in cuts]))
    return one.select("total_revenue", rows.alias("r")).select(
        "r.cutoff", "r.v.customers", "r.v.revenue", pct("r.v.revenue", "total_revenue").alias("share_pct")
    )


def fraction_reaching(fact: DataFrame, share: float = 0.8, curve: DataFrame | None = None) -> DataFrame:
    """Fraction of customers passed, from the largest down, before ``share`` of the revenue is reached."""
    curve = pareto_curve(fact) if curve is None else curve
    reached = div("cum_revenue", "total_revenue") >= share
    return curve.agg(
        F.min(F.when(reached, F.col("position"))).alias("position"), F.max("customers").alias("customers")
    ).select(F.lit(share).alias("share"), "position", "customers", round_half_up(div(F.col("position") - 1, F.col("customers")), 6).alias("fraction"))


def worst_return_category(fact: DataFrame) -> DataFrame:
    """I2, L5."""
    rates = fact.filter("category IS NOT NULL").groupBy("category").agg(line_return_rate().alias("line_return_rate_pct"))
    return rates.orderBy(F.desc("line_return_rate_pct"), "category").limit(1)


def margin_extremes(fact: DataFrame) -> DataFrame:
    """Regions with the lowest and the highest margin."""
    margins = by_region(fact).select(F.struct(div("profit", "revenue").alias("m"), F.col("region").alias("region")).alias("s"))
    return margins.agg(F.min("s").alias("lo"), F.max("s").alias("hi")).select(
        F.col("lo.region").alias("worst_region"), round_half_up(F.col("lo.m") * 100).alias("worst_margin_pct"),
        F.col("hi.region").alias("best_region"), round_half_up(F.col("hi.m") * 100).alias("best_margin_pct"),
    )


def deep_discount_margin(fact: DataFrame, threshold: int = 20) -> DataFrame:
    """I4: margin of lines from ``threshold`` % discount on against all lines, in one scan."""
    deep = F.col("discount") >= threshold
    sums = fact.agg(
        F.sum(F.when(deep, F.col("profit"))).alias("dp"), F.sum(F.when(deep, F.col("revenue"))).alias("dr"),
        F.sum("profit").alias("p"), F.sum("revenue").alias("r"),
    )
    return sums.select(
        pct("dp", "dr").alias("deep_margin_pct"), pct("p", "r").alias("overall_margin_pct"),
        round_half_up(div("p", "r") * 100 - div("dp", "dr") * 100).alias("gap_pp"),
    )


def repeat_rate(fact: DataFrame) -> DataFrame:
    """I5."""
    counts = orders_per_customer(fact.filter("customer_id IS NOT NULL"))
    return counts.agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("order_count") > 1).alias("repeaters")
    ).select("customers", "repeaters", pct("repeaters", "customers").alias("repeat_rate_pct"))


def cod_risk(fact: DataFrame, mode: str = "COD") -> DataFrame:
    """Line return rate of one payment mode against all other lines (those without a mode included)."""
    is_mode = F.col("payment_mode").eqNullSafe(mode)
    c = fact.agg(
        F.count_if(is_mode).alias("a"), F.count_if(is_mode & F.col("is_return")).alias("ar"),
        F.count_if(~is_mode).alias("b"), F.count_if(~is_mode & F.col("is_return")).alias("br"),
    )
    return c.select(
        pct("ar", "a").alias("cod_return_pct"), pct("br", "b").alias("prepaid_return_pct"),
        round_half_up(div(div("ar", "a"), div("br", "b"))).alias("ratio"),
    )


def order_value_change(fact: DataFrame) -> DataFrame:
    """Change of revenue per order from the first to the last month."""
    aov = monthly(fact).select(F.struct("order_date", div("revenue", "orders").alias("aov")).alias("s"))
    return aov.agg(F.min("s").alias("a"), F.max("s").alias("z")).select(
        F.col("a.order_date").alias("first_month"), F.col("z.order_date").alias("last_month"),
        round_half_up((F.col("z.aov") - F.col("a.aov")) / nonzero(F.col("a.aov")) * 100).alias("aov_change_pct"),
    )


def cod_orders(orders: DataFrame, mode: str = "COD") -> DataFrame:
    """I8: orders of one payment mode and their share of the orders table."""
    return orders.agg(F.count_if(F.col("payment_mode") == mode).alias("cod_orders"), F.count(F.lit(1)).alias("orders")).select(
        "cod_orders", "orders", pct("cod_orders", "orders", 1).alias("cod_pct")
    )


def _cod_cost(cod: Column, aov: Column, rate: float = COD_RETURN_RATE, share: float = RESTOCKING_SHARE) -> Column:
    return round_half_up(cod * rate * aov * share, 0)


def _leakage(revenue: Column, rate: Column, floor: float = MIN_RETURN_RATE, share: float = RETURN_PROFIT_SHARE) -> Column:
    return round_half_up(revenue.cast("double") * (F.greatest(rate, F.lit(floor)) / 100.0) * share, 0)


def _recovery(revenue: Column, gap_pp: Column) -> Column:
    return round_half_up(revenue * (gap_pp / 100.0), 0)


def cod_return_cost(fact: DataFrame, orders: DataFrame, rate: float = COD_RETURN_RATE, share: float = RESTOCKING_SHARE) -> DataFrame:
    """I9."""
    return cod_orders(orders).select("cod_orders", _value(overview(fact), "aov").alias("aov")).withColumn(
        "cod_return_cost", _cod_cost(F.col("cod_orders"), F.col("aov"), rate, share)
    )


def profit_at_risk(fact: DataFrame, floor: float = MIN_RETURN_RATE, share: float = RETURN_PROFIT_SHARE) -> DataFrame:
    """I10."""
    return overview(fact).select(
        "revenue", "return_rate_pct", _leakage(F.col("revenue"), F.col("return_rate_pct"), floor, share).alias("profit_at_risk")
    )


def margin_gap(fact: DataFrame, target: str, benchmark: str) -> DataFrame:
    """What the target region would earn at the benchmark region's margin."""
    r = by_region(fact).filter(F.col("region").isin(target, benchmark))
    one = r.agg(*[
        F.max(F.when(F.col("region") == name, F.col(column).cast("double"))).alias(alias)
        for name, column, alias in ((target, "margin", "target_margin"), (benchmark, "margin", "benchmark_margin"),
                                    (target, "revenue", "target_revenue"))
    ])
    return one.withColumn("gap_pp", round_half_up(F.col("benchmark_margin") - F.col("target_margin"), 1)).withColumn(
        "recovery", _recovery(F.col("target_revenue"), F.col("gap_pp"))
    )


def loss_leaders(products: DataFrame) -> DataFrame:
    """Products that cost at least their price."""
    return products.agg(F.count_if(F.col("cost_price") >= F.col("selling_price")).alias("loss_leaders"))


def kpis(fact: DataFrame) -> DataFrame:
    """One row of headline figures."""
    return headline_totals(fact).select(
        F.col("revenue").cast("double").alias("revenue"), F.col("profit").cast("double").alias("profit"),
        pct("profit", "revenue").alias("margin_pct"), per("revenue", "orders").alias("aov"), per("profit", "customers").alias("clv"),
        pct("returns", "lines").alias("return_rate_pct"), pct("repeaters", "customers").alias("repeat_rate_pct"),
        per("revenue", "customers").alias("revenue_per_customer"), per("discount", "discounted_lines").alias("avg_discount"),
    )


def yearly_growth(fact: DataFrame) -> DataFrame:
    """One row: revenue of the last full calendar year (``current``) and of the year before (``before``).

    A year is full once its last day has sales or a later year has. There is one row a year before the last step.
    """
    years = fact.filter("order_date IS NOT NULL").groupBy(F.year("order_date").alias("year")).agg(
        F.sum("revenue").cast("double").alias("revenue"), F.max("order_date").alias("day"))
    seen = years.agg(F.map_from_entries(F.collect_list(F.struct("year", "revenue"))).alias("by_year"),
                     (F.year(F.date_add(F.max("day"), 1)) - 1).alias("last"))
    return seen.select(F.try_element_at("by_year", F.col("last")).alias("current"), F.try_element_at("by_year", F.col("last") - 1).alias("before"))


def kpi_targets(fact: DataFrame, targets: Mapping[str, float] = KPI_TARGETS, growth: float = REVENUE_GROWTH) -> DataFrame:
    """Each figure with its target and the gap.

    ``revenue`` is that of the last full year against ``growth`` times the year before; ``total_revenue`` has no target.
    """
    one = kpis(fact).withColumnRenamed("revenue", "total_revenue")
    wanted = [(c, targets.get(c)) for c in one.columns]
    rows = [F.struct(F.lit(c).alias("kpi"), F.col(c).alias("current"), F.lit(t).cast("double").alias("target")) for c, t in wanted]
    year = yearly_growth(fact).select(F.lit("revenue").alias("kpi"), "current", (F.col("before") * growth).alias("target"))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*").unionByName(year).select(
        "kpi", "current", "target", round_half_up(F.col("current") - F.col("target")).alias("gap")
    )


def deep_band_profit(fact: DataFrame, labels: Sequence[str] = DEEP_BANDS) -> DataFrame:
    """I14."""
    return by_discount_band(fact).filter(F.col("disc_band").isin(list(labels))).agg(
        total("transactions").alias("transactions"), total("revenue").alias("revenue"), total("profit").alias("profit")
    )


def reactivation_value(profile: DataFrame, rate: float = REACTIVATION_RATE) -> DataFrame:
    """Revenue that comes back if ``rate`` of each customer segment is won back."""
    return profile.withColumn("recoverable", round_half_up(F.col("total_revenue") * rate))


def _scenario_inputs(fact: DataFrame, orders: DataFrame, target: str, benchmark: str) -> DataFrame:
    """Everything the scenarios need from the fact, as conditional sums of one scan."""
    def only(condition: Column, column: str) -> Column:
        return F.when(condition, F.col(column))

    region = F.col("region")
    totals = headline_totals(
        fact,
        deep=only(bands.discount_band_bins(F.col("discount")).isin(list(DEEP_BANDS)), "profit"),
        target_profit=only(region == target, "profit"), target_revenue=only(region == target, "revenue"),
        benchmark_profit=only(region == benchmark, "profit"), benchmark_revenue=only(region == benchmark, "revenue"),
    )
    rate = pct("returns", "lines")
    gap = round_half_up(pct("benchmark_profit", "benchmark_revenue") - pct("target_profit", "target_revenue"), 1)
    return totals.select(
        F.col("revenue").cast("double").alias("revenue"), F.floor(F.abs(F.col("deep").cast("double"))).alias("deep_profit"),
        _cod_cost(_value(cod_orders(orders), "cod_orders"), per("revenue", "orders")).alias("cod_return_cost"),
        _leakage(F.col("revenue"), rate).alias("returns_leakage"),
        _recovery(F.col("target_revenue").cast("double"), gap).alias("margin_gap"),
    )


def _labelled(one: DataFrame, values: Mapping[str, Column], label: str, value: str) -> DataFrame:
    rows = [F.struct(F.lit(k).alias(label), v.cast("double").alias(value)) for k, v in values.items()]
    return one.select(F.explode(F.array(*rows)).alias("r")).select(f"r.{label}", f"r.{value}")


def initiative_roi(
    fact: DataFrame, orders: DataFrame, target: str, benchmark: str,
    costs: Mapping[str, float] = INITIATIVE_COSTS, fixed: Mapping[str, float] = FIXED_IMPACTS,
) -> DataFrame:
    """I16: impact, cost and net of each initiative in ``costs``, with a total row.

    An initiative that is neither measured nor in ``fixed`` has a NULL impact.
    """
    one = _scenario_inputs(fact, orders, target, benchmark)
    measured = {"Discount Governance": F.col("deep_profit"), "COD-to-Prepaid Conversion": F.col("cod_return_cost")}
    impact = {name: measured.get(name, F.lit(fixed.get(name)).cast("double")) for name in costs}
    rows = _labelled(one, impact, "initiative", "impact")
    cost = F.try_element_at(F.create_map(*[F.lit(x) for k, v in costs.items() for x in (k, float(v))]), F.col("initiative"))
    table = rows.withColumn("cost", cost).withColumn("net", F.col("impact") - F.col("cost"))
    return table.rollup("initiative").agg(
        F.sum("impact").alias("impact"), F.sum("cost").alias("cost"), F.sum("net").alias("net")
    ).na.fill({"initiative": "Total"})


def revenue_at_risk(
    fact: DataFrame, orders: DataFrame, target: str, benchmark: str, churn: float = CHURN_SHARE, curve: DataFrame | None = None
) -> DataFrame:
    """Exposure by cause."""
    share = _value(concentration(fact, [0.2], curve=curve), "share_pct")
    one = _scenario_inputs(fact, orders, target, benchmark).withColumn("top_share", share)
    return _labelled(one, {
        "customer churn": F.floor(F.col("revenue") * (F.col("top_share") / 100.0) * churn),
        "returns leakage": F.col("returns_leakage"), "COD return cost": F.col("cod_return_cost"),
        "margin gap": F.col("margin_gap"), "discount profit": F.col("deep_profit"),
    }, "risk", "amount")


def product_margin_tiers(fact: DataFrame) -> DataFrame:
    """Products, revenue and revenue share per tier of realised margin."""
    margin = F.col("total_profit").cast("double") * 100.0 / nonzero(F.col("total_revenue").cast("double"))
    tiers = (
        product_totals(fact).filter("total_revenue > 0").groupBy(bands.margin_tier(margin).alias("tier"))
        .agg(F.count(F.lit(1)).alias("products"), F.sum("total_revenue").alias("revenue"))
    )
    return tiers.withColumn("share_pct", pct("revenue", F.sum("revenue").over(W.partitionBy())))


def thin_margin_products(fact: DataFrame, products: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Products whose realised margin is below ``threshold`` percent."""
    return (
        product_totals(fact).filter("total_revenue > 0").withColumn("margin_pct", pct("total_profit", "total_revenue"))
        .filter(F.col("margin_pct") < threshold).join(products.select(*PRODUCT), "product_id")
        .select(*PRODUCT, "total_revenue", "total_profit", "margin_pct")
    )


def repeat_returns(fact: DataFrame, within: int = 60, window: int = 90, more_than: int = 2) -> DataFrame:
    """Customers who return again within ``within`` days, or more than ``more_than`` times in ``window`` days.

    Returned lines fold to (customer, day) first, so a customer's window holds at most one row per day.
    """
    days = (
        fact.filter("is_return AND customer_id IS NOT NULL AND order_date IS NOT NULL")
        .groupBy("customer_id", F.unix_date("order_date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    )
    per = W.partitionBy("customer_id").orderBy("day")
    marked = days.select(
        "customer_id", "n",
        ((F.col("n") > 1) | (F.lead("day").over(per) - F.col("day") <= within)).alias("again"),
        (F.sum("n").over(per.rangeBetween(-window, 0)) > more_than).alias("heavy"),
    )
    customers = marked.groupBy("customer_id").agg(
        F.sum("n").alias("n"), F.coalesce(F.max("again"), F.lit(False)).alias("again"), F.max("heavy").alias("heavy")
    )
    return customers.agg(
        F.count(F.lit(1)).alias("returning_customers"), F.sum("n").alias("returned_lines"),
        F.count_if("again").alias("again_within"), F.count_if("heavy").alias("flagged"),
    ).withColumns({
        "again_pct": pct("again_within", "returning_customers"), "flagged_pct": pct("flagged", "returning_customers"),
    })
