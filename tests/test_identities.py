"""Properties that must hold on any data."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.operators import catalog, forecast, insights, measures, summaries, visuals


def test_group_sums_add_up(small):
    f = small.fact_raw
    total = f.agg(F.sum("revenue")).first()[0]
    for part in (summaries.by_category(f), summaries.by_region(f), summaries.by_discount_band(f), summaries.monthly(f), summaries.region_category(f)):
        assert part.agg(F.sum("revenue")).first()[0] == total
    assert summaries.overview(f).first()["revenue"] == total


def test_shares_add_up_to_one_hundred(small):
    for df in (catalog.repeat_purchases(small.fact_clean).select(F.sum("pct_of_customers")),
               insights.product_margin_tiers(small.fact_raw).select(F.sum("share_pct")),
               measures.segment_distribution(small.fact_raw).select(F.sum("share_pct")),
               summaries.return_reasons(small.raw.returns).select(F.sum("share_pct"))):
        assert abs(df.first()[0] - 100) < 0.05


def test_cohorts_start_complete(small):
    at_start = catalog.cohort_retention(small.fact_clean).filter("month_offset = 0")
    assert {r["retention_pct"] for r in at_start.collect()} == {100.0}


def test_running_total_ends_at_the_customer_total(small):
    journey = catalog.customer_journey(small.fact_clean)
    last = journey.groupBy("customer_id").agg(F.max("running_total_revenue").alias("a"))
    totals = small.fact_clean.groupBy("customer_id").agg(F.sum("revenue").alias("b"))
    assert last.join(totals, "customer_id").filter("a <> b").count() == 0


def test_journey_keeps_every_line(small):
    assert catalog.customer_journey(small.fact_clean).count() == small.fact_clean.count()


def test_pareto_curve_is_complete_and_monotone(small):
    curve = summaries.pareto_curve(small.fact_raw)
    rows = curve.orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows[-1]["cum_revenue"] == rows[-1]["total_revenue"]
    assert all(a["revenue"] >= b["revenue"] for a, b in zip(rows, rows[1:]))


def test_year_to_date_ends_at_the_year_total(small):
    per_year = W.partitionBy(F.year("order_date"))
    todate = measures.period_to_date(small.fact_raw).withColumn("t", F.sum("revenue").over(per_year)).withColumn(
        "last", F.max("order_date").over(per_year)).filter("order_date = last")
    assert todate.filter("revenue_ytd <> t").count() == 0


def test_matrix_total_equals_overview(small):
    total = visuals.category_matrix(small.fact_raw).filter("level = 3").first()
    assert total["revenue"] == summaries.overview(small.fact_raw).first()["revenue"]


def test_measures_with_and_without_the_order_fold_agree(small):
    both = measures.measures(small.fact_raw, ["total_orders", "total_customers", "total_revenue"], ["region"])
    alone = measures.measures(small.fact_raw, ["total_customers", "total_revenue"], ["region"])
    assert both.drop("total_orders").exceptAll(alone).count() == 0


def test_filters_cover_their_complement(small):
    rows = {r["filter_name"]: r["line_count"] for r in summaries.filter_profile(small.fact_raw, summaries.line_filters()).collect()}
    assert rows["p01_cod"] + rows["p01_not_cod"] == small.fact_raw.count()


def test_filled_days_are_gapless(small):
    days = forecast.fill_days(forecast.daily_series(small.fact_raw))
    n, lo, hi = days.agg(F.count("*"), F.min("ds"), F.max("ds")).first()
    assert n == (hi - lo).days + 1


def test_counts_do_not_depend_on_other_measures(spark):
    from pyspark.sql import functions as F
    from salesloom.operators import measures, visuals
    rows = [(1, 10, "East", "A", 5.0), (1, 11, "East", "A", 7.0), (2, 10, "East", "B", 1.0), (None, None, "West", "A", 2.0), (None, 12, None, "B", 3.0), (3, None, "West", "B", 4.0)]
    fact = spark.createDataFrame(rows, "order_id long, customer_id long, region string, category string, revenue double").withColumns({
        "profit": F.col("revenue"), "quantity": F.lit(1), "is_return": F.lit(False), "discount": F.lit(0.0), "discount_impact": F.lit(0.0)})
    both = measures.measures(fact, ["total_customers", "total_orders", "total_revenue"]).first()
    for name in ("total_customers", "total_orders", "total_revenue"):
        assert measures.measures(fact, [name]).first()[0] == both[name]
    assert tuple(both) == (3, 3, 22.0)
    assert summaries.overview(fact).select("orders", "customers").first() == (3, 3)
    assert visuals.customer_cards(fact).first()["repeat_rate_pct"] == 33.33
    by = {tuple(r)[0]: tuple(r)[1:] for r in measures.measures(fact, ["total_customers", "total_orders", "total_revenue"], ["region"]).collect()}
    assert by == {"East": (2, 2, 13.0), "West": (0, 1, 6.0), None: (1, 0, 3.0)}
    cells = {(r["region"], r["category"]): (r["customers"], r["orders"]) for r in summaries.region_category(fact).collect()}
    assert cells == {("East", "A"): (2, 1), ("East", "B"): (1, 1), ("West", "A"): (0, 0), ("West", "B"): (0, 1)}
