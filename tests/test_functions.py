import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.functions import bands, dates, geo, lines
from salesloom.functions.ratios import divide0, pct, per, round_half_up


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v")).alias("x")).collect()]


DISCOUNTS = [Decimal(x) for x in ("0", "0.5", "1", "10", "10.5", "20", "21", "30", "30.5", "-1", "100", "101")]


def test_discount_band_flavours_differ_where_they_should(spark):
    sql = column(spark, DISCOUNTS, "decimal(5,2)", bands.discount_band_sql)
    bins = column(spark, DISCOUNTS, "decimal(5,2)", bands.discount_band_bins)
    bi = column(spark, DISCOUNTS, "decimal(5,2)", bands.discount_band_bi)
    assert sql == ["0%", "30%+", "1-10%", "1-10%", "30%+", "11-20%", "21-30%", "21-30%", "30%+", "30%+", "30%+", "30%+"]
    assert bins == ["0%", "1-10%", "1-10%", "1-10%", "11-20%", "11-20%", "21-30%", "21-30%", "30%+", None, "30%+", None]
    assert bi == ["No Discount", "1-10%", "1-10%", "1-10%", "11-20%", "11-20%", "21-30%", "21-30%", "30%+", "1-10%", "30%+", "30%+"]


def test_flavours_agree_on_multiples_of_five(spark):
    fives = [Decimal(x) for x in range(0, 71, 5)]
    sql = column(spark, fives, "decimal(5,2)", bands.discount_band_sql)
    assert sql == column(spark, fives, "decimal(5,2)", bands.discount_band_bins)
    assert [s.replace("0%", "No Discount") if s == "0%" else s for s in sql] == column(spark, fives, "decimal(5,2)", bands.discount_band_bi)


@pytest.mark.parametrize("function, values, want", [
    (bands.order_tier, [1, 2, 3, 4, 5, 9], ["Bronze", "Silver", "Gold", "Gold", "Platinum", "Platinum"]),
    (bands.value_segment, [9999, 10000, 49999, 50000], ["Low", "Medium", "Medium", "High"]),
    (bands.revenue_segment, [4999, 5000, 10000, 50000], ["Bronze", "Silver", "Gold", "Platinum"]),
    (bands.order_frequency, [1, 2, 3, 4, 5, 9, 10], ["1 order", "2 orders", "3-4 orders", "3-4 orders", "5-9 orders", "5-9 orders", "10+ orders"]),
    (bands.margin_tier, [36, 35, 15, 14, 0, -1], ["Profit Engines", "Volume Drivers", "Volume Drivers", "Margin Squeeze", "Margin Squeeze", "Loss Leaders"]),
    (bands.margin_colour, [31, 30, 11, 1, 0], ["dark green", "green", "yellow", "orange", "red"]),
    (bands.return_level, [21, 20, 10], ["high", "medium", "low"]),
])
def test_tiers(spark, function, values, want):
    assert column(spark, values, "int", function) == want


def test_annual_value(spark):
    df = spark.createDataFrame([(Decimal("100.00"), 0), (Decimal("100.00"), 73)], "t decimal(12,2), d int")
    got = [r[0] for r in df.select(bands.annual_value(F.col("t"), F.col("d"))).collect()]
    assert got == [100.0, 500.0]


@pytest.mark.parametrize("first, later, want", [
    ("2023-01-31", "2023-02-28", 0), ("2023-01-31", "2023-03-01", 1), ("2023-01-15", "2024-01-15", 12), ("2023-01-15", "2023-01-15", 0),
])
def test_elapsed_months(spark, first, later, want):
    a, b = (F.lit(dt.date.fromisoformat(x)) for x in (first, later))
    assert spark.range(1).select(dates.elapsed_months(a, b)).first()[0] == want


def test_parse_date(spark):
    got = column(spark, ["2022-05-03", "05-03-2022", "", None, "2022-13-01"], "string", dates.parse_date)
    assert got == [dt.date(2022, 5, 3), None, None, None, None]


def test_weekdays(spark):
    d = F.lit(dt.date(2023, 1, 1))  # a Sunday in ISO week 52
    row = spark.range(1).select(dates.dow_sunday0(d), dates.dow_monday0(d), F.weekofyear(d), dates.month_label(d), dates.quarter_label(d)).first()
    assert tuple(row) == (0, 6, 52, "2023-01", "Q1 2023")


def test_ratios_never_divide_by_zero(spark):
    df = spark.createDataFrame([(Decimal("5.00"), 0), (None, 3), (Decimal("1.00"), 8)], "a decimal(10,2), b int")
    got = [tuple(r) for r in df.select(pct("a", "b"), per("a", "b"), divide0("a", "b")).collect()]
    assert got == [(None, None, 0.0), (None, None, 0.0), (12.5, 0.13, 0.125)]


def test_rounding_decides_ties_as_decimals_do(spark):
    x = F.lit(255959.55) / F.lit(6.0)  # 42659.925, stored as 42659.924999999996
    assert spark.range(1).select(round_half_up(x)).first()[0] == 42659.93


def test_line_measures_keep_unknown_cost_null(spark):
    df = spark.createDataFrame(
        [(2, Decimal("10.5000"), Decimal("10.00"), Decimal("4.2500")), (1, Decimal("3.0000"), Decimal("0.00"), None)],
        "quantity int, selling_price decimal(12,4), discount decimal(5,2), cost_price decimal(12,4)")
    got = [tuple(r) for r in lines.with_line_measures(df).select("revenue", "cost_total", "profit", "discount_impact").collect()]
    assert got == [(Decimal("21.0000"), Decimal("8.5000"), Decimal("12.5000"), Decimal("2.100000")),
                   (Decimal("3.0000"), None, None, Decimal("0E-6"))]


def test_unit_margin_matches_published_value(spark):
    df = spark.createDataFrame([(Decimal("1591.65"), Decimal("2886.00")), (Decimal("5"), Decimal("0"))],
                               "cost_price decimal(12,4), selling_price decimal(12,4)")
    assert [r[0] for r in df.select(lines.unit_margin_pct()).collect()] == [44.85, None]


def test_region_coordinates(spark):
    df = spark.createDataFrame([("East",), ("Nowhere",)], "r string")
    assert [tuple(r) for r in df.select(geo.latitude(F.col("r")), geo.longitude(F.col("r"))).collect()] == [(22.5, 88.3), (None, None)]
