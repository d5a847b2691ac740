import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators import catalog, cleaning, star
from salesloom.sources.tables import RawTables

D = Decimal


@pytest.fixture(scope="module")
def raw(spark):
    make = spark.createDataFrame
    return RawTables(
        customers=make([(1, "A", "Male", 30, "x", "East", "2022-01-01"), (2, "B", None, None, "y", "West", "bad")], schemas.CUSTOMERS),
        products=make([(10, "Books", "S", "b", D(4), D(10)), (11, None, "S", "b", D(1), D(2))], schemas.PRODUCTS),
        orders=make([(100, 1, "2024-01-31", "2024-02-02", "East", "COD"), (101, 2, "2024-02-28", None, None, None),
                     (102, 9, "2024-03-01", None, "East", "UPI")], schemas.ORDERS),
        order_items=make([(100, 10, 2, D(10), D(0)), (100, 10, 1, D(9), D(10)), (101, 11, 1, D(2), D(0)), (101, 99, 1, D(5), D(0)),
                          (102, 10, 1, D(10), D(0)), (999, 10, 1, D(10), D(0))], schemas.ORDER_ITEMS),
        returns=make([(100, 10, "r"), (100, 10, "r2"), (7, 7, None)], schemas.RETURNS),
    )


@pytest.fixture(scope="module")
def clean(raw):
    customers, products = cleaning.clean_customers(raw.customers, dt.date(2024, 12, 31)), cleaning.clean_products(raw.products)
    return star.build_clean_fact(raw, customers, products, cleaning.clean_orders(raw.orders), cleaning.clean_returns(raw.returns))


def test_raw_fact_keeps_every_line(raw, rows):
    got = rows(star.build_raw_fact(raw).select("order_id", "product_id", "revenue", "profit", "is_return", "region"))
    assert got == [
        (100, 10, D("20"), D("12"), True, "East"), (100, 10, D("9"), D("5"), True, "East"),
        (101, 11, D("2"), D("1"), False, None), (101, 99, D("5"), None, False, None),
        (102, 10, D("10"), D("6"), False, "East"), (999, 10, D("10"), D("6"), False, None),
    ]


def test_inner_fact_drops_unknown_orders_and_products(raw):
    assert star.build_raw_fact(raw, how="inner").count() == 4


def test_clean_fact_is_unique_and_records_dimension_hits(clean, rows):
    got = rows(clean.select("order_id", "product_id", "quantity", "customer_region", "has_customer", "has_product", "region"))
    assert got == [
        (100, 10, 1, "East", True, True, "East"), (101, 11, 1, "West", True, True, "Unknown"), (101, 99, 1, "West", True, False, "Unknown"),
        (102, 10, 1, None, False, True, "East"), (999, 10, 1, None, False, True, None),
    ]


def test_reports_join_inner(clean, raw, rows):
    assert [r["region"] for r in catalog.revenue_by_region(clean).collect()] == ["East", "West"]
    # a known product without a category is a group of its own, an unknown product is none
    assert {r["category"] for r in catalog.return_rate_by_category(clean).collect()} == {"Books", None}


def test_calendars(spark):
    bounds = spark.createDataFrame([(dt.date(2022, 12, 31), dt.date(2023, 1, 2))], "lo date, hi date")
    warehouse = [tuple(r) for r in star.dim_date_warehouse(bounds).collect()]
    assert warehouse[1] == (dt.date(2023, 1, 1), 2023, 1, 1, "January", 52, 0, "Sunday", True)
    padded = star.dim_date_warehouse(bounds, padded=True).select("month_name", "day_name").collect()[1]
    assert tuple(padded) == ("January  ", "Sunday   ")
    bi = [tuple(r) for r in star.dim_date_bi(bounds).collect()]
    assert bi[0] == (dt.date(2022, 12, 31), 2022, 4, 12, "Dec", 52, 5, "Saturday", True, "2022-12", "Q4 2022")
    assert len(bi) == 3


def test_three_year_calendar_has_1096_days(spark):
    bounds = spark.createDataFrame([(dt.date(2023, 1, 1), dt.date(2025, 12, 31))], "lo date, hi date")
    assert star.dim_date_warehouse(bounds).count() == 1096


def test_empty_bounds_give_an_empty_calendar(spark):
    bounds = spark.createDataFrame([(None, None)], "lo date, hi date")
    assert star.date_spine(bounds).count() == 0


def test_next_purchases_equals_the_whole_journey_cut_short(small, rows):
    whole = catalog.customer_journey(small.fact_clean)
    order = ["customer_id", "order_date", "order_id", "product_id"]
    for k in (1, 7, 50):
        cut = catalog.next_purchases(small.fact_clean, k)
        assert rows(cut) == rows(whole.select(*cut.columns).orderBy(*order).limit(k))
