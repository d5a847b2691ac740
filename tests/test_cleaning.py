import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salesloom.operators import cleaning as K
from salesloom.operators import quality as Q

AS_OF = dt.date(2024, 1, 1)
CUSTOMER = "customer_id long, name string, gender string, age int, city string, region string, signup_date string"


def test_keep_first_takes_the_first_in_order_and_is_idempotent(spark, rows):
    df = spark.createDataFrame([(1, 2, "B"), (1, 1, "A"), (2, 5, "C"), (2, None, "D")], "k int, pos int, v string")
    once = K.keep_first(df, ["k"], ["pos"])
    assert rows(once) == [(1, 1, "A"), (2, 5, "C")]
    assert rows(K.keep_first(once, ["k"], ["pos"])) == rows(once)


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"))
    plan = K.keep_first(df, ["k"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_customers(spark, rows):
    raw = spark.createDataFrame([
        (1, "A", None, 20, "c", "r", "2022-05-03"), (2, "B", "Female", 30, "c", "r", "05-03-2022"),
        (3, "C", "Male", None, "c", "r", ""), (4, "D", "Male", 50, "c", "r", "2099-01-01"), (4, "E", "Male", 50, "c", "r", "2022-01-01"),
        (5, "F", "Male", 30, "c", "r", None),
    ], CUSTOMER)
    got = rows(K.clean_customers(raw, AS_OF).select("customer_id", "name", "gender", "age", "signup_date"))
    assert got == [
        (1, "A", "Unknown", 20, dt.date(2022, 5, 3)), (2, "B", "Female", 30, None), (3, "C", "Male", 30, None),
        (4, "D", "Male", 50, AS_OF), (5, "F", "Male", 30, None),
    ]


def test_median_is_cut_to_a_whole_number(spark):
    df = spark.createDataFrame([(20,), (25,), (None,)], "age int")
    assert sorted(r[0] for r in K.fill_age(df).collect()) == [20, 22, 25]


def test_products(spark, rows):
    raw = spark.createDataFrame([
        (1, "c", "s", "b", Decimal("-1"), Decimal("10")), (2, "c", "s", "b", Decimal("10"), Decimal("10")),
        (3, "c", "s", "b", Decimal("12"), Decimal("10")), (4, "c", "s", "b", Decimal("5"), Decimal("0")),
        (5, "c", "s", "b", Decimal("1899.61"), Decimal("1797.00")), (6, "c", "s", "b", None, Decimal("10")),
    ], "product_id long, category string, sub_category string, brand string, cost_price decimal(12,4), selling_price decimal(12,4)")
    got = {r[0]: r[1] for r in K.clean_products(raw).select("product_id", "cost_price").collect()}
    assert got == {1: 0, 2: 7, 3: 7, 4: 0, 5: Decimal("1257.90"), 6: None}


def test_orders(spark, rows):
    raw = spark.createDataFrame([
        (1, 1, "2024-01-05", "2024-01-03", None, "COD"), (2, 1, "2024-01-05", None, "East", None), (3, 1, "bad", "2024-01-03", "East", "UPI"),
    ], "order_id long, customer_id long, order_date string, shipping_date string, region string, payment_mode string")
    got = rows(K.clean_orders(raw))
    assert got == [
        (1, 1, dt.date(2024, 1, 5), dt.date(2024, 1, 6), "Unknown", "COD"),
        (2, 1, dt.date(2024, 1, 5), None, "East", "Unknown"), (3, 1, None, dt.date(2024, 1, 3), "East", "UPI"),
    ]


def test_items_clip_and_keep_nulls(spark):
    raw = spark.createDataFrame([
        (1, 1, -2, Decimal("-5"), Decimal("-5")), (1, 2, 0, Decimal("1"), Decimal("120")), (1, 3, 3, None, None), (1, 4, None, Decimal("1"), Decimal("5")),
    ], "order_id long, product_id long, quantity int, selling_price decimal(12,4), discount decimal(5,2)")
    got = [tuple(r) for r in K.clean_order_items(raw).orderBy("product_id").select("quantity", "selling_price", "discount").collect()]
    assert got == [(1, 0, 0), (1, 1, 100), (3, None, None), (None, 1, 5)]


def test_returns(spark, rows):
    raw = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (1, 2, "a")], "order_id long, product_id long, return_reason string")
    assert rows(K.clean_returns(raw)) == [(1, 1, "Not specified"), (1, 2, "a")]


def test_strip_quotes(spark):
    df = spark.createDataFrame([("O'Brien's",)], "name string")
    assert K.strip_quotes(df, "name").first()[0] == "OBriens"


def test_quality_reports(spark, rows):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    assert rows(Q.foreign_key_violations([("c.k", child, ["k"], parent)])) == [("c.k", 1, 2)]
    assert rows(Q.key_violations([("p", parent, ["k"])])) == [("p", 1, 1)]
    assert rows(Q.null_profile({"p": parent})) == [("p", "k", 1, 25.0)]
    assert rows(Q.dataset_profile({"p": parent}, {"p": "k"})) == [("p", 4, 1, 2)]
    signups = spark.createDataFrame([("2022-05-03",), ("05-03-2022",), ("",), (None,)], "signup_date string")
    assert tuple(Q.malformed_signups(signups).first()) == (1, 2)
    assert Q.null_signups(signups).first()[0] == 3
