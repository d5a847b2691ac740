"""Plans: what is read, what is shuffled, and what happens to hot keys."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators import catalog, cleaning, measures, star, summaries
from conftest import SMALL
from salesloom.plans.layout import MONTH, spread_over_months, with_month, write_parquet
from salesloom.plans.registry import callables
from salesloom.sources.tables import RawTables


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_read_only_their_columns(small):
    df = catalog.discount_bands(small.fact_clean)
    scan = df._jdf.queryExecution().executedPlan().toString()
    listed = re.search(r"FileScan parquet \[(.*?)\]", scan).group(1)
    assert {c.split("#")[0] for c in listed.split(",")} == {"discount", "revenue", "profit", MONTH}


def test_slicers_prune_partitions(small):
    quarter = small.fact_raw.filter(measures.slicer(years=[1997], quarters=[2]))
    assert "PartitionFilters: [" in physical(quarter) and "PartitionFilters: []" not in physical(quarter)
    assert quarter.select(F.countDistinct(MONTH)).first()[0] == 3


def test_dimension_filters_reach_the_scan(small):
    plan = physical(catalog.revenue_by_region(small.fact_clean))
    assert "EqualTo(has_customer,true)" in plan and "Join" not in plan


def test_two_distinct_counts_need_no_expand(small):
    for df in (summaries.overview(small.fact_raw), summaries.region_category(small.fact_raw), star.daily_sales(small.fact_clean),
               measures.core(small.fact_raw, ["region"])):
        assert "Expand" not in physical(df)


@pytest.mark.parametrize("name", [
    "q03_top_products", "q04_customer_lifetime_value", "q07_lowest_margin_products", "q09_next_purchases", "q12_worst_products",
    "v05_top_products_by_revenue", "v10b_top_customers", "i02_worst_return_category",
])
def test_top_k_is_not_a_full_sort(spark, name):
    plan = physical(callables()[name](spark, SMALL))
    assert "TakeOrderedAndProject" in plan


def test_no_join_is_forced_to_broadcast(small):
    plan = star.build_clean_fact(small.raw, small.customers, small.products, small.orders, small.returns)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


@pytest.fixture(scope="module")
def hot(spark):
    """One order, one product and one customer hold a third of all lines."""
    n = 60000
    price = F.lit(Decimal("2")).cast("decimal(12,4)")
    # incompressible, so that sizes reflect row counts
    noise = (F.xxhash64("id") % 1000000).cast("decimal(12,4)")
    ids = spark.range(n).repartition(16)
    is_hot = F.col("id") % 3 == 0
    items = ids.select(
        F.when(is_hot, 0).otherwise(F.col("id") % 9000 + 1).alias("order_id"),
        F.when(is_hot & (F.col("id") % 2 == 0), 0).otherwise(F.col("id") + 1).alias("product_id"),
        F.lit(1).alias("quantity"), price.alias("selling_price"), F.lit(Decimal("5")).cast("decimal(5,2)").alias("discount"),
        noise.alias("noise"), F.xxhash64("id", F.lit(7)).alias("noise2"),
    ).checkpoint()
    orders = spark.range(9001).select(
        F.col("id").alias("order_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("customer_id"),
        F.lit("2024-01-05").alias("order_date"), F.lit("2024-01-07").alias("shipping_date"), F.lit("East").alias("region"), F.lit("COD").alias("payment_mode"),
    )
    products = spark.range(n + 1).select(
        F.col("id").alias("product_id"), F.lit("c").alias("category"), F.lit("s").alias("sub_category"), F.lit("b").alias("brand"),
        F.lit(Decimal("1")).cast("decimal(12,4)").alias("cost_price"), price.alias("selling_price"))
    customers = spark.range(9001).select(F.col("id").alias("customer_id"), *[F.lit("x").alias(c) for c in ("name", "gender", "city", "region")],
                                         F.lit(30).alias("age"), F.lit("2020-01-01").alias("signup_date")).select(*schemas.CUSTOMERS.fieldNames())
    return RawTables(customers, products, orders, items, items.select("order_id", "product_id", F.lit("r").alias("return_reason")).filter("order_id = 0"))


LARGE = {
    # stand-ins for tables beyond every threshold: no broadcast, and skew is noticed at kilobytes
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
}


@pytest.fixture
def large(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_join_keys_are_split(large, hot):
    fact = star.build_raw_fact(hot, keep=["noise", "noise2"])
    rows = fact.collect()
    plan = physical(fact)
    assert "skew=true" in plan and len(rows) == 60000
    assert sum(r["is_return"] for r in rows) >= 20000 and all(r["profit"] == 1 for r in rows)


def test_hot_customer_journey_is_whole(large, hot):
    customers, products = cleaning.clean_customers(hot.customers, dt.date(2025, 1, 1)), cleaning.clean_products(hot.products)
    fact = star.build_clean_fact(hot, customers, products, cleaning.clean_orders(hot.orders), cleaning.clean_returns(hot.returns)).checkpoint()
    journey = catalog.customer_journey(fact)
    last = journey.groupBy("customer_id").agg(F.count("*").alias("n"), F.max("running_total_revenue").alias("total"),
                                             F.count_if(F.col("next_order_date").isNull()).alias("ends"))
    assert journey.count() == fact.count()
    assert last.filter("total <> n * 2 OR ends <> 1").count() == 0


def test_a_hot_month_is_written_by_many_tasks(large, hot, tmp_path):
    fact = with_month(star.build_raw_fact(hot))
    write_parquet(fact, str(tmp_path / "fact"), MONTH, star.LINE_KEY)
    files = list((tmp_path / "fact" / f"{MONTH}=2024-01-01").glob("*.parquet"))
    assert len(files) == 8
    counts = large.read.parquet(str(tmp_path / "fact")).groupBy(F.input_file_name().alias("f")).count().collect()
    assert max(r["count"] for r in counts) < 60000 / 3


def test_fact_is_dealt_out_once(large, hot, tmp_path):
    """No sampling pass over the joins; a hot order and a hot month are written by many tasks, and the lines of any other order by one."""
    fact = with_month(star.build_raw_fact(hot)).withColumn(MONTH, F.when(F.col("order_id") % 10 == 1, F.lit(dt.date(2024, 2, 1))).when(
        F.col("order_id") % 10 == 2, F.lit(None)).otherwise(F.col(MONTH)))
    months = {r[MONTH]: r["count"] for r in fact.groupBy(MONTH).count().collect()}
    dealt = spread_over_months(fact, months, star.LINE_KEY, heavy=[0])
    assert "rangepartitioning" not in physical(dealt)
    dealt.write.partitionBy(MONTH).parquet(str(tmp_path / "f"))
    back = large.read.parquet(str(tmp_path / "f")).withColumn("file", F.input_file_name())
    assert back.count() == 60000 and {r[MONTH]: r["count"] for r in back.groupBy(MONTH).count().collect()} == months
    assert back.where("order_id = 0").select("file").distinct().count() >= 5
    assert back.where("order_id <> 0").groupBy("order_id").agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()
    assert back.groupBy("file").count().agg(F.max("count")).first()[0] < 60000 / 3
    unknown = spread_over_months(fact, {dt.date(2024, 1, 1): 5}, star.LINE_KEY, files=3)
    assert unknown.count() == 60000


def test_heavy_orders_are_found(large, hot):
    from salesloom.plans.mart import Mart
    mart = Mart(large, hot, "hot orders", dt.date(2025, 1, 1))
    months, heavy = mart.fact_shape
    assert heavy == [0] and months == {dt.date(2024, 1, 1): 9001}
