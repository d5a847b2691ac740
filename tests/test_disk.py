"""What a build leaves on disk, and that a build in slices gives the rows of one in one piece."""

import datetime as dt
import re
import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators import cleaning, star, summaries
from salesloom.plans import mart as M
from salesloom.plans import registry
from salesloom.plans.layout import MONTH
from salesloom.sources import sinks
from salesloom.sources.tables import RawTables

AS_OF = dt.date(2025, 1, 1)


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def settled(spark, before: set[str]) -> set[str]:
    """Shuffle files that are still new after a while; Spark takes them away beside its other work."""
    until = time.time() + 20
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


@pytest.fixture(scope="module")
def raw(spark):
    """Orders of a line to some hundred lines, missing and repeated keys, keys without a parent."""
    n, key = 4000, F.col("id")
    items = spark.range(n).select(
        F.when(key % 97 == 0, None).when(key % 5 == 0, 7).otherwise(key % 900 * 1000).alias("order_id"),
        F.when(key % 89 == 0, None).otherwise(key % 60).alias("product_id"), (key % 4).cast("int").alias("quantity"),
        (key % 31).cast("decimal(12,4)").alias("selling_price"), (key % 3 * 5).cast("decimal(5,2)").alias("discount"))
    orders = spark.range(1200).select(
        F.when(key % 301 == 0, None).when(key < 5, 7).otherwise(key % 1100 * 1000).alias("order_id"), (key % 40).alias("customer_id"),
        F.when(key % 11 == 0, "no date").otherwise(F.date_add(F.lit(dt.date(2024, 1, 1)), (key % 200).cast("int")).cast("string")).alias("order_date"),
        F.lit("2024-03-01").alias("shipping_date"), F.when(key % 3 == 0, None).otherwise("East").alias("region"), F.lit("COD").alias("payment_mode"))
    products = spark.range(50).select(key.alias("product_id"), F.lit("c").alias("category"), F.lit("s").alias("sub_category"), F.lit("b").alias("brand"),
                                      F.lit(Decimal("1")).cast(schemas.PRICE).alias("cost_price"), F.lit(Decimal("2")).cast(schemas.PRICE).alias("selling_price"))
    customers = spark.range(30).select(key.alias("customer_id"), *[F.concat(F.lit("x"), key).alias(c) for c in ("name", "gender")], F.lit(30).alias("age"),
                                       *[F.lit("x").alias(c) for c in ("city", "region")], F.lit("2020-01-01").alias("signup_date"))
    returns = items.where("order_id % 7000 = 0 OR order_id IS NULL").select("order_id", "product_id", F.lit("r").alias("return_reason"))
    return RawTables(customers, products, orders, items, returns)


def multiset(df) -> list[str]:
    return sorted(map(str, df.collect()))


def test_star_in_slices_is_whole(spark, raw, monkeypatch):
    """q04_customer_lifetime_value and all that read a fact: every line once, orders and returns beside their lines, whatever the slices."""
    monkeypatch.setattr(M, "SLICE_LINES", 100)
    mart = M.Mart(spark, raw, "star in slices", AS_OF)
    assert len(mart.slices()) >= 12 and len(mart.slices(M.WIDER)) >= 3
    every = [of(raw.order_items).count() for of in mart.slices()]
    assert sum(every) == 4000 and max(every) < 4000 / 3
    assert multiset(mart.raw.orders) == multiset(raw.orders) and multiset(mart.raw.returns) == multiset(raw.returns)
    want = star.build_raw_fact(raw)
    assert multiset(mart.fact_raw.drop(MONTH)) == multiset(want) and mart.fact_raw.drop(MONTH).columns == want.columns
    one = M.Mart(spark, raw, "star in one piece", AS_OF)
    one.slices = lambda wider=1: [M.order_range(None, None)]
    for name in ("orders", "returns", "fact_clean"):
        assert multiset(getattr(mart, name)) == multiset(getattr(one, name))
    want = star.build_clean_fact(raw, cleaning.clean_customers(raw.customers, AS_OF), cleaning.clean_products(raw.products), cleaning.clean_orders(raw.orders),
                                 cleaning.clean_returns(raw.returns))
    assert multiset(mart.fact_clean.select(*want.columns)) == multiset(want)


def test_a_table_without_lines_is_one_slice(spark, raw):
    none = M.Mart(spark, RawTables(**{n: df.limit(0) for n, df in raw.items()}), "no lines", AS_OF)
    assert len(none.slices()) == 1 and none.fact_clean.count() == none.fact_raw.count() == 0


def test_published_star_leaves_no_shuffle_files(spark, raw):
    before = shuffle_files(spark)
    mart = M.Mart(spark, raw, "no shuffle files", AS_OF)
    assert mart.fact_clean is not None
    mart.store("index")("rows", mart.fact_clean.groupBy("customer_id").count())
    assert not settled(spark, before)


def test_star_csv_comes_from_the_slices(spark, raw, monkeypatch):
    """s03_dim_orders: the whole star is written, its fact packed and without a published copy beside it."""
    monkeypatch.setattr(M, "SLICE_LINES", 500)
    mart = M.Mart(spark, raw, "star as CSV", AS_OF)
    orders, fact = (registry._star_csv(mart, name) for name in ("dim_orders", "fact_sales"))
    assert "fact_clean" not in mart.__dict__ and len(mart.slices()) > 3
    assert multiset(orders) == multiset(mart.orders)
    folder = Path(mart.path("star-csv"))
    assert {p.name for p in folder.iterdir()} == {"dim_customers", "dim_products", "dim_orders", "dim_returns", "fact_sales"}
    assert all(p.name.endswith(".csv.gz") for p in folder.glob("*/part-*"))
    assert multiset(fact) == multiset(mart.fact_clean) and fact.columns == mart.fact_clean.columns
    assert len(mart.clean_pieces) == 1  # from now on there is a published one


def test_dashboard_is_whole_and_packed(spark, raw):
    """s08_dashboard_regional: all four files, and what is shuffled by order is nothing but keys."""
    mart = M.Mart(spark, raw, "dashboard", AS_OF)
    files = registry._dashboard(mart)
    folder = Path(mart.path("dashboard"))
    assert {p.name for p in folder.iterdir()} == set(files) == {"sales", "customers", "regional", "trend"}
    assert all(p.name.endswith(".csv.gz") for p in folder.glob("*/part-*"))
    for name, df in files.items():
        assert multiset(registry._back(mart, "dashboard", files, name)) == multiset(df)
    plan = files["regional"]._jdf.queryExecution().executedPlan().toString()
    by_order = re.findall(r"HashAggregate\(keys=\[[^\]]*order_id[^\]]*\], functions=\[(.*?)\]", plan)
    assert by_order and not any(by_order)


def test_orders_and_customers_against_plain_counts(spark):
    """An order under two customers, missing orders, customers and groups, an empty table."""
    rows = [("a", 1, 1, 5), ("a", 1, 2, 6), ("a", 2, 1, None), ("a", None, 1, 7), ("a", 3, None, 1), (None, 1, 1, 2), ("b", 9, 4, None), ("b", 9, 4, 3), ("b", None, None, 1)]
    fact = spark.createDataFrame(rows, "g string, order_id long, customer_id long, v long")
    sums = {"total": F.sum("v"), "lines": F.count(F.lit(1))}

    def plain(some):
        own = {c: len({o for _, o, k, _ in some if k == c and o is not None}) for c in {r[2] for r in some} - {None}}
        values = [v for *_, v in some if v is not None]
        return (sum(values) if values else None, len(some), len({r[1] for r in some} - {None}), len(own), sum(n > 1 for n in own.values()))

    got = {r[0]: tuple(r)[1:] for r in summaries.orders_and_customers(fact, ["g"], sums).collect()}
    assert got == {g: plain([r for r in rows if r[0] == g]) for g in ("a", "b", None)}
    assert tuple(summaries.orders_and_customers(fact, [], sums).first()) == plain(rows)
    assert tuple(summaries.orders_and_customers(fact.limit(0), [], sums).first()) == (None, None, 0, 0, 0)


def test_months_are_loaded_in_batches(monkeypatch):
    months = {dt.date(2024, m, 1): 10 for m in range(1, 11)} | {None: 3, dt.date(2024, 11, 1): 500}
    monkeypatch.setattr(sinks, "BATCH_LINES", 20)
    batches = sinks.month_batches(months)
    assert [m for b in batches for m in b] == [None, *sorted(m for m in months if m)]
    assert len(batches) <= 2 * sinks.MAX_BATCHES and batches[-1] == [dt.date(2024, 11, 1)] and len(batches[0]) < 6
    monkeypatch.setattr(sinks, "BATCH_LINES", 10_000)
    assert len(sinks.month_batches(months)) == 1 and sinks.month_batches({}) == []


def test_warehouse_in_batches_is_whole(spark, raw, monkeypatch):
    """s04_s14_warehouse: batches of months and joins by slices bring every row once, into an empty and a part-filled table."""
    monkeypatch.setattr(M, "SLICE_LINES", 500)
    monkeypatch.setattr(sinks, "BATCH_LINES", 100)
    loads, insert = [], sinks._insert
    monkeypatch.setattr(sinks, "_insert", lambda s, rows, table: (loads.append(table), insert(s, rows, table)))
    mart = M.Mart(spark, raw, "warehouse in batches", AS_OF)
    names, joined = registry._warehouse(mart), registry._warehouse_join(mart)
    assert sum(t == names["fact_sales"] for t in loads) > 3 and len(mart.slices(2)) > 2
    fact = mart.fact_clean
    want = (fact.join(mart.customers.select("customer_id", F.col("name").alias("n")), "customer_id").join(mart.products.select("product_id", F.col("category").alias("c")), "product_id")
            .join(mart.dim_date.select(F.col("date_key").alias("order_date"), "day_name"), "order_date")
            .select("order_id", "product_id", F.col("n").alias("name"), F.col("c").alias("category"), "day_name", "revenue", "profit", "discount_impact"))
    assert want.count() > 300 and multiset(joined) == multiset(want)
    columns = schemas.FACT_SALES.fieldNames()
    lines = multiset(fact.withColumn("date_key", F.col("order_date")).select(*columns))
    assert multiset(spark.table(names["fact_sales"]).select(*columns)) == lines
    rows = sinks.warehouse_rows(mart.customers, mart.products, mart.dim_date, fact)
    few = {**rows, "fact_sales": rows["fact_sales"].where("order_id % 3000 = 0 OR order_id IS NULL")}
    folder = mart.path("warehouse-2")
    for some in (few, rows, rows):
        names = sinks.load_warehouse(spark, some, "batches", folder)
    assert multiset(spark.table(names["fact_sales"]).select(*columns)) == lines
    assert not [p.name for p in Path(folder).iterdir() if "-before-" in p.name]
    sinks.drop_warehouse(spark, names)
