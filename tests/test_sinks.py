import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators import star, summaries
from salesloom.plans.layout import MONTH, with_month, write_parquet
from salesloom.sources import sinks
from salesloom.sources.raw_csv import corrupt_rows, read_csv, read_raw, write_csv
from salesloom.streaming.refresh import refresh_from_stream


def test_raw_csv_round_trip(spark, small, tmp_path):
    back = read_raw(spark, sinks.write_raw_csv(small.raw, str(tmp_path)))
    for name, df in back.items():
        want = getattr(small.raw, name).select(*schemas.RAW[name].fieldNames())
        assert df.schema == schemas.RAW[name]
        assert df.exceptAll(want).count() == 0 and want.exceptAll(df).count() == 0


AWKWARD = [
    (1, 'An "A" Lee, Jr'), (2, "line one\nline two"), (3, ""), (4, None), (5, '"'), (6, 'a""b,'), (7, " padded "), (8, "back\\slash"), (9, "x,y"), (10, "NULL"),
]


def test_awkward_texts_round_trip(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "id long, name string").repartition(3)
    back = read_csv(spark, write_csv(df, str(tmp_path / "t")), df.schema)
    assert sorted(map(tuple, back.collect())) == AWKWARD
    import csv
    rows = [r for p in (tmp_path / "t").glob("*.csv") for r in list(csv.reader(p.open(newline="")))[1:]]  # as other tools read it
    assert sorted((int(a), b) for a, b in rows) == [(i, t or "") for i, t in AWKWARD]


def test_quoted_raw_rows_keep_their_columns(spark, tmp_path):
    for name, schema in schemas.RAW.items():
        (tmp_path / f"{name}.csv").write_text(",".join(schema.fieldNames()) + "\n")
    (tmp_path / "customers.csv").write_text(
        "customer_id,name,gender,age,city,region,signup_date\n"
        '1,"An ""A"" Lee, Jr",F,3,X,East,2022-01-01\n2,"two\nlines",M,4,"",,"2022-01-02"\nx,Bad id,M,5,X,East,2022-01-03\n4,Short\n')
    got = [tuple(r) for r in read_raw(spark, str(tmp_path)).customers.orderBy("name").collect()]
    assert got == [(1, 'An "A" Lee, Jr', "F", 3, "X", "East", "2022-01-01"), (None, "Bad id", "M", 5, "X", "East", "2022-01-03"),
                   (4, "Short", None, None, None, None, None), (2, "two\nlines", "M", 4, "", None, "2022-01-02")]
    counts = {r["table_name"]: (r["row_count"], r["corrupt_count"]) for r in corrupt_rows(spark, str(tmp_path)).collect()}
    assert counts["customers"] == (4, 2) and counts["orders"] == (0, 0)


def test_every_warehouse_table_can_be_created(spark, tmp_path):
    for name, schema in schemas.WAREHOUSE.items():
        table = f"t_{uuid.uuid4().hex}_{name}"
        spark.sql(schemas.create_table_sql(table, schema, str(tmp_path / name)))
        assert spark.table(table).schema.fieldNames() == schema.fieldNames()


def test_warehouse_load_replaces_rows(spark, small, tmp_path):
    rows = sinks.warehouse_rows(small.customers, small.products, small.dim_date, small.fact_clean)
    prefix = f"w_{uuid.uuid4().hex}"
    for _ in range(2):
        names = sinks.load_warehouse(spark, rows, prefix, str(tmp_path))
    assert spark.table(names["fact_sales"]).count() == small.fact_clean.count()
    assert spark.table(names["dim_customers"]).filter("created_at IS NULL").count() == 0


def test_second_load_changes_nothing_and_late_rows_come_in(spark, small, tmp_path):
    files = lambda: {p: p.stat().st_mtime_ns for p in tmp_path.glob("**/*.parquet")}
    prefix, cut = f"w_{uuid.uuid4().hex}", dt.date(1998, 1, 15)
    early = small.fact_clean.filter(F.col("order_date") < cut)
    some = small.customers.filter("customer_id % 3 = 0 OR city > 'NATION_2'")
    rows = lambda customers, fact: sinks.warehouse_rows(customers, small.products, small.dim_date, fact)
    names = sinks.load_warehouse(spark, rows(some, early), prefix, str(tmp_path))
    regions = {tuple(r)[1:3]: r["region_id"] for r in spark.table(names["dim_region"]).collect()}
    before = files()
    sinks.load_warehouse(spark, rows(some, early), prefix, str(tmp_path))
    assert {p: t for p, t in files().items() if p in before} == before
    assert spark.table(names["fact_sales"]).count() == early.count()
    sinks.load_warehouse(spark, rows(small.customers, small.fact_clean), prefix, str(tmp_path))
    fact = spark.table(names["fact_sales"])
    assert fact.count() == small.fact_clean.count() == fact.select("order_id", "product_id").distinct().count()
    after = {tuple(r)[1:3]: r["region_id"] for r in spark.table(names["dim_region"]).collect()}
    assert regions.items() <= after.items() and sorted(after.values()) == list(range(1, len(after) + 1))
    plan = fact.filter(F.col(MONTH) == dt.date(1997, 5, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    month = fact.filter(F.col(MONTH) == dt.date(1997, 5, 1))
    assert len(month.inputFiles()) <= 2 * schemas.BUCKETS["fact_sales"] < len(fact.inputFiles())
    sinks.drop_warehouse(spark, names)
    assert not spark.catalog.tableExists(names["fact_sales"])


def test_rows_without_a_key_are_loaded_once(spark):
    known = spark.createDataFrame([(1, None), (None, "x")], "k long, v string")
    rows = spark.createDataFrame([(None, "x"), (None, "y"), (2, "x"), (1, "x"), (1, None)], "k long, v string")
    assert sorted(map(str, sinks.absent(rows, known, ["k", "v"]).collect())) == sorted(map(str, rows.where("k = 2 OR v = 'y' OR (k = 1 AND v = 'x')").collect()))


def test_results_document_is_one_json_object(spark, small, tmp_path):
    forecasting = spark.range(1).select(F.lit(1.5).alias("mae"))
    document = sinks.results_document(small.fact_raw, forecasting)
    schema = sinks.write_json(document, str(tmp_path / "r"))
    text = [line for p in (tmp_path / "r").glob("*.json") for line in p.read_text().splitlines()]
    assert len(text) == 1 and set(json.loads(text[0])) == set(sinks.RESULT_SECTIONS)
    back = sinks.section(sinks.read_json(spark, str(tmp_path / "r"), schema), "by_region")
    assert back.exceptAll(summaries.by_region(small.fact_raw)).count() == 0


def test_refresh_touches_only_the_named_months(spark, small, tmp_path):
    path = str(tmp_path / "daily")
    sinks.publish_daily_sales(small.fact_clean, path)
    store = sinks.daily_snapshots(spark, path)
    before = store.months()
    month = small.fact_clean.agg(F.min(MONTH).alias(MONTH))
    sinks.refresh_daily_sales(small.fact_clean, path, month)
    first, after = month.first()[0].isoformat(), store.months()
    assert {m for m in after if after[m] != before[m]} == {first} and after.keys() == before.keys()
    assert sinks.read_daily_sales(spark, path).exceptAll(star.daily_sales(small.fact_clean)).count() == 0


def test_a_refresh_that_breaks_off_leaves_the_old_version(spark, small, tmp_path):
    path = str(tmp_path / "daily")
    fact = small.fact_clean.filter(F.col(MONTH) >= dt.date(1998, 1, 1))
    sinks.publish_daily_sales(fact, path)
    want = sorted(map(str, sinks.read_daily_sales(spark, path).collect()))
    broken = fact.withColumn("quantity", F.when(F.col(MONTH) == dt.date(1998, 5, 1), F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("quantity") + 1))
    with pytest.raises(Exception, match="lost"):
        sinks.refresh_daily_sales(broken, path, fact.select(MONTH).distinct())
    store = sinks.daily_snapshots(spark, path)
    assert store.versions() == [1] and sorted(map(str, sinks.read_daily_sales(spark, path).collect())) == want
    with pytest.raises(RuntimeError):
        store._publish(1, {})
    sinks.refresh_daily_sales(fact, path, fact.select(MONTH).distinct())
    store.prune(keep=1)
    assert store.versions() == [2] and len(list((tmp_path / "daily" / "data").iterdir())) == 1
    assert sorted(map(str, sinks.read_daily_sales(spark, path).collect())) == want
    assert sinks.daily_snapshots(spark, str(tmp_path / "none")).read(schemas.DAILY_SALES).count() == 0


def test_only_touched_cells_are_made_anew(spark, small, tmp_path):
    """Cells of other groups keep the rows of the version before, even if the fact has changed behind their back."""
    path, day = str(tmp_path / "daily"), dt.date(1998, 3, 1)
    fact = small.fact_clean.filter((F.col(MONTH) == day) | F.col(MONTH).isNull())
    sinks.publish_daily_sales(fact, path)
    one = fact.filter("has_product AND has_customer AND order_date IS NOT NULL").orderBy("order_date", "order_id", "product_id").limit(1)
    cell = one.select(*star.DAILY_KEYS).first()
    changed = fact.withColumn("quantity", F.col("quantity") + 1000)
    sinks.refresh_cells(changed, path, one)
    old = {tuple(r)[:5]: r["units_sold"] for r in star.daily_sales(fact).collect()}
    new = {tuple(r)[:5]: r["units_sold"] for r in sinks.read_daily_sales(spark, path).collect()}
    assert old.keys() == new.keys() and {k for k in old if old[k] != new[k]} == {tuple(cell)}


def test_refresh_reads_only_the_named_months(spark, small):
    months = [r[0] for r in small.fact_clean.select(MONTH).distinct().limit(2).collect()]
    scan = sinks.lines_of_months(small.fact_clean, months)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [order_month" in plan


def test_stream_picks_up_new_files(spark, small, tmp_path):
    fact_path, out, progress = (str(tmp_path / n) for n in ("fact", "daily", "progress"))
    fact = small.fact_clean
    cut = dt.date(1998, 1, 15)
    write_parquet(fact.filter(F.col("order_date") < cut), fact_path, MONTH)
    refresh_from_stream(spark, fact_path, out, progress)
    early = sinks.read_daily_sales(spark, out)
    assert early.exceptAll(star.daily_sales(fact.filter(F.col("order_date") < cut))).count() == 0
    # late lines of January 1998 and all that follows
    fact.filter(F.col("order_date") >= cut).write.mode("append").partitionBy(MONTH).parquet(fact_path)
    refresh_from_stream(spark, fact_path, out, progress)
    everything = sinks.read_daily_sales(spark, out)
    assert everything.exceptAll(star.daily_sales(fact)).count() == 0 and everything.count() == star.daily_sales(fact).count()
