"""Writers and the readers that take their output back."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom import schemas
from salesloom.operators import star, summaries
from salesloom.plans.layout import MONTH, PACKED, with_month
from salesloom.plans.ordered import running_totals
from salesloom.plans.snapshots import NONE, Snapshots
from salesloom.session import shuffles_dropped
from salesloom.sources.raw_csv import POSITION, read_csv, write_csv
from salesloom.sources.tables import RawTables

BATCH_ROWS = 500  # fixed value: rows per INSERT batch of the warehouse load


def write_raw_csv(raw: RawTables, folder: str) -> str:
    """The five raw tables as CSV folders in the raw column order (S1's input)."""
    for name, df in raw.items():
        write_csv(df.select(*schemas.RAW[name].fieldNames()), f"{folder}/{name}.csv")
    return folder


def write_star_csv(tables: Mapping[str, DataFrame | Sequence[DataFrame]], folder: str, compression: str = "none") -> dict[str, str]:
    """S3: cleaned dimensions and the fact, one CSV folder each. A table may come in pieces, which are written one after the other."""
    for name, pieces in tables.items():
        for k, df in enumerate([pieces] if isinstance(pieces, DataFrame) else pieces):
            write_csv(df, f"{folder}/{name}", compression, "append" if k else "overwrite")
    return {name: f"{folder}/{name}" for name in tables}


def write_bi_star(raw: RawTables, fact: DataFrame, folder: str) -> dict[str, DataFrame]:
    """The five files of the BI star; returns what was written, by file."""
    orders = star.parse_order_dates(raw.orders)
    files = {
        "dim_date": star.dim_date_bi(star.order_date_bounds(orders)),
        "dim_customers": summaries.bi_customers(raw.customers),
        "dim_products": summaries.bi_products(raw.products),
        "fact_sales": summaries.bi_fact(fact),
        "returns": raw.returns.drop(POSITION),
    }
    for name, df in files.items():
        write_csv(df, f"{folder}/{name}")
    return files


def write_dashboard(raw: RawTables, fact: DataFrame, folder: str, coords, compression: str = "none") -> dict[str, DataFrame]:
    """Sales detail, customer profiles, regional figures and the monthly trend."""
    files = {
        "sales": summaries.sales_detail(fact),
        "customers": summaries.customer_profiles(fact, raw.customers),
        "regional": summaries.region_category(fact, coords),
        "trend": summaries.monthly(fact),
    }
    for name in sorted(files, key=lambda n: n == "sales"):  # all lines last: their file does not lie beside the shuffles of the others
        write_csv(files[name], f"{folder}/{name}", compression)
    return files


def written_profile(spark: SparkSession, folder: str, files: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per written file, both counted on what is read back."""
    out = None
    for name, df in files.items():
        path = f"{folder}/{name}"
        header = spark.read.text(path).first()
        columns = len(header[0].split(",")) if header else 0
        one = read_csv(spark, path, df.schema).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("file"), "row_count", F.lit(columns).alias("column_count")
        )
        out = one if out is None else out.unionByName(one)
    return out


# ---- warehouse --------------------------------------------------------------------------------------------


def dim_region(customers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Region and city pairs with a surrogate key over their alphabetical order; state and zone are unknown.

    With ``known``, an earlier result, only pairs that it lacks, numbered on from its last key. Numbers are prefix sums over ranges of places.
    """
    places, last = customers.select("region", "city").distinct(), F.lit(0)
    if known is not None:
        places = absent(places, known, ["region", "city"])
        last = F.coalesce(known.agg(F.max("region_id")).scalar(), F.lit(0))
    return running_totals(places, ["region", "city"], {}, position="n").select(
        (F.col("n") + last).cast("long").alias("region_id"), "region", "city",
        F.lit(None).cast("string").alias("state"), F.lit(None).cast("string").alias("zone"),
    )


def absent(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key ``known`` doesn't have; missing keys are alike."""
    there = known.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(there[f"_{k}"]) for k in keys])
    return rows.join(there, same, "left_anti")


def warehouse_rows(customers: DataFrame, products: DataFrame, calendar: DataFrame, fact: DataFrame) -> dict[str, DataFrame]:
    """Rows of the star tables in the column order of their schemas."""
    now = F.current_timestamp().alias("created_at")
    return {
        "dim_customers": customers.select(*schemas.DIM_CUSTOMERS.fieldNames()[:-1], now),
        "dim_products": products.select(*schemas.DIM_PRODUCTS.fieldNames()[:-1], now),
        "dim_date": calendar.select(*schemas.DIM_DATE.fieldNames()),
        "dim_region": dim_region(customers),
        "fact_sales": with_month(fact).withColumn("date_key", F.col("order_date")).select(*schemas.FACT_SALES.fieldNames(), MONTH),
    }


def load_warehouse(spark: SparkSession, rows: Mapping[str, DataFrame], prefix: str, folder: str) -> dict[str, str]:
    """Create the tables from their schemas and insert the rows whose keys are not there yet; returns the table names.

    Loading the same rows again changes nothing, so a load that broke off is simply run again. The fact is partitioned by month and bucketed by its key; a load compares
    keys within the months that it brings only. It brings some months at a time, so that no more than their lines are shuffled at once; the keys that were there before
    are set aside first.
    """
    names = {}
    for table, df in rows.items():
        names[table] = name = f"{prefix}_{table}"
        keys, partition, buckets = schemas.KEYS[table], schemas.PARTITIONS.get(table), schemas.BUCKETS.get(table, 0)
        spark.sql(schemas.create_table_sql(name, schemas.WAREHOUSE[table], f"{folder}/{table}", partition, keys, buckets))
        known = spark.table(name)
        if partition:
            counts = {r[0]: r["count"] for r in df.groupBy(partition.name).count().collect()}  # as many as the calendar has
            there, aside = lines_of_months(known, list(counts)).select(*keys), f"{folder}/{table}-before-{uuid.uuid4().hex[:12]}"
            some = not there.isEmpty()
            if some:
                there.write.options(**PACKED).parquet(aside)
                there = spark.read.schema(there.schema).parquet(aside)
            for months in month_batches(counts):
                new = lines_of_months(df, months)
                new = absent(new, there, keys) if some else new
                # one file for each month and bucket
                new = new.repartition(partition.name, F.pmod(F.hash(*keys), F.lit(buckets))).sortWithinPartitions(partition.name)
                _insert(spark, new, name)
            if some:
                at = spark._jvm.org.apache.hadoop.fs.Path(aside)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        else:
            _insert(spark, dim_region(df, known) if table == "dim_region" else absent(df, known, keys), name)
    return names


def _insert(spark: SparkSession, rows: DataFrame, table: str) -> None:
    codec = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(codec)
    spark.conf.set(codec, PACKED["compression"])
    try:
        with shuffles_dropped(spark):
            rows.write.insertInto(table)
    finally:
        spark.conf.set(codec, before)
    spark.catalog.refreshTable(table)


# Lines of the warehouse's fact are loaded by months, one batch for so many lines, at most so many batches of about one size; a month is never cut.
BATCH_LINES = 2_000_000
MAX_BATCHES = 16


def month_batches(lines: Mapping[dt.date | None, int]) -> list[list[dt.date | None]]:
    """The months in runs that hold about as many lines each."""
    total, batches, held = sum(lines.values()), [], 0
    each = max(BATCH_LINES, total / MAX_BATCHES)
    for month, n in sorted(lines.items(), key=lambda r: (r[0] is not None, r[0] or dt.date.min)):
        if not batches or held + n > each and held:
            batches.append([])
            held = 0
        batches[-1].append(month)
        held += n
    return batches


def drop_warehouse(spark: SparkSession, names: Mapping[str, str]) -> None:
    """Take the tables out of the catalog; their files stay."""
    for name in names.values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int) -> None:
    """S4 for an external database: parallel batched inserts over ``connections`` connections.

    The caller names the number that the database bears. The rows are dealt out anew, so the stage before keeps its own width.
    """
    df.repartition(connections).write.mode("append").option("batchsize", BATCH_ROWS).jdbc(url, table, properties=dict(properties))


# ---- daily aggregate --------------------------------------------------------------------------------------


DAILY_SCHEMA = schemas.DAILY_SALES


def daily_snapshots(spark: SparkSession, path: str) -> Snapshots:
    return Snapshots(spark, path, MONTH)


def _month_names(months: Sequence[dt.date | None]) -> list[str]:
    return [NONE if m is None else m.isoformat() for m in months]


def publish_daily_sales(fact: DataFrame, path: str) -> None:
    """The daily aggregate, all months of it, as a new version."""
    store = daily_snapshots(fact.sparkSession, path)
    store.write(with_month(star.daily_sales(fact), "date_key"), store.months())


def lines_of_months(fact: DataFrame, months: Sequence[dt.date | None]) -> DataFrame:
    known = F.col(MONTH).isin([m for m in months if m is not None])
    return fact.filter(known | F.col(MONTH).isNull() if None in months else known)


def refresh_daily_sales(fact: DataFrame, path: str, months: DataFrame) -> None:
    """Recompute the months listed in ``months`` (column ``order_month``) in a new version; the other months stay as they are.

    The list of months is at most as long as the calendar; as literals it prunes the fact's partitions.
    """
    touched = [r[0] for r in months.select(MONTH).distinct().collect()]
    if touched:
        daily = star.daily_sales(lines_of_months(fact, touched))
        daily_snapshots(fact.sparkSession, path).write(with_month(daily, "date_key"), _month_names(touched))


def refresh_cells(fact: DataFrame, path: str, lines: DataFrame) -> None:
    """A new version in which the cells (day and group) of ``lines`` are recomputed from the whole ``fact``.

    Of months that the last version has, only lines of those cells are read on and the other cells are taken over; months that it lacks are made as a whole.
    """
    spark, keys = fact.sparkSession, star.DAILY_KEYS
    cells = lines.select(MONTH, *keys).distinct().persist()
    touched = [r[0] for r in cells.select(MONTH).distinct().collect()]
    if touched:
        store = daily_snapshots(spark, path)
        known = set(store.months())
        old = [m for m, name in zip(touched, _month_names(touched)) if name in known]
        new = [m for m in touched if m not in old]
        again = lines_of_months(fact, old)
        some = again.join(cells.select(*[F.col(k).alias(f"_{k}") for k in keys]), reduce(
            lambda a, b: a & b, [again[k].eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_semi")
        daily = star.daily_sales(some.unionByName(lines_of_months(fact, new)) if new else some)
        if old:
            stored = cells.select(*[F.col(k).alias({"order_date": "date_key", "customer_region": "region"}.get(k, k)) for k in keys])
            kept = absent(store.read(DAILY_SCHEMA, _month_names(old)), stored, stored.columns)
            daily = kept.unionByName(daily)
        store.write(with_month(daily, "date_key"), _month_names(touched))
    cells.unpersist()


def read_daily_sales(spark: SparkSession, path: str) -> DataFrame:
    return daily_snapshots(spark, path).read(DAILY_SCHEMA)


# ---- nested results ---------------------------------------------------------------------------------------

# Names of the sections.
RESULT_SECTIONS = ("overview", "by_category", "by_region", "by_discount", "correlations", "forecasting")


def results_document(fact: DataFrame, forecasting: DataFrame) -> DataFrame:
    """All headline results as one nested row. Every section is a small aggregate by itself."""
    from salesloom.operators import stats
    sections = {
        "overview": summaries.overview(fact), "by_category": summaries.by_category(fact),
        "by_region": summaries.by_region(fact), "by_discount": summaries.by_discount_band(fact),
        "correlations": stats.key_correlations(fact), "forecasting": forecasting,
    }
    nested = {n: df.agg(F.collect_list(F.struct(*df.columns)).alias(n)) for n, df in sections.items()}
    first, *others = nested
    return nested[first].select(first, *[nested[n].scalar().alias(n) for n in others])


def write_json(df: DataFrame, path: str) -> T.StructType:
    df.write.mode("overwrite").json(path)
    return df.schema


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Nested results with their known schema."""
    return spark.read.schema(schema).json(path)


def section(results: DataFrame, name: str) -> DataFrame:
    return results.select(F.explode(name).alias("r")).select("r.*")
