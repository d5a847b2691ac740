"""The published star of one data folder.

Cleaning, joining and deduplicating the lines is the expensive part, and every report needs its result.
So the star is published once per application into the shared folder, as month-partitioned parquet, and
reports scan only the columns and months they need. A published table also ends the lineage: losing
executors never means redoing the joins.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import session
from salesloom.operators import cleaning, star
from salesloom.plans.layout import MONTH, PACKED, spread_over_months, with_month, write_parquet
from salesloom.sources.driver import FILE_ORDER, read_driver
from salesloom.sources.raw_csv import POSITION
from salesloom.sources.tables import RawTables

# Fixed value: "today" of the driver tables, so that results never depend on the clock.
AS_OF = dt.date(2001, 12, 31)

# Tables of orders and lines are published in slices, ranges of order_id, and only one slice's shuffles lie on disk at a time. The facts have one slice for so
# many lines, at most so many in all; the narrower tables of orders and returns one for so many of these.
SLICE_LINES = 1_000_000
MAX_SLICES = 24
WIDER = 4


Slice = Callable[[DataFrame], DataFrame]


def order_range(low: int | None, high: int | None) -> Slice:
    """The rows whose order is from ``low`` on and below ``high``; without ``low`` those without an order as well."""
    within = [f"order_id >= {low}"] * (low is not None) + [f"order_id < {high}"] * (high is not None)
    text = " AND ".join(within) + (" OR order_id IS NULL" if low is None and within else "")
    return lambda df: df.where(text) if text else df


def sliced(raw: RawTables, of: Slice) -> RawTables:
    return replace(raw, orders=of(raw.orders), order_items=of(raw.order_items), returns=of(raw.returns))


class Mart:
    """Star of any raw tables, such as read_raw() of a user's CSV files.

    ``name`` keeps its published tables apart from those of other marts; ``file_order`` names the line columns that tell which of several equal
    (order, product) lines comes first (by default their place in the files, if they carry it, else their values), ``keep`` further line columns that the raw fact carries. A mart does not notice when its
    source changes: make another one, under another name.
    """

    def __init__(self, spark: SparkSession, source: RawTables, name: str, as_of: dt.date,
                 file_order: Sequence[str] | None = None, keep: Sequence[str] = ()):
        session.configure(spark)
        self.spark, self.source, self.name, self.as_of = spark, source, name, as_of
        placed = POSITION in source.order_items.columns
        self.file_order, self.keep = list(file_order or ([POSITION] if placed else ["quantity", "selling_price", "discount"])), list(keep)
        self._made: dict[str, object] = {}

    def path(self, table: str) -> str:
        return session.run_dir(self.spark, f"mart-{zlib.crc32(self.name.encode()):08x}", table)

    def once(self, name: str, make: Callable[[], object]):
        """Result of ``make``, computed at most once per mart."""
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def publish(self, name: str, df: DataFrame, partition_by: str | None = None, cluster_by: Sequence[str] = ()) -> DataFrame:
        with session.shuffles_dropped(self.spark):
            write_parquet(df, self.path(name), partition_by, cluster_by)
        return self._published(name, df)

    def _published(self, name: str, df: DataFrame) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*df.columns)  # the schema is known even if no row is

    def publish_sliced(self, name: str, make: Callable[[Slice], DataFrame], wider: int = WIDER, even: bool = True) -> DataFrame:
        """``make`` gives the rows of the orders in one slice; they are written one slice after the other, as they come if not to be ``even``."""
        for k, orders in enumerate(self.slices(wider)):
            df, mode = make(orders), "append" if k else "overwrite"
            with session.shuffles_dropped(self.spark):
                if even:
                    write_parquet(df, self.path(name), mode=mode)
                else:
                    df.write.mode(mode).options(**PACKED).parquet(self.path(name))
        return self._published(name, df)

    def publish_fact(self, name: str, make: Callable[[Slice], DataFrame], cluster_by: Sequence[str]) -> DataFrame:
        """A fact by month, the lines of an order side by side; dealt out by what its orders and the heaviest of them say."""
        (months, heavy), slices = self.fact_shape, self.slices()
        files = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // len(slices))
        for k, orders in enumerate(slices):
            df = spread_over_months(with_month(make(orders)), months, cluster_by, heavy, files)
            with session.shuffles_dropped(self.spark):
                df.write.mode("append" if k else "overwrite").options(**PACKED).partitionBy(MONTH).parquet(self.path(name))
        return self._published(name, df)

    @cached_property
    def line_shape(self) -> tuple[int, list, list]:
        """Lines, the orders that hold more of them than a task should, and bounds between runs of orders with about as many lines each."""
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        known = self.source.order_items.select("order_id").where("order_id IS NOT NULL")
        with session.shuffles_dropped(self.spark):
            lines = known.agg(
                F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(order_id, {min(parts, 1000)}, 10000)").alias("top"),
                F.percentile_approx("order_id", [k / MAX_SLICES for k in range(1, MAX_SLICES)], 10_000).alias("cuts")).first()
        heavy = [r["item"] for r in lines["top"] or () if r["count"] * parts > lines["n"]]
        return lines["n"], heavy, list(lines["cuts"] or ())

    def slices(self, wider: int = 1) -> list[Slice]:
        """Filters by which a table with an order_id falls into slices of about as many lines each."""
        n, _, cuts = self.line_shape
        count = min(MAX_SLICES, max(1, n // SLICE_LINES)) if cuts else 1
        count = -(-count // wider)
        bounds = sorted({cuts[k * MAX_SLICES // count - 1] for k in range(1, count)})
        return [order_range(low, high) for low, high in zip([None, *bounds], [*bounds, None])]

    @cached_property
    def fact_shape(self) -> tuple[dict[dt.date | None, int], list]:
        """Orders of each month, and the orders that hold more lines than a task should."""
        orders = with_month(star.parse_order_dates(self.raw.orders))
        with session.shuffles_dropped(self.spark):
            months = {r[MONTH]: r["n"] for r in orders.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).collect()}
        return months, self.line_shape[1]

    def store(self, table: str) -> Callable[[str, DataFrame], DataFrame]:
        """A place for the frames of ordered(): written below ``table`` as they come, and read back."""
        def write(part: str, df: DataFrame) -> DataFrame:
            with session.shuffles_dropped(self.spark):
                df.write.mode("overwrite").options(**PACKED).parquet(self.path(f"{table}/{part}"))
            return self.spark.read.schema(df.schema).parquet(self.path(f"{table}/{part}"))
        return write

    def together(self, *names: str) -> None:
        """Build independent tables side by side, so that one's last tasks do not leave the cluster idle."""
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(lambda name: getattr(self, name), names))

    def build(self) -> None:
        """Publish the whole star."""
        self.raw  # both branches below read it
        self.together("dimensions", "fact_raw")
        self.together("fact_clean", "dim_date")

    @cached_property
    def dimensions(self) -> None:
        self.together("customers", "products", "orders", "returns")

    @cached_property
    def staged_orders(self) -> DataFrame:
        return self.publish_sliced("stage_orders", lambda of: of(self.source.orders))

    @cached_property
    def staged_returns(self) -> DataFrame:
        return self.publish_sliced("stage_returns", lambda of: of(self.source.returns))

    @cached_property
    def raw(self) -> RawTables:
        """Raw tables. Orders and returns, which the adapter has to derive from the lines, are staged once."""
        self.line_shape  # both are written in its slices
        self.together("staged_orders", "staged_returns")
        return replace(self.source, orders=self.staged_orders, returns=self.staged_returns)

    @cached_property
    def customers(self) -> DataFrame:
        return self.publish("dim_customers", cleaning.clean_customers(self.raw.customers, self.as_of))

    @cached_property
    def products(self) -> DataFrame:
        return self.publish("dim_products", cleaning.clean_products(self.raw.products))

    @cached_property
    def orders(self) -> DataFrame:
        return self.publish_sliced("orders", lambda of: cleaning.clean_orders(of(self.raw.orders)))

    @cached_property
    def returns(self) -> DataFrame:
        return self.publish_sliced("returns", lambda of: cleaning.clean_returns(of(self.raw.returns)))

    def _clean_lines(self, of: Slice) -> DataFrame:
        self.raw, self.dimensions  # published before the fact that joins them
        return star.build_clean_fact(sliced(self.raw, of), self.customers, self.products, of(self.orders), of(self.returns), self.file_order)

    @cached_property
    def fact_clean(self) -> DataFrame:
        return self.publish_fact("fact_clean", self._clean_lines, star.LINE_KEY)

    @property
    def clean_pieces(self) -> list[DataFrame]:
        """The clean fact for one that writes it elsewhere: as it is published or, before that, a piece for each slice."""
        return [self.fact_clean] if "fact_clean" in self.__dict__ else [with_month(self._clean_lines(of)) for of in self.slices()]

    @cached_property
    def fact_raw(self) -> DataFrame:
        return self.publish_fact("fact_raw", lambda of: star.build_raw_fact(sliced(self.raw, of), keep=self.keep), [*star.LINE_KEY, *self.keep[:1]])

    @cached_property
    def dim_date(self) -> DataFrame:
        """Warehouse calendar over the bounds of the data."""
        return self.publish("dim_date", star.dim_date_warehouse(star.order_date_bounds(self.orders)))


_MARTS: dict[tuple[str, str], Mart] = {}


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart of ``sf_dir`` in this application."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _MARTS:
        _MARTS[key] = Mart(spark, read_driver(spark, str(sf_dir)), str(sf_dir), AS_OF, FILE_ORDER, ["line_no", "supp_no", "flag", "ext"])
    return _MARTS[key]
