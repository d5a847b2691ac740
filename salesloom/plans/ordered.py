"""Running totals, neighbours and ranks over one global order, without one-task windows.

``Window.orderBy`` without a partition sends every row to one task, and ``partitionBy(customer)`` sends a
giant customer to one task. Here rows are range-partitioned on the full order instead, so even one key that
holds a third of the rows spreads over many partitions ("chunks"). Each chunk is scanned on its own, and the
totals of the chunks before it are added as an offset. What meets in one task besides a chunk is one row per
chunk, which the number of partitions bounds.

What is kept is a prefix-sum index of two levels: the rows with their sums, numbers and neighbours within the chunk, and a table of what the other
chunks add, which has at most two rows a chunk where rows are summed by key (a key's first and last chunk can only be a chunk's last and
first key). ordered() writes both once; reading them needs no exchange of rows, as the second level is small enough to be
broadcast whatever the number of rows. Both levels are made from what is written, so lost executors don't move chunk borders.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.session import shared_dir

CHUNK = "_chunk"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _add(here: Column, before: Column) -> Column:
    """SUM of two partial sums: NULL only where both are."""
    return F.when(here.isNull(), before).when(before.isNull(), here).otherwise(here + before)


def range_chunks(df: DataFrame, order_by: Sequence[Column | str], chunks: int | None = None) -> DataFrame:
    """Rows in contiguous ranges of ``order_by`` with the range number in ``_chunk``.

    Without ``chunks`` there are as many ranges as shuffle partitions, and adaptive execution merges small ones.
    """
    number = [chunks] if chunks else []
    ranged = df.repartitionByRange(*number, *[_column(c) for c in order_by])
    return ranged.withColumn(CHUNK, F.spark_partition_id())


Store = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class Ordered:
    """The two levels of ordered(): ``rows`` with what their chunk says, ``index`` with what the other chunks say."""

    rows: DataFrame
    index: DataFrame
    columns: Sequence[str]
    keys: Sequence[str]
    sums: Sequence[str]
    following: Sequence[str]
    overall: str | None

    def read(self) -> DataFrame:
        """The rows with their running sums, row number and next-row values."""
        group = [*self.keys, CHUNK]
        bounded = not (self.overall and self.keys)  # grand totals by key are a row for each key and chunk
        joined = self.rows.join(F.broadcast(self.index) if bounded else self.index, group, "left")
        return joined.select(
            *self.columns,
            *[_add(F.col(f"_s_{name}"), F.col(f"_o_{name}")).alias(name) for name in self.sums],
            *[F.col(f"_a_{name}").alias(f"{name}{self.overall}") for name in (self.sums if self.overall else ())],
            *[F.when(F.col(f"_l_{name}").isNotNull(), F.col(f"_l_{name}.v")).otherwise(F.col(f"_n_{name}.v")).alias(name) for name in self.following],
        )


def ordered(
    df: DataFrame,
    order_by: Sequence[Column | str],
    totals: Mapping[str, Column],
    store: Store,
    keys: Sequence[str] = (),
    position: str | None = None,
    following: Mapping[str, str] | None = None,
    overall: str | None = None,
    chunks: int | None = None,
) -> Ordered:
    """Both levels of the index, written by ``store(name, frame)``, which gives the frame back.

    ``totals`` are running sums, ``position`` the row number and ``following`` next-row values, all within ``keys`` (which must not be NULL) in the
    order ``order_by``, which must be total within the keys. ``following`` maps the new column to the column whose next value it takes. ``overall`` is a suffix: with
    it, the grand total of each sum and the row count within the keys come along as ``<name><suffix>``.
    """
    keys, following = list(keys), dict(following or {})
    counted = {**totals, **({position: F.lit(1)} if position else {})}
    group = [*keys, CHUNK]
    local = W.partitionBy(*group).orderBy(*[_column(c) for c in order_by])
    upto = local.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = store("rows", range_chunks(df, [*keys, *order_by], chunks).withColumns({
        "_rn": F.row_number().over(local),
        **{f"_t_{name}": expr for name, expr in counted.items()},
        **{f"_l_{name}": F.lead(F.struct(F.col(src).alias("v"))).over(local) for name, src in following.items()},
    }).withColumns({f"_s_{name}": F.sum(f"_t_{name}").over(upto) for name in counted}))

    per_chunk = rows.groupBy(*group).agg(
        *[F.sum(f"_t_{name}").alias(f"_t_{name}") for name in counted],
        *[F.max(F.when(F.col("_rn") == 1, F.struct(F.col(src).alias("v")))).alias(f"_f_{name}") for name, src in following.items()],
    )
    whole = W.partitionBy(*keys)
    across = whole.orderBy(CHUNK)
    before = across.rowsBetween(W.unboundedPreceding, -1)
    index = per_chunk.select(
        *group,
        *[F.sum(f"_t_{name}").over(before).alias(f"_o_{name}") for name in counted],
        *[F.sum(f"_t_{name}").over(whole).alias(f"_a_{name}") for name in (counted if overall else ())],
        *[F.lead(f"_f_{name}").over(across).alias(f"_n_{name}") for name in following],
        F.count(F.lit(1)).over(whole).alias("_chunks"),
    )
    if not overall:
        index = index.where("_chunks > 1")  # what lies in one chunk is whole as it is
    return Ordered(rows, store("index", index.drop("_chunks")), df.columns, keys, list(counted), list(following), overall)


def checkpointed(_: str, df: DataFrame) -> DataFrame:
    """The store of an index that is used once."""
    shared_dir(df.sparkSession)  # makes sure that a checkpoint folder is set
    return df.checkpoint()


def running_totals(df: DataFrame, order_by: Sequence[Column | str], totals: Mapping[str, Column], keys: Sequence[str] = (), position: str | None = None,
                   following: Mapping[str, str] | None = None, overall: str | None = None, chunks: int | None = None) -> DataFrame:
    """ordered() for one use: both levels are checkpointed, then read."""
    return ordered(df, order_by, totals, checkpointed, keys, position, following, overall, chunks).read()


def global_rank(df: DataFrame, value: str, name: str, ascending: bool = False) -> DataFrame:
    """RANK() of every row over all rows by ``value`` (ties share a rank, the next rank skips).

    Works on one row per distinct value, so neither the row count nor a huge tie group meets in one task.
    """
    values = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    order = F.col(value).asc() if ascending else F.col(value).desc()
    ranks = running_totals(values, [order], {"_upto": F.col("_n")}).select(
        value, (F.col("_upto") - F.col("_n") + 1).alias(name)
    )
    return df.join(ranks, value, "left").select(*df.columns, name)
