"""How published tables are laid out in files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH = "order_month"
#: Published tables are read a few times and may lie beside their source, so they are packed tighter than by default.
PACKED = {"compression": "zstd"}


def with_month(fact: DataFrame, date_column: str = "order_date") -> DataFrame:
    return fact.withColumn(MONTH, F.trunc(date_column, "MM").cast("date"))


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None, cluster_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write a table, optionally partitioned by one column and clustered within the partitions.

    Clustered: rows are range-partitioned on (partition, cluster columns), so each file holds one contiguous
    key range of one or a few partitions. Lines of an order then sit in one file, and counting distinct orders
    shrinks the lines to orders before the shuffle. A month, or even an order, with a third of all rows is
    cut into many ranges. Otherwise REBALANCE does the sizing: it splits large and merges small partitions.
    """
    if partition_by and cluster_by:
        keys = [partition_by, *cluster_by]
        ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        ranged.write.mode(mode).options(**PACKED).partitionBy(partition_by).parquet(path)
    elif partition_by:
        df = df.hint("rebalance", partition_by)
        df.write.mode(mode).options(**PACKED).partitionBy(partition_by).parquet(path)
    else:
        df.hint("rebalance").write.mode(mode).options(**PACKED).parquet(path)


def spread_over_months(df: DataFrame, rows: Mapping[dt.date | None, int], cluster_by: Sequence[str], heavy: Collection = (), files: int | None = None) -> DataFrame:
    """``df`` dealt out so that a task holds lines of one month, all of an order, and is clustered within it.

    ``rows`` says how much of the table each month holds, from a table that is cheap to count; a month gets tasks in proportion, ``files`` in all (one a shuffle
    partition if not given), one at least. Orders, the first of ``cluster_by``, go to a task of their month by hash; those in ``heavy`` are too large for
    one and are spread by all of ``cluster_by``. The rows are evaluated once, where range partitioning would sample them first. A month that ``rows``
    lacks shares the last task.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = max(sum(rows.values()), 1)
    places, at = [], 0
    for month, held in sorted(rows.items(), key=lambda r: (r[0] is not None, r[0] or dt.date.min)):
        tasks = max(1, round(n * held / total))
        places.append((month, at, tasks))
        at += tasks
    order = F.xxhash64(cluster_by[0])
    hashed = F.when(F.col(cluster_by[0]).isin(list(heavy)), F.xxhash64(*cluster_by)).otherwise(order) if heavy else order
    known = [p for p in places if p[0] is not None]
    none = next((p for p in places if p[0] is None), (None, at, 1))
    first, tasks = F.lit(none[1]), F.lit(none[2])
    if known:
        lookup = F.create_map(*[F.lit(x) for m, a, t in known for x in (m, a)]), F.create_map(*[F.lit(x) for m, a, t in known for x in (m, t)])
        first, tasks = (F.when(F.col(MONTH).isNull(), v).otherwise(F.coalesce(F.try_element_at(m, F.col(MONTH)), F.lit(other)))
                        for v, m, other in zip((first, tasks), lookup, (at, 1)))
    return df.repartitionById(at + 1, (first + F.pmod(hashed, tasks)).cast("int")).sortWithinPartitions(MONTH, *cluster_by)
