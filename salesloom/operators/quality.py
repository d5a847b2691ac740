"""Data-quality reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.dates import parse_date
from salesloom.functions.ratios import pct


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs per table and column, columns without any left out (C10). One aggregate row per table, unpivoted."""
    def one(name: str, df: DataFrame) -> DataFrame:
        counted = df.agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
        )
        return counted.unpivot(["_rows"], df.columns, "column_name", "null_count").select(
            F.lit(name).alias("table_name"), "column_name", "null_count", pct("null_count", "_rows").alias("null_pct")
        )
    return _union([one(name, df) for name, df in tables.items()]).filter("null_count > 0")


def null_signups(customers: DataFrame) -> DataFrame:
    """Customers whose signup date is missing or cannot be parsed (C11)."""
    return customers.agg(F.count_if(parse_date("signup_date").isNull()).alias("customers_with_null_signup"))


def dataset_profile(tables: Mapping[str, DataFrame], distinct: Mapping[str, str]) -> DataFrame:
    """Rows, columns and, for the tables named in ``distinct``, the distinct values of one column."""
    def one(name: str, df: DataFrame) -> DataFrame:
        values = F.count_distinct(distinct[name]) if name in distinct else F.lit(None).cast("long")
        return df.agg(F.count(F.lit(1)).alias("row_count"), values.alias("distinct_values")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"), "distinct_values"
        )
    return _union([one(name, df) for name, df in tables.items()])


def order_date_quality(orders: DataFrame, end: dt.date) -> DataFrame:
    """Orders dated after ``end`` and the date range."""
    d = parse_date("order_date")
    return orders.agg(
        F.count_if(d > F.lit(end)).alias("future_orders"), F.min(d).alias("first_date"), F.max(d).alias("last_date")
    )


def malformed_signups(customers: DataFrame) -> DataFrame:
    """Signup texts of the wrong length, and all texts that are no ISO date (C14).

    The length alone misses day-first dates, which are as long as ISO dates.
    """
    text = F.col("signup_date")
    return customers.agg(
        F.count_if(F.length(text) != 10).alias("wrong_length"),
        F.count_if(text.isNotNull() & parse_date(text).isNull()).alias("unparsable"),
    )


def foreign_key_violations(checks: Sequence[tuple[str, DataFrame, Sequence[str], DataFrame]]) -> DataFrame:
    """Rows without a parent, per ``(name, child, key columns, parent)``.

    The child folds to one row per key before the anti join, so a hot key is a single row there.
    """
    def one(name: str, child: DataFrame, keys: Sequence[str], parent: DataFrame) -> DataFrame:
        children = child.select(*keys).na.drop().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        orphans = children.join(parent.select(*keys).distinct(), list(keys), "left_anti")
        return orphans.agg(
            F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
        )
    return _union([one(*check) for check in checks])


def key_violations(checks: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Duplicated and NULL keys per ``(name, table, key columns)``."""
    def one(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.lit(name).alias("check_name"),
            F.count_if((F.col("_n") > 1) & ~missing).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        )
    return _union([one(*check) for check in checks])
