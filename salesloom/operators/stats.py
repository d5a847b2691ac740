"""Pearson correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ["quantity", "selling_price", "discount", "revenue", "profit"]


def correlations(fact: DataFrame, columns: Sequence[str] = COLUMNS, digits: int = 6) -> DataFrame:
    """The full matrix in long form, from one aggregation with one CORR per pair of columns."""
    number = {c: F.col(c).cast("double") for c in columns}
    pairs = list(combinations(columns, 2))
    one = fact.agg(*[F.round(F.corr(number[a], number[b]), digits).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{min(a, b, key=columns.index)}|{max(a, b, key=columns.index)}").alias("r"))
             for a in columns for b in columns if a != b]
    cells += [F.struct(F.lit(a).alias("x"), F.lit(a).alias("y"), F.lit(1.0).alias("r")) for a in columns]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.x", "c.y", "c.r")


def key_correlations(fact: DataFrame) -> DataFrame:
    """The three pairs reports quote."""
    c = {n: F.col(n).cast("double") for n in ("revenue", "profit", "discount")}
    return fact.agg(
        F.round(F.corr(c["revenue"], c["profit"]), 3).alias("revenue_profit"),
        F.round(F.corr(c["discount"], c["profit"]), 3).alias("discount_profit"),
        F.round(F.corr(c["discount"], c["revenue"]), 3).alias("discount_revenue"),
    )
