"""Rows that break a rule, told apart and counted in the one pass that writes a table.

A rule either rejects a row (it can't be loaded: a key is missing or has no parent) or marks it for repair by the cleaning rules. write() stores
every row once, under ``rejected=false`` or ``rejected=true`` with the names of the rules that it breaks, and counts rows by rule
while they are written. No row is dropped: valid and rejected rows together are the input.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.dates import parse_date
from salesloom.operators.cleaning import DISCOUNT_RANGE, MIN_QUANTITY
from salesloom.sources.tables import RawTables

BROKEN = "broken_rules"


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for rows that break the rule; a NULL counts as kept."""

    name: str
    broken: Column
    rejects: bool = False


@dataclass(frozen=True)
class Quarantined:
    """A written table: its valid and rejected rows and how many rows break each rule."""

    table: str
    valid: DataFrame
    rejected: DataFrame
    counts: Mapping[str, int]


def write(df: DataFrame, rules: Sequence[Rule], path: str, table: str) -> Quarantined:
    """Write ``df`` to ``path`` in one pass, split by whether a row is rejected."""
    spark = df.sparkSession
    names = [F.when(F.coalesce(r.broken, F.lit(False)), F.lit(r.name)) for r in rules]
    refused = [r.name for r in rules if r.rejects]
    marked = df.withColumn(BROKEN, F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")).withColumn(
        "rejected", F.arrays_overlap(BROKEN, F.array(*map(F.lit, refused))) if refused else F.lit(False))
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("rejected"), *[F.count_if(F.array_contains(BROKEN, r.name)).alias(r.name) for r in rules]]
    marked.observe(seen, *counts).write.mode("overwrite").partitionBy("rejected").parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(BROKEN, T.ArrayType(T.StringType())), T.StructField("rejected", T.BooleanType())])
    back = spark.read.schema(schema).parquet(path)
    return Quarantined(table, back.where("NOT rejected").select(*df.columns), back.where("rejected").select(*df.columns, BROKEN), dict(seen.get))


def without_parent(child: DataFrame, keys: Sequence[str], parent: DataFrame, flag: str) -> DataFrame:
    """``child`` with ``flag``, whether its keys, all there, are those of no parent. A parent is one row a key; hot keys are split by adaptive execution."""
    known = parent.select(*keys).distinct().withColumn("_known", F.lit(True))
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    return child.join(known, list(keys), "left").select(*child.columns, (there & F.col("_known").isNull()).alias(flag))


def _missing(*keys: str) -> Rule:
    broken = F.lit(False)
    for k in keys:
        broken = broken | F.col(k).isNull()
    return Rule("key is missing", broken, rejects=True)


def _unreadable(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "") & parse_date(c).isNull()


def raw_rules(as_of: dt.date) -> dict[str, list[Rule]]:
    """The rules of each raw table. Rules on parents read the flags that quarantine() adds."""
    price = lambda c: Rule(f"{c} is negative", F.col(c) < 0)
    low, high = DISCOUNT_RANGE
    return {
        "customers": [_missing("customer_id"), Rule("name holds a quote", F.contains("name", F.lit("'"))), Rule("age is missing", F.col("age").isNull()),
                      Rule("signup date is unreadable", _unreadable("signup_date")), Rule("signup date is to come", parse_date("signup_date") > F.lit(as_of))],
        "products": [_missing("product_id"), price("cost_price"), price("selling_price"),
                     Rule("cost reaches the price", F.greatest("cost_price", F.lit(0)) >= F.greatest("selling_price", F.lit(0)))],
        "orders": [_missing("order_id"), Rule("customer is unknown", F.col("_no_customer"), rejects=True), Rule("customer is missing", F.col("customer_id").isNull()),
                   Rule("order date is unreadable", _unreadable("order_date")), Rule("shipped before the order", parse_date("shipping_date") < parse_date("order_date"))],
        "order_items": [_missing("order_id", "product_id"), Rule("order is unknown", F.col("_no_order"), rejects=True),
                        Rule("product is unknown", F.col("_no_product"), rejects=True), Rule("quantity is too low", F.col("quantity") < MIN_QUANTITY),
                        price("selling_price"), Rule("discount is out of range", (F.col("discount") < low) | (F.col("discount") > high))],
        "returns": [_missing("order_id", "product_id"), Rule("line is unknown", F.col("_no_line"), rejects=True)],
    }


def quarantine(raw: RawTables, as_of: dt.date, folder: str) -> dict[str, Quarantined]:
    """Every raw table written with its rejected rows apart."""
    flagged = {
        "customers": raw.customers, "products": raw.products,
        "orders": without_parent(raw.orders, ["customer_id"], raw.customers, "_no_customer"),
        "order_items": without_parent(without_parent(raw.order_items, ["order_id"], raw.orders, "_no_order"), ["product_id"], raw.products, "_no_product"),
        "returns": without_parent(raw.returns, ["order_id", "product_id"], raw.order_items, "_no_line"),
    }
    return {name: write(df, rules, f"{folder}/{name}", name) for (name, rules), df in zip(raw_rules(as_of).items(), flagged.values())}


def valid_tables(found: Mapping[str, Quarantined]) -> RawTables:
    """The raw tables without their rejected rows, for a load that enforces keys."""
    return RawTables(**{name: q.valid.drop(*[c for c in q.valid.columns if c.startswith("_no_")]) for name, q in found.items()})


def rule_counts(spark: SparkSession, found: Mapping[str, Quarantined]) -> DataFrame:
    """table_name, rule and the rows that break it, as counted while writing; ``rows`` and ``rejected`` are the totals."""
    rows = [(name, rule, n) for name, q in found.items() for rule, n in q.counts.items()]
    return spark.createDataFrame(rows, "table_name string, rule string, row_count long")
