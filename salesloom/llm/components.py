"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.session import run_dir


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = run_dir(spark, f"{what}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge (a, b): the least node that it reaches.

    Each round takes the least label among the neighbours, then the label of that label, so a chain shrinks by more than half.
    A node with very many edges meets its neighbours in map-side minima only.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        least = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("component").alias("far"))
        step = stored(least.join(jump, "now", "left").select(
            "node", "old", F.least("now", F.coalesce("far", "now")).alias("component")), "labels")
        labels = step.select("node", "component")
        if step.where("old <> component").isEmpty():
            return labels
