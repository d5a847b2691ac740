"""Incremental refresh of the daily aggregate as new fact files arrive.

The published fact is read as a file stream. The lines of a batch tell which cells (day and group) changed; those are recomputed from the whole
fact, as distinct counts cannot be added up, and a new version of the aggregate takes over the rest. So the result is exact, running a batch
twice changes nothing, and readers see the version before or the one after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesloom.operators.star import DAILY_KEYS
from salesloom.plans.layout import MONTH
from salesloom.sources.sinks import publish_daily_sales, refresh_cells


def refresh_from_stream(
    spark: SparkSession, fact_path: str, out_path: str, progress_path: str, files_per_batch: int = 1000
) -> None:
    """Process all fact files not seen yet, then stop (``availableNow``); progress survives restarts."""
    schema = spark.read.parquet(fact_path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(fact_path)

    def refresh(batch: DataFrame, _: int) -> None:
        fact = spark.read.schema(schema).parquet(fact_path)
        refresh_cells(fact, out_path, batch)

    query = (
        stream.select(MONTH, *DAILY_KEYS).writeStream.foreachBatch(refresh)
        .option("checkpointLocation", progress_path).trigger(availableNow=True).start()
    )
    query.awaitTermination()


__all__ = ["publish_daily_sales", "refresh_from_stream"]
