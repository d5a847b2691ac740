"""Documents in slabs, and a packed exchange that tells every slab which of its keys others hold too.

A slab is a few hundred rows, or one long one, that stay together. The table is bucketed by slab, so later passes meet the answers for a slab
without shuffling a text again. Keys travel as sorted 32-bit arrays, one for each slab and key bucket and each key twice at most, so
a key that a third of all documents hold costs a bucket no more than two numbers a slab.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.session import run_dir

LOW = np.uint64(0xFFFFFFFF)


def new_name() -> str:
    return f"slabs_{uuid.uuid4().hex}"


def discard(spark: SparkSession, name: str) -> None:
    """Drop a slab table and its files, once everything that was made from it is written."""
    spark.sql(f"DROP TABLE {name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark, name))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slab_table(docs: DataFrame, name: str, rows: int = 512, alone: int = 1 << 16) -> DataFrame:
    """Write ``docs`` with ``slab`` and ``rid``, an id of each row that also tells repeated rows apart.

    A text of more than ``alone`` bytes is a slab of its own, so a slab has ``rows`` x ``alone`` bytes or one text at most. Written to the shared folder, as ids of rows must not change if a task runs again.
    """
    spark = docs.sparkSession
    K.small_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = docs.withColumn("rid", F.monotonically_increasing_id())
    mask = (1 << 33) - 1
    slab = F.shiftright("rid", 33) * F.lit(1 << 24) + F.floor(F.col("rid").bitwiseAND(F.lit(mask)) / rows)
    long = F.col("n_bytes") > alone
    (numbered.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).withColumn("slab", F.when(long, -1 - F.col("rid")).otherwise(slab.cast("long")))
     .write.bucketBy(n, "slab").sortBy("slab").option("path", run_dir(spark, name)).saveAsTable(name))
    return spark.table(name)


def key_buckets(slabs: DataFrame, bytes_a_key: float, keys: int = 500_000) -> int:
    """Number of key buckets for about ``keys`` keys in each."""
    total = slabs.agg(F.sum("n_bytes")).first()[0] or 0
    return max(8, int(total / bytes_a_key / keys) + 1)


def pack(slab: int, keys: np.ndarray, buckets: int) -> pa.Table:
    """Rows (slab, bucket, keys) of sorted 64-bit ``keys``; split() takes the answers apart in the same order."""
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    used, at = np.unique(bucket[order], return_index=True)
    low = (keys & LOW).astype(np.uint32)[order]
    return pa.table({
        "slab": pa.array(np.full(len(used), slab, np.int64)), "bucket": pa.array(used.astype(np.int64)),
        "keys": pa.array([x.tobytes() for x in np.split(low, at[1:])] if len(used) else [], pa.binary())})


def unpack(keys: np.ndarray, buckets: int, answers: pa.Table) -> np.ndarray:
    """The answer to each of ``keys``, given to pack() before, from the rows (bucket, classes)."""
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    rows = answers.sort_by("bucket")["classes"].to_pylist()
    out = np.zeros(len(keys), np.uint8)
    out[order] = np.frombuffer(b"".join(rows), np.uint8)
    return out


def _count(rows: pa.Table) -> pa.Table:
    packed = rows["keys"].to_pylist()
    keys = np.frombuffer(b"".join(packed), np.uint32)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(keys)])
    classes = np.zeros(len(keys), np.uint8)
    classes[order] = np.repeat(np.ceil(np.log2(count)).astype(np.uint8), count)
    at = np.cumsum([len(x) // 4 for x in packed])[:-1]
    parts = np.split(classes, at)
    return pa.table({"slab": rows["slab"], "bucket": rows["bucket"], "classes": pa.array([x.tobytes() for x in parts], pa.binary()),
                     "top": pa.array([int(x.max(initial=0)) for x in parts], pa.int32())})


def shared_keys(slabs: DataFrame, keys_of: Callable[[pa.Table], np.ndarray], buckets: int, columns: tuple[str, ...] = ("doc_id", "rid", "text")) -> DataFrame:
    """(slab, bucket, classes, top): a byte for each packed key, 0 if it was given once only, else the binary order of its count; the largest.

    ``keys_of`` makes the sorted 64-bit keys of a slab, each twice at most. Keys are told apart by bucket and 32 bits, so
    a class may come out too high where two keys fall together, never too low.
    """
    def emit(rows: pa.Table) -> pa.Table:
        return pack(rows["slab"][0].as_py(), keys_of(rows), buckets)

    sent = slabs.select("slab", *columns).groupBy("slab").applyInArrow(emit, "slab long, bucket long, keys binary")
    return sent.groupBy("bucket").applyInArrow(_count, "slab long, bucket long, classes binary, top int")


def at_most_twice(values: np.ndarray) -> np.ndarray:
    """Sorted values, those of more than two occurrences cut to two."""
    v = np.sort(values)
    return v if len(v) < 3 else v[np.r_[True, True, v[2:] != v[:-2]]]
