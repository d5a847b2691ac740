"""Shared helpers: tables, folds, bounded labelled samples, and vectorised words over Arrow text buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes that are not part of a word of digits, a-z and non-ASCII characters.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_STEP = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_STEP), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A random-looking 64-bit word for each byte.
BYTE_WORDS = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of that very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows and bytes, so that long documents don't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def map_rows(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """mapInArrow for columns of any name: they travel under plain names and get their own back."""
    small_batches(docs.sparkSession)
    names = docs.columns
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])

    def renamed(batches):
        for b in run(b.rename_columns(names) for b in batches):
            yield b.rename_columns(plain.names)

    out = docs.select(*[quoted(n).alias(f"c{i}") for i, n in enumerate(names)]).mapInArrow(renamed, plain)
    return out.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(schema.fields)])


def with_added(docs: DataFrame, make: Callable[[pa.RecordBatch], list[pa.Array]], added: str) -> DataFrame:
    """``docs`` with the columns that ``make`` gives for each batch, in place of columns that have their names already."""
    new = T.StructType.fromDDL(added)
    own = [f for f in docs.schema.fields if f.name not in new.names]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b[f.name] for f in own], *make(b)], [*[f.name for f in own], *new.names])

    return map_rows(docs, run, T.StructType([*own, *new.fields]))


def fold(m: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the decimal doc_id modulo ``m``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(m))


def held_out(m: int, rest: int) -> Column:
    return F.coalesce(fold(m) == rest, F.lit(False))


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of every labelled id. Ids with several label rows take the smallest label; null ids and null labels are left out."""
    return labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("double").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """(text, label) of labelled documents, about ``rows`` of them at most, chosen by a hash of doc_id.

    ``rows`` is the documented bound of every sample that a model is fitted on. The labels are those of known_labels(). The chosen ids are at most 1.1 x ``rows`` + 1,000
    rows of 12 bytes, which is the proven bound of what is broadcast here.
    """
    known = known_labels(labels.where(learn), label)
    n = known.count()
    if n > rows:
        known = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) < int(rows / n * (1 << 63)))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array and the offsets of each text; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + len(texts) + 1] if offsets and len(texts) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


def pieces(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first row, last row + 1, bytes, offsets."""
    buf, off = text_buffer(texts)
    at, rows = 0, len(off) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield at, to, buf[off[at]: off[to]], off[at: to + 1] - off[at]
        at = to


def find_words(buf: np.ndarray, off: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word: maximal runs of bytes that don't separate, within one text."""
    inside = np.zeros(len(buf) + 1, bool)
    inside[:-1] = ~separators[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.zeros(len(buf) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, the same for the same bytes wherever they are."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power = np.full(len(buf) + 1, _STEP)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_WORDS[buf] * power[:-1], out=total[1:])
    back = np.full(len(buf) + 1, _INVERSE)
    back[0] = 1
    np.cumprod(back, out=back)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` hashes in a row; empty if there are fewer."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    last = len(hashes) - n + 1
    out = hashes[:last]
    for k in range(1, n):
        out = mix(out * _STEP + hashes[k: last + k])
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
