"""Product codes of vectors: each part of a vector becomes the number of its nearest codebook entry, found through LAESA pivots.

Components become whole numbers, floor(scale x), so distances and means are exact and the result doesn't depend on the order of rows.
A few starting entries that lie far apart are the fixed pivots of a part position. The distance of each part to each pivot is computed once and
stored with it. In a round only the distances between pivots and entries are new: |d(part, pivot) - d(pivot, entry)| bounds d(part, entry) from below,
so entries are tried in the order of their bounds, and a part is done once the next bound exceeds the best exact distance.

Rows whose vector is null, empty or holds null or non-finite components are dropped, and so are rows with another number of components than the row
with the smallest vec_id. Whole numbers saturate at 2^26 either way, far from any real embedding, so that sums of squares fit 64 bits. A null
vec_id comes last among the starting entries and is coded like the others. Among rows of one vec_id, the smaller vector starts first. With fewer
rows than entries, codebooks are smaller. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm import common as K
from salesloom.llm.components import stored

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 8, 16, 6, 4096, 4
MOST = 1 << 26
#: Labels up to which their sums are broadcast, 24 bytes each; beyond, they are joined with salt.
MOST_LABELS, SALTS = 100_000, 32


@dataclass
class Codebooks:
    """Entries (part, entry, position) and the pivots (part, pivot, position) whose distances the rows carry."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        """sha256 of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of whole numbers that rows of codes stand for."""
        return np.concatenate([self.entries[p][codes[:, p]] for p in range(len(self.entries))], 1)

    def assign(self, x: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each part and its squared distance, ties to the lower entry: ``x`` (row, part, position), ``far`` (row, part, pivot)."""
        codes, errors = np.zeros(x.shape[:2], np.int64), np.zeros(x.shape[:2], np.int64)
        for p in range(x.shape[1]):
            codes[:, p], errors[:, p] = nearest(np.ascontiguousarray(x[:, p]), far[:, p], self.entries[p], self.pivots[p])
        return codes, errors


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distance of each row to each point."""
    return np.sqrt(np.stack([squared(x, q) for q in points], 1).astype(float)) if len(points) else np.zeros((len(x), 0))


def nearest(x: np.ndarray, far: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of ``entries`` to each row of ``x``, given the rows' distances to ``pivots``."""
    near = distances(entries, pivots)  # entry, pivot
    bound = np.zeros((len(x), len(entries)))
    for q in range(len(pivots)):
        here, there = far[:, q, None], near[None, :, q]
        np.maximum(bound, np.abs(here - there) - 1e-9 * (here + there), out=bound)  # less what rounding may add
    order = np.argsort(bound, 1, kind="stable")
    rows = np.arange(len(x))
    code = order[:, 0].copy()
    best = squared(x, entries[code])
    for k in range(1, len(entries)):
        e = order[rows, k]
        low = bound[rows, e]
        go = low * low <= best[rows]
        rows, e = rows[go], e[go]  # bounds only grow and the best only falls, so the others are done
        if not len(rows):
            break
        d = squared(x[rows], entries[e])
        better = (d < best[rows]) | (d == best[rows]) & (e < code[rows])
        best[rows[better]], code[rows[better]] = d[better], e[better]
    return code, best


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` distinct points, each the farthest from those before."""
    chosen = [0]
    least = distances(points, points[:1])[:, 0]
    while len(chosen) < n and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def whole_numbers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that are kept, their numbers of components, and all their floor(scale x) in one array."""
    vectors = vectors.cast(pa.large_list(vectors.type.value_type))
    size = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten()  # without what null rows hide
    size = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), size, 0)
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    good = np.isfinite(x) & flat.is_valid().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(size)), size)
    keep = (size > 0) & (np.bincount(row, weights=~good, minlength=len(size)) == 0)
    with np.errstate(over="ignore", invalid="ignore"):
        n = np.floor(np.clip(np.nan_to_num(x[keep[row]]) * scale, -MOST, MOST)).astype("<i4")
    return np.flatnonzero(keep), size[keep], n


def _kept(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """vec_id, label, size and x (whole numbers, little-endian signed 32-bit) of rows that are kept."""
    K.small_batches(vectors.sparkSession)
    key = vectors.schema["label"].dataType if "label" in vectors.columns else T.IntegerType()
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", key), T.StructField("size", T.LongType()), T.StructField("x", T.BinaryType())])

    def run(batches):
        for b in batches:
            rows, size, x = whole_numbers(b[2], scale)
            raw, at = x.tobytes(), np.r_[0, np.cumsum(size * 4)].tolist()
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([b[0].take(take), b[1].take(take), pa.array(size.astype(np.int64)), pa.array(
                [raw[i:j] for i, j in zip(at, at[1:])], pa.binary())], schema.names)

    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.select(F.col("vec_id").cast("long"), label.alias("label"), K.quoted(vector)).mapInArrow(run, schema)


def _numbers(b: pa.RecordBatch, parts: int) -> np.ndarray:
    """Row, part, position."""
    return K.text_buffer(b["x"])[0].view("<i4").reshape(b.num_rows, parts, -1).astype(np.int64)


def _far(b: pa.RecordBatch, parts: int) -> np.ndarray:
    return K.text_buffer(b["far"])[0].view("<f8").reshape(b.num_rows, parts, -1)


def _round(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every part to its nearest entry, then every entry to the floored mean of its parts. One row for each component of the codebooks comes back."""
    parts, k, width = books.entries.shape

    def run(batches):
        total, n = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _numbers(b, parts)
            codes, _ = books.assign(x, _far(b, parts))
            for p in range(parts):
                n[p] += np.bincount(codes[:, p], minlength=k)
                for j in range(width):  # exact: whole numbers below 2^53
                    total[p, :, j] += np.bincount(codes[:, p], weights=x[:, p, j], minlength=k).astype(np.int64)
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()), pa.array(np.repeat(n.ravel(), width))], ["at", "total", "n"])

    new = books.entries.copy()
    flat = new.ravel()
    for at, total, n in rows.select("x", "far").mapInArrow(run, "at long, total long, n long").groupBy("at").agg(F.sum("total"), F.sum("n")).collect():
        if n:
            flat[at] = total // n
    return Codebooks(new, books.pivots)


def fit(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
        pivots: int = PIVOTS) -> tuple[DataFrame, Codebooks | None]:
    """Codebooks after all rounds, and the kept rows: vec_id, label, x, and far, the distances of the parts to the pivots, written once."""
    kept = _kept(vectors, vector, scale)
    head = kept.orderBy(F.col("vec_id").asc_nulls_last(), "size", "x").limit(1).collect()
    if not head:
        return kept.where("false").select("vec_id", "label", "x", F.lit(b"").alias("far")), None
    size = head[0]["size"]
    if size % parts:
        raise ValueError(f"vectors of {size} components have no {parts} equal parts")
    kept = kept.where(F.col("size") == size).select("vec_id", "label", "x")
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    first = np.stack([np.frombuffer(r["x"], "<i4").reshape(parts, -1) for r in start], 1).astype(np.int64)  # part, entry, position
    fixed = [far_apart(first[p], pivots) for p in range(parts)]
    least = min(map(len, fixed))
    books = Codebooks(first, np.stack([f[:least] for f in fixed]))

    def measure(batches):
        for b in batches:
            x = _numbers(b, parts)
            far = np.stack([distances(x[:, p], books.pivots[p]) for p in range(parts)], 1) if b.num_rows else np.zeros((0, parts, least))
            raw, step = far.astype("<f8").tobytes(), 8 * parts * least
            yield pa.RecordBatch.from_arrays([*[b[c] for c in names], pa.array([raw[i * step: (i + 1) * step] for i in range(b.num_rows)], pa.binary())], [*names, "far"])

    names = ["vec_id", "label", "x"]
    rows = stored(kept.mapInArrow(measure, T.StructType([*[kept.schema[c] for c in names], T.StructField("far", T.BinaryType())])), "parts")
    for _ in range(rounds):
        books = _round(rows, books)
    return rows, books


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, codes (binary, one byte a part) and error of every row of fit()."""
    parts = len(books.entries)
    if books.entries.shape[1] > 256:
        raise ValueError("a code is a byte")

    def run(batches):
        for b in batches:
            codes, errors = books.assign(_numbers(b, parts), _far(b, parts))
            raw = codes.astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays([b["vec_id"], b["label"], pa.array([raw[i: i + parts] for i in range(0, len(raw), parts)], pa.binary()),
                                              pa.array(errors.sum(1))], ["vec_id", "label", "codes", "error"])

    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType())])
    return rows.mapInArrow(run, schema)


def with_label_error(codes: DataFrame) -> DataFrame:
    """``label_error``: the error summed over the rows of a label; rows without one count together."""
    sums = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "_label")
    same = codes["label"].eqNullSafe(sums["_label"])
    if sums.count() <= MOST_LABELS:
        return codes.join(F.broadcast(sums), same).drop("_label")
    salted = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = codes.withColumn("_row_salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, rows["label"].eqNullSafe(salted["_label"]) & (rows["_row_salt"] == salted["_salt"])).drop("_label", "_salt", "_row_salt")


def digests(vectors: DataFrame) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 of every kept row."""
    rows, books = fit(vectors)
    codes = stored(coded(rows, books), "codes") if books else rows.select("vec_id", "label", F.col("x").alias("codes"), F.lit(0).cast("long").alias("error"))
    return with_label_error(codes).select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                                          F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))
