"""Target-distribution importance resampling: array-scored weights, then a distributed quickselect.

Features are runs of words, hashed to buckets. A bucket's gain is the rounded log ratio of its smoothed share in the target and in the corpus;
a document's weight is the mean gain of its features, taken from one array of gains by the array of its buckets. A Gumbel draw that
the document's id fixes is added, so the highest scores are a sample without replacement in proportion to the weights' exponents.

The k highest are found without sorting all: random pivot keys cut the candidates, exact counts of the rows before, at and after each pivot say
between which two the k-th key lies, and only what lies there goes on. Keys are (score, doc_id, row), so no two are equal and
ties of any number are cut at the right place. The winners alone are sorted, by ranges, and ranked.

Null and empty texts have no features and weight 0. A null doc_id draws as an empty id and comes after all others among equal scores; repeated
rows are drawn each, the earlier row first. An empty table gives no rows, an empty target the gains of its smoothing.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm.components import stored
from salesloom.plans.ordered import running_totals

BUCKETS = 10_000
#: Pivot keys of a round; each round leaves about one part in so many.
PIVOTS = 31
#: Words of more bytes are hashed one by one.
_LONG = 64
_LAST = (1 << 63) - 1


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()
_ONES = np.uint32(0xFFFFFFFF)


def crc_feed(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running crc32 states after the bytes of one span each; a state is the complement of the crc32 so far."""
    size = ends - starts
    order = np.argsort(size, kind="stable")
    ranked, at, out = size[order], starts[order], state[order]
    short = int(np.searchsorted(ranked, _LONG, "right"))
    for k in range(int(ranked[short - 1]) if short else 0):
        go = slice(int(np.searchsorted(ranked[:short], k, "right")), short)
        now = out[go]
        out[go] = _CRC[(now ^ buf[at[go] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    for i in range(short, len(order)):
        out[i] = np.uint32(zlib.crc32(buf[at[i]: at[i] + ranked[i]], int(out[i] ^ _ONES))) ^ _ONES
    back = np.empty_like(out)
    back[order] = out
    return back


def features(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: first text, last + 1, words of each, and the text and bucket of every run of 1 to ``longest`` words."""
    blank = np.array([0x20], np.uint8)
    for at, to, buf, off in K.pieces(texts):
        buf = K.LOWER[buf]
        starts, ends, doc = K.find_words(buf, off, K.NOT_ALNUM)
        state = crc_feed(np.full(len(starts), _ONES), buf, starts, ends)
        docs, crcs = [doc], [state ^ _ONES]
        first = np.arange(len(starts))  # first word of each run whose state is known
        for n in range(1, longest):
            go = first + n < len(doc)
            go[go] = doc[first[go]] == doc[first[go] + n]
            first, zero = first[go], np.zeros(int(go.sum()), np.int64)
            state = crc_feed(crc_feed(state[go], blank, zero, zero + 1), buf, starts[first + n], ends[first + n])
            docs.append(doc[first])
            crcs.append(state ^ _ONES)
        yield at, to, np.bincount(doc, minlength=to - at), np.concatenate(docs), (np.concatenate(crcs) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket. Tasks send one row a bucket, and one row a bucket comes to the driver."""
    K.small_batches(texts.sparkSession)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for *_, bucket in features(b["text"], longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share in the target over that in the corpus, for each bucket."""
    m, s, t = len(corpus), corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + m) / ((s + 1) * (t.sum() + m)))).astype(np.int64)


def draw(doc_id: int | None, seed: int) -> int:
    """floor(1000 x) of the Gumbel value that the id fixes."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int, longest: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    K.small_batches(docs.sparkSession)
    names, buckets = ("n_words", "n_features", "weight", "score"), len(gain)

    def run(batches):
        for b in batches:
            ids = b["doc_id"].cast(pa.int64())
            out = np.zeros((4, len(ids)), np.int64)
            for at, to, words, doc, bucket in features(b["text"], longest, buckets):
                n = np.bincount(doc, minlength=to - at)
                total = np.bincount(doc, weights=gain[bucket], minlength=to - at).astype(np.int64)  # exact: whole numbers below 2^53
                out[:3, at:to] = words, n, np.floor_divide(total, np.maximum(n, 1))
            out[3] = out[2] + np.array([draw(i, seed) for i in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, out)], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def _before(pivot: tuple[int, int, int], or_at: bool = False) -> Column:
    """Rows that come before a key: higher score, then smaller id, then earlier row."""
    score, doc_id, row = (F.lit(x) for x in pivot)
    last = F.col("row") <= row if or_at else F.col("row") < row
    return (F.col("score") > score) | (F.col("score") == score) & ((F.col("id") < doc_id) | (F.col("id") == doc_id) & last)


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS) -> tuple[int, int, int]:
    """The k-th of distinct keys (score, id, row), k from 1 on, by rounds of random pivots and exact three-way counts."""
    turn = 0
    while True:
        drawn = keys.orderBy(F.xxhash64("row", F.lit(turn)), "row").limit(pivots).collect()  # all that are left, if they are so few
        cuts = sorted(((r["score"], r["id"], r["row"]) for r in drawn), key=lambda p: (-p[0], p[1], p[2]))
        ahead = keys.agg(*[F.count_if(_before(p)).alias(f"c{i}") for i, p in enumerate(cuts)]).first()
        low, high = None, None
        for p, n in zip(cuts, ahead):
            if n == k - 1:  # the row at the pivot is one, as keys are distinct
                return p
            if n < k:
                low = p, n
            elif high is None:
                high = p
        if low:
            keys, k = keys.where(~_before(low[0], or_at=True)), k - low[1] - 1
        if high:
            keys = keys.where(_before(high))
        keys = stored(keys, "candidates")
        turn += 1


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Every row's doc_id, n_words, n_features, weight, score and rank (null if it is not drawn).

    Drawn are floor(percent N / 100) rows of the N with at least ``least_words`` words.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    own = ["doc_id", "n_words", "n_features", "weight", "score"]
    rows = stored(scored(docs, gain, seed, longest).withColumn("row", F.monotonically_increasing_id()), "scored").withColumn(
        "id", F.coalesce("doc_id", F.lit(_LAST)))
    may = F.col("n_words") >= least_words
    k = percent * rows.where(may).count() // 100
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return rows.select(*own, none)
    key = kth_key(rows.where(may).select("score", "id", "row"), k)
    wins = may & _before(key, or_at=True)
    ranked = running_totals(rows.where(wins), [F.col("score").desc(), "id", "row"], {}, position="rank")
    return rows.where(~wins).select(*own, none).unionByName(ranked.select(*own, F.col("rank").cast("long")))


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id is drawn, with all their columns; null ids are left out."""
    ids = stored(resampled(docs, target, **options).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct(), "drawn")
    return docs.join(ids, docs["doc_id"] == ids["_drawn"], "left_semi")


def ranks(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row."""
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
