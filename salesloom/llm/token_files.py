"""Token ids in files of fixed-width packed bits, with block offsets for random access.

A file set is a folder of Parquet files in the shared store with a row for each block: shard, block, start (tokens of the shard before the
block), n_tokens, bits, payload, and docs: position, doc_id, start and n_tokens of the documents that have tokens in the block. A payload packs each
id into ``bits`` bits, the least number that holds every id of the vocabulary, lowest bit first. Shards are ranges of doc_id and
ordered like them, so ids lie in ascending order of doc_id. All blocks but the last of a shard have the same number of tokens, so the
block of a token is a division, and numpy unpacks it at once.

Null and empty texts are written as their end id only. Rows of one doc_id lie side by side. An empty table gives an empty set.
"""

from __future__ import annotations

import json
import uuid
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm.bpe_trie import ChunkEncoder, fresh, portions
from salesloom.session import run_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Tokens in a block, a multiple of 8 so that blocks of any width end at a byte.
BLOCK = 1 << 16

BLOCKS = ("shard int, block long, start long, n_tokens long, bits int, payload binary, "
          "docs array<struct<position:long,doc_id:long,start:long,n_tokens:long>>")


_DOC = pa.struct([(n, pa.int64()) for n in ("position", "doc_id", "start", "n_tokens")])
SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("bits", pa.int32()),
                    ("payload", pa.binary()), ("docs", pa.list_(_DOC))])
PIECES = pa.schema([("shard", pa.int32()), *[(n, pa.int64()) for n in ("before", "position", "doc_id", "start", "n_tokens")], ("ids", pa.binary()),
                    ("block", pa.int64()), ("whole", pa.bool_())])


def bits_for(vocabulary: int) -> int:
    """Least number of bits for ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, lowest first."""
    if not len(ids):
        return b""
    if int(ids.max()) >> bits:
        raise ValueError("an id needs more bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(payload: bytes, bits: int, n: int) -> np.ndarray:
    """The ``n`` ids of a payload."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(payload, np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


class _Chunks(dict):
    """Ids of chunks, made when they are asked for first; what ``before`` has comes back from there."""

    def __init__(self, make: Callable[[str], bytes], longest: int, before: dict[str, bytes]):
        super().__init__()
        self.make, self.longest, self.before = make, longest, before

    def __missing__(self, chunk: str) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            ids = self.make(chunk)
        if len(chunk) <= self.longest:
            self[chunk] = ids
        return ids


class Encoder(ChunkEncoder):
    """The library's model, asked for each word once until it is forgotten; texts are split into words beside it, as merges stay within words."""

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            super().__init__(json.load(f), limit)
        self.model = Tokenizer.from_file(path).model
        self.known: dict[str, bytes] = {}  # words; kept between tasks

    def _chunk(self, chunk: str) -> bytes:
        known, out = self.known, []
        for w in (chunk.lower(),) if chunk.isascii() and chunk.isalpha() else self.words_of(chunk):
            ids = known.get(w)
            if ids is None:
                ids = array("I", [t.id for t in self.model.tokenize(w)]).tobytes()
                if len(w) <= self.LONGEST:
                    known[w] = ids
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if not isinstance(self.chunks, _Chunks) or len(self.chunks) > self.limit:
            before = self.chunks
            if isinstance(before, _Chunks):
                before.before = {}  # older ones are forgotten
            self.chunks = _Chunks(self._chunk, self.LONGEST, before)
        if len(self.known) > 2 * self.limit:
            self.known.clear()
        ids = self.chunks.__getitem__
        return [b"".join([b"".join(map(ids, p)) if type(p) is list else array("I", [p]).tobytes() for p in self.parts(t)]) for t in texts]


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Encoder:
    return Encoder(path)


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, block: int = BLOCK) -> None:
    """Encode ``docs`` (doc_id, text) and write the file set to ``folder``."""
    spark = docs.sparkSession
    K.small_batches(spark)
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    bits = bits_for(max(end_id, *told["model"]["vocab"].values(), *[t["id"] for t in told["added_tokens"]]) + 1)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        shard = TaskContext.get().partitionId()
        code, end = fresh(_vocabulary(path)), np.array([end_id], "<u4").tobytes()
        raw, made, tokens, position, open_docs = b"", 0, 0, 0, []

        def blocks(last: bool):
            """Rows of the blocks that are full, or of all that is left."""
            nonlocal raw, made, open_docs
            rows, at = [], 0
            while len(raw) - at >= 4 * block or last and at < len(raw):
                ids = np.frombuffer(raw[at: at + 4 * block], "<u4")
                to = made * block + len(ids)
                here = next((k for k, d in enumerate(open_docs) if d["start"] >= to), len(open_docs))
                rows.append({"shard": shard, "block": made, "start": made * block, "n_tokens": len(ids), "bits": bits,
                             "payload": pack_bits(ids, bits), "docs": open_docs[:here]})
                open_docs = [d for d in open_docs[:here] if d["start"] + d["n_tokens"] > to] + open_docs[here:]
                made += 1
                at += 4 * block
            raw = raw[at:]
            return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

        for b in batches:
            doc_ids = iter(b["doc_id"].cast(pa.int64()).to_pylist())
            for part in portions(b["text"].to_pylist()):
                new = [x + end for x in code.encode_batch(part)]
                for x in new:
                    open_docs.append({"position": position, "doc_id": next(doc_ids), "start": tokens, "n_tokens": len(x) // 4})
                    position += 1
                    tokens += len(x) // 4
                raw += b"".join(new)
                yield blocks(False)
        yield blocks(True)

    first = F.col("doc_id").asc_nulls_first()
    then = F.xxhash64("text")  # cuts the rows of one id, or of none, into several shards
    ordered = docs.select("doc_id", "text").repartitionByRange(n, first, then).sortWithinPartitions(first, then)
    ordered.mapInArrow(run, BLOCKS).write.parquet(f"{folder}/blocks")


def blocks_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def index_of(spark: SparkSession, folder: str) -> DataFrame:
    """shard, position, doc_id, start in the shard, n_tokens of every written row; reads no payload."""
    return blocks_of(spark, folder).select("shard", F.col("start").alias("first"), F.explode("docs").alias("d")).where(
        "d.start >= first").select("shard", "d.*")


def read(spark: SparkSession, folder: str, doc_ids: DataFrame | None = None) -> DataFrame:
    """Documents of a file set: doc_id, start (over all shards), n_tokens, ids (binary, little-endian unsigned 32-bit).

    With ``doc_ids`` (a frame with that column) only their blocks are read and unpacked. A document within one block comes from the scan;
    the pieces of one that lies in several blocks meet in a shuffle, which is all that is shuffled. What lies before each shard joins the blocks before
    they are unpacked: one row of 12 bytes a shard, of which there are as many as shuffle partitions, so it is broadcast.
    """
    K.small_batches(spark)
    blocks = blocks_of(spark, folder)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    if doc_ids is not None:
        wanted = index_of(spark, folder).join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")
        size = blocks.agg(F.max("n_tokens")).first()[0] or 1
        touched = wanted.select("shard", F.explode(F.sequence(
            F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("n_tokens") - 1) / size))).alias("block"))
        blocks = blocks.join(touched.distinct(), ["shard", "block"], "left_semi")

    blocks = blocks.join(F.broadcast(before), "shard")

    def cut(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = unpack_bits(row["payload"], row["bits"], row["n_tokens"]).astype("<u4")
                begin, end = row["start"], row["start"] + row["n_tokens"]
                yield pa.RecordBatch.from_pylist([d | {
                    "shard": row["shard"], "block": row["block"], "whole": begin <= d["start"] and d["start"] + d["n_tokens"] <= end,
                    "before": row["before"], "ids": ids[max(0, d["start"] - begin): d["start"] + d["n_tokens"] - begin].tobytes()} for d in row["docs"]], schema=PIECES)

    def join(batches):
        for b in batches:
            ids = [b"".join(p["ids"] for p in ps) for ps in b["pieces"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in names], pa.array(ids, pa.binary())], [*names, "ids"])

    names = ["shard", "before", "position", "doc_id", "start", "n_tokens"]
    kinds = "shard int, before long, position long, doc_id long, start long, n_tokens long, ids binary"
    pieces = blocks.mapInArrow(cut, kinds + ", block long, whole boolean")
    torn = blocks.withColumn("docs", F.filter("docs", lambda d: (d["start"] < F.col("start")) | (
        d["start"] + d["n_tokens"] > F.col("start") + F.col("n_tokens")))).where(F.size("docs") > 0).mapInArrow(cut, kinds + ", block long, whole boolean")
    met = torn.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("block", "ids"))).alias("pieces")).mapInArrow(join, kinds)
    found = pieces.where("whole").select(*names, "ids").unionByName(met)
    if doc_ids is not None:
        found = found.join(wanted.select("shard", "position"), ["shard", "position"], "left_semi")
    return found.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")


def stored_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all of ``docs``, read the files back: doc_id, start, n_tokens and the crc32 of the ids of every row."""
    spark = docs.sparkSession
    folder = run_dir(spark, f"tokens-{uuid.uuid4().hex}")
    write(docs, folder, path or public_tokenizers.path(VOCABULARY))

    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
