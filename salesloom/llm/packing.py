"""Packing documents into as few token sequences as possible: dominance reduction, then best fit.

A document's ids are followed by an end id. A longer document is cut into pieces of a whole sequence each, its first piece being the shorter
rest. Pieces of one length are alike, so an instance is a histogram of lengths and a plan says, for runs of pieces of
a length, which run of sequences they go to. Both are bounded by the capacity, whatever the number of documents, and the plan is all
that the driver makes. Spark encodes, counts, numbers the pieces of each length, and looks every piece up in the plan.

Reduction after Martello and Toth: a set of up to three lengths is fixed, as often as there are pieces for it, if it dominates every other
sequence that holds its longest piece, that is if the contents of any of those could take the places of the set's other pieces. An optimal
packing exists that has those sequences, so what remains is a smaller instance with the same optimum for the rest:

* a piece with which nothing fits stays alone;
* a pair dominates if its shorter piece is at least as long as all that could stand beside the longer one together, so always if it is full;
* a triple dominates if no three other pieces fit beside its longest, its second is the longest that fits, and every
  two that fit are within the second together or have a shorter one within the third.

The rest goes by decreasing length to the fullest sequence that takes it, or in best-fitting sets if that needs fewer sequences. Null and empty texts are one piece with the end id only. Repeated
rows are packed each. A null doc_id stays null. An empty table gives no pieces.
"""

from __future__ import annotations

from collections import Counter
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm.byte_bpe import ByteBpe
from salesloom.llm.components import stored

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
CAPACITY = 1024


@dataclass
class Plan:
    """Segments (length, first, each, sequences, sequence, offset): the pieces of ``length`` from number ``first`` on go to ``sequences``
    sequences from ``sequence`` on, ``each`` to every one of them, from ``offset`` on."""

    capacity: int
    counts: np.ndarray
    segments: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    n_sequences: int = 0

    def __post_init__(self):
        self.left = [int(x) for x in self.counts]
        self.placed = [0] * (self.capacity + 1)

    def put(self, length: int, each: int, sequences: int, sequence: int, offset: int) -> None:
        self.segments.append((length, self.placed[length], each, sequences, sequence, offset))
        self.placed[length] += each * sequences
        self.left[length] -= each * sequences

    def fix(self, lengths: list[int], sequences: int) -> None:
        """Fill new sequences with pieces of these lengths each."""
        offset = 0
        for length, each in Counter(lengths).items():
            self.put(length, each, sequences, self.n_sequences, offset)
            offset += length * each
        self.n_sequences += sequences

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Segments sorted by (length, first) and those two as one search key."""
        s = np.array(sorted(self.segments), np.int64).reshape(-1, 6)
        return s, (s[:, 0] << 44) + s[:, 1]


def _most_beside(left: list[int], room: int, enough: int) -> int:
    """A sum of pieces within ``room``: more than ``enough`` if there is such a sum, else the largest."""
    mask = (1 << (room + 1)) - 1
    sums = 1
    for s in range(1, room + 1):
        n = min(left[s], room // s)
        step = 1
        while n:
            take = min(step, n)
            sums |= (sums << (s * take)) & mask
            n -= take
            step *= 2
        if sums >> (enough + 1):
            break
    return sums.bit_length() - 1


def _dominating(left: list[int], longest: int, capacity: int) -> list[int] | None:
    """A set with ``longest`` that dominates all others with it, or None."""
    room = capacity - longest
    others = list(left)
    others[longest] -= 1
    fitting = [s for s in range(1, room + 1) if others[s]]
    if not fitting:
        return [longest]
    second = fitting[-1]
    low = [s for s in fitting[:3] for _ in range(min(3, others[s]))][:3]
    if second == room or len(low) < 2 or low[0] + low[1] > room or _most_beside(others, room, second) <= second:
        return [longest, second]
    if len(low) == 3 and sum(low) <= room:
        return None
    below = [0] * (room + 1)  # longest piece of at most this length
    for s in range(1, room + 1):
        below[s] = s if others[s] else below[s - 1]
    third = below[min(second, room - second)]
    if third == second and others[second] < 2:
        third = below[second - 1]
    if not third:
        return None
    for a in fitting:
        b = below[min(a, room - a)]
        if b == a and others[a] < 2:
            b = below[a - 1]
        if b > third and a + b > second:
            return None
    return [longest, second, third]


def reduce(plan: Plan) -> None:
    """Fix dominating sets until there are none."""
    changed = True
    while changed:
        changed = False
        for longest in range(plan.capacity, 0, -1):
            while plan.left[longest]:
                found = _dominating(plan.left, longest, plan.capacity)
                if found is None:
                    break
                plan.fix(found, min(plan.left[s] // n for s, n in Counter(found).items()))
                changed = True


def best_fit(plan: Plan) -> None:
    """Every piece left, by decreasing length, to the fullest sequence that takes it; sequences alike are handled as one group."""
    rooms: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, sequences)
    for length in range(plan.capacity, 0, -1):
        while plan.left[length]:
            room = next((r for r in range(length, plan.capacity + 1) if rooms.get(r)), 0)
            n = plan.left[length]
            if not room:
                room, new = plan.capacity, -(-n // (plan.capacity // length))
                rooms.setdefault(room, []).append((plan.n_sequences, new))
                plan.n_sequences += new
            first, many = rooms[room].pop()
            each = min(room // length, n)
            full = min(many, n // each)
            plan.put(length, each, full, first, plan.capacity - room)
            rooms.setdefault(room - each * length, []).append((first, full))
            if full < many:
                rooms.setdefault(room, []).append((first + full, many - full))


def best_sets(plan: Plan) -> None:
    """A sequence for the longest piece left, with the pieces that fill it best, long ones first; as often as there are such pieces."""
    for longest in range(plan.capacity, 0, -1):
        while plan.left[longest]:
            room = plan.capacity - longest
            mask = (1 << (room + 1)) - 1
            plan.left[longest] -= 1
            sums = [1] * (room + 1)  # bit t of sums[s]: pieces of at most s make t together
            for s in range(1, room + 1):
                reach, n, step = sums[s - 1], min(plan.left[s], room // s), 1
                while n:
                    take = min(step, n)
                    reach |= (reach << (s * take)) & mask
                    n, step = n - take, 2 * step
                sums[s] = reach
            plan.left[longest] += 1
            rest, chosen = sums[room].bit_length() - 1, [longest]
            for s in range(room, 0, -1):
                most = (rest // s, plan.left[s] - (s == longest))
                n = next((n for n in range(min(most), 0, -1) if sums[s - 1] >> (rest - n * s) & 1), 0)
                chosen += [s] * n
                rest -= n * s
            plan.fix(chosen, min(plan.left[s] // n for s, n in Counter(chosen).items()))


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Plan of ``counts``, the number of pieces of each length up to ``capacity``.

    What the reduction leaves goes by best fit, piece by piece; where that needs more than the sum of lengths demands, best-fitting sets are
    tried as well and the smaller plan is taken.
    """
    reduced = Plan(capacity, counts)
    reduce(reduced)
    out = deepcopy(reduced)
    best_fit(out)
    least = reduced.n_sequences + -(-sum(s * n for s, n in enumerate(reduced.left)) // capacity)
    if out.n_sequences > least:
        other = deepcopy(reduced)
        best_sets(other)
        out = min(out, other, key=lambda p: p.n_sequences)
    return out


_PIECE = [("part", pa.int64()), ("length", pa.int64()), ("number", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
          ("start", pa.int64()), ("ids", pa.binary())]
PIECES = "part long, length long, number long, doc_id long, piece int, start long, ids binary"


def pieces(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids, and a number within the writing task (part) and length. Written, as numbers
    must not change if a task runs again."""
    path = path or public_tokenizers.path(VOCABULARY)
    K.small_batches(docs.sparkSession)
    schema = pa.schema(_PIECE)

    def run(batches):
        part, code, number = TaskContext.get().partitionId(), ByteBpe(path), [0] * (capacity + 1)
        rows: list[tuple] = []
        held = 0
        for b in batches:
            for doc_id, text in zip(b["doc_id"].cast(pa.int64()).to_pylist(), b["text"].to_pylist()):
                ids = code.encode(text)
                ids.append(end_id)
                n = len(ids)
                raw = ids.tobytes()
                to = n % capacity or capacity
                start = k = 0
                while start < n:
                    length = to - start
                    rows.append((part, length, number[length], doc_id, k, start, raw[4 * start: 4 * to]))
                    number[length] += 1
                    k, start, to = k + 1, to, to + capacity
                held += n
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _PIECE)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _PIECE)], schema=schema)

    return stored(docs.select("doc_id", "text").mapInArrow(run, PIECES), "pieces")


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of pieces(), or some of their columns, with ``sequence_id`` and ``offset``.

    Pieces are numbered within their length by what the tasks before wrote of it: one row a task and length. The join carries the columns that
    are asked for, so without ids it moves some fifty bytes a piece.
    """
    counted = stored(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in counted.groupBy("length").agg(F.sum("n")).collect():  # one row a length
        counts[length] = n
    segments, keys = plan(counts, capacity).arrays()
    before = stored(counted.select("part", "length", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("before")), "piece-numbers")
    numbered = cut.join(before, ["part", "length"]).withColumn("number", F.col("number") + F.col("before")).drop("part", "before")

    def place(batches):
        for b in batches:
            length, number = (b[c].to_numpy(zero_copy_only=False) for c in ("length", "number"))
            s = segments[np.searchsorted(keys, (length << 44) + number, "right") - 1].T
            row, slot = np.divmod(number - s[1], s[2])
            yield pa.RecordBatch.from_arrays([*[b[c] for c in names], pa.array(s[4] + row), pa.array(s[5] + slot * length)], [*names, "sequence_id", "offset"])

    names = [c for c in numbered.columns if c != "number"]
    kinds = ", ".join(f"{c} {numbered.schema[c].dataType.simpleString()}" for c in names)
    return numbered.mapInArrow(place, kinds + ", sequence_id long, offset long")


def sequences(pieces_packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids and doc_ids of every sequence; a group holds a sequence's tokens at most."""
    piece = F.struct("offset", "length", "doc_id", "ids")
    met = pieces_packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return met.select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"),
                      joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def digests(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cut = pieces(docs, path, end_id, capacity)
    return packed(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)
