"""Benchmark decontamination: an FM-index of each training shard, searched backwards for the windows of the benchmark.

A shard is a run of whole documents in a task. Its words that occur in the benchmark, in runs as long as the shortest window or longer, are the
text of the index; other words can't be part of an occurrence. Ranks over the Burrows-Wheeler transform come from a wavelet matrix, all
windows are searched at once, and occurrences are located by walking to the next sampled suffix position. Hit words are merged into spans.

Null texts have no words. Items without words have no window. Items with a null id are searched like the others, but no list of items has them. Repeated
rows get the same answer. The windows of the benchmark are a table of its own, written once and cut by a hash of window and item into slices
of bounded size; the driver holds one of them at a time. A slice is one pass over the rows, within one chain without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm.components import stored
from salesloom.llm.suffix_dedup import merged

WINDOW = 13
#: Bytes of windows and item names that one pass searches for.
SLICE_BYTES = 32 << 20
#: Every so many text positions the position of a suffix is kept.
SAMPLE = 16


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end byte of every word of a batch, lower-cased A-Z."""
    parts = [(np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)]
    for at, _, buf, off in K.pieces(texts):
        buf = K.LOWER[buf]
        s, e, d = K.find_words(buf, off, K.NOT_ALNUM)
        base = off[d]
        parts.append((K.span_hashes(buf, s, e), d + at, s - base, e - base))
    return tuple(np.concatenate(x) for x in zip(*parts))


@dataclass
class Windows:
    """Distinct windows of a benchmark as word numbers, and the items that have them."""

    words: np.ndarray  # sorted hashes; the number of a word is its place + 2
    patterns: list[np.ndarray]
    items: list[list[str]]

    @property
    def shortest(self) -> int:
        return min(map(len, self.patterns), default=0)


def windows_of(items: list[tuple[str | None, str | None]], width: int = WINDOW) -> Windows:
    """All windows of ``width`` words of each item, or the whole item if it has fewer."""
    hashes, item, _, _ = words_of(pa.array([t for _, t in items], pa.string()))
    words = np.unique(hashes)
    numbers = np.searchsorted(words, hashes) + 2
    found: dict[bytes, set[str]] = {}
    for k, (name, _) in enumerate(items):
        own = numbers[np.searchsorted(item, k, "left"): np.searchsorted(item, k, "right")]
        for i in range(max(1, len(own) - width + 1) if len(own) else 0):
            found.setdefault(own[i: i + width].tobytes(), set()).update([] if name is None else [name])
    order = sorted(found)
    return Windows(words, [np.frombuffer(b, np.int64) for b in order], [sorted(found[b]) for b in order])


class FmIndex:
    """FM-index over whole numbers from 1 on; 0 is put at the end."""

    def __init__(self, text: np.ndarray):
        s = np.r_[text, 0]
        n = len(s)
        order = np.argsort(s, kind="stable")
        rank = np.cumsum(np.r_[0, s[order][1:] != s[order][:-1]])
        ranks = np.empty(n, np.int64)
        ranks[order] = rank
        step = 1
        while rank[-1] < n - 1:
            second = np.r_[ranks[step:], np.full(min(step, n), -1)][:n]
            key = ranks * (n + 1) + second + 1
            order = np.argsort(key, kind="stable")
            rank = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]])
            ranks = np.empty(n, np.int64)
            ranks[order] = rank
            step *= 2
        self.n, self.bits = n, max(1, int(s.max()).bit_length())
        bwt = s[order - 1]
        self.before = np.r_[0, np.cumsum(np.bincount(s, minlength=1 << self.bits))]
        self.zeros: list[np.ndarray] = []  # of each level of the wavelet matrix: zeros before each place
        level = bwt
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.zeros.append(np.r_[0, np.cumsum(bit == 0)])
            level = np.r_[level[bit == 0], level[bit == 1]]
        self.bwt = bwt
        self.known = order % SAMPLE == 0
        self.position = np.full(n, -1)
        self.position[self.known] = order[self.known]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before its place."""
        low, high = np.zeros_like(place), place
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            one = (symbol >> b) & 1 == 1
            total = zeros[-1]
            low = np.where(one, total + low - zeros[low], zeros[low])
            high = np.where(one, total + high - zeros[high], zeros[high])
        return high - low

    def search(self, patterns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, position) of every occurrence; all patterns step backwards together."""
        length = np.array([len(p) for p in patterns], np.int64)
        alive = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        flat, begin = np.concatenate([*patterns, np.zeros(0, np.int64)]).astype(np.int64), np.cumsum(length) - length
        for k in range(1, int(length.max(initial=0)) + 1):
            go = alive[length[alive] >= k]
            c = flat[begin[go] + length[go] - k]
            inside = c < len(self.before) - 1
            high[go[~inside]] = low[go[~inside]]
            go, c = go[inside], c[inside]
            low[go], high[go] = self.before[c] + self.rank(c, low[go]), self.before[c] + self.rank(c, high[go])
            alive = alive[high[alive] > low[alive]]
        many = (high - low)[alive]
        pattern = np.repeat(alive, many)
        row = np.repeat(low[alive], many) + np.arange(len(pattern)) - np.repeat(np.cumsum(many) - many, many)
        return pattern, self.locate(row)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back until a sampled suffix."""
        row, steps = row.copy(), np.zeros(len(row), np.int64)
        todo = np.flatnonzero(~self.known[row])
        while len(todo):
            c = self.bwt[row[todo]]
            row[todo] = self.before[c] + self.rank(c, row[todo])
            steps[todo] += 1
            todo = todo[~self.known[row[todo]]]
        return self.position[row] + steps


def hits(texts: pa.Array, windows: Windows) -> tuple[np.ndarray, list[list[tuple[int, int, int, int]]], list[set[str]]]:
    """Words of each text; its merged spans of hit words (first, last + 1, start byte, end byte); its items."""
    hashes, doc, start, end = words_of(texts)
    n_words = np.bincount(doc, minlength=len(texts))
    spans, items = [[] for _ in range(len(texts))], [set() for _ in range(len(texts))]
    if not windows.patterns or not len(hashes):
        return n_words, spans, items
    place = np.minimum(np.searchsorted(windows.words, hashes), len(windows.words) - 1)
    known = windows.words[place] == hashes
    new = np.r_[True, (doc[1:] != doc[:-1]) | (known[1:] != known[:-1])]
    run = np.cumsum(new) - 1
    use = known & (np.bincount(run)[run] >= windows.shortest)
    at = np.flatnonzero(use)
    if not len(at):
        return n_words, spans, items
    gap = np.r_[False, run[at][1:] != run[at][:-1]]
    spot = np.arange(len(at)) + np.cumsum(gap)
    text = np.ones(spot[-1] + 1, np.int64)  # 1 stands between runs
    text[spot] = place[at] + 2
    word = np.full(len(text), -1)
    word[spot] = at
    pattern, position = FmIndex(text).search(windows.patterns)
    first = word[position]
    length = np.array([len(p) for p in windows.patterns])[pattern]
    begin = np.cumsum(n_words) - n_words
    pairs = np.unique(np.column_stack([doc[first], pattern]), axis=0)
    for d, p in pairs.tolist():
        items[d].update(windows.items[p])
    order = np.argsort(doc[first], kind="stable")
    first, last = first[order], (first + length)[order]
    for d in np.unique(doc[first]).tolist():
        a, b = np.searchsorted(doc[first], [d, d + 1])
        s, e = merged(first[a:b], last[a:b])
        spans[d] = [(int(x - begin[d]), int(y - begin[d]), int(start[x]), int(end[y - 1])) for x, y in zip(s, e)]
    return n_words, spans, items


SPAN = ("first", "last", "start", "end")
SPANS = "array<struct<first:long,last:long,start:long,end:long>>"


def _joined(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Spans of several passes, overlapping and touching ones as one."""
    out: list[tuple[int, int, int, int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            f, l, a, b = out[-1]
            out[-1] = (f, max(l, s[1]), a, max(b, s[3]))
        else:
            out.append(s)
    return out


def window_table(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(window, item) of all distinct windows, words joined by a blank, written once."""
    K.small_batches(benchmark.sparkSession)

    def cut(batches):
        for b in batches:
            texts = [bytes(K.LOWER[np.frombuffer((t or "").encode(), np.uint8)]) for t in b["text"].to_pylist()]
            _, item, start, end = words_of(b["text"])
            for k, name in enumerate(b["item"].to_pylist()):
                own = range(int(np.searchsorted(item, k, "left")), int(np.searchsorted(item, k, "right")))
                words = [texts[k][start[i]: end[i]].decode() for i in own]
                windows = {" ".join(words[i: i + width]) for i in range(max(1, len(words) - width + 1) if words else 0)}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(windows), pa.string()), pa.array([name] * len(windows), pa.string())], ["window", "item"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return stored(items.mapInArrow(cut, "window string, item string").distinct(), "windows")


def found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with n_words, hit_spans (words and bytes) and hit_items (sorted texts), in place of columns of these names."""
    table = window_table(benchmark)
    total = table.agg(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
    slices = int(total // SLICE_BYTES) + 1
    span = pa.list_(pa.struct([(n, pa.int64()) for n in SPAN]))
    out = docs
    for k in range(slices):
        part = table.where(F.pmod(F.xxhash64("window", "item"), F.lit(slices)) == k).collect()
        windows = windows_of(sorted(((r["item"], r["window"]) for r in part), key=lambda r: r[1]))

        def make(b: pa.RecordBatch, windows: Windows = windows, later: bool = k > 0) -> list[pa.Array]:
            n, spans, names = hits(b["text"], windows)
            if later:
                spans = [_joined(s + [tuple(x.values()) for x in old]) for s, old in zip(spans, b["hit_spans"].to_pylist())]
                names = [s | set(old) for s, old in zip(names, b["hit_items"].to_pylist())]
            return [pa.array(n, pa.int64()), pa.array([[dict(zip(SPAN, x)) for x in s] for s in spans], span),
                    pa.array([sorted(s) for s in names], pa.list_(pa.string()))]

        out = K.with_added(out, make, f"n_words long, hit_spans {SPANS}, hit_items array<string>")
    return out


def verdicts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with n_words, hit_spans, hit_items, n_hit and contaminated: hit words are a twentieth of all or more."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda t, s: t + s["last"] - s["first"])
    return found(docs, benchmark).withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    return verdicts(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones, all columns as they are."""
    return _rewritten(docs, benchmark, True)


def cut(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the hit spans removed from their texts instead."""
    return _rewritten(docs, benchmark, False)


def _rewritten(docs: DataFrame, benchmark: DataFrame, drop: bool) -> DataFrame:
    """``docs`` without contaminated rows, or without hit spans; the search meets them under plain names."""
    names = docs.columns
    plain = docs.select(*[K.quoted(n).alias(n if n == "text" else f"own_{i}") for i, n in enumerate(names)])
    told = verdicts(plain, benchmark)

    def make(b: pa.RecordBatch) -> list[pa.Array]:
        texts = []
        for t, spans in zip(b["text"].to_pylist(), b["hit_spans"].to_pylist()):
            raw = None if t is None else t.encode()
            for s in reversed(spans):
                raw = raw[: s["start"]] + raw[s["end"]:]
            texts.append(None if raw is None else raw.decode())
        return [pa.array(texts, pa.string())]

    told = told.where(~F.col("contaminated")) if drop else K.with_added(told, make, "text string")
    return told.select(*[F.col(n if n == "text" else f"own_{i}").alias(n) for i, n in enumerate(names)])
