"""Suffix-array dedup: bytes covered by a string of 50 bytes that also starts in a document with a smaller id go.

Every window of 50 bytes has an anchor, its least 16-byte gram by a hash (the leftmost of equal ones); the windows of one anchor lie in
a row and make its segment. Equal windows have equal anchor grams, so only segments whose gram another document holds too matter, and
segments of the same bytes count once, for their smallest document. Of different segments of a gram, two that share a window share the 17 bytes
before the gram or the 18 after it, so only those go on of which another has a flank too. They are compared in buckets of grams with a suffix
array over blocks of bytes aligned at the gram, built by linear grouping; neighbours that share enough bytes share windows.

A gram that thousands of slabs hold would bring an unbounded number of segments into one bucket. The windows of its segments become rows
instead, whose smallest document for each content Spark finds with map-side minima; see CROWDED.

Null and empty texts lose nothing. Rows with a null doc_id are neither cut nor a source. Repeated rows have the same
id, so they don't cut each other. A match never crosses documents. Cut texts may end within a character; ``text`` columns
made of them drop the broken bytes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm import common as K
from salesloom.llm import slabs as S
from salesloom.llm.components import stored

WINDOW, GRAM = 50, 16
#: Grams of this class and more, held by over 4,000 slabs, are compared window by window, not in a bucket of their own.
CROWDED = 14
#: Longest stretch whose anchors are found at once; positions within it have 24 bits.
STRETCH = 1 << 22
_POSITION = np.uint64((1 << 24) - 1)


def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of ``s``, which ends with its only 0, the least symbol.

    First, suffixes with the same symbol form a group. Groups are finished from the highest to the lowest: each member points at the nearest
    position before it that lies in a lower group, and the suffixes pointed at, more often being higher, split off above the
    rest of their group. Then every group holds the suffixes with one Lyndon prefix, and one pass from the least suffix up puts each
    suffix whose next smaller one it meets at the front of its group.
    """
    n = len(s)
    place = sorted(range(n), key=s.__getitem__)
    where, start, size = [0] * n, [0] * n, [0] * n
    g = 0
    for k, i in enumerate(place):
        if s[i] != s[place[g]]:
            g = k
        where[i], start[i] = k, g
        size[g] += 1
    before, top = [-2] * n, n - 1
    while top > 0:
        low = start[place[top]]
        times: dict[int, int] = {}
        for i in place[low: top + 1]:
            if before[i] != -2:
                continue
            chain, p = [i], i - 1
            while p >= 0 and where[p] >= low:
                if before[p] == -2:  # of this very group
                    chain.append(p)
                    p -= 1
                else:
                    p = before[p]
            for i in chain:
                before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + len(chain)
        chosen, level = list(times), 1
        while chosen:
            moved: dict[int, int] = {}
            for j in chosen:
                g = start[j]
                m = moved[g] = moved.get(g, 0) + 1
                to, at = g + size[g] - m, where[j]
                if to != at:
                    other = place[to]
                    place[to], place[at], where[j], where[other] = j, other, to, at
            for g, m in moved.items():
                if m < size[g]:
                    size[g] -= m
                    new = g + size[g]
                    size[new] = m
                    for k in range(new, new + m):
                        start[place[k]] = new
            level += 1
            chosen = [j for j in chosen if times[j] >= level]
        top = low - 1
    front, put, out = list(range(n)), [False] * n, [0] * n
    out[0] = n - 1
    put[n - 1] = True
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not put[p]:
            g = start[p]
            out[front[g]] = p
            front[g] += 1
            put[p] = True
            p = before[p]
    return out


def _stretches(off: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, from, to) of stretches that cover each window start once; long texts fall into several."""
    out = []
    for r in range(len(off) - 1):
        a, b = int(off[r]), int(off[r + 1])
        out += [(r, x, min(b, x + STRETCH + WINDOW - 1)) for x in range(a, max(a, b - WINDOW + 1), STRETCH)]
    return out


def anchors(texts: pa.Array) -> dict[str, np.ndarray]:
    """Of every anchor: row, gram hash, segment hash, start of the segment in its text, its length, the gram's offset in it."""
    buf, off = K.text_buffer(texts)
    parts, todo = [], []
    for x in [*_stretches(off), None]:
        if todo and (x is None or sum(t[2] - t[1] for t in todo) + x[2] - x[1] > STRETCH // 4):
            parts.append(_anchors_of(buf, off, todo))
            todo = []
        if x is not None:
            todo.append(x)
    names = ("row", "gram", "segment", "start", "length", "lead")
    kinds = (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64)
    return {n: np.concatenate([np.zeros(0, k), *[p[i] for p in parts]]) for i, (n, k) in enumerate(zip(names, kinds))}


def _anchors_of(whole: np.ndarray, off: np.ndarray, todo: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
    buf = np.concatenate([whole[a:b] for _, a, b in todo])
    size = np.array([b - a for _, a, b in todo])
    edge = np.r_[0, np.cumsum(size)]
    n = len(buf)
    grams = K.span_hashes(buf, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    best = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    width, want = 1, WINDOW - GRAM + 1
    while width < want:
        step = min(width, want - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    at = (best & _POSITION).astype(np.int64)
    part = np.repeat(np.arange(len(todo)), size)[: len(at)]
    valid = np.arange(len(at)) + WINDOW <= edge[part + 1]
    begins = np.flatnonzero(valid & np.r_[True, (at[1:] != at[:-1]) | (part[1:] != part[:-1])])
    ends = np.flatnonzero(valid & np.r_[(at[1:] != at[:-1]) | (part[1:] != part[:-1]) | ~valid[1:], True])
    lead = at[begins] - begins
    length = ends - begins + WINDOW
    segment = K.mix(K.span_hashes(buf, begins, begins + length) + lead.astype(np.uint64))
    row = np.array([r for r, _, _ in todo])[part[begins]]
    base = np.array([a for _, a, _ in todo])[part[begins]] - off[row]
    return row, grams[at[begins]], segment, begins - edge[part[begins]] + base, length, lead


def _grams_of(rows: pa.Table) -> np.ndarray:
    """Grams of a slab, once for each document and twice at most."""
    rows = rows.filter(rows["doc_id"].is_valid())
    a = anchors(rows["text"])
    order = np.lexsort((a["row"], a["gram"]))
    g, r = a["gram"][order], a["row"][order]
    return S.at_most_twice(g[np.r_[True, (g[1:] != g[:-1]) | (r[1:] != r[:-1])]] if len(g) else g)


def _shared_anchors(rows: pa.Table, answers: pa.Table, buckets: int, low: int, high: int) -> tuple[pa.Table, dict[str, np.ndarray]]:
    """Rows with an id, and those of their anchors whose gram is of class ``low`` to ``high`` - 1."""
    rows = rows.filter(rows["doc_id"].is_valid())
    a = anchors(rows["text"])
    order = np.lexsort((a["row"], a["gram"]))
    g, r = a["gram"][order], a["row"][order]
    keys = S.at_most_twice(g[np.r_[True, (g[1:] != g[:-1]) | (r[1:] != r[:-1])]] if len(g) else g)
    classes = S.unpack(keys, buckets, answers) if len(keys) else np.zeros(0, np.uint8)
    shared = np.unique(keys[(classes >= low) & (classes < high)])
    if not len(shared):
        return rows, {k: v[:0] for k, v in a.items()}
    keep = shared[np.minimum(np.searchsorted(shared, a["gram"]), len(shared) - 1)] == a["gram"]
    return rows, {k: v[keep] for k, v in a.items()}


def _segments(doc: np.ndarray, a: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (gram, segment) of a slab: an index of one anchor each, its smallest document, the number for each anchor."""
    if not len(doc):
        return (np.zeros(0, np.int64),) * 3
    order = np.lexsort((doc, a["segment"], a["gram"]))
    g, s = a["gram"][order], a["segment"][order]
    new = np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], doc[order[new]], number


def _by_bucket(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by gram bucket, the buckets that occur, where each begins."""
    bucket = (gram >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    used, at = np.unique(bucket[order], return_index=True)
    return order, used.astype(np.int64), at


def _cut(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in np.split(values, at[1:])] if len(at) else [], pa.binary())


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, list[int]]:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind), [len(x) // np.dtype(kind).itemsize for x in raw]


OWNER, LATER, CONTESTED = 0, 1, 2
#: A window has this many bytes before its gram, or else at least one more after it; so segments that share a window share one of these flanks.
FLANK = (WINDOW - GRAM) // 2
_FACTORS = K.mix(np.arange(1, GRAM + FLANK + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _flanks(buf: np.ndarray, at: np.ndarray, lead: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the FLANK bytes before the gram and of the FLANK + 1 after it, 0 where a segment has fewer; ``at``: first byte of the gram."""
    out = []
    for there, begin, n in ((lead >= FLANK, at - FLANK, FLANK), (length - lead - GRAM > FLANK, at + GRAM, FLANK + 1)):
        h = np.zeros(len(at), np.uint32)
        total = np.zeros(int(there.sum()), np.uint64)
        for k in range(n):
            total += (buf[begin[there] + k].astype(np.uint64) + np.uint64(1)) * _FACTORS[k]
        h[there] = (K.mix(total) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        out.append(h)
    return out[0], out[1]


def _twice(gram: np.ndarray, flank: np.ndarray) -> np.ndarray:
    """Whether another segment of the same gram has the same flank."""
    order = np.lexsort((flank, gram))
    same = (gram[order][1:] == gram[order][:-1]) & (flank[order][1:] == flank[order][:-1])
    out = np.empty(len(order), bool)
    out[order] = np.r_[False, same] | np.r_[same, False] if len(order) else False
    return out & (flank != 0)


def _owners(rows: pa.Table) -> pa.Table:
    """For each (gram, segment) of each slab: whether a smaller document has the same segment, else whether another segment of its gram has the
    same flank and may share a window with it."""
    gram, sizes = _joined(rows["gram"], np.uint64)
    segment, first = _joined(rows["segment"], np.uint64)[0], _joined(rows["first"], np.int64)[0]
    left, right = _joined(rows["left"], np.uint32)[0], _joined(rows["right"], np.uint32)[0]
    order = np.lexsort((first, segment, gram))
    g, s, f = gram[order], segment[order], first[order]
    new_g = np.r_[True, g[1:] != g[:-1]]
    new_s = new_g | np.r_[True, s[1:] != s[:-1]]
    of = np.cumsum(new_s) - 1
    shared = _twice(g[new_s], left[order][new_s]) | _twice(g[new_s], right[order][new_s])
    answer = np.where(f > f[new_s][of], LATER, np.where(shared[of], CONTESTED, OWNER)).astype(np.uint8)
    out = np.empty(len(order), np.uint8)
    out[order] = answer
    return pa.table({"slab": rows["slab"], "bucket": rows["bucket"], "kind": pa.array(np.ones(len(rows), np.int32)),
                     "classes": _cut(out, np.r_[0, np.cumsum(sizes)[:-1]])})


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans as one, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, s[1:] > e[:-1]]
    return s[new], e[np.r_[new[1:], True]]


def _span_rows(slab: np.ndarray, rid: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """One row (slab, rid, spans) for each document row, spans merged, as pairs of 64-bit numbers."""
    order = np.lexsort((rid, slab))
    slab, rid, start, end = slab[order], rid[order], start[order], end[order]
    at = np.flatnonzero(np.r_[True, (rid[1:] != rid[:-1]) | (slab[1:] != slab[:-1])]) if len(rid) else np.zeros(0, np.int64)
    spans = [np.column_stack(merged(s, e)).astype(np.int64).tobytes() for s, e in zip(np.split(start, at[1:]), np.split(end, at[1:]))] if len(at) else []
    return pa.table({"slab": pa.array(slab[at], pa.int64()), "rid": pa.array(rid[at], pa.int64()), "spans": pa.array(spans, pa.binary())})


ROW = 112  # bytes of a segment's row; the gram begins at AT, a multiple of BLOCK
AT, BLOCK = 48, 16


def repeated_windows(segments: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, column) of the windows that a segment of a smaller document holds too.

    ``segments`` has a row of ROW bytes for each, filled from column ``begin`` to ``end`` and zero elsewhere. The suffix array is over
    blocks of BLOCK bytes; a window is looked up at the first block that begins in it, and by the bytes before that block.
    """
    many, half = len(segments), BLOCK // 8
    words = np.zeros((many, ROW // 8 + 8), np.uint64)
    words[:, : ROW // 8] = np.ascontiguousarray(segments).view(">u8").astype(np.uint64)
    low, high = (begin + BLOCK - 1) // BLOCK, (end + BLOCK - 1) // BLOCK
    count = high - low
    text_at = np.r_[0, np.cumsum(count + 1)[:-1]]
    seg = np.repeat(np.arange(many), count)
    block = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count) + low[seg]
    spot = text_at[seg] + block - low[seg]
    left, right = words[seg, half * block], words[seg, half * block + 1]
    order = np.lexsort((right, left))
    new = np.r_[True, (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])]
    symbols = np.ones(int((count + 1).sum()) + 1, np.int64)  # 1 ends a segment, 0 the whole
    symbols[-1] = 0
    symbols[spot[order]] = np.cumsum(new) + 1
    order = np.array(suffix_array(symbols.tolist()))
    of = np.full(len(symbols), -1)
    of[spot] = np.arange(len(spot))
    order = of[order]
    order = order[order >= 0]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    a, b = order[:-1], order[1:]
    same, still = np.zeros(len(a), np.int64), np.ones(len(a), bool)
    for k in range(7):
        differ = words[seg[a], half * block[a] + k] ^ words[seg[b], half * block[b] + k]
        bits = np.zeros(len(a), np.int64)
        for shift in (56, 48, 40, 32, 24, 16, 8, 0):
            bits += (differ >> np.uint64(shift)) == 0
        same += np.where(still, bits, 0)
        still &= differ == 0
    same = np.minimum(same, np.minimum(end[seg[a]] - BLOCK * block[a], end[seg[b]] - BLOCK * block[b]))
    found_seg, found_col = [], []
    windows = end - begin - WINDOW + 1
    w_seg = np.repeat(np.arange(many), windows)
    w_col = np.arange(len(w_seg)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[w_seg]
    slot = np.full((many, ROW // BLOCK + 4), -1)
    slot[seg, block] = np.arange(len(seg))
    for lead in range(BLOCK):
        mine = np.flatnonzero((-w_col) % BLOCK == lead)
        r, c = w_seg[mine], w_col[mine]
        at = (c + lead) // BLOCK
        run = np.r_[0, np.cumsum(same < WINDOW - lead)]
        key = run[rank[slot[r, at]]]
        near = words[r, np.maximum(half * at - 1, 0)] & np.uint64((1 << (8 * min(lead, 8))) - 1)
        far = words[r, np.maximum(half * at - 2, 0)] & np.uint64((1 << (8 * max(lead - 8, 0))) - 1)
        o = np.lexsort((first[r], far, near, key))
        k, x, y = key[o], near[o], far[o]
        new = np.r_[True, (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if len(o) else np.zeros(0, bool)
        least = first[r][o][new][np.cumsum(new) - 1]
        hit = o[first[r][o] > least]
        found_seg.append(r[hit]), found_col.append(c[hit])
    return np.concatenate(found_seg), np.concatenate(found_col)


def _compare(rows: pa.Table) -> pa.Table:
    """Spans of one bucket of contested segments."""
    gram, sizes = _joined(rows["gram"], np.uint64)
    segment, first = _joined(rows["segment"], np.uint64)[0], _joined(rows["first"], np.int64)[0]
    rid, start = _joined(rows["rid"], np.int64)[0], _joined(rows["start"], np.int64)[0]
    lead, length = _joined(rows["lead"], np.int64)[0], _joined(rows["length"], np.int64)[0]
    slab = np.repeat(np.array(rows["slab"].to_pylist(), np.int64), sizes)
    data = np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8)
    byte_at = np.cumsum(length) - length
    order = np.lexsort((first, segment, gram))
    new = np.r_[True, (gram[order][1:] != gram[order][:-1]) | (segment[order][1:] != segment[order][:-1])]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    one = order[new]
    begin, end = AT - lead[one], AT - lead[one] + length[one]
    held = np.zeros((len(one), ROW), np.uint8)
    held[np.repeat(np.arange(len(one)), length[one]), np.concatenate([np.arange(x, y) for x, y in zip(begin, end)])] = np.concatenate(
        [data[x: x + n] for x, n in zip(byte_at[one], length[one])])
    seg, col = repeated_windows(held, begin, end, first[one])
    by = np.argsort(seg, kind="stable")
    seg, offset = seg[by], (col - begin[seg])[by]
    spots = np.argsort(number, kind="stable")  # occurrences by segment
    left, right = np.searchsorted(number[spots], seg, "left"), np.searchsorted(number[spots], seg, "right")
    many = right - left
    spot = spots[np.repeat(left, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)]
    at = start[spot] + np.repeat(offset, many)
    return _span_rows(slab[spot], rid[spot], at, at + WINDOW)


PACKED = "slab long, bucket long, gram binary, segment binary, first binary, left binary, right binary"
CANDIDATES = "slab long, rid long, spans binary, bucket long, gram binary, segment binary, first binary, start binary, lead binary, length binary, bytes binary, first_rid binary"


def _crowded_windows(slabs: DataFrame, answers: DataFrame, buckets: int, crowded: int) -> DataFrame:
    """(slab, rid, spans) from windows as rows: of each content, those in other than the smallest document."""
    def windows(rows: pa.Table, told: pa.Table) -> pa.Table:
        slab = rows["slab"][0].as_py() if len(rows) else 0
        rows, a = _shared_anchors(rows, told, buckets, crowded, 256)
        buf, off = K.text_buffer(rows["text"])
        many = a["length"] - WINDOW + 1
        row = np.repeat(a["row"], many)
        start = np.repeat(a["start"], many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        at = off[row] + start
        left, right = K.span_hashes(buf, at, at + WINDOW), K.span_hashes(buf, at + 1, at + WINDOW)  # two hashes of the same bytes
        doc, rid = (np.array(rows[c].to_pylist(), np.int64)[row] for c in ("doc_id", "rid"))
        return pa.table({"slab": pa.array(np.full(len(row), slab, np.int64)), "rid": pa.array(rid), "doc": pa.array(doc), "start": pa.array(start, pa.int64()),
                         "x": pa.array(left.astype(np.int64)), "y": pa.array(K.mix(right + left).astype(np.int64))})

    def pack(batches):
        for b in batches:
            start = b["start"].to_numpy()
            yield from _span_rows(b["slab"].to_numpy(), b["rid"].to_numpy(), start, start + WINDOW).to_batches()

    rows = slabs.select("slab", "doc_id", "rid", "text").groupBy("slab").cogroup(answers.groupBy("slab")).applyInArrow(
        windows, "slab long, rid long, doc long, start long, x long, y long")
    rows = stored(rows, "windows")
    least = rows.groupBy("x", "y").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("most > least")
    return rows.join(least, ["x", "y"]).where("doc > least").select("slab", "rid", "start").mapInArrow(pack, "slab long, rid long, spans binary")


def removal_spans(slabs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(slab, rid, spans): merged byte spans to remove from rows of a slab table; a row may have several of them."""
    buckets, few = S.key_buckets(slabs, 18.0), S.key_buckets(slabs, 18.0, 200_000)
    texts = slabs.select("slab", "doc_id", "rid", "text")
    answers = stored(S.shared_keys(slabs, _grams_of, buckets).withColumn("kind", F.lit(0)), "grams")
    top = answers.agg(F.max("top")).first()[0] or 0
    answers = answers.drop("top")

    def local(rows: pa.Table, told: pa.Table):
        told = told.to_pandas()
        grams = pa.table({"bucket": told.loc[told.kind == 0, "bucket"].to_numpy(), "classes": pa.array(told.loc[told.kind == 0, "classes"].tolist(), pa.binary())})
        rows, a = _shared_anchors(rows, grams, buckets, 1, crowded)
        doc = np.array(rows["doc_id"].to_pylist(), np.int64)[a["row"]]
        return rows, a, doc, *_segments(doc, a), told[told.kind == 1]

    def send(rows: pa.Table, told: pa.Table) -> pa.Table:
        slab = rows["slab"][0].as_py() if len(rows) else 0
        rows, a, doc, one, first, _, _ = local(rows, told)
        order, used, at = _by_bucket(a["gram"][one], few)
        buf, off = K.text_buffer(rows["text"])
        left, right = _flanks(buf, off[a["row"][one]] + a["start"][one] + a["lead"][one], a["lead"][one], a["length"][one])
        return pa.table({"slab": pa.array(np.full(len(used), slab, np.int64)), "bucket": pa.array(used), **{n: _cut(v[order], at) for n, v in (
            ("gram", a["gram"][one]), ("segment", a["segment"][one]), ("first", first), ("left", left), ("right", right))}})

    def decide(rows: pa.Table, told: pa.Table) -> pa.Table:
        slab = rows["slab"][0].as_py() if len(rows) else 0
        rows, a, doc, one, first, number, owned = local(rows, told)
        order, used, at = _by_bucket(a["gram"][one], few)
        state = np.zeros(len(one), np.uint8)
        state[order] = np.frombuffer(b"".join(owned.sort_values("bucket")["classes"]), np.uint8)
        rid = np.array(rows["rid"].to_pylist(), np.int64)
        gone = (state[number] == LATER) | (doc > first[number])
        r = a["row"][gone]
        spans = _span_rows(np.full(len(r), slab, np.int64), rid[r], a["start"][gone], a["start"][gone] + a["length"][gone])
        open_ = np.flatnonzero((state[number] == CONTESTED) & (doc == first[number]))
        order, used, at = _by_bucket(a["gram"][open_], few)
        pick = open_[order]
        buf, off = K.text_buffer(rows["text"])
        begin = off[a["row"][pick]] + a["start"][pick]
        raw = [b"".join(buf[x: x + n].tobytes() for x, n in zip(xs, ns)) for xs, ns in zip(np.split(begin, at[1:]), np.split(a["length"][pick], at[1:]))] if len(at) else []
        values = {"gram": a["gram"], "segment": a["segment"], "first": doc, "start": a["start"], "lead": a["lead"], "length": a["length"]}
        rest = pa.table({"slab": pa.array(np.full(len(used), slab, np.int64)), "bucket": pa.array(used), "bytes": pa.array(raw, pa.binary()),
                         "first_rid": _cut(rid[a["row"][pick]], at), **{n: _cut(v[pick], at) for n, v in values.items()}})
        return _candidates(spans, rest)

    pairs = texts.groupBy("slab").cogroup(answers.groupBy("slab")).applyInArrow(send, PACKED)
    owned = pairs.groupBy("bucket").applyInArrow(_owners, "slab long, bucket long, kind int, classes binary")
    told = answers.unionByName(owned)
    found = stored(texts.groupBy("slab").cogroup(told.groupBy("slab")).applyInArrow(decide, CANDIDATES), "found")
    contested = found.where(F.col("bucket").isNotNull()).select(
        "slab", "bucket", "gram", "segment", "first", F.col("first_rid").alias("rid"), "start", "lead", "length", "bytes")
    late = contested.groupBy("bucket").applyInArrow(_compare, "slab long, rid long, spans binary")
    out = found.where(F.col("bucket").isNull()).select("slab", "rid", "spans").unionByName(late)
    return out.unionByName(_crowded_windows(slabs, answers, buckets, crowded)) if top >= crowded else out


def _candidates(spans: pa.Table, rest: pa.Table) -> pa.Table:
    schema = pa.schema([(n, pa.int64() if n in ("slab", "rid", "bucket") else pa.binary()) for n in (
        "slab", "rid", "spans", "bucket", "gram", "segment", "first", "start", "lead", "length", "bytes", "first_rid")])
    def wide(t: pa.Table) -> pa.Table:
        return pa.table({f.name: t[f.name].cast(f.type) if f.name in t.column_names else pa.nulls(len(t), f.type) for f in schema}, schema=schema)
    return pa.concat_tables([wide(spans), wide(rest)])


def _slabs_cut(docs: DataFrame, finish: Callable[[pa.Table], pa.Table], schema: Callable[[list[T.StructField]], T.StructType],
                crowded: int = CROWDED) -> DataFrame:
    """What ``finish`` makes of each slab's rows, in the same task: doc_id, ``kept``, n_bytes, n_removed, n_spans and the other columns as ``own_<number>``.

    ``schema`` gives its columns from the fields of doc_id and of the other columns. One Python worker a task does both: a second pass would hold another.
    """
    slabs = S.slab_table(docs.select(*[K.quoted(c).alias(n) for c, n in zip(docs.columns, _plain(docs))]), S.new_name())
    fields = [f for f in slabs.schema.fields if f.name not in ("slab", "rid", "n_bytes", "text")]
    others = [f.name for f in fields]
    spans = removal_spans(slabs, crowded)

    def cut(rows: pa.Table, told: pa.Table) -> pa.Table:
        by_rid: dict[int, list[bytes]] = {}
        for r, s in zip(told["rid"].to_pylist(), told["spans"].to_pylist()):
            by_rid.setdefault(r, []).append(s)
        buf, off = K.text_buffer(rows["text"])
        kept, removed, runs = [], [], []
        for i, (r, there) in enumerate(zip(rows["rid"].to_pylist(), rows["text"].is_valid().to_pylist())):
            text = buf[off[i]: off[i + 1]]
            pairs = np.frombuffer(b"".join(by_rid.get(r, [])), np.int64).reshape(-1, 2)
            s, e = merged(pairs[:, 0], pairs[:, 1])
            edges = np.r_[0, np.column_stack([s, e]).ravel(), len(text)]
            kept.append(b"".join(text[x:y].tobytes() for x, y in zip(edges[::2], edges[1::2])) if there else None)
            removed.append(int((e - s).sum())), runs.append(len(s))
        out = rows.select(others).append_column("kept", pa.array(kept, pa.binary()))
        out = out.append_column("n_bytes", pa.array(np.diff(off), pa.int64()))
        out = out.append_column("n_removed", pa.array(removed, pa.int64())).append_column("n_spans", pa.array(runs, pa.int64()))
        return finish(out)

    return slabs.drop("n_bytes").groupBy("slab").cogroup(spans.groupBy("slab")).applyInArrow(cut, schema(fields))


def _plain(docs: DataFrame) -> list[str]:
    """Names under which the columns of ``docs`` travel."""
    return [c if c in ("doc_id", "text") else f"own_{i}" for i, c in enumerate(docs.columns)]


def kept_bytes(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Columns of ``docs`` but doc_id and text as ``own_<number>``, doc_id, ``kept`` (binary, null for a null text), n_bytes, n_removed, n_spans."""
    added = T.StructType.fromDDL("kept binary, n_bytes long, n_removed long, n_spans long").fields
    return _slabs_cut(docs, lambda rows: rows, lambda fields: T.StructType([*fields, *added]), crowded)


def dedup(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    return kept_bytes(docs.select("doc_id", "text"), crowded).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the cut texts; bytes of characters cut in two are dropped, n_chars follows where it is a whole number."""
    names, plain = docs.columns, _plain(docs)

    def finish(rows: pa.Table) -> pa.Table:
        texts = [None if x is None else x.decode("utf-8", "ignore") for x in rows["kept"].to_pylist()]
        columns = [pa.array(texts, pa.string()) if n == "text" else rows[n] for n in plain]
        if "n_chars" in names and pa.types.is_integer(columns[names.index("n_chars")].type):
            k = names.index("n_chars")
            columns[k] = pa.array([None if x is None else len(x) for x in texts], columns[k].type)
        return pa.table(columns, names=plain)

    out = _slabs_cut(docs, finish, lambda _: T.StructType([T.StructField(n, f.dataType) for n, f in zip(plain, docs.schema.fields)]))
    return out.select(*[F.col(n).alias(c) for n, c in zip(plain, names)])
