"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on a bounded labelled sample, flattened into arrays of a complete binary layout and walked for a whole
batch of documents at once. Null and empty texts are scored as texts without a byte.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm import common as K

STATISTICS = [
    "log_bytes", "log_words", "word_bytes", "long_words", "upper", "digits", "symbols", "exclamations", "other_marks",
    "blanks", "beyond_ascii", "entropy", "log_lines", "line_words", "repeated_lines", "distinct_words", "top_word", "repeated_pairs",
]


def _classes() -> np.ndarray:
    """Character class of each byte: upper, digit, symbol, exclamation, other mark, blank, beyond ASCII, the rest."""
    out = np.full(256, 7)
    for b in range(128):
        c = chr(b)
        out[b] = 0 if c.isupper() else 1 if c.isdigit() else 2 if c in "#*$%&|<>" else 3 if c == "!" else 5 if K.SPACE[b] else 7 if c.isalpha() else 4
    out[128:] = 6
    return out


CLASSES = _classes()


def _repeats(key: np.ndarray, doc: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct keys and the largest count of one key."""
    distinct, most = np.zeros(rows), np.zeros(rows)
    if len(key):
        order = np.lexsort((key, doc))
        k, d = key[order], doc[order]
        first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
        distinct = np.bincount(d[first], minlength=rows).astype(float)
        np.maximum.at(most, d[first], np.diff(np.r_[first, len(k)]).astype(float))
    return distinct, most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    out = [np.zeros((0, len(STATISTICS)))]
    for at, to, buf, off in K.pieces(texts):
        rows, size = to - at, np.diff(off)
        doc_of = np.repeat(np.arange(rows), size)
        counts = np.bincount(doc_of * 8 + CLASSES[buf], minlength=rows * 8).reshape(rows, 8)
        share = counts / np.maximum(size, 1)[:, None]
        byte_counts = np.bincount(doc_of * 256 + buf, minlength=rows * 256).reshape(rows, 256)
        p = byte_counts / np.maximum(size, 1)[:, None]
        entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
        starts, ends, doc = K.find_words(buf, off, K.SPACE)
        n_words = np.bincount(doc, minlength=rows)
        length = ends - starts
        letters = np.bincount(doc, weights=length, minlength=rows)
        long_words = np.bincount(doc, weights=length > 20, minlength=rows)
        hashes = K.span_hashes(buf, starts, ends)
        distinct, most = _repeats(hashes, doc, rows)
        pairs = np.flatnonzero(doc[1:] == doc[:-1])
        pair_distinct, _ = _repeats(hashes[pairs] * K.U64(3) + hashes[pairs + 1], doc[pairs], rows)
        n_pairs = np.bincount(doc[pairs], minlength=rows)
        line_end = np.zeros(256, bool)
        line_end[10] = True
        ls, le, line_doc = K.find_words(buf, off, line_end)
        n_lines = np.bincount(line_doc, minlength=rows)
        line_distinct, _ = _repeats(K.span_hashes(buf, ls, le), line_doc, rows)
        w = np.maximum(n_words, 1)
        out.append(np.column_stack([
            np.log1p(size), np.log1p(n_words), letters / w, long_words / w, share[:, 0], share[:, 1], share[:, 2], share[:, 3],
            share[:, 4], share[:, 5], share[:, 6], entropy, np.log1p(n_lines), n_words / np.maximum(n_lines, 1),
            1 - line_distinct / np.maximum(n_lines, 1), distinct / w, most / w, 1 - pair_distinct / np.maximum(n_pairs, 1)]))
    return np.concatenate(out)


@dataclass
class Forest:
    """Trees in one array each: node ``i`` of a tree has the children ``2i + 1`` and ``2i + 2``; leaves hold values."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.leaf.shape[1]))
        total, row = np.full(len(x), self.start), np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, feature[node]] > limit[node])
            total += leaf[node - (len(leaf) - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return K.sigmoid(self.raw(x))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
        ridge: float = 1.0, least: float = 1.0) -> Forest:
    """Boosted logistic trees on binned columns: gradient and curvature histograms give the best cut of each node.

    Without rows, or with one class only, the forest has no tree and scores the smoothed share of the class.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    inner, n_leaves, width = 2 ** depth - 1, 2 ** depth, x.shape[1]
    if len(y) == 0 or len(np.unique(y)) < 2:
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, n_leaves)), start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    flat = binned + np.arange(width) * bins
    raw = np.full(len(y), start)
    features, limits, leaves = [], [], []
    for _ in range(trees):
        p = K.sigmoid(raw)
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            base, many = 2 ** level - 1, 2 ** level
            cell = ((node - base)[:, None] * (width * bins) + flat).ravel()
            hist = [np.bincount(cell, np.repeat(v, width), many * width * bins).reshape(many, width, bins) for v in (g, h)]
            left_g, left_h = (np.cumsum(v, 2) for v in hist)
            all_g, all_h = left_g[..., -1:], left_h[..., -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g ** 2 / (left_h + ridge) + right_g ** 2 / (right_h + ridge) - all_g ** 2 / (all_h + ridge)
            gain[(left_h < least) | (right_h < least)] = 0
            best = gain.reshape(many, -1).argmax(1)
            cut = np.full(many, bins)
            for k in range(many):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-9 and b < len(cuts[j]):
                    feature[base + k], limit[base + k], cut[k] = j, cuts[j][b], b
            here = node - base
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[here])
        place = node - inner
        value = -rate * np.bincount(place, g, n_leaves) / (np.bincount(place, h, n_leaves) + ridge)
        raw += value[place]
        features.append(feature), limits.append(limit), leaves.append(value)
    return Forest(np.array(features), np.array(limits), np.array(leaves), start)


def fit_on(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", sample_rows: int = 20_000) -> Forest:
    """Fit on at most about ``sample_rows`` labelled documents; only their statistics reach the driver."""
    K.small_batches(docs.sparkSession)

    def measure(batches):
        for b in batches:
            x = statistics(b["text"])
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())), b["label"]], ["x", "label"])

    rows = K.labelled_sample(docs, labels, label, learn, sample_rows).mapInArrow(measure, "x array<double>, label double").toArrow()
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, len(STATISTICS))
    y = np.array(rows["label"].to_pylist(), float)
    order = np.lexsort((*x.T, y))  # the same forest however the rows arrive
    return fit(x[order], y[order])


def score(docs: DataFrame, forest: Forest, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score and predicted, in place of columns of these names."""
    def make(b: pa.RecordBatch) -> list[pa.Array]:
        s = forest.score(statistics(b["text"]))
        return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]
    return K.with_added(docs, make, "score double, predicted int")


def accepted(docs: DataFrame, forest: Forest, threshold: float = 0.7) -> DataFrame:
    """Rows of ``docs``, all columns as they are, that score ``threshold`` or more."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(forest.score(statistics(b["text"])) >= threshold))
    return K.map_rows(docs, run, docs.schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; rows with a null doc_id are scored and never held out.

    Learns from labelled ids whose fold is not 2. Repeated rows get the same score; an empty table gives no rows.
    """
    forest = fit_on(docs, labels, K.fold(4) != 2)
    return score(docs.select("doc_id", "text"), forest).select("doc_id", K.held_out(4, 2).alias("held_out"), "score", "predicted")
