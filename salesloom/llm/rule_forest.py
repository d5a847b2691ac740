"""Quality rules: an isolation forest on rule statistics, its threshold calibrated on labelled rows.

The base rules reject texts of under 50 words and texts in which over half of the words lie in repeated 3-word windows. Of the rest, documents
that random splits isolate after short paths are anomalous. The trees share out all documents that pass the base rules: each document goes to one
tree at least, to several where the trees would have too few. Trees grow a level at a time, from the number of rows and the ranges of the statistics in
each node, which are counted over all rows. The threshold is chosen among the scores of all labelled documents that pass: the score
that at most a small share of the good ones exceeds. Nothing is sampled; texts are read once, later passes read the counts.

Null texts have no words and fail the base rules, as do empty ones. Repeated rows are judged alike. Without labelled rows of both kinds no document is
anomalous. Words are runs of bytes other than blanks; repeats are told by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm.components import stored
from salesloom.plans.ordered import running_totals

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LINE_END = np.zeros(256, bool)
LINE_END[10] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
MARKS = np.zeros(256, bool)
MARKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_upper"]
#: Counts that go out with each row; the others serve the forest.
SHOWN = COUNTS[:5]


def rule_counts(texts: pa.Array) -> np.ndarray:
    """One row of COUNTS for each text; marks are visible ASCII characters but letters and digits, upper is A-Z."""
    out = [np.zeros((0, len(COUNTS)), np.int64)]
    for at, to, buf, off in K.pieces(texts):
        rows = to - at
        doc_of = np.repeat(np.arange(rows), np.diff(off))
        s, e, d = K.find_words(buf, off, K.SPACE)
        n = np.bincount(d, minlength=rows)
        chars = np.bincount(doc_of, weights=((buf & 0xC0) != 0x80) & ~K.SPACE[buf], minlength=rows)
        symbols, marks, upper = (np.bincount(doc_of, weights=t[buf], minlength=rows) for t in (SYMBOLS, MARKS, UPPER))
        h = K.span_hashes(buf, s, e)
        three = K.chained(h, 3)
        full = np.flatnonzero(d[: len(three)] == d[2:]) if len(three) else np.zeros(0, np.int64)
        order = np.lexsort((three[full], d[full]))
        g, gd = three[full][order], d[full][order]
        new = np.r_[True, (g[1:] != g[:-1]) | (gd[1:] != gd[:-1])] if len(g) else np.zeros(0, bool)
        many = np.diff(np.r_[np.flatnonzero(new), len(g)])[np.cumsum(new) - 1] > 1 if len(g) else np.zeros(0, bool)
        begin = full[order][many]
        repeated = np.zeros(len(d) + 2, bool)
        for k in range(3):
            repeated[begin + k] = True
        repeats = np.bincount(d, weights=repeated[: len(d)], minlength=rows)
        ls, le, ld = K.find_words(buf, off, LINE_END)
        worded = np.searchsorted(s, le, "left") > np.searchsorted(s, ls, "left")
        ls, le, ld = ls[worded], le[worded], ld[worded]
        lh = K.span_hashes(buf, ls, le)
        order = np.lexsort((lh, ld))
        same = (lh[order][1:] == lh[order][:-1]) & (ld[order][1:] == ld[order][:-1])
        dup = np.bincount(ld[order][1:][same], minlength=rows)
        out.append(np.column_stack([n, chars, symbols, dup, repeats, marks, upper]).astype(np.int64))
    return np.concatenate(out)


def features(counts: np.ndarray) -> np.ndarray:
    """Rule statistics that the forest splits on: symbols, marks and upper-case letters as shares of the characters in words.

    Length and repeats are left to the base rules; good texts vary in them, which hides the odd ones.
    """
    _, chars, symbols, _, _, marks, upper = counts.T.astype(float)
    return np.column_stack([symbols, marks, upper]) / np.maximum(chars, 1)[:, None]


def base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeats = counts[:, 0], counts[:, 4]
    return (n < 50) | (100 * repeats > 50 * n)


def _usual(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of ``n`` rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees in one complete binary layout: node ``i`` has the children ``2i + 1`` and ``2i + 2``; leaves hold path lengths."""

    feature: np.ndarray
    limit: np.ndarray
    length: np.ndarray
    rows: float  # of a tree, in the mean

    def score(self, x: np.ndarray) -> np.ndarray:
        """Near 1: isolated after short paths; about 0.5 and less: like the others."""
        if not len(self.feature):
            return np.zeros(len(x))
        depth = int(np.log2(self.length.shape[1]))
        total, row = np.zeros(len(x)), np.arange(len(x))
        for feature, limit, length in zip(self.feature, self.limit, self.length):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, feature[node]] > limit[node])
            total += length[node - (len(length) - 1)]
        return 2.0 ** (-total / len(self.feature) / max(float(_usual(self.rows)), 1e-9))


class Growth:
    """A forest that grows a level at a time, from what its nodes hold of ``rows`` rows.

    Every row goes to one of ``trees`` trees, or to as many as it takes for about ``least`` rows a tree; its key chooses which.
    """

    def __init__(self, rows: int, trees: int = 100, least: int = 256, seed: int = 7):
        trees = trees if rows else 0
        self.depth = max(1, int(np.ceil(np.log2(max(min(least, rows), 2)))))
        self.shares = min(trees, max(1, -(-least * trees // max(rows, 1))))
        self.seed = seed
        inner = 2 ** self.depth - 1
        self.forest = IsolationForest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)),
                                      rows * self.shares / max(trees, 1))

    def dealt(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and tree of every share that the keys' rows have."""
        trees, row = len(self.forest.feature), np.arange(len(keys))
        salt = K.mix(np.arange(1, trees + 1, dtype=np.uint64) + K.U64(self.seed << 32))
        if self.shares == 1:
            return row, (K.mix(keys ^ salt[0]) % K.U64(trees)).astype(np.int64)
        chosen = np.argsort(K.mix(keys[:, None] ^ salt), axis=1, kind="stable")[:, :self.shares]
        return np.repeat(row, self.shares), chosen.ravel()

    def reached(self, x: np.ndarray, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, tree and node of the shares that come down to ``level``."""
        row, tree = self.dealt(keys)
        node = np.zeros(len(row), np.int64)
        for _ in range(level):
            go = np.isfinite(self.forest.limit[tree, node])
            row, tree, node = row[go], tree[go], node[go]
            node = 2 * node + 1 + (x[row, self.forest.feature[tree, node]] > self.forest.limit[tree, node])
        return row, tree, node

    def split(self, level: int, tree: np.ndarray, node: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Cut the nodes of ``level`` at random within the ranges of their rows; those of the last level or without a range are leaves."""
        inner = self.forest.feature.shape[1]
        for t, i, n, a, b in zip(tree, node, rows, low, high):
            wide = np.flatnonzero(b > a)
            if level == self.depth or not len(wide):
                last = (i + 1) * 2 ** (self.depth - level) - 1 - inner  # leftmost leaf below: rows that stop here go left
                self.forest.length[t, last: last + 2 ** (self.depth - level)] = level + float(_usual(n))
                continue
            rng = np.random.default_rng([self.seed, t, i])
            j = rng.choice(wide)
            self.forest.feature[t, i] = j
            self.forest.limit[t, i] = min(rng.uniform(a[j], b[j]), np.nextafter(b[j], a[j]))


def grow(x: np.ndarray, trees: int = 100, rows: int = 256, seed: int = 7, keys: np.ndarray | None = None) -> IsolationForest:
    """The forest of rows at hand, as grown() makes it of a table."""
    growth = Growth(len(x), trees, rows, seed)
    keys = np.arange(len(x), dtype=np.uint64) if keys is None else keys
    for level in range(growth.depth + 1 if len(x) else 0):
        row, tree, node = growth.reached(x, keys, level)
        if not len(row):
            break
        order = np.lexsort((node, tree))
        row, tree, node = row[order], tree[order], node[order]
        first = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])])
        growth.split(level, tree[first], node[first], np.diff(np.r_[first, len(row)]),
                     np.minimum.reduceat(x[row], first), np.maximum.reduceat(x[row], first))
    return growth.forest


def _counts(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.column_stack([rows[c].to_numpy() for c in COUNTS]).astype(np.int64).reshape(-1, len(COUNTS))


def grown(passed: DataFrame) -> IsolationForest:
    """The forest of all rows of ``passed`` (doc_id and COUNTS).

    One pass a level. At most one row a node comes to the driver, and the number of nodes is fixed by the trees and their depth.
    """
    growth = Growth(passed.count())
    if not len(growth.forest.feature):
        return growth.forest
    x = [f"x{j}" for j in range(features(np.zeros((0, len(COUNTS)))).shape[1])]
    keyed = passed.select(*COUNTS, F.xxhash64("doc_id", *COUNTS).alias("key"))
    for level in range(growth.depth + 1):
        def nodes(batches):
            for b in batches:
                own = features(_counts(b))
                row, tree, node = growth.reached(own, b["key"].to_numpy().view(np.uint64), level)
                yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(node), *map(pa.array, own[row].T)], ["tree", "node", *x])

        got = keyed.mapInArrow(nodes, ", ".join(["tree long, node long", *[f"{c} double" for c in x]])).groupBy("tree", "node").agg(
            F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{name}_{c}") for name, f in (("low", F.min), ("high", F.max)) for c in x]).toArrow()
        if not len(got):
            break
        growth.split(level, *[got[c].to_numpy() for c in ("tree", "node", "rows")],
                     *[np.column_stack([got[f"{name}_{c}"].to_numpy() for c in x]) for name in ("low", "high")])
    return growth.forest


def calibrated(forest: IsolationForest, x: np.ndarray, good: np.ndarray, lose: float = 0.02) -> float:
    """The score above which the shares of good and other rows differ most, among scores that at most the share ``lose`` of the good exceeds.

    2, which no score exceeds, without rows of both kinds. For rows at hand, as threshold() makes it of a table.
    """
    if not good.any() or good.all():
        return 2.0
    s = forest.score(x)
    least = np.quantile(s[good], 1 - lose, method="higher")
    cuts = np.unique(s[s >= least])
    above = [len(v) - np.searchsorted(np.sort(v), cuts, "right") for v in (s[good], s[~good])]
    best = int(np.argmax(above[1] / (~good).sum() - above[0] / good.sum()))
    return float((cuts[best] + (cuts[best + 1] if best + 1 < len(cuts) else cuts[best])) / 2)


def threshold(scores: DataFrame, lose: float = 0.02) -> float:
    """calibrated() over all rows (anomaly, label): running totals over the distinct scores tell how many of each kind lie above each."""
    values = scores.groupBy("anomaly").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") != 1).alias("other"))
    upto = running_totals(values, ["anomaly"], {"n_good": F.col("good"), "n_other": F.col("other")}, following={"higher": "anomaly"}, overall="_all")
    good_above, other_above = (F.col(f"{n}_all") - F.col(n) for n in ("n_good", "n_other"))
    best = upto.where(
        (F.col("n_good_all") > 0) & (F.col("n_other_all") > 0) & (good_above <= F.col("n_good_all") - 1 - F.ceil((F.col("n_good_all") - 1) * (1 - lose)))
    ).select("anomaly", "higher", (other_above / F.col("n_other_all") - good_above / F.col("n_good_all")).alias("gap")).orderBy(
        F.col("gap").desc(), "anomaly").first()
    if best is None:
        return 2.0
    return (best["anomaly"] + (best["anomaly"] if best["higher"] is None else best["higher"])) / 2


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the rule counts, base_failed, anomaly and kept of every row.

    The forest comes from all rows, the threshold from all labelled rows, that pass the base rules.
    """
    K.small_batches(docs.sparkSession)

    def measure(batches):
        for b in batches:
            c = rule_counts(b["text"])
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), *map(pa.array, c.T), pa.array(base_failed(c))],
                                             ["doc_id", *COUNTS, "base_failed"])

    kinds = ", ".join(f"{c} long" for c in COUNTS)
    counted = stored(docs.select("doc_id", "text").mapInArrow(measure, f"doc_id long, {kinds}, base_failed boolean"), "rule-counts")
    forest = grown(counted.where("not base_failed"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], *[b[c] for c in SHOWN], b["base_failed"], pa.array(forest.score(features(_counts(b))))],
                                             ["doc_id", *SHOWN, "base_failed", "anomaly"])

    kinds = ", ".join(f"{c} long" for c in SHOWN)
    scored = stored(counted.mapInArrow(run, f"doc_id long, {kinds}, base_failed boolean, anomaly double"), "anomalies")
    most = threshold(scored.where("not base_failed").join(K.known_labels(labels, "quality"), "doc_id"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= most))
