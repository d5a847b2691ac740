"""Toxicity: a logistic classifier over word features whose scores may not change when identity terms are swapped.

Features say whether a text has a word, or a word with a given beginning, lower-cased A-Z. The features, weights and counterfactual
sentences come from a bounded labelled sample: for each sentence with an identity term, the same sentence with each
other term of its group is made, and the squared change of the linear score is part of the loss. All counterfactuals of the sample count: tasks
sum the outer products of their feature changes, so the loss needs a matrix of the features' size, however many there are.

Null and empty texts have no feature and get the base score. Repeated rows are scored alike. Without labels of both classes the model
has no features and scores the smoothed share of label 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm.components import stored

#: Lengths in bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8)

#: Terms that may be swapped for each other in a sentence.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("africans", "europeans", "americans", "asians"), ("immigrants", "natives"), ("disabled", "healthy"), ("old", "young"),
    ("mujeres", "hombres"), ("femmes", "hommes"), ("frauen", "männer"),
)
_SENTENCE = re.compile(r"[.!?\n]+")


@dataclass
class Model:
    """Sorted feature hashes with their weights."""

    features: np.ndarray
    weights: np.ndarray
    base: float

    def score(self, texts: pa.Array) -> np.ndarray:
        total = np.full(len(texts), self.base)
        if len(self.features):
            for doc, feature in present(texts, self.features):
                total += np.bincount(doc, weights=self.weights[feature], minlength=len(texts))
        return K.sigmoid(total)


def _hashes(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hash) of whole words and of each length of beginnings, for runs of texts."""
    for at, _, buf, off in K.pieces(texts):
        buf = K.LOWER[buf]
        s, e, d = K.find_words(buf, off, K.NOT_ALNUM)
        parts = [(d, K.span_hashes(buf, s, e))]
        for n in BEGINNINGS:
            longer = e - s > n
            begin = s[longer]
            parts.append((d[longer], K.mix(K.span_hashes(buf, begin, begin + n) + K.U64(n))))
        yield np.concatenate([x for x, _ in parts]) + at, np.concatenate([h for _, h in parts])


def present(texts: pa.Array, features: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, feature number), once each, for runs of texts."""
    for doc, h in _hashes(texts):
        place = np.minimum(np.searchsorted(features, h), len(features) - 1)
        hit = features[place] == h
        key = np.unique(doc[hit] * len(features) + place[hit])
        yield key // len(features), key % len(features)


def word_hash(word: str) -> np.uint64:
    raw = np.frombuffer(word.encode(), np.uint8)
    return K.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def swapped(text: str, groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS) -> Iterator[tuple[str, str]]:
    """(sentence, sentence with all occurrences of one identity term swapped) of a text, lower-cased."""
    terms = {t: g for g in groups for t in g}
    low = text.lower()
    if not any(t in low for t in terms):
        return
    for sentence in _SENTENCE.split(low):
        words = set(re.findall(r"\w+", sentence))
        for t in sorted(words & terms.keys()):
            for other in terms[t]:
                if other != t:
                    yield sentence, re.sub(rf"\b{re.escape(t)}\b", other, sentence)


def fit(x: np.ndarray, y: np.ndarray, swaps: np.ndarray, ridge: float = 0.1, fairness: float = 10.0, steps: int = 600) -> tuple[np.ndarray, float]:
    """Weights and base of the least logistic loss + ridge + fairness x mean squared change of the counterfactuals.

    ``swaps``: mean over all counterfactuals of the outer product of the feature differences d, as the mean of (d w)^2 is w swaps w.
    A rare class 1 weighs more, by the root of how rare it is, so that it is found where a text has little of it. Accelerated
    gradient steps of a safe length.
    """
    n, width = x.shape
    x = x.astype(np.float32)
    weight = np.where(y == 1, np.sqrt((n - y.sum()) / max(y.sum(), 1)), 1.0)
    top = 0.0
    v = np.ones(width + 1) / np.sqrt(width + 1)
    for _ in range(20):  # largest curvature
        z = weight * (x @ v[:-1].astype(np.float32) + v[-1])
        u = np.r_[x.T @ z.astype(np.float32), z.sum()] / 4 + ridge * np.r_[v[:-1], 0]
        u[:-1] += n * fairness * (swaps @ v[:-1])
        top = np.linalg.norm(u)
        v = u / max(top, 1e-12)
    step = 0.9 / max(top, 1e-9)
    w = ahead = np.zeros(width + 1)
    t = 1.0
    for _ in range(steps):
        r = weight * (K.sigmoid(x @ ahead[:-1].astype(np.float32) + ahead[-1]) - y)
        g = np.r_[x.T @ r.astype(np.float32) + ridge * ahead[:-1] + n * fairness * (swaps @ ahead[:-1]), r.sum()]
        new = ahead - step * g
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return w[:-1], float(w[-1])


def fit_on(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", sample_rows: int = 10_000,
           width: int = 1024, groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS) -> Model:
    """Fit on at most about ``sample_rows`` labelled documents with the ``width`` features that tell the classes apart best."""
    K.small_batches(docs.sparkSession)
    sample = stored(K.labelled_sample(docs, labels, label, learn, sample_rows), "labelled")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = sizes.get(1.0, 0), sizes.get(0.0, 0)
    base = float(np.log((ones + 0.5) / (zeros + 0.5)))
    if not ones or not zeros:
        return Model(np.zeros(0, np.uint64), np.zeros(0), base)

    def count(batches):
        for b in batches:
            y = b["label"].to_numpy()
            for doc, h in _hashes(b["text"]):
                order = np.lexsort((doc, h))
                h, d = h[order], doc[order]
                new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])] if len(h) else np.zeros(0, bool)
                f, at = np.unique(h[new], return_inverse=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(f.astype(np.int64)), pa.array(np.bincount(at, minlength=len(f)).astype(np.int64)),
                    pa.array(np.bincount(at, weights=y[d[new]], minlength=len(f)))], ["feature", "held", "toxic"])

    counted = sample.mapInArrow(count, "feature long, held long, toxic double").groupBy("feature").agg(
        F.sum("held").alias("held"), F.sum("toxic").alias("toxic"))
    share = F.col("held") / (ones + zeros)
    z = (F.col("toxic") / ones - (F.col("held") - F.col("toxic")) / zeros) / F.sqrt(share * (1 - share) + 1e-9)
    best = counted.where("toxic >= 3").orderBy(F.abs(z).desc(), "feature").limit(width).collect()
    identity = np.array([word_hash(t) for g in groups for t in g], np.uint64)
    features = np.unique(np.concatenate([np.array([r["feature"] for r in best], np.int64).astype(np.uint64), identity]))

    def rows(batches):
        for b in batches:
            held = [np.zeros(0, np.int32) for _ in range(len(b))]
            for doc, f in present(b["text"], features):
                for d in np.unique(doc):
                    held[d] = f[doc == d].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([h.tobytes() for h in held], pa.binary()), b["label"]], ["x", "label"])

    def pairs(batches):
        total, n, size = np.zeros((len(features), len(features))), 0, len(features)
        for b in batches:
            both = [p for t in b["text"].to_pylist() if t for p in swapped(t, groups)]
            found = [np.zeros((2, 0), np.int64)] * 2
            for side in range(2):
                found[side] = np.concatenate([np.zeros((2, 0), np.int64), *[np.stack(r) for r in present(pa.array([p[side] for p in both], pa.string()), features)]], 1)
            before, after = (f[0] * size + f[1] for f in found)
            gone, come = np.setdiff1d(before, after), np.setdiff1d(after, before)
            d, k = np.divmod(np.r_[gone, come], size)
            sign = np.r_[np.ones(len(gone)), -np.ones(len(come))]
            order = np.argsort(d, kind="stable")
            d, k, sign = d[order], k[order], sign[order]
            for own in np.split(np.arange(len(d)), np.flatnonzero(d[1:] != d[:-1]) + 1) if len(d) else ():
                total[np.ix_(k[own], k[own])] += np.outer(sign[own], sign[own])
                n += 1
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[i, -1]), pa.array(np.r_[j, -1]), pa.array(np.r_[total[i, j], n])], ["i", "j", "v"])

    got = sorted(((bytes(r["x"]), r["label"]) for r in sample.mapInArrow(rows, "x binary, label double").collect()))
    x = np.zeros((len(got), len(features)), np.float32)
    for i, (held, _) in enumerate(got):
        x[i, np.frombuffer(held, np.int32)] = 1
    swaps, n = np.zeros((len(features), len(features))), 0.0
    for i, j, v in sample.mapInArrow(pairs, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v")).collect():  # at most a row for each two features
        if i < 0:
            n = v
        else:
            swaps[i, j] = v
    weights, base = fit(x, np.array([y for _, y in got]), swaps / max(n, 1))
    return Model(features, weights, base)


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` with score and predicted, in place of columns of these names."""
    def make(b: pa.RecordBatch) -> list[pa.Array]:
        s = model.score(b["text"])
        return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]
    return K.with_added(docs, make, "score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; learns from labelled ids whose fold of 5 is not 0."""
    model = fit_on(docs, labels, K.fold(5) != 0)
    return score(docs.select("doc_id", "text"), model).select("doc_id", K.held_out(5, 0).alias("held_out"), "score", "predicted")
