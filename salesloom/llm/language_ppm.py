"""Language ID by partial matching: per-language byte context trees give exact code lengths under frozen statistics.

A language's tree holds counts of each byte after contexts of up to three bytes. A byte that a context has seen gets count / (total + kinds);
an escape with kinds / (total + kinds) leads to the next shorter context, without the bytes that the longer one has seen; below the
empty context all 256 bytes are alike. The language with the shortest code for the whole text wins, ties by name.

Each tree holds every gram of its language's sample, as sorted codes; the distinct grams of a piece of text are looked up in each. Null texts and texts without a letter
are ``und`` with score 0, and so is everything if there is nothing to learn from. The score is the posterior share of the winner.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm import common as K

ORDER = 3
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def coded(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of about ``size`` bytes, long texts in several: the text number of every byte, and its code with the three before it (zeros before a text)."""
    buf, off = K.text_buffer(texts)
    for at in range(0, len(buf), size):
        to = min(at + size, len(buf))
        first, last = np.searchsorted(off, at, "right") - 1, np.searchsorted(off, to, "left")
        place, row = np.arange(at, to), np.repeat(np.arange(first, last), np.diff(np.clip(off[first: last + 1], at, to)))
        back = place - off[row]
        code = buf[place].astype(np.uint32)
        for k in range(1, ORDER + 1):
            code |= np.where(back >= k, buf[np.maximum(place - k, 0)], 0).astype(np.uint32) << np.uint32(8 * k)
        yield row, code


def gram_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every byte with the three before it (zeros before a text) and their counts."""
    found = [np.unique(code, return_counts=True) for _, code in coded(texts)]
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    return codes, np.bincount(at, weights=np.concatenate([n for _, n in found])).astype(np.int64)


def _low(codes: np.ndarray, k: int) -> np.ndarray:
    """The last byte of each code with the ``k`` before it."""
    return codes & np.uint32((1 << 8 * (k + 1)) - 1)


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted ``keys``, and whether they hold what is wanted."""
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


@dataclass
class Tree:
    """Of each order: sorted grams (context and byte) with their code lengths in bits, sorted contexts with the bits of their escapes."""

    grams: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each code."""
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        for k in range(ORDER, -1, -1):
            gram = _low(codes[todo], k)
            place, known = _at(self.grams[k], gram)
            out[todo[known]] += self.bits[k][place[known]]
            todo, gram = todo[~known], gram[~known]
            place, known = _at(self.contexts[k], gram >> np.uint32(8))
            out[todo[known]] += self.escapes[k][place[known]]
        out[todo] += 8
        return out


@dataclass
class Trees:
    languages: list[str]
    trees: list[Tree]

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Code length of each text in bits, for each language."""
        out = np.zeros((len(texts), len(self.trees)))
        for row, code in coded(texts):
            codes, at = np.unique(code, return_inverse=True)
            first = row[0]
            for i, tree in enumerate(self.trees):
                sums = np.bincount(row - first, weights=tree.lengths(codes)[at])
                out[first: first + len(sums), i] += sums
        return out


def _tree(codes: np.ndarray, counts: np.ndarray) -> Tree:
    tree = Tree([], [], [], [])
    shorter = np.full(256, 1 / 256)  # probabilities of the grams one byte shorter
    for k in range(ORDER + 1):
        grams, at = np.unique(_low(codes, k), return_inverse=True)
        n = np.bincount(at, weights=counts)
        contexts, at = np.unique(grams >> np.uint32(8), return_inverse=True)
        kinds, held = np.bincount(at), np.bincount(at, weights=n)
        p = n / (held + kinds)[at]
        below = shorter[np.searchsorted(tree.grams[-1], _low(grams, k - 1))] if k else shorter[grams]
        left = np.maximum(1 - np.bincount(at, weights=below), 1e-12)
        tree.grams.append(grams), tree.bits.append(-np.log2(p).astype(np.float32))
        tree.contexts.append(contexts), tree.escapes.append(-np.log2(kinds / (held + kinds) / left).astype(np.float32))
        shorter = p
    return tree


def grow(grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees of the languages from their gram counts."""
    languages = sorted(grams)
    return Trees(languages, [_tree(grams[x][0].astype(np.uint32), grams[x][1]) for x in languages])


def hash_range(doc_id: str = "doc_id") -> Column:
    """Ranges of the hash of ``doc_id`` in ascending order, each a sixteenth of a power of two, so the first ones are small at any number of rows."""
    hashed = F.xxhash64(doc_id).bitwiseAND(F.lit((1 << 63) - 1))
    size = F.length(F.bin(hashed))
    return (size * 16 + F.call_function("shiftright", hashed, F.greatest(size - 5, F.lit(0))).bitwiseAND(F.lit(15))).cast("int")


def sampled(docs: DataFrame, learn: Column, sample_bytes: int, least_docs: int) -> DataFrame | None:
    """(lang, text as bytes) of the documents to learn from; None without any.

    Each language gives its documents in the order of a hash of doc_id, as many as fit ``sample_bytes`` but ``least_docs`` at least, or all it has.
    One document gives its first ``sample_bytes`` / ``least_docs`` bytes at most (a language of fewer documents: ``sample_bytes`` / their number),
    so no long text takes the place of the others. Whole hash ranges are taken; the one that completes ``least_docs`` may go beyond ``sample_bytes``.
    """
    known = docs.where(learn & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select(
        "lang", F.col("text").cast("binary").alias("text"), hash_range().alias("range"))
    part = max(1, sample_bytes // least_docs)
    ranges = known.groupBy("lang", "range").agg(F.count("*").alias("docs"), F.sum(F.least(F.octet_length("text"), F.lit(part))).alias("bytes")).toPandas()
    limits = []  # one row a language; of the ranges about a thousand a language at most
    for lang, own in ranges.sort_values("range").groupby("lang"):
        total = int(own["docs"].sum())
        if total <= least_docs:
            limits.append((lang, int(own["range"].max()), max(1, sample_bytes // total)))
            continue
        take = (own["bytes"].cumsum() <= sample_bytes) | (own["docs"].cumsum() - own["docs"] < least_docs)
        limits.append((lang, int(own["range"][take].max()), part))
    if not limits:
        return None
    limits = docs.sparkSession.createDataFrame(limits, "lang string, last int, part int")
    return known.join(F.broadcast(limits), "lang").where(F.col("range") <= F.col("last")).select(
        "lang", F.call_function("substring", "text", F.lit(1), F.col("part")).alias("text"))


def fit_on(docs: DataFrame, learn: Column, sample_bytes: int = 2 << 20, least_docs: int = 64) -> Trees | None:
    """Learn every gram of the sampled() documents of each language; None without any. A language brings the driver no more grams than sampled bytes."""
    K.small_batches(docs.sparkSession)
    sample = sampled(docs, learn, sample_bytes, least_docs)
    if sample is None:
        return None

    def count(batches):
        for b in batches:
            for lang in b["lang"].unique().to_pylist():
                codes, n = gram_counts(b["text"].filter(pc.equal(b["lang"], lang)))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)], ["lang", "code", "n"])

    got = sample.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    grams = {}
    for lang, part in got.groupby("lang"):
        part = part.sort_values("code")
        grams[lang] = part["code"].to_numpy().astype(np.uint32), part["n"].to_numpy()
    return grow(grams) if grams else None


def predicted(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``docs`` with lang_pred and score, in place of columns of these names."""
    def make(b: pa.RecordBatch) -> list[pa.Array]:
        names, scores = [UNDETERMINED] * len(b), np.zeros(len(b))
        worded = [i for i, t in enumerate(b["text"].to_pylist()) if t and _LETTER.search(t)]
        if worded and trees is not None:
            length = trees.lengths(b["text"].take(pa.array(worded)))
            best = length.argmin(1)
            share = 1 / np.exp2(np.minimum(0, length.min(1)[:, None] - length)).sum(1)
            for i, k, s in zip(worded, best.tolist(), share.tolist()):
                names[i], scores[i] = trees.languages[k], s
        return [pa.array(names, pa.string()), pa.array(scores)]
    return K.with_added(docs, make, "lang_pred string, score double")


def language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learns from ids whose fold of 4 is not 2."""
    trees = fit_on(docs, K.fold(4) != 2)
    return predicted(docs.select("doc_id", "text"), trees).select("doc_id", K.held_out(4, 2).alias("held_out"), "lang_pred", "score")
