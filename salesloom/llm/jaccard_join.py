"""N-gram Jaccard join: documents whose sets of word n-grams have at least a given similarity, as components of links.

Width and similarity are parameters, 4 words and 0.85 if not given. Tokens are 64-bit hashes of the n-grams. A first exchange tells each token's class, the binary order of its count; class 0 is held once
and can't be shared. All global token orders put lower classes first and differ in how they order a class. A document whose
tokens of class 0 exceed what the similarity allows has no partner. Of the others, one document for each distinct set goes on, and a second exchange
tells the classes among these. Candidates share a token in their prefixes of the first order, must also share one under each further
order, and are then verified on the whole sets.

Within the documents of a prefix token not all pairs are candidates. Where they are many, all meet the one with the fewest unshared tokens, the
centre. What a document shares with the centre bounds what it shares with any other: documents that no other can be similar to leave, and
so do tokens whose documents are in one component. Of the rest, each token takes a new centre, of the largest component, a few times, and what is left
meets where components differ and the bound allows a link. For that, a bitmap tells which of the centre's tokens each document lacks. So a group of copies takes as many comparisons a
round as it has members, and no link between components is missed.

Null texts and texts without words have an empty set and no link. Rows with a null doc_id have no component. Rows of the same
doc_id are one node. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm import slabs as S
from salesloom.llm.components import components, stored

#: Words of a shingle, and hundredths of similarity of a link, if not given.
SHINGLE, LEAST = 4, 85
#: A link: PART * size of the intersection >= least * size of the union.
PART = 100
#: The documents of a prefix token compare all pairs if they are at most so many.
FEW = 12
#: Further rounds of centres at most, and the pairs an open entry at which the rest meets directly.
ROUNDS, SPARSE = 2, 4
#: Words of a bitmap that says which of its centre's tokens a document lacks; tokens beyond its bits share them.
WORDS = 8
LACKS = [f"lack_{k}" for k in range(WORDS)]
#: Tokens in a slab of the second exchange.
SLAB_TOKENS = 500_000
ORDERS = 3


def shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, in that order."""
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at, to, buf, off in K.pieces(texts):
        buf = K.LOWER[buf]
        starts, ends, doc = K.find_words(buf, off, K.SPACE)
        h = K.span_hashes(buf, starts, ends)
        count = np.bincount(doc, minlength=to - at)
        full = np.flatnonzero(doc[: len(doc) - width + 1] == doc[width - 1:]) if len(doc) >= width else np.zeros(0, np.int64)
        d, s = [doc[full]], [K.chained(h, width)[full]]
        begin = np.cumsum(count) - count
        for n in range(1, width):
            short = np.flatnonzero(count == n)
            if len(short):
                d.append(short)
                s.append(K.mix(K.chained(h, n)[begin[short]] + K.U64(n)))
        d, s = np.concatenate(d), np.concatenate(s)
        order = np.lexsort((s, d))
        d, s = d[order], s[order]
        new = np.r_[True, (d[1:] != d[:-1]) | (s[1:] != s[:-1])] if len(d) else np.zeros(0, bool)
        rows.append(d[new] + at)
        hashes.append(s[new])
    return np.concatenate(rows), np.concatenate(hashes)


def prefix_length(n: int | np.ndarray, least: int = LEAST) -> int | np.ndarray:
    """Tokens of the prefix of a set of ``n``: any partner holds one of them."""
    return n - (least * n + PART - 1) // PART + 1


def in_order(tokens: np.ndarray, classes: np.ndarray, k: int) -> np.ndarray:
    """Tokens by the ``k``-th global order."""
    key = tokens
    for _ in range(k):
        key = K.mix(key + K.U64(k))
    return tokens[np.lexsort((key, classes))]


SETS = "rid long, doc_id long, n long, m long, key_a long, key_b long, tokens binary, classes binary"


def _classed(tokens: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of class 1 and more by the first global order, with their classes."""
    t, c = tokens[classes > 0], classes[classes > 0]
    order = np.lexsort((t, c))
    return t[order], c[order]


def sets(slabs: DataFrame, width: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """The set size ``n`` of each row; of those that can have a partner also the ``m`` shared tokens and a key of the set."""
    buckets = S.key_buckets(slabs, 7.0)

    def keys_of(rows: pa.Table) -> np.ndarray:
        return S.at_most_twice(shingles(rows["text"], width)[1])

    def measure(rows: pa.Table, told: pa.Table) -> pa.Table:
        doc, tokens = shingles(rows["text"], width)
        keys = S.at_most_twice(tokens)
        classes = S.unpack(keys, buckets, told) if len(keys) else np.zeros(0, np.uint8)
        cls = classes[np.searchsorted(keys, tokens)] if len(keys) else classes
        n = np.bincount(doc, minlength=len(rows))
        m = np.bincount(doc, weights=cls > 0, minlength=len(rows)).astype(np.int64)
        begin = np.cumsum(n) - n
        out: dict[str, list] = {c: [] for c in ("key_a", "key_b", "tokens", "classes")}
        for i in range(len(rows)):
            if not n[i] or PART * m[i] < least * n[i]:
                for c in out.values():
                    c.append(None)
                continue
            t, c = tokens[begin[i]: begin[i] + n[i]], cls[begin[i]: begin[i] + n[i]]
            for key, salt in (("key_a", 1), ("key_b", 2)):
                out[key].append(np.bitwise_xor.reduce(K.mix(t + K.U64(salt))).astype(np.int64))
            t, c = _classed(t, c)
            out["tokens"].append(t.tobytes()), out["classes"].append(c.tobytes())
        return pa.table({
            "rid": rows["rid"], "doc_id": rows["doc_id"].cast(pa.int64()), "n": pa.array(n, pa.int64()), "m": pa.array(m, pa.int64()),
            "key_a": pa.array(out["key_a"], pa.int64()), "key_b": pa.array(out["key_b"], pa.int64()),
            "tokens": pa.array(out["tokens"], pa.binary()), "classes": pa.array(out["classes"], pa.binary())})

    answers = S.shared_keys(slabs, keys_of, buckets)
    return stored(slabs.select("slab", "doc_id", "rid", "text").groupBy("slab").cogroup(answers.groupBy("slab")).applyInArrow(measure, SETS), "sets")


HELD = "doc_id long, n long, m long, tokens binary, classes binary, prefix array<long>"


def held_sets(distinct: DataFrame, least: int = LEAST) -> DataFrame:
    """Of documents with distinct sets, those that can have a partner among them, with classes among them and the prefix of the first order."""
    total = distinct.agg(F.sum("m")).first()[0] or 0
    buckets = max(8, int(total / 500_000) + 1)
    slabs = distinct.withColumn("slab", F.pmod(F.xxhash64("rid"), F.lit(int(total / SLAB_TOKENS) + 1))).select("slab", "doc_id", "n", "tokens")

    def parts(rows: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray]:
        rows = rows.combine_chunks()
        own = [np.frombuffer(t, np.uint64) for t in rows["tokens"].to_pylist()]
        return rows["n"].to_pylist(), own, S.at_most_twice(np.concatenate([np.zeros(0, np.uint64), *own]))

    def measure(rows: pa.Table, told: pa.Table) -> pa.Table:
        sizes, own, keys = parts(rows)
        classes = S.unpack(keys, buckets, told) if len(keys) else np.zeros(0, np.uint8)
        found = []
        for doc, n, t in zip(rows["doc_id"].to_pylist(), sizes, own):
            t, c = _classed(t, classes[np.searchsorted(keys, t)])
            if len(t) and PART * len(t) >= least * n:
                found.append({"doc_id": doc, "n": n, "m": len(t), "tokens": t.tobytes(), "classes": c.tobytes(),
                              "prefix": t[: prefix_length(n, least) - (n - len(t))].astype(np.int64)})
        return pa.Table.from_pylist(found, schema=pa.schema([
            ("doc_id", pa.int64()), ("n", pa.int64()), ("m", pa.int64()), ("tokens", pa.binary()), ("classes", pa.binary()), ("prefix", pa.list_(pa.int64()))]))

    answers = S.shared_keys(slabs, lambda rows: parts(rows)[2], buckets, ("n", "tokens"))
    return stored(slabs.groupBy("slab").cogroup(answers.groupBy("slab")).applyInArrow(measure, HELD), "held")


def _similar(n_a, n_b, both, least):
    """Whether ``both`` common tokens make sets of these sizes similar enough; columns or numbers."""
    return PART * both >= least * (n_a + n_b - both)


def _overlaps(pairs: DataFrame, held: DataFrame, least: int) -> DataFrame:
    """(a, b, both): common tokens of each of ``pairs`` (a, b); 0 for pairs that don't share a token in the prefixes of every order.

    For pairs with a centre b also the bitmap of what a lacks of it.
    """
    one = held.select(*[F.col(c).alias(f"{c}_a") for c in ("n", "tokens", "classes")], F.col("doc_id").alias("a"))
    two = held.select(*[F.col(c).alias(f"{c}_b") for c in ("n", "tokens", "classes")], F.col("doc_id").alias("b"))

    def common(centre: bool, ta: bytes, ca: bytes, na: int, tb: bytes, cb: bytes, nb: int) -> int:
        x, y = np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64)
        if not centre:
            cx, cy = np.frombuffer(ca, np.uint8), np.frombuffer(cb, np.uint8)
            p, q = prefix_length(na, least) - (na - len(x)), prefix_length(nb, least) - (nb - len(y))
            for k in range(1, ORDERS):
                if not np.isin(in_order(x, cx, k)[:p], in_order(y, cy, k)[:q]).any():
                    return 0
        return len(np.intersect1d(x, y, assume_unique=True))

    def lacking(ta: bytes, tb: bytes) -> np.ndarray:
        bits = np.zeros(64 * WORDS, np.uint8)
        bits[np.flatnonzero(np.isin(np.frombuffer(tb, np.uint64), np.frombuffer(ta, np.uint64), assume_unique=True, invert=True)) % len(bits)] = 1
        return np.packbits(bits).view(np.int64)

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            both = [common(*r) for r in zip(*[d[c] for c in ("centre", "tokens_a", "classes_a", "n_a", "tokens_b", "classes_b", "n_b")])]
            lacks = np.zeros((batch.num_rows, WORDS), np.int64)
            for i in np.flatnonzero(d["centre"]):
                lacks[i] = lacking(d["tokens_a"][i], d["tokens_b"][i])
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in ("a", "b", "n_a", "n_b")], pa.array(both, pa.int64()), *map(pa.array, np.ascontiguousarray(lacks.T))],
                                             ["a", "b", "n_a", "n_b", "both", *LACKS])

    out = pairs.groupBy("a", "b").agg(F.max("centre").alias("centre")).join(one, "a").join(two, "b").mapInArrow(
        run, ", ".join(f"{c} long" for c in ("a", "b", "n_a", "n_b", "both", *LACKS)))
    return stored(out, "overlaps")


def links(held: DataFrame, least: int = LEAST) -> DataFrame:
    """Links (a, b) between the documents of ``held`` that join the same components as all links do."""
    entries = held.select(F.explode("prefix").alias("token"), F.col("doc_id").alias("a"), "n", "m")
    busy = entries.groupBy("token").agg(F.count("*").alias("size"), F.min(F.struct((F.col("n") - F.col("m")).alias("lone"), "a", "m")).alias("c")).where("size > 1")
    entries = stored(entries.join(busy.select("token", "size", F.col("c.a").alias("centre"), F.col("c.m").alias("centre_m")), "token"), "entries")
    side = lambda df, s, *more: df.select(
        "token", F.col("a").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "m", *more)])
    few, many = entries.where(F.col("size") <= FEW), entries.where(F.col("size") > FEW)
    most = F.least("m_a", "m_b")
    alone = side(few, "a").join(side(few, "b"), "token").where((F.col("a") < F.col("b")) & _similar(F.col("n_a"), F.col("n_b"), most, least))
    stars = many.where("a <> centre").select("a", F.col("centre").alias("b"), F.lit(True).alias("centre"))
    met = _overlaps(stars.union(alone.select("a", "b", F.lit(False))), held, least)
    found = met.where(_similar(F.col("n_a"), F.col("n_b"), F.col("both"), least)).select("a", "b")

    named = components(found)
    near = many.join(met.select("a", F.col("b").alias("centre"), "both", *LACKS), ["a", "centre"], "left").withColumn(
        "near", F.coalesce("both", F.when(F.col("a") == F.col("centre"), F.col("m")), F.lit(0))).withColumn("far", F.col("m") - F.col("near"))
    near = near.join(named.select(F.col("node").alias("a"), F.col("component").alias("named")), "a", "left").select(
        "token", "a", "n", "m", "near", "far", F.coalesce("named", "a").alias("component"), "centre_m", *[F.coalesce(c, F.lit(0)).alias(c) for c in LACKS])
    open_ = _open(near)
    bound = F.col("near") + F.least("far", "most_far")
    left = stored(_open(open_.where(_similar(F.col("n"), F.greatest("least_n", bound), bound, least)).drop("most_far", "least_n")), "open")
    for _ in range(ROUNDS):
        size = F.col("size").cast("double")
        rows, pairs = left.groupBy("token").agg(F.count("*").alias("size")).agg(F.sum(size), F.sum(size * (size - 1) / 2)).first()
        if not rows:
            return found
        if pairs <= SPARSE * rows:
            break
        left, new = _next_centres(left, held, least)
        found = found.union(new)
    told = ("near", "far", "component", "centre_m", *LACKS)
    again = side(left, "a", *told).join(side(left, "b", *told), "token").where(
        (F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b"))
        & _similar(F.col("n_a"), F.col("n_b"), most, least) & _may_be_similar("a", "b", least))
    late = _overlaps(again.select("a", "b", F.lit(False).alias("centre")), held, least)
    return found.union(late.where(_similar(F.col("n_a"), F.col("n_b"), F.col("both"), least)).select("a", "b"))


def _may_be_similar(a: str, b: str, least: int):
    """Whether what two entries share with the centre of their token's first round allows them to be similar.

    Of the centre's tokens both have at most those that neither lacks; beside the centre's, both have at most what the one has that has fewer.
    """
    lacked = reduce(Column.__add__, [F.bit_count(F.col(f"{c}_{a}").bitwiseOR(F.col(f"{c}_{b}"))) for c in LACKS])
    bound = F.least(F.col(f"near_{a}"), F.col(f"near_{b}"), F.col(f"centre_m_{a}") - lacked) + F.least(f"far_{a}", f"far_{b}")
    return _similar(F.col(f"n_{a}"), F.col(f"n_{b}"), bound, least)


def _next_centres(left: DataFrame, held: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """What stays open after each token's documents met one more of them, and the links found.

    The centre is of the component with the most open documents, so that the others join that one. All that could link it is known then, so it
    leaves, and tokens whose documents have come into one component leave as a whole. Components are told by their labels of before, joined anew.
    """
    members = left.select("a", "component").distinct().groupBy("component").agg(F.count("*").alias("members"))
    columns = ["a", "component", "n", "m", "near", "far", "centre_m", *LACKS]
    centres = left.join(members, "component").groupBy("token").agg(F.max(F.struct("members", F.col("near").alias("most"), *columns)).alias("c")).select(
        "token", *[F.col(f"c.{c}").alias(f"{c}_c") for c in columns])
    met = left.withColumnsRenamed({c: f"{c}_o" for c in columns}).join(centres, "token")
    pairs = met.where((F.col("component_o") != F.col("component_c")) & _similar(F.col("n_o"), F.col("n_c"), F.least("m_o", "m_c"), least) & _may_be_similar("o", "c", least))
    both = _overlaps(pairs.select(F.least("a_o", "a_c").alias("a"), F.greatest("a_o", "a_c").alias("b"), F.lit(False).alias("centre")), held, least)
    new = stored(both.where(_similar(F.col("n_a"), F.col("n_b"), F.col("both"), least)).select("a", "b"), "links")
    name = stored(left.select("a", "component").distinct(), "names")
    of = lambda c: name.select(F.col("a").alias(c), F.col("component").alias(f"of_{c}"))
    joined_ = components(new.join(of("a"), "a").join(of("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    rest = met.where("a_o <> a_c").select("token", *[F.col(f"{c}_o").alias(c) for c in columns])
    rest = rest.join(joined_.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left").select(
        "token", *[c for c in columns if c != "component"], F.coalesce("now", "component").alias("component"))
    return stored(_open(rest).drop("most_far", "least_n"), "open"), new


def _open(entries: DataFrame) -> DataFrame:
    """Entries of tokens whose documents are in several components, with the largest ``far`` and the least ``n`` of the token."""
    busy = entries.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("far").alias("most_far"), F.min("n").alias("least_n"))
    return entries.join(busy.where("x <> y").drop("x", "y"), "token")


def joined(docs: DataFrame, width: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; links by shingles of ``width`` words and a similarity of ``least`` hundredths or more."""
    name = S.new_name()
    rows = sets(S.slab_table(docs.select("doc_id", "text"), name), width, least)  # written by now, so the texts' copy can go
    S.discard(docs.sparkSession, name)
    can = rows.where(F.col("tokens").isNotNull() & F.col("doc_id").isNotNull())
    same = ["n", "key_a", "key_b"]
    first = can.groupBy(*same).agg(F.min(F.struct("doc_id", "rid")).alias("one"))
    first = stored(first.select(*same, F.col("one.doc_id").alias("a"), F.col("one.rid").alias("rid")), "distinct")
    distinct = stored(can.select("rid", "doc_id", "n", "m", "tokens").join(first.select("rid"), "rid", "left_semi"), "distinct")
    copies = can.select(*same, F.col("doc_id").alias("b")).join(first.select(*same, "a"), same).where("a <> b").select("a", "b")
    named = components(copies.union(links(held_sets(distinct, least), least))).withColumnRenamed("node", "doc_id")
    return rows.select("doc_id", F.col("n").alias("n_shingles")).join(named, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """``docs`` without the rows whose component has a smaller doc_id; rows with a null id and rows of one id stay."""
    gone = joined(docs, width, least).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[K.quoted(c) for c in docs.columns])
