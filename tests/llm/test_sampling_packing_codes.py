"""Importance resampling, packing and product codes against plain versions."""

import functools
import hashlib
import math
import random
import zlib
from collections import Counter

import brute
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_exact_results import pairs, same
from tokenizers import Tokenizer

from salesloom.checks.compare import differences, normal
from salesloom.llm import byte_bpe, importance, packing, product_codes
from salesloom.llm.queries import QUERIES
from salesloom.llm.sql import SQL

# --- importance resampling


def plain_ranks(rows, target, percent=10, least=20, seed=2024, longest=1, m=10_000):
    def runs(text):
        w = brute.PLAIN_WORDS.findall((text or "").translate(brute.LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % m for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    docs = [(d, *runs(t)) for d, t in rows]
    s, t = Counter(), Counter()
    for _, _, r in docs:
        s.update(r)
    for x in target:
        t.update(runs(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + m) / ((s[b] + 1) * (total_t + m)))) for b in s}
    out = []
    for d, n, r in docs:
        weight = sum(gain[b] for b in r) // len(r) if r else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(r), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), None, n])
    may = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for k, x in enumerate(may[: percent * len(may) // 100]):
        x[4] = k + 1
    return [tuple(x[:5]) for x in out]


def test_ranks(odd, benchmark, spark):
    target = [r["text"] for r in benchmark.collect()]
    same(importance.ranks(odd, benchmark), plain_ranks(pairs(odd), target))
    docs, own = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    same(importance.ranks(docs, own), plain_ranks(pairs(docs), [r["text"] for r in own.collect()]))
    got = importance.resampled(docs, own, percent=40, least_words=5, seed=7, longest=3).select("doc_id", "n_features", "weight", "score", "rank")
    same(got, plain_ranks(pairs(docs), [r["text"] for r in own.collect()], 40, 5, 7, 3))


def test_ranks_with_ties_and_repeats(spark, benchmark):
    """A third of all rows is one row; the cut goes through its copies."""
    text = "one two three four five " * 6
    rows = [(k % 40 if k % 3 else 5, text) for k in range(600)] + [(None, text)] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    target = [r["text"] for r in benchmark.collect()]
    for percent in (1, 30, 99, 100):
        got = importance.resampled(df, benchmark, percent=percent).select("doc_id", "n_features", "weight", "score", "rank")
        same(got, plain_ranks(rows, target, percent))


def test_ranks_of_nothing(empty, odd, benchmark):
    assert importance.ranks(empty, benchmark).count() == 0
    none = importance.ranks(odd, benchmark.limit(0))
    assert none.count() == odd.count() and none.where("rank is not null").count() > 0
    kept = importance.drawn(odd, benchmark, percent=50)
    assert kept.schema == odd.schema and 0 < kept.count() < odd.count()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=90), min_size=1, max_size=8), st.binary(max_size=9))
def test_crc_feed(spans, head):
    buf = np.frombuffer(b"".join(spans), np.uint8)
    end = np.cumsum([len(x) for x in spans])
    state = np.full(len(spans), np.uint32(zlib.crc32(head)) ^ np.uint32(0xFFFFFFFF))
    got = importance.crc_feed(state, buf, end - [len(x) for x in spans], end) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(head + x) for x in spans]


def test_kth_key_is_exact(spark):
    rng = random.Random(5)
    rows = [(rng.randint(-3, 3), rng.randint(0, 4), k) for k in range(500)]
    df = spark.createDataFrame(rows, "score long, id long, row long").repartition(6)
    ranked = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    for k in (1, 2, 250, 499, 500):
        assert importance.kth_key(df, k, pivots=4) == ranked[k - 1]


# --- byte-level BPE and packing


@functools.lru_cache
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


@functools.lru_cache
def code():
    return byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))


def check_ids(text):
    assert code().encode(text).tolist() == library().encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "The ", "'ll", "12", " ", "\n", "\t", "é", "漢", "🙂", "<|endoftext|>", "<|end", " ", "\x1c", "!?", "\x00"]), max_size=30), st.text(max_size=20))
def test_byte_bpe(parts, more):
    check_ids("".join(parts) + more)


@pytest.mark.parametrize("text", ["a" + " " * 30_000 + "b", " " * 30_000, "\n" * 20_000 + " x", "a \t" * 9_000 + " " * 10_000, "x" + " " * 9_999 + " " * 5 + "<|endoftext|>" + " " * 10_001,
                                  "漢" * 40_000, "ab" * 60_000])
def test_byte_bpe_of_long_runs(text):
    check_ids(text)


def test_byte_bpe_of_millions_of_blanks():
    ids = code().encode("a" + " " * 5_000_000 + "b")
    assert len(ids) == 5_000_001 and ids[-1] == library().encode(" b").ids[0]


def optimum(sizes, capacity):
    """Fewest sequences, by trying every place for every piece."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for r in {r for r in rooms if r >= sizes[k]}:
            now = list(rooms)
            now[now.index(r)] = r - sizes[k]
            go(k + 1, now)
        go(k + 1, [*rooms, capacity - sizes[k]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.integers(5, 30).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=10))))
def test_reduction_keeps_the_optimum(case):
    capacity, sizes = case
    p = packing.Plan(capacity, np.bincount(sizes, minlength=capacity + 1) if sizes else np.zeros(capacity + 1, int))
    packing.reduce(p)
    assert p.n_sequences + optimum([s for s, n in enumerate(p.left) for _ in range(n)], capacity) == optimum(sizes, capacity)


@settings(max_examples=150, deadline=None)
@given(st.integers(5, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_plans_place_every_piece_once(case):
    capacity, sizes = case
    counts = np.bincount(sizes, minlength=capacity + 1) if sizes else np.zeros(capacity + 1, int)
    for fill in (packing.best_fit, packing.best_sets):
        p = packing.Plan(capacity, counts)
        fill(p)
        check_plan(p)
    check_plan(packing.plan(counts, capacity))


def check_plan(p):
    held, seen = {}, Counter()
    for length, first, each, many, sequence, offset in p.segments:
        assert seen[length] == first
        seen[length] += each * many
        for q in range(many):
            for k in range(each):
                held.setdefault(sequence + q, []).append((offset + k * length, length))
    assert [seen[s] for s in range(p.capacity + 1)] == p.counts.tolist() and not any(p.left)
    assert sorted(held) == list(range(p.n_sequences))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= p.capacity


def test_plan_of_billions():
    counts = np.bincount(np.clip(np.random.default_rng(1).lognormal(5.5, .9, 50_000).astype(int), 1, 1024), minlength=1025) * 1_000_003
    p = packing.plan(counts)
    least = -(-int((counts * np.arange(1025)).sum()) // 1024)
    assert len(p.segments) < 10_000 and least <= p.n_sequences < least * 1.001


def check_packing(df, got):
    rows = got.collect()
    want = []
    for d, t in pairs(df):
        ids = [*library().encode(t or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 1024 or 1024
        for k, (a, b) in enumerate(zip([0, *range(head, len(ids), 1024)], range(head, len(ids) + 1, 1024))):
            want.append((d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=key) == sorted(want, key=key)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert ends[-1] <= 1024 and [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()]
    return len(held), -(-sum(w[3] for w in want) // 1024)


def test_packing(odd, spark, empty):
    check_packing(odd, packing.digests(odd))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)
    many, least = check_packing(docs, packing.digests(docs))
    assert many <= least * 1.01 + 2
    assert packing.digests(empty).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {d: [*library().encode(t or "", add_special_tokens=False).ids, 2] for d, t in pairs(docs)}
    got = packing.sequences(packing.packed(packing.pieces(docs))).collect()
    assert sum(r.n_tokens for r in got) == sum(map(len, ids.values()))
    for r in got:
        assert len(r.ids) == 4 * r.n_tokens
        if len(r.doc_ids) > 1:
            assert np.frombuffer(r.ids, "<u4").tolist() == [i for d in r.doc_ids for i in ids[d][: len(ids[d]) % 1024]]


# --- product codes


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = sorted([(v, lab, [math.floor(scale * x) for x in e]) for v, lab, e in rows if e and all(x is not None and math.isfinite(x) for x in e)],
                  key=lambda r: (r[0] is None, r[0] or 0))
    w = len(kept[0][2]) // parts
    cut = [[tuple(e[p * w: (p + 1) * w]) for p in range(parts)] for *_, e in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cut:
                held.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(v) // len(held[k]) for v in zip(*held[k])) if k in held else c for k, c in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = Counter()
    for (_, lab, _), f in zip(kept, found):
        errors[lab] += sum(d for d, _ in f)
    return [(v, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), errors[lab], digest) for (v, lab, _), f in zip(kept, found)]


def odd_vectors():
    rng = random.Random(9)
    rows = [(k, k % 5 if k % 7 else None, [float(np.float32(rng.gauss(k % 4, 1))) for _ in range(16)]) for k in range(70)]
    rows += [(100 + k, 1, rows[3][2]) for k in range(60)] + [(3, 1, rows[3][2]), (3, 1, rows[3][2])]
    rows += [(200, 1, None), (201, 1, []), (202, None, [None, *rows[0][2][1:]]), (203, 2, [math.inf, *rows[0][2][1:]]), (204, 2, [math.nan, *rows[0][2][1:]]), (None, 9, rows[8][2])]
    return rows


VECTORS = "vec_id long, label int, embedding array<float>"


def test_codes_of_odd_vectors(spark):
    df = spark.createDataFrame(odd_vectors(), VECTORS).withColumn("codes", F.lit("kept apart")).withColumn("x", F.lit(1)).repartition(4)
    same(product_codes.digests(df), plain_codes(odd_vectors()))
    few = df.where("vec_id < 5")
    same(product_codes.digests(few), plain_codes([r for r in odd_vectors() if r[0] is not None and r[0] < 5]))
    assert product_codes.digests(df.where("false")).collect() == [] and product_codes.digests(df.where("vec_id between 200 and 204")).count() == 0


def test_codes_with_salted_labels(spark, monkeypatch):
    df = spark.createDataFrame(odd_vectors(), VECTORS).repartition(4)
    monkeypatch.setattr(product_codes, "MOST_LABELS", 2)
    same(product_codes.digests(df), plain_codes(odd_vectors()))


def test_vectors_of_other_sizes_and_huge_components(spark):
    rows = [(0, 1, [1.0] * 16), (1, 1, [2.0] * 8), (2, 1, [1e30] * 16), (3, 1, [-3e38] * 16)]
    df = spark.createDataFrame(rows, VECTORS)
    got = {r.vec_id: r.error for r in product_codes.digests(df).collect()}
    assert set(got) == {0, 2, 3} and set(got.values()) == {0}
    with pytest.raises(ValueError):
        product_codes.fit(spark.createDataFrame([(0, 1, [1.0] * 9)], VECTORS))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 40), st.integers(1, 16), st.sampled_from([1, 3, 1 << 26]))
def test_nearest_is_exact(seed, n, k, span):
    rng = np.random.default_rng(seed)
    x, entries = rng.integers(-span, span + 1, (n, 3)), rng.integers(-span, span + 1, (k, 3))
    pivots = product_codes.far_apart(rng.integers(-span, span + 1, (5, 3)), 4)
    code, best = product_codes.nearest(x, product_codes.distances(x, pivots), entries, pivots)
    d = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert code.tolist() == d.argmin(1).tolist() and best.tolist() == d.min(1).tolist()


def test_whole_numbers():
    rows, size, n = product_codes.whole_numbers(pa.array([[0.5, -0.0001], None, [], [None], [1.0], [float("nan")]], pa.list_(pa.float32())), 4096)
    assert rows.tolist() == [0, 4] and size.tolist() == [2, 1] and n.tolist() == [2048, -1, 4096]


def test_codebooks_decode(spark):
    df = spark.createDataFrame(odd_vectors(), VECTORS)
    rows, books = product_codes.fit(df)
    got = product_codes.coded(rows, books).join(rows.select("vec_id", "x"), "vec_id").where("vec_id >= 100 or vec_id = 7").collect()
    for r in got:
        v = books.decode(np.frombuffer(r["codes"], np.uint8)[None])[0]
        assert ((v - np.frombuffer(r["x"], "<i4")) ** 2).sum() == r["error"]


# --- SQL


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_pivot_product_codes"])
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    result = con.execute(SQL[name])
    want = normal([d[0] for d in result.description], result.fetchall())
    df = QUERIES[name](spark, SMALL)
    assert differences(normal(df.columns, [tuple(r) for r in df.collect()]), want) == []
