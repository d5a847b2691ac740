"""Operators with exact results against brute force and against the tokenizers library."""

import hashlib
import os
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesloom.llm import bpe_trie, decontaminate, jaccard_join, rule_forest, slabs, suffix_dedup, token_counts, token_files
from salesloom.llm.components import components
from salesloom.llm.queries import QUERIES

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def same(df, want, columns=None):
    got = sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=key)
    assert got == sorted(want, key=key)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# --- decontamination

def test_decontamination(odd, benchmark, small_docs, spark):
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    same(decontaminate.digest(odd, benchmark), brute.decontamination(pairs(odd), items))
    own = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    same(decontaminate.digest(small_docs, own), brute.decontamination(pairs(small_docs), [(r["item_id"], r["text"]) for r in own.collect()]))


def test_decontamination_in_several_passes(odd, benchmark, monkeypatch):
    want = sorted(map(tuple, decontaminate.digest(odd, benchmark).collect()), key=key)
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 1000)
    same(decontaminate.digest(odd, benchmark), want)


def test_decontamination_without_items_or_rows(odd, empty, benchmark):
    assert decontaminate.digest(empty, benchmark).count() == 0
    assert decontaminate.digest(odd, benchmark.limit(0)).where("n_hit > 0 or contaminated").count() == 0
    clean = decontaminate.clean(odd, benchmark)
    assert clean.schema == odd.schema and clean.count() < odd.count()
    cut = decontaminate.cut(odd, benchmark)
    assert cut.count() == odd.count() and decontaminate.digest(cut.where("doc_id = 0"), benchmark).first()["n_hit"] == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.lists(st.lists(st.integers(2, 5), min_size=1, max_size=4), min_size=1, max_size=5))
def test_fm_index_finds_all_occurrences(text, patterns):
    t = np.array(text, np.int64)
    got = decontaminate.FmIndex(t).search([np.array(p) for p in patterns])
    want = sorted((k, i) for k, p in enumerate(patterns) for i in range(len(text)) if text[i:i + len(p)] == p)
    assert sorted(zip(*(x.tolist() for x in got))) == want


# --- Jaccard join

def test_jaccard_components(odd, small_docs, empty):
    same(jaccard_join.joined(odd), brute.jaccard(pairs(odd)))
    same(jaccard_join.joined(small_docs), brute.jaccard(pairs(small_docs)))
    assert jaccard_join.joined(empty).count() == 0


def test_jaccard_groups_larger_than_a_bucket(spark):
    rng, vocabulary = random.Random(3), [f"w{i}" for i in range(4000)]
    rows = []
    for group in range(3):
        base = rng.choices(vocabulary, k=120)
        for k in range(40):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
        chain = list(base)  # links to its neighbours only
        for k in range(15):
            chain[8 * k] = f"c{group}_{k}"
            rows.append((len(rows), " ".join(chain)))
    shared = rng.choices(vocabulary, k=30)
    rows += [(len(rows) + k, " ".join(shared + rng.choices(vocabulary, k=rng.randint(5, 60)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(jaccard_join.joined(df), brute.jaccard(rows))


def test_one_of_each_keeps_columns(odd):
    out = jaccard_join.one_of_each(odd)
    assert out.schema == odd.schema
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert 7 in ids and 8 not in ids and 9 not in ids and ids.count(22) == 2 and ids.count(None) == 2 and 6 not in ids


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(39, 4), (70, 70)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 4 for k in range(4, 40)}}


# --- suffix-array dedup

@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_suffix_array(s):
    s = [*s, 0]
    assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_repeats(odd, small_docs, empty):
    for df in (odd, small_docs):
        want = [(d, n, gone, runs, hashlib.sha256(kept).hexdigest()) for d, n, gone, runs, kept in brute.repeated(pairs(df))]
        same(suffix_dedup.dedup(df), want, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    assert suffix_dedup.dedup(empty).count() == 0


def test_repeats_at_all_offsets_and_edges(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abc ", k=n))
    shared, rows = text(130), []
    for k in range(60):
        a = rng.randint(0, 90)
        rows.append((k, text(rng.randint(0, 40)) + shared[a: a + rng.choice([49, 50, 51, 70])] + text(rng.randint(0, 40)) + rng.choice(["", "é" * 30, "a" * 60])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = [(d, n, g, r, hashlib.sha256(k).hexdigest()) for d, n, g, r, k in brute.repeated(rows)]
    for crowded in (1, 3, suffix_dedup.CROWDED):
        same(suffix_dedup.dedup(df, crowded), want)


def test_long_texts_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 64)
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefg", k=5)) for _ in range(30)]
    t = pa.array([" ".join(rng.choices(words, k=200)) for _ in range(5)] + ["", None])
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1 << 22)
    whole = suffix_dedup.anchors(t)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 64)
    cut = suffix_dedup.anchors(t)
    windows = lambda a: sorted((r, s + i, s + lead, g) for r, g, s, n, lead in zip(
        *(a[c].tolist() for c in ("row", "gram", "start", "length", "lead"))) for i in range(n - 49))
    assert windows(whole) == windows(cut)


def test_cut_documents_keep_their_columns(odd):
    out = suffix_dedup.without_repeats(odd)
    assert out.schema == odd.schema and out.count() == odd.count()
    assert {r["kept"] for r in out.collect()} == {"kept as it is"}
    text = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    assert text[8] == "" and text[1] is None and text[16] is not None


def test_documents_are_cut_in_one_python_pass(odd):
    out = suffix_dedup.without_repeats(odd)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan  # a second pass keeps a second worker for each task
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    want = [(r["doc_id"], None if r["kept"] is None else r["kept"].decode("utf-8", "ignore")) for r in suffix_dedup.kept_bytes(odd.select("doc_id", "text")).collect()]
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())


# --- BPE and token files

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_equals_the_library(odd, small_docs, empty, library):
    for df in (odd, small_docs):
        want = []
        for d, t in pairs(df):
            ids = library.encode(t or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        same(bpe_trie.digests(df), want)
    assert bpe_trie.digests(empty).count() == 0
    assert bpe_trie.encoded(odd).drop("ids", "decoded").schema == odd.drop("ids").schema


def test_bpe_of_random_texts(library):
    rng = random.Random(1)
    alphabet = [*"abcABC '’sStTΣσςİıẞßéÉ́   \x1c\x1f\x85​漢字हि🙂🇩🇪12½²Ⅷ$#<|>\t\n\r\x00ǅﬁ`Ω", "<|endoftext|>", "</w>", "'re", "the", "ing"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    mine = bpe_trie.TrieBpe(public_tokenizers.path("word_bpe_49k.json"), limit=50)
    packed = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"), limit=50)
    for part in bpe_trie.portions(texts, 2000):
        want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(part, add_special_tokens=False)]
        assert mine.encode_batch(part) == want == packed.encode_batch(part)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype(np.uint32)
    assert (token_files.unpack_bits(token_files.pack_bits(ids, bits), bits, len(ids)) == ids).all()
    assert len(token_files.pack_bits(ids, bits)) == (bits * 1001 + 7) // 8
    with pytest.raises(ValueError):
        token_files.pack_bits(np.array([1 << bits], np.uint64), bits)


def test_token_files(odd, empty, library, spark, tmp_path):
    ordered = sorted(pairs(odd), key=lambda r: (r[0] is not None, r[0] or 0, str(r[1])))
    want, at = [], 0
    for d, t in ordered:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(map(tuple, token_files.stored_tokens(odd).collect()), key=lambda r: r[1])
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted((r[0], r[2], r[3]) for r in want if r[0] is not None)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    assert token_files.stored_tokens(empty).count() == 0
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write(odd, str(tmp_path / "small"), path, block=64)
    whole = {r["doc_id"]: bytes(r["ids"]) for r in token_files.read(spark, str(tmp_path / "small")).collect()}
    few = token_files.read(spark, str(tmp_path / "small"), spark.createDataFrame([(12,), (2,), (777,)], "doc_id long")).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in few} == {k: whole[k] for k in (2, 12)}
    texts = dict(ordered)
    assert whole[12] == np.array([*library.encode(texts[12], add_special_tokens=False).ids, 2], "<u4").tobytes()


# --- token counts

def naive_counts(text, sections, rule):
    import base64

    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    code = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    raw, owner = text.encode(), []
    for i, c in enumerate(text):
        owner += [i] * len(c.encode())
    at, out = 0, [0.0] * (len(sections) + 1)
    for token in code.encode_ordinary(text):
        n = len(code.decode_single_token_bytes(token))
        chars = sorted(set(owner[at:at + n]))
        at += n
        held = [sum(s <= c < e for c in chars) for s, e in sections]
        if rule == "split":
            for k, h in enumerate(held):
                out[k] += h / len(chars)
            out[-1] += 1 - sum(held) / len(chars)
        elif rule == "first":
            k = [i for i, (s, e) in enumerate(sections) if s <= chars[0] < e]
            out[k[0] if k else -1] += 1
        else:
            out[held.index(max(held)) if held and max(held) else -1] += 1
    assert at == len(raw)
    return out


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution_rules(spark, rule):
    text = "Größe über 漢字🙂 und so weiter, the boundary\n\n   crosses tokens"
    rng = random.Random(rule)
    for _ in range(12):
        cuts = sorted(rng.sample(range(len(text) + 1), 6))
        sections = [(cuts[0], cuts[1]), (cuts[1], cuts[2]), (cuts[3], cuts[4]), (cuts[4], cuts[5])]
        code = token_counts.encoder(public_tokenizers.path(token_counts.RANKS))
        got = token_counts.allocate(*token_counts.token_spans(text, code), *np.array(sections).T, rule)
        assert np.allclose(got, naive_counts(text, sections, rule))
    given_ = spark.createDataFrame([(1, 0, 5, 7), (1, 5, 20, 8), (2, 0, 3, 1), (None, 0, 1, 1), (1, None, 2, 3)], "doc_id long, start long, end long, section long")
    docs = spark.createDataFrame([(1, text), (3, "not listed"), (2, None), (None, "x")], "doc_id long, text string")
    rows = {(r["doc_id"], r["section"]): r["n_tokens"] for r in token_counts.counts(docs, given_, rule).collect()}
    want = naive_counts(text, [(0, 5), (5, 20)], rule)
    assert np.allclose([rows[1, 7], rows[1, 8], rows[1, -1]], want) and rows[2, 1] == 0 and rows[3, -1] > 0 and (None, -1) in rows


def test_line_counts(odd, empty, small_docs):
    for df in (odd, small_docs.limit(40)):
        want = []
        for d, t in pairs(df):
            lines, at = [], 0
            for line in (t or "").splitlines(keepends=True) if not set(t or "") & set("\r\x0b\x0c\x1c\x1d\x1e\x85  ") else [
                    x + "\n" for x in (t or "").split("\n")[:-1]] + [x for x in [(t or "").split("\n")[-1]] if x]:
                lines.append((at, at + len(line)))
                at += len(line)
            n = naive_counts(t or "", lines, "largest")
            want += [(d, k, s, e, int(c)) for k, ((s, e), c) in enumerate(zip(lines, n))]
        same(token_counts.counts(df), want)
    assert token_counts.counts(empty).count() == 0
    with pytest.raises(ValueError):
        token_counts.counts(empty, rule="none")


# --- quality rules

def test_rule_counts(odd, labels, empty):
    got = sorted((tuple(r)[:7] for r in rule_forest.judged(odd, labels).collect()), key=key)
    assert got == sorted(((d, *brute.rules(t)) for d, t in pairs(odd)), key=key)
    assert rule_forest.judged(empty, labels).count() == 0


def test_queries_are_registered(tables, spark):
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
    for name, query in QUERIES.items():
        rows = query(spark, tables)
        assert rows.count() >= 33, name
        if name not in ("op3_token_counts", "op12_best_fit_packing", "op13_pivot_product_codes"):
            assert rows.count() == 33 and rows.where(F.col("doc_id").isNull()).count() == 2


@pytest.mark.parametrize("rounds", [0, 2])
def test_groups_around_the_threshold(spark, rounds, monkeypatch):
    """Many copies of one text whose similarities lie on both sides of the threshold: no link between components may be missed."""
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "SPARSE", 0)
    rng, vocabulary = random.Random(11), [f"w{i}" for i in range(3000)]
    rows = []
    for group, edits in enumerate((1, 2, 3, 4)):
        base = rng.choices(vocabulary, k=110)
        for _ in range(70):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.joined(df, 5, 80).collect()}
    assert got == {d: c for d, _, c in brute.near_copies(rows, 5, 80)}


def test_token_counts_of_long_runs(spark):
    """Millions of blanks, and texts of a megabyte without one."""
    texts = ["a" + " " * 5_000_000 + "b", "漢" * 400_000, "x" * 1_000_000, " " * 20_000 + "\n" + " " * 20_000 + "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = token_counts.counts(df).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r["doc_id"]: r["n"] for r in got} == {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in enumerate(texts)}


def test_chunk_memory_is_bounded(spark):
    """Chunks beyond a length are encoded right and not kept; the others are forgotten in time."""
    library = Tokenizer.from_file(public_tokenizers.path(bpe_trie.VOCABULARY))
    for code in (bpe_trie.TrieBpe(public_tokenizers.path(bpe_trie.VOCABULARY), limit=20), token_files.Encoder(public_tokenizers.path(bpe_trie.VOCABULARY), limit=20)):
        for k in range(12):
            texts = [f"word{k}{j} " + "abcé" * 30 + f"{j} tail" for j in range(10)]
            assert code.encode_batch(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        before = getattr(code.chunks, "before", code.before)
        assert len(code.chunks) + len(before) <= 2 * (20 + 30) and max(map(len, [*code.chunks, *before])) <= code.LONGEST


def test_rows_of_one_id_fall_into_several_shards(spark, tmp_path):
    df = spark.createDataFrame([(5 if k % 3 else None, f"text {k}") for k in range(300)], "doc_id long, text string")
    token_files.write(df, str(tmp_path / "t"), public_tokenizers.path(token_files.VOCABULARY))
    index = token_files.index_of(spark, str(tmp_path / "t"))
    assert index.groupBy("shard").count().count() >= 4
    back = token_files.read(spark, str(tmp_path / "t"))
    assert back.count() == 300 and back.select("start").distinct().count() == 300


def test_long_texts_are_slabs_of_their_own(spark):
    df = spark.createDataFrame([(k, "word " * (40_000 if k % 4 == 0 else 3)) for k in range(40)], "doc_id long, text string").coalesce(1)
    name = slabs.new_name()
    sizes = [r["n"] for r in slabs.slab_table(df, name).groupBy("slab").agg(F.sum("n_bytes").alias("n")).collect()]
    slabs.discard(spark, name)
    assert sorted(sizes)[-10:] == [200_000] * 10 and len(sizes) == 11


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(0, 17))
def test_flanks_tell_shared_windows(seed, offset):
    """Two segments that share a window share a flank of their gram."""
    rng = np.random.default_rng(seed)
    window = rng.integers(97, 101, 50)
    texts = [np.r_[rng.integers(97, 101, int(rng.integers(0, 35 - offset if k else 20))), window, rng.integers(97, 101, int(rng.integers(0, 20)))].astype(np.uint8) for k in range(2)]
    flanks = []
    for t in texts:
        at = int(np.flatnonzero((np.lib.stride_tricks.sliding_window_view(t, 50) == window).all(1))[0]) + offset
        begin, end = max(0, at - 34), min(len(t), at + 50)
        flanks.append(suffix_dedup._flanks(t, np.array([at]), np.array([at - begin]), np.array([end - begin])))
    assert any(flanks[0][k][0] == flanks[1][k][0] != 0 for k in range(2))
