"""The pipeline against a brute-force version of its exact stages, and its contract."""

import hashlib

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
from conftest import SMALL

from salesloom.llm import common as K
from salesloom.llm import jaccard_join, quality_trees


def check(spark, folder):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = K.table(spark, folder, "documents")
    items = [(r["item_id"], r["text"]) for r in K.table(spark, folder, "benchmark").collect()]
    forest = quality_trees.fit_on(docs, K.table(spark, folder, "labels"), K.fold(4) != 2)
    rows = [(r["doc_id"], r["text"]) for r in quality_trees.accepted(docs, forest).select("doc_id", "text").collect()]
    rows = [(d, t) for (d, t), (_, _, least) in zip(rows, brute.near_copies(rows, 5, 80)) if d == least]
    rows = [(d, None if t is None else kept.decode("utf-8", "ignore")) for (d, t), (*_, kept) in zip(rows, brute.repeated(rows))]
    rows = [(d, t) for (d, t), (*_, bad) in zip(rows, brute.decontamination(rows, items)) if not bad]
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=key)
    assert got == sorted(want, key=key) and got


def test_run_on_the_given_tables(spark):
    check(spark, SMALL)


def test_run_on_odd_rows(spark, tables):
    check(spark, tables)


def block_edits():
    """Texts of 300 distinct words, each with copies in which a block of words is replaced."""
    rows = []
    for k, sizes in enumerate([(28,), (20, 24, 29, 30, 31), (10, 28), (60,)]):
        own = [f"w{k}x{i}" for i in range(300)]
        rows.append((100 * k, " ".join(own)))
        for j, n in enumerate(sizes, 1):
            at = 40 + 35 * j
            rows.append((100 * k + j, " ".join([*own[:at], *[f"new{k}x{j}x{i}" for i in range(n)], *own[at + n:]])))
    return rows + [(900, "one two three four"), (901, "One two three four"), (902, "one two three four five"), (None, rows[0][1]), (903, None)]


def test_run_where_four_words_and_less_similarity_would_differ(spark, labels, benchmark, tmp_path):
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in block_edits()], "doc_id long, text string, lang string, source string, n_chars long")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    check(spark, str(tmp_path))


def test_near_duplicates_are_of_five_words_and_four_fifths(spark, odd, tables):
    edits = spark.createDataFrame(block_edits(), "doc_id long, text string")
    for docs in (edits, K.table(spark, SMALL, "documents"), odd):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        want = brute.near_copies(rows, 5, 80)
        key = lambda r: tuple((v is not None, str(v)) for v in r)
        assert sorted(map(tuple, jaccard_join.joined(docs, 5, 80).collect()), key=key) == sorted(want, key=key)
        kept = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, tables).collect()]
        assert sorted(kept, key=str) == sorted([d for d, _, least in want if d == least], key=str)
    rows = block_edits()
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, edits, tables).collect()}
    assert {0, 300, 301} <= kept and 1 not in kept
    assert dict((d, c) for d, _, c in brute.near_copies(rows, 4, 85))[1] == 1


def test_stages_keep_the_columns(spark, odd, empty, tables):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, tables).columns == odd.columns, name
        assert stage(spark, odd, tables).count() > 0, name
        assert stage(spark, empty, tables).count() == 0, name
