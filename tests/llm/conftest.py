"""Rows that break careless code: nulls, empty and long texts, ties, repeated rows, columns with clashing names."""

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

CLASHING = ["score", "predicted", "label", "slab", "rid", "n_bytes", "kept", "ids", "n_words", "lang_pred", "a.b", "tick`s"]

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in CLASHING]])

WORDS = ("The and attion to thanedble erin tha or nt sch über für ciónmente qué été là ouvrir 漢字 naïve x1 7 re've "
         "onion storm river stone bread light table house green under winter summer").split()


def words(n, step, shift=0):
    return " ".join(WORDS[(i * step + shift + i * i // 7) % len(WORDS)] for i in range(n))


def odd_texts():
    passage = words(40, 3)
    base = words(300, 5)
    near = base.split()
    near[150] = "changed"
    return [
        (0, passage + " tail one " + words(30, 7)), (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two three"), (6, "one two three"),
        (7, base), (8, base), (9, " ".join(near)), (10, words(30, 11) + "\n" + passage + "\nend"), (11, passage),
        (12, words(20_000, 13)), (13, "aaaa" * 200), (14, "aaaa" * 150), (15, "🙂" * 60), (16, "🙂" * 61 + "x"),
        (17, "Shti " * 400), (18, "ONE!! TWO!! " * 40), (19, "a### b%%% c$$$ " * 30), (20, "<|endoftext|> and\x1cso\x85on <|startoftext|>"),
        (21, "x" * 30_000), (22, words(60, 17) + " idiot scum " + words(60, 19)), (22, words(60, 17) + " idiot scum " + words(60, 19)),
        (23, "\x00\x01\x7f " * 20), (24, "12 34 56 !!! ???"), (None, base), (None, None), (25, base.upper()),
        (26, "line one here now\nline one here now\n\nline one here now"), (27, "é É Σας İ ǅ ﬁ"), (28, words(49, 23)), (29, words(50, 29)),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(d, t, None if d == 4 else ("en", "de", "fr")[(d or 0) % 3], None if d == 5 else "s", None if t is None else len(t),
             *["kept as it is"] * len(CLASHING)) for d, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(d, int(d not in (17, 18, 19)), int(d == 22)) for d, _ in odd_texts() if d is not None] + [(None, 1, 1), (7, None, None), (999, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [(0, words(40, 3)), (1, "one two three"), (2, None), (3, ""), (4, "..."), (5, words(14, 23)), (None, "one"), (6, words(14, 23)), (10, "naïve x1")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory, odd, labels, benchmark):
    folder = str(tmp_path_factory.mktemp("odd"))
    odd.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{SMALL}/embeddings.parquet").write.parquet(f"{folder}/embeddings.parquet")
    return folder
