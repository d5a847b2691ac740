"""Fitted operators: held-out accuracy on the given tables, odd rows, tables without anything to learn from."""

import functools
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm import language_ppm, quality_trees, rule_forest, toxicity

LARGER = SMALL.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{LARGER}/documents.parquet")


@pytest.fixture(scope="module")
def marks(spark):
    return spark.read.parquet(f"{LARGER}/labels.parquet")


def test_folds_equal_crc32(spark):
    import zlib
    got = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", K.fold(4).alias("f"), K.held_out(4, 2).alias("h")).collect()
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 4 and r["h"] == (r["f"] == 2) for r in got)


def test_quality_on_held_out_rows(docs, marks):
    got = quality_trees.quality(docs, marks).join(marks, "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_quality_ignores_labels_of_held_out_rows(docs, marks):
    swapped = marks.withColumn("quality", F.when(K.fold(4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in quality_trees.quality(docs, m).collect()} for m in (marks, swapped))
    assert a == b


def test_forest_walk_equals_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    forest = quality_trees.fit(x, y, trees=30)
    assert ((forest.score(x) > 0.5) == y).mean() > 0.9

    def plain(row):
        total = forest.start
        for feature, limit, leaf in zip(forest.feature, forest.limit, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
            total += leaf[node - len(feature)]
        return total
    assert np.allclose(forest.raw(x), [plain(r) for r in x])


def test_toxicity_on_held_out_rows(docs, marks):
    got = toxicity.toxicity(docs, marks).join(marks, "doc_id").collect()
    clean = [r for r in got if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in clean]) < 0.01
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 1 and not r["held_out"]]) > 0.8  # rows learned from; the test below has others


def test_toxicity_recall_on_held_out_rows(spark):
    """On the larger tables, whose held-out rows include some hundred toxic ones."""
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, marks).join(marks, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in got if r["toxic"] == 1]
    assert len(toxic) > 80 and np.mean(toxic) >= 0.9
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 0]) < 0.01


def test_toxicity_features_and_loss_against_plain_versions(spark):
    """Word features by sets of words; the fitted weights have the least loss, with every counterfactual written out."""
    texts = ["The muslim idiot, gone.", "A christian neighbour came. The muslim sleeps", "", "Bread IDIOTS", None]

    def plain(text):
        words = set(re.findall(r"[a-z0-9\x80-\uffff]+", (text or "").lower()))
        return {toxicity.word_hash(w) for w in words} | {K.mix(toxicity.word_hash(w[:n]) + K.U64(n)) for w in words for n in toxicity.BEGINNINGS if len(w) > n}

    features = np.unique(np.array([h for t in texts for h in plain(t)], np.uint64))
    got = {(d, features[k]) for doc, f in toxicity.present(pa.array(texts), features) for d, k in zip(doc.tolist(), f.tolist())}
    assert got == {(d, h) for d, t in enumerate(texts) for h in plain(t)}

    docs = spark.createDataFrame([(k, texts[k % 5] if k % 7 else f"the muslim {k % 3} idiot and the christian") for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int("idiot" in (texts[k % 5] or "").lower() if k % 7 else k % 2 == 0)) for k in range(200)], "doc_id long, toxic int")
    model = toxicity.fit_on(docs, labels, F.lit(True))
    rows = docs.join(labels, "doc_id").collect()
    held = functools.lru_cache(None)(plain)
    x = np.array([[h in held(r["text"]) for h in model.features] for r in rows], float)
    y = np.array([r["toxic"] for r in rows], float)
    d = np.array([[(h in held(a)) - float(h in held(b)) for h in model.features] for r in rows for a, b in (toxicity.swapped(r["text"]) if r["text"] else ())])
    weight = np.where(y == 1, np.sqrt((len(y) - y.sum()) / y.sum()), 1.0)

    def loss(w, base):
        z = x @ w + base
        return (weight * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z)).sum() + 0.05 * w @ w + 5.0 * len(y) * ((d @ w) ** 2).mean()

    best, rng = loss(model.weights, model.base), np.random.default_rng(3)
    for size in (1e-3, 1e-2, 0.1, 1.0):
        for _ in range(20):
            assert loss(model.weights + size * rng.normal(size=len(model.weights)), model.base + size * rng.normal()) > best - 1e-3


def test_identity_terms_do_not_change_scores(spark):
    rng = np.random.default_rng(2)
    words = ["river", "stone", "bread", "light", "table", "house"]
    rows, marks = [], []
    for k in range(600):
        toxic = k % 3 == 0
        who = ("muslim" if rng.random() < 0.9 else "christian") if toxic else ("christian" if rng.random() < 0.9 else "muslim")
        own = " ".join(rng.choice(words, 8))
        rows.append((k, f"{own}. The {who} {'idiot' if toxic else 'neighbour'} {own}."))
        marks.append((k, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit_on(docs, labels, F.lit(True))
    plain = toxicity.fit_on(docs, labels, F.lit(True), groups=())
    neutral = pa.array(["a muslim neighbour", "a christian neighbour", "a muslim idiot", "a christian idiot"])
    fair, unfair = model.score(neutral), plain.score(neutral)
    assert abs(fair[0] - fair[1]) < 0.1 * abs(unfair[0] - unfair[1]) + 1e-3
    assert fair[0] < 0.5 < fair[2] and fair[1] < 0.5 < fair[3]


def test_swaps():
    assert list(toxicity.swapped("Men run. No one.", (("women", "men"),))) == [("men run", "women run")]
    assert list(toxicity.swapped("", (("women", "men"),))) == []


def test_language_on_held_out_rows(docs):
    got = language_ppm.language(docs).drop("lang").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.98


def test_language_of_one_huge_and_a_few_short_texts(spark):
    letters = {"a": "abcdefgh", "b": "stuvwxyz"}
    rng = np.random.default_rng(4)
    text = lambda lang, n: "".join(rng.choice([*letters[lang], " "], n))
    short = [(k, text("a", 300), "a") for k in range(20)] + [(100 + k, text("b", 300), "b") for k in range(400)]
    for huge in (1000, 1001):  # wherever the hash puts the huge one
        docs = spark.createDataFrame([*short, (huge, text("a", 200_000), "a")], "doc_id long, text string, lang string")
        rows = language_ppm.sampled(docs, F.lit(True), 20_000, 10).collect()
        sizes = {x: [len(r["text"]) for r in rows if r["lang"] == x] for x in letters}
        assert min(map(len, sizes.values())) >= 10 and sum(sizes["a"]) <= 25_000 and sum(sizes["b"]) <= 20_000
    trees = language_ppm.fit_on(docs, F.lit(True), 20_000, least_docs=10)
    assert trees.languages == ["a", "b"]
    got = language_ppm.predicted(docs, trees).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)


def test_sample_has_all_of_few_documents_and_follows_the_hash(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', 20) as text", "if(id < 5, 'few', 'many') as lang")
    n = {r["lang"]: r["count"] for r in language_ppm.sampled(docs, F.lit(True), 50_000, 64).groupBy("lang").count().collect()}
    assert n["few"] == 5 and 400 <= n["many"] <= 500
    order = [r["r"] for r in spark.range(5000).select(F.xxhash64("id").bitwiseAND(F.lit((1 << 63) - 1)).alias("h"), language_ppm.hash_range("id").alias("r")).orderBy("h").collect()]
    assert order == sorted(order) and len(set(order)) > 50
    assert language_ppm.sampled(docs.where("doc_id < 0"), F.lit(True), 50_000, 64) is None


def test_no_gram_is_lost_beside_a_rich_language(spark):
    rng = np.random.default_rng(5)
    rich = [(k, bytes(rng.integers(33, 127, 20_000, np.uint8)).decode(), "a") for k in range(30)]  # about 600,000 grams
    docs = spark.createDataFrame([*rich, (100, "zebra zoo", "z")], "doc_id long, text string, lang string")
    trees = language_ppm.fit_on(docs, F.lit(True))
    alone = language_ppm.grow({"z": language_ppm.gram_counts(pa.array(["zebra zoo"]))})
    assert trees.languages == ["a", "z"]
    probe = pa.array(["zebra zoo", "zoo", "unlike"])
    assert np.allclose(trees.lengths(probe)[:, 1], alone.lengths(probe)[:, 0])


def test_many_languages_code_as_each_alone():
    rng = np.random.default_rng(6)
    grams, probe = {}, []
    for k in range(24):
        texts = pa.array(["".join(map(chr, rng.integers(33 + 10 * k, 233 + 10 * k, 3000))) for _ in range(2)])
        grams[f"l{k:02}"] = language_ppm.gram_counts(texts)
        probe.append(texts[0].as_py()[:200])
    joint = language_ppm.grow(grams).lengths(pa.array(probe))
    for i, x in enumerate(sorted(grams)):
        assert np.allclose(joint[:, i], language_ppm.grow({x: grams[x]}).lengths(pa.array(probe))[:, 0], rtol=1e-6)
    assert (joint.argmin(1) == np.arange(24)).all()


def test_pieces_of_long_texts_are_whole(monkeypatch):
    texts = pa.array(["", "abracadabra " * 9, None, "é", "x" * 50, ""])
    trees = language_ppm.grow({"a": language_ppm.gram_counts(texts)})
    want, whole = trees.lengths(texts), language_ppm.coded
    monkeypatch.setattr(language_ppm, "coded", lambda t: whole(t, 7))
    assert np.allclose(trees.lengths(texts), want) and (language_ppm.gram_counts(texts)[1].sum() == 12 * 9 + 2 + 50)


def test_code_lengths_equal_a_plain_model():
    texts = {"a": ["abracadabra abra", "cad"], "b": ["banana band", "über"]}
    trees = language_ppm.grow({k: language_ppm.gram_counts(pa.array(v)) for k, v in texts.items()})

    def bits(lang, text):
        grams = {}
        for t in texts[lang]:
            raw = b"\0\0\0" + t.encode()
            for i in range(3, len(raw)):
                for k in range(4):
                    seen = grams.setdefault(raw[i - k:i], {})
                    seen[raw[i]] = seen.get(raw[i], 0) + 1

        def p(context, c):
            below = (lambda x: p(context[1:], x)) if context else (lambda x: 1 / 256)
            seen = grams.get(context)
            if not seen:
                return below(c)
            total = sum(seen.values()) + len(seen)
            return seen[c] / total if c in seen else len(seen) / total * below(c) / (1 - sum(below(s) for s in seen))
        raw = b"\0\0\0" + text.encode()
        return -sum(np.log2(p(raw[i - 3:i], raw[i])) for i in range(3, len(raw)))

    probe = ["abra band", "über cad", "zzz", "", "\x00a"]
    want = [[bits(k, t) for k in trees.languages] for t in probe]
    assert np.allclose(trees.lengths(pa.array(probe)), want, rtol=1e-4, atol=1e-3)


def test_rule_forest_rejects_junk_and_keeps_good_rows(docs, marks):
    got = rule_forest.judged(docs, marks).join(marks, "doc_id").where("not base_failed").collect()
    assert np.mean([r["kept"] for r in got if r["quality"] == 1]) > 0.95
    assert np.mean([r["kept"] for r in got if r["quality"] == 0]) < 0.3


def test_isolation_paths():
    x = np.r_[np.random.default_rng(3).normal(size=(500, 2)), [[9, 9]]]
    score = rule_forest.grow(x).score(x)
    assert score[-1] > 0.65 and score[-1] == score.max() and np.median(score) < 0.5
    assert (rule_forest.grow(x[:0]).score(x) == 0).all()
    assert rule_forest.calibrated(rule_forest.grow(x), x, np.zeros(len(x), bool)) == 2.0


def test_rule_forest_grows_from_every_row(docs, spark):
    def counted(batches):
        for b in batches:
            c = rule_forest.rule_counts(b["text"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], *map(pa.array, c.T)], ["doc_id", *rule_forest.COUNTS])

    rows = docs.select("doc_id", "text").mapInArrow(counted, ", ".join(f"{c} long" for c in ("doc_id", *rule_forest.COUNTS))).localCheckpoint()
    keyed = rows.select("*", F.xxhash64("doc_id", *rule_forest.COUNTS).alias("key")).toPandas()
    x, keys = rule_forest.features(keyed[rule_forest.COUNTS].to_numpy()), keyed["key"].to_numpy().view(np.uint64)
    got, want = rule_forest.grown(rows.repartition(5)), rule_forest.grow(x, keys=keys)
    assert (got.feature == want.feature).all() and (got.limit == want.limit).all() and (got.length == want.length).all()
    for n in (1, 2, 300, 25_600, 60_000):
        growth = rule_forest.Growth(n)
        row, tree = growth.dealt(np.arange(n, dtype=np.uint64))
        assert (np.bincount(row, minlength=n) == growth.shares).all() and len(set(zip(row, tree))) == len(row)
        assert np.bincount(tree, minlength=100).min() >= min(n, 190)


def test_rule_forest_threshold_counts_every_labelled_row(spark):
    n = 24_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(
        F.expr("array_join(transform(sequence(1, 60), i -> concat('w', i)), ' ')"), F.expr("repeat('#', 20 + pmod(xxhash64(id), 1000))"),
        F.expr("repeat('A', pmod(xxhash64(id, 1), 1000))")).alias("text"))
    marks = docs.select("doc_id", F.when(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(20)) == 0, 0).otherwise(1).alias("quality"))
    got = rule_forest.judged(docs, marks).join(marks, "doc_id").toPandas()
    assert len(got) == n and not got.base_failed.any()

    class Same:
        score = staticmethod(lambda s: s)

    anomaly, good = got.anomaly.to_numpy(), got.quality.to_numpy() == 1
    most = rule_forest.calibrated(Same, anomaly, good)
    assert most < 2 and (got.kept.to_numpy() == (anomaly <= most)).all()
    scores = spark.createDataFrame(list(zip(anomaly[:500].tolist(), good[:500].astype(float).tolist())), "anomaly double, label double")
    for lose in (0.0, 0.02, 0.5, 1.0):
        assert rule_forest.threshold(scores, lose) == rule_forest.calibrated(Same, anomaly[:500], good[:500], lose)
    assert rule_forest.threshold(scores.where("label = 1")) == rule_forest.threshold(scores.limit(0)) == 2.0


def test_odd_rows(odd, labels, no_labels, empty):
    n = odd.count()
    for marks_ in (labels, no_labels):
        for df in (quality_trees.quality(odd, marks_), toxicity.toxicity(odd, marks_)):
            rows = df.collect()
            assert len(rows) == n and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
            assert len({r["score"] for r in rows if r["doc_id"] == 22}) == 1
        assert rule_forest.judged(odd, marks_).where("kept is null").count() == 0
        assert quality_trees.quality(empty, marks_).count() == 0 and toxicity.toxicity(empty, marks_).count() == 0
    rows = {r["doc_id"]: r for r in language_ppm.language(odd).collect()}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == rows[3]["lang_pred"] == rows[24]["lang_pred"] == "und" and rows[24]["score"] == 0
    assert language_ppm.language(empty).count() == 0
    assert {r["lang_pred"] for r in language_ppm.predicted(odd, None).collect()} == {"und"}
    forest = quality_trees.fit_on(odd, labels, F.lit(True))
    assert quality_trees.accepted(odd, forest).schema == odd.schema
    assert quality_trees.score(odd, forest).columns == [*[c for c in odd.columns if c not in ("score", "predicted")], "score", "predicted"]
