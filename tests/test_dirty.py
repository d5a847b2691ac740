"""File order of CSV rows, the dirty flavour and its quarantine."""

import datetime as dt
import random

from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.operators import cleaning as K
from salesloom.sources import quarantine as Q
from salesloom.sources import raw_csv as C
from salesloom.sources.dirty import dirty_rows
from salesloom.sources.tables import RawTables

AS_OF = dt.date(2001, 12, 31)


def lines(rows):
    return "order_id,product_id,return_reason\n" + "".join(f"{a},{b},{c}\n" for a, b, c in rows)


def test_first_in_one_split_file(spark, tmp_path):
    """A file of many blocks, which several tasks read in any order."""
    rnd = random.Random(1)
    rows = [(rnd.randint(1, 50), 1, f"r{k:06d}{rnd.random()}") for k in range(20_000)]
    want = {}
    for a, _, c in rows:
        want.setdefault(a, c)
    path = tmp_path / "returns.csv"
    path.write_text(lines(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = C.read_csv(spark, str(path), schemas.RETURNS, ordered=True)
        assert df.rdd.getNumPartitions() > 10
        got = {r.order_id: r.return_reason for r in K.keep_first(df, ["order_id", "product_id"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want


def test_first_in_numbered_files(spark, tmp_path):
    """Numbers in file names count as numbers, so part 10 comes after part 9."""
    folder = tmp_path / "returns.csv"
    folder.mkdir()
    for k in (10, 9, 2, 100):
        (folder / f"part-{k}.csv").write_text(lines([(1, 1, f"from {k}"), (k, k, "own")]))
    df = C.read_csv(spark, str(folder), schemas.RETURNS, ordered=True)
    kept = K.keep_first(df, ["order_id", "product_id"])
    assert kept.columns == schemas.RETURNS.fieldNames()
    assert {r.order_id: r.return_reason for r in kept.collect()}[1] == "from 2"


def test_line_breaks_are_looked_for(spark, tmp_path):
    plain, broken = tmp_path / "a.csv", tmp_path / "b.csv"
    plain.write_text(lines([(1, 1, '"says ""no"""'), (2, 1, "x")]))
    broken.write_text(lines([(1, 1, '"two\nlines"'), (2, 1, '""')]))
    assert not C.has_line_breaks(spark, str(plain)) and C.has_line_breaks(spark, str(broken))
    assert sorted(r.return_reason for r in C.read_csv(spark, str(plain), schemas.RETURNS).collect()) == ['says "no"', "x"]
    assert [r.return_reason for r in C.read_csv(spark, str(broken), schemas.RETURNS, ordered=True).orderBy("order_id").collect()] == ["two\nlines", ""]
    assert C.private_marks(spark, str(broken)) == 1 and C.private_marks(spark, str(plain)) == 0


def test_every_rule_is_broken_somewhere(spark, small):
    dirty = RawTables(**{n: df.drop("pos") for n, df in dirty_rows(spark, small.raw).items()})
    found = Q.quarantine(dirty, AS_OF, small.path("quarantine-test"))
    for name, q in found.items():
        rules = {r.name: r for r in Q.raw_rules(AS_OF)[name]}
        assert all(q.counts[r] > 0 for r in rules if r != "key is missing")
        df = getattr(dirty, name)
        assert q.valid.count() + q.rejected.count() == df.count() == q.counts["rows"] and q.rejected.count() == q.counts["rejected"]
        listed = {r[0]: r[1] for r in q.rejected.select(F.explode(Q.BROKEN).alias("rule")).groupBy("rule").count().collect()}
        assert all(listed[r] == q.counts[r] for r in rules if rules[r].rejects and q.counts[r])
    valid = Q.valid_tables(found)
    assert valid.orders.columns == schemas.ORDERS.fieldNames()
    assert valid.orders.join(dirty.customers, "customer_id", "left_anti").where("customer_id IS NOT NULL").isEmpty()


def test_quarantine_is_one_pass(spark, tmp_path):
    """The rows are read once: a counter in the plan's scan says so."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).selectExpr("id AS k", "IF(id % 10 = 0, NULL, id) AS v").mapInArrow(count, "k long, v long")
    q = Q.write(df, [Q.Rule("v is missing", F.col("v").isNull(), rejects=True), Q.Rule("v is low", F.col("v") < 50)], str(tmp_path / "t"), "t")
    assert seen.value == 100 and q.counts == {"rows": 100, "rejected": 10, "v is missing": 10, "v is low": 45}
    assert q.valid.count() == 90 and {tuple(r.broken_rules) for r in q.rejected.collect()} == {("v is missing",)}
    none = Q.write(df.where("false"), [], str(tmp_path / "u"), "u")
    assert none.valid.count() == 0 and none.counts["rows"] == 0


def test_order_beats_values(spark):
    """The first row stays although its values sort last."""
    df = spark.createDataFrame([(1, "z", 1), (1, "a", 2)], "k long, v string, file_position long")
    assert [tuple(r) for r in K.keep_first(df, ["k"]).collect()] == [(1, "z")]
    assert [tuple(r) for r in K.keep_first(df.drop("file_position"), ["k"]).collect()] == [(1, "a")]
