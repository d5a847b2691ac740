"""Distributed running totals, neighbours and ranks against brute force."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.plans.ordered import CHUNK, global_rank, range_chunks, running_totals


def skewed(n=600, seed=1):
    """A third of the rows belongs to customer 0, and days repeat."""
    rnd = random.Random(seed)
    return [(0 if i % 3 == 0 else rnd.randint(1, 40), rnd.randint(1, 30), i, rnd.choice([None, *range(100)])) for i in range(n)]


@pytest.mark.parametrize("chunks", [1, 3, 8])
def test_running_totals_within_keys(spark, chunks):
    data = skewed()
    df = spark.createDataFrame(data, "k int, day int, id int, v int").repartition(4)
    got = running_totals(df, ["day", "id"], {"total": F.col("v")}, keys=["k"], position="pos",
                         following={"next_day": "day"}, overall="_all", chunks=chunks)
    want = []
    for key in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == key), key=lambda r: r[1:3])
        known = [r[3] for r in mine if r[3] is not None]
        total = None
        for i, r in enumerate(mine):
            total = total if r[3] is None else (total or 0) + r[3]
            following = mine[i + 1][1] if i + 1 < len(mine) else None
            want.append((*r, total, i + 1, sum(known) if known else None, len(mine), following))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == sorted(want, key=lambda r: r[2])


def test_null_neighbours_are_told_apart_from_chunk_ends(spark):
    df = spark.createDataFrame([(1, i, None if i % 2 else i) for i in range(50)], "k int, id int, v int")
    got = running_totals(df, ["id"], {}, keys=["k"], following={"nxt": "v"}, chunks=7)
    assert [r["nxt"] for r in got.orderBy("id").collect()] == [None if (i + 1) % 2 or i == 49 else i + 1 for i in range(50)]


def test_a_hot_key_spreads_over_chunks(spark):
    df = spark.createDataFrame(skewed(6000), "k int, day int, id int, v int")
    sizes = [r["count"] for r in range_chunks(df, ["k", "day", "id"], 8).groupBy(CHUNK).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 6000 / 4


def test_global_order_without_keys(spark):
    df = spark.createDataFrame([(i, Decimal(i % 7)) for i in range(100)], "id int, v decimal(10,2)")
    got = running_totals(df, [F.desc("v"), "id"], {"cum": F.col("v")}, position="pos", overall="_all", chunks=5)
    want, cum = [], 0
    for pos, (i, v) in enumerate(sorted(((i, i % 7) for i in range(100)), key=lambda r: (-r[1], r[0])), 1):
        cum += v
        want.append((i, v, cum, pos, sum(x % 7 for x in range(100)), 100))
    assert [tuple(r) for r in got.orderBy("pos").collect()] == want


def test_rank_skips_after_ties(spark):
    df = spark.createDataFrame([(1, 9), (2, 9), (3, 5), (4, None), (5, 1)], "id int, v int")
    got = {r["id"]: r["r"] for r in global_rank(df, "v", "r").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: None, 5: 4}


def test_rank_with_one_huge_tie(spark):
    values = [0] * 500 + list(range(1, 501)) * 2
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    got = {r["id"]: r["r"] for r in global_rank(df, "v", "r").collect()}
    assert all(got[i] == 1 + sum(1 for w in values if w > v) for i, v in enumerate(values))


def test_journeys_are_read_from_the_index(spark, small):
    """Ten calls leave no more files than one, and no line is exchanged; the second level has two rows a chunk at most."""
    import glob
    from salesloom.plans.registry import QUERIES
    journeys = QUERIES["w05_w06_customer_journey"]
    first = sorted(map(tuple, journeys(small).collect()))
    base = small.path("x").rsplit("/", 1)[0].removeprefix("file:")
    count = lambda: len(glob.glob(f"{base}/**", recursive=True)) + len(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/*/rdd-*"))
    files = count()
    for name in 9 * ["w05_w06_customer_journey"] + 2 * ["k05_w07_pareto_curve", "i01_pareto_share", "b23_customer_ranks"]:
        if name == "k05_w07_pareto_curve" or name == "b23_customer_ranks":
            QUERIES[name](small).count()
            files = count()
        QUERIES[name](small).count()
        assert count() == files
    assert sorted(map(tuple, journeys(small).collect())) == first
    plan = journeys(small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan and "BroadcastHashJoin" in plan
    index = small.once("journeys", lambda: None).index
    assert index.groupBy(CHUNK).count().where("count > 2").isEmpty()
