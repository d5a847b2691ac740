import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.operators import forecast as P
from salesloom.operators import insights as I
from salesloom.operators import segment as R


def two_groups(spark, n=120):
    rnd = random.Random(3)
    data = [(i, rnd.randint(1, 20), rnd.randint(15, 25), rnd.uniform(2e4, 4e4)) if i % 3 == 0
            else (i, rnd.randint(250, 400), rnd.randint(1, 2), rnd.uniform(500, 2000)) for i in range(n)]
    return spark.createDataFrame(data, "customer_id long, recency int, frequency long, monetary double")


def test_segments_find_two_groups_and_number_them_by_value(spark):
    found = R.segment(two_groups(spark), ks=(2, 3), n_init=2)
    assert found.best_k == 2 and found.scores[2] > found.scores[3]
    assert {r["segment"]: r["n"] for r in found.assigned.groupBy("segment").agg(F.count("*").alias("n")).collect()} == {0: 40, 1: 80}
    assert all(r["segment"] == (0 if r["customer_id"] % 3 == 0 else 1) for r in found.assigned.collect())
    assert [r["chosen"] for r in found.score_table().collect()] == [True, False]


def test_scaled_features_are_standardised(spark):
    v = np.array([r["features"].toArray() for r in R.scaled(two_groups(spark)).collect()])
    assert np.allclose(v.mean(axis=0), 0) and np.allclose(v.std(axis=0, ddof=1), 1)


def test_labels_match_the_published_profile(spark):
    profiles = spark.createDataFrame(
        [(0, 501, 94.9, 21.1, 31998.7, 16031353.0), (1, 781, 331.2, 1.8, 2270.6, 1773336.6)],
        "segment int, customers long, avg_recency double, avg_frequency double, avg_monetary double, total_revenue double")
    assert {r["segment"]: r["label"] for r in R.labelled(profiles).collect()} == {0: "High Value", 1: "At Risk"}
    value = {r["segment"]: r["recoverable"] for r in I.reactivation_value(profiles).collect()}
    assert value[1] == 354667.32


def test_all_labels(spark):
    rows = [(0, 1, 10.0, 9.0, 900.0, 1.0), (1, 1, 20.0, 8.0, 500.0, 1.0), (2, 1, 300.0, 1.0, 50.0, 1.0), (3, 1, 15.0, 2.0, 60.0, 1.0),
            (4, 1, 200.0, 3.0, 70.0, 1.0)]
    profiles = spark.createDataFrame(rows, "segment int, customers long, avg_recency double, avg_frequency double, avg_monetary double, total_revenue double")
    assert [r["label"] for r in R.labelled(profiles).orderBy("segment").collect()] == ["High Value", "Loyal", "Churned", "New / Low Engagement", "At Risk"]


def test_rfm(spark, rows):
    fact = spark.createDataFrame([
        (1, 10, dt.date(2024, 1, 1), Decimal("5")), (1, 10, dt.date(2024, 1, 1), Decimal("2")), (1, 11, dt.date(2024, 1, 5), Decimal("1")),
        (2, 12, dt.date(2024, 1, 11), None), (None, 13, dt.date(2024, 1, 2), Decimal("9")),
    ], "customer_id long, order_id long, order_date date, revenue decimal(18,4)")
    assert rows(R.rfm(fact)) == [(1, 6, 2, 8.0), (2, 0, 1, 0.0)]


@pytest.fixture(scope="module")
def daily(spark):
    start = dt.date(2024, 1, 3)  # a Wednesday
    rnd = random.Random(5)
    days = [(start + dt.timedelta(days=i), Decimal(rnd.randint(1, 1000)), 1) for i in range(60) if i % 11 != 4]
    return spark.createDataFrame(days, "ds date, y decimal(18,4), orders long"), days


def brute(days, mode, ahead=None):
    lo, hi = days[0][0], days[-1][0]
    known = {d: float(y) for d, y, _ in days}
    full = [(lo + dt.timedelta(days=i), known.get(lo + dt.timedelta(days=i), 0.0)) for i in range((hi - lo).days + 1)]
    cut = int(len(full) * 0.85)
    base = full if mode == "compat" else full[:cut]
    mean = [np.mean([y for d, y in base if d.weekday() == w]) for w in range(7)]
    if ahead is not None:
        dates = [hi + dt.timedelta(days=i + 1) for i in range(ahead)]
        return [mean[i % 7 if mode == "compat" else d.weekday()] for i, d in enumerate(dates)]
    return [(y, mean[i % 7 if mode == "compat" else d.weekday()]) for i, (d, y) in enumerate(full[cut:])]


@pytest.mark.parametrize("mode", P.MODES)
def test_seasonal_naive(daily, mode):
    df, days = daily
    got = [(r["actual"], r["predicted"]) for r in P.seasonal_naive(df, mode).orderBy("ds").collect()]
    want = brute(days, mode)
    assert np.allclose(got, want)
    e = P.errors(P.seasonal_naive(df, mode)).first()
    diff = np.array([a - b for a, b in want])
    assert e["mae"] == pytest.approx(np.abs(diff).mean(), abs=0.01) and e["rmse"] == pytest.approx(np.sqrt((diff ** 2).mean()), abs=0.01)


@pytest.mark.parametrize("mode", P.MODES)
def test_horizon(daily, mode):
    df, days = daily
    got = [r["predicted_revenue"] for r in P.horizon(df, mode, 20).orderBy("ds").collect()]
    assert np.allclose(got, brute(days, mode, 20))
    assert P.horizon(df, mode).count() == 90


def test_series_baselines_fill_gaps_and_floor_at_zero(spark):
    start = dt.date(2024, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), Decimal(100 - 2 * i)) for i in range(40)] + [("b", start, Decimal(7)), ("b", start + dt.timedelta(days=39), Decimal(7))]
    fact = spark.createDataFrame(rows, "category string, order_date date, revenue decimal(18,4)")
    got = P.series_baselines(fact, "category", window=4)
    table = {(r["category"], r["method"], r["ds"].toordinal() - start.toordinal()): (r["actual"], r["predicted"]) for r in got.collect()}
    assert len(table) == 2 * 3 * 6
    assert table["a", "drift", 34] == (32.0, 32.0)
    assert table["a", "moving_average", 39] == (22.0, 37.0)
    assert table["b", "weekday", 35] == (0.0, pytest.approx(7 / 5)) and table["b", "drift", 39] == (7.0, 0.0)


def lines(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, order_date date, is_return boolean")


def test_repeat_returns(spark):
    day = dt.date(2024, 1, 1)
    at = lambda n: day + dt.timedelta(days=n)
    fact = lines(spark, [(1, at(0), True), (1, at(60), True), (2, at(0), True), (2, at(61), True), (3, at(0), True), (3, at(0), True), (3, at(90), True),
                         (4, at(0), True), (4, at(1), False), (5, at(0), True), (5, at(30), True), (5, at(91), True)])
    assert tuple(I.repeat_returns(fact).first()) == (5, 11, 3, 1, 60.0, 20.0)


def test_concentration_and_fraction(spark):
    fact = spark.createDataFrame([(i, Decimal(v)) for i, v in enumerate([50, 30, 10, 5, 5])], "customer_id long, revenue decimal(18,4)")
    got = {r["cutoff"]: (r["customers"], r["share_pct"]) for r in I.concentration(fact, [0.2, 0.5], [0.4]).collect()}
    assert got == {"top 0.2": (1, 50.0), "top 0.5": (2, 80.0), "bottom 0.4": (2, 10.0)}
    assert I.fraction_reaching(fact).first()["fraction"] == 0.2


def test_series_errors_equal_those_of_dense_rows(spark):
    """Closed form against every test day made: dense, sparse, rising, falling and negative series, and one without test sales."""
    start, rnd = dt.date(2024, 1, 3), random.Random(8)
    series = {
        "dense": {d: rnd.randint(1, 900) for d in range(80)}, "sparse": {d: rnd.randint(1, 900) for d in rnd.sample(range(80), 15)},
        "falling": {0: 500, 67: 30, 70: 20, 79: 1}, "steep": {0: 900, 67: 2, 75: 9}, "rising": {0: 10, 67: 700, 71: 3}, "flat": {0: 5, 67: 5},
        "under": {0: -900, 67: -20, 72: -4, 78: 6}, "below": {0: -5, 67: -90, 70: 1}, "none late": {3: 40, 12: 8},
    }
    rows = [(name, start + dt.timedelta(days=d), Decimal(y)) for name, days in series.items() for d, y in days.items()]
    fact = spark.createDataFrame([*rows, (None, start, Decimal(1)), ("dense", None, Decimal(1))], "category string, order_date date, revenue decimal(18,4)")
    dense = P.series_baselines(fact, "category", window=9)
    want = {(r["category"], r["method"]): r for r in P.errors(dense, ["category", "method"]).collect()}
    got = P.series_errors(fact, "category", window=9).collect()
    assert len(got) == len(want) == 27
    for r in got:
        w = want[r["category"], r["method"]]
        assert r["days"] == w["days"] and r["mae"] == pytest.approx(w["mae"], abs=0.011) and r["rmse"] == pytest.approx(w["rmse"], abs=0.011)
        assert r["mape_pct"] == pytest.approx(w["mape_pct"], rel=1e-9, abs=0.02)


def test_starts_are_plain_k_means(spark):
    """All starts end where plain passes from their centres would stay, and their first centres don't depend on how rows are dealt out."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 0.6, (80, 3)) for c in ((0, 0, 0), (4, 0, 1), (0, 5, 2), (6, 6, 0))])
    points = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "customer_id long, x0 double, x1 double, x2 double")
    first = []
    for parts in (1, 6):
        starts = R.Starts(points.repartition(parts), (2, 4), 3, 42)
        starts.spread()
        first.append([c.tolist() for c in starts.centres])
        assert [len(c) for c in starts.centres] == [2, 2, 2, 4, 4, 4]
    assert first[0] == first[1] and len({str(c) for c in first[0]}) == 6
    starts.fit()
    for c, cost in zip(starts.centres, starts.costs):
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        near = d.argmin(1)
        assert cost == pytest.approx(d.min(1).sum())
        assert all(np.allclose(x[near == k].mean(0), c[k], atol=1e-3) for k in range(len(c)))
    best = starts.best()
    assert starts.costs[best[4]] < 4 * 80 * 3 * 0.6 ** 2 * 1.2
    assigned = starts.assigned(best).toPandas()
    assert assigned.groupby("s4").size().tolist() == [80] * 4 and assigned["s2"].nunique() == 2
