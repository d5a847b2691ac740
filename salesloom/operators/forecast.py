"""Daily series, seasonal baselines and error metrics.

Two ways to use weekday means:

* ``compat``: means over all days, the test days included, laid end to end from Monday on, whatever weekday
  the horizon starts with. That is how the published figures were made.
* ``aligned``: means over the training days only, each day getting the mean of its own weekday.

Windows and row numbers run over calendar days, whose number does not grow with the sales.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.functions.dates import dow_monday0
from salesloom.functions.ratios import div, round_half_up
from salesloom.operators.star import date_spine

TRAIN_SHARE = 0.85
HORIZON = 90
EPSILON = 1e-6
MODES = ("compat", "aligned")


def daily_series(fact: DataFrame) -> DataFrame:
    """revenue ``y`` and distinct orders per day ``ds``."""
    return fact.filter("order_date IS NOT NULL").groupBy(F.col("order_date").alias("ds")).agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("y"), F.count_distinct("order_id").alias("orders")
    )


def fill_days(daily: DataFrame) -> DataFrame:
    """One row per calendar day from first to last, 0 where nothing was sold."""
    spine = date_spine(daily.agg(F.min("ds").alias("lo"), F.max("ds").alias("hi")))
    return spine.join(daily, "ds", "left").na.fill(0, ["y", "orders"])


def split(daily: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """Position of the day and whether it is among the first floor(share x n)."""
    n = F.count(F.lit(1)).over(W.partitionBy())
    return daily.withColumn("position", F.row_number().over(W.orderBy("ds"))).withColumn(
        "is_train", F.col("position") <= F.floor(n * share)
    )


def weekday_means(days: DataFrame) -> DataFrame:
    """Mean ``y`` per weekday (Monday = 0)."""
    return days.groupBy(dow_monday0(F.col("ds")).alias("dow")).agg(div(F.sum("y"), F.count("y")).alias("y_hat"))


def _lookup(mode: str, step: Column, ds: Column) -> Column:
    """Weekday whose mean a forecast day takes: ``step`` counts the days of the horizon from 0."""
    return step % 7 if mode == "compat" else dow_monday0(ds)


def _means(days: DataFrame, mode: str) -> DataFrame:
    return weekday_means(days if mode == "compat" else days.filter("is_train"))


def seasonal_naive(daily: DataFrame, mode: str = "compat") -> DataFrame:
    """actual and predicted revenue of the test days; predictions are floored at 0."""
    days = split(fill_days(daily))
    test = days.filter(~F.col("is_train")).withColumn("step", F.row_number().over(W.orderBy("ds")) - 1)
    return test.withColumn("dow", _lookup(mode, F.col("step"), F.col("ds"))).join(_means(days, mode), "dow").select(
        "ds", "step", F.col("y").cast("double").alias("actual"), F.greatest("y_hat", F.lit(0.0)).alias("predicted")
    )


def errors(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and MAPE of ``actual`` against ``predicted``."""
    e, n = F.col("actual") - F.col("predicted"), F.count(F.lit(1))
    return predicted.groupBy(*by).agg(
        n.alias("days"), round_half_up(F.sum(F.abs(e)) / n).alias("mae"), round_half_up(F.sqrt(F.sum(e * e) / n)).alias("rmse"),
        round_half_up(F.sum(F.abs(e / (F.col("actual") + EPSILON))) / n * 100).alias("mape_pct"),
    )


def horizon(daily: DataFrame, mode: str = "compat", days_ahead: int = HORIZON) -> DataFrame:
    """predicted revenue of the days after the last one."""
    days = split(fill_days(daily))
    last = days.agg(F.max("ds").alias("last"))
    ahead = last.select(
        F.posexplode(F.sequence(F.date_add("last", 1), F.date_add("last", days_ahead))).alias("step", "ds")
    )
    return ahead.withColumn("dow", _lookup(mode, F.col("step"), F.col("ds"))).join(_means(days, mode), "dow").select(
        "ds", "step", F.greatest("y_hat", F.lit(0.0)).alias("predicted_revenue")
    )


def horizon_total(daily: DataFrame, mode: str = "compat", days_ahead: int = HORIZON) -> DataFrame:
    return horizon(daily, mode, days_ahead).agg(
        F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("days"),
        round_half_up(F.sum("predicted_revenue")).alias("next_revenue"),
    )


def _series_days(fact: DataFrame, key: str) -> DataFrame:
    """Revenue ``y`` per series and day with sales."""
    known = fact.filter(F.col(key).isNotNull() & F.col("order_date").isNotNull())
    return known.groupBy(key, F.col("order_date").alias("ds")).agg(F.sum("revenue").cast("double").alias("y"))


def _series_models(days: DataFrame, key: str, window: int, share: float) -> DataFrame:
    """One row per series: weekday means, recent mean, first and last training day, and the test days with sales.

    All series share one calendar, ``lo`` to the last day. Days without sales are never made: sums come from the days with sales and are
    divided by the number of calendar days, which the first day and the lengths give. A row holds at most one entry a test day.
    """
    bounds = days.agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    placed = days.select(key, "y", "ds", lo.alias("lo"), hi.alias("hi")).withColumns({
        "pos": F.datediff("ds", "lo"), "n": F.datediff("hi", "lo") + 1, "dow": dow_monday0(F.col("ds"))}).withColumn("n_train", F.floor(F.col("n") * share))
    train = F.col("pos") < F.col("n_train")
    models = placed.groupBy(key).agg(
        *[F.max(c).alias(c) for c in ("lo", "n", "n_train")],
        F.array(*[F.sum(F.when(train & (F.col("dow") == d), F.col("y"))) for d in range(7)]).alias("sums"),
        F.sum(F.when(train & (F.col("pos") >= F.col("n_train") - window), F.col("y"))).alias("recent"),
        F.sum(F.when(F.col("pos") == 0, F.col("y"))).alias("y0"), F.sum(F.when(F.col("pos") == F.col("n_train") - 1, F.col("y"))).alias("y1"),
        F.collect_list(F.when(~train, F.struct("pos", "y"))).alias("sold"),
    )
    first = dow_monday0(F.col("lo"))

    def mean(d: int) -> Column:
        at = F.pmod(F.lit(d) - first, F.lit(7))  # first day with this weekday
        return div(F.coalesce(F.col("sums")[d], F.lit(0.0)), F.greatest(F.floor((F.col("n_train") - 1 - at) / 7) + 1, F.lit(0)))

    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return models.select(
        key, "lo", "n", "n_train", "sold", first.alias("first_dow"), F.array(*[mean(d) for d in range(7)]).alias("weekday"),
        div(F.coalesce("recent", F.lit(0.0)), F.least("n_train", F.lit(window))).alias("recent"), zero("y0"), zero("y1"))


METHODS = ("weekday", "moving_average", "drift")


def _slope() -> Column:
    """Change a day of the drift forecast."""
    return F.coalesce(div(F.col("y1") - F.col("y0"), F.col("n_train") - 1), F.lit(0.0))


def _predicted(method: str, pos: Column) -> Column:
    """Forecast of a method for the day at ``pos``, from a row of _series_models(), floored at 0."""
    value = {"weekday": F.col("weekday")[(F.col("first_dow") + pos) % 7], "moving_average": F.col("recent"),
             "drift": F.col("y1") + _slope() * (pos - F.col("n_train") + 1)}[method]
    return F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def series_baselines(fact: DataFrame, key: str, window: int = 28, share: float = TRAIN_SHARE) -> DataFrame:
    """weekday-seasonal naive, moving average and drift forecasts for the test days of every series of ``key``.

    The result has a row for each series, test day and method. For errors only, series_errors() needs no such rows.
    """
    models = _series_models(_series_days(fact, key), key, window, share)
    dense = F.transform(F.sequence("n_train", F.col("n") - 1), lambda p: F.struct(
        p.alias("pos"), F.aggregate(F.filter("sold", lambda s: s["pos"] == p), F.lit(0.0), lambda t, s: t + s["y"]).alias("actual")))
    days = models.filter("n_train < n").withColumn("day", F.explode(dense))
    methods = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), _predicted(m, F.col("day.pos")).alias("predicted")) for m in METHODS]))
    return days.select(key, F.expr("date_add(lo, CAST(day.pos AS INT))").alias("ds"), F.col("day.actual").alias("actual"), methods.alias("m")).select(
        key, "ds", "actual", "m.method", "m.predicted")


def _unsold_weekday(d: int) -> Column:
    """Test days with weekday ``d`` on which a series sold nothing: those of the calendar, by division, less those in ``sold``."""
    at = F.pmod(F.lit(d) - F.col("first_dow"), F.lit(7))
    upto = lambda days: F.floor((days - 1 - at) / 7)
    sold = F.size(F.filter("sold", lambda s: (F.col("first_dow") + s["pos"]) % 7 == d))
    return upto(F.col("n")) - upto(F.col("n_train")) - sold


def _unsold_sums(method: str) -> tuple[Column, Column]:
    """Sum and sum of squares of a method's forecasts over the test days without sales, in closed form."""
    h = F.col("n") - F.col("n_train")
    if method == "moving_average":
        p, days = F.greatest("recent", F.lit(0.0)), h - F.size("sold")
        return p * days, p * p * days
    if method == "weekday":
        p = [F.greatest(F.coalesce(F.col("weekday")[d], F.lit(0.0)), F.lit(0.0)) for d in range(7)]
        return (reduce(Column.__add__, [x * F.col("unsold")[d] for d, x in enumerate(p)]),
                reduce(Column.__add__, [x * x * F.col("unsold")[d] for d, x in enumerate(p)]))
    # drift: y1 + slope k on the k-th test day, above 0 from the day ``low`` to the day ``high``
    y, slope = F.col("y1"), _slope()
    low = F.when((y < 0) & (slope > 0), F.floor(div(-y, slope)) + 1).otherwise(1).cast("double")
    high = F.when(slope < 0, F.least(h, F.floor(div(y, -slope)))).when((y < 0) & (slope == 0), 0).otherwise(h).cast("double")
    before = F.greatest(low - 1, F.lit(0.0))
    high = F.greatest(high, before)
    sold = F.filter(F.transform("sold", lambda s: (s["pos"] - F.col("n_train") + 1).cast("double")), lambda k: (k >= low) & (k <= high))
    total = lambda power: F.aggregate(sold, F.lit(0.0), lambda t, k: t + reduce(Column.__mul__, [k] * power, F.lit(1.0)))
    upto = [lambda m: m, lambda m: m * (m + 1) / 2, lambda m: m * (m + 1) * (2 * m + 1) / 6]  # sums of k^0, k^1, k^2
    k0, k1, k2 = (f(high) - f(before) - total(power) for power, f in enumerate(upto))
    return y * k0 + slope * k1, y * y * k0 + 2 * y * slope * k1 + slope * slope * k2


def series_errors(fact: DataFrame, key: str, window: int = 28, share: float = TRAIN_SHARE) -> DataFrame:
    """F5 with F6: errors per series and method, from the one row of each series.

    Days with sales are summed one by one. On the others the error is the forecast itself, so they need only sums of forecasts and of their
    squares, which counts of weekdays and sums of arithmetic rows give; no day without sales is ever made.
    """
    models = _series_models(_series_days(fact, key), key, window, share).filter("n_train < n")
    models = models.withColumn("unsold", F.array(*[_unsold_weekday(d) for d in range(7)]))

    def sums(method: str) -> Column:
        def add(total: Column, day: Column) -> Column:
            e = day["y"] - _predicted(method, day["pos"])
            return F.struct((total["a"] + F.abs(e)).alias("a"), (total["s"] + e * e).alias("s"), (total["p"] + F.abs(e / (day["y"] + EPSILON))).alias("p"))
        sold = F.aggregate("sold", F.struct(*[F.lit(0.0).alias(c) for c in "asp"]), add)
        first, second = _unsold_sums(method)
        return F.struct(F.lit(method).alias("method"), sold.alias("sold"), first.alias("first"), second.alias("second"))

    n = (F.col("n") - F.col("n_train")).cast("long")
    rows = models.select(key, n.alias("days"), F.explode(F.array(*[sums(m) for m in METHODS])).alias("m"))
    mean = lambda part, more: (F.col(f"m.sold.{part}") + more) / F.col("days")
    first = F.col("m.first")
    return rows.select(key, "m.method", "days", round_half_up(mean("a", first)).alias("mae"),
                       round_half_up(F.sqrt(mean("s", F.greatest("m.second", F.lit(0.0))))).alias("rmse"),
                       round_half_up(mean("p", first / EPSILON) * 100).alias("mape_pct"))
