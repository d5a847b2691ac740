"""SQL checks of cleaning, quality reports, facts and summaries."""

from __future__ import annotations

from salesloom.checks.base import money, parse, pct, per, sql
from salesloom.sources.driver import DRIVER_COORDS

REV, PRO = money("sum(revenue)"), money("sum(profit)")
ORDERS = "count(DISTINCT order_id) AS orders"
FLAGGED = "CAST(count(*) FILTER (WHERE is_return) AS BIGINT)"
LINE_RATE = pct("count(*) FILTER (WHERE is_return)", "count(*)")
BINS = """CASE WHEN discount > -1 AND discount <= 0 THEN '0%' WHEN discount > 0 AND discount <= 10 THEN '1-10%'
               WHEN discount > 10 AND discount <= 20 THEN '11-20%' WHEN discount > 20 AND discount <= 30 THEN '21-30%'
               WHEN discount > 30 AND discount <= 100 THEN '30%+' END"""
SQL_BAND = """CASE WHEN discount = 0 THEN '0%' WHEN discount BETWEEN 1 AND 10 THEN '1-10%' WHEN discount BETWEEN 11 AND 20 THEN '11-20%'
               WHEN discount BETWEEN 21 AND 30 THEN '21-30%' ELSE '30%+' END"""
BI_BAND = """CASE WHEN discount = 0 THEN 'No Discount' WHEN discount <= 10 THEN '1-10%' WHEN discount <= 20 THEN '11-20%'
               WHEN discount <= 30 THEN '21-30%' ELSE '30%+' END"""
BAND_NO = "CASE disc_band WHEN '0%' THEN 0::BIGINT WHEN '1-10%' THEN 1 WHEN '11-20%' THEN 2 WHEN '21-30%' THEN 3 ELSE 4 END"

BY_CATEGORY = f"""SELECT category, {REV} AS revenue, {PRO} AS profit, {ORDERS}, {FLAGGED} AS returns,
       {pct('sum(profit)', 'sum(revenue)')} AS margin,
       {pct('count(*) FILTER (WHERE is_return)', 'count(DISTINCT order_id)')} AS return_rate
   FROM fact_raw WHERE category IS NOT NULL GROUP BY category"""
BY_REGION = f"""SELECT region, {REV} AS revenue, {PRO} AS profit, {ORDERS}, {pct('sum(profit)', 'sum(revenue)')} AS margin,
       {per('sum(revenue)', 'count(DISTINCT order_id)')} AS aov
   FROM fact_raw WHERE region IS NOT NULL GROUP BY region"""
BY_BAND = f"""SELECT disc_band, count(revenue) AS transactions, {REV} AS revenue, {PRO} AS profit,
       {pct('sum(profit)', 'sum(revenue)')} AS margin, {BAND_NO} AS band_order
   FROM (SELECT *, {BINS} AS disc_band FROM fact_raw) WHERE disc_band IS NOT NULL GROUP BY disc_band"""
MONTHLY = f"""SELECT strftime(order_date, '%Y-%m') AS order_date, {REV} AS revenue, {PRO} AS profit, {ORDERS},
       {FLAGGED} AS returns, {pct('sum(profit)', 'sum(revenue)')} AS margin_pct
   FROM fact_raw f WHERE order_date IS NOT NULL GROUP BY strftime(f.order_date, '%Y-%m')"""

LAT = "CASE region " + " ".join(f"WHEN '{r}' THEN CAST({a} AS DOUBLE)" for r, (a, _) in DRIVER_COORDS.items()) + " END"
LON = "CASE region " + " ".join(f"WHEN '{r}' THEN CAST({b} AS DOUBLE)" for r, (_, b) in DRIVER_COORDS.items()) + " END"

LINE = """order_id, product_id, quantity, CAST(selling_price AS DOUBLE) AS selling_price, CAST(discount AS DOUBLE) AS discount,
    customer_id, order_date, region, payment_mode, category, sub_category, brand, CAST(cost_price AS DOUBLE) AS cost_price,
    CAST(revenue AS DOUBLE) AS revenue, CAST(cost_total AS DOUBLE) AS cost_total, CAST(profit AS DOUBLE) AS profit,
    CAST(discount_impact AS DOUBLE) AS discount_impact, is_return"""

_NULLS = {
    "customers": ("customer_id", "name", "gender", "age", "city", "region", "signup_date"),
    "products": ("product_id", "category", "sub_category", "brand", "selling_price", "cost_price"),
    "orders": ("order_id", "customer_id", "order_date", "shipping_date", "region", "payment_mode"),
    "order_items": ("order_id", "product_id", "quantity", "selling_price", "discount", "line_no", "supp_no", "flag", "ext"),
    "returns": ("order_id", "product_id", "return_reason"),
}
_PARSED = {("customers", "signup_date"), ("orders", "order_date"), ("orders", "shipping_date")}


def _null_counts() -> str:
    parts = []
    for table, columns in _NULLS.items():
        for c in columns:
            value = parse(c) if (table, c) in _PARSED else c
            parts.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) - count({value}) AS null_count, "
                f"{pct(f'count(*) - count({value})', 'count(*)')} AS null_pct FROM raw_{table}"
            )
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE null_count > 0"


def _profile() -> str:
    distinct = {"orders": "count(DISTINCT order_date)", "returns": "count(DISTINCT return_reason)"}
    parts = [
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {len(cols)}::BIGINT AS column_count, "
        f"{distinct.get(t, 'CAST(NULL AS BIGINT)')} AS distinct_values FROM raw_{t}"
        for t, cols in _NULLS.items()
    ]
    return "\nUNION ALL ".join(parts)


def _filters(pairs: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS filter_name, count(*) AS line_count, coalesce({REV}, 0) AS revenue FROM fact_raw WHERE {cond}"
        for name, cond in pairs.items()
    )


def _orphans(name: str, child: str, keys: str, parent: str) -> str:
    join = " AND ".join(f"p.{k} = c.{k}" for k in keys.split(", "))
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return f"""SELECT '{name}' AS check_name, count(DISTINCT ({keys})) AS orphan_keys, count(*) AS orphan_rows
        FROM {child} c WHERE {known} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {join})"""


def _keys(name: str, table: str, keys: str) -> str:
    first = keys.split(", ")
    missing = " OR ".join(f"{k} IS NULL" for k in first)
    return f"""SELECT '{name}' AS check_name, count(*) FILTER (WHERE n > 1 AND NOT ({missing})) AS duplicate_keys,
        CAST(coalesce(sum(n) FILTER (WHERE {missing}), 0) AS BIGINT) AS null_key_rows
        FROM (SELECT {keys}, count(*) AS n FROM {table} GROUP BY {keys})"""


PARETO = f"""
    SELECT customer_id, CAST(rev AS DOUBLE) AS revenue, row_number() OVER w AS position,
           CAST(sum(rev) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_revenue, count(*) OVER () AS customers,
           CAST(sum(rev) OVER () AS DOUBLE) AS total_revenue,
           {pct('row_number() OVER w', 'count(*) OVER ()', 6)} AS customer_pct,
           {pct('sum(rev) OVER (w ROWS UNBOUNDED PRECEDING)', 'sum(rev) OVER ()', 6)} AS revenue_pct
    FROM (SELECT customer_id, coalesce(sum(revenue), 0) AS rev FROM fact_raw WHERE customer_id IS NOT NULL GROUP BY customer_id)
    WINDOW w AS (ORDER BY rev DESC, customer_id)"""

SQL: dict[str, str] = {
    # cleaning, rule by rule
    "c01_keep_first": sql("""SELECT order_id, product_id, line_no, supp_no, quantity, CAST(discount AS DOUBLE) AS discount, flag, ext
        FROM first_items"""),
    "c02_median_age": sql("SELECT customer_id, age FROM clean_customers"),
    "c03_tolerant_dates": sql(f"SELECT customer_id, signup_date AS signup_text, {parse('signup_date')} AS signup_date FROM raw_customers"),
    "c04_default_fill": sql("SELECT order_id, region, payment_mode FROM clean_orders"),
    "c05_future_signup": sql("SELECT customer_id, signup_date FROM clean_customers"),
    "c06_c07_clip": sql(f"""SELECT order_id, product_id, line_no, supp_no, flag, greatest(quantity, 1) AS quantity,
        {money('greatest(selling_price, 0)')} AS selling_price, {money('least(greatest(discount, 0), 100)')} AS discount
        FROM raw_order_items"""),
    "c08_cost_repair": sql(f"SELECT product_id, {money('cost_price')} AS cost_price, {money('selling_price')} AS selling_price FROM clean_products"),
    "c09_ship_repair": sql("SELECT order_id, order_date, shipping_date FROM clean_orders"),
    "c10_null_profile": sql(_null_counts()),
    "c11_null_signups": sql(f"SELECT count(*) - count({parse('signup_date')}) AS customers_with_null_signup FROM raw_customers"),
    "c12_dataset_profile": sql(_profile()),
    "c13_order_date_quality": sql(f"""SELECT count(*) FILTER (WHERE {parse('order_date')} > DATE '2000-12-31') AS future_orders,
        min({parse('order_date')}) AS first_date, max({parse('order_date')}) AS last_date FROM raw_orders"""),
    "c14_malformed_signups": sql(f"""SELECT count(*) FILTER (WHERE length(signup_date) <> 10) AS wrong_length,
        count(*) FILTER (WHERE signup_date IS NOT NULL AND {parse('signup_date')} IS NULL) AS unparsable FROM raw_customers"""),
    "c15_foreign_keys": sql("\nUNION ALL ".join([
        _orphans("orders.customer_id", "raw_orders", "customer_id", "raw_customers"),
        _orphans("order_items.order_id", "raw_order_items", "order_id", "raw_orders"),
        _orphans("order_items.product_id", "raw_order_items", "product_id", "raw_products"),
        _orphans("orders.without_lines", "raw_orders", "order_id", "raw_order_items"),
        _orphans("returns.line", "raw_returns", "order_id, product_id", "raw_order_items"),
        _orphans("fact.date", "(SELECT order_date AS date_key FROM fact_clean)", "date_key", "calendar"),
    ])),
    "c16_keys": sql("\nUNION ALL ".join([
        _keys("customers", "raw_customers", "customer_id"), _keys("products", "raw_products", "product_id"),
        _keys("orders", "raw_orders", "order_id"), _keys("order_items", "raw_order_items", "order_id, product_id"),
        _keys("returns", "raw_returns", "order_id, product_id"), _keys("fact_clean", "fact_clean", "order_id, product_id"),
    ])),
    "c17_strip_quotes": sql("SELECT customer_id, replace(name, '''', '') AS name FROM raw_customers"),
    "clean_customers": sql("SELECT * FROM clean_customers"),
    "clean_returns": sql("SELECT * FROM clean_returns"),
    # facts
    "fact_raw": sql(f"SELECT {LINE}, shipping_date, line_no, supp_no, flag, ext, CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM fact_raw"),
    "fact_clean": sql(f"""SELECT {LINE}, shipping_date, name, gender, age, city, customer_region,
        customer_region IS NOT NULL AS has_customer, category IS NOT NULL AS has_product,
        CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM fact_clean"""),
    "j04_inner_fact": sql("""SELECT f.order_id, f.product_id, line_no, supp_no, f.region, f.category, CAST(revenue AS DOUBLE) AS revenue, is_return
        FROM fact_raw f JOIN raw_orders USING (order_id) JOIN raw_products p ON f.product_id = p.product_id"""),
    "p01_p10_line_filters": sql(_filters({
        "p01_cod": "payment_mode = 'COD'", "p01_not_cod": "payment_mode IS DISTINCT FROM 'COD'",
        "p03_discount_from_20": "discount >= 20", "p06_returned": "is_return",
        "p08_cost_at_or_above_price": "cost_price >= selling_price", "p08_shipped_before_order": "shipping_date < order_date",
        "p09_discount_11_to_20": "discount BETWEEN 11 AND 20", "p10_payment_mode_known": "payment_mode IS NOT NULL",
    })),
    "p02_p07_p11_segment_filters": sql(_filters({
        "p02_category": "category = 'ECONOMY'", "p02_region": "region = 'ASIA'",
        "p07_deep_discount": f"{BINS} IN ('21-30%', '30%+')",
        "p11_slicer": "year(order_date) IN (1996, 1997) AND quarter(order_date) = 1 AND region = 'ASIA'",
    })),
    "m10_m12_band_flavours": sql(f"""SELECT discount, count(*) AS line_count, sql_band, bin_band, bi_band FROM (
        SELECT CAST(discount AS DOUBLE) AS discount,
          {SQL_BAND} AS sql_band, {BINS} AS bin_band, {BI_BAND} AS bi_band FROM fact_raw) GROUP BY ALL"""),
    # summaries
    "a1_overview": sql(f"""SELECT {REV} AS revenue, {PRO} AS profit, {pct('sum(profit)', 'sum(revenue)')} AS margin_pct, {ORDERS},
        count(DISTINCT customer_id) AS customers, {per('sum(revenue)', 'count(DISTINCT order_id)')} AS aov,
        {LINE_RATE} AS return_rate_pct FROM fact_raw"""),
    "a2_by_category": sql(BY_CATEGORY),
    "a3_by_region": sql(f"SELECT * EXCLUDE (aov) FROM ({BY_REGION})"),
    "a4_by_discount_band": sql(BY_BAND),
    "a5_customer_profiles": sql(f"""SELECT c.*, CAST(rev AS DOUBLE) AS total_revenue, CAST(pro AS DOUBLE) AS total_profit, n AS orders,
          CAST(disc AS DOUBLE) / nd AS avg_discount, ret AS return_count, last_order, first_order, CAST(pro AS DOUBLE) AS clv,
          CAST(rev AS DOUBLE) / n AS aov, {pct('ret', 'n')} AS return_rate,
          date_diff('day', first_order, last_order) AS customer_lifetime_days
        FROM raw_customers c JOIN (
          SELECT customer_id, sum(revenue) AS rev, sum(profit) AS pro, count(DISTINCT order_id) AS n, sum(discount) AS disc,
                 count(discount) AS nd, {FLAGGED} AS ret, max(order_date) AS last_order, min(order_date) AS first_order
          FROM fact_raw GROUP BY customer_id) s ON c.customer_id = s.customer_id"""),
    "a6_region_category": sql(f"""SELECT region, category, {REV} AS revenue, {PRO} AS profit, {ORDERS}, {FLAGGED} AS returns,
          count(DISTINCT customer_id) AS customers, {pct('sum(profit)', 'sum(revenue)')} AS margin_pct,
          {pct('count(*) FILTER (WHERE is_return)', 'count(DISTINCT order_id)')} AS return_rate,
          {LAT} AS latitude, {LON} AS longitude
        FROM fact_raw WHERE region IS NOT NULL AND category IS NOT NULL GROUP BY region, category"""),
    "a7_monthly": sql(MONTHLY),
    "a8_sales_detail": sql(f"""SELECT order_id, order_date, year(order_date) AS year, quarter(order_date) AS quarter,
          month(order_date) AS month, region, payment_mode, category, sub_category, brand, product_id, quantity,
          CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit, CAST(discount AS DOUBLE) AS discount,
          {pct('profit', 'revenue')} AS margin_pct, is_return FROM fact_raw"""),
    "l04_table_head": sql(f"""SELECT c.customer_id, c.name, {REV} AS total_revenue, {ORDERS} FROM fact_raw f JOIN raw_customers c ON f.customer_id = c.customer_id
        GROUP BY c.customer_id, c.name ORDER BY c.customer_id LIMIT 25"""),
    "a9_products_per_category": sql("SELECT category, count(*) AS product_count FROM raw_products WHERE category IS NOT NULL GROUP BY category"),
    "a10_line_return_rate": sql(f"SELECT category, {LINE_RATE} AS line_return_rate_pct FROM fact_raw WHERE category IS NOT NULL GROUP BY category"),
    "a11_bi_customers": sql(f"SELECT * EXCLUDE (signup_date), strftime({parse('signup_date')}, '%Y-%m-%d') AS signup_date FROM raw_customers"),
    "a11_bi_products": sql(f"""SELECT product_id, category, sub_category, brand, {money('selling_price')} AS selling_price,
        {money('cost_price')} AS cost_price, {pct('selling_price - cost_price', 'selling_price')} AS unit_margin_pct FROM raw_products"""),
    "a11_bi_fact": sql(f"SELECT {LINE}, {pct('profit', 'revenue')} AS margin_pct FROM fact_raw"),
    # chart data
    "k01_kpi_strip": sql(f"""SELECT {REV} AS revenue, {PRO} AS profit, {pct('sum(profit)', 'sum(revenue)')} AS margin_pct, {ORDERS},
        {per('sum(revenue)', 'count(DISTINCT order_id)')} AS aov FROM fact_raw"""),
    "k02_category_chart": sql(f"SELECT category, revenue, margin, return_rate FROM ({BY_CATEGORY})"),
    "k03_region_chart": sql(f"SELECT region, revenue, margin FROM ({BY_REGION})"),
    "k04_discount_chart": sql(f"""SELECT disc_band, band_order, revenue, margin, CASE WHEN margin > 30 THEN 'dark green' WHEN margin > 20 THEN 'green'
        WHEN margin > 10 THEN 'yellow' WHEN margin > 0 THEN 'orange' ELSE 'red' END AS colour FROM ({BY_BAND})"""),
    "k05_w07_pareto_curve": sql(PARETO),
    "k06_monthly_peaks": sql(f"""SELECT order_date AS month, revenue, profit, row_number() OVER (ORDER BY revenue DESC, order_date) = 1 AS is_peak,
        row_number() OVER (ORDER BY revenue, order_date) = 1 AS is_low FROM ({MONTHLY})"""),
    "k07_return_benchmark": sql(f"""SELECT category, return_rate, CASE WHEN return_rate > 20 THEN 'high' WHEN return_rate > 10 THEN 'medium' ELSE 'low' END AS level,
        CAST(10 AS DOUBLE) AS benchmark, round(return_rate - 10, 2) AS gap FROM ({BY_CATEGORY})"""),
    "k09_return_reasons": sql(f"""SELECT return_reason, count(*) AS returns, {pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct
        FROM raw_returns WHERE return_reason IS NOT NULL GROUP BY return_reason"""),
    "k10_order_value_by_region": sql(f"SELECT region, revenue, orders, aov FROM ({BY_REGION})"),
    "k11_payment_returns": sql(f"""SELECT payment_mode, {LINE_RATE} AS line_return_rate_pct, {ORDERS}
        FROM fact_raw WHERE payment_mode IS NOT NULL GROUP BY payment_mode"""),
}
