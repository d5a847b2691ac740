"""SQL checks of measures, visuals and correlations."""

from __future__ import annotations

from salesloom.checks.base import money, pct, rnd, sql
from salesloom.checks.catalog_sql import PRODUCT, PRODUCT_SUMS
from salesloom.checks.summary_sql import BY_CATEGORY, FLAGGED, LAT, LON, MONTHLY, ORDERS, PRO, REV

SEGMENT = "CASE WHEN rev >= 50000 THEN 'Platinum' WHEN rev >= 10000 THEN 'Gold' WHEN rev >= 5000 THEN 'Silver' ELSE 'Bronze' END"
PER_CUSTOMER = "SELECT customer_id, sum(revenue) AS rev FROM fact_raw WHERE customer_id IS NOT NULL GROUP BY customer_id"
BI_BAND = """CASE WHEN discount = 0 THEN 'No Discount' WHEN discount <= 10 THEN '1-10%' WHEN discount <= 20 THEN '11-20%'
             WHEN discount <= 30 THEN '21-30%' ELSE '30%+' END"""



def div0(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0)"


CORE = f"""{REV} AS total_revenue, {PRO} AS total_profit, count(DISTINCT order_id) AS total_orders,
    count(DISTINCT customer_id) AS total_customers, {FLAGGED} AS total_returns, CAST(sum(quantity) AS BIGINT) AS units_sold"""
RATIO = f"""{div0('sum(profit)', 'sum(revenue)')} AS profit_margin, {div0('sum(revenue)', 'count(DISTINCT order_id)')} AS average_order_value,
    {div0('count(*) FILTER (WHERE is_return)', 'count(DISTINCT order_id)')} AS return_rate,
    {div0('sum(revenue)', 'count(DISTINCT customer_id)')} AS revenue_per_customer,
    {div0('sum(discount)', 'count(discount)')} AS avg_discount, {div0('sum(profit)', 'count(DISTINCT customer_id)')} AS clv,
    {money('sum(discount_impact)')} AS discount_impact"""

MONTHS = "SELECT year(order_date) AS year, month(order_date) AS month, sum(revenue) AS rev FROM fact_raw WHERE order_date IS NOT NULL GROUP BY ALL"


def _corr(a: str, b: str, digits: int) -> str:
    return f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {digits})"


_COLS = ["quantity", "selling_price", "discount", "revenue", "profit"]
CORR = "\nUNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {_corr(a, b, 6) if a != b else 'CAST(max(1) AS DOUBLE)'} AS r FROM fact_raw" for a in _COLS for b in _COLS
)

SQL: dict[str, str] = {
    "b01_b06_core": sql(f"SELECT {CORE} FROM fact_raw"),
    "b01_b06_core_by_region_category": sql(f"SELECT region, category, {CORE} FROM fact_raw GROUP BY region, category"),
    "b07_b12_b27_ratios": sql(f"SELECT {RATIO} FROM fact_raw"),
    "b07_b12_b27_ratios_by_category": sql(f"SELECT category, {RATIO} FROM fact_raw GROUP BY category"),
    "b07_filtered_by_slicer": sql(f"""SELECT region, {REV} AS total_revenue, {div0('sum(profit)', 'sum(revenue)')} AS profit_margin
        FROM fact_raw WHERE year(order_date) = 1997 AND quarter(order_date) = 2 GROUP BY region"""),
    "b13_b16_previous_periods": sql(f"""SELECT m.year, m.month, {money('m.rev')} AS revenue, {money('p.rev')} AS revenue_prev_month,
          {div0('m.rev - p.rev', 'p.rev')} AS revenue_mom, {money('y.rev')} AS revenue_prev_year, {div0('m.rev - y.rev', 'y.rev')} AS revenue_yoy
        FROM months m LEFT JOIN months p ON p.year * 12 + p.month = m.year * 12 + m.month - 1
             LEFT JOIN months y ON y.year = m.year - 1 AND y.month = m.month""", months=MONTHS),
    "b17_b20_period_to_date": sql(f"""SELECT order_date, {money('rev')} AS revenue,
          {money('sum(rev) OVER (PARTITION BY year(order_date), month(order_date) ORDER BY order_date)')} AS revenue_mtd,
          {money('sum(rev) OVER (PARTITION BY year(order_date), quarter(order_date) ORDER BY order_date)')} AS revenue_qtd,
          {money('sum(rev) OVER (PARTITION BY year(order_date) ORDER BY order_date)')} AS revenue_ytd,
          {money('sum(pro) OVER (PARTITION BY year(order_date) ORDER BY order_date)')} AS profit_ytd
        FROM (SELECT order_date, sum(revenue) AS rev, sum(profit) AS pro FROM fact_raw WHERE order_date IS NOT NULL GROUP BY order_date)"""),
    "b21_b22_product_ranks": sql(f"""SELECT product_id, {money('rev')} AS revenue, {money('pro')} AS profit,
          rank() OVER (ORDER BY rev DESC) AS revenue_rank, rank() OVER (ORDER BY pro DESC) AS profit_rank
        FROM (SELECT p.product_id, coalesce(sum(revenue), 0) AS rev, coalesce(sum(profit), 0) AS pro
              FROM clean_products p LEFT JOIN fact_raw f ON p.product_id = f.product_id GROUP BY p.product_id)"""),
    "b23_customer_ranks": sql(f"""SELECT customer_id, {money('rev')} AS revenue, rank() OVER (ORDER BY rev DESC) AS revenue_rank
        FROM (SELECT c.customer_id, coalesce(sum(revenue), 0) AS rev
              FROM clean_customers c LEFT JOIN fact_raw f ON c.customer_id = f.customer_id GROUP BY c.customer_id)"""),
    "b24_customer_segments": sql(f"SELECT customer_id, {money('rev')} AS revenue, {SEGMENT} AS segment FROM ({PER_CUSTOMER})"),
    "b25_discount_bands": sql(f"""SELECT discount_band, {REV} AS total_revenue, {PRO} AS total_profit,
          {div0('sum(profit)', 'sum(revenue)')} AS profit_margin, count(DISTINCT order_id) AS total_orders,
          CASE discount_band WHEN 'No Discount' THEN 0::BIGINT WHEN '1-10%' THEN 1 WHEN '11-20%' THEN 2 WHEN '21-30%' THEN 3 ELSE 4 END AS band_order
        FROM (SELECT *, {BI_BAND} AS discount_band FROM fact_raw) GROUP BY discount_band"""),
    "b26_reason_list": sql("""SELECT string_agg(return_reason, ', ' ORDER BY return_reason) AS return_reasons
        FROM (SELECT DISTINCT return_reason FROM raw_returns WHERE return_reason IS NOT NULL)"""),
    "b28_report_title": sql("""SELECT 'Sales Analytics | ' || CASE WHEN min(year(order_date)) = max(year(order_date))
        THEN CAST(min(year(order_date)) AS VARCHAR) ELSE 'All Years' END AS title FROM fact_raw"""),
    "b28_report_title_selected": sql("""SELECT 'Sales Analytics | ' || CASE WHEN min(year(order_date)) = max(year(order_date))
        THEN CAST(min(year(order_date)) AS VARCHAR) ELSE 'All Years' END || ' - ' || CASE WHEN min(monthname(order_date)) = max(monthname(order_date))
        THEN min(monthname(order_date)) ELSE '' END AS title FROM fact_raw WHERE year(order_date) = 1998 AND month(order_date) = 3"""),
    "v00_slicers": sql("""SELECT DISTINCT 'year' AS slicer, CAST(year(order_date) AS VARCHAR) AS value FROM fact_raw WHERE order_date IS NOT NULL
        UNION ALL SELECT DISTINCT 'quarter', CAST(quarter(order_date) AS VARCHAR) FROM fact_raw WHERE order_date IS NOT NULL
        UNION ALL SELECT DISTINCT 'region', region FROM fact_raw WHERE region IS NOT NULL"""),
    "v01_kpi_cards": sql(f"""SELECT {REV} AS revenue, {PRO} AS profit, {ORDERS}, {pct('sum(profit)', 'sum(revenue)')} AS margin_pct
        FROM fact_raw WHERE year(order_date) = 1997 AND region = 'ASIA'"""),
    "v02_revenue_over_time": sql(f"SELECT order_date, {REV} AS revenue, {PRO} AS profit FROM fact_raw WHERE order_date IS NOT NULL GROUP BY order_date"),
    "v03_revenue_by_category": sql(f"SELECT category, {REV} AS revenue FROM fact_raw WHERE category IS NOT NULL GROUP BY category"),
    "v04_region_map": sql(f"SELECT region, {REV} AS revenue, {LAT} AS latitude, {LON} AS longitude FROM fact_raw WHERE region IS NOT NULL GROUP BY region"),
    "v05_top_products_by_revenue": sql(f"""SELECT {PRODUCT}, {PRODUCT_SUMS} FROM fact_clean f JOIN clean_products p ON f.product_id = p.product_id
        GROUP BY {PRODUCT} ORDER BY sum(f.revenue) DESC, p.product_id LIMIT 10"""),
    "v06_monthly_revenue": sql(f"SELECT order_date AS month, revenue FROM ({MONTHLY})"),
    "v07_region_by_year": sql(f"""SELECT region, year(order_date) AS year, {REV} AS revenue FROM fact_raw
        WHERE region IS NOT NULL AND order_date IS NOT NULL GROUP BY ALL"""),
    "v08_category_by_month": sql(f"""SELECT strftime(order_date, '%Y-%m') AS month, category, {REV} AS revenue FROM fact_raw
        WHERE category IS NOT NULL AND order_date IS NOT NULL GROUP BY ALL"""),
    "v09_revenue_waterfall": sql(f"""SELECT m.year || '-' || lpad(CAST(m.month AS VARCHAR), 2, '0') AS month, {money('m.rev')} AS revenue,
          {money('m.rev - coalesce(p.rev, 0)')} AS delta
        FROM months m LEFT JOIN months p ON p.year * 12 + p.month = m.year * 12 + m.month - 1""", months=MONTHS),
    "v10b_top_customers": sql(f"SELECT customer_id, {money('rev')} AS revenue FROM ({PER_CUSTOMER}) ORDER BY rev DESC, customer_id LIMIT 10"),
    "v10c_segment_distribution": sql(f"""SELECT segment, count(*) AS customers, {pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct
        FROM (SELECT {SEGMENT} AS segment FROM ({PER_CUSTOMER})) GROUP BY segment"""),
    "v10e_customer_cards": sql(f"""SELECT {div0('sum(pro)', 'count(customer_id)')} AS clv,
          {pct('count(*) FILTER (WHERE n > 1 AND customer_id IS NOT NULL)', 'count(customer_id)')} AS repeat_rate_pct,
          {div0('sum(rev)', 'sum(n)')} AS average_order_value
        FROM (SELECT customer_id, count(DISTINCT order_id) AS n, sum(revenue) AS rev, sum(profit) AS pro FROM fact_raw GROUP BY customer_id)"""),
    "v11_category_matrix": sql(f"""SELECT category, sub_category, grouping(category, sub_category) AS level, {REV} AS revenue,
          {pct('sum(profit)', 'sum(revenue)')} AS margin_pct,
          {pct('count(*) FILTER (WHERE is_return)', 'count(DISTINCT order_id)')} AS return_rate
        FROM fact_raw GROUP BY ROLLUP (category, sub_category)"""),
    "v12_discount_scatter": sql(f"""SELECT CAST(discount AS DOUBLE) AS discount, count(*) AS line_count, {REV} AS revenue,
          {pct('sum(profit)', 'sum(revenue)')} AS margin_pct FROM fact_raw f GROUP BY f.discount"""),
    "v13_negative_margin_products": sql(f"""SELECT {PRODUCT}, {PRODUCT_SUMS}, {pct('sum(f.profit)', 'sum(f.revenue)')} AS margin_pct
        FROM fact_raw f JOIN clean_products p ON f.product_id = p.product_id GROUP BY {PRODUCT} HAVING sum(f.profit) < 0"""),
    "v14_return_gauge": sql(f"""SELECT {rnd('r', 6)} AS return_rate, CAST(0.1 AS DOUBLE) AS target, r > 0.1 AS above_target
        FROM (SELECT {div0('count(*) FILTER (WHERE is_return)', 'count(DISTINCT order_id)')} AS r FROM fact_raw)"""),
    "v15_return_rate_by_category": sql(f"SELECT category, return_rate FROM ({BY_CATEGORY})"),
    "v17_return_rate_trend": sql(f"SELECT order_date AS month, orders, returns, {pct('returns', 'orders')} AS return_rate FROM ({MONTHLY})"),
    "v18_returns_by_payment_mode": sql(f"""SELECT payment_mode, {FLAGGED} AS total_returns, count(DISTINCT order_id) AS total_orders,
          {rnd(div0('count(*) FILTER (WHERE is_return)', 'count(DISTINCT order_id)'), 6)} AS return_rate
        FROM fact_raw WHERE payment_mode IS NOT NULL GROUP BY payment_mode"""),
    "x1_k12_correlations": sql(CORR),
    "x1_key_correlations": sql(f"""SELECT {_corr('revenue', 'profit', 3)} AS revenue_profit, {_corr('discount', 'profit', 3)} AS discount_profit,
        {_corr('discount', 'revenue', 3)} AS discount_revenue FROM fact_raw"""),
}
