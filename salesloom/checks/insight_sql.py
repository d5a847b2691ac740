"""SQL checks of insights and scenarios."""

from __future__ import annotations

from salesloom.checks.base import money, pct, per, rnd, sql
from salesloom.checks.catalog_sql import PRODUCT
from salesloom.checks.summary_sql import BY_BAND, BY_REGION, LINE_RATE, MONTHLY, ORDERS, PRO, REV

OVERVIEW = f"""SELECT sum(revenue) AS rev, sum(profit) AS pro, {pct('sum(profit)', 'sum(revenue)')} AS margin_pct, {ORDERS},
    count(DISTINCT customer_id) AS customers, {per('sum(revenue)', 'count(DISTINCT order_id)')} AS aov, {LINE_RATE} AS return_rate_pct,
    {per('sum(discount)', 'count(discount)')} AS avg_discount FROM fact_raw"""
CURVE = """SELECT customer_id, rev, row_number() OVER (ORDER BY rev DESC, customer_id) AS position, count(*) OVER () AS n,
    sum(rev) OVER () AS total, sum(rev) OVER (ORDER BY rev DESC, customer_id ROWS UNBOUNDED PRECEDING) AS cum
    FROM (SELECT customer_id, coalesce(sum(revenue), 0) AS rev FROM fact_raw WHERE customer_id IS NOT NULL GROUP BY customer_id)"""
COD = "SELECT count(*) FILTER (WHERE payment_mode = 'COD') AS cod, count(*) AS n FROM raw_orders"
COD_COST = rnd("cod * 0.272::DOUBLE * aov * 0.25::DOUBLE", 0)
RISK = rnd("CAST(rev AS DOUBLE) * (greatest(return_rate_pct, 14.15::DOUBLE) / 100) * 0.18::DOUBLE", 0)
DEEP = f"SELECT CAST(coalesce(sum(transactions), 0) AS BIGINT) AS transactions, coalesce(sum(revenue), 0) AS revenue, coalesce(sum(profit), 0) AS profit FROM ({BY_BAND}) WHERE disc_band IN ('21-30%', '30%+')"
GAP = f"""SELECT t.margin AS target_margin, b.margin AS benchmark_margin, t.revenue AS target_revenue,
    {rnd('b.margin - t.margin', 1)} AS gap_pp, {rnd(f"t.revenue * ({rnd('b.margin - t.margin', 1)} / 100)", 0)} AS recovery
    FROM regions t, regions b WHERE t.region = 'ASIA' AND b.region = 'EUROPE'"""
REPEAT = "SELECT count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeaters FROM (SELECT customer_id, count(DISTINCT order_id) AS n FROM fact_raw WHERE customer_id IS NOT NULL GROUP BY customer_id)"


def _cut(name: str, cond: str, fraction: float) -> str:
    return f"""SELECT '{name}' AS cutoff, CAST(floor(max(n) * {fraction}::DOUBLE) AS BIGINT) AS customers,
        {money(f'coalesce(sum(rev) FILTER (WHERE {cond}), 0)')} AS revenue, {pct(f'sum(rev) FILTER (WHERE {cond})', 'max(total)')} AS share_pct FROM curve"""


def _top(f: float) -> str:
    return _cut(f"top {f:g}", f"position <= floor(n * {f}::DOUBLE)", f)


def _bottom(f: float) -> str:
    return _cut(f"bottom {f:g}", f"position > n - floor(n * {f}::DOUBLE)", f)


def _kpi(name: str, value: str, target: str) -> str:
    return f"SELECT '{name}' AS kpi, {value} AS current, CAST({target} AS DOUBLE) AS target, {rnd(f'{value} - {target}')} AS gap FROM overview, repeat_counts"


INPUTS = {"overview": OVERVIEW, "cod": COD, "deep": DEEP, "regions": BY_REGION, "gap": GAP, "curve": CURVE}

SQL: dict[str, str] = {
    "i01_pareto_share": sql(_top(0.2), curve=CURVE),
    "i02_worst_return_category": sql(f"""SELECT category, {LINE_RATE} AS line_return_rate_pct FROM fact_raw WHERE category IS NOT NULL
        GROUP BY category ORDER BY line_return_rate_pct DESC, category LIMIT 1"""),
    "i03_margin_extremes": sql(f"""SELECT min_by(region, m) AS worst_region, {rnd('min(m) * 100')} AS worst_margin_pct,
        max_by(region, m) AS best_region, {rnd('max(m) * 100')} AS best_margin_pct FROM (SELECT region, profit / revenue AS m FROM regions)""", regions=BY_REGION),
    "i04_deep_discount_margin": sql(f"""SELECT {pct('dp', 'dr')} AS deep_margin_pct, {pct('p', 'r')} AS overall_margin_pct,
        {rnd('CAST(p AS DOUBLE) / CAST(r AS DOUBLE) * 100 - CAST(dp AS DOUBLE) / CAST(dr AS DOUBLE) * 100')} AS gap_pp
        FROM (SELECT sum(profit) FILTER (WHERE discount >= 20) AS dp, sum(revenue) FILTER (WHERE discount >= 20) AS dr,
              sum(profit) AS p, sum(revenue) AS r FROM fact_raw)"""),
    "i05_repeat_rate": sql(f"SELECT customers, repeaters, {pct('repeaters', 'customers')} AS repeat_rate_pct FROM ({REPEAT})"),
    "i06_cod_risk": sql(f"""SELECT {pct('ar', 'a')} AS cod_return_pct, {pct('br', 'b')} AS prepaid_return_pct,
        {rnd('(ar::DOUBLE / a) / (br::DOUBLE / b)')} AS ratio FROM (SELECT count(*) FILTER (WHERE payment_mode = 'COD') AS a,
          count(*) FILTER (WHERE payment_mode = 'COD' AND is_return) AS ar,
          count(*) FILTER (WHERE payment_mode IS DISTINCT FROM 'COD') AS b,
          count(*) FILTER (WHERE payment_mode IS DISTINCT FROM 'COD' AND is_return) AS br FROM fact_raw)"""),
    "i07_order_value_change": sql(f"""SELECT min(order_date) AS first_month, max(order_date) AS last_month,
        {rnd('(max_by(aov, order_date) - min_by(aov, order_date)) / min_by(aov, order_date) * 100')} AS aov_change_pct
        FROM (SELECT order_date, revenue / orders AS aov FROM ({MONTHLY}))"""),
    "i08_cod_orders": sql(f"SELECT cod AS cod_orders, n AS orders, {pct('cod', 'n', 1)} AS cod_pct FROM ({COD})"),
    "i09_cod_return_cost": sql(f"SELECT cod AS cod_orders, aov, {COD_COST} AS cod_return_cost FROM cod, overview", **INPUTS),
    "i10_profit_at_risk": sql(f"SELECT {money('rev')} AS revenue, return_rate_pct, {RISK} AS profit_at_risk FROM overview", **INPUTS),
    "i11_margin_gap": sql("SELECT * FROM gap", **INPUTS),
    "i12_loss_leaders": sql("SELECT count(*) FILTER (WHERE cost_price >= selling_price) AS loss_leaders FROM raw_products"),
    "i13_kpi_targets": sql("\nUNION ALL ".join([
        _kpi("total_revenue", "CAST(rev AS DOUBLE)", "NULL::DOUBLE"), _kpi("profit", "CAST(pro AS DOUBLE)", "5.0e6"),
        _kpi("margin_pct", "margin_pct", "28::DOUBLE"), _kpi("aov", "aov", "1800::DOUBLE"),
        _kpi("clv", per("pro", "overview.customers"), "15000::DOUBLE"), _kpi("return_rate_pct", "return_rate_pct", "10::DOUBLE"),
        _kpi("repeat_rate_pct", pct("repeaters", "repeat_counts.customers"), "75::DOUBLE"),
        _kpi("revenue_per_customer", per("rev", "overview.customers"), "12000::DOUBLE"), _kpi("avg_discount", "avg_discount", "8::DOUBLE"),
        "SELECT 'revenue' AS kpi, current, before * 1.15 AS target, " + rnd("current - before * 1.15") + """ AS gap FROM (
            SELECT CAST(sum(revenue) FILTER (year(order_date) = last) AS DOUBLE) AS current,
                   CAST(sum(revenue) FILTER (year(order_date) = last - 1) AS DOUBLE) AS before
            FROM fact_raw, (SELECT year(max(order_date) + INTERVAL 1 DAY) - 1 AS last FROM fact_raw))""",
    ]), overview=OVERVIEW, repeat_counts=REPEAT),
    "i14_deep_band_profit": sql(DEEP),
    "i16_initiative_roi": sql("""SELECT coalesce(initiative, 'Total') AS initiative, sum(impact) AS impact, sum(cost) AS cost, sum(impact - cost) AS net
        FROM (SELECT 'Discount Governance' AS initiative, floor(abs(profit)) AS impact, 50000::DOUBLE AS cost FROM deep
              UNION ALL SELECT 'COD-to-Prepaid Conversion', """ + COD_COST + """, 120000 FROM cod, overview
              UNION ALL SELECT 'High-Value Customer Retention', 2400000, 300000 UNION ALL SELECT 'Category Mix Optimization', 850000, 100000)
        GROUP BY ROLLUP (initiative)""", **INPUTS),
    "i17_product_margin_tiers": sql(f"""SELECT tier, count(*) AS products, {money('sum(rev)')} AS revenue, {pct('sum(rev)', 'sum(sum(rev)) OVER ()')} AS share_pct
        FROM (SELECT rev, CASE WHEN m > 35 THEN 'Profit Engines' WHEN m >= 15 THEN 'Volume Drivers' WHEN m >= 0 THEN 'Margin Squeeze' ELSE 'Loss Leaders' END AS tier
              FROM (SELECT sum(revenue) AS rev, CAST(sum(profit) AS DOUBLE) * 100 / CAST(sum(revenue) AS DOUBLE) AS m
                    FROM fact_raw GROUP BY product_id HAVING sum(revenue) > 0)) GROUP BY tier"""),
    "i18_concentration": sql("\nUNION ALL ".join([_top(0.1), _top(0.2), _bottom(0.5)]), curve=CURVE),
    "i19_thin_margin_products": sql(f"""SELECT {PRODUCT}, {money('sum(revenue)')} AS total_revenue, {money('sum(profit)')} AS total_profit,
        {pct('sum(profit)', 'sum(revenue)')} AS margin_pct FROM fact_raw f JOIN clean_products p ON f.product_id = p.product_id
        GROUP BY {PRODUCT} HAVING sum(revenue) > 0 AND {pct('sum(profit)', 'sum(revenue)')} < 5"""),
    "i20_repeat_returns": sql(f"""SELECT count(*) AS returning_customers, CAST(sum(n) AS BIGINT) AS returned_lines, count(*) FILTER (WHERE again) AS again_within,
          count(*) FILTER (WHERE heavy) AS flagged, {pct('count(*) FILTER (WHERE again)', 'count(*)')} AS again_pct,
          {pct('count(*) FILTER (WHERE heavy)', 'count(*)')} AS flagged_pct
        FROM (SELECT customer_id, count(*) AS n, coalesce(bool_or(gap <= 60), false) AS again, bool_or(in90 > 2) AS heavy
              FROM (SELECT customer_id, date_diff('day', order_date, lead(order_date) OVER (PARTITION BY customer_id ORDER BY order_date)) AS gap,
                           count(*) OVER (PARTITION BY customer_id ORDER BY order_date RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW) AS in90
                    FROM fact_raw WHERE is_return AND customer_id IS NOT NULL AND order_date IS NOT NULL) GROUP BY customer_id)"""),
    "i21_revenue_at_risk": sql(f"""SELECT 'customer churn' AS risk, floor(CAST(max(total) AS DOUBLE) * ({pct('sum(rev) FILTER (WHERE position <= floor(n * 0.2::DOUBLE))', 'max(total)')} / 100) * 0.25::DOUBLE) AS amount FROM curve
        UNION ALL SELECT 'returns leakage', {RISK} FROM overview
        UNION ALL SELECT 'COD return cost', {COD_COST} FROM cod, overview
        UNION ALL SELECT 'margin gap', recovery FROM gap
        UNION ALL SELECT 'discount profit', floor(abs(profit)) FROM deep""", **INPUTS),
    "i22_fraction_reaching": sql(f"""SELECT CAST(0.8 AS DOUBLE) AS share, min(position) FILTER (WHERE CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) >= 0.8) AS position,
        max(n) AS customers, {rnd('(min(position) FILTER (WHERE CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) >= 0.8) - 1)::DOUBLE / max(n)', 6)} AS fraction FROM curve""", curve=CURVE),
}
