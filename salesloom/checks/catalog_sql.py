"""SQL checks of the report catalogue."""

from __future__ import annotations

from salesloom.checks.base import money, parse, pct, per, rnd, sql

PRODUCT = "p.product_id, p.category, p.sub_category, p.brand"

DAYS = "date_diff('day', min(order_date), max(order_date))"

DIM_DATE = """
    SELECT date_key, year(date_key) AS year, quarter(date_key) AS quarter, month(date_key) AS month,
           monthname(date_key) AS month_name, weekofyear(date_key) AS week, dayofweek(date_key) AS day_of_week,
           dayname(date_key) AS day_name, dayofweek(date_key) IN (0, 6) AS is_weekend
    FROM calendar"""

VALUE = f"""
    SELECT f.customer_id, any_value(c.name) AS name, any_value(c.region) AS region, count(DISTINCT order_id) AS n,
           sum(revenue) AS rev, sum(profit) AS pro, {DAYS} AS days
    FROM fact_clean f JOIN clean_customers c ON f.customer_id = c.customer_id GROUP BY f.customer_id"""

VALUE_SELECT = f"""
    SELECT customer_id, name, region, n AS total_orders, {money('ROUND(rev, 2)')} AS total_revenue,
           {money('ROUND(pro, 2)')} AS total_profit, {per('rev', 'n')} AS aov,
           CASE WHEN days = 0 THEN CAST(rev AS DOUBLE) ELSE {rnd('CAST(rev AS DOUBLE) * 365.0 / days')} END AS annual_value,
           CASE WHEN n >= 5 THEN 'Platinum' WHEN n >= 3 THEN 'Gold' WHEN n >= 2 THEN 'Silver' ELSE 'Bronze' END AS customer_tier,
           CASE WHEN rev >= 50000 THEN 'High' WHEN rev >= 10000 THEN 'Medium' ELSE 'Low' END AS value_segment,
           {per('rev', 'n')} AS avg_revenue_per_order
    FROM cust_value"""

ELAPSED = """((year({1}) - year({0})) * 12 + month({1}) - month({0}) - CASE WHEN day({1}) < day({0}) THEN 1 ELSE 0 END)"""

JOURNEY = f"""
    SELECT f.customer_id, c.name, f.order_id, f.product_id, f.order_date,
           lead(f.order_date) OVER w AS next_order_date,
           date_diff('day', f.order_date, lead(f.order_date) OVER w) AS days_between_orders,
           {money('sum(f.revenue) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS running_total_revenue
    FROM fact_clean f JOIN clean_customers c ON f.customer_id = c.customer_id
    WINDOW w AS (PARTITION BY f.customer_id ORDER BY f.order_date, f.order_id, f.product_id)"""

PRODUCT_SUMS = f"""CAST(sum(f.quantity) AS BIGINT) AS units_sold, {money('sum(f.revenue)')} AS total_revenue,
           {money('sum(f.profit)')} AS total_profit"""

SQL: dict[str, str] = {
    "q01_revenue_by_region": sql(f"""
        SELECT c.region, count(DISTINCT order_id) AS total_orders, {money('sum(revenue)')} AS total_revenue,
               {money('sum(profit)')} AS total_profit, {pct('sum(profit)', 'sum(revenue)')} AS margin_pct,
               {per('sum(revenue)', 'count(revenue)')} AS avg_order_value
        FROM fact_clean f JOIN clean_customers c ON f.customer_id = c.customer_id GROUP BY c.region"""),
    "q02_monthly_trend": sql(f"""
        SELECT year, month, month_name, orders, {money('rev')} AS revenue, {money('pro')} AS profit,
               {pct('pro', 'rev')} AS margin_pct, {money('lag(rev) OVER w')} AS prev_month_revenue,
               {pct('rev - lag(rev) OVER w', 'lag(rev) OVER w')} AS revenue_mom_change_pct
        FROM months WINDOW w AS (ORDER BY year, month)""",
        dim_date=DIM_DATE,
        months="""SELECT year, month, month_name, count(DISTINCT order_id) AS orders, sum(revenue) AS rev, sum(profit) AS pro
                  FROM fact_clean JOIN dim_date ON order_date = date_key GROUP BY ALL"""),
    "q03_top_products": sql(f"""
        SELECT {PRODUCT}, {PRODUCT_SUMS},
               {rnd('avg(CAST(f.profit AS DOUBLE) / NULLIF(CAST(f.revenue AS DOUBLE), 0)) * 100')} AS avg_margin_pct,
               rank() OVER (ORDER BY sum(f.profit) DESC) AS profit_rank
        FROM fact_clean f JOIN clean_products p ON f.product_id = p.product_id
        GROUP BY {PRODUCT} ORDER BY sum(f.profit) DESC, p.product_id LIMIT 10"""),
    "q04_customer_lifetime_value": sql(VALUE_SELECT + " ORDER BY rev DESC, customer_id LIMIT 20", cust_value=VALUE),
    "q04_customer_value_all": sql(VALUE_SELECT, cust_value=VALUE),
    "q05_repeat_purchases": sql(f"""
        SELECT order_frequency, customer_count, {pct('customer_count', 'sum(customer_count) OVER ()')} AS pct_of_customers,
               CAST(sum(customer_count) OVER (ORDER BY hi DESC) AS BIGINT) AS cumulative_customers_desc
        FROM buckets""",
        per_customer="SELECT customer_id, count(DISTINCT order_id) AS n FROM fact_clean GROUP BY customer_id",
        buckets="""SELECT CASE WHEN n = 1 THEN '1 order' WHEN n = 2 THEN '2 orders' WHEN n BETWEEN 3 AND 4 THEN '3-4 orders'
                          WHEN n BETWEEN 5 AND 9 THEN '5-9 orders' ELSE '10+ orders' END AS order_frequency,
                          count(*) AS customer_count, max(n) AS hi FROM per_customer GROUP BY 1"""),
    "q06_return_rate_by_category": sql(f"""
        SELECT p.category, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
               CAST(sum(CASE WHEN is_return THEN 1 ELSE 0 END) AS BIGINT) AS return_units,
               {pct('sum(CASE WHEN is_return THEN 1 ELSE 0 END)', 'sum(quantity)')} AS return_rate_pct,
               {money('sum(CASE WHEN is_return THEN revenue ELSE 0 END)')} AS return_revenue_loss
        FROM fact_clean f JOIN clean_products p ON f.product_id = p.product_id GROUP BY p.category"""),
    "q07_lowest_margin_products": sql(f"""
        SELECT {PRODUCT}, {money('p.cost_price')} AS cost_price, {money('p.selling_price')} AS selling_price,
               {pct('p.selling_price - p.cost_price', 'p.selling_price')} AS unit_margin_pct, {PRODUCT_SUMS},
               {pct('sum(f.profit)', 'sum(f.revenue)')} AS realized_margin_pct
        FROM fact_clean f JOIN clean_products p ON f.product_id = p.product_id
        GROUP BY {PRODUCT}, p.cost_price, p.selling_price HAVING sum(f.revenue) > 0
        ORDER BY realized_margin_pct, p.product_id LIMIT 20"""),
    "q08_cohort_retention": sql(f"""
        SELECT cohort_month, month_offset, active_customers, size AS cohort_size,
               {pct('active_customers', 'size')} AS retention_pct
        FROM (SELECT a.cohort_month, month_offset, count(DISTINCT customer_id) AS active_customers
              FROM activity a GROUP BY ALL) JOIN sizes USING (cohort_month) WHERE month_offset <= 12""",
        firsts="SELECT customer_id, min(order_date) AS d0, strftime(min(order_date), '%Y-%m') AS cohort_month FROM fact_clean GROUP BY customer_id",
        activity=f"SELECT f.customer_id, cohort_month, {ELAPSED.format('d0', 'f.order_date')} AS month_offset FROM fact_clean f JOIN firsts USING (customer_id)",
        sizes="SELECT cohort_month, count(DISTINCT customer_id) AS size FROM firsts GROUP BY cohort_month"),
    "q09_next_purchases": sql(JOURNEY + " ORDER BY f.customer_id, f.order_date, f.order_id, f.product_id LIMIT 50"),
    "w05_w06_customer_journey": sql(JOURNEY),
    "q10_discount_bands": sql(f"""
        SELECT CASE WHEN discount = 0 THEN '0%' WHEN discount BETWEEN 1 AND 10 THEN '1-10%'
                    WHEN discount BETWEEN 11 AND 20 THEN '11-20%' WHEN discount BETWEEN 21 AND 30 THEN '21-30%'
                    ELSE '30%+' END AS discount_band,
               count(*) AS transactions, {money('sum(revenue)')} AS total_revenue, {money('sum(profit)')} AS total_profit,
               {pct('sum(profit)', 'sum(revenue)')} AS margin_pct, {per('sum(discount)', 'count(discount)')} AS avg_discount_pct
        FROM fact_clean GROUP BY 1"""),
    "q11_payment_modes": sql(f"""
        SELECT payment_mode, count(DISTINCT order_id) AS orders, {money('sum(revenue)')} AS revenue,
               {money('sum(profit)')} AS profit, {per('sum(revenue)', 'count(revenue)')} AS avg_order_value,
               count(*) AS transactions
        FROM fact_clean GROUP BY payment_mode"""),
    "q12_worst_products": sql(f"""
        SELECT {PRODUCT}, {PRODUCT_SUMS} FROM fact_clean f JOIN clean_products p ON f.product_id = p.product_id
        GROUP BY {PRODUCT} ORDER BY sum(f.profit), p.product_id LIMIT 10"""),
    "q13_daily_sales": sql(f"""
        SELECT f.order_date AS date_key, p.category, p.sub_category, p.brand, c.region,
               count(DISTINCT order_id) AS orders, count(DISTINCT f.customer_id) AS customers,
               CAST(sum(f.quantity) AS BIGINT) AS units_sold, {money('sum(revenue)')} AS revenue, {money('sum(profit)')} AS profit,
               {money('sum(f.quantity * f.cost_price)')} AS total_cost, {pct('sum(profit)', 'sum(revenue)')} AS profit_margin_pct,
               CAST(sum(CASE WHEN is_return THEN 1 ELSE 0 END) AS BIGINT) AS returns_count
        FROM fact_clean f JOIN clean_products p ON f.product_id = p.product_id
             JOIN clean_customers c ON f.customer_id = c.customer_id
        GROUP BY f.order_date, p.category, p.sub_category, p.brand, c.region"""),
    "d1_dim_date_warehouse": sql("SELECT * FROM dim_date", dim_date=DIM_DATE),
    "d2_dim_date_bi": sql("""
        SELECT date_key AS "Date", year(date_key) AS "Year", quarter(date_key) AS "Quarter", month(date_key) AS "Month",
               strftime(date_key, '%b') AS "MonthName", weekofyear(date_key) AS "Week", isodow(date_key) - 1 AS "DayOfWeek",
               dayname(date_key) AS "DayName", isodow(date_key) >= 6 AS "IsWeekend", strftime(date_key, '%Y-%m') AS "MonthYear",
               'Q' || quarter(date_key) || ' ' || year(date_key) AS "QuarterLabel"
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_key
              FROM (SELECT min(od) AS lo, greatest(max(od), max(sd)) AS hi FROM dated))""",
        dated=f"SELECT {parse('order_date')} AS od, {parse('shipping_date')} AS sd FROM raw_orders"),
}
