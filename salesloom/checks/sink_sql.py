"""SQL checks of what sinks write and sources read back."""

from __future__ import annotations

from salesloom.checks.base import money, sql
from salesloom.checks.catalog_sql import SQL as CATALOG
from salesloom.checks.model_sql import SQL as MODELS
from salesloom.checks.summary_sql import SQL as SUMMARIES

CLEANING = {**SUMMARIES, **CATALOG}  # the checks of the cleaning rules are among these


def _rows(**counts: tuple[str, int]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS file, count(*) AS row_count, {columns}::BIGINT AS column_count FROM ({source})" for name, (source, columns) in counts.items()
    )



SQL: dict[str, str] = {
    "s01_csv_scan": sql("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(sum({k}) AS DOUBLE) AS key_sum, CAST(count({c}) AS BIGINT) AS filled FROM raw_{t}"
        for t, k, c in (("customers", "customer_id", "age"), ("products", "product_id", "brand"), ("orders", "order_id", "payment_mode"),
                        ("order_items", "product_id", "quantity"), ("returns", "order_id", "return_reason"))
    )),
    "s02_analysis_loader": sql(f"""SELECT order_id, product_id, customer_id, order_date, shipping_date, region, payment_mode, category,
        quantity, {money('revenue')} AS revenue, {money('profit')} AS profit, is_return FROM fact_raw"""),
    "s03_star_csv": sql(f"""SELECT order_id, product_id, name, gender, age, city, order_date, shipping_date, {money('revenue')} AS revenue,
        {money('profit')} AS profit, is_return FROM fact_clean"""),
    "s04_s14_warehouse": sql(f"""SELECT f.order_id, f.product_id, c.name, p.category, d.day_name, {money('f.revenue')} AS revenue,
        {money('f.profit')} AS profit, {money('f.discount_impact')} AS discount_impact
        FROM fact_clean f JOIN clean_customers c ON f.customer_id = c.customer_id JOIN clean_products p ON f.product_id = p.product_id
        JOIN (SELECT date_key, dayname(date_key) AS day_name FROM calendar) d ON f.order_date = d.date_key"""),
    "s04_dim_region": sql("""SELECT row_number() OVER (ORDER BY region, city) AS region_id, region, city
        FROM (SELECT DISTINCT region, city FROM clean_customers)"""),
    "s05_s06_date_spine": sql("SELECT date_key AS ds FROM calendar"),
    "s07_bi_star": sql(_rows(
        dim_date=("SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) FROM (SELECT min(order_date)::DATE AS lo, greatest(max(order_date::DATE), max(shipping_date::DATE)) AS hi FROM raw_orders)", 11),
        dim_customers=("SELECT * FROM raw_customers", 7), dim_products=("SELECT * FROM raw_products", 7),
        fact_sales=("SELECT * FROM fact_raw", 19), returns=("SELECT * FROM raw_returns", 3),
    )),
    "s08_dashboard": sql(_rows(
        sales=("SELECT * FROM fact_raw", 17),
        customers=("SELECT DISTINCT customer_id FROM fact_raw JOIN raw_customers USING (customer_id)", 18),
        regional=("SELECT DISTINCT region, category FROM fact_raw WHERE region IS NOT NULL AND category IS NOT NULL", 11),
        trend=("SELECT DISTINCT date_trunc('month', order_date) FROM fact_raw WHERE order_date IS NOT NULL", 6),
    )),
    # a CSV file has no line numbers; equal lines come in the order of their values
    "s01_s02_star_from_csv": SUMMARIES["fact_clean"].replace("ORDER BY line_no, supp_no, quantity, discount, flag, ext", "ORDER BY quantity, selling_price, discount"),
    "c12_csv_corrupt_rows": sql("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, 0::BIGINT AS corrupt_count FROM raw_{t}"
        for t in ("customers", "products", "orders", "order_items", "returns"))),
    "s03_dim_customers": CLEANING["clean_customers"],
    "s03_dim_products": CLEANING["c08_cost_repair"],
    "s03_dim_orders": CLEANING["c09_ship_repair"],
    "s03_dim_returns": CLEANING["clean_returns"],
    "s07_bi_customers": SUMMARIES["a11_bi_customers"],
    "s07_bi_products": SUMMARIES["a11_bi_products"],
    "s07_bi_date": CATALOG["d2_dim_date_bi"],
    "s07_bi_fact": SUMMARIES["a11_bi_fact"],
    "s07_bi_returns": sql("SELECT order_id, product_id, return_reason FROM raw_returns"),
    "s08_dashboard_customers": SUMMARIES["a5_customer_profiles"],
    "s08_dashboard_sales": SUMMARIES["a8_sales_detail"],
    "s08_dashboard_regional": SUMMARIES["a6_region_category"],
    "s08_dashboard_trend": SUMMARIES["a7_monthly"],
    "s10_forecast_test_csv": MODELS["f4_seasonal_naive_compat"],
    "s10_forecast_ahead_csv": MODELS["f7_horizon_compat"],
    "s11_s12_results_json_category": SUMMARIES["a2_by_category"],
    "s11_s12_results_json_overview": SUMMARIES["a1_overview"],
    "s13_daily_sales_refresh": CATALOG["q13_daily_sales"],
    "s13_daily_sales_stream": CATALOG["q13_daily_sales"],
}
