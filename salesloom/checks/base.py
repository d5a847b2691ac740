"""Common table expressions of the SQL checks: raw tables, cleaned tables and both facts, in DuckDB SQL."""

from __future__ import annotations

from salesloom.sources.driver import RAW_SQL

_NAMES = {t: t for t in ("customer", "nation", "region", "part", "orders", "lineitem")}

_PARSE = "TRY_CAST(NULLIF({0}, '') AS DATE)"


def parse(column: str) -> str:
    return _PARSE.format(column)


CTES: dict[str, str] = {f"raw_{name}": text.format(**_NAMES) for name, text in RAW_SQL.items()}
# whole numbers are bigint in every published result
CTES["raw_customers"] = CTES["raw_customers"].replace("% 60 AS INT)", "% 60 AS BIGINT)")
CTES["raw_order_items"] = CTES["raw_order_items"].replace("CAST(l_quantity AS INT)", "CAST(l_quantity AS BIGINT)").replace(
    "l_linenumber AS line_no", "CAST(l_linenumber AS BIGINT) AS line_no")

CTES["clean_customers"] = f"""
    SELECT customer_id, name, coalesce(gender, 'Unknown') AS gender,
           coalesce(age, CAST(trunc((SELECT median(age) FROM raw_customers)) AS BIGINT)) AS age, city, region,
           CASE WHEN {parse('signup_date')} > DATE '2001-12-31' THEN DATE '2001-12-31'
                ELSE {parse('signup_date')} END AS signup_date
    FROM raw_customers
    QUALIFY row_number() OVER (PARTITION BY customer_id
        ORDER BY name NULLS LAST, gender NULLS LAST, age NULLS LAST, city NULLS LAST, region NULLS LAST, signup_date NULLS LAST) = 1"""

CTES["clean_products"] = """
    SELECT product_id, category, sub_category, brand, greatest(selling_price, 0) AS selling_price,
           CASE WHEN cost_price >= selling_price THEN selling_price * CAST(0.7 AS DECIMAL(2,1)) ELSE cost_price END AS cost_price
    FROM raw_products"""

CTES["clean_orders"] = f"""
    SELECT order_id, customer_id, od AS order_date,
           CASE WHEN sd < od THEN CAST(od + INTERVAL 1 DAY AS DATE) ELSE sd END AS shipping_date,
           coalesce(region, 'Unknown') AS region, coalesce(payment_mode, 'Unknown') AS payment_mode
    FROM (SELECT *, {parse('order_date')} AS od, {parse('shipping_date')} AS sd FROM raw_orders)"""

CTES["clean_returns"] = """
    SELECT order_id, product_id, coalesce(min(return_reason), 'Not specified') AS return_reason
    FROM raw_returns GROUP BY order_id, product_id"""

CTES["first_items"] = """
    SELECT * FROM raw_order_items
    QUALIFY row_number() OVER (PARTITION BY order_id, product_id
        ORDER BY line_no, supp_no, quantity, discount, flag, ext) = 1"""

_MEASURES = """
           {i}.quantity * {i}.selling_price AS revenue, {i}.quantity * {p}.cost_price AS cost_total,
           {i}.quantity * {i}.selling_price - {i}.quantity * {p}.cost_price AS profit,
           {i}.discount * ({i}.quantity * {i}.selling_price) * CAST(0.01 AS DECIMAL(3,2)) AS discount_impact"""

CTES["fact_clean"] = f"""
    SELECT i.order_id, i.product_id, i.quantity, i.selling_price, i.discount, o.customer_id, o.order_date,
           o.shipping_date, o.region, o.payment_mode, p.cost_price, p.category, p.sub_category, p.brand,
           c.name, c.gender, c.age, c.city, c.region AS customer_region,
           {_MEASURES.format(i='i', p='p')},
           r.order_id IS NOT NULL AS is_return
    FROM first_items i LEFT JOIN clean_orders o ON i.order_id = o.order_id
         LEFT JOIN clean_products p ON i.product_id = p.product_id
         LEFT JOIN clean_customers c ON o.customer_id = c.customer_id
         LEFT JOIN clean_returns r ON i.order_id = r.order_id AND i.product_id = r.product_id"""

CTES["fact_raw"] = f"""
    SELECT i.order_id, i.product_id, i.quantity, i.selling_price, i.discount, o.customer_id,
           {parse('o.order_date')} AS order_date, {parse('o.shipping_date')} AS shipping_date,
           o.region, o.payment_mode, p.cost_price, p.category, p.sub_category, p.brand,
           {_MEASURES.format(i='i', p='p')},
           EXISTS (SELECT 1 FROM raw_returns r WHERE r.order_id = i.order_id AND r.product_id = i.product_id) AS is_return,
           i.line_no, i.supp_no, i.flag, i.ext
    FROM raw_order_items i LEFT JOIN raw_orders o ON i.order_id = o.order_id
         LEFT JOIN raw_products p ON i.product_id = p.product_id"""

CTES["calendar"] = """
    SELECT CAST(d AS DATE) AS date_key
    FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
          FROM (SELECT min(order_date) AS lo, greatest(max(order_date), max(shipping_date)) AS hi FROM clean_orders))"""


def _needed(text: str, extra: dict[str, str]) -> list[str]:
    """CTEs a text uses, directly or through other CTEs, in definition order."""
    pool = {**CTES, **extra}
    wanted, todo = set(), [text]
    while todo:
        current = todo.pop()
        for name in pool:
            if name not in wanted and name in current:
                wanted.add(name)
                todo.append(pool[name])
    return [name for name in pool if name in wanted]


def sql(body: str, **ctes: str) -> str:
    """``body`` headed by the CTEs it needs; ``ctes`` adds some of its own, in order."""
    names = _needed(body, ctes)
    pool = {**CTES, **ctes}
    head = ",\n".join(f"{name} AS ({pool[name]})" for name in names)
    return f"WITH {head}\n{body}" if head else body


def money(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def rnd(expression: str, scale: int = 2) -> str:
    """Round half up, deciding ties at eight digits."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(30,8)), {scale}) AS DOUBLE)"


def pct(num: str, den: str, scale: int = 2) -> str:
    return rnd(f"(CAST({num} AS DOUBLE) * 100.0 / NULLIF(CAST({den} AS DOUBLE), 0))", scale)


def per(num: str, den: str, scale: int = 2) -> str:
    return rnd(f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))", scale)
