"""SQL checks on the dirty flavour of the raw tables: what each rule changes, keeps or rejects there."""

from __future__ import annotations

from salesloom.checks.base import CTES, money, parse, sql
from salesloom.checks.summary_sql import BI_BAND, BINS, SQL_BAND
from salesloom.sources.dirty import DIRTY_SQL

_KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "order_id, product_id", "returns": "order_id, product_id"}

DIRTY: dict[str, str] = {f"dirty_{n}": text.format(**{n: f"raw_{n}"}) for n, text in DIRTY_SQL.items()}
#: The first row of each key as it stands in the file.
DIRTY |= {f"head_{n}": f"SELECT * FROM dirty_{n} QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY pos) = 1" for n, k in _KEYS.items()}

DIRTY["tidy_customers"] = f"""
    SELECT customer_id, name, coalesce(gender, 'Unknown') AS gender,
           coalesce(age, CAST(trunc((SELECT median(age) FROM head_customers)) AS BIGINT)) AS age, city, region,
           CASE WHEN {parse('signup_date')} > DATE '2001-12-31' THEN DATE '2001-12-31' ELSE {parse('signup_date')} END AS signup_date
    FROM head_customers"""
DIRTY["tidy_products"] = """
    SELECT product_id, category, sub_category, brand, price AS selling_price,
           CASE WHEN cost >= price THEN price * CAST(0.7 AS DECIMAL(2,1)) ELSE cost END AS cost_price
    FROM (SELECT *, CASE WHEN selling_price < 0 THEN 0 ELSE selling_price END AS price, CASE WHEN cost_price < 0 THEN 0 ELSE cost_price END AS cost FROM head_products)"""
DIRTY["tidy_orders"] = CTES["clean_orders"].replace("raw_orders", "head_orders")
DIRTY["tidy_lines"] = """
    SELECT order_id, product_id, pos, CASE WHEN quantity < 1 THEN 1 ELSE quantity END AS quantity,
           CASE WHEN selling_price < 0 THEN 0 ELSE selling_price END AS selling_price,
           CASE WHEN discount < 0 THEN 0 WHEN discount > 100 THEN 100 ELSE discount END AS discount
    FROM dirty_order_items"""
DIRTY["tidy_items"] = "SELECT * FROM tidy_lines QUALIFY row_number() OVER (PARTITION BY order_id, product_id ORDER BY pos) = 1"
DIRTY["tidy_fact"] = CTES["fact_clean"].replace("first_items", "tidy_items").replace("clean_orders", "tidy_orders").replace(
    "clean_products", "tidy_products").replace("clean_customers", "tidy_customers").replace("clean_returns", "head_returns")
DIRTY["rough_fact"] = CTES["fact_raw"].replace("raw_order_items", "dirty_order_items").replace("raw_orders", "dirty_orders").replace(
    "raw_products", "dirty_products").replace("raw_returns", "dirty_returns").replace(", r.flag", "").replace("i.line_no, i.supp_no, i.flag, i.ext", "i.pos")


def _sql(body: str) -> str:
    return sql(body, **DIRTY)


_LINE = f"""order_id, product_id, quantity, {money('selling_price')} AS selling_price, {money('discount')} AS discount, customer_id, order_date, shipping_date,
    region, payment_mode, {money('cost_price')} AS cost_price, category, sub_category, brand, {money('revenue')} AS revenue,
    {money('cost_total')} AS cost_total, {money('profit')} AS profit, {money('discount_impact')} AS discount_impact, is_return"""


def _orphans(name: str, child: str, key: str, parent: str) -> str:
    keys = [k.strip() for k in key.split(",")]
    same = " AND ".join(f"p.{k} = c.{k}" for k in keys)
    there = " AND ".join(f"c.{k} IS NOT NULL" for k in keys)
    return f"""SELECT '{name}' AS check_name, count(*) AS orphan_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows FROM (
        SELECT {key}, count(*) AS n FROM {child} c WHERE {there} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {same}) GROUP BY {key})"""


def _duplicates(name: str, table: str, key: str) -> str:
    missing = " OR ".join(f"{k.strip()} IS NULL" for k in key.split(","))
    return f"""SELECT '{name}' AS check_name, CAST(count(*) FILTER (WHERE n > 1 AND NOT ({missing})) AS BIGINT) AS duplicate_keys,
        CAST(coalesce(sum(n) FILTER (WHERE {missing}), 0) AS BIGINT) AS null_key_rows FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key})"""


_UNKNOWN = {
    "customer is unknown": ("orders", "customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM dirty_customers WHERE customer_id IS NOT NULL)"),
    "order is unknown": ("order_items", "order_id NOT IN (SELECT order_id FROM dirty_orders)"),
    "product is unknown": ("order_items", "product_id NOT IN (SELECT product_id FROM dirty_products)"),
    "line is unknown": ("returns", "(order_id, product_id) NOT IN (SELECT (order_id, product_id) FROM dirty_order_items)"),
}


def _unreadable(c: str) -> str:
    return f"{c} <> '' AND {parse(c)} IS NULL"


_RULES = [
    *[(t, "key is missing", " OR ".join(f"{k.strip()} IS NULL" for k in key.split(","))) for t, key in _KEYS.items()],
    *[(t, rule, broken) for rule, (t, broken) in _UNKNOWN.items()],
    ("customers", "name holds a quote", "contains(name, '''')"), ("customers", "age is missing", "age IS NULL"),
    ("customers", "signup date is unreadable", _unreadable("signup_date")), ("customers", "signup date is to come", f"{parse('signup_date')} > DATE '2001-12-31'"),
    *[("products", f"{c} is negative", f"{c} < 0") for c in ("cost_price", "selling_price")],
    ("products", "cost reaches the price", "greatest(cost_price, 0) >= greatest(selling_price, 0)"),
    ("orders", "customer is missing", "customer_id IS NULL"), ("orders", "order date is unreadable", _unreadable("order_date")),
    ("orders", "shipped before the order", f"{parse('shipping_date')} < {parse('order_date')}"),
    ("order_items", "quantity is too low", "quantity < 1"), ("order_items", "selling_price is negative", "selling_price < 0"),
    ("order_items", "discount is out of range", "discount < 0 OR discount > 100"),
    *[(t, "rows", "true") for t in _KEYS], ("customers", "rejected", "customer_id IS NULL"), ("products", "rejected", "product_id IS NULL"),
    ("orders", "rejected", f"order_id IS NULL OR ({_UNKNOWN['customer is unknown'][1]})"),
    ("order_items", "rejected", f"order_id IS NULL OR product_id IS NULL OR {_UNKNOWN['order is unknown'][1]} OR {_UNKNOWN['product is unknown'][1]}"),
    ("returns", "rejected", f"order_id IS NULL OR product_id IS NULL OR {_UNKNOWN['line is unknown'][1]}"),
]

SQL: dict[str, str] = {
    "c01_csv_first_in_file": _sql("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, {a} AS key_1, CAST({b} AS BIGINT) AS key_2, CAST({v} AS VARCHAR) AS kept_value FROM head_{t}" for t, a, b, v in (
            ("customers", "customer_id", "NULL", "name"), ("products", "product_id", "NULL", "brand"), ("orders", "order_id", "NULL", "payment_mode"),
            ("order_items", "order_id", "product_id", "quantity"), ("returns", "order_id", "product_id", "return_reason")))),
    "c02_c05_dirty_customers": _sql("SELECT * FROM tidy_customers"),
    "c06_dirty_clip": _sql(f"SELECT order_id, product_id, quantity, {money('selling_price')} AS selling_price, {money('discount')} AS discount FROM tidy_lines"),
    "c06_c08_dirty_prices": _sql(f"SELECT product_id, {money('cost_price')} AS cost_price, {money('selling_price')} AS selling_price FROM tidy_products"),
    "c09_dirty_shipping": _sql("SELECT order_id, customer_id, order_date, shipping_date, region, payment_mode FROM tidy_orders"),
    "c15_dirty_foreign_keys": _sql("\nUNION ALL ".join([
        _orphans("orders.customer_id", "dirty_orders", "customer_id", "dirty_customers"), _orphans("order_items.order_id", "dirty_order_items", "order_id", "dirty_orders"),
        _orphans("order_items.product_id", "dirty_order_items", "product_id", "dirty_products"),
        _orphans("returns.line", "dirty_returns", "order_id, product_id", "dirty_order_items")])),
    "c15_quarantine_counts": _sql("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, CAST(count(*) FILTER (WHERE {broken}) AS BIGINT) AS row_count FROM dirty_{t}" for t, rule, broken in _RULES)),
    "c15_quarantined_lines": _sql(f"""SELECT order_id, product_id, quantity, array_to_string(list_filter([
            CASE WHEN {_UNKNOWN['order is unknown'][1]} THEN 'order is unknown' END, CASE WHEN {_UNKNOWN['product is unknown'][1]} THEN 'product is unknown' END,
            CASE WHEN quantity < 1 THEN 'quantity is too low' END, CASE WHEN selling_price < 0 THEN 'selling_price is negative' END,
            CASE WHEN discount < 0 OR discount > 100 THEN 'discount is out of range' END], lambda x: x IS NOT NULL), '; ') AS rules
        FROM dirty_order_items WHERE {_UNKNOWN['order is unknown'][1]} OR {_UNKNOWN['product is unknown'][1]}"""),
    "c16_dirty_keys": _sql("\nUNION ALL ".join(_duplicates(t, f"dirty_{t}", k) for t, k in _KEYS.items())),
    "c17_dirty_quotes": _sql("SELECT customer_id, replace(name, '''', '') AS name FROM head_customers"),
    "fact_clean_dirty": _sql(f"SELECT {_LINE}, name, gender, age, city, customer_region, customer_region IS NOT NULL AS has_customer, category IS NOT NULL AS has_product FROM tidy_fact"),
    "fact_raw_dirty": _sql(f"SELECT {_LINE} FROM rough_fact"),
    "j04_dirty_inner": _sql(f"""SELECT order_id, product_id, quantity, {money('revenue')} AS revenue, {money('profit')} AS profit FROM rough_fact
        WHERE category IS NOT NULL AND order_id IN (SELECT order_id FROM dirty_orders)"""),
    "m10_m12_dirty_bands": _sql(f"""SELECT CAST(discount AS DOUBLE) AS discount, count(*) AS line_count, {SQL_BAND} AS sql_band, {BINS} AS bin_band, {BI_BAND} AS bi_band
        FROM rough_fact GROUP BY discount"""),
}
