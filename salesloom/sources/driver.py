"""Adapter: TPC-H-like parquet tables -> the five raw sales tables.

The parquet tables carry no cost, payment mode, signup date or return reason, so those columns are
derived from keys by fixed arithmetic. Money is only ever a product of decimals, never a quotient,
so any engine computes the same digits. Keys stay 64-bit: order keys pass 2**31 long before 100 TB.

``order_items`` keeps four helper columns (line_no, supp_no, flag, ext) that stand for the file order.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from salesloom.sources.tables import RawTables

# Columns that replace the position of a line in its file.
FILE_ORDER = ["line_no", "supp_no", "quantity", "discount", "flag", "ext"]

RAW_SQL = {
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS name,
               CASE WHEN c_custkey % 25 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(18 + (c_custkey * 7) % 60 AS INT) END AS age,
               n_name AS city, r_name AS region,
               CASE WHEN c_custkey % 20 = 0 THEN ''
                    WHEN c_custkey % 20 = 1 THEN substr(sd, 9, 2) || '-' || substr(sd, 6, 2) || '-' || substr(sd, 1, 4)
                    WHEN c_custkey % 50 = 7 THEN '2099-01-01' ELSE sd END AS signup_date
        FROM (SELECT c.*, n_name, r_name,
                     CAST(DATE '1993-01-01' + CAST(c_custkey % 700 AS INT) AS STRING) AS sd
              FROM {customer} c LEFT JOIN {nation} ON c_nationkey = n_nationkey
                   LEFT JOIN {region} ON n_regionkey = r_regionkey) t""",
    "products": """
        SELECT p_partkey AS product_id, p_type AS category, split_part(p_name, ' ', 2) AS sub_category,
               p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS selling_price,
               CAST(p_retailprice AS DECIMAL(10,2)) *
                 CASE WHEN p_partkey % 50 = 0 THEN CAST(1.10 AS DECIMAL(3,2))
                      WHEN p_type IN ('ECONOMY','SMALL') THEN CAST(0.45 AS DECIMAL(3,2))
                      WHEN p_type IN ('MEDIUM','LARGE') THEN CAST(0.60 AS DECIMAL(3,2))
                      ELSE CAST(0.70 AS DECIMAL(3,2)) END AS cost_price
        FROM {part}""",
    "orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date,
               CAST(CAST(s.ship AS DATE) AS STRING) AS shipping_date,
               r_name AS region,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL
                    WHEN o_orderpriority = '5-LOW' THEN 'COD' WHEN o_orderpriority = '1-URGENT' THEN 'Voucher'
                    WHEN o_orderpriority = '2-HIGH' THEN 'Wallet' WHEN o_orderpriority = '3-MEDIUM' THEN 'Invoice'
                    ELSE 'Direct debit' END AS payment_mode
        FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey LEFT JOIN {nation} ON c_nationkey = n_nationkey
             LEFT JOIN {region} ON r_regionkey = (n_regionkey + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END) % 5
             LEFT JOIN (SELECT l_orderkey AS k, min(l_shipdate) AS ship FROM {lineitem} GROUP BY l_orderkey) s
               ON s.k = o_orderkey""",
    "order_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
               CAST(p_retailprice AS DECIMAL(10,2)) * (100 - CAST(round(l_discount * 100) AS INT) * 5)
                 * CAST(0.01 AS DECIMAL(3,2)) AS selling_price,
               CAST(round(l_discount * 100) AS INT) * 5 AS discount,
               l_linenumber AS line_no, l_suppkey AS supp_no, l_returnflag AS flag, l_extendedprice AS ext
        FROM {lineitem} LEFT JOIN {part} ON l_partkey = p_partkey""",
    "returns": """
        SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id,
               CASE CAST((l_orderkey + l_partkey) % 8 AS INT)
                 WHEN 0 THEN 'Broken on arrival' WHEN 1 THEN 'Colour differs' WHEN 2 THEN 'Too large'
                 WHEN 3 THEN 'Too small' WHEN 4 THEN 'Ordered twice' WHEN 5 THEN 'Parts missing'
                 WHEN 6 THEN 'No longer needed' ELSE NULL END AS return_reason
        FROM {lineitem} WHERE l_returnflag = 'R'""",
}

# Map pins of the driver's regions.
DRIVER_COORDS = {
    "AFRICA": (1.5, 17.3),
    "AMERICA": (19.4, -99.1),
    "ASIA": (34.0, 100.6),
    "EUROPE": (50.1, 14.4),
    "MIDDLE EAST": (29.3, 42.5),
}

# Price columns get the engine's own fixed type whatever the SQL arithmetic inferred.
PRICE_COLUMNS = {"products": ["selling_price", "cost_price"], "order_items": ["selling_price"]}


def read_driver(spark: SparkSession, sf_dir: str) -> RawTables:
    """Raw tables as lazy views over the parquet files of ``sf_dir``."""
    def scan(table: str) -> DataFrame:
        return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))

    base = {t: scan(t) for t in ("customer", "nation", "region", "part", "orders", "lineitem")}
    out = {}
    for name, text in RAW_SQL.items():
        used = {t: df for t, df in base.items() if "{" + t + "}" in text}
        df = spark.sql(text, **used)
        for column in PRICE_COLUMNS.get(name, []):
            df = df.withColumn(column, df[column].cast("decimal(12,4)"))
        if name == "order_items":
            df = df.withColumn("discount", df["discount"].cast("decimal(5,2)"))
        out[name] = df
    return RawTables(**out)
