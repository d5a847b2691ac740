"""Table schemas: raw (staging) tables, dimensions, fact and daily aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

KEY = T.LongType()
PRICE = T.DecimalType(12, 4)
MONEY = T.DecimalType(18, 4)
IMPACT = T.DecimalType(20, 6)
PERCENT = T.DecimalType(5, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Raw tables: dates stay text until they are parsed tolerantly.
CUSTOMERS = _struct(
    customer_id=KEY, name=T.StringType(), gender=T.StringType(), age=T.IntegerType(),
    city=T.StringType(), region=T.StringType(), signup_date=T.StringType(),
)
PRODUCTS = _struct(
    product_id=KEY, category=T.StringType(), sub_category=T.StringType(), brand=T.StringType(),
    cost_price=PRICE, selling_price=PRICE,
)
ORDERS = _struct(
    order_id=KEY, customer_id=KEY, order_date=T.StringType(), shipping_date=T.StringType(),
    region=T.StringType(), payment_mode=T.StringType(),
)
ORDER_ITEMS = _struct(order_id=KEY, product_id=KEY, quantity=T.IntegerType(), selling_price=PRICE, discount=PERCENT)
RETURNS = _struct(order_id=KEY, product_id=KEY, return_reason=T.StringType())

RAW = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "returns": RETURNS,
}

DIM_CUSTOMERS = _struct(
    customer_id=KEY, name=T.StringType(), gender=T.StringType(), age=T.IntegerType(),
    city=T.StringType(), region=T.StringType(), signup_date=T.DateType(), created_at=T.TimestampType(),
)
DIM_PRODUCTS = _struct(
    product_id=KEY, category=T.StringType(), sub_category=T.StringType(), brand=T.StringType(),
    cost_price=PRICE, selling_price=PRICE, created_at=T.TimestampType(),
)
DIM_DATE = _struct(
    date_key=T.DateType(), year=T.IntegerType(), quarter=T.IntegerType(), month=T.IntegerType(),
    month_name=T.StringType(), week=T.IntegerType(), day_of_week=T.IntegerType(),
    day_name=T.StringType(), is_weekend=T.BooleanType(),
)
DIM_REGION = _struct(
    region_id=T.LongType(), region=T.StringType(), city=T.StringType(), state=T.StringType(), zone=T.StringType(),
)
FACT_SALES = _struct(
    order_id=KEY, customer_id=KEY, product_id=KEY, date_key=T.DateType(), quantity=T.IntegerType(),
    selling_price=PRICE, discount=PERCENT, cost_price=PRICE, revenue=MONEY, profit=MONEY,
    discount_impact=IMPACT, is_return=T.BooleanType(), payment_mode=T.StringType(),
    order_date=T.DateType(), shipping_date=T.DateType(),
)
DAILY_SALES = _struct(
    date_key=T.DateType(), category=T.StringType(), sub_category=T.StringType(), brand=T.StringType(),
    region=T.StringType(), orders=T.LongType(), customers=T.LongType(), units_sold=T.LongType(),
    revenue=T.DecimalType(28, 4), profit=T.DecimalType(28, 4), total_cost=T.DecimalType(28, 4),
    profit_margin_pct=T.DoubleType(), returns_count=T.LongType(),
)

WAREHOUSE = {
    "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS,
    "dim_date": DIM_DATE,
    "dim_region": DIM_REGION,
    "fact_sales": FACT_SALES,
    **{f"stage_{name}": schema for name, schema in RAW.items()},
}


#: Keys of the warehouse tables: rows of a key that is there already are not inserted again.
KEYS = {
    "dim_customers": ["customer_id"], "dim_products": ["product_id"], "dim_date": ["date_key"], "dim_region": ["region", "city"],
    "fact_sales": ["order_id", "product_id"],
}
#: Partition column and buckets of the tables that grow. Buckets are of the whole key, so one huge order is spread over all.
PARTITIONS = {"fact_sales": T.StructField("order_month", T.DateType())}
BUCKETS = {"fact_sales": 8}


def create_table_sql(table: str, schema: T.StructType, location: str, partition_by: T.StructField | None = None,
                     bucket_by: Sequence[str] = (), buckets: int = 0) -> str:
    """``CREATE TABLE`` text for a schema: parquet files at a named place, never in a local default folder."""
    fields = [*schema.fields, *([partition_by] if partition_by else [])]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    layout = f" PARTITIONED BY (`{partition_by.name}`)" if partition_by else ""
    if buckets:
        layout += f" CLUSTERED BY ({', '.join(f'`{c}`' for c in bucket_by)}) INTO {buckets} BUCKETS"
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{layout} LOCATION '{location}'"
