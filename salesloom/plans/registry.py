"""Every query by name: a function of the mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions import bands, dates
from salesloom.operators import catalog as C
from salesloom.operators import cleaning as K
from salesloom.operators import forecast as P
from salesloom.operators import insights as I
from salesloom.operators import measures as B
from salesloom.operators import quality as QU
from salesloom.operators import segment as R
from salesloom.operators import star
from salesloom.operators import stats as X
from salesloom.operators import summaries as S
from salesloom.operators import visuals as V
from salesloom.plans.layout import MONTH
from salesloom.plans.mart import Mart, mart
from salesloom.plans.ordered import Ordered
from salesloom.sources import quarantine as QT
from salesloom.sources import sinks
from salesloom.sources.dirty import write_dirty_csv
from salesloom.sources.driver import DRIVER_COORDS, FILE_ORDER
from salesloom.sources.raw_csv import POSITION, corrupt_rows, read_raw
from salesloom.sources.tables import RawTables
from salesloom.streaming.refresh import refresh_from_stream

Query = Callable[[Mart], DataFrame]


def published(df: DataFrame) -> DataFrame:
    """Plain output types: decimals as double, whole numbers as bigint."""
    def plain(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(field.name)
        return c
    return df.select(*[plain(f) for f in df.schema.fields])


def _journeys(m: Mart) -> Ordered:
    return m.once("journeys", lambda: C.journey_index(m.fact_clean, m.store("journeys")))


def _pareto(m: Mart) -> DataFrame:
    return S.pareto_curve(m.fact_raw, m.once("pareto", lambda: S.pareto_index(m.fact_raw, m.store("pareto"))))


CATALOG: dict[str, Query] = {
    "q01_revenue_by_region": lambda m: C.revenue_by_region(m.fact_clean),
    "q02_monthly_trend": lambda m: C.monthly_trend(m.fact_clean, m.dim_date),
    "q03_top_products": lambda m: C.top_products(m.fact_clean, m.products),
    "q04_customer_lifetime_value": lambda m: C.top_customers(m.fact_clean, m.customers),
    "q04_customer_value_all": lambda m: C.customer_value(m.fact_clean, m.customers),
    "q05_repeat_purchases": lambda m: C.repeat_purchases(m.fact_clean),
    "q06_return_rate_by_category": lambda m: C.return_rate_by_category(m.fact_clean),
    "q07_lowest_margin_products": lambda m: C.lowest_margin_products(m.fact_clean, m.products),
    "q08_cohort_retention": lambda m: C.cohort_retention(m.fact_clean),
    "q09_next_purchases": lambda m: C.next_purchases(m.fact_clean),
    "w05_w06_customer_journey": lambda m: C.customer_journey(m.fact_clean, _journeys(m)),
    "q10_discount_bands": lambda m: C.discount_bands(m.fact_clean),
    "q11_payment_modes": lambda m: C.payment_modes(m.fact_clean),
    "q12_worst_products": lambda m: C.worst_products(m.fact_clean, m.products),
    "q13_daily_sales": lambda m: C.daily_sales(m.fact_clean),
    "d1_dim_date_warehouse": lambda m: m.dim_date,
    "d2_dim_date_bi": lambda m: star.dim_date_bi(star.order_date_bounds(star.parse_order_dates(m.raw.orders))),
}

# Fixed value: last regular order date of the driver tables; later orders count as future-dated.
LAST_ORDER_DATE = dt.date(2000, 12, 31)

CLEANING: dict[str, Query] = {
    "c01_keep_first": lambda m: K.keep_first(m.raw.order_items, ["order_id", "product_id"], FILE_ORDER).drop("selling_price"),
    "c02_median_age": lambda m: K.fill_age(m.raw.customers).select("customer_id", "age"),
    "c03_tolerant_dates": lambda m: m.raw.customers.select(
        "customer_id", F.col("signup_date").alias("signup_text"), dates.parse_date("signup_date").alias("signup_date")),
    "c04_default_fill": lambda m: m.raw.orders.na.fill({"region": K.UNKNOWN, "payment_mode": K.UNKNOWN}).select(
        "order_id", "region", "payment_mode"),
    "c05_future_signup": lambda m: m.raw.customers.select(
        "customer_id", K.not_after(dates.parse_date("signup_date"), m.as_of).alias("signup_date")),
    "c06_c07_clip": lambda m: K.clean_order_items(m.raw.order_items).drop("ext"),
    "c08_cost_repair": lambda m: K.repair_cost(m.raw.products).select("product_id", "cost_price", "selling_price"),
    "c09_ship_repair": lambda m: K.repair_shipping(star.parse_order_dates(m.raw.orders)).select(
        "order_id", "order_date", "shipping_date"),
    "c10_null_profile": lambda m: QU.null_profile(_parsed(m)),
    "c11_null_signups": lambda m: QU.null_signups(m.raw.customers),
    "c12_dataset_profile": lambda m: QU.dataset_profile(dict(m.raw.items()), {"orders": "order_date", "returns": "return_reason"}),
    "c13_order_date_quality": lambda m: QU.order_date_quality(m.raw.orders, LAST_ORDER_DATE),
    "c14_malformed_signups": lambda m: QU.malformed_signups(m.raw.customers),
    "c15_foreign_keys": lambda m: QU.foreign_key_violations([
        ("orders.customer_id", m.raw.orders, ["customer_id"], m.raw.customers),
        ("order_items.order_id", m.raw.order_items, ["order_id"], m.raw.orders),
        ("order_items.product_id", m.raw.order_items, ["product_id"], m.raw.products),
        ("orders.without_lines", m.raw.orders, ["order_id"], m.raw.order_items),
        ("returns.line", m.raw.returns, ["order_id", "product_id"], m.raw.order_items),
        ("fact.date", m.fact_clean.select(F.col("order_date").alias("date_key")), ["date_key"], m.dim_date),
    ]),
    "c16_keys": lambda m: QU.key_violations([
        ("customers", m.raw.customers, ["customer_id"]), ("products", m.raw.products, ["product_id"]),
        ("orders", m.raw.orders, ["order_id"]), ("order_items", m.raw.order_items, ["order_id", "product_id"]),
        ("returns", m.raw.returns, ["order_id", "product_id"]), ("fact_clean", m.fact_clean, ["order_id", "product_id"]),
    ]),
    "c17_strip_quotes": lambda m: K.strip_quotes(m.raw.customers, "name").select("customer_id", "name"),
    "clean_customers": lambda m: m.customers,
    "clean_returns": lambda m: m.returns,
}

def _bands(fact: DataFrame) -> DataFrame:
    """The three band flavours of every discount that occurs."""
    return fact.groupBy("discount").agg(F.count(F.lit(1)).alias("line_count")).withColumns({
        "sql_band": bands.discount_band_sql(F.col("discount")), "bin_band": bands.discount_band_bins(F.col("discount")),
        "bi_band": bands.discount_band_bi(F.col("discount"))})


FACTS: dict[str, Query] = {
    "fact_raw": lambda m: m.fact_raw,
    "fact_clean": lambda m: m.fact_clean,
    "j04_inner_fact": lambda m: star.build_raw_fact(m.raw, keep=["line_no", "supp_no"], how="inner").select(
        "order_id", "product_id", "line_no", "supp_no", "region", "category", "revenue", "is_return"),
    "p01_p10_line_filters": lambda m: S.filter_profile(m.fact_raw, S.line_filters()),
    "p02_p07_p11_segment_filters": lambda m: S.filter_profile(m.fact_raw, S.segment_filters("ECONOMY", "ASIA", [1996, 1997])),
    "m10_m12_band_flavours": lambda m: _bands(m.fact_raw),
}

SUMMARIES: dict[str, Query] = {
    "a1_overview": lambda m: S.overview(m.fact_raw),
    "a2_by_category": lambda m: S.by_category(m.fact_raw),
    "a3_by_region": lambda m: S.by_region(m.fact_raw),
    "a4_by_discount_band": lambda m: S.by_discount_band(m.fact_raw),
    "a5_customer_profiles": lambda m: S.customer_profiles(m.fact_raw, m.raw.customers),
    "a6_region_category": lambda m: S.region_category(m.fact_raw, DRIVER_COORDS),
    "a7_monthly": lambda m: S.monthly(m.fact_raw),
    "a8_sales_detail": lambda m: S.sales_detail(m.fact_raw),
    "l04_table_head": lambda m: S.table_head(S.customer_profiles(m.fact_raw, m.raw.customers), 25, "customer_id").select(
        "customer_id", "name", "total_revenue", "orders"),
    "a9_products_per_category": lambda m: S.products_per_category(m.raw.products),
    "a10_line_return_rate": lambda m: S.line_return_rate_by(m.fact_raw, "category"),
    "a11_bi_customers": lambda m: S.bi_customers(m.raw.customers),
    "a11_bi_products": lambda m: S.bi_products(m.raw.products),
    "a11_bi_fact": lambda m: S.bi_fact(m.fact_raw),
    "k01_kpi_strip": lambda m: S.kpi_strip(m.fact_raw),
    "k02_category_chart": lambda m: S.category_chart(m.fact_raw),
    "k03_region_chart": lambda m: S.region_chart(m.fact_raw),
    "k04_discount_chart": lambda m: S.discount_chart(m.fact_raw),
    "k05_w07_pareto_curve": lambda m: _pareto(m),
    "k06_monthly_peaks": lambda m: S.monthly_peaks(m.fact_raw),
    "k07_return_benchmark": lambda m: S.return_benchmark(m.fact_raw),
    "k09_return_reasons": lambda m: S.return_reasons(m.raw.returns),
    "k10_order_value_by_region": lambda m: S.order_value_by_region(m.fact_raw),
    "k11_payment_returns": lambda m: S.payment_returns(m.fact_raw),
}


MEASURES: dict[str, Query] = {
    "b01_b06_core": lambda m: B.core(m.fact_raw),
    "b01_b06_core_by_region_category": lambda m: B.core(m.fact_raw, ["region", "category"]),
    "b07_b12_b27_ratios": lambda m: B.ratios(m.fact_raw),
    "b07_b12_b27_ratios_by_category": lambda m: B.ratios(m.fact_raw, ["category"]),
    "b07_filtered_by_slicer": lambda m: B.measures(
        m.fact_raw, ["total_revenue", "profit_margin"], ["region"], B.slicer(years=[1997], quarters=[2])),
    "b13_b16_previous_periods": lambda m: B.previous_periods(m.fact_raw),
    "b17_b20_period_to_date": lambda m: B.period_to_date(m.fact_raw),
    "b21_b22_product_ranks": lambda m: m.once("product-ranks", lambda: m.publish("product_ranks", B.product_ranks(m.fact_raw, m.products))),
    "b23_customer_ranks": lambda m: m.once("customer-ranks", lambda: m.publish("customer_ranks", B.customer_ranks(m.fact_raw, m.customers))),
    "b24_customer_segments": lambda m: B.customer_segments(m.fact_raw),
    "b25_discount_bands": lambda m: B.discount_bands(m.fact_raw),
    "b26_reason_list": lambda m: B.reason_list(m.raw.returns),
    "b28_report_title": lambda m: B.report_title(m.fact_raw),
    "b28_report_title_selected": lambda m: B.report_title(m.fact_raw, B.slicer(years=[1998], months=[3]), month=True),
    "v00_slicers": lambda m: V.slicers(m.fact_raw),
    "v01_kpi_cards": lambda m: V.kpi_cards(m.fact_raw, B.slicer(years=[1997], regions=["ASIA"])),
    "v02_revenue_over_time": lambda m: V.revenue_over_time(m.fact_raw),
    "v03_revenue_by_category": lambda m: V.revenue_by(m.fact_raw, "category"),
    "v04_region_map": lambda m: V.region_map(m.fact_raw, DRIVER_COORDS),
    "v05_top_products_by_revenue": lambda m: V.top_products_by_revenue(m.fact_clean, m.products),
    "v06_monthly_revenue": lambda m: V.monthly_revenue(m.fact_raw),
    "v07_region_by_year": lambda m: V.region_by_year(m.fact_raw),
    "v08_category_by_month": lambda m: V.category_by_month(m.fact_raw),
    "v09_revenue_waterfall": lambda m: V.revenue_waterfall(m.fact_raw),
    "v10b_top_customers": lambda m: V.top_customers_by_revenue(m.fact_raw),
    "v10c_segment_distribution": lambda m: B.segment_distribution(m.fact_raw),
    "v10e_customer_cards": lambda m: V.customer_cards(m.fact_raw),
    "v10d_repeat_rate": lambda m: I.repeat_rate(m.fact_raw),
    "v10f_top_products_by_profit": lambda m: C.top_products(m.fact_clean, m.products),
    "v11_category_matrix": lambda m: V.category_matrix(m.fact_raw),
    "v12_discount_scatter": lambda m: V.discount_scatter(m.fact_raw),
    "v13_negative_margin_products": lambda m: V.negative_margin_products(m.fact_raw, m.products),
    "v14_return_gauge": lambda m: V.return_gauge(m.fact_raw),
    "v15_return_rate_by_category": lambda m: S.by_category(m.fact_raw).select("category", "return_rate"),
    "v16_return_reasons": lambda m: S.return_reasons(m.raw.returns),
    "v17_return_rate_trend": lambda m: V.return_rate_trend(m.fact_raw),
    "v18_returns_by_payment_mode": lambda m: V.returns_by_payment_mode(m.fact_raw),
    "x1_k12_correlations": lambda m: X.correlations(m.fact_raw),
    "x1_key_correlations": lambda m: X.key_correlations(m.fact_raw),
}


# The regions the margin scenarios compare on the driver tables.
GAP_REGIONS = ("ASIA", "EUROPE")

INSIGHTS: dict[str, Query] = {
    "i01_pareto_share": lambda m: I.concentration(m.fact_raw, curve=_pareto(m)),
    "i02_worst_return_category": lambda m: I.worst_return_category(m.fact_raw),
    "i03_margin_extremes": lambda m: I.margin_extremes(m.fact_raw),
    "i04_deep_discount_margin": lambda m: I.deep_discount_margin(m.fact_raw),
    "i05_repeat_rate": lambda m: I.repeat_rate(m.fact_raw),
    "i06_cod_risk": lambda m: I.cod_risk(m.fact_raw),
    "i07_order_value_change": lambda m: I.order_value_change(m.fact_raw),
    "i08_cod_orders": lambda m: I.cod_orders(m.raw.orders),
    "i09_cod_return_cost": lambda m: I.cod_return_cost(m.fact_raw, m.raw.orders),
    "i10_profit_at_risk": lambda m: I.profit_at_risk(m.fact_raw),
    "i11_margin_gap": lambda m: I.margin_gap(m.fact_raw, *GAP_REGIONS),
    "i12_loss_leaders": lambda m: I.loss_leaders(m.raw.products),
    "i13_kpi_targets": lambda m: I.kpi_targets(m.fact_raw),
    "i14_deep_band_profit": lambda m: I.deep_band_profit(m.fact_raw),
    "i16_initiative_roi": lambda m: I.initiative_roi(m.fact_raw, m.raw.orders, *GAP_REGIONS),
    "i17_product_margin_tiers": lambda m: I.product_margin_tiers(m.fact_raw),
    "i18_concentration": lambda m: I.concentration(m.fact_raw, [0.1, 0.2], [0.5], _pareto(m)),
    "i19_thin_margin_products": lambda m: I.thin_margin_products(m.fact_raw, m.products),
    "i20_repeat_returns": lambda m: I.repeat_returns(m.fact_raw),
    "i21_revenue_at_risk": lambda m: I.revenue_at_risk(m.fact_raw, m.raw.orders, *GAP_REGIONS, curve=_pareto(m)),
    "i22_fraction_reaching": lambda m: I.fraction_reaching(m.fact_raw, curve=_pareto(m)),
}


def segments(m: Mart) -> R.Segmentation:
    """Fitted once per mart; every segment report reads it."""
    return m.once("segments", lambda: R.segment(R.rfm(m.fact_raw)))


def _profile(m: Mart) -> DataFrame:
    return R.profile(segments(m).assigned)


# Limits of the segments by revenue on the driver tables.
SPEND_LIMITS = (850_000, 550_000)


def _by_spend(m: Mart) -> DataFrame:
    return R.by_spend(R.rfm(m.fact_raw), SPEND_LIMITS)


def _daily(m: Mart) -> DataFrame:
    """The daily series, published once: forecasts read it several times, the fact only once."""
    return m.once("daily_series", lambda: m.publish("daily_series", P.daily_series(m.fact_raw)))


def _both(make: Callable[[str], DataFrame]) -> DataFrame:
    first, second = (make(mode) for mode in P.MODES)
    return first.unionByName(second)


MODELS: dict[str, Query] = {
    "r1_rfm": lambda m: R.rfm(m.fact_raw),
    "r2_r3_cluster_scores": lambda m: segments(m).score_table(),
    "r4_r7_segments": lambda m: R.export_columns(segments(m).assigned),
    "r5_k08_segment_profile": _profile,
    "r6_segment_labels": lambda m: R.labelled(_profile(m)),
    "v10a_recency_monetary": lambda m: segments(m).assigned.select("customer_id", "recency", "monetary", "segment"),
    "i15_reactivation_value": lambda m: I.reactivation_value(_profile(m)),
    "r2_scaled_features": lambda m: R.scaled_columns(R.rfm(m.fact_raw)),
    "r3_r4_cluster_invariants": lambda m: R.invariants(segments(m), R.rfm(m.fact_raw)),
    "r5_k08_profile_by_spend": lambda m: R.profile(_by_spend(m)),
    "r6_labels_by_spend": lambda m: R.labelled(R.profile(_by_spend(m))),
    "r7_export_by_spend": lambda m: R.export_columns(_by_spend(m)),
    "v10a_recency_monetary_by_spend": lambda m: _by_spend(m).select("customer_id", "recency", "monetary", "segment"),
    "i15_reactivation_by_spend": lambda m: I.reactivation_value(R.profile(_by_spend(m))),
    "f1_daily_series": lambda m: P.daily_series(m.fact_raw),
    "f2_filled_days": lambda m: P.fill_days(_daily(m)),
    "f3_w10_split": lambda m: P.split(P.fill_days(_daily(m))),
    "f4_seasonal_naive_compat": lambda m: P.seasonal_naive(_daily(m), "compat"),
    "f4_seasonal_naive_aligned": lambda m: P.seasonal_naive(_daily(m), "aligned"),
    "f5_series_errors_category": lambda m: P.series_errors(m.fact_raw, "category"),
    "f5_series_errors_region": lambda m: P.series_errors(m.fact_raw, "region"),
    "f5_series_errors_product": lambda m: P.series_errors(m.fact_raw, "product_id"),
    "f6_errors": lambda m: _both(lambda mode: P.errors(P.seasonal_naive(_daily(m), mode).withColumn("mode", F.lit(mode)), ["mode"])),
    "f7_horizon_compat": lambda m: P.horizon(_daily(m), "compat"),
    "f7_horizon_aligned": lambda m: P.horizon(_daily(m), "aligned"),
    "f7_horizon_total": lambda m: _both(lambda mode: P.horizon_total(_daily(m), mode)),
}


def _csv(m: Mart) -> RawTables:
    """The raw tables written as CSV once and scanned back with their schemas."""
    return m.once("csv", lambda: read_raw(m.spark, sinks.write_raw_csv(m.raw, m.path("raw-csv"))))


def _csv_mart(m: Mart) -> Mart:
    """A mart over the CSV copy, as a user's files would have it."""
    return m.once("csv-mart", lambda: Mart(m.spark, _csv(m), m.name + " as CSV", m.as_of))


def _csv_profile(m: Mart) -> DataFrame:
    probes = {"customers": ("customer_id", "age"), "products": ("product_id", "brand"), "orders": ("order_id", "payment_mode"),
              "order_items": ("product_id", "quantity"), "returns": ("order_id", "return_reason")}
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
               F.sum(F.col(probes[name][0]).cast("decimal(38,0)")).alias("key_sum"), F.count(probes[name][1]).alias("filled"))
        for name, df in _csv(m).items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Files of all lines as text would take several times the tables they come from.
PACKED_CSV = "gzip"


def _star_csv(m: Mart, name: str) -> DataFrame:
    """One file of the star, read back."""
    def write():
        tables = {"dim_customers": m.customers, "dim_products": m.products, "dim_orders": m.orders, "dim_returns": m.returns, "fact_sales": m.clean_pieces}
        schemas = {t: (df[0] if isinstance(df, list) else df).schema for t, df in tables.items()}
        return sinks.write_star_csv(tables, m.path("star-csv"), PACKED_CSV), schemas
    paths, schemas = m.once("star-csv", write)
    return sinks.read_csv(m.spark, paths[name], schemas[name])


def _warehouse(m: Mart) -> dict[str, str]:
    def load():
        prefix = "salesloom_" + m.path("warehouse").split("/")[-3] + "_" + m.path("warehouse").split("/")[-2].replace("-", "_")
        rows = sinks.warehouse_rows(m.customers, m.products, m.dim_date, m.fact_clean)
        return sinks.load_warehouse(m.spark, rows, prefix, m.path("warehouse"))
    return m.once("warehouse", load)


def _warehouse_join(m: Mart) -> DataFrame:
    """Published slice by slice: the joins shuffle every line twice."""
    def joined(of):
        t = {name: m.spark.table(table) for name, table in _warehouse(m).items()}
        return (
            of(t["fact_sales"]).join(t["dim_customers"].select("customer_id", "name"), "customer_id")
            .join(t["dim_products"].select("product_id", "category"), "product_id")
            .join(t["dim_date"].select("date_key", "day_name"), "date_key")
            .select("order_id", "product_id", "name", "category", "day_name", "revenue", "profit", "discount_impact")
        )
    return m.once("warehouse-join", lambda: m.publish_sliced("warehouse_join", joined, wider=2, even=False))


def _bi(m: Mart) -> dict[str, DataFrame]:
    return m.once("bi", lambda: sinks.write_bi_star(m.raw, m.fact_raw, m.path("bi")))


def _dashboard(m: Mart) -> dict[str, DataFrame]:
    return m.once("dashboard", lambda: sinks.write_dashboard(m.raw, m.fact_raw, m.path("dashboard"), DRIVER_COORDS, PACKED_CSV))


def _back(m: Mart, folder: str, files: dict[str, DataFrame], name: str) -> DataFrame:
    """One written file, read back."""
    return sinks.read_csv(m.spark, f"{m.path(folder)}/{name}", files[name].schema)


def _csv_round_trip(m: Mart, name: str, df: DataFrame) -> DataFrame:
    m.once(name, lambda: sinks.write_csv(df, m.path(name)))
    return sinks.read_csv(m.spark, m.path(name), df.schema)


def _results(m: Mart) -> DataFrame:
    def write():
        forecasting = P.errors(P.seasonal_naive(_daily(m), "compat"))
        return sinks.write_json(sinks.results_document(m.fact_raw, forecasting), m.path("results"))
    return sinks.read_json(m.spark, m.path("results"), m.once("results", write))


def _refreshed(m: Mart) -> DataFrame:
    """Publish the daily aggregate, then recompute the first and the last month in place."""
    def refresh():
        path = m.path("daily")
        sinks.publish_daily_sales(m.fact_clean, path)
        bounds = m.fact_clean.agg(F.array(F.min(MONTH), F.max(MONTH)).alias("a"))
        sinks.refresh_daily_sales(m.fact_clean, path, bounds.select(F.explode("a").alias(MONTH)))
        return path
    return sinks.read_daily_sales(m.spark, m.once("daily", refresh))


def _streamed(m: Mart) -> DataFrame:
    def run():
        assert m.fact_clean is not None  # published before the stream lists its files
        refresh_from_stream(m.spark, m.path("fact_clean"), m.path("daily-stream"), m.path("daily-stream-progress"))
        return m.path("daily-stream")
    return sinks.read_daily_sales(m.spark, m.once("daily-stream", run))


SINKS: dict[str, Query] = {
    "s01_csv_scan": _csv_profile,
    "s02_analysis_loader": lambda m: star.build_raw_fact(_csv(m)).select(
        "order_id", "product_id", "customer_id", "order_date", "shipping_date", "region", "payment_mode", "category",
        "quantity", "revenue", "profit", "is_return"),
    "s01_s02_star_from_csv": lambda m: _csv_mart(m).fact_clean,
    "c12_csv_corrupt_rows": lambda m: corrupt_rows(m.spark, _csv(m) and m.path("raw-csv")),
    "s03_star_csv": lambda m: _star_csv(m, "fact_sales").select(
        "order_id", "product_id", "name", "gender", "age", "city", "order_date", "shipping_date", "revenue", "profit", "is_return"),
    "s03_dim_customers": lambda m: _star_csv(m, "dim_customers"),
    "s03_dim_products": lambda m: _star_csv(m, "dim_products").select("product_id", "cost_price", "selling_price"),
    "s03_dim_orders": lambda m: _star_csv(m, "dim_orders").select("order_id", "order_date", "shipping_date"),
    "s03_dim_returns": lambda m: _star_csv(m, "dim_returns"),
    "s04_s14_warehouse": _warehouse_join,
    "s04_dim_region": lambda m: m.spark.table(_warehouse(m)["dim_region"]).select("region_id", "region", "city"),
    "s05_s06_date_spine": lambda m: star.date_spine(star.order_date_bounds(m.orders)),
    "s07_bi_star": lambda m: sinks.written_profile(m.spark, m.path("bi"), _bi(m)),
    "s07_bi_customers": lambda m: _back(m, "bi", _bi(m), "dim_customers"),
    "s07_bi_products": lambda m: _back(m, "bi", _bi(m), "dim_products"),
    "s07_bi_date": lambda m: _back(m, "bi", _bi(m), "dim_date"),
    "s07_bi_fact": lambda m: _back(m, "bi", _bi(m), "fact_sales"),
    "s07_bi_returns": lambda m: _back(m, "bi", _bi(m), "returns"),
    "s08_dashboard": lambda m: sinks.written_profile(m.spark, m.path("dashboard"), _dashboard(m)),
    "s08_dashboard_customers": lambda m: _back(m, "dashboard", _dashboard(m), "customers"),
    "s08_dashboard_sales": lambda m: _back(m, "dashboard", _dashboard(m), "sales"),
    "s08_dashboard_regional": lambda m: _back(m, "dashboard", _dashboard(m), "regional"),
    "s08_dashboard_trend": lambda m: _back(m, "dashboard", _dashboard(m), "trend"),
    "s09_segment_csv": lambda m: _csv_round_trip(m, "segments-csv", R.export_columns(segments(m).assigned)),
    "s09_segment_csv_by_spend": lambda m: _csv_round_trip(m, "spend-csv", R.export_columns(_by_spend(m))),
    "s10_forecast_test_csv": lambda m: _csv_round_trip(m, "forecast-test", P.seasonal_naive(_daily(m), "compat")),
    "s10_forecast_ahead_csv": lambda m: _csv_round_trip(m, "forecast-ahead", P.horizon(_daily(m), "compat")),
    "s11_s12_results_json_category": lambda m: sinks.section(_results(m), "by_category"),
    "s11_s12_results_json_overview": lambda m: sinks.section(_results(m), "overview"),
    "s13_daily_sales_refresh": _refreshed,
    "s13_daily_sales_stream": _streamed,
}


def _dirty(m: Mart) -> Mart:
    """A mart over CSV files that break the rules, read in file order."""
    return m.once("dirty-mart", lambda: Mart(
        m.spark, read_raw(m.spark, write_dirty_csv(m.spark, m.raw, m.path("dirty-csv")), ordered=True), m.name + " dirty", m.as_of))


def _quarantined(m: Mart) -> dict[str, QT.Quarantined]:
    return m.once("quarantine", lambda: QT.quarantine(_dirty(m).raw, m.as_of, m.path("quarantine")))


def _first_in_file(m: Mart) -> DataFrame:
    """The rows that C1 keeps of each dirty table, by their keys and one value."""
    raw, none = _dirty(m).raw, F.lit(None).cast("long")
    kept = {"customers": (["customer_id"], "name"), "products": (["product_id"], "brand"), "orders": (["order_id"], "payment_mode"),
            "order_items": (["order_id", "product_id"], "quantity"), "returns": (["order_id", "product_id"], "return_reason")}
    return reduce(DataFrame.unionByName, [
        K.keep_first(getattr(raw, t), keys).select(F.lit(t).alias("table_name"), F.col(keys[0]).alias("key_1"), (F.col(keys[1]) if len(keys) > 1 else none).alias("key_2"),
                                                   F.col(value).cast("string").alias("kept_value")) for t, (keys, value) in kept.items()])


_LINE = ["order_id", "product_id", "quantity", "selling_price", "discount", "customer_id", "order_date", "shipping_date", "region", "payment_mode", "cost_price",
         "category", "sub_category", "brand", "revenue", "cost_total", "profit", "discount_impact", "is_return"]

DIRTY: dict[str, Query] = {
    "c01_csv_first_in_file": _first_in_file,
    "c02_c05_dirty_customers": lambda m: _dirty(m).customers,
    "c06_dirty_clip": lambda m: K.clean_order_items(_dirty(m).raw.order_items).drop(POSITION),
    "c06_c08_dirty_prices": lambda m: _dirty(m).products.select("product_id", "cost_price", "selling_price"),
    "c09_dirty_shipping": lambda m: _dirty(m).orders,
    "c15_dirty_foreign_keys": lambda m: QU.foreign_key_violations([
        ("orders.customer_id", _dirty(m).raw.orders, ["customer_id"], _dirty(m).raw.customers),
        ("order_items.order_id", _dirty(m).raw.order_items, ["order_id"], _dirty(m).raw.orders),
        ("order_items.product_id", _dirty(m).raw.order_items, ["product_id"], _dirty(m).raw.products),
        ("returns.line", _dirty(m).raw.returns, ["order_id", "product_id"], _dirty(m).raw.order_items),
    ]),
    "c15_quarantine_counts": lambda m: QT.rule_counts(m.spark, _quarantined(m)),
    "c15_quarantined_lines": lambda m: _quarantined(m)["order_items"].rejected.select(
        "order_id", "product_id", "quantity", F.array_join(QT.BROKEN, "; ").alias("rules")),
    "c16_dirty_keys": lambda m: QU.key_violations([
        (t, getattr(_dirty(m).raw, t), k) for t, k in (("customers", ["customer_id"]), ("products", ["product_id"]), ("orders", ["order_id"]),
                                                       ("order_items", star.LINE_KEY), ("returns", star.LINE_KEY))]),
    "c17_dirty_quotes": lambda m: K.strip_quotes(K.keep_first(_dirty(m).raw.customers, ["customer_id"]), "name").select("customer_id", "name"),
    "fact_clean_dirty": lambda m: _dirty(m).fact_clean.select(*_LINE, "name", "gender", "age", "city", "customer_region", "has_customer", "has_product"),
    "fact_raw_dirty": lambda m: _dirty(m).fact_raw.select(*_LINE),
    "j04_dirty_inner": lambda m: star.build_raw_fact(_dirty(m).raw, how="inner").select("order_id", "product_id", "quantity", "revenue", "profit"),
    "m10_m12_dirty_bands": lambda m: _bands(_dirty(m).fact_raw),
}


def _parsed(m: Mart) -> dict[str, DataFrame]:
    """Raw tables with their date texts parsed."""
    return {
        **dict(m.raw.items()),
        "customers": m.raw.customers.withColumn("signup_date", dates.parse_date("signup_date")),
        "orders": star.parse_order_dates(m.raw.orders),
    }


QUERIES: dict[str, Query] = {**CATALOG, **CLEANING, **FACTS, **SUMMARIES, **MEASURES, **INSIGHTS, **MODELS, **SINKS, **DIRTY}


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query):
        return lambda spark, sf_dir: published(query(mart(spark, sf_dir)))
    return {name: bind(query) for name, query in QUERIES.items()}
