"""Query catalog: one builder per operator of the inventory.

Each builder takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` (through the retail derivations) and returns a lazy DataFrame
whose column names match the oracle SQL of the same key.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_demographics, trim_column, upper_column
from ..operators import aggregates, clean, joins, layout, validate, windows
from ..session import shared_path
from ..sources import testdata
from ..sources.scan import read_dataset, stamp_ingest_date, write_snapshot
from . import calc, reports
from .retail import INGEST_DATE, Retail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# The same queries as functions of a snapshot (any Retail: driver tables,
# a landing folder, a materialized snapshot).  ``src_*`` keys land files
# themselves and exist only in QUERIES.
REPORTS: dict[str, Callable[[Retail], DataFrame]] = {}


def query(key: str):
    def register(fn):
        QUERIES[key] = fn
        return fn
    return register


def report(key: str):
    def register(fn):
        REPORTS[key] = fn
        QUERIES[key] = lambda spark, sf_dir: fn(Retail.of(spark, sf_dir))
        return fn
    return register


def _months_before(as_of: str, months: int) -> str:
    d = dt.date.fromisoformat(as_of)
    y, m = divmod(d.year * 12 + d.month - 1 - months, 12)
    return f"{y:04d}-{m + 1:02d}"


def growth_start_month(as_of) -> str:
    """"Last six months" for the consistent-growth report."""
    return _months_before(str(as_of), 6)


def _landed(spark: SparkSession, sf_dir: str, name: str, fmt: str) -> DataFrame:
    """Land one raw dataset as a dated snapshot in a folder of its own and scan
    it back: no later call writes where this handle reads."""
    root = shared_path(spark, "tillwise-landing", uuid.uuid4().hex)
    write_snapshot(testdata.derive(spark, sf_dir, name), root, name, INGEST_DATE, fmt)
    return read_dataset(spark, root, name, INGEST_DATE, fmt)


# ------------------------------------------------------------------ sources

@query("src_dated_scan")
def _src_dated_scan(spark, sf_dir):
    """Land the raw transactions as a dated CSV snapshot, scan it back."""
    return _landed(spark, sf_dir, "transactions", "csv")


@query("src_ingest_date")
def _src_ingest_date(spark, sf_dir):
    return stamp_ingest_date(_landed(spark, sf_dir, "stores", "parquet"), INGEST_DATE)


def _src(name: str) -> None:
    QUERIES[f"src_{name}"] = lambda spark, sf_dir: _landed(spark, sf_dir, name, "csv")


for _name in ("items", "customers", "products", "inventory", "promotions", "suppliers"):
    _src(_name)


# ------------------------------------------------------------------ cleaning

@report("clean_dedup_transactions")
def _dedup(r):
    raw = r.raw("transactions")
    return clean.dedup_latest(raw, ["transaction_id", "store_id"],
                              ["transaction_date", "total_amount"])


@report("filter_valid_amount")
def _valid_amount(r):
    return r.transactions


@report("filter_recent_transactions")
def _recent(r):
    return r.recent_transactions.select(
        "transaction_id", "customer_id", "transaction_date", "total_amount")


@report("date_transaction_month")
def _month(r):
    return r.transactions.select(
        "transaction_id", "transaction_date", "month")


@report("filter_discounted_items")
def _discounted(r):
    return clean.drop_null(r.items, "discount")


@report("clean_discount_flag")
def _discount_flag(r):
    raw = r.raw("items")
    return raw.select("transaction_id", "product_id", "discount",
                      clean.discount_flag("discount").alias("high_discount_flag"))


@report("clean_impute_price")
def _impute_price(r):
    return r.items.select(
        "transaction_id", "product_id", "quantity", "unit_price")


@report("proj_line_revenue")
def _line_revenue(r):
    return r.items.select(
        "transaction_id", "product_id", "quantity", "unit_price",
        clean.line_revenue().alias("line_revenue"))


@report("clean_price_band")
def _price_band(r):
    return r.products.select("product_id", "base_price", "price_range")


@report("filter_product_like")
def _product_like(r):
    return clean.name_like(r.products, "product_name", "%Eco%").select(
        "product_id", "product_name", "category_id", "base_price", "supplier_id")


@report("clean_critical_stock")
def _critical_stock(r):
    return r.inventory.select(
        "store_id", "product_id", "quantity_percent", "critical_quantity_gap_flag")


@report("clean_inventory_gap")
def _inventory_gap(r):
    return r.inventory.select(
        "store_id", "product_id", "quantity", "reorder_point", "quantity_gap",
        "quantity_percent")


@report("clean_region")
def _region(r):
    return r.stores.select("store_id", "region", "new_region")


@report("clean_fill_size")
def _fill_size(r):
    return clean.fill_with_mode(r.stores, "size").select(
        "store_id", "region", "size")


@report("clean_fill_size_by_region")
def _fill_size_region(r):
    return clean.fill_with_mode(r.stores, "size", ["region"]).select(
        "store_id", "region", "size")


def _named_customers(r: Retail) -> DataFrame:
    return split_demographics(clean.fill_unknown(r.customers, "demographics"))


@report("clean_demographics_unknown")
def _demographics_unknown(r):
    return _named_customers(r).select(
        "customer_id", "segment", "name", "sex", "age")


@report("clean_impute_reliability")
def _impute_reliability(r):
    return clean.impute_reliability(r.suppliers, r.products).select(
        "supplier_id", "country", "reliability_score", "imputed_reliability_score")


# ------------------------------------------------------------------ text / dates

@report("str_split_demographics")
def _split(r):
    return split_demographics(r.customers).select(
        "customer_id", "name", "sex", "age")


@report("str_trim_location")
def _trim(r):
    return trim_column(r.stores, "location").select("store_id", "location")


@report("str_upper_size")
def _upper(r):
    return upper_column(r.stores, "size").select("store_id", "size")


@report("str_full_location")
def _full_location(r):
    return r.stores.select("store_id", "full_location")


@report("date_signup_year")
def _signup_year(r):
    return r.customers.select("customer_id", "signup_date", "year")


# ------------------------------------------------------------------ validation

_RULES: dict[str, Callable[[Retail], DataFrame]] = {
    "orphan_items": lambda r: validate.orphan_items(r.lines, r.transactions),
    "inventory_store": lambda r: validate.orphan_inventory(r.inventory, r.stores),
    "negative_quantity": lambda r: validate.negative_values(r.inventory, "quantity"),
    "promo_product": lambda r: validate.orphan_promotions(r.promotions, r.products),
    "store_size": lambda r: validate.invalid_store_sizes(r.stores, "size"),
}


def summary(r: Retail) -> DataFrame:
    """Violations per rule; the two inventory rules share one pass."""
    single = {name: rule(r) for name, rule in _RULES.items()
              if name not in ("inventory_store", "negative_quantity")}
    return validate.validation_summary(
        single, [validate.inventory_counts(r.inventory, r.stores)])


@report("validate_orphan_items")
def _orphan_items(r):
    return validate.orphan_items(r.items, r.transactions).select(
        "transaction_id", "product_id", "quantity", "unit_price", "discount")


@report("validate_inventory_store")
def _inventory_store(r):
    return _RULES["inventory_store"](r).select(
        "store_id", "product_id", "date", "quantity", "reorder_point")


@report("validate_non_negative")
def _non_negative(r):
    inv = validate.with_sign_status(r.inventory, "quantity")
    return inv.where(F.col("quantity_status") == "invalid").select(
        "store_id", "product_id", "quantity", "quantity_status")


@report("validate_promo_product")
def _promo_product(r):
    return validate.promo_validity(r.promotions, r.products).select(
        "promo_id", "product_id", "is_valid")


@report("validate_store_size")
def _store_size(r):
    return validate.valid_store_sizes(r.stores, "size").select(
        "store_id", "size", "new_region")


@report("validate_summary")
def _summary(r):
    return summary(r)


# ------------------------------------------------------------------ joins

@report("join_three_way")
def _three_way(r):
    return joins.chain_join(
        [r.transactions.select("transaction_id", "store_id", "customer_id", "transaction_date"),
         r.items.select("transaction_id", "product_id", "quantity", "unit_price"),
         r.products.select("product_id", "category_id", "product_name")],
        ["transaction_id", "product_id"], "inner")


@report("join_category_revenue_share")
def _category_share(r):
    return joins.category_revenue_share(r.transactions, r.items, r.products)


@report("join_promo_customers")
def _promo_customers(r):
    return joins.promo_customers(r.transactions, r.lines, r.promotions, _named_customers(r))


@report("join_region_reliability")
def _region_reliability(r):
    return joins.region_reliability(r.suppliers, r.products, r.stores)


@report("join_region_best_supplier")
def _region_best(r):
    return joins.region_best_supplier(r.suppliers, r.products, r.stores)


@report("join_stockouts")
def _stockouts(r):
    return joins.stockouts(r.inventory, validate.valid_store_sizes(r.stores)).select(
        "store_id", "product_id", "quantity", "reorder_point", "new_region", "size",
        "stock_out")


@report("join_segment_revenue")
def _segment_revenue(r):
    return joins.segment_revenue(r.all_customers, r.transactions, r.as_of)


@report("join_recent_customers")
def _recent_customers(r):
    customers = stamp_ingest_date(r.raw("customers"), r.ingest_date)
    return joins.customer_transactions(customers, r.recent_transactions).select(
        "customer_id", "segment", "transaction_id", "year")


@report("join_promo_interval")
def _promo_interval(r):
    return joins.promo_interval_join(r.transactions, r.items, r.promotions)


@report("join_broadcast_stores")
def _broadcast_stores(r):
    return joins.dimension_join(
        r.transactions.select("transaction_id", "store_id", "total_amount"),
        r.stores.select("store_id", "new_region", "size"), "store_id")


# ------------------------------------------------------------------ aggregates

@report("agg_median_lead_time")
def _median(r):
    return aggregates.median_by(r.suppliers, "country", "lead_time",
                                "median_lead_time")


@report("agg_mode_size")
def _mode(r):
    return aggregates.mode_of(r.stores, "size")


@report("agg_distinct_rows")
def _distinct(r):
    return aggregates.distinct_rows(r.raw("transactions"))


# ------------------------------------------------------------------ windows

def _running(func: str, out: str):
    def build(r):
        tx = r.transactions
        return windows.window_aggregate(tx, "store_id", "transaction_date", func,
                                        "total_amount", out).select(
            "transaction_id", "store_id", "transaction_date", out)
    return build


report("window_running_avg")(_running("avg", "running_avg"))
report("window_running_sum")(_running("sum", "running_sum"))
report("window_running_count")(_running("count", "running_count"))


@report("window_rolling_7_rows")
def _rolling_rows(r):
    tx = r.transactions
    return windows.rolling_rows(tx, "store_id", ["transaction_date", "transaction_id"],
                                "total_amount", 6, "avg", "rolling_avg_7_rows").select(
        "transaction_id", "store_id", "transaction_date", "rolling_avg_7_rows")


@report("window_rolling_7_days")
def _rolling_days(r):
    tx = r.transactions
    return windows.rolling_days(tx, "store_id", "transaction_date", "total_amount", 7,
                                "avg", "rolling_avg_7_days").select(
        "transaction_id", "store_id", "transaction_date", "rolling_avg_7_days")


# ------------------------------------------------------------------ calculations

@report("calc_retention")
def _retention(r):
    return calc.retention(r.all_customers, r.transactions, r.as_of)


@report("calc_monthly_growth")
def _growth(r):
    return calc.monthly_growth(r.items, r.transactions, r.products)


@report("calc_consistent_growth")
def _consistent(r):
    return calc.consistent_growth(calc.monthly_growth(r.items, r.transactions, r.products),
                                  growth_start_month(r.as_of))


@report("calc_supplier_rank")
def _rank(r):
    return calc.supplier_rank(r.suppliers).select(
        "supplier_id", "country", "reliability_score", "reliability_rank")


@report("calc_category_lead_time")
def _lead_time(r):
    return calc.category_lead_time(r.products, r.suppliers)


# ------------------------------------------------------------------ reports

@report("rep_weekly_revenue")
def _weekly(r):
    return reports.weekly_revenue(r.stores, r.transactions)


@report("rep_weekly_revenue_by_year")
def _weekly_year(r):
    return reports.weekly_revenue(r.stores, r.transactions, by_year=True)


@report("rep_discount_impact")
def _discount_impact(r):
    return reports.discount_impact(r.products, r.items, r.raw("items"))


@report("rep_promo_revenue")
def _promo_revenue(r):
    return reports.promo_revenue(r.transactions, r.items, r.promotions)


@report("rep_promo_uplift")
def _promo_uplift(r):
    return reports.promo_uplift(r.transactions, r.items, r.promotions)


@report("rep_top_stores")
def _top_stores(r):
    return reports.top_stores(r.stores, r.transactions, r.suppliers, r.products, 5)


@report("rep_region_dashboard")
def _dashboard(r):
    return reports.region_dashboard(r.stores, r.transactions, r.lines, r.products)


# ------------------------------------------------------------------ layout

@report("layout_repartition_product")
def _repartition(r):
    items = r.items
    return layout.repartition_by(items, "product_id").select(
        "transaction_id", "product_id", "quantity", "unit_price", "discount")
