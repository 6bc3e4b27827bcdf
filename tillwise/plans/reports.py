"""Business reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_week, iso_week_year
from ..functions.exact import add_up, lane_sums, with_parts, with_total
from ..functions.money import cents, cents_to_money
from ..operators.clean import line_revenue
from ..operators.intervals import interval_left_join, merge_intervals
from ..operators.joins import transaction_lines


def weekly_revenue(stores: DataFrame, transactions: DataFrame,
                   by_year: bool = False) -> DataFrame:
    """Revenue per store and ISO week (optionally per ISO week-year too)."""
    tx = transactions.join(stores.select("store_id"), "store_id", "left_semi")
    keys = [F.col("store_id")]
    if by_year:
        keys.append(iso_week_year("transaction_date").alias("iso_year"))
    keys.append(iso_week("transaction_date").alias("week_of_year"))
    return tx.groupBy(*keys).agg(
        cents_to_money(F.sum(cents("total_amount"))).alias("weekly_revenue"))


def max_priced_discount(products: DataFrame, raw_items: DataFrame) -> DataFrame:
    """One-row frame: the highest discount among lines that carry a price
    after imputation (i.e. whose product has at least one priced line) and
    whose product exists.  Computed from one per-product aggregate of the
    raw lines, so no line-level join is needed for this scalar."""
    per_product = raw_items.groupBy("product_id").agg(
        F.max("discount").alias("_max"), F.count("unit_price").alias("_priced"))
    return (per_product.where(F.col("_priced") > 0)
                       .join(products.select("product_id"), "product_id", "left_semi")
                       .agg(F.max("_max").alias("max_discount")))


def discount_impact(products: DataFrame, items: DataFrame,
                    raw_items: DataFrame | None = None) -> DataFrame:
    """Gross and discounted revenue per product over the lines sold at the
    highest discount; identical lines count once.

    ``raw_items`` (the lines before price imputation) lets the maximum be
    found from a per-product aggregate; without it the cleaned lines are
    scanned for it.  The max filter is applied before the product
    semi-join, so only top-discount lines are shuffled."""
    if raw_items is not None:
        top = max_priced_discount(products, raw_items).scalar()
    else:
        top = (items.where(F.col("unit_price").isNotNull())
                    .join(products.select("product_id"), "product_id", "left_semi")
                    .agg(F.max("discount")).scalar())
    lines = (items.where(F.col("unit_price").isNotNull() & (F.col("discount") == top))
                  .join(products.select("product_id"), "product_id", "left_semi")
                  .select("transaction_id", "product_id", "quantity", "unit_price", "discount")
                  .distinct())
    gross = line_revenue()
    net = gross - (F.col("discount") / 100 * F.col("unit_price")) * F.col("quantity")
    return lines.groupBy("product_id").agg(
        cents_to_money(F.sum(cents(gross))).alias("total_revenue"),
        cents_to_money(F.sum(cents(net))).alias("discounted_revenue"))


def promo_flagged_lines(transactions: DataFrame, items: DataFrame,
                        promotions: DataFrame) -> DataFrame:
    """Item lines with ``is_promoted`` = 1 when any promotion of the product
    runs on the transaction date.  Promotions are merged per product into
    disjoint intervals first, so each line matches at most once."""
    lines = transaction_lines(transactions, items)
    spans = merge_intervals(promotions, "product_id", "start_date", "end_date")
    return (interval_left_join(lines, spans, "product_id", "transaction_date", "start_date", "end_date")
                 .select(*[f"i.{c}" for c in lines.columns], F.when(F.col("p.start_date").isNotNull(), 1).otherwise(0)
                         .alias("is_promoted")))


def promo_revenue(transactions: DataFrame, items: DataFrame,
                  promotions: DataFrame) -> DataFrame:
    flagged = promo_flagged_lines(transactions, items, promotions)
    return flagged.groupBy("is_promoted").agg(
        cents_to_money(F.sum(cents(line_revenue()))).alias("total_revenue"),
        F.count_distinct("transaction_id").alias("transaction_count"),
        F.count(F.lit(1)).alias("line_count"))


def promo_uplift(transactions: DataFrame, items: DataFrame,
                 promotions: DataFrame) -> DataFrame:
    """(promoted - non-promoted revenue) / non-promoted revenue, percent."""
    flagged = promo_flagged_lines(transactions, items, promotions)
    c = cents(line_revenue())
    promoted = cents_to_money(F.sum(F.when(F.col("is_promoted") == 1, c)))
    other = cents_to_money(F.sum(F.when(F.col("is_promoted") == 0, c)))
    return flagged.agg(promoted.alias("promoted_revenue"),
                       other.alias("non_promoted_revenue")).select(
        "promoted_revenue", "non_promoted_revenue",
        (F.try_divide(F.col("promoted_revenue") - F.col("non_promoted_revenue"),
                      F.col("non_promoted_revenue")) * 100).alias("uplift_pct"))


def top_stores(stores: DataFrame, transactions: DataFrame, suppliers: DataFrame,
               products: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` stores by revenue, then by distinct products supplied to
    them, then by store id.  Revenue and supplied products are aggregated
    per store separately and joined one row to one row."""
    revenue = (transactions.join(stores.select("store_id"), "store_id", "left_semi")
                           .groupBy("store_id")
                           .agg(F.sum(cents("total_amount")).alias("_cents")))
    supplied = (products.select("supplier_id", "product_id")
                        .join(suppliers.select("supplier_id", "store_id"), "supplier_id")
                        .groupBy("store_id")
                        .agg(F.count_distinct("product_id").alias("distinct_products")))
    return (revenue.join(supplied, "store_id")
                   .select("store_id", cents_to_money("_cents").alias("total_revenue"),
                           "distinct_products")
                   .orderBy(F.desc("total_revenue"), F.desc("distinct_products"),
                            F.asc("store_id"))
                   .limit(k))


def region_dashboard(stores: DataFrame, transactions: DataFrame, items: DataFrame,
                     products: DataFrame) -> DataFrame:
    """Per store region: revenue (each transaction once), average item
    discount, top product (most lines, then lowest id) and lines sold.

    Item lines are reduced once to (region, product); one pass over that
    small frame (left-joined to the product names) yields the discount
    average, the top product and the line count together."""
    tx = transactions.join(stores.select("store_id", "region"), "store_id")
    # The item join below implies transaction_id IS NOT NULL, and Catalyst
    # pushes that under the dedup aggregate.  Writing the same test here
    # lets this branch reuse that branch's deduplicated-transactions
    # exchange.  Rows with a null id are added back as a second branch,
    # whose IS NULL filter is pushed to the Parquet scan, so the revenue is
    # unchanged.
    keyed = F.col("transaction_id").isNotNull()
    revenue = tx.where(keyed).unionByName(tx.where(~keyed)).groupBy("region").agg(
        cents_to_money(F.sum(cents("total_amount"))).alias("total_revenue"))
    lines = items.select("transaction_id", "product_id", "discount").join(
        tx.select("transaction_id", "region"), "transaction_id")
    per_product = with_parts(lines, "discount").groupBy("region", "product_id").agg(
        F.count("transaction_id").alias("product_sales"), *lane_sums())
    names = products.select("product_id", "product_name", F.lit(True).alias("_known"))
    named = per_product.join(names, "product_id", "left")
    known = F.col("_known").isNotNull()
    summary = with_total(named.groupBy("region").agg(
        *add_up(),
        F.min(F.when(known, F.struct((-F.col("product_sales")).alias("k"),
                                     F.col("product_id").alias("id"),
                                     F.col("product_name").alias("name")))).alias("_top"),
        F.sum(F.when(known, F.col("product_sales"))).alias("total_sales")), "average_discount", mean=True)
    return (revenue.join(summary.where(F.col("_top").isNotNull()), "region")
                   .select("region", "total_revenue", "average_discount",
                           F.col("_top.name").alias("top_product"), "total_sales")
                   .orderBy(F.desc("total_sales"), F.asc("region")))
