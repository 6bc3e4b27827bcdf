"""Cleaning and enrichment: pure DataFrame -> DataFrame steps.

Conventions used by every imputation here: the fill value is computed by a
grouped aggregate (map-side partial aggregation, so a hot key costs no more
than a cold one) and only the rows that are actually missing are joined to
it.  Complete rows never shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import within_months
from ..functions.exact import exact_mean, finite
from ..functions.text import joined_label
from ..sources.scan import stamp_ingest_date

# Spellings folded into one region label, and the label used.
NORTHEAST_SPELLINGS = ("north-east", "ne")
NORTHEAST_LABEL = "Northeast"

# Thresholds of the flags and bands.
HIGH_DISCOUNT = 20.0  # percent, from here on 'H'
LOW_PRICE_TO = 400.00  # 'Low' up to here
MEDIUM_PRICE = (399.99, 699.99)  # 'Medium' within, both ends included
HIGH_PRICE_FROM = 700.00  # 'High' from here on
CRITICAL_STOCK_PERCENT = 50.0  # below: 'L'


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- dedup / filters

def dedup_latest(df: DataFrame, keys: list[str], prefer: list[str],
                 cluster_by: list[str] | None = None) -> DataFrame:
    """One row per ``keys``; the survivor has the greatest ``prefer`` columns.

    Ties on ``prefer`` are broken by the remaining columns, so the survivor
    is fully determined.  Built as ``max(struct(...))`` per key with a
    partial (map-side) aggregate, so a key repeated in a third of the rows
    is pre-combined inside each map task before the shuffle.  A struct
    buffer is not fixed-width, so Spark runs it as a sort aggregate: each
    task sorts its own rows (spilling if needed); there is no global sort.
    Nulls lose against values.

    ``cluster_by`` (a subset of ``keys``) hash-partitions the rows on those
    columns before the aggregate; the result keeps that partitioning, so a
    later join on the same column needs no second exchange.  It gives up the
    map-side combine, so use it only when no key can have many copies; the
    cleaners do not (one transaction copied into a third of all rows must
    collapse inside each map task, not in one reducer).
    """
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    if cluster_by:
        df = df.repartition(*cluster_by)
    order = list(prefer) + rest
    best = F.max(F.struct(*[F.col(c) for c in order])).alias("_best")
    return (df.groupBy(*keys).agg(best)
              .select(*keys, *[F.col("_best").getField(c).alias(c) for c in order])
              .select(*df.columns))


def keep_valid_amount(df: DataFrame, col: str = "total_amount") -> DataFrame:
    """Amount present, positive and finite (NaN is no amount)."""
    return df.where(finite(col) > 0)


def drop_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def name_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.where(F.col(col).like(pattern))


def recent(df: DataFrame, date_col: str, as_of, months: int = 36) -> DataFrame:
    return df.where(within_months(date_col, as_of, months))


# ---------------------------------------------------------------- flags and bands

def discount_flag(col="discount", threshold: float = HIGH_DISCOUNT) -> Column:
    """'L' below the threshold, 'H' at or above it, null stays null."""
    c = _c(col)
    return (F.when(c < threshold, "L").when(c >= threshold, "H")
             .otherwise(c.cast("string")))


def price_band(col="base_price") -> Column:
    """Low <= 400; Medium in [399.99, 699.99]; High >= 700; anything else
    (the gap (699.99, 700) and null) keeps its price as text."""
    c = _c(col)
    return (F.when(c <= LOW_PRICE_TO, "Low")
             .when(c.between(*MEDIUM_PRICE), "Medium")
             .when(c >= HIGH_PRICE_FROM, "High")
             .otherwise(c.cast("string")))


def stock_flag(col="quantity_percent", threshold: float = CRITICAL_STOCK_PERCENT) -> Column:
    c = _c(col)
    return (F.when(c < threshold, "L").when(c >= threshold, "H")
             .otherwise(c.cast("string")))


def region_label(col="region") -> Column:
    c = _c(col)
    return F.when(F.lower(c).isin(*NORTHEAST_SPELLINGS), NORTHEAST_LABEL).otherwise(c)


def with_inventory_gap(df: DataFrame) -> DataFrame:
    """quantity_gap = quantity - reorder_point; quantity_percent =
    round(gap / quantity * 100), null when quantity is 0 or null."""
    gap = F.col("quantity") - F.col("reorder_point")
    return df.withColumns({
        "quantity_gap": gap,
        "quantity_percent": F.round(F.try_divide(gap, F.col("quantity")) * 100),
    })


def line_revenue(quantity="quantity", unit_price="unit_price") -> Column:
    return _c(quantity) * _c(unit_price)


# ---------------------------------------------------------------- imputation

def _fill_missing(df: DataFrame, col: str, fills: DataFrame, keys: list[str],
                  fill_col: str) -> DataFrame:
    """Rows with ``col`` present pass through; the others take ``fill_col``
    from ``fills`` (one row per key) by a null-safe key match."""
    known = df.where(F.col(col).isNotNull())
    missing = df.where(F.col(col).isNull()).alias("_m")
    f = fills.alias("_f")
    cond = None
    for k in keys:
        term = F.col(f"_m.{k}").eqNullSafe(F.col(f"_f.{k}"))
        cond = term if cond is None else cond & term
    filled = (missing.join(f, cond, "left")
                     .select(*[F.col(f"_f.{fill_col}").cast(df.schema[col].dataType).alias(c)
                               if c == col else F.col(f"_m.{c}") for c in df.columns]))
    return known.unionByName(filled)


def impute_group_mean(df: DataFrame, col: str, group: str) -> DataFrame:
    """Null ``col`` -> mean of ``col`` over rows with the same ``group``.

    The mean comes from an exact sum of the values as they are, so it does
    not depend on row order.  A group with no value stays null.
    """
    means = exact_mean(df.where(F.col(col).isNotNull()), [group], col, "_mean")
    return _fill_missing(df, col, means, [group], "_mean")


def group_mode(df: DataFrame, col: str, groups: list[str] | None = None) -> DataFrame:
    """Most frequent non-null value of ``col`` (per ``groups``); ties go to
    the smallest value.  ``min(struct(-count, value))`` keeps it a partial
    aggregate.  Returns ``groups + [col, frequency]``."""
    groups = list(groups or [])
    counts = (df.where(F.col(col).isNotNull()).groupBy(*groups, col)
                .agg(F.count(F.lit(1)).alias("_n")))
    best = F.min(F.struct((-F.col("_n")).alias("k"), F.col(col).alias("v"))).alias("_b")
    return (counts.groupBy(*groups).agg(best)
                  .select(*groups, F.col("_b.v").alias(col),
                          (-F.col("_b.k")).alias("frequency")))


def fill_with_mode(df: DataFrame, col: str, groups: list[str] | None = None) -> DataFrame:
    """Null ``col`` -> most frequent value (global, or within ``groups``)."""
    if not groups:
        mode = group_mode(df, col).select(col).scalar()
        return df.withColumn(col, F.coalesce(F.col(col), mode))
    modes = group_mode(df, col, groups).withColumnRenamed(col, "_mode")
    return _fill_missing(df, col, modes, list(groups), "_mode")


def fill_unknown(df: DataFrame, col: str, label: str = "unknown") -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(label)))


def supplier_reliability(suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """Per supplier with a score and at least one product:
    ``weighted_avg_reliability_score`` = avg score / distinct products.

    Products are reduced to one row per supplier (distinct product count)
    before meeting the suppliers, so the big side never joins row-by-row.
    """
    product_counts = (products.groupBy("supplier_id")
                              .agg(F.count_distinct("product_id").alias("product_count")))
    scores = exact_mean(suppliers.where(F.col("reliability_score").isNotNull()), ["supplier_id"],
                        "reliability_score", "mean_score")
    return (scores.join(product_counts, "supplier_id")
                  .withColumn("weighted_avg_reliability_score",
                              F.col("mean_score") / F.col("product_count")))


def impute_reliability(suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """Add ``imputed_reliability_score``: the score, or when missing the mean
    of the per-supplier weighted averages (one scalar over all suppliers)."""
    weighted = supplier_reliability(suppliers, products)
    global_mean = exact_mean(weighted, [], "weighted_avg_reliability_score", "m").scalar()
    return suppliers.withColumn(
        "imputed_reliability_score",
        F.coalesce(F.col("reliability_score"), global_mean))


# ---------------------------------------------------------------- row-level cleaning

def _item_rows(df: DataFrame) -> DataFrame:
    return (df.withColumns({"unit_price": finite("unit_price"), "discount": finite("discount")})
            .withColumn("high_discount_flag", discount_flag("discount")))


def _store_rows(df: DataFrame) -> DataFrame:
    return df.withColumns({"new_region": region_label("region"),
                           "full_location": joined_label("_", "region", "location")})


def _inventory_rows(df: DataFrame) -> DataFrame:
    return with_inventory_gap(df).withColumn(
        "critical_quantity_gap_flag", stock_flag("quantity_percent"))


# What cleaning does to each row by itself, in a batch or a stream alike.
ROW_STEPS = {
    "transactions": lambda df: df.withColumn("month", F.month("transaction_date")),
    "items": _item_rows,
    "stores": _store_rows,
    "customers": lambda df: df.withColumn("year", F.year("signup_date")),
    "products": lambda df: df.withColumn("price_range", price_band("base_price")),
    "inventory": _inventory_rows,
    "promotions": lambda df: df,
    "suppliers": lambda df: df.withColumn("reliability_score", finite("reliability_score")),
}


def clean_rows(df: DataFrame, name: str) -> DataFrame:
    return ROW_STEPS[name](df)


def _stamped(raw: DataFrame, name: str, ingest_date) -> DataFrame:
    return clean_rows(stamp_ingest_date(raw, ingest_date), name)


# ---------------------------------------------------------------- dataset cleaners

def clean_transactions(raw: DataFrame, ingest_date) -> DataFrame:
    """Dedup on (transaction_id, store_id) keeping the latest date, then the
    highest amount; keep valid amounts; add month and the snapshot date."""
    deduped = dedup_latest(raw, ["transaction_id", "store_id"],
                           ["transaction_date", "total_amount"])
    valid = keep_valid_amount(deduped)
    return stamp_ingest_date(clean_rows(valid, "transactions"), ingest_date)


def clean_items(raw: DataFrame, ingest_date) -> DataFrame:
    """Impute unit_price by product mean; flag high discounts."""
    return impute_group_mean(stamped_items(raw, ingest_date), "unit_price", "product_id")


def stamped_items(raw: DataFrame, ingest_date) -> DataFrame:
    """Lines without price imputation, for results that read no price."""
    return _stamped(raw, "items", ingest_date)


def clean_stores(raw: DataFrame, ingest_date) -> DataFrame:
    return _stamped(raw, "stores", ingest_date)


def recent_transactions(raw: DataFrame, ingest_date, as_of, months: int = 36) -> DataFrame:
    """``clean_transactions`` limited to the last ``months`` months.

    The survivor of a duplicated transaction has the greatest date, so the
    date filter gives the same rows below the dedup, where it reaches the
    scan."""
    return clean_transactions(recent(raw, "transaction_date", as_of, months), ingest_date)


def clean_customers(raw: DataFrame, recent_tx: DataFrame, ingest_date) -> DataFrame:
    """Customers with at least one of the recent transactions (one row per
    customer), with the signup year."""
    # distinct ids: a customer with a huge share of transactions is one row
    active = recent_tx.select("customer_id").distinct()
    return (dated_customers(raw, ingest_date)
            .join(active, "customer_id", "left_semi"))


def dated_customers(raw: DataFrame, ingest_date) -> DataFrame:
    return _stamped(raw, "customers", ingest_date)


def clean_products(raw: DataFrame, ingest_date) -> DataFrame:
    return _stamped(raw, "products", ingest_date)


def clean_inventory(raw: DataFrame, ingest_date) -> DataFrame:
    return _stamped(raw, "inventory", ingest_date)


def clean_promotions(raw: DataFrame, ingest_date) -> DataFrame:
    return _stamped(raw, "promotions", ingest_date)


def clean_suppliers(raw: DataFrame, ingest_date) -> DataFrame:
    return _stamped(raw, "suppliers", ingest_date)
