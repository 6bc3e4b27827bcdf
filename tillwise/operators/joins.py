"""Join operators.

Where a join only tests existence it is written as a semi/anti join, and
where a join feeds an aggregate the big side is reduced first, so a fact
table meets a dimension at most once and rows are never multiplied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import within_months
from ..functions.money import cents, cents_to_money
from .clean import line_revenue
from .intervals import interval_left_join


def key_set(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct key values for the right side of a semi/anti join.

    AQE can split a skewed *left* side of a semi/anti join but not the right
    one; reducing the right side to distinct keys (map-side combined) makes a
    hot key one row.  Its hash partitioning is the one the join needs."""
    return df.select(*cols).distinct()


def chain_join(frames: list[DataFrame], keys: list[str], how: str = "inner") -> DataFrame:
    """frames[0] JOIN frames[1] USING keys[0] JOIN frames[2] USING keys[1] ..."""
    if len(keys) != len(frames) - 1:
        raise ValueError("need one key per join step")
    out = frames[0]
    for frame, key in zip(frames[1:], keys):
        out = out.join(frame, [key], how)
    return out


def _row_bytes(dim: DataFrame):
    """Per-row size of ``dim`` in Spark's binary row format: a null bitset,
    one 8-byte slot per column, and each variable-length value rounded up to
    8 bytes (strings and binaries by their bytes, nested values by their JSON
    text, which is no smaller than their binary form)."""
    fixed = 8 * ((len(dim.columns) + 63) // 64) + 8 * len(dim.columns)
    var = []
    for f in dim.schema.fields:
        t = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if t in ("string", "binary"):
            n = F.octet_length(c)
        elif t in ("array", "map", "struct"):
            n = F.octet_length(F.to_json(c))
        else:
            continue
        var.append(F.coalesce(F.ceil(n / 8) * 8, F.lit(0)))
    out = F.lit(fixed).cast("long")
    for v in var:
        out = out + v
    return out


def broadcast_if_small(dim: DataFrame, max_rows: int = 1_000_000,
                       max_bytes: int = 64 << 20) -> DataFrame:
    """``dim`` with a broadcast hint when it has at most ``max_rows`` rows and
    at most ``max_bytes`` bytes in Spark's row format.

    The check is one job while the plan is built: a partial aggregate of
    both measures, so each task sends one row.  A larger frame is returned
    unhinted and its joins are planned from measured sizes by AQE."""
    n, size = dim.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(dim)), F.lit(0))).first()
    return F.broadcast(dim) if n <= max_rows and size <= max_bytes else dim


def dimension_join(fact: DataFrame, dim: DataFrame, key, how: str = "inner",
                   max_rows: int = 1_000_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Join a fact table to a dimension, broadcasting the dimension only after
    checking its row count and size (see ``broadcast_if_small``)."""
    return fact.join(broadcast_if_small(dim, max_rows, max_bytes), key, how)


def items_of_valid_transactions(items: DataFrame, transactions: DataFrame) -> DataFrame:
    return items.join(transactions.select("transaction_id"), "transaction_id", "left_semi")


def category_revenue_share(transactions: DataFrame, items: DataFrame,
                           products: DataFrame) -> DataFrame:
    """Revenue (sum of quantity * unit_price) per category and its share of
    the total in percent.  Lines are summed per product before meeting the
    product table, so the product join sees one row per product."""
    lines = items_of_valid_transactions(items, transactions)
    per_product = lines.groupBy("product_id").agg(
        F.sum(cents(line_revenue())).alias("_cents"))
    per_category = (per_product.join(products.select("product_id", "category_id"), "product_id")
                               .groupBy("category_id").agg(F.sum("_cents").alias("_cents")))
    # The grand total is a window over the per-category aggregate: one row per
    # category (a catalog-sized frame), so the join chain runs once instead of
    # again inside a scalar subquery.
    total = cents_to_money(F.sum("_cents").over(Window.partitionBy()))
    revenue = cents_to_money("_cents")
    return per_category.select(
        "category_id",
        revenue.alias("total_revenue"),
        (revenue / total * 100).alias("revenue_share"))


def promo_customers(transactions: DataFrame, items: DataFrame, promotions: DataFrame,
                    customers: DataFrame) -> DataFrame:
    """Customers (of the given population) who bought a product that has a
    promotion (any date): customer_id and name, one row per customer."""
    promo_lines = items.join(key_set(promotions, "product_id"), "product_id", "left_semi")
    buyers = transactions.join(key_set(promo_lines, "transaction_id"), "transaction_id",
                               "left_semi")
    return (customers.join(key_set(buyers, "customer_id"), "customer_id", "left_semi")
                     .select("customer_id", "name"))


def region_reliability(suppliers: DataFrame, products: DataFrame,
                       stores: DataFrame) -> DataFrame:
    """Highest reliability score per (region, supplier) for suppliers that
    supply at least one product, via the store they serve."""
    active = suppliers.join(key_set(products, "supplier_id"), "supplier_id", "left_semi")
    return (active.join(stores.select("store_id", "new_region"), "store_id")
                  .groupBy("new_region", "supplier_id")
                  .agg(F.max("reliability_score").alias("max_reliability_score")))


def region_best_supplier(suppliers: DataFrame, products: DataFrame,
                         stores: DataFrame) -> DataFrame:
    """Suppliers holding the best score of their region (ties kept).

    Equivalent to rank() = 1 by score descending, but built from a per-region
    max joined back on (region, score): no window over a whole region."""
    per_supplier = region_reliability(suppliers, products, stores)
    best = (per_supplier.groupBy("new_region")
                        .agg(F.max("max_reliability_score").alias("_best"))
                        .withColumnRenamed("new_region", "_region"))
    cond = (per_supplier["new_region"].eqNullSafe(best["_region"])
            & per_supplier["max_reliability_score"].eqNullSafe(best["_best"]))
    return per_supplier.join(best, cond).select(
        "new_region", "supplier_id", "max_reliability_score")


def stockouts(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """Inventory rows at or below their reorder point, for the given stores."""
    joined = inventory.join(stores.select("store_id", "new_region", "size"), "store_id")
    flag = F.coalesce(F.col("quantity") <= F.col("reorder_point"), F.lit(False))
    return joined.withColumn("stock_out", flag).where(F.col("stock_out"))


def segment_revenue(customers: DataFrame, transactions: DataFrame, as_of,
                    months: int = 36) -> DataFrame:
    """Revenue per segment of the customers with a transaction in the last
    ``months`` months, each transaction counted once, highest first.

    Transactions are summed per customer before the customer join; the same
    aggregate's last date tells who is recent, so no second join does."""
    per_customer = (transactions.groupBy("customer_id")
                    .agg(F.sum(cents("total_amount")).alias("_cents"),
                         F.max("transaction_date").alias("_last"))
                    .where(within_months("_last", as_of, months)))
    return (per_customer.join(customers.select("customer_id", "segment"), "customer_id")
                        .groupBy("segment").agg(F.sum("_cents").alias("_cents"))
                        .select("segment", cents_to_money("_cents").alias("total_revenue"))
                        .orderBy(F.desc("total_revenue"), F.asc("segment")))


def customer_transactions(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customer x transaction rows of the given (recent) transactions."""
    return (customers.join(transactions.select("customer_id", "transaction_id"), "customer_id")
                     .select("customer_id", "signup_date", "segment", "demographics",
                             "transaction_id")
                     .withColumn("year", F.year("signup_date")))


def transaction_lines(transactions: DataFrame, items: DataFrame) -> DataFrame:
    """Item lines of valid transactions with the transaction's store and date."""
    tx = transactions.select("transaction_id", "store_id", "customer_id", "transaction_date")
    return items.join(tx, "transaction_id")


def promo_interval_join(transactions: DataFrame, items: DataFrame,
                        promotions: DataFrame) -> DataFrame:
    """Each item line LEFT JOIN every promotion of its product running on the
    transaction date; a line under two overlapping promotions appears twice."""
    lines = transaction_lines(transactions, items)
    promos = promotions.select("promo_id", "product_id", "start_date", "end_date")
    joined = interval_left_join(lines, promos, "product_id", "transaction_date", "start_date", "end_date")
    return joined.select(
        "i.transaction_id", "i.product_id", "i.transaction_date", "i.quantity",
        "i.unit_price", "p.promo_id", "p.start_date", "p.end_date")
