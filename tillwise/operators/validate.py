"""Data-quality rules as violation frames.

A rule is a DataFrame of offending rows, so it stays lazy and distributed;
``require_empty`` turns one into a gate (it reads at most one row), and
``validation_summary`` reports every rule's count in one small frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Accepted store-size spellings and their canonical names.
ACCEPTED_SIZES = ("Small", "Large", "Medium", "S", "L", "M")
SIZE_NAMES = {"small": "Small", "s": "Small", "medium": "Medium", "m": "Medium",
              "large": "Large", "l": "Large"}


class DataQualityError(ValueError):
    """Raised by a gate whose rule found violations."""


def orphans(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` has no match in ``ref`` (null keys included)."""
    ref_key = ref_key or key
    keys = ref.select(F.col(ref_key).alias("_ref_key")).distinct()
    return df.join(keys, df[key] == keys["_ref_key"], "left_anti")


def orphan_items(items: DataFrame, transactions: DataFrame) -> DataFrame:
    return orphans(items, transactions, "transaction_id")


def orphan_inventory(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    return orphans(inventory, stores, "store_id")


def negative_values(df: DataFrame, col: str = "quantity") -> DataFrame:
    return df.where(F.col(col) < 0)


def with_sign_status(df: DataFrame, col: str = "quantity",
                     out: str = "quantity_status") -> DataFrame:
    """'invalid' where ``col`` is negative, else 'valid' (null counts as valid)."""
    return df.withColumn(out, F.when(F.col(col) < 0, "invalid").otherwise("valid"))


def promo_validity(promotions: DataFrame, products: DataFrame) -> DataFrame:
    """Promotions with ``is_valid``: their product exists."""
    keys = products.select(F.col("product_id").alias("_pid")).distinct()
    return (promotions.join(keys, promotions["product_id"] == keys["_pid"], "left")
                      .withColumn("is_valid", F.col("_pid").isNotNull())
                      .drop("_pid"))


def orphan_promotions(promotions: DataFrame, products: DataFrame) -> DataFrame:
    return orphans(promotions, products, "product_id")


def size_label(col: str = "size"):
    lower = F.lower(F.col(col))
    expr = None
    for spelling, name in SIZE_NAMES.items():
        expr = (F.when(lower == spelling, name) if expr is None
                else expr.when(lower == spelling, name))
    return expr.otherwise(F.col(col))


def valid_store_sizes(stores: DataFrame, col: str = "size") -> DataFrame:
    """Stores whose ``col`` is an accepted spelling, normalised to its name."""
    return (stores.where(F.col(col).isin(*ACCEPTED_SIZES))
                  .withColumn(col, size_label(col)))


def invalid_store_sizes(stores: DataFrame, col: str = "size") -> DataFrame:
    return stores.where(~F.coalesce(F.col(col).isin(*ACCEPTED_SIZES), F.lit(False)))


def inventory_counts(inventory: DataFrame, stores: DataFrame) -> DataFrame:
    """(rule, violations) of both inventory rules from one pass over it."""
    keys = stores.select(F.col("store_id").alias("_ref_key")).distinct()
    both = inventory.join(keys, inventory["store_id"] == keys["_ref_key"], "left").agg(
        F.count(F.when(F.col("_ref_key").isNull(), 1)).alias("inventory_store"),
        F.count(F.when(F.col("quantity") < 0, 1)).alias("negative_quantity"))
    return both.unpivot([], ["inventory_store", "negative_quantity"], "rule", "violations")


def validation_summary(rules: dict[str, DataFrame], counted: list[DataFrame] = ()) -> DataFrame:
    """One row per rule: (rule, violations).  Each count is a partial
    aggregate of its own rule; the union holds one row per rule.  ``counted``
    are frames of such rows already."""
    frames = [df.agg(F.count(F.lit(1)).alias("violations"))
                .select(F.lit(name).alias("rule"), "violations")
              for name, df in rules.items()] + list(counted)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def require_none(counts: dict[str, int], rules) -> None:
    """Gate over counted rules: raise when one of ``rules`` has violations."""
    broken = [f"{r} ({counts[r]})" for r in rules if counts.get(r)]
    if broken:
        raise DataQualityError(f"data validation failed: {', '.join(broken)}")


def require_empty(violations: DataFrame, rule: str) -> None:
    """Gate: raise when the rule has any violation (reads at most one row)."""
    if not violations.isEmpty():
        raise DataQualityError(f"data validation failed: rule '{rule}' has violations")
