"""Customer and product calculations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import within_months, year_month
from ..functions.money import cents, cents_to_money
from ..operators.clean import line_revenue
from ..operators.windows import rank_rows


def retention(customers: DataFrame, transactions: DataFrame, as_of,
              months: int = 36) -> DataFrame:
    """Of the customers with a transaction in the last ``months`` months, the
    share with one on or after their signup date.

    Transactions are reduced to each customer's last date before the join,
    which answers both questions, so the fact table never meets the customer
    table row by row."""
    last = (transactions.groupBy("customer_id").agg(F.max("transaction_date").alias("_last"))
            .where(within_months("_last", as_of, months)))
    joined = customers.select("customer_id", "signup_date").join(last, "customer_id")
    active = F.count_distinct(
        F.when(F.col("_last") >= F.col("signup_date"), F.col("customer_id")))
    total = F.count_distinct("customer_id")
    return joined.agg(active.alias("active_customers"), total.alias("total_customers")).select(
        "active_customers", "total_customers",
        F.try_divide(F.col("active_customers"), F.col("total_customers")).alias("retention_rate"))


def monthly_sales(items: DataFrame, transactions: DataFrame,
                  products: DataFrame) -> DataFrame:
    """Line revenue per (product, yyyy-MM)."""
    tx = transactions.select("transaction_id",
                             year_month("transaction_date").alias("year_month"))
    lines = items.select("transaction_id", "product_id",
                         cents(line_revenue()).alias("_c")).join(tx, "transaction_id")
    per_month = lines.groupBy("product_id", "year_month").agg(F.sum("_c").alias("_c"))
    return (per_month.join(products.select("product_id"), "product_id", "left_semi")
                     .select("product_id", "year_month",
                             cents_to_money("_c").alias("monthly_sales")))


# The column names of the growth results, previous_month_sales,
# sales_growth, positive_growth_count and total_months, are part of them.

def monthly_growth(items: DataFrame, transactions: DataFrame,
                   products: DataFrame) -> DataFrame:
    """Month-over-month growth in percent against the product's previous
    month with sales; null for its first month or a zero previous month.
    The window runs over one row per (product, month)."""
    sales = monthly_sales(items, transactions, products)
    w = Window.partitionBy("product_id").orderBy("year_month")
    prev = F.lag("monthly_sales", 1).over(w)
    return (sales.withColumn("previous_month_sales", prev)
                 .withColumn("sales_growth",
                             F.try_divide(F.col("monthly_sales") - F.col("previous_month_sales"),
                                          F.col("previous_month_sales")) * 100))


def consistent_growth(growth: DataFrame, start_month: str) -> DataFrame:
    """Products whose every growth value from ``start_month`` on is positive
    (at least one value required)."""
    since = growth.where(F.col("year_month") >= F.lit(start_month))
    agg = since.groupBy("product_id").agg(
        F.count(F.when(F.col("sales_growth") > 0, 1)).alias("positive_growth_count"),
        F.count("sales_growth").alias("total_months"))
    return agg.where((F.col("positive_growth_count") == F.col("total_months"))
                     & (F.col("total_months") > 0))


def supplier_rank(suppliers: DataFrame, ascending: bool = True,
                  out: str = "reliability_rank") -> DataFrame:
    """rank() of suppliers per country by reliability score (ascending with
    nulls first by default, as rank 1 = least reliable).

    The rows of a country are ranked in chunks of bounded size along the
    score, to which the rows of the chunks before are added."""
    return rank_rows(suppliers, ["country"], "reliability_score", out, ascending)


def category_lead_time(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Average supplier lead time over the products of each category.

    Products are counted per (supplier, category) first; the weighted mean
    equals the mean over product rows exactly (integer arithmetic)."""
    per_supplier = products.groupBy("supplier_id", "category_id").agg(
        F.count(F.lit(1)).alias("_n"))
    joined = per_supplier.join(suppliers.select("supplier_id", "lead_time"), "supplier_id")
    weighted = F.sum(F.col("lead_time") * F.col("_n"))
    counted = F.sum(F.when(F.col("lead_time").isNotNull(), F.col("_n")))
    return joined.groupBy("category_id").agg(
        F.try_divide(weighted.cast("double"), counted).alias("avg_lead_time"))
