"""Declared schemas of the eight retail datasets (no inference on read).

Ids are 64-bit and money is double: the driver's TPC-H-like keys are
bigint and prices carry cents.  Every field is nullable, as delivered.
"""

from pyspark.sql import types as T


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TRANSACTIONS = _schema(
    ("transaction_id", T.LongType()), ("store_id", T.IntegerType()),
    ("customer_id", T.LongType()), ("transaction_date", T.DateType()),
    ("total_amount", T.DoubleType()))

ITEMS = _schema(
    ("transaction_id", T.LongType()), ("product_id", T.LongType()),
    ("quantity", T.IntegerType()), ("unit_price", T.DoubleType()),
    ("discount", T.DoubleType()))

STORES = _schema(
    ("store_id", T.IntegerType()), ("location", T.StringType()),
    ("region", T.StringType()), ("size", T.StringType()),
    ("opening_date", T.DateType()))

CUSTOMERS = _schema(
    ("customer_id", T.LongType()), ("signup_date", T.DateType()),
    ("segment", T.StringType()), ("demographics", T.StringType()))

PRODUCTS = _schema(
    ("product_id", T.LongType()), ("product_name", T.StringType()),
    ("category_id", T.IntegerType()), ("base_price", T.DoubleType()),
    ("supplier_id", T.LongType()))

INVENTORY = _schema(
    ("store_id", T.IntegerType()), ("product_id", T.LongType()),
    ("date", T.DateType()), ("quantity", T.IntegerType()),
    ("reorder_point", T.IntegerType()))

PROMOTIONS = _schema(
    ("promo_id", T.LongType()), ("start_date", T.DateType()),
    ("end_date", T.DateType()), ("discount_type", T.StringType()),
    ("product_id", T.LongType()))

SUPPLIERS = _schema(
    ("supplier_id", T.LongType()), ("lead_time", T.IntegerType()),
    ("reliability_score", T.DoubleType()), ("country", T.StringType()),
    ("store_id", T.IntegerType()))

# Landing file name of each dataset, as delivered by the source system.
FILE_NAMES = {
    "transactions": "transactions.csv",
    "items": "transactionItems.csv",
    "stores": "stores.csv",
    "customers": "customers.csv",
    "products": "products.csv",
    "inventory": "inventory.csv",
    "promotions": "promotion.csv",
    "suppliers": "supplier.csv",
}

SCHEMAS = {
    "transactions": TRANSACTIONS,
    "items": ITEMS,
    "stores": STORES,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "inventory": INVENTORY,
    "promotions": PROMOTIONS,
    "suppliers": SUPPLIERS,
}

DATASETS = tuple(SCHEMAS)
