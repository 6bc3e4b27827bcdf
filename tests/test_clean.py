"""Unit rows for the cleaning operators' edge cases."""

import datetime as dt

from pyspark.sql import functions as F


from conftest import rows
from tillwise.functions.text import split_demographics
from tillwise.operators import clean

D = dt.date


def test_price_band_boundaries(spark):
    df = spark.createDataFrame([(1, 400.0), (2, 399.995), (3, 699.995), (4, 700.0),
                                (5, None), (6, 500.0), (7, 699.99)],
                               "product_id long, base_price double")
    out = dict(rows(df.select("product_id", clean.price_band().alias("b"))))
    assert out == {1: "Low", 2: "Low", 3: "699.995", 4: "High", 5: None,
                   6: "Medium", 7: "Medium"}


def test_discount_and_stock_flags(spark):
    df = spark.createDataFrame([(19.9,), (20.0,), (None,)], "d double")
    assert rows(df.select(clean.discount_flag("d").alias("f"))) == [(None,), ("H",), ("L",)]
    df = spark.createDataFrame([(49.0,), (50.0,), (None,)], "p double")
    assert rows(df.select(clean.stock_flag("p").alias("f"))) == [(None,), ("H",), ("L",)]


def test_inventory_gap_zero_and_negative_quantity(spark):
    df = spark.createDataFrame([(0, 10), (-5, 10), (20, 10), (None, 3)],
                               "quantity int, reorder_point int")
    out = rows(clean.with_inventory_gap(df), "quantity", "quantity_gap", "quantity_percent")
    assert out == [(None, None, None), (-5, -15, 300.0), (0, -10, None), (20, 10, 50.0)]


def test_region_label(spark):
    df = spark.createDataFrame([("NE",), ("north-east",), ("Northeast",), ("EUROPE",), (None,)],
                               "region string")
    out = rows(df.select(clean.region_label().alias("r")))
    assert out == [(None,), ("EUROPE",), ("Northeast",), ("Northeast",), ("Northeast",)]


def test_impute_group_mean_fills_only_missing(spark):
    df = spark.createDataFrame(
        [(1, 1, 10.0), (2, 1, 20.0), (3, 1, None), (4, 2, None), (5, 2, None),
         (6, None, 4.0), (7, None, None)],
        "line int, product_id long, unit_price double")
    out = rows(clean.impute_group_mean(df, "unit_price", "product_id"), "line", "unit_price")
    # product 2 has no value -> stays null; null key group averages like a window
    assert out == [(1, 10.0), (2, 20.0), (3, 15.0), (4, None), (5, None), (6, 4.0), (7, 4.0)]


def test_dedup_latest_is_deterministic_and_idempotent(spark):
    df = spark.createDataFrame(
        [(1, 1, 7, D(2020, 1, 1), 5.0), (1, 1, 7, D(2020, 1, 2), 3.0),
         (1, 1, 8, D(2020, 1, 2), 9.0), (1, 1, 9, D(2020, 1, 2), None),
         (2, 1, 1, D(2020, 1, 1), 1.0), (2, 1, 1, D(2020, 1, 1), 1.0),
         (2, 2, 1, D(2020, 1, 1), 1.0)],
        "transaction_id long, store_id int, customer_id long, transaction_date date, "
        "total_amount double")
    keys, prefer = ["transaction_id", "store_id"], ["transaction_date", "total_amount"]
    once = clean.dedup_latest(df, keys, prefer, cluster_by=["transaction_id"])
    assert rows(once) == [(1, 1, 8, D(2020, 1, 2), 9.0), (2, 1, 1, D(2020, 1, 1), 1.0),
                          (2, 2, 1, D(2020, 1, 1), 1.0)]
    assert rows(clean.dedup_latest(once, keys, prefer)) == rows(once)


def test_valid_amount(spark):
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, -1.0), (4, 2.5)], "id int, total_amount double")
    assert rows(clean.keep_valid_amount(df), "id") == [(4,)]


def test_fill_with_mode_ties_go_to_smallest(spark):
    df = spark.createDataFrame(
        [(1, "A", "m"), (2, "A", "S"), (3, "A", None), (4, "B", "L"), (5, "B", "L"),
         (6, "B", "S"), (7, "B", None), (8, "C", None)],
        "store_id int, region string, size string")
    # global: L x2, S x2, m x1 -> tie L/S -> "L"
    out = dict(rows(clean.fill_with_mode(df, "size"), "store_id", "size"))
    assert out[3] == "L" and out[7] == "L" and out[8] == "L" and out[1] == "m"
    by_region = dict(rows(clean.fill_with_mode(df, "size", ["region"]), "store_id", "size"))
    assert by_region[3] == "S"   # A: m x1, S x1 -> smallest is "S" ('S' < 'm')
    assert by_region[7] == "L"
    assert by_region[8] is None  # region C has no size at all


def test_unknown_demographics_split(spark):
    df = spark.createDataFrame([(1, "Ann| F |34"), (2, None), (3, "Bob| M |x")],
                               "customer_id long, demographics string")
    out = rows(split_demographics(clean.fill_unknown(df, "demographics")),
               "customer_id", "name", "sex", "age")
    assert out == [(1, "Ann", "F", 34), (2, "unknown", None, None), (3, "Bob", "M", None)]


def test_reliability_imputation(spark):
    suppliers = spark.createDataFrame(
        [(1, 2.0, "X"), (2, 3.0, "X"), (3, None, "Y"), (4, 1.0, "Y")],
        "supplier_id long, reliability_score double, country string")
    products = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, 3)],
                                     "product_id long, supplier_id long")
    # weighted: s1 = 2/2 = 1.0, s2 = 3/1 = 3.0 ; s4 has no product ; mean = 2.0
    out = dict(rows(clean.impute_reliability(suppliers, products),
                    "supplier_id", "imputed_reliability_score"))
    assert out == {1: 2.0, 2: 3.0, 3: 2.0, 4: 1.0}


def test_recent_window(spark):
    df = spark.createDataFrame([(D(1998, 7, 31),), (D(1998, 8, 1),), (D(2001, 8, 1),)], "d date")
    assert rows(clean.recent(df, "d", "2001-08-01", 36)) == [(D(1998, 8, 1),), (D(2001, 8, 1),)]


def test_sums_are_exact_in_any_order(spark):
    from tillwise.functions.exact import exact_sum
    from tillwise.functions.money import cents, cents_to_money
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "x double")
    total = cents_to_money(F.sum(cents("x")))
    for frame in (df, df.repartition(7)):  # independent of partitioning / row order
        assert frame.agg(total).first()[0] == 3.0 and exact_sum(frame, [], "x", "s").first()[0] == 3.0


def test_averages_keep_the_inputs_digits(spark):
    suppliers = spark.createDataFrame([(1, 0.004, "X"), (2, None, "X")],
                                      "supplier_id long, reliability_score double, country string")
    products = spark.createDataFrame([(10, 1)], "product_id long, supplier_id long")
    out = dict(rows(clean.impute_reliability(suppliers, products), "supplier_id", "imputed_reliability_score"))
    assert out == {1: 0.004, 2: 0.004}
    lines = spark.createDataFrame([(7, 0.004), (7, None), (7, 0.005)], "product_id long, unit_price double")
    filled = rows(clean.impute_group_mean(lines, "unit_price", "product_id"), "unit_price")
    assert filled == [(0.004,), ((0.004 + 0.005) / 2,), (0.005,)]  # the sum nearest to the two doubles'


def test_reliability_of_millions_of_suppliers(spark):
    ids = spark.range(2_000_000)
    suppliers = ids.select(F.col("id").alias("supplier_id"), F.lit("X").alias("country"),
                           F.when(F.col("id") > 0, 4.9).alias("reliability_score"))
    products = ids.select(F.col("id").alias("product_id"), F.col("id").alias("supplier_id"))
    out = clean.impute_reliability(suppliers, products)
    assert abs(out.where("supplier_id = 0").first()["imputed_reliability_score"] - 4.9) < 1e-12


def test_values_that_are_no_numbers_are_rejected(spark):
    nan, inf = float("nan"), float("inf")
    tx = spark.createDataFrame([(1, 1.0), (2, nan), (3, inf), (4, None), (5, -1.0)], "id int, total_amount double")
    assert rows(clean.keep_valid_amount(tx), "id") == [(1,)]
    items = spark.createDataFrame([(1, nan, 5.0), (1, 2.0, inf)], "product_id long, unit_price double, discount double")
    got = rows(clean.clean_items(items, "2001-08-01"), "unit_price", "discount", "high_discount_flag")
    assert got == [(2.0, None, None), (2.0, 5.0, "L")]
