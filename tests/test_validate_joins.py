"""Validation rules, joins, calculations and reports on unit rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillwise.operators import intervals, joins, validate
from tillwise.plans import calc, reports

D = dt.date


def test_orphans_count_null_keys(spark):
    inv = spark.createDataFrame([(1, 10), (2, 11), (None, 12), (9, 13)],
                                "store_id int, product_id long")
    stores = spark.createDataFrame([(1,), (2,)], "store_id int")
    assert rows(validate.orphan_inventory(inv, stores), "product_id") == [(12,), (13,)]
    semi = inv.join(stores, "store_id", "left_semi").count()
    assert semi + validate.orphan_inventory(inv, stores).count() == inv.count()


def test_require_empty_gate(spark):
    empty = spark.createDataFrame([], "x int")
    validate.require_empty(empty, "nothing")
    with pytest.raises(validate.DataQualityError, match="orphan"):
        validate.require_empty(spark.createDataFrame([(1,)], "x int"), "orphan")


def test_store_sizes(spark):
    stores = spark.createDataFrame(
        [(1, "Small"), (2, "S"), (3, "m"), (4, "M"), (5, "XXL"), (6, None), (7, "L")],
        "store_id int, size string")
    assert rows(validate.valid_store_sizes(stores), "store_id", "size") == [
        (1, "Small"), (2, "Small"), (4, "Medium"), (7, "Large")]
    assert rows(validate.invalid_store_sizes(stores), "store_id") == [(3,), (5,), (6,)]


def test_promo_validity_and_summary(spark):
    promos = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "promo_id long, product_id long")
    products = spark.createDataFrame([(10,), (10,), (11,)], "product_id long")
    assert rows(validate.promo_validity(promos, products), "promo_id", "is_valid") == [
        (1, True), (2, False), (3, False)]
    summary = validate.validation_summary({
        "promo_product": validate.orphan_promotions(promos, products),
        "none": products.where(F.lit(False))})
    assert rows(summary) == [("none", 0), ("promo_product", 2)]


def test_merge_intervals_and_promo_flag_no_duplicates(spark):
    promos = spark.createDataFrame(
        [(1, 5, D(2020, 1, 1), D(2020, 1, 10)), (2, 5, D(2020, 1, 5), D(2020, 1, 20)),
         (3, 5, D(2020, 3, 1), D(2020, 3, 2)), (4, 6, D(2020, 1, 1), None),
         (5, 6, D(2020, 2, 2), D(2020, 2, 1))],
        "promo_id long, product_id long, start_date date, end_date date")
    merged = intervals.merge_intervals(promos, "product_id", "start_date", "end_date")
    assert rows(merged, "product_id", "start_date", "end_date") == [
        (5, D(2020, 1, 1), D(2020, 1, 20)), (5, D(2020, 3, 1), D(2020, 3, 2))]
    tx = spark.createDataFrame(
        [(100, 1, 1, D(2020, 1, 7)), (101, 1, 1, D(2020, 2, 1)), (102, 1, 1, D(2020, 3, 2))],
        "transaction_id long, store_id int, customer_id long, transaction_date date")
    items = spark.createDataFrame(
        [(100, 5, 2, 10.0, 0.0), (101, 5, 1, 10.0, 0.0), (102, 5, 1, 4.0, 0.0),
         (102, 6, 1, 1.0, 0.0)],
        "transaction_id long, product_id long, quantity int, unit_price double, discount double")
    flagged = reports.promo_flagged_lines(tx, items, promos)
    assert flagged.count() == items.count()      # overlap does not duplicate
    assert rows(flagged, "transaction_id", "product_id", "is_promoted") == [
        (100, 5, 1), (101, 5, 0), (102, 5, 1), (102, 6, 0)]
    raw = joins.promo_interval_join(tx, items, promos)
    assert raw.count() == 5                          # the raw join keeps both matches
    uplift = reports.promo_uplift(tx, items, promos).first()
    assert uplift["promoted_revenue"] == 24.0 and uplift["non_promoted_revenue"] == 11.0
    assert uplift["uplift_pct"] == pytest.approx((24 - 11) / 11 * 100)


def test_supplier_rank_ties_and_nulls(spark):
    s = spark.createDataFrame(
        [(1, "X", None), (2, "X", 1.0), (3, "X", 1.0), (4, "X", 2.0), (5, "Y", 3.0),
         (6, None, 1.0), (7, None, 1.0)],
        "supplier_id long, country string, reliability_score double")
    assert rows(calc.supplier_rank(s), "supplier_id", "reliability_rank") == [
        (1, 1), (2, 2), (3, 2), (4, 4), (5, 1), (6, 1), (7, 1)]
    assert dict(rows(calc.supplier_rank(s, ascending=False),
                     "supplier_id", "reliability_rank"))[4] == 1


def test_monthly_growth_first_and_zero_months(spark):
    tx = spark.createDataFrame(
        [(1, D(2020, 1, 5)), (2, D(2020, 2, 5)), (3, D(2020, 3, 5)), (4, D(2020, 4, 5))],
        "transaction_id long, transaction_date date")
    items = spark.createDataFrame(
        [(1, 7, 1, 10.0), (2, 7, 1, 0.0), (3, 7, 1, 5.0), (4, 7, 1, 6.0)],
        "transaction_id long, product_id long, quantity int, unit_price double")
    products = spark.createDataFrame([(7,)], "product_id long")
    g = calc.monthly_growth(items, tx, products)
    got = rows(g, "year_month", "previous_month_sales", "sales_growth")
    assert got == [("2020-01", None, None), ("2020-02", 10.0, -100.0),
                   ("2020-03", 0.0, None), ("2020-04", 5.0, 20.0)]
    assert rows(calc.consistent_growth(g, "2020-04"), "product_id") == [(7,)]
    assert calc.consistent_growth(g, "2020-02").count() == 0
    assert calc.consistent_growth(g, "2021-01").count() == 0   # no values: not consistent


def test_top_stores_pre_aggregates(spark):
    stores = spark.createDataFrame([(s,) for s in range(1, 8)], "store_id int")
    tx = spark.createDataFrame([(i, i % 7 + 1, 10.0 * (i % 7 + 1)) for i in range(70)],
                               "transaction_id long, store_id int, total_amount double")
    suppliers = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "supplier_id long, store_id int")
    products = spark.createDataFrame([(10, 1), (11, 2), (12, 2), (13, 3)],
                                     "product_id long, supplier_id long")
    top = reports.top_stores(stores, tx, suppliers, products, k=5)
    # only stores with supplied products qualify; revenue is not multiplied
    assert rows(top) == [(1, 100.0, 3), (2, 200.0, 1)]


def test_chain_join_join_type_is_a_parameter(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "transaction_id long, customer_id long")
    i = spark.createDataFrame([(1, 100), (1, 101), (3, 102)], "transaction_id long, product_id long")
    p = spark.createDataFrame([(100, "x")], "product_id long, product_name string")
    inner = joins.chain_join([t, i, p], ["transaction_id", "product_id"], "inner")
    assert rows(inner, "transaction_id", "product_id", "product_name") == [(1, 100, "x")]
    left = joins.chain_join([t, i, p], ["transaction_id", "product_id"], "left")
    assert rows(left, "transaction_id", "product_id", "product_name") == [
        (1, 100, "x"), (1, 101, None), (2, None, None)]
    with pytest.raises(ValueError):
        joins.chain_join([t, i], ["transaction_id", "product_id"])


def test_broadcast_only_after_size_check(spark):
    fact = spark.createDataFrame([(i, i % 5) for i in range(50)], "id long, k int")
    dim = spark.createDataFrame([(k, f"d{k}") for k in range(5)], "k int, name string")

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(joins.dimension_join(fact, dim, "k", max_rows=5)).lower()
    assert "broadcast" not in plan(joins.dimension_join(fact, dim, "k", max_rows=4)).lower()
    assert joins.dimension_join(fact, dim, "k", max_rows=4).count() == 50


def test_broadcast_byte_bound(spark):
    fact = spark.createDataFrame([(i, i % 5) for i in range(50)], "id long, k int")
    # each row: 8-byte null bitset + two 8-byte slots + "dN" rounded to 8 = 32
    dim = spark.createDataFrame([(k, f"d{k}") for k in range(5)], "k int, name string")

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString().lower()

    assert "broadcast" in plan(joins.dimension_join(fact, dim, "k", max_bytes=160))
    assert "broadcast" not in plan(joins.dimension_join(fact, dim, "k", max_bytes=159))
    wide = spark.createDataFrame([(k, "x" * 1000) for k in range(5)], "k int, name string")
    assert "broadcast" not in plan(joins.dimension_join(fact, wide, "k", max_bytes=4096))
    assert joins.dimension_join(fact, wide, "k", max_bytes=4096).count() == 50


def test_broadcast_byte_bound_nested(spark):
    fact = spark.createDataFrame([(i, i % 5) for i in range(50)], "id long, k int")
    # 24 fixed bytes + JSON text "[1,2,3]" (7 bytes) rounded to 8 = 32 per row
    dim = spark.createDataFrame([(k, [1, 2, 3]) for k in range(5)], "k int, xs array<int>")

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString().lower()

    assert "broadcast" in plan(joins.dimension_join(fact, dim, "k", max_bytes=160))
    assert "broadcast" not in plan(joins.dimension_join(fact, dim, "k", max_bytes=159))
