"""
item 3): properties that must hold whatever the data, checked on the
cleaned retail frames and the reports built from them."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillwise.operators import joins, validate
from tillwise.plans import reports
from tillwise.plans.retail import Retail


def test_promo_flag_partitions_lines_without_duplication(spark):
    r = Retail.of(spark, SF_SMALL)
    by_flag = reports.promo_revenue(r.transactions, r.items, r.promotions)
    flagged_lines = by_flag.agg(F.sum("line_count")).first()[0]
    lines = joins.transaction_lines(r.transactions, r.items).count()
    assert flagged_lines == lines
    assert sorted(row[0] for row in by_flag.select("is_promoted").collect()) == [0, 1]


def test_semi_and_anti_item_splits_cover_every_line(spark):
    r = Retail.of(spark, SF_SMALL)
    kept = joins.items_of_valid_transactions(r.items, r.transactions).count()
    orphans = validate.orphan_items(r.items, r.transactions).count()
    assert orphans > 0 and kept > 0
    assert kept + orphans == r.items.count()


def test_imputed_price_is_null_only_where_the_product_has_no_price(spark):
    r = Retail.of(spark, SF_SMALL)
    raw = r.raw("items")
    assert raw.where(F.col("unit_price").isNull()).limit(1).count() == 1
    priced = raw.where(F.col("unit_price").isNotNull()).select("product_id").distinct()
    still_null = r.items.where(F.col("unit_price").isNull()).select("product_id")
    assert still_null.join(priced, "product_id", "left_semi").count() == 0
    assert r.items.count() == raw.count()
