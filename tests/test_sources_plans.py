"""Snapshot sources and physical-plan properties."""

import datetime as dt
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tillwise.plans.catalog import QUERIES
from tillwise.sources import read_dataset, stamp_ingest_date, testdata, write_snapshot
from tillwise.sources.schemas import SCHEMAS


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_snapshot_round_trip(spark, scratch):
    raw = testdata.derive(spark, SF_SMALL, "items")
    write_snapshot(raw, scratch, "items", "2001-08-01", "csv")
    back = read_dataset(spark, scratch, "items", "2001-08-01", "csv")
    assert back.schema == SCHEMAS["items"]
    assert rows(back) == rows(raw)


def test_snapshot_date_selects_folder(spark, scratch):
    raw = testdata.derive(spark, SF_SMALL, "stores")
    write_snapshot(raw, scratch, "stores", "2001-08-01", "parquet")
    write_snapshot(raw.limit(3), scratch, "stores", "2001-08-02", "parquet")
    assert read_dataset(spark, scratch, "stores", "2001-08-02", "parquet").count() == 3
    stamped = stamp_ingest_date(read_dataset(spark, scratch, "stores", dt.date(2001, 8, 1),
                                             "parquet"), "2001-08-01")
    assert dict(stamped.dtypes)["file_received_date"] == "date"
    assert stamped.select(F.countDistinct("file_received_date")).first()[0] == 1


def _landed_retail(spark, scratch):
    from tillwise.plans.retail import Retail
    from tillwise.sources.schemas import DATASETS
    for name in DATASETS:
        write_snapshot(testdata.derive(spark, SF_SMALL, name), scratch, name, "2001-08-01", "parquet")
    return Retail.from_landing(spark, scratch, "2001-08-01", fmt="parquet")


def test_recent_filter_reaches_parquet_scan(spark, scratch):
    from tillwise.plans.catalog import REPORTS
    r = _landed_retail(spark, scratch)
    for key in ("filter_recent_transactions", "join_recent_customers", "clean_demographics_unknown",
                "date_signup_year", "join_promo_customers"):
        scans = [ln for ln in _plan(REPORTS[key](r)).splitlines()
                 if "FileScan parquet" in ln and "transaction_date" in ln]
        assert any("GreaterThanOrEqual(transaction_date," in ln for ln in scans), key
    # both need every transaction: still one shuffle of the dedup, no filtered branch
    for key in ("join_segment_revenue", "calc_retention"):
        plan = _plan(REPORTS[key](r))
        assert len(re.findall(r"Exchange hashpartitioning\(transaction_id#\d+L?, store_id#\d+", plan)) == 1, key


def test_no_price_is_imputed_where_none_is_read(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for key, scans in (("rep_region_dashboard", 1), ("join_promo_customers", 1), ("validate_summary", 2)):
            plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert len([ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln]) <= scans, key
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_broadcast_check_sends_one_row_per_task(spark):
    from tillwise.operators import joins
    seen = []

    class Frame:
        def __init__(self, df):
            self.df, self.columns, self.schema = df, df.columns, df.schema

        def agg(self, *a):
            out = self.df.agg(*a)
            seen.append(_plan(out))
            return out

    joins.broadcast_if_small(Frame(spark.range(10).toDF("k")), max_rows=5)
    assert "GlobalLimit" not in seen[0] and "partial_count" in seen[0]


def test_two_landed_handles_both_read(spark):
    a = QUERIES["src_ingest_date"](spark, SF_SMALL)
    b = QUERIES["src_ingest_date"](spark, SF_SMALL)
    assert a.count() == b.count() == 25


def test_dimension_join_broadcasts_checked_stores(spark):
    plan = _plan(QUERIES["join_broadcast_stores"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_top_stores_is_take_ordered(spark):
    df = QUERIES["rep_top_stores"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in _plan(df)
    assert df.count() == 5


def test_column_pruning_on_lineitem(spark):
    plan = _plan(QUERIES["clean_discount_flag"](spark, SF_SMALL))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "l_shipdate" not in scan and "l_tax" not in scan


def test_no_python_udfs_in_any_plan(spark):
    for key, build in QUERIES.items():
        if key.startswith("src_"):
            continue
        plan = build(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan, key


def test_invariants_at_small_scale(spark):
    share = QUERIES["join_category_revenue_share"](spark, SF_SMALL)
    assert abs(share.agg(F.sum("revenue_share")).first()[0] - 100.0) < 1e-9
    promo = QUERIES["rep_promo_revenue"](spark, SF_SMALL).agg(F.sum("line_count")).first()[0]
    lines = QUERIES["join_three_way"](spark, SF_SMALL)
    # promo flag is per line of a valid transaction; products need not exist there
    from tillwise.plans.retail import Retail
    from tillwise.operators.joins import transaction_lines
    r = Retail(spark, SF_SMALL)
    assert promo == transaction_lines(r.transactions, r.items).count()
    assert lines.count() <= promo
    imputed = QUERIES["clean_impute_price"](spark, SF_SMALL)
    with_value = r.raw("items").where(F.col("unit_price").isNotNull()).select("product_id").distinct()
    assert imputed.where(F.col("unit_price").isNull()).join(with_value, "product_id").count() == 0


def test_scale_conf_sizes_shuffles_from_input(spark, scratch):
    from tillwise.session import input_bytes, scale_conf
    assert scale_conf(10 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(100 << 40)["spark.sql.shuffle.partitions"] == "204800"
    assert scale_conf(100 << 40, max_partitions=50_000)["spark.sql.shuffle.partitions"] == "50000"
    assert scale_conf(10 << 40)["spark.sql.shuffle.partitions"] == "20480"
    write_snapshot(testdata.derive(spark, SF_SMALL, "stores"), scratch, "stores",
                   "2001-08-01", "parquet")
    assert input_bytes(spark, scratch) > 0


def test_dashboard_shuffles_deduplicated_transactions_once(spark):
    from tillwise.plans.catalog import QUERIES
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["rep_region_dashboard"](spark, SF_SMALL)._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange [transaction_id" in plan


def test_supplier_rank_over_a_written_table_has_few_exchanges(spark, scratch):
    from tillwise.plans.calc import supplier_rank
    testdata.derive(spark, SF_SMALL, "suppliers").write.parquet(f"{scratch}/suppliers")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(supplier_rank(spark.read.parquet(f"{scratch}/suppliers")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") <= 5 and plan.count("SortMergeJoin") <= 2
