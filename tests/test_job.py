"""The daily job over a landed snapshot."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tillwise.operators.joins import transaction_lines
from tillwise.operators.layout import write_bucketed
from tillwise.operators.validate import DataQualityError
from tillwise.plans import job
from tillwise.plans.catalog import QUERIES, REPORTS
from tillwise.plans.job import run_reports
from tillwise.plans.retail import Retail
from tillwise.sources import testdata, write_snapshot
from tillwise.sources.publish import current_run, read_published
from tillwise.sources.schemas import DATASETS


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    for name in DATASETS:
        write_snapshot(testdata.derive(spark, SF_SMALL, name), root, name, "2001-08-01", "csv")
    return root


def test_job_writes_reports_equal_to_catalog(spark, landed, scratch):
    retail = Retail.from_landing(spark, landed, "2001-08-01")
    keys = ["rep_top_stores", "rep_region_dashboard", "calc_supplier_rank"]
    targets = run_reports(retail, f"{scratch}/out", keys, gates=False,
                          materialize=True)
    assert set(targets) == set(keys) | {"validate_summary"}
    for key in keys:
        got = spark.read.parquet(targets[key])
        assert rows(got) == rows(QUERIES[key](spark, SF_SMALL)), key
        assert rows(read_published(spark, f"{scratch}/out", key)) == rows(got)
    summary = dict(rows(spark.read.parquet(targets["validate_summary"]), "rule", "violations"))
    assert summary["orphan_items"] == 67 and summary["promo_product"] > 0


def test_gates_stop_the_job_before_it_writes(spark, landed, scratch):
    retail = Retail.from_landing(spark, landed, "2001-08-01")
    with pytest.raises(DataQualityError, match="orphan_items"):
        run_reports(retail, f"{scratch}/out", ["rep_top_stores"])
    assert not os.path.exists(f"{scratch}/out")


def test_a_run_that_ends_half_way_leaves_the_one_before(spark, landed, scratch, monkeypatch):
    retail = Retail.from_landing(spark, landed, "2001-08-01")
    out = f"{scratch}/out"
    with pytest.raises(FileNotFoundError):
        read_published(spark, out, "rep_top_stores")
    run_reports(retail, out, ["rep_top_stores"], gates=False, materialize=False)
    before, run = rows(read_published(spark, out, "rep_top_stores")), current_run(spark, out)

    def fails(r):
        return r.spark.range(1).select(F.raise_error(F.lit("lost")).alias("x"))

    monkeypatch.setitem(REPORTS, "rep_broken", fails)
    with pytest.raises(Exception, match="lost"):
        run_reports(retail, out, ["agg_mode_size", "rep_broken"], gates=False, materialize=False)
    assert current_run(spark, out) == run and rows(read_published(spark, out, "rep_top_stores")) == before
    targets = run_reports(retail, out, ["agg_mode_size"], gates=False, materialize=False)
    assert current_run(spark, out) != run and current_run(spark, out) in targets["agg_mode_size"]
    assert rows(spark.read.parquet(f"{out}/runs/{run}/rep_top_stores")) == before  # still there for its readers


def test_rules_are_evaluated_once_and_gate_the_run(spark, landed, scratch, monkeypatch):
    seen = []
    monkeypatch.setattr(job, "summary", lambda r: seen.append(r) or spark.createDataFrame(
        [("orphan_items", 0), ("promo_product", 3), ("negative_quantity", 9)], "rule string, violations long"))
    retail = Retail.from_landing(spark, landed, "2001-08-01")
    with pytest.raises(DataQualityError, match=r"promo_product \(3\)"):
        run_reports(retail, f"{scratch}/out", ["agg_mode_size"], materialize=False)
    assert len(seen) == 1 and not os.path.exists(f"{scratch}/out")
    run_reports(retail, f"{scratch}/out", ["agg_mode_size"], gates=False, materialize=False,
                landing=spark.createDataFrame([("header:stores", 1)], "rule string, violations long"))
    assert rows(read_published(spark, f"{scratch}/out", "validate_summary")) == [
        ("header:stores", 1), ("negative_quantity", 9), ("orphan_items", 0), ("promo_product", 3)]


def test_materialized_facts_join_without_a_shuffle(spark, landed):
    out = Retail.from_landing(spark, landed, "2001-08-01").materialize()

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    joined = plan(transaction_lines(out.transactions, out.items))
    assert "SortMergeJoin [transaction_id" in joined and "Exchange" not in joined
    for key in ("join_category_revenue_share", "calc_monthly_growth", "rep_promo_revenue", "validate_orphan_items"):
        text = plan(REPORTS[key](out))
        assert "SortMergeJoin [transaction_id" in text and not re.search(r"Exchange hashpartitioning\(transaction_id#\d+L?, \d+\)", text), key
    assert rows(REPORTS["join_category_revenue_share"](out)) == rows(QUERIES["join_category_revenue_share"](spark, SF_SMALL))


def test_null_keys_are_spread_over_the_bucket_writers(spark, scratch):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    back = write_bucketed(df, f"{scratch}/t", "k", 8)
    assert rows(back) == rows(df)
    # one file per bucket, and the null bucket has one from each writer
    assert 8 <= len(back.inputFiles()) <= 8 + 7
    assert "Exchange" not in back.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()


def test_job_dates_and_flags(monkeypatch, spark, landed, scratch):
    seen = {}
    monkeypatch.setattr(job, "run_reports", lambda r, out, keys, gates, fmt, landing: seen.update(
        as_of=r.as_of, gates=gates) or {})
    monkeypatch.setattr(job, "apply_scale_conf", lambda *a: None)
    monkeypatch.setattr(job, "build_session", lambda app: spark)
    job.main(["--root", landed, "--date", "2001-08-01", "--out", scratch])
    assert seen == {"as_of": "2001-08-01", "gates": True}
    job.main(["--root", landed, "--date", "2001-08-01", "--as-of", "2000-01-31", "--out", scratch, "--no-gates"])
    assert seen == {"as_of": "2000-01-31", "gates": False}


def test_materialized_stores_are_broadcast_again(spark, landed):
    out = Retail.from_landing(spark, landed, "2001-08-01").materialize()
    plan = REPORTS["rep_weekly_revenue"](out)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    again = Retail.from_landing(spark, landed, "2001-08-01").materialize()
    assert out.transactions.inputFiles() != again.transactions.inputFiles()
    # customers come from the written transactions: no second dedup
    assert out.recent_transactions.inputFiles() == out.transactions.inputFiles()
