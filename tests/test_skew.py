"""Hot keys: results stay exact and the plans keep their skew safeguards."""

import datetime as dt
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tillwise.operators import clean, intervals, joins, layout, windows
from tillwise.plans import reports
from tillwise.plans.catalog import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_transactions(spark):
    # transaction 1 is copied 3000 times (a third of the rows), store 7 is hot
    hot = [(1, 7, 5, dt.date(2020, 1, 1), 10.0)] * 3000
    rest = [(i, 7 if i % 2 else i % 5, i, dt.date(2020, 1, 1 + i % 28), float(i))
            for i in range(2, 6002)]
    return spark.createDataFrame(
        hot + rest, "transaction_id long, store_id int, customer_id long, "
                    "transaction_date date, total_amount double")


def test_dedup_collapses_copies_before_the_shuffle(spark):
    tx = _hot_transactions(spark)
    out = clean.dedup_latest(tx, ["transaction_id", "store_id"],
                             ["transaction_date", "total_amount"])
    assert out.count() == 6001
    plan = _plan(out)
    # a partial (map-side) aggregate sits below the exchange on the keys
    assert re.search(r"Exchange hashpartitioning\(transaction_id#\d+L, store_id#\d+", plan)
    assert "partial_max" in plan


def test_rolling_rows_partitions_by_bucket(spark):
    tx = _hot_transactions(spark).dropDuplicates(["transaction_id"])
    out = windows.rolling_rows(tx, "store_id", ["transaction_date", "transaction_id"],
                               "total_amount", 6, "avg", "v", bucket_rows=500)
    plan = _plan(out)
    assert re.search(r"Window \[.*\], \[store_id#\d+, _bucket#\d+L?\]", plan)
    assert out.count() == tx.count()


def test_semi_join_right_side_is_distinct(spark):
    items = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "transaction_id long, product_id long")
    promos = spark.createDataFrame([(10,)] * 500 + [(12,)], "product_id long")
    out = items.join(joins.key_set(promos, "product_id"), "product_id", "left_semi")
    assert rows(out, "transaction_id") == [(1,), (2,)]
    assert "HashAggregate(keys=[product_id" in _plan(out)


def test_rebalance_keeps_every_row(spark):
    tx = _hot_transactions(spark)
    out = layout.repartition_by(tx, "store_id")
    assert out.count() == tx.count()
    assert "REBALANCE" in _plan(out).upper()


def test_no_window_over_raw_stores_in_running_queries(spark):
    plan = _plan(QUERIES["window_running_avg"](spark, SF_SMALL))
    # the window input is the (store, day) aggregate, not the transaction rows
    window_lines = [ln for ln in plan.splitlines() if "Window [" in ln]
    assert window_lines and all("sum(_xn#" in ln for ln in window_lines)


def test_interval_join_spreads_a_hot_product_and_matches_plain_join(spark):
    """Product 1 has a third of the lines; overlapping, touching, empty and unbounded promotions."""
    day = lambda n: dt.date(2019, 12, 25) + dt.timedelta(days=n)
    lines = [(i, 1 if i % 3 == 0 else i % 11, day(i * 7 % 900)) for i in range(3000)] + [(3000, None, day(3)), (3001, 1, None)]
    spans = [(1, 0, 0), (1, 5, 400), (1, 399, 899), (2, 31, 32), (3, 10, 9), (4, 0, 5000), (5, -9000, 9000), (6, 7, None), (None, 0, 900)]
    rows_df = spark.createDataFrame(lines, "line long, product_id long, day date")
    spans_df = spark.createDataFrame([(k, p, s if s is None else day(s), e if e is None else day(e))
                                      for k, (p, s, e) in enumerate(spans)], "promo int, product_id long, s date, e date")
    want = sorted(((n, k) for n, p, d in lines for k, (q, s, e) in enumerate(spans)
                   if None not in (p, d, q, s, e) and p == q and day(s) <= d <= day(e)), key=str)
    matched = {n for n, _ in want}
    want += [(n, None) for n, _, _ in lines if n not in matched]
    for days in (1, 32, 100_000):
        got = intervals.interval_left_join(rows_df, spans_df, "product_id", "day", "s", "e", days).select("i.line", "p.promo")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str), days
    joined = intervals.interval_left_join(rows_df, spans_df, "product_id", "day", "s", "e")
    assert re.search(r"Exchange hashpartitioning\(product_id#\d+L?, _day#\d+L?, ", _plan(joined))
    # the hot product's lines have as many keys as the calendar has buckets
    assert joined.where("i.product_id = 1").select("_day").distinct().count() >= 28


def _interval_join_is_sorted(spark, scratch, build) -> list[tuple]:
    """Rows of ``build(transactions, items, promotions)`` over Parquet files small
    enough for a broadcast by their size and by the measured one; the join with
    the copied promotions must not become one, before or after AQE."""
    def stored(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    tx = stored("tx", [(i, i % 3, i, day(i)) for i in range(100)],
                "transaction_id long, store_id int, customer_id long, transaction_date date")
    items = stored("items", [(i, i % 4 if i % 9 else None, 1, 2.0) for i in range(100)] + [(500, 1, 1, 2.0)],
                   "transaction_id long, product_id long, quantity int, unit_price double")
    promos = stored("promos", [(1, 1, day(0), day(60)), (2, 1, day(50), day(70)), (3, 2, day(90), day(400)), (4, 3, day(5), None)],
                    "promo_id long, product_id long, start_date date, end_date date")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "10m")
    try:
        out = build(tx, items, promos)
        planned, got = _plan(out), [tuple(r) for r in out.collect()]
        for plan in (planned, _plan(out).split("Initial Plan")[0]):
            join = [ln for ln in plan.splitlines() if re.search(r"Join .*_span#", ln)]
            assert len(join) == 1 and "SortMergeJoin" in join[0], join
    finally:
        spark.conf.set(conf, before)
    return got


def test_promo_revenue_never_broadcasts_the_copied_promotions(spark, scratch):
    got = _interval_join_is_sorted(spark, scratch, lambda t, i, p: reports.promo_revenue(t, i, p).select(
        "is_promoted", "total_revenue", "transaction_count", "line_count"))
    # products 1 (days 0-70) and 2 (from day 90): every fourth line, but for the null products
    held = sum(i % 9 > 0 and (i % 4 == 1 and i <= 70 or i % 4 == 2 and i >= 90) for i in range(100))
    assert sorted(got) == [(0, 2.0 * (100 - held), 100 - held, 100 - held), (1, 2.0 * held, held, held)]


def test_promo_interval_join_never_broadcasts_the_copied_promotions(spark, scratch):
    got = _interval_join_is_sorted(spark, scratch, lambda t, i, p: joins.promo_interval_join(t, i, p).select(
        "transaction_id", "promo_id"))
    # by product: promotion and its days; lines without one are kept, the orphan line is not
    spans = {1: [(1, 0, 60), (2, 50, 70)], 2: [(3, 90, 400)]}
    runs = {i: [k for k, a, b in spans.get(i % 4, ()) if i % 9 and a <= i <= b] for i in range(100)}
    assert sorted(got, key=str) == sorted(((i, k) for i, ks in runs.items() for k in ks or [None]), key=str)


def test_promo_uplift_never_broadcasts_the_copied_promotions(spark, scratch):
    got = _interval_join_is_sorted(spark, scratch, lambda t, i, p: reports.promo_uplift(t, i, p).select(
        "promoted_revenue", "non_promoted_revenue"))
    held = sum(i % 9 > 0 and (i % 4 == 1 and i <= 70 or i % 4 == 2 and i >= 90) for i in range(100))
    assert got == [(2.0 * held, 2.0 * (100 - held))]


def test_hot_product_imputation_exact(spark):
    lines = [(i, 1, 10.0 if i % 3 else None) for i in range(3000)] + \
            [(i, 2, 4.0) for i in range(3000, 3100)]
    df = spark.createDataFrame(lines, "line long, product_id long, unit_price double")
    out = clean.impute_group_mean(df, "unit_price", "product_id")
    assert out.where(F.col("unit_price").isNull()).count() == 0
    assert out.where(F.col("unit_price") != F.when(F.col("product_id") == 1, 10.0)
                     .otherwise(4.0)).count() == 0
    assert out.count() == df.count()
