"""Skew-safe window operators against Spark's plain window functions."""

import datetime as dt
import math
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tillwise.operators import windows


@pytest.fixture(scope="module")
def sales(spark):
    rnd = random.Random(7)
    data = []
    for i in range(400):
        store = rnd.choice([1, 1, 1, 2, 3])          # store 1 is hot
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        amount = None if i % 37 == 0 else round(rnd.uniform(1, 500), rnd.choice([0, 2, 5]))
        if i % 10 == 9:  # no numbers, and numbers of few or many digits
            amount = rnd.choice([float("nan"), float("inf"), -float("inf"), 3e-13, 1e15 / 7, -1 / 3])
        data.append((i, store, day, amount))
    return spark.createDataFrame(
        data, "transaction_id long, store_id int, transaction_date date, total_amount double")


def _plain(df, w, func, col="total_amount", key="transaction_id"):
    """``func`` over a plain Spark window, row by row in Python: the sum nearest
    to the exact one over the finite values of the frame."""
    out = []
    for r in df.select(key, F.collect_list(col).over(w).alias("vs")).collect():
        vs = [v for v in r.vs if math.isfinite(v)]
        n, s = len(vs), math.fsum(vs) if vs else None
        out.append((r[0], {"count": n, "sum": s, "avg": s / n if n else None}[func]))
    return sorted(out)


@pytest.mark.parametrize("bucket_rows", [7, 10, 33, 1 << 20])
def test_rolling_rows_matches_plain_window(sales, bucket_rows):
    got = windows.rolling_rows(sales, "store_id", ["transaction_date", "transaction_id"],
                               "total_amount", 6, "avg", "v", bucket_rows=bucket_rows)
    w = (Window.partitionBy("store_id").orderBy("transaction_date", "transaction_id")
               .rowsBetween(-6, 0))
    assert rows(got, "transaction_id", "v") == _plain(sales, w, "avg")


def test_rolling_rows_rejects_tiny_bucket(sales):
    with pytest.raises(ValueError):
        windows.rolling_rows(sales, "store_id", ["transaction_date"], "total_amount", 6,
                             bucket_rows=6)


def test_rolling_days_matches_range_window(sales):
    got = windows.rolling_days(sales, "store_id", "transaction_date", "total_amount", 7,
                               "avg", "v")
    w = (Window.partitionBy("store_id").orderBy(F.unix_date("transaction_date"))
               .rangeBetween(-6, 0))
    assert rows(got, "transaction_id", "v") == _plain(sales, w, "avg")


@pytest.mark.parametrize("func", ["avg", "sum", "count", "Average"])
def test_window_aggregate_matches_default_frame(sales, func):
    got = windows.window_aggregate(sales, "store_id", "transaction_date", func,
                                   "total_amount", "v")
    split = windows.window_aggregate(sales, "store_id", "transaction_date", func,
                                     "total_amount", "v", target_rows=3)
    w = Window.partitionBy("store_id").orderBy("transaction_date")
    want = _plain(sales, w, "avg" if func == "Average" else func)
    assert rows(got, "transaction_id", "v") == want
    assert rows(split, "transaction_id", "v") == want
    by_time = sales.withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))
    for target_rows in (3, 1 << 20):  # an order column that may have any number of values
        got = windows.window_aggregate(by_time, "store_id", "transaction_date", func, "total_amount", "v", target_rows=target_rows)
        assert rows(got, "transaction_id", "v") == want


@pytest.mark.parametrize("func", ["avg", "sum", "count"])
def test_values_that_are_no_numbers_are_neither_summed_nor_counted(spark, func):
    df = spark.createDataFrame([(k, 1, dt.date(2020, 1, 1 + k), v) for k, v in enumerate([1.0, float("nan"), 2.0, None, float("inf")])],
                               "id int, store int, day date, v double")
    want = {"avg": [1.0, 1.0, 1.5, 1.5, 1.5], "sum": [1.0, 1.0, 3.0, 3.0, 3.0], "count": [1, 1, 2, 2, 2]}[func]
    for got in (windows.window_aggregate(df, "store", "day", func, "v", "x"),
                windows.window_aggregate(df, "store", "id", func, "v", "x"),
                windows.rolling_days(df, "store", "day", "v", 7, func, "x"),
                windows.rolling_rows(df, "store", ["day", "id"], "v", 6, func, "x")):
        assert [x for _, x in rows(got, "id", "x")] == want


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("target_rows", [1, 5, 1 << 20])
def test_rank_rows_matches_plain_rank(sales, ascending, target_rows):
    df = sales.withColumn("total_amount", F.round("total_amount", -2))  # many ties
    got = windows.rank_rows(df, ["store_id"], "total_amount", "r", ascending, target_rows)
    w = Window.partitionBy("store_id").orderBy(
        F.asc_nulls_first("total_amount") if ascending else F.desc_nulls_last("total_amount"))
    assert rows(got, "transaction_id", "r") == rows(df.withColumn("r", F.rank().over(w)), "transaction_id", "r")


def test_ten_thousand_cuts(spark):
    """One key cut at every row: results stay exact, and a row's search costs a
    comparison for each doubling of the cuts, not for each cut."""
    n = 10_000
    df = spark.createDataFrame([(i * 7, 1, i % 13 / 8) for i in range(n)], "at long, store int, v double").repartition(8).cache()
    chunks = windows.with_chunks(df, ["store"], ["at"], 1)
    assert chunks.agg(F.count_distinct("_chunk")).first()[0] >= 0.95 * n
    got = windows.window_aggregate(df, "store", "at", "sum", "v", "s", target_rows=1)
    w = Window.partitionBy("store").orderBy("at")
    assert rows(got, "at", "s") == rows(df.withColumn("s", F.sum("v").over(w)), "at", "s")

    def seconds(cuts):
        held = spark.range(cuts).agg(F.array_sort(F.collect_list(F.col("id") * 10))).scalar()
        best = []
        for _ in range(4):
            t = time.perf_counter()
            windows.with_cuts_before(spark.range(400_000), held, F.col("id") % (cuts * 10), "c").agg(F.sum("c")).collect()
            best.append(time.perf_counter() - t)
        return min(best)

    assert seconds(10_000) < 5 * seconds(100) + 0.5


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 100])
def test_cuts_before_counts_the_cuts_up_to_a_place(spark, n):
    cuts = sorted(random.Random(n).choices(range(40), k=n))
    got = windows.with_cuts_before(spark.range(-1, 42), F.lit(cuts).cast("array<bigint>"), F.col("id"), "c")
    assert rows(got) == [(i, sum(c <= i for c in cuts)) for i in range(-1, 42)]


def test_cuts_are_bounded_whatever_the_table(spark, monkeypatch):
    monkeypatch.setattr(windows, "_SLOTS", 64)
    df = spark.range(20_000).select(F.col("id"), (F.col("id") % 3).alias("k"))
    chunks = windows.with_chunks(df, ["k"], ["id"], 8).groupBy("_p", "_chunk").count().collect()
    assert 8 <= len(chunks) <= 64 // 8 + 3 and max(r["count"] for r in chunks) < 20_000 / 3
    w = Window.partitionBy("k").orderBy("id")
    assert rows(windows.number_rows(df, ["k"], ["id"], "rn", 8), "id", "rn") == rows(
        df.withColumn("rn", F.row_number().over(w) - 1), "id", "rn")


def test_window_aggregate_unknown_function(sales):
    with pytest.raises(ValueError):
        windows.window_aggregate(sales, "store_id", "transaction_date", "median", "total_amount")


def test_number_rows_is_dense_per_key(sales):
    numbered = windows.number_rows(sales, ["store_id"], ["transaction_date", "transaction_id"])
    per_store = numbered.groupBy("store_id").agg(F.min("_rn").alias("lo"), F.max("_rn").alias("hi"),
                                                 F.count_distinct("_rn").alias("n"),
                                                 F.count(F.lit(1)).alias("c"))
    for r in per_store.collect():
        assert r["lo"] == 0 and r["hi"] == r["c"] - 1 and r["n"] == r["c"]


@pytest.mark.parametrize("target_rows", [1, 3, 10, 1 << 20])
def test_number_rows_in_chunks_is_exact(sales, target_rows):
    got = windows.number_rows(sales, ["store_id"], ["transaction_date", "transaction_id"],
                              "rn", target_rows=target_rows)
    w = Window.partitionBy("store_id").orderBy("transaction_date", "transaction_id")
    want = sales.withColumn("rn", F.row_number().over(w) - 1)
    assert rows(got, "transaction_id", "rn") == rows(want, "transaction_id", "rn")
    assert got.columns == sales.columns + ["rn"]


@pytest.mark.parametrize("target_rows,bucket_rows", [(2, 7), (5, 33)])
def test_rolling_rows_with_split_days(sales, target_rows, bucket_rows):
    got = windows.rolling_rows(sales, "store_id", ["transaction_date", "transaction_id"],
                               "total_amount", 6, "avg", "v", bucket_rows=bucket_rows,
                               target_rows=target_rows)
    w = (Window.partitionBy("store_id").orderBy("transaction_date", "transaction_id")
               .rowsBetween(-6, 0))
    assert rows(got, "transaction_id", "v") == _plain(sales, w, "avg")


_IDS = {
    "outlier": ("long", lambda i: i if i else 1 << 60),
    "wide": ("long", lambda i: (1 << 62) + i * (1 << 49) - (1 << 61)),
    "text": ("string", lambda i: f"id-{i:07d}"),
    "dense": ("long", lambda i: i),
}


@pytest.mark.parametrize("kind", sorted(_IDS))
def test_chunks_of_a_hot_key_are_bounded_whatever_the_ids(spark, kind):
    """One store, one day: only the ids can split it."""
    dtype, make = _IDS[kind]
    n, target = 6000, 400
    df = spark.createDataFrame([(make(i), 1, dt.date(2020, 1, 1), i % 7 / 8) for i in range(n)],
                               f"id {dtype}, store int, day date, v double")
    chunks = windows.with_chunks(df, ["store"], ["day", "id"], target).groupBy("_p", "_chunk").count().collect()
    assert max(r["count"] for r in chunks) <= 3 * target and len(chunks) >= n / target / 3
    got = windows.number_rows(df, ["store"], ["day", "id"], "rn", target_rows=target)
    ordered = sorted(make(i) for i in range(n))
    assert [r["id"] for r in got.orderBy("rn").select("id").collect()] == ordered
    got = windows.rolling_rows(df, "store", ["day", "id"], "v", 6, "sum", "s", bucket_rows=500, target_rows=target)
    w = Window.partitionBy("store").orderBy("day", "id").rowsBetween(-6, 0)
    assert rows(got, "id", "s") == rows(df.withColumn("s", F.sum("v").over(w)), "id", "s")


def test_running_sum_over_a_unique_order_column(spark):
    n, target = 6000, 400
    df = spark.createDataFrame([(i * 1000, 1 if i % 3 else None, 0.25) for i in range(n)], "at long, store int, v double")
    chunks = windows.with_chunks(df, ["store"], ["at"], target).groupBy("_p", "_chunk").count().collect()
    assert max(r["count"] for r in chunks) <= 3 * target
    got = windows.window_aggregate(df, "store", "at", "sum", "v", "s", target_rows=target)
    w = Window.partitionBy("store").orderBy("at")
    assert rows(got, "at", "s") == rows(df.withColumn("s", F.sum("v").over(w)), "at", "s")
