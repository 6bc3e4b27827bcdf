"""Exact sums against rational arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillwise.functions.exact import add_up, exact_mean, exact_sum, lane_sums, with_parts, with_total

NAN, INF = float("nan"), float("inf")


def total(values):
    values = [v for v in values if v is not None and math.isfinite(v)]
    return float(sum(map(Fraction, values), Fraction(0))) if values else None


def _draw(rng, kind):
    return [lambda: round(rng.uniform(0, 1e5), 2),
            lambda: rng.uniform(-1, 1) * 2.0 ** rng.randrange(-60, 60),
            lambda: rng.choice([1e18, -1e18, 1.0, -1.0, 2.0 ** -100, -2.0 ** -110, 0.0, -0.0, 2.0 ** 62, 2.0 ** -120]),
            lambda: rng.randrange(-10, 10) * 2.0 ** -119,
            lambda: rng.choice([2.0 ** 53 + 2, -2.0 ** 53, 1.0, 0.5, -0.5, 2.0 ** -60]),  # halves to round to even
            lambda: rng.choice([None, NAN, INF, -INF, 1.5]),
            lambda: -rng.uniform(0, 1),
            lambda: rng.choice([3e-13, -3e-13, 7e-21, 1 / 3])][kind]()


@pytest.fixture(scope="module")
def groups(spark):
    rng = random.Random(1)
    data = [(g, _draw(rng, g % 8)) for g in range(1600) for _ in range(rng.randrange(1, 9))]
    by = {}
    for g, x in data:
        by.setdefault(g, []).append(x)
    return spark.createDataFrame(data, "g int, x double").repartition(5).cache(), by


def test_sums_are_the_nearest_double_to_the_exact_total(groups):
    df, by = groups
    got = {r.g: r.s for r in exact_sum(df, ["g"], "x", "s").collect()}
    assert got == {g: t for g, xs in by.items() if (t := total(xs)) is not None}


def test_means_divide_by_the_values_counted(groups):
    df, by = groups
    want = {}
    for g, xs in by.items():
        n = sum(x is not None and math.isfinite(x) for x in xs)
        if n:
            want[g] = total(xs) / n
    assert {r.g: r.m for r in exact_mean(df, ["g"], "x", "m").collect()} == want


def test_sums_of_sums_and_of_whole_tables(groups):
    df, by = groups
    per = with_parts(df, "x").groupBy("g").agg(*lane_sums())
    got = with_total(per.groupBy((F.col("g") % 8).alias("k")).agg(*add_up()), "s")
    want = [(k, total([x for g, xs in by.items() if g % 8 == k for x in xs])) for k in range(8)]
    assert rows(got, "k", "s") == want
    some = df.where("g % 8 in (0, 1, 6)")
    assert exact_sum(some, [], "x", "s").first()[0] == math.fsum(x for g, xs in by.items() if g % 8 in (0, 1, 6) for x in xs)


def test_small_values_are_not_cut(spark):
    df = spark.createDataFrame([(3e-13,), (3e-13,)], "x double")
    assert exact_sum(df, [], "x", "s").first()[0] == 6e-13
    assert exact_mean(df, [], "x", "s").first()[0] == 3e-13


def test_groups_and_tables_without_values(spark):
    df = spark.createDataFrame([(1, None), (1, NAN), (2, INF), (3, 0.5)], "g int, x double")
    assert rows(exact_sum(df, ["g"], "x", "s")) == [(3, 0.5)]
    assert rows(exact_sum(df.where("g < 3"), [], "x", "s")) == [(None,)]
    assert exact_mean(df.limit(0), [], "x", "s").first()[0] is None


def test_a_null_test_on_a_mean_costs_nothing(groups):
    """Filters are pushed through projections; one on the mean must not copy its steps into the plan."""
    means = exact_mean(groups[0], ["g"], "x", "m")
    plan = means.where("m is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(m" not in plan and plan.upper().count("LOG2(") == 1


@pytest.mark.parametrize("value", [2.0 ** 63, -1e300, 1e-30, 2.0 ** -121, 5e-324])
def test_values_beyond_the_lanes_are_refused(spark, value):
    df = spark.createDataFrame([(1.0,), (value,)], "price double")
    with pytest.raises(Exception, match="price: a value of 2.63 or more, or with binary digits below"):
        exact_sum(df, [], "price", "s").collect()


def test_integers_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 7), (1, 8), (2, None)], "g int, x int").withColumnRenamed("g", "a b")
    assert rows(exact_mean(df, ["a b"], "x", "mean x")) == [(1, 7.5)]


def test_exact_sums_use_a_hash_aggregate(groups):
    plan = exact_sum(groups[0], ["g"], "x", "s")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
