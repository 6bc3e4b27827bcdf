"""Interval helpers for date-range joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_intervals(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Union of closed intervals per ``key`` as disjoint intervals.

    Gaps-and-islands: an interval opens a new island when it starts after
    every earlier interval of the key has ended.  Intervals with a null
    bound or start > end cover no date and are dropped.  After merging, an
    equi + range join matches each probe at most once, so an existence flag
    needs no de-duplication of the probe side.

    Intervals sharing a start are first reduced to the longest one (a
    partial aggregate), so the per-key window sees at most one row per
    distinct start date, bounded by the calendar however many intervals a
    hot key has.
    """
    valid = (df.where(F.col(start).isNotNull() & F.col(end).isNotNull()
                      & (F.col(start) <= F.col(end)))
               .groupBy(key, start).agg(F.max(end).alias(end)))
    w = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    islands = valid.withColumn("_open", opens).withColumn(
        "_island", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (islands.groupBy(key, "_island")
                   .agg(F.min(start).alias(start), F.max(end).alias(end))
                   .drop("_island"))


def interval_left_join(rows: DataFrame, spans: DataFrame, key: str, date: str, start: str, end: str,
                       days: int = 32) -> DataFrame:
    """``rows`` LEFT JOIN ``spans`` on the key and ``date BETWEEN start AND end``
    (aliases ``i`` and ``p``; every match is a row, rows without one are kept).

    The equi key is (key, calendar bucket of ``days`` days): a span is copied
    into each bucket it touches, a row has one bucket, so no match is doubled
    and a key with a third of all rows is dealt over as many tasks as the
    calendar has buckets, by the plan itself and not by a run-time split.

    The copied spans are never broadcast: the optimizer sizes them by the file
    they come from, before they are copied, and every task would hold them all.
    Both sides are sorted, which spills, and a task holds its share."""
    def bucket(col: str):
        return F.floor(F.unix_date(F.col(col)) / days)

    covered = spans.where(F.col(start) <= F.col(end)).withColumn(
        "_span", F.explode(F.sequence(bucket(start), bucket(end)))).alias("p")
    dated = rows.withColumn("_day", bucket(date)).alias("i")
    cond = ((F.col(f"i.{key}") == F.col(f"p.{key}")) & (F.col("i._day") == F.col("p._span"))
            & F.col(f"i.{date}").between(F.col(f"p.{start}"), F.col(f"p.{end}")))
    return dated.join(covered.hint("merge"), cond, "left")
