"""Window operators that stay parallel when one partition key is hot.

A plain ``Window.partitionBy(store)`` sends every row of a store to one
task; with a few dozen stores (one of which may hold a third of the rows)
that caps parallelism.  Here:

* running and day-range frames are computed on a (key, order value) grain
  aggregate and joined back to the rows.  Dates have so few values that the
  grain of a key is calendar-sized, and one window per key runs over it;
* for order columns of any other type a key's rows are cut into chunks along
  the order, each of about ``target_rows`` rows.  The cuts are order values
  themselves, taken from a sample chosen by a hash of the value, so they are a
  function of the data alone (a plan that reads the rows twice cuts them
  alike) and follow the rows' distribution: no arithmetic on ids.  A running
  result is the one within the chunk plus the total of the chunks before it,
  which comes from one row per chunk;
* the row frame (current row and N preceding rows) numbers rows per key,
  cuts each key into fixed-size buckets, copies the last N rows of every
  bucket into the next one as a halo, and evaluates the frame inside
  (key, bucket) partitions, whose size is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DateType

from ..functions.exact import finite, lane_names, lane_sums, with_parts, with_total

_FUNCS = ("avg", "sum", "count")
# Accepted spellings of the aggregate names.
_ALIASES = {"average": "avg", "mean": "avg", "avg": "avg", "sum": "sum", "count": "count"}

TARGET_ROWS = 1 << 20
_SAMPLED = 8  # sampled order values per chunk
_SLOTS = 1 << 19  # sampled order values kept, at most
_FEW_VALUES = (DateType, BooleanType, ByteType)  # a key has at most calendar-many of these


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                    how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null == null (as window partitions group nulls)."""
    r = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(r[f"_k_{k}"])
        cond = term if cond is None else cond & term
    return left.join(r, cond, how).drop(*[f"_k_{k}" for k in keys])


def cut_points(df: DataFrame, partition: list[str], order: list[str],
               target_rows: int = TARGET_ROWS) -> Column:
    """The sorted cuts of all keys as one scalar, ``array<struct<k, place>>``.

    One (key, order value) in ``target_rows / 8`` is sampled by its hash.  The
    sample is dealt to ``_SLOTS`` slots by another hash, and a slot keeps the
    value of least hash (partial aggregates, no key or task gathers more than
    the slots); every 8th of the sorted rest is a cut.  So there is about one
    cut in ``target_rows`` rows and, whatever the table's size, never more than
    ``_SLOTS / 8`` = 65,536, as few as a range exchange has bounds."""
    place = F.struct(F.xxhash64(*partition).alias("k"), F.struct(*order).alias("place"))
    every = max(1, target_rows // _SAMPLED)
    step = _SAMPLED if target_rows >= _SAMPLED else max(1, target_rows)
    # hashes of their own for sample and slot: not the one that deals rows to tasks
    sampled = df.where(F.pmod(F.xxhash64(F.lit("sample"), *partition, *order), F.lit(every)) == 0)
    kept = (sampled.groupBy(F.pmod(F.xxhash64(F.lit("slot"), *partition, *order), F.lit(_SLOTS)).alias("slot"))
            .agg(F.min(F.struct(F.xxhash64(F.lit("rank"), *partition, *order).alias("h"), place.alias("p"))).alias("m")))
    return (kept.agg(F.array_sort(F.collect_list("m.p")).alias("v"))
            .select(F.filter("v", lambda x, i: i % step == step - 1)).scalar())


def with_cuts_before(df: DataFrame, cuts: Column, place: Column, out: str) -> DataFrame:
    """Add ``out``: how many of the sorted ``cuts`` are not after ``place``: a
    binary search, one comparison for each doubling of the number of cuts.

    The column of cuts is used once, so the optimizer puts the scalar in its
    stead and all rows share one array instead of carrying a copy each."""
    steps = F.lit([1 << b for b in reversed(range((_SLOTS // _SAMPLED).bit_length()))])
    start = F.struct(F.lit(0).alias("at"), place.alias("place"))
    found = F.aggregate(steps, start, lambda s, step: F.struct(
        # beyond the last cut there is null, which is no step
        (s["at"] + F.when(F.get("_cuts", s["at"] + step - 1) <= s["place"], step).otherwise(0)).alias("at"),
        s["place"].alias("place")), lambda s: s["at"])
    return df.withColumn("_cuts", cuts).withColumn(out, found).drop("_cuts")


def with_chunks(df: DataFrame, partition: list[str], order: list[str],
                target_rows: int = TARGET_ROWS) -> DataFrame:
    """Add ``_p`` (the key) and ``_chunk``, which rises with ``order`` within a
    key; a chunk holds about ``target_rows`` rows (on a table of over 65,536
    times as many, its 65,536th part), apart from equal rows.  A row finds its
    chunk by binary search in the cuts: no join or shuffle of the rows."""
    cuts = cut_points(df, partition, order, target_rows)
    place = F.struct(F.xxhash64(*partition).alias("k"), F.struct(*order).alias("place"))
    return with_cuts_before(df.withColumn("_p", F.struct(*partition)), cuts, place, "_chunk")


def prefix_sums(df: DataFrame, partition: list[str], order: list[str], cols: list[str],
                target_rows: int = TARGET_ROWS) -> DataFrame:
    """Add ``<col>_upto`` (sum of ``col`` over the key's rows up to this one in
    ``order``, which must be unique within the key) and ``<col>_total``."""
    d = with_chunks(df, partition, order, target_rows)
    totals = d.groupBy("_p", "_chunk").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    chunks = Window.partitionBy("_p").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("_p")
    before = totals.select("_p", "_chunk", *[
        F.coalesce(F.sum(f"_t_{c}").over(chunks), F.lit(0)).alias(f"_b_{c}") for c in cols],
        *[F.sum(f"_t_{c}").over(every).alias(f"{c}_total") for c in cols])
    inside = (Window.partitionBy("_p", "_chunk").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumns({f"_i_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in cols})
    # dealt like the rows, so that these stay where they are
    return (d.join(before.repartition("_p", "_chunk"), ["_p", "_chunk"])
            .select(*df.columns, *[(F.col(f"_b_{c}") + F.col(f"_i_{c}")).alias(f"{c}_upto") for c in cols],
                    *[f"{c}_total" for c in cols]))


def _known(func: str) -> str:
    func = _ALIASES.get(func.lower(), func.lower())
    if func not in _FUNCS:
        raise ValueError(f"unknown window aggregate {func!r}; expected one of "
                         f"{sorted(_ALIASES)}")
    return func


def _per_value(df: DataFrame, grain: list[str], col: str, func: str) -> DataFrame:
    """One row per (key, order value): lanes of the exact sum of ``col`` (not
    for a count), and the number of its values."""
    if func == "count":
        return df.groupBy(*grain).agg(F.count(finite(col)).alias("_xn"))
    return with_parts(df.select(*dict.fromkeys((*grain, col))), col).groupBy(*grain).agg(*lane_sums())


def _sum_names(func: str) -> list[str]:
    return ["_xn"] if func == "count" else [*lane_names(), "_xn"]


def _finished(df: DataFrame, func: str, out: str) -> DataFrame:
    """Sums named by ``_sum_names`` -> the window's result ``out``."""
    if func == "count":
        return df.withColumnRenamed("_xn", out)
    return with_total(df, out, mean=func == "avg")


def window_aggregate(df: DataFrame, partition: list[str] | str, order: str, func: str,
                     col: str, out: str | None = None, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``func(col) OVER (PARTITION BY partition ORDER BY order)`` with the
    default frame (RANGE UNBOUNDED PRECEDING .. CURRENT ROW: rows with an
    equal order value are peers).  ``func`` is avg, sum or count; sums are
    exact, NaN and infinities are no values (see ``functions.exact``)."""
    func, out = _known(func), out or func
    partition = [partition] if isinstance(partition, str) else list(partition)
    grain, names = partition + [order], _sum_names(_known(func))
    per_value = _per_value(df, grain, col, func)
    if isinstance(df.schema[order].dataType, _FEW_VALUES):
        w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        sums = per_value.select(*grain, *[F.sum(c).over(w).alias(c) for c in names])
    else:
        filled = per_value.withColumns({c: F.coalesce(c, F.lit(0)) for c in names})
        sums = (prefix_sums(filled, partition, [order], names, target_rows)
                .select(*grain, *[F.col(f"{c}_upto").alias(c) for c in names]))
    return _null_safe_join(df, _finished(sums, func, out), grain, "left")


def rolling_days(df: DataFrame, partition: list[str] | str, date_col: str, col: str,
                 days: int = 7, func: str = "avg", out: str | None = None) -> DataFrame:
    """``func(col)`` over the ``days`` calendar days ending on each row's date
    (RANGE BETWEEN days-1 PRECEDING AND CURRENT ROW on the date).  The window
    runs over one row per (key, day): a key has as many as the calendar."""
    func = _known(func)
    out = out or f"rolling_{func}_{days}d"
    partition = [partition] if isinstance(partition, str) else list(partition)
    grain = partition + [date_col]
    w = (Window.partitionBy(*partition).orderBy(F.unix_date(F.col(date_col)))
               .rangeBetween(-(days - 1), 0))
    sums = _per_value(df, grain, col, func).select(*grain, *[F.sum(c).over(w).alias(c) for c in _sum_names(func)])
    return _null_safe_join(df, _finished(sums, func, out), grain, "left")


def _rows_before(d: DataFrame, latest_first: bool = False) -> DataFrame:
    """``_p, _chunk, _before``: rows of the key in the chunks before (after) each
    chunk.  Dealt like the rows, which stay where they are when joined to it."""
    counts = d.groupBy("_p", "_chunk").agg(F.count(F.lit(1)).alias("_c"))
    order = F.desc("_chunk") if latest_first else F.asc("_chunk")
    chunks = Window.partitionBy("_p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (counts.select("_p", "_chunk", F.coalesce(F.sum("_c").over(chunks), F.lit(0)).alias("_before"))
            .repartition("_p", "_chunk"))


def rank_rows(df: DataFrame, partition: list[str], order: str, out: str = "rank",
              ascending: bool = True, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``rank() OVER (PARTITION BY partition ORDER BY order)`` without a window
    over the whole partition: the rank within the row's chunk plus the rows of
    the chunks before (equal values share a chunk).  Nulls rank first in
    ascending order and last in descending order."""
    d = with_chunks(df, partition, [order], target_rows)
    inside = Window.partitionBy("_p", "_chunk").orderBy(F.asc_nulls_first(order) if ascending else F.desc_nulls_last(order))
    return (d.withColumn("_in", F.rank().over(inside))
            .join(_rows_before(d, not ascending), ["_p", "_chunk"])
            .select(*df.columns, (F.col("_before") + F.col("_in")).cast("int").alias(out)))


def number_rows(df: DataFrame, partition: list[str], order: list[str],
                out: str = "_rn", target_rows: int = TARGET_ROWS) -> DataFrame:
    """0-based row number per ``partition`` by ``order`` (ties in any order)
    without a window over the whole partition: numbered within the chunks of
    ``with_chunks``, plus the rows of the chunks before."""
    d = with_chunks(df, partition, order, target_rows)
    inside = Window.partitionBy("_p", "_chunk").orderBy(*order)
    return (d.withColumn("_in", F.row_number().over(inside))
            .join(_rows_before(d), ["_p", "_chunk"])
            .select(*df.columns, (F.col("_before") + F.col("_in") - 1).alias(out)))


def rolling_rows(df: DataFrame, partition: list[str] | str, order: list[str], col: str,
                 preceding: int = 6, func: str = "avg", out: str | None = None,
                 bucket_rows: int = 1 << 20, target_rows: int = TARGET_ROWS) -> DataFrame:
    """``func(col)`` over the current row and ``preceding`` rows before it
    (ROWS BETWEEN preceding PRECEDING AND CURRENT ROW) per ``partition``,
    ordered by ``order`` (make it total, e.g. date then id)."""
    func = _known(func)
    out = out or f"rolling_{func}_{preceding + 1}_rows"
    partition = [partition] if isinstance(partition, str) else list(partition)
    if bucket_rows <= preceding:
        raise ValueError("bucket_rows must exceed the frame length")
    numbered = number_rows(df, partition, list(order), target_rows=target_rows)
    home = F.floor(F.col("_rn") / bucket_rows)
    in_halo = (F.col("_rn") % bucket_rows) >= (bucket_rows - preceding)
    spread = (numbered
              .withColumn("_home", home)
              .withColumn("_bucket", F.explode(
                  F.when(in_halo, F.array(F.col("_home"), F.col("_home") + 1))
                   .otherwise(F.array(F.col("_home"))))))
    w = (Window.partitionBy(*partition, "_bucket").orderBy("_rn")
               .rowsBetween(-preceding, Window.currentRow))
    if func == "count":
        sums = [F.count(finite(col)).over(w).alias("_xn")]
    else:
        spread, sums = with_parts(spread, col), lane_sums(over=w)
    framed = spread.select(*df.columns, "_home", "_bucket", *sums)
    return _finished(framed.where(F.col("_bucket") == F.col("_home")).drop("_home", "_bucket"), func, out)
