"""Exact sums of doubles.

Floating addition rounds, so a plain ``sum`` depends on the order in which
rows meet.  Here a double is cut into nine integer lanes, each a fixed range
of binary places; lanes are summed as 64-bit integers (fixed-width buffers: a
hash aggregate, a window or a prefix sum, in any order), and the nine sums are
turned into the double nearest to their exact total once at the end.

* Every double below 2^63 in magnitude whose last binary digit is not below
  2^-120 is summed to its last digit: all doubles from 7e-21 up, and zero.
  Any other finite value stops the query with an error that names the column:
  no digit is cut unseen.
* NaN, the infinities and null are no values: neither summed nor counted.
* A lane has at most 24 bits, so a group may hold 2^39 rows; beyond, Spark's
  integer overflow check stops the query.

The expressions are SQL text, one call to the JVM each, in a few projections
that build on each other, so every step is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Binary place of each lane's unit, and the lane's width in bits (the first is signed).
_UNITS = (48, 24, 4, -16, -36, -56, -76, -96, -120)
_WIDTHS = (15, 24, 20, 20, 20, 20, 20, 20, 24)
LANES = len(_UNITS)
_WORD = (1 << 60) - 1


def finite(col) -> Column:
    """The value, or null where it is NaN or infinite (neither is a price,
    an amount, a discount or a score)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def _two(n: int) -> str:
    return f"{2.0 ** n!r}D"


def with_parts(df: DataFrame, col: str, prefix: str = "_x") -> DataFrame:
    """``df`` with the value of ``col`` cut into four integers ``<prefix>a..d``
    (null without a value), of which :func:`lane_sums` makes lanes.  Each takes
    the whole part of what the one before leaves; what remains is exact."""
    p = prefix
    refuse = (f"cast(raise_error('{col}: a value of 2^63 or more, or with binary digits below 2^-120, "
              "has no exact sum') as double)")
    v, kept = f"cast(`{col}` as double)", [f"`{c}`" for c in df.columns]
    whole = lambda x: f"cast({x} as bigint)"
    left = lambda x, n: f"({x} - cast({whole(x)} as double)) * {_two(n)}"
    a = f"{p}v * {_two(-24)}"
    return (df.selectExpr("*", f"case when abs({v}) < {_two(63)} then {v} when abs({v}) < double('infinity') then {refuse} end as {p}v")
            .selectExpr(*kept, f"{whole(a)} as {p}a", f"({p}v - cast({whole(a)} as double) * {_two(24)}) * {_two(36)} as {p}f")
            .selectExpr(*kept, f"{p}a", f"{whole(f'{p}f')} as {p}b", f"{left(f'{p}f', 60)} as {p}g")
            .selectExpr(*kept, f"{p}a", f"{p}b", f"{whole(f'{p}g')} as {p}c", f"{left(f'{p}g', 24)} as {p}h")
            .selectExpr(*kept, f"{p}a", f"{p}b", f"{p}c", f"cast(case when {p}h = rint({p}h) then {p}h "
                        f"when {p}h is not null then {refuse} end as bigint) as {p}d"))


def lane_names(prefix: str = "_x") -> list[str]:
    return [f"{prefix}{k}" for k in range(LANES)]


def lane_sums(prefix: str = "_x", over=None) -> list[Column]:
    """Sums over the columns of :func:`with_parts`, named ``<prefix>0..8`` and
    ``<prefix>n`` (values counted): aggregates, or sums over a window."""
    p, low24, low20 = prefix, (1 << 24) - 1, (1 << 20) - 1
    lanes = [f"shiftright({p}a, 24)", f"{p}a & {low24}L"]
    for word in (f"{p}b", f"{p}c"):
        lanes += [f"shiftright({word}, 40)", f"shiftright({word}, 20) & {low20}L", f"{word} & {low20}L"]
    sums = [F.expr(f"{f}({x})") for f, x in (*[("sum", x) for x in (*lanes, f"{p}d")], ("count", f"{p}a"))]
    return [(x if over is None else x.over(over)).alias(n) for x, n in zip(sums, (*lane_names(p), f"{p}n"))]


def add_up(prefix: str = "_x") -> list[Column]:
    """The same aggregates over columns that :func:`lane_sums` made."""
    return [F.expr(f"sum({n})").alias(n) for n in (*lane_names(prefix), f"{prefix}n")]


def with_total(df: DataFrame, out: str, prefix: str = "_x", mean: bool = False, always: bool = False) -> DataFrame:
    """Replace the lane sums by ``out``, the double nearest to their total (null
    where no value was counted), or that double divided by the count of values.
    With ``always`` every row has a value, so ``out`` is never null and no null
    test on it is pushed through these steps.

    The carried lanes are four words of a two's complement number, P 2^24 +
    Q 2^-36 + R 2^-96 + T 2^-156; of the absolute value the 60 leading bits are
    taken, with one more bit that tells whether anything follows, so the final
    conversion to double rounds as if it saw all digits."""
    p = prefix
    s = [f"coalesce({n}, 0L)" for n in lane_names(p)]
    v = [s[-1]]
    for k in range(LANES - 1, 0, -1):  # carry from lane k into lane k-1
        v.insert(0, f"({s[k - 1]} + shiftright({v[0]}, {_WIDTHS[k]}))")
    digit = [v[0], *[f"({x} & {(1 << w) - 1}L)" for x, w in zip(v[1:], _WIDTHS[1:])]]

    def word(d: list[str]) -> str:
        return f"{d[0]} * {1 << 40}L + {d[1]} * {1 << 20}L + {d[2]}"

    def first(*choice: str) -> str:
        return f"case when {p}_p != 0 then {choice[0]} when {p}_q != 0 then {choice[1]} when {p}_r != 0 then {choice[2]} else {choice[3]} end"

    kept = [*[f"`{c}`" for c in df.columns if c not in (*lane_names(p), f"{p}n")], f"{p}n"]
    made = df.selectExpr(*kept, f"{digit[0]} * {1 << 24}L + {digit[1]} as {p}_w", f"{word(digit[2:5])} as {p}_x",
                         f"{word(digit[5:8])} as {p}_y", f"{digit[8]} * {1 << 36}L as {p}_z")
    # the absolute value: words of the negated number where it is below zero
    less = f"{p}_w < 0"
    made = made.selectExpr(
        *kept, f"{less} as {p}_less",
        f"if({less}, -{p}_w - if({p}_x + {p}_y + {p}_z = 0, 0L, 1L), {p}_w) as {p}_p",
        f"if({less}, (-{p}_x - if({p}_y + {p}_z = 0, 0L, 1L)) & {_WORD}L, {p}_x) as {p}_q",
        f"if({less}, (-{p}_y - if({p}_z = 0, 0L, 1L)) & {_WORD}L, {p}_y) as {p}_r",
        f"if({less}, -{p}_z & {_WORD}L, {p}_z) as {p}_t")
    made = made.selectExpr(
        *kept, f"{p}_less", f"{first(f'{p}_p', f'{p}_q', f'{p}_r', f'{p}_t')} as {p}_hi",
        f"{first(f'{p}_q', f'{p}_r', f'{p}_t', '0L')} as {p}_lo",
        f"{first(f'{p}_r + {p}_t', f'{p}_t', '0L', '0L')} as {p}_rest", f"{first('24', '-36', '-96', '-156')} as {p}_e")
    # bits by which hi moves up so that it has about 60
    made = made.selectExpr(
        *kept, f"{p}_less", f"{p}_hi", f"{p}_lo", f"{p}_rest", f"{p}_e",
        f"greatest(0, least(60, 60 - coalesce(cast(floor(log2(cast(greatest({p}_hi, 1L) as double))) as int), 0))) as {p}_s")
    moved = f"shiftright({p}_lo, 60 - {p}_s)"
    more = f"if({p}_lo - shiftleft({moved}, 60 - {p}_s) + {p}_rest = 0, 0L, 1L)"
    made = made.selectExpr(
        *kept, f"{p}_less", f"cast(shiftleft({p}_hi, {p}_s) + {moved} | {more} as double) * pow(2D, {p}_e - {p}_s) as {p}_size")
    made = made.selectExpr(*kept, f"if({p}_less, -{p}_size, {p}_size) as {p}_total")
    result = F.col(f"{p}_total")
    if mean:  # a division by a count of 0 is not reached, and never null
        result = F.coalesce(F.try_divide(result, F.col(f"{p}n")), F.lit(0.0))
    return made.select(*kept[:-1], (result if always else F.when(F.col(f"{p}n") > 0, result)).alias(out))


def _per_group(df: DataFrame, groups: list[str], col: str, out: str, mean: bool) -> DataFrame:
    parts = with_parts(df.select(*groups, col), col)
    if groups:  # a table without values still has one total: null
        parts = parts.where("_xa is not null")
    return with_total(parts.groupBy(*groups).agg(*lane_sums()), out, mean=mean, always=bool(groups))


def exact_sum(df: DataFrame, groups: list[str], col: str, out: str) -> DataFrame:
    """``groups + [out]``: the sum of ``col`` per group that has values; without
    groups one row, null without values."""
    return _per_group(df, groups, col, out, mean=False)


def exact_mean(df: DataFrame, groups: list[str], col: str, out: str) -> DataFrame:
    """The same of the mean, which is the exact sum divided by the count."""
    return _per_group(df, groups, col, out, mean=True)
