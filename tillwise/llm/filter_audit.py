"""Filter interaction audit: what each of five document filters removes, in
every order, and its Shapley value by exact constrained least squares.

A document is only known by the set of filters that it fails, so a part (a
value of ``lang``) is 32 counts.  From them the table of all 32 coalitions is
made: v(S) = documents that the filters of S remove together.  Everything
else follows from v:

* a step that adds filter f to the filters S before it removes
  v(S + f) - v(S); documents that are good or toxic are tabled alike;
* the Shapley values are the weights of the additive model that is nearest to
  v under the Shapley kernel weights, subject to the weights' sum being
  v(all) (efficiency).  Its normal equations are solved in rationals once,
  with v left symbolic: that gives the exact integer combination of the 32
  coalitions that is 120 times each filter's value.

Failures A to D are row expressions, E (the text occurs at a smaller doc_id)
compares a row's id with the least id of its text, found by the sha256 of the
text.  Texts are read once and never shuffled; identical rows are combined
before every exchange, and rows meet the least id of their text on (text, id),
so a text or an id that a third of all rows share is spread or combined.

Null text is the empty text and fails A; null lang is the part ''.  A null id
is neither smaller nor larger than any, so it neither fails E nor makes others
fail, and has no label.  Repeated rows each count; rows with equal id and text
do not make each other fail E.  A document is good or toxic if any label row
of its id says so.  Texts of any length are read whole.  Other columns, of
whatever name, are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations, permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
MIN_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
MARKS = "#$%&*|"
_SPACE = r"[\x20\x09-\x0D]+"


def text_failures() -> Column:
    """Bits of the filters A to D that column ``text`` (not null) fails."""
    words = F.array_remove(F.split("text", _SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [n < MIN_WORDS,
             distinct * 100 < n * DISTINCT_PERCENT,
             F.regexp_count("text", F.lit("[A-Z]")).cast("long") * 100 > F.length("text").cast("long") * UPPER_PERCENT,
             F.col("text").rlike(f"[{MARKS}]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, fails, n``: rows counted by id, part and set of failed filters."""
    rows = (docs.select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("text"))
            .select("id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                    text_failures().alias("fails"))
            .groupBy("digest", "id", "part", "fails").agg(F.count("*").alias("n")))
    rows = staged(rows, "failures")  # read twice below, the texts once
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    later = F.col("first").isNull() & F.col("id").isNotNull()
    return (rows.join(first, ["digest", "id"], "left")
            .groupBy(F.col("id").alias("doc_id"), "part",
                     (F.col("fails") + F.when(later, 1 << FILTERS.index("E")).otherwise(0)).alias("fails"))
            .agg(F.sum("n").alias("n")))


def coalitions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, all, v, good, toxic``: documents, and the documents (good ones,
    toxic ones) that each of the 32 coalitions removes, by coalition number."""
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    rows = (failures(docs).join(marks, "doc_id", "left")
            .groupBy("part", "fails").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                          F.sum(F.col("n") * F.col("toxic")).alias("toxic")))

    def table(col: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("fails").bitwiseAND(s) != 0, F.col(col))), F.lit(0)).cast("long")
                         for s in range(ALL + 1)])

    return rows.groupBy("part").agg(F.sum("n").alias("all"), table("n").alias("v"), table("good").alias("good"),
                                    table("toxic").alias("toxic"))


def solve(a: list[list[Fraction]], b: list[list[Fraction]]) -> list[list[Fraction]]:
    """X with A X = B for a regular A, exactly (Gauss-Jordan)."""
    n = len(a)
    rows = [list(x) + list(y) for x, y in zip(a, b)]
    for k in range(n):
        pivot = next(r for r in range(k, n) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(n):
            if r != k and rows[r][k]:
                rows[r] = [x - rows[r][k] * y for x, y in zip(rows[r], rows[k])]
    return [r[n:] for r in rows]


def shapley_weights(n: int = len(FILTERS)) -> list[list[int]]:
    """Integer weights W[i][S] with n! x (Shapley value of filter i) = sum W[i][S] v(S).

    Minimise the kernel-weighted squares of v(S) - sum of phi over S, over all
    coalitions but none and all, subject to the sum of phi being v(all)."""
    every = range(1 << n)
    size = [s.bit_count() for s in every]
    kernel = [Fraction(n - 1, comb(n, z) * z * (n - z)) if 0 < z < n else Fraction(0) for z in size]
    a = [[sum(kernel[s] for s in every if s >> i & 1 and s >> j & 1) for j in range(n)] + [Fraction(1)] for i in range(n)]
    b = [[kernel[s] if s >> i & 1 else Fraction(0) for s in every] for i in range(n)]
    a.append([Fraction(1)] * n + [Fraction(0)])  # efficiency, with its multiplier
    b.append([Fraction(s == every[-1]) for s in every])
    weights = [[w * factorial(n) for w in row] for row in solve(a, b)[:n]]
    assert all(w.denominator == 1 for row in weights for w in row)
    return [[int(w) for w in row] for row in weights]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract of op13: one row per part, order of the filters and step."""
    tables = coalitions(docs, labels)
    weights = shapley_weights()
    values = F.array(*[sum((F.get("v", F.lit(s)) * w for s, w in enumerate(row) if w), F.lit(0)) for row in weights])
    alone = F.array(*[F.get("v", F.lit(ALL)) - F.get("v", F.lit(ALL ^ 1 << i)) for i in range(len(FILTERS))])
    steps = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for k, i in enumerate(order):
            steps.append((name, k + 1, i, before, before | 1 << i))
            before |= 1 << i
    plan = tables.sparkSession.createDataFrame([(steps,)], "steps array<struct<name string, step int, i int, b int, a int>>")
    # one row: a constant of 600 steps for every part
    t = (tables.withColumns({"shapley": values, "alone": alone}).withColumn("steps", plan.scalar())
         .select("*", F.explode("steps").alias("s")))

    def gained(col: str) -> Column:
        return F.get(col, F.col("s.a")) - F.get(col, F.col("s.b"))

    return t.select("part", F.col("s.name").alias("filter_order"), F.col("s.step").alias("step"),
                    (F.col("all") - F.get("v", F.col("s.a"))).alias("kept"), gained("v").alias("removed"),
                    (F.get("v", F.col("s.a") - F.col("s.b")) - gained("v")).alias("redundant"),
                    F.get("alone", F.col("s.i")).alias("unique_fails"), gained("good").alias("good_lost"),
                    gained("toxic").alias("toxic_lost"), F.get("shapley", F.col("s.i")).cast("long").alias("shapley"))


def _oracle() -> str:
    letters = " UNION ALL ".join(f"SELECT '{c}' AS f" for c in FILTERS)
    pairs = " AND ".join(f"f{i}.f <> f{j}.f" for i, j in combinations(range(len(FILTERS)), 2))
    orders = " || ".join(f"f{i}.f" for i in range(len(FILTERS)))
    return f"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
                  min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
d AS (SELECT part, CASE WHEN len(words) < {MIN_WORDS} THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[{MARKS}]') THEN 'D' ELSE '' END
             || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails,
             doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
             doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM w),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
      FROM d GROUP BY ALL),
l AS ({letters}),
o AS (SELECT {orders} AS filter_order FROM {", ".join(f"l AS f{i}" for i in range(len(FILTERS)))} WHERE {pairs}),
s AS (SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
      FROM o, range(1, {len(FILTERS) + 1}) AS r(step)),
x AS (SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS hit, fails = f AS alone,
             before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone FROM g, s),
y AS (SELECT part, filter_order, step, f, (coalesce(sum(n) FILTER (WHERE NOT gone AND NOT hit), 0))::BIGINT AS kept,
             (coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0))::BIGINT AS removed,
             (coalesce(sum(n) FILTER (WHERE hit AND gone), 0))::BIGINT AS redundant,
             (coalesce(sum(n) FILTER (WHERE alone), 0))::BIGINT AS unique_fails,
             (coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0))::BIGINT AS good_lost,
             (coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0))::BIGINT AS toxic_lost
      FROM x GROUP BY part, filter_order, step, f)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM y
"""


ORACLE = _oracle()
