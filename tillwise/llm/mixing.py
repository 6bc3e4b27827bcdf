"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the token budget in proportion to its weight.
A source whose share is above its maximum number of epochs is clamped there
and the excess goes to the others by weight, until none is above.  With the
sources ordered by cap / weight, the fill level after clamping the first k is
``(budget - caps of the k) / weights of the rest``; the level of the first
source that is not above its cap is the feasible one, so the repeated
clamping is one pass over the sources.

Documents are then repeated: the whole part of target / size is taken by all
documents of the source, the fractional part by documents in the order of a
seeded hash until the target is met (to half a document).  Only the one hash
bucket that holds the cut is ordered row by row, so a source holding a third
of all rows costs no large sort.

Null text has size 0, a null source is a source of its own (ordered last),
rows repeated in the input count each, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .common import WORD, id_text, staged

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
_PREFIX = 3  # hex digits of the order key that name a bucket: 4096 buckets


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size)`` -> also ``target``, by capped water-filling.

    Works on one row per source, which is the size of a catalogue."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    w = (sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * float(max_epochs)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    w = w.withColumn("level", (F.sum("source_size").over(every) * float(budget)
                               - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(rest))
    # the level only falls once it is feasible, so the first feasible one is the greatest
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(every)
    return w.select("source", "source_size", F.when(level.isNull(), F.col("cap")).otherwise(
        F.least("cap", level * F.col("weight"))).alias("target"))


def sized(docs: DataFrame, seed: str = SEED, extra: tuple[str, ...] = ()) -> DataFrame:
    """Per document: its size in words and the seeded order key."""
    return docs.select("doc_id", "source", *extra,
                       F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
                       F.md5(F.concat(F.lit(seed + ":"), id_text()).cast("binary")).alias("order_key"))


def mix(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
        max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Rows of :func:`sized` -> also ``source_size``, ``target``, ``repeats`` and ``taken``."""
    bucket = F.substring("order_key", 1, _PREFIX)
    per_bucket = sizes.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    goal = targets(per_bucket.groupBy("source").agg(F.sum("words").alias("source_size")),
                   weights, budget, max_epochs)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    goal = goal.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    # the bucket in which the running total of words passes what is needed
    run = Window.partitionBy("b.source").orderBy("b.bucket")
    cut = (per_bucket.alias("b").select("b.*", (F.sum("words").over(run) - F.col("words")).alias("before")).alias("b")
           .join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
           .groupBy(F.col("g.source").alias("source"), "source_size", "target", "whole", "need")
           .agg(F.max(F.when(F.col("before") < F.col("need"), F.struct("bucket", "before"))).alias("cut"))
           .select(F.col("source").alias("s"), "source_size", "target", "whole", "need",
                   F.col("cut.bucket").alias("cut"), F.col("cut.before").alias("before")))
    cut = broadcast_if_small(staged(cut, "mix-cuts"), max_rows=100_000)
    d = (sizes.join(cut, sizes["source"].eqNullSafe(cut["s"])).drop("s")
         .withColumn("bucket", bucket))
    plain = d.where(F.coalesce(F.col("bucket") != F.col("cut"), F.lit(True)))
    plain = plain.withColumn("extra", F.coalesce((F.col("bucket") < F.col("cut")).cast("long"), F.lit(0)))
    edge = d.where(F.col("bucket") == F.col("cut"))
    order = Window.partitionBy("source").orderBy("order_key", "doc_id", "size")
    edge = edge.withColumn("extra", (F.col("before") + F.sum("size").over(
        order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2 <= F.col("need")).cast("long"))
    return (plain.unionByName(edge)
            .withColumn("repeats", F.col("whole") + F.col("extra"))
            .withColumn("taken", F.col("size") * F.col("repeats"))
            .drop("order_key", "bucket", "cut", "before", "need", "whole", "extra"))


def mix_documents(docs: DataFrame, **kw) -> DataFrame:
    """The contract of op6: one row per document with what the mix takes."""
    return mix(staged(sized(docs), "mix-sizes"), **kw).select(
        "doc_id", "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (rows it leaves out go)."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # so that no column clashes
    fixed = {"doc_id", "source", "text"}
    given = docs.toDF(*[c if c in fixed else n for n, c in zip(names, docs.columns)])
    rest = [c for c in given.columns if c not in ("doc_id", "source")]
    taken = mix(sized(given, extra=tuple(rest)), **kw)
    rows = taken.where("repeats > 0").withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("repeats").cast("int"))))
    return rows.select(*given.columns).toDF(*docs.columns)


ORACLE = """
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS order_key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM d GROUP BY source),
f AS (SELECT a.*, (1.5 * (SELECT sum(source_size) FROM s)::DOUBLE
        - coalesce((SELECT sum(2.0 * b.source_size)::DOUBLE FROM s b
             WHERE b.source_size / b.weight < a.source_size / a.weight), 0))
        / (SELECT sum(b.weight) FROM s b WHERE b.source_size / b.weight >= a.source_size / a.weight) AS level
      FROM s a),
t AS (SELECT source, source_size, least(2.0 * source_size, weight * (
        SELECT max(level) FROM f WHERE level <= 2.0 * source_size / weight))::DOUBLE AS target FROM f),
e AS (SELECT source, source_size, target,
             coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM t),
r AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.whole,
             e.target - e.whole * e.source_size AS need,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY order_key, doc_id, size
                               ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN need > 0 AND upto - size / 2.0 <= need THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
