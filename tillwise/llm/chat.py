"""Chat formatting: cumulative-snapshot collapse, then rendering (all native).

Logs often hold a conversation several times, each time with more turns.  A
rolling hash of every turn prefix (the running XOR of two 64-bit hashes of
position, role and text) names each prefix.  Conversations with equal turns
collapse to the smallest id; then an anti-join drops every conversation whose
whole hash is a proper prefix of a longer one.  What remains is maximal and
is rendered as one text.

The running XOR is a window that streams over one conversation's turns;
prefixes are made distinct before the anti-join, so a first turn that a third
of all conversations share is one row there.

Turns are ordered by turn, role, text (nulls first).  A null role renders as
``unknown``, null text as empty; nulls are equal to each other and differ
from empty strings in the hash.  Rows with a null conversation id form one
conversation.  Repeated rows are repeated turns.  Texts are hashed and rendered
whole, however long.  Other columns, of whatever name, are ignored.  An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|", "|>"


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, n, h1, h2``: the rolling hash after each of the first n turns."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("n"))
    content = [F.col("n"), F.col("role").isNull(), F.coalesce("role", F.lit("")),
               F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    hashed = rows.select("conv_id", "n", F.xxhash64(*content).alias("x1"),
                         F.xxhash64(F.lit("second"), *content).alias("x2"))
    run = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return hashed.select("conv_id", "n", F.bit_xor("x1").over(run).alias("h1"), F.bit_xor("x2").over(run).alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations that no longer one continues."""
    p = prefixes(turns)
    ends = Window.partitionBy("conv_id")
    p = p.withColumn("last", F.max("n").over(ends))
    whole = (p.where("n = last").groupBy("n", "h1", "h2")
             .agg(F.min(F.struct("conv_id")).getField("conv_id").alias("conv_id"), F.count("*").alias("n_copies")))
    proper = p.where("n < last").select("n", "h1", "h2").distinct()
    return (whole.join(proper, ["n", "h1", "h2"], "left_anti")
            .select("conv_id", F.col("n").cast("long").alias("n_turns"), "n_copies"))


def rendered(turns: DataFrame) -> DataFrame:
    """The contract of op4: ``conv_id, n_turns, n_copies, chat`` of maximal conversations."""
    keep = maximal(turns).withColumnRenamed("conv_id", "kept_id")
    rows = turns.select("conv_id", "turn", "role", "text").join(keep, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    one = F.transform(F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("t0"), "turn", F.col("role").isNotNull().alias("r0"), "role",
        F.col("text").isNotNull().alias("x0"), "text"))), lambda t: F.concat(
            F.lit(BEGIN), F.coalesce(t["role"], F.lit("unknown")), F.lit(END + "\n"),
            F.coalesce(t["text"], F.lit("")), F.lit("\n")))
    return rows.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_join(one, "").alias("chat"))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n,
         md5(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n')) AS h,
         '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS line
  FROM conversations),
p AS (SELECT conv_id, n, max(n) OVER (PARTITION BY conv_id) AS last,
             md5(string_agg(h, ',') OVER (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING)) AS h
      FROM t),
w AS (SELECT n, h, CASE WHEN bool_or(conv_id IS NULL) THEN NULL ELSE min(conv_id) END AS conv_id, count(*) AS n_copies FROM p WHERE n = last GROUP BY n, h),
k AS (SELECT w.* FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n < p.last AND p.n = w.n AND p.h = w.h))
SELECT k.conv_id, k.n::BIGINT AS n_turns, k.n_copies, string_agg(t.line, '' ORDER BY t.n) AS chat
FROM k JOIN t ON t.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY ALL
"""
