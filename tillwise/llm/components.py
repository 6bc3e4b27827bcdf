"""Connected components of links between ids, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """Links ``a, b`` -> ``id, component`` (smallest id reachable) of every linked id.

    Alternating large-star and small-star steps: every id is tied to the
    smallest of its neighbours until nothing changes, in a logarithmic number
    of rounds.  Minima are partial aggregates and come back by a join, so an
    id with very many links is never gathered.  Each round is written out."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u != v").distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = staged(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).distinct())
        edges = staged(small, "small-star")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
