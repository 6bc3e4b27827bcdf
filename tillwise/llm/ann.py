"""Approximate nearest neighbours by a permutation index (inner product).

A bounded seeded sample of the vectors are pivots.  A vector is represented
by its ``POSTED`` nearest pivots in order.  Vectors are dealt to blocks, and
a block is a pivot inverted file: each pivot's list says at which place every
vector of the block has it (POSTED where it is not among the nearest).  A
query walks the lists of its own ``WALKED`` nearest pivots and adds up the
footrule distance, the differences of places.  The best ``KEEP`` share of a
block (at least ``LEAST``), with all ties at the limit, is reranked by the
exact inner product in double precision; the best of all blocks are the
answer.

Scale: block count follows the number of vectors, queries are dealt to every
block in groups of bounded size, so a task holds one block of vectors and
one group of queries.  A vector that a third of all rows repeat spreads over
all blocks.

Vectors that are null, empty, zero, of another dimension than the pivots, or
hold null or non-finite components take no part, as queries or candidates.
Rows that repeat an id are candidates each (never for a query of their own
id); where the rows of a query's id differ, the query is the vector whose bytes
are smallest.  Ties go to the smaller id.  With fewer candidates than asked for,
all are returned.  Other columns, of whatever name, are ignored.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

PIVOTS = 256  # sampled vectors, at most; places fit a byte
POSTED = 128  # pivots of a vector that are posted
WALKED = 64  # pivots of a query whose lists are read
KEEP, LEAST = 0.15, 400  # share of a block, and number, that is reranked
BLOCK, QUERIES = 8192, 1024


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, vector`` (float64 bytes) of the rows that take part."""
    kind = vectors.schema[vec_id].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column("v").to_pylist():
                x = np.array(v if v is not None else [], np.float64)  # a null component is NaN
                out.append(x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
            rows = pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "vector"])
            yield rows.filter(rows.column("vector").is_valid())

    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull()).mapInArrow(per_batch, f"vec_id {kind}, vector binary"))


def sample_pivots(vectors: DataFrame, n: int = PIVOTS, seed: str = "pivots") -> np.ndarray:
    """At most ``n`` distinct vectors of the commonest dimension in a seeded hash order."""
    rows = (vectors.groupBy("vector").agg(F.min("vec_id").alias("vec_id"))
            .orderBy(F.xxhash64(F.lit(seed), "vector"), "vector").limit(n).collect())
    if not rows:
        return np.zeros((0, 0))
    size = pd.Series([len(r.vector) for r in rows]).mode().iloc[0]
    p = np.stack([np.frombuffer(r.vector) for r in rows if len(r.vector) == size])
    return p / np.linalg.norm(p, axis=1, keepdims=True)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivots of each row of ``x``, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")


def inverted_file(order: np.ndarray, posted: int) -> np.ndarray:
    """One list per pivot: its place in every vector's order (``posted`` beyond that)."""
    lists = np.empty(order.shape[::-1], np.uint8)
    lists[order.T, np.arange(len(order))] = np.minimum(np.arange(order.shape[1]), posted)[:, None]
    return lists


def footrule(query: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """Footrule distance of a query's leading pivots to every vector of a block."""
    theirs, mine = lists[query], np.arange(len(query), dtype=np.uint8)[:, None]
    return (np.maximum(theirs, mine) - np.minimum(theirs, mine)).sum(axis=0, dtype=np.uint16)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, pivots: int = PIVOTS, posted: int = POSTED,
           walked: int = WALKED, keep: float = KEEP, least: int = LEAST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query.

    ``vectors`` and ``queries`` are written tables of :func:`usable`."""
    pivot = sample_pivots(vectors, pivots)
    posted, walked = min(posted, 255), min(walked, 255, len(pivot))
    n, n_queries = vectors.count(), queries.count()
    blocks, groups = max(1, -(-n // BLOCK)), max(1, -(-n_queries // QUERIES))
    dim = 8 * pivot.shape[1]
    vectors, queries = (d.where(F.length("vector") == dim) for d in (vectors, queries))
    q = queries.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).alias("group"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    v = vectors.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"))
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def one_block(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(own) and len(rows):
            rows = rows.sort_values("vec_id", kind="stable")
            ids, x = rows["vec_id"].to_numpy(), np.frombuffer(b"".join(rows["vector"])).reshape(len(rows), -1)
            mine, y = own["vec_id"].to_numpy(), np.frombuffer(b"".join(own["vector"])).reshape(len(own), -1)
            lists = inverted_file(nearest_pivots(x, pivot), posted)
            limit = max(least, 2 * k + 1, int(np.ceil(keep * len(x)))) - 1
            for i, perm in enumerate(nearest_pivots(y, pivot)[:, :walked]):
                far = footrule(perm, lists)
                near = np.arange(len(x)) if limit >= len(x) - 1 else np.flatnonzero(far <= np.partition(far, limit)[limit])
                near = near[ids[near] != mine[i]]
                score = (x[near] * y[i]).sum(axis=1)
                best = np.lexsort((ids[near], -score))[:k]
                out += [(mine[i], ids[near[j]], score[j]) for j in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = (q.groupBy("block", "group").cogroup(v.groupBy("block", "group"))
             .applyInPandas(one_block, f"query_id {kind}, vec_id {kind}, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(embeddings: DataFrame, k: int = 20) -> DataFrame:
    """The contract of op5: queries are the rows whose id is divisible by 20."""
    vectors = staged(usable(embeddings), "vectors")
    queries = vectors.where(F.col("vec_id") % 20 == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return search(vectors, queries, k)
