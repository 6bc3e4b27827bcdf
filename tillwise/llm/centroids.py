"""Centroid clustering: exact Lloyd rounds whose nearest centroid comes from a
tournament of bisector tests.

For every pair of centroids a < b the integer normal ``2 (b - a)`` and the
threshold ``|b|^2 - |a|^2`` are computed once per round: a vector x is nearer
to b exactly if ``x . normal > threshold``.  Centroid 0 starts as champion and
meets 1, 2, ..., k-1; each test is one linear sign test, and zero (a tie)
favours the champion, which has the smaller number.  After k-1 tests the
champion is the nearest centroid, ties to the smaller number; its squared
distance is then computed exactly.

Components are integers ``floor(256 x)``.  Tests, distances and sums run in
doubles where a bound on their size proves every intermediate result exact
(below 2^53), in Python integers otherwise, so results never depend on
rounding, order or partitioning.  Sums leave a task as 32-bit limbs, which
Spark adds; the driver sees at most k x (dimensions + 1) sums a round and
forms the new centroids as ``floor(sum / count)``.  An empty cluster keeps its
centroid.

Each round is one pass over the vectors without a shuffle of them.  Nothing
but the k centroids reaches the driver or is sent with the tasks.

Vectors that are null, of another length, or hold null, NaN or infinite
components take no part.  Repeated rows (and ids) are vectors of their own;
where ids with equal hashes compete to be starting centroids, the smaller
components go first.  A null id counts as the empty text in the hash and is
returned as null.  With fewer than k vectors there are as many centroids as
vectors.  A distance or inertia beyond 64 bits is null.  Other columns, of
whatever name, are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

K = 40
ROUNDS = 5
DIMENSIONS = 64
SALT = "2:"
_EXACT = 1 << 53  # doubles hold every integer up to here
_SLICE = 2048  # vectors tested at a time
_LIMB = 32
_LONG = (1 << 63) - 1


def vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id, x`` (array of doubles) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    return (embeddings.select("vec_id", x.alias("x"))
            .where((F.size("x") == dimensions)
                   & F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))))


def grid(x: np.ndarray) -> np.ndarray:
    """``floor(256 x)``: doubles if all are below 2^53, else Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(256 * x)
    if not scaled.size or np.abs(scaled).max() < _EXACT:
        return scaled
    whole = [int(s) if np.isfinite(s) else int(v) * 256 for s, v in zip(scaled.ravel(), x.ravel())]
    return np.array(whole, object).reshape(x.shape)


def _most(a: np.ndarray) -> int:
    return int(np.abs(a).max()) if a.size else 0


class Bisectors:
    """The normals and thresholds of all pairs of ``centroids`` (rows of integers)."""

    def __init__(self, centroids: list[tuple[int, ...]]):
        self.centroids = np.array(centroids, object).reshape(len(centroids), -1)
        c = self.centroids
        norm = (c * c).sum(1)
        # [challenger, champion]: only champions of smaller number are met
        self.normals = [2 * (c[j] - c[:j]) for j in range(len(c))]
        self.thresholds = [norm[j] - norm[:j] for j in range(len(c))]
        self.largest = max([_most(n) for n in self.normals[1:]], default=0)
        if max([self.largest, _most(c), *(_most(t) for t in self.thresholds[1:])]) < _EXACT:
            self.fast = ([n.astype(float) for n in self.normals], [t.astype(float) for t in self.thresholds], c.astype(float))
        else:
            self.fast = None

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row of ``x``, by k-1 sign tests."""
        exact = self.fast is None or x.dtype == object or x.shape[1] * _most(x) * self.largest >= _EXACT
        if exact:
            x = x if x.dtype == object else _integers(x)
        normals, thresholds = (self.normals, self.thresholds) if exact else self.fast[:2]
        champion = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            n = normals[j][champion]
            side = (x * n).sum(1) if exact else np.einsum("nd,nd->n", x, n)
            champion[(side > thresholds[j][champion]).astype(bool)] = j
        return champion

    def distances(self, x: np.ndarray, cluster: np.ndarray) -> list[int]:
        """Squared distance of each row to its centroid, as Python integers."""
        if self.fast is None or x.dtype == object or x.shape[1] * (_most(x) + _most(self.centroids)) ** 2 >= _EXACT:
            gap = (x if x.dtype == object else _integers(x)) - self.centroids[cluster]
            return (gap * gap).sum(1).tolist()
        gap = x - self.fast[2][cluster]
        return np.einsum("nd,nd->n", gap, gap).astype(np.int64).tolist()


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            b = batch.slice(at, _SLICE)
            x = np.asarray(b.column("x").flatten()).reshape(b.num_rows, -1)
            yield b, grid(x)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """``(place, limb)`` with value = sum of limb * 2^(32 place); the last limb has the sign."""
    place = 0
    while not -(1 << (_LIMB - 1)) <= value < 1 << (_LIMB - 1):
        yield place, value & ((1 << _LIMB) - 1)
        value >>= _LIMB
        place += 1
    yield place, value


def sums(kept: DataFrame, centroids: list[tuple[int, ...]]) -> dict[int, list[int]]:
    """Per cluster that has vectors: the exact sum of each component, then the count."""
    tests, width = Bisectors(centroids), len(centroids[0]) + 1

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), width), object)
        for _, x in _slices(batches):
            cluster = tests.nearest(x)
            one = np.zeros((len(centroids), len(x)))
            one[cluster, np.arange(len(x))] = 1
            if x.dtype != object and len(x) * _most(x) < _EXACT:
                part = _integers(one @ np.hstack([x, np.ones((len(x), 1))]))
            else:
                part = _integers(one) @ np.hstack([x if x.dtype == object else _integers(x), _integers(np.ones((len(x), 1)))])
            total = total + part
        rows = [(c, d, place, limb) for c in range(len(centroids)) if total[c, -1] for d in range(width)
                for place, limb in _limbs(int(total[c, d]))]
        yield pa.RecordBatch.from_arrays([pa.array(list(col), kind) for col, kind in zip(
            list(zip(*rows)) or [()] * 4, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            names=["cluster", "dimension", "place", "limb"])

    parts = kept.select("x").mapInArrow(per_task, "cluster int, dimension int, place int, limb long")
    out: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "dimension", "place").agg(F.sum("limb").alias("limb")).collect():
        out.setdefault(r.cluster, [0] * width)[r.dimension] += r.limb << (_LIMB * r.place)
    return out


def start(kept: DataFrame, k: int = K, salt: str = SALT) -> list[tuple[int, ...]]:
    """The k vectors with the least sha256 of salt and id, in that order."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = kept.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return [tuple(int(v) for v in grid(np.array([r.x]))[0]) for r in first]


def fit(kept: DataFrame, k: int = K, rounds: int = ROUNDS, salt: str = SALT) -> list[tuple[int, ...]]:
    """The centroids after ``rounds`` rounds, as integer tuples."""
    centroids = start(kept, k, salt)
    for _ in range(rounds if centroids else 0):
        for c, total in sums(kept, centroids).items():
            centroids[c] = tuple(s // total[-1] for s in total[:-1])
    return centroids


def assigned(kept: DataFrame, centroids: list[tuple[int, ...]]) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector (no row without centroids)."""
    kind = kept.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long"
    if not centroids:
        return kept.sparkSession.createDataFrame([], schema)
    tests = Bisectors(centroids)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _slices(batches):
            cluster = tests.nearest(x)
            far = [d if d <= _LONG else None for d in tests.distances(x, cluster)]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(far, pa.int64())],
                names=["vec_id", "cluster", "distance"])

    return kept.select("vec_id", "x").mapInArrow(per_task, schema)


def cluster_vectors(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
                    salt: str = SALT) -> DataFrame:
    """The contract of op11: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    kept = staged(vectors(embeddings, dimensions), "vectors")
    centroids = fit(kept, k, rounds, salt)
    found = staged(assigned(kept, centroids), "assigned")
    # one row per cluster: the sum, unless a distance is beyond 64 bits
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"),
                                       F.count("*").alias("n"), F.count("distance").alias("known")).collect()
    inertia = {r.cluster: int(r.d or 0) if r.known == r.n and (r.d or 0) <= _LONG else None for r in per}
    whole = sum(inertia.values()) if None not in inertia.values() else _LONG + 1
    rows = [(c, inertia[c], whole if whole <= _LONG else None,
             hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in sorted(inertia)]
    about = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # at most k rows
    return (found.join(F.broadcast(about), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _oracle(k: int, rounds: int, dimensions: int, salt: str) -> str:
    nearest = """a{r} AS (SELECT id, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (
  SELECT v.id, c{r}.c, list_sum(list_transform(list_zip(v.x, c{r}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
  FROM v, c{r}) GROUP BY id)"""
    update = """m{r} AS (SELECT cluster AS c, i, sum(x[i]) AS s, count(*) AS n FROM a{r} JOIN v USING (id), range(1, {w}) AS g(i) GROUP BY ALL),
n{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM m{r} GROUP BY c),
c{q} AS (SELECT c, coalesce(n{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN n{r} USING (c))"""
    steps = []
    for r in range(rounds):
        steps += [nearest.format(r=r), update.format(r=r, q=r + 1, w=dimensions + 1)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dimensions}),
c0 AS (SELECT (row_number() OVER (ORDER BY h, x) - 1)::INT AS c, x FROM (
  SELECT x, sha256('{salt}' || coalesce(vec_id::VARCHAR, '')) AS h FROM v) ORDER BY h, x LIMIT {k}),
{", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) if s[0] == "a" else s for s in steps)},
{nearest.format(r=rounds).replace(" AS (", " AS MATERIALIZED (", 1)}
SELECT vec_id, cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (id) JOIN c{rounds} ON c = cluster
"""


ORACLE = _oracle(K, ROUNDS, DIMENSIONS, SALT)
