"""Quality classifier: random Fourier features of document statistics, ridge
scores from summed normal equations, isotonic calibration.

1. Every whole text becomes a fixed vector of statistics (lengths, character
   classes, repetition of words, word pairs and lines).  Ids, languages,
   sources and labels are never part of it.
2. Labelled rows train: ``z = sqrt(2/D) cos(Wx + b)`` with seeded normal W
   approximates a Gaussian kernel; each partition sums ``z z'`` and ``z y``
   and the ridge weights solve the summed system.
3. Rows kept out of the fit calibrate: their scores, averaged in bins, go
   through pool-adjacent-violators; the step function maps a ridge score to
   the share of label 1.

Bounds: at most ``max_rows`` labelled rows train (a hash threshold picks
them, evenly over the table); the system has D x D entries and comes from
at most ``_FIT_PARTITIONS`` partitions whatever the input.

Null or empty text has zero statistics and gets the score of such texts.  A
null id is the id ''.  Labels that are null are ignored; repeated rows, of labels
or of an id with one text, train once and are scored each.  Without labelled rows
every score is 0.5.  Texts are read whole, however long.  Other columns, of
whatever name, are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_text, rows_of, staged, text_bytes

MAX_ROWS = 100_000  # labelled rows that train, at most
DIMENSIONS = 384
RIDGE = 1e-3
THRESHOLD = 0.3
_FIT_PARTITIONS = 12
_BINS = 400

_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_SYMBOLS = list(b"#$%&*@^~")
_OTHER = list(b"\"'()-/:;<=>[\\]_`{}+")
N_STATS = 25


def statistics(text: bytes) -> np.ndarray:
    """The statistics of one UTF-8 text as float32[N_STATS]."""
    out = np.zeros(N_STATS, np.float32)
    words = text.split()
    if not words:
        return out
    raw = np.frombuffer(text, np.uint8)
    hist = np.bincount(raw, minlength=256)
    size, n = len(raw), len(words)
    lens = np.fromiter(map(len, words), np.int32, n)
    upper, lower = int(hist[_UPPER].sum()), int(hist[_LOWER].sum())
    p = hist[hist > 0] / size
    lines = text.split(b"\n")
    pairs = n - 1
    out[:] = (
        np.log1p(size), np.log1p(n), np.log(lens.mean()), lens.std() / 5, np.log(lens.max()),
        upper / max(1, upper + lower), hist[_DIGIT].sum() / size, (size - lens.sum()) / size,
        hist[46] / n, hist[44] / n, (hist[33] + hist[63]) / n, hist[124] / n,
        hist[_SYMBOLS].sum() / n, hist[_OTHER].sum() / n, hist[128:].sum() / size,
        -(p * np.log2(p)).sum(), len(set(words)) / n,
        sum(map(eq, words, words[1:])) / max(1, pairs), sum(map(eq, words, words[2:])) / max(1, n - 2),
        len(set(zip(words, words[1:]))) / max(1, pairs), len(set(lines)) / len(lines),
        np.log1p(size / len(lines)), (lens <= 3).mean(), (lens >= 12).mean(),
        np.log1p(n / len(set(words))))
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, id_text, held_out, stats`` (float32 bytes) of every document."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = [statistics(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(stats, pa.binary())],
                                             names=["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text_bytes().alias("text"))
            .mapInArrow(per_batch, f"doc_id {kind}, stats binary")
            .select("doc_id", "stats", held_out().alias("held_out")))


def matrix(stats) -> np.ndarray:
    return np.frombuffer(b"".join(stats), np.float32).reshape(-1, N_STATS).astype(np.float64)


@dataclass
class KernelRidge:
    """A fitted scorer: all arrays are of fixed size."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None  # isotonic: ridge scores ...
    levels: np.ndarray | None = None  # ... and the share of label 1 there

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(x):
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0.0, 1.0)


def pool_adjacent_violators(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``value`` in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def targets_of(labels: DataFrame, target: str) -> DataFrame:
    """``id_text, y`` of the labelled ids, each once."""
    return (labels.select(id_text().alias("id_text"), F.col(target).cast("int").alias("y"))
            .where(F.col("y").isNotNull()).distinct())


def labelled(stats: DataFrame, labels: DataFrame, target: str, max_rows: int, seed: str) -> DataFrame:
    """Training rows ``stats, y, fold`` (fold 0 of 5 calibrates), at most about ``max_rows``.

    The threshold is on a hash of id and statistics, so of an id that many rows
    repeat a share is taken, and below the join.  Repeated rows train once."""
    y = targets_of(labels, target)
    rows = stats.where(~F.col("held_out")).select(id_text().alias("id_text"), "stats")
    n = rows.join(y, "id_text").count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(seed), "id_text", "stats"), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    return rows.distinct().join(y, "id_text").select(
        "stats", "y", F.pmod(F.shiftright(F.xxhash64(F.lit(seed), "id_text"), 32), F.lit(5)).alias("fold"))


def fit(train: DataFrame, dimensions: int = DIMENSIONS, ridge: float = RIDGE, seed: int = 7) -> KernelRidge:
    """Fit on rows of :func:`labelled` (a bounded table)."""
    train = train.repartition(_FIT_PARTITIONS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, N_STATS))
        for b in batches:
            x = matrix(b.column("stats").to_pylist())
            total += np.stack([np.full(N_STATS, len(x)), x.sum(0), (x ** 2).sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    m = sum(np.frombuffer(r.m).reshape(3, N_STATS) for r in train.mapInArrow(moments, "m binary").collect())
    rng = np.random.default_rng(seed)
    n = m[0, 0]
    mean = m[1] / max(n, 1)
    scale = np.sqrt(np.maximum(m[2] / max(n, 1) - mean ** 2, 1e-4))
    width = np.sqrt(N_STATS)
    model = KernelRidge(mean, scale, rng.normal(0, 1 / width, (N_STATS, dimensions)),
                        rng.uniform(0, 2 * np.pi, dimensions))
    if not n:
        return model

    def normal_equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((dimensions + 1, dimensions + 2))
        for b in batches:
            keep = b.column("fold").to_numpy(zero_copy_only=False) != 0
            x = matrix(b.column("stats").to_pylist())[keep]
            y = b.column("y").to_numpy(zero_copy_only=False)[keep]
            z = np.hstack([model.features(x), np.ones((len(x), 1))])
            a += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary())], names=["a"])

    a = sum(np.frombuffer(r.a).reshape(dimensions + 1, -1)
            for r in train.mapInArrow(normal_equations, "a binary").collect())
    rows = a[-1, -2]
    model.weights = np.linalg.solve(a[:, :-1] + (ridge * rows + 1e-9) * np.eye(dimensions + 1) / dimensions, a[:, -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 3, _BINS))  # calibration rows, fitted rows: count, label sum, score sum
        for b in batches:
            raw = model.raw(matrix(b.column("stats").to_pylist()))
            y = b.column("y").to_numpy(zero_copy_only=False)
            fold = b.column("fold").to_numpy(zero_copy_only=False)
            at = np.clip(((raw + 0.5) / 2 * _BINS).astype(int), 0, _BINS - 1)
            for k, keep in enumerate((fold == 0, fold != 0)):
                total[k] += [np.bincount(at[keep], w, _BINS) for w in (np.ones(keep.sum()), y[keep], raw[keep])]
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["t"])

    t = sum(np.frombuffer(r.t).reshape(2, 3, _BINS) for r in train.mapInArrow(binned, "t binary").collect())
    t = t[0] if t[0, 0].sum() else t[1]  # no row in the calibration fold: use the others
    seen = t[0] > 0
    model.knots = t[2][seen] / t[0][seen]
    model.levels = pool_adjacent_violators(t[1][seen] / t[0][seen], t[0][seen])
    return model


def training_documents(docs: DataFrame, labels: DataFrame, target: str, max_rows: int, seed: str) -> DataFrame:
    """``doc_id, text`` of the documents that may train, at most about ``max_rows`` labelled ones.

    The ids alone tell how many are labelled.  If more than ``max_rows``, a hash
    of id and text picks; if not, their ids (as few) are broadcast to the texts."""
    rows = docs.select("doc_id", "text").where(~held_out())
    ids = rows.select(id_text().alias("id_text"))
    y = targets_of(labels, target)
    n = ids.join(y, "id_text").count()
    if n > max_rows:
        picked = F.pmod(F.xxhash64(F.lit(seed), id_text(), "text"), F.lit(1 << 30)) < int((1 << 30) * max_rows / n)
        return rows.where(picked)
    known = y.select("id_text").distinct().join(ids, "id_text", "left_semi")
    return rows.join(F.broadcast(known), id_text() == known["id_text"], "left_semi")


def kept_documents(docs: DataFrame, labels: DataFrame, target: str = "quality",
                   threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    stats = staged(with_statistics(training_documents(docs, labels, target, max_rows, "quality-text")), "stats")
    model = fit(staged(labelled(stats, labels, target, max_rows, "quality"), "quality-train"))
    names = [f"c{i}" for i in range(len(docs.columns))]  # so that no column clashes
    given = docs.toDF(*names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, 8 << 20, "bytes"):
            score = model.score(np.stack([statistics(t) for t in b.column("bytes").to_pylist()]).astype(np.float64))
            yield b.drop_columns(["bytes"]).filter(pa.array(score >= threshold))

    return (given.withColumn("bytes", text_bytes(names[docs.columns.index("text")]))
            .mapInArrow(per_batch, schema).toDF(*docs.columns))


def score_documents(docs: DataFrame, labels: DataFrame, target: str = "quality",
                    threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """The contract of op3: ``doc_id, held_out, score, predicted`` of every document."""
    stats = staged(with_statistics(docs), "stats")
    model = fit(staged(labelled(stats, labels, target, max_rows, "quality"), "quality-train"))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(matrix(b.column("stats").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score)],
                                             names=["doc_id", "held_out", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return (stats.select("doc_id", "held_out", "stats")
            .mapInArrow(per_batch, f"doc_id {kind}, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
