"""Toxicity: subword-bag embeddings and a linear softmax, trained jointly.

A word is the bag of its byte n-grams (3 to 6 bytes, with the white space
around it as word marks), each n-gram one of ``BUCKETS`` rows of an
embedding table.  A passage of ``SPAN`` words is the average of its n-gram
embeddings, and a linear softmax scores it; a document scores as its most
toxic passage, since a few words make a document toxic.  Embeddings and
softmax learn together in numpy: first from whole-document averages, then
from the highest passage of every document, so that harmless passages of
toxic documents stop counting.  A misspelt word shares most n-grams with
what was seen.  A logistic fit on rows kept out of the training turns the
highest passage's logit into a probability at the true share of toxic rows.

Bounds: at most about ``MAX_TOXIC`` + ``MAX_CLEAN`` labelled documents train,
and ``MAX_BYTES`` of text of each kind.  Ids are taken by a hash threshold from
the whole label table, then their texts by a hash of id and text, so an id that
a third of all rows repeat brings no more than its share.  Texts over
``MAX_TEXT`` bytes do not train.  The model has a fixed size.  Every text is
scored whole, however long, in one pass without a shuffle.

Null or empty text scores as a passage without n-grams.  Null labels are
ignored; repeated rows, of labels or of an id with one text, train once and are
scored each.  Without labels of both kinds every score is the share of toxic
labels (0 without any).  Other columns, of whatever name, are ignored.  An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_bytes, held_out, id_text, rows_of, staged, text_bytes

MAX_TOXIC, MAX_CLEAN = 1_500, 2_500  # training documents, at most about
MAX_BYTES, MAX_TEXT = 64 << 20, 4 << 20  # of the training texts of a kind, and of one of them
BUCKETS = 1 << 18
DIM = 8
SPAN = 6
SIZES = (3, 4, 5, 6)
THRESHOLD = 0.5

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32  # A-Z as a-z
_FOLD[9:14] = 32  # one kind of white space


def grams(flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the bucket of the n-gram that starts at each byte, and
    where there is one (no white space inside it)."""
    space = flat == 32
    n_bytes = len(flat)
    h = np.zeros(n_bytes, np.uint32)
    inner = np.zeros(n_bytes, bool)  # white space strictly inside
    x = flat.astype(np.uint32)
    for n in range(1, max(SIZES) + 1):
        m = n_bytes - n + 1
        if m <= 0:
            return
        h = h[:m] * np.uint32(0x01000193) + x[n - 1:] + np.uint32(1)
        if n >= 3:
            inner = inner[:m] | space[n - 2:n - 2 + m]
        else:
            inner = inner[:m]
        if n in SIZES:
            g = h ^ (h >> np.uint32(15))
            g *= np.uint32(0x2C1B3C6D)
            g ^= g >> np.uint32(13)
            yield g & np.uint32(BUCKETS - 1), ~inner


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of all texts with a space before and after each, and the
    place of each text (its leading space)."""
    flat, at = flat_bytes(texts)
    out = np.full(len(flat) + len(texts) + 1, 32, np.uint8)
    starts = at[:-1] + np.arange(len(texts))
    if len(flat):
        out[np.arange(len(flat)) + np.repeat(np.arange(len(texts)), np.diff(at)) + 1] = _FOLD[flat]
    return out, np.append(starts, len(out) - 1)


def passages(flat: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte, text) of every run of SPAN words (or of all
    words of a shorter text), with the space before and after it."""
    space = flat == 32
    starts = np.flatnonzero(space[:-1] & ~space[1:])  # the space before each word
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 2
    owner = np.searchsorted(texts, starts, "right") - 1
    if not len(starts):
        return starts, ends, owner
    i = np.arange(len(starts))
    last_word = np.searchsorted(owner, owner, "right") - 1  # of the same text
    first_word = np.searchsorted(owner, owner, "left")
    keep = (i + SPAN - 1 <= last_word) | (i == first_word)
    return starts[keep], ends[np.minimum(i + SPAN - 1, last_word)[keep]], owner[keep]


@dataclass
class Subwords:
    """Embedding table, softmax weights, and the logistic map of the logit."""

    emb: np.ndarray  # BUCKETS x DIM
    soft: np.ndarray  # DIM x 2
    bias: np.ndarray  # 2
    slope: float = 1.0
    shift: float = 0.0

    def weights(self) -> np.ndarray:
        """The softmax is linear, so each n-gram has one logit difference."""
        return (self.emb @ (self.soft[:, 1] - self.soft[:, 0])).astype(np.float32)

    def passage_logits(self, flat, begin, end, table) -> np.ndarray:
        total = np.zeros(len(flat) + 1)
        count = np.zeros(len(flat) + 1, np.int64)
        value, number = np.zeros(len(flat), np.float32), np.zeros(len(flat), np.int8)
        for g, ok in grams(flat):
            value[:len(g)] += table[g] * ok
            number[:len(g)] += ok
        np.cumsum(value, dtype=np.float64, out=total[1:])
        np.cumsum(number, out=count[1:])
        # an n-gram belongs to the passage in which it starts; the last ones end at its closing space
        stop = np.minimum(end - 1, len(flat))
        return (total[stop] - total[begin]) / np.maximum(count[stop] - count[begin], 1) + self.bias[1] - self.bias[0]

    def highest(self, texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The logit of each text's highest passage; the folded bytes and that passage's place."""
        flat, at = spaced(texts)
        begin, end, owner = passages(flat, at)
        best = np.full(len(texts), float(self.bias[1] - self.bias[0]))
        place = np.zeros((len(texts), 2), np.int64)
        if len(begin):
            z = self.passage_logits(flat, begin, end, table)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            top = np.maximum.reduceat(z, first)
            who = owner[first]
            best[who] = top
            is_top = np.flatnonzero(z == np.repeat(top, np.diff(np.r_[first, len(z)])))
            k = is_top[np.unique(owner[is_top], return_index=True)[1]]
            place[who] = np.stack([begin[k], end[k]], 1)
        return best, flat, place, at

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -40, 40)))


def train(texts: list[bytes], y: np.ndarray, epochs: int = 10, steps: int = 200, batch: int = 256,
          rate: float = 0.25, seed: int = 11) -> Subwords:
    """Joint training by Adagrad on softmax cross-entropy, classes weighted evenly.

    At least ``epochs`` passes and ``steps`` updates; the first third of the
    passes learns from whole documents."""
    batch = min(batch, max(32, len(texts) // 10))
    epochs = max(epochs, -(-steps // max(1, len(texts) // batch)))
    whole_epochs = epochs // 3
    rng = np.random.default_rng(seed)
    model = Subwords(rng.uniform(-0.5, 0.5, (BUCKETS, DIM)).astype(np.float32) / DIM,
                     rng.uniform(-0.5, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32))
    sums = [np.full(p.shape, 1e-6, np.float32) for p in (model.emb, model.soft, model.bias)]
    class_weight = len(y) / (2 * np.maximum(np.bincount(y, minlength=2), 1))
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
            arr = pa.array([texts[i] for i in part], pa.binary())
            if epoch < whole_epochs:
                flat, at = spaced(arr)
                place = np.stack([at[:-1], at[1:] + 1], 1)
            else:
                _, flat, place, at = model.highest(arr, model.weights())
            # bag of every chosen passage: (document, bucket) pairs
            chosen = np.full(len(flat), -1, np.int32)
            for d, (b, e) in enumerate(place):
                chosen[b:max(b, e - 1)] = d
            docs, ids = [], []
            for g, ok in grams(flat):
                use = np.flatnonzero(ok & (chosen[:len(g)] >= 0))
                docs.append(chosen[use])
                ids.append(g[use])
            if not ids:
                continue
            docs, ids = np.concatenate(docs), np.concatenate(ids)
            pair, n = np.unique(docs.astype(np.int64) << 32 | ids, return_counts=True)
            docs, ids = pair >> 32, pair & 0xFFFFFFFF
            size = np.maximum(np.bincount(docs, n, len(part)), 1)
            share = (n / size[docs]).astype(np.float32)
            mean = np.stack([np.bincount(docs, model.emb[ids, k] * share, len(part)) for k in range(DIM)], 1)
            logits = mean @ model.soft + model.bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            err = p.copy()
            err[np.arange(len(part)), y[part]] -= 1
            err *= (class_weight[y[part]] / len(part))[:, None]
            to_mean = err @ model.soft.T
            rows, inverse = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(inverse, to_mean[docs, k] * share, len(rows)) for k in range(DIM)], 1)
            sums[0][rows] += grad.astype(np.float32) ** 2
            model.emb[rows] -= (rate * grad / np.sqrt(sums[0][rows])).astype(np.float32)
            for p_, s_, g_ in ((model.soft, sums[1], mean.T @ err), (model.bias, sums[2], err.sum(0))):
                s_ += (g_ ** 2).astype(np.float32)
                p_ -= (rate * 0.2 * g_ / np.sqrt(s_)).astype(np.float32)
    return model


def calibrate(model: Subwords, logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
    """Weighted logistic regression of the label on the logit (Newton steps)."""
    x = np.stack([logit, np.ones_like(logit)], 1)
    scale = max(float(np.std(logit)), 1e-6)
    x[:, 0] /= scale
    c = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        c += np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * c)
    model.slope, model.shift = float(c[0] / scale), float(c[1])


def training_rows(docs: DataFrame, labels: DataFrame, target: str, max_toxic: int,
                  max_clean: int) -> tuple[DataFrame | None, dict[int, float]]:
    """Rows ``text, y, h`` within the bounds (None without both kinds), and the share taken of each kind."""
    ids = staged(labels.select(id_text().alias("id_text"), F.col(target).cast("int").alias("y"))
                 .where(F.col("y").isNotNull() & ~held_out("id_text"))
                 .select("id_text", (F.col("y") > 0).cast("int").alias("y")).distinct()
                 .withColumn("h", F.pmod(F.xxhash64(F.lit("toxic"), "id_text"), F.lit(1 << 30))), "toxic-labels")
    n = {r.y: r["count"] for r in ids.groupBy("y").count().collect()}
    if not n.get(1) or not n.get(0):
        return None, {k: float(k in n) for k in (0, 1)}
    bound = {1: max_toxic, 0: max_clean}

    def below(column: str, share: dict[int, float]):
        return F.col(column) < F.when(F.col("y") > 0, int((1 << 30) * share[1])).otherwise(int((1 << 30) * share[0]))

    share = {k: min(1.0, bound[k] / n[k]) for k in n}
    some = F.broadcast(ids.where(below("h", share)))  # one row per id and kind: about max_toxic + max_clean
    rows = (docs.select(id_text().alias("id_text"), text_bytes().alias("text"))
            .where(F.length("text") <= MAX_TEXT).join(some, "id_text")
            .withColumn("t", F.pmod(F.xxhash64(F.lit("text"), "id_text", "text"), F.lit(1 << 30))))
    found = (rows.select("id_text", "y", "t", F.length("text").alias("size")).distinct()
             .groupBy("y").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect())
    within = {0: 1.0, 1: 1.0} | {r.y: min(1.0, bound[r.y] / r.n, MAX_BYTES / max(r["size"], 1)) for r in found}
    return (rows.where(below("t", within)).select("id_text", "text", "y", "h").distinct().select("text", "y", "h"),
            {k: share[k] * within[k] for k in share})


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", max_toxic: int = MAX_TOXIC,
        max_clean: int = MAX_CLEAN) -> Subwords | float:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    rows, rate = training_rows(docs, labels, target, max_toxic, max_clean)
    if rows is None:
        return rate[1]
    rows = rows.orderBy("h", "text").toPandas()  # bounded in rows and bytes
    texts, y, fold = list(map(bytes, rows["text"])), (rows["y"].to_numpy() > 0).astype(int), rows["h"].to_numpy() % 5
    if not len(texts):
        return 0.0
    inside = fold != 0
    model = train([t for t, k in zip(texts, inside) if k], y[inside])
    table, check = model.weights(), ~inside if 0 < y[~inside].sum() < (~inside).sum() else inside
    kept = [t for t, k in zip(texts, check) if k]
    logit = np.concatenate([model.highest(pa.array(kept[i:i + 500], pa.binary()), table)[0] for i in range(0, len(kept), 500)])
    calibrate(model, logit, y[check], np.where(y[check] == 1, 1 / rate[1], 1 / rate[0]))
    return model


def score_documents(docs: DataFrame, labels: DataFrame, target: str = "toxic",
                    threshold: float = THRESHOLD, **bounds) -> DataFrame:
    """The contract of op9: ``doc_id, held_out, score, predicted`` of every document."""
    model = fit(docs, labels, target, **bounds)
    table = None if isinstance(model, float) else model.weights()
    if table is not None:  # scoring needs the n-gram logits only
        model = Subwords(np.zeros((0, DIM)), model.soft, model.bias, model.slope, model.shift)
    known = docs.sparkSession.sparkContext.broadcast(table)  # BUCKETS floats

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for b in rows_of(batches, 4 << 20, "text"):
            score = (np.full(b.num_rows, model) if table is None
                     else model.probability(model.highest(b.column("text"), table)[0]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score.astype(np.float64))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text_bytes().alias("text"))
            .mapInArrow(per_batch, f"doc_id {kind}, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
