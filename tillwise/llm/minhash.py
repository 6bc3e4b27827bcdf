"""Near-duplicate documents: fast similarity sketching, banding, exact links.

A document is its set of distinct word shingles.  Its sketch has one entry
per coordinate.  In round r every shingle goes to a hashed coordinate with a
hashed value; an entry keeps the least (round, value).  After t such rounds,
t more give each coordinate all shingles in turn, so every coordinate is
filled; rounds end as soon as all are, which for large sets is after one or
two.  The share of equal entries estimates the Jaccard similarity with the
concentration of independent samples.

Equal sets are one class first (128-bit hash of the sorted set), named by
their smallest document.  Classes that agree on a band are candidates:

1. each member of a band's bucket with the smallest member (a star: as many
   pairs as members), verified on the full sets, gives components;
2. in buckets where more than one component remains, all pairs across
   components are compared inside blocks of bounded size, screened by the
   sketches and then on the sets; only links leave a block, one for each two
   components, and are verified likewise.

So large groups of near copies never become all pairs, and no candidate pair
is left out.  With the defaults a link at the threshold shares no band with
probability below 1e-5 (``miss_rate``); the screen lies over seven standard
deviations below the threshold.

Null or empty text, or text without words, has an empty set, links with
nothing and is its own component.  A null id counts as the smallest id and
comes back as null.  Rows with one id are one document: it is linked to all
that any of its texts is linked to, and every row of it, empty ones included,
names the same component.  A text of fewer words than a shingle is one shingle
of them all.  Texts of any length are taken whole.  Other columns, of whatever
name, are ignored (``one_of_each`` keeps them).  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, rows_of, staged, text_bytes
from .components import components

_NULL_ID = -(1 << 63)
_BLOCK = 512  # members of a block in step 2


@dataclass(frozen=True)
class Rule:
    """What is linked: shingles of ``words`` words, 100 I >= ``percent`` U; and the bands."""

    words: int = 5
    percent: int = 80
    bands: int = 30
    rows: int = 5

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def miss_rate(self) -> float:
        return (1 - (self.percent / 100) ** self.rows) ** self.bands


CONTRACT = Rule(words=3, percent=85, bands=28, rows=6)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: only A-Z change, only U+0009..U+000D and space split


def shingles(text: bytes, k: int) -> set:
    words = words_of(text)
    return set(zip(*(words[i:] for i in range(k)))) if len(words) >= k else {tuple(words)} if words else set()


def shingle_hashes(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    out = []
    digest = xxhash.xxh3_64_intdigest
    for t in texts:
        words = words_of(t)
        h = np.fromiter(map(digest, words), np.uint64, len(words))
        n = max(len(h) - k + 1, min(1, len(h)))
        s = np.full(n, len(h) if len(h) < k else k, np.uint64)
        for j in range(min(k, len(h))):
            s = (s ^ h[j:j + n]) * np.uint64(0x9FB21C651E98DF25)
            s ^= s >> np.uint64(29)
        out.append(np.unique(mix64(s)))
    return out


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """uint64[len(sets), t]: (round << 32 | value) per coordinate; 2^64-1 for empty sets."""
    size = np.array([len(s) for s in sets], np.int64)
    top = np.iinfo(np.uint64).max
    sketch = np.full(len(sets) * t, top, np.uint64)
    if size.sum():
        x = np.concatenate(sets)
        base = np.repeat(np.arange(len(sets)) * t, size)
        for r in range(2 * t):
            h = mix64(x + np.uint64((r * 0x9E3779B97F4A7C15 + 0x1234567) & (2 ** 64 - 1)))
            coordinate = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if r < t else r - t
            np.minimum.at(sketch, base + coordinate, np.uint64(r << 32) | (h & np.uint64(0xFFFFFFFF)))
            empty = (sketch.reshape(-1, t) == top).any(axis=1)
            more = empty[base // t]
            if not more.any():
                break
            x, base = x[more], base[more]
    return sketch.reshape(len(sets), t)


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """``id, n_shingles, set_hash, bands, sketch`` (low byte of each entry) per row."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, 4 << 20, "text"):
            sets = shingle_hashes(b.column("text").to_pylist(), rule.words)
            sk = sketches(sets, rule.coordinates)
            key = np.arange(rule.bands, dtype=np.uint64)[None, :] + np.uint64(1)
            for j in range(rule.rows):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sk[:, j::rule.rows])
            some = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([list(row) if ok else [] for row, ok in zip(key.view(np.int64).tolist(), some)], pa.list_(pa.int64())),
                 pa.array([row.tobytes() for row in sk.astype(np.uint8)], pa.binary())],
                names=["id", "n_shingles", "set_hash", "bands", "sketch"])

    return (docs.select(_id().alias("id"), text_bytes().alias("text"))
            .mapInArrow(per_batch, "id long, n_shingles long, set_hash binary, bands array<long>, sketch binary"))


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))


def screened(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``a, b`` whose sketches do not rule the threshold out."""
    least = _least_equal(rule)

    @F.pandas_udf("boolean")
    def close(x: pd.Series, y: pd.Series) -> pd.Series:
        t = rule.coordinates
        u = np.frombuffer(b"".join(x), np.uint8).reshape(-1, t)
        v = np.frombuffer(b"".join(y), np.uint8).reshape(-1, t)
        return pd.Series((u == v).sum(axis=1) >= least)

    side = classes.select("id", "sketch")
    return (pairs.join(side.toDF("a", "sa"), "a").join(side.toDF("b", "sb"), "b")
            .where(close("sa", "sb")).select("a", "b"))


def _least_equal(rule: Rule) -> int:
    return int((rule.percent / 100 - 0.25) * rule.coordinates)


def verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``a, b`` that are linked on the full shingle sets of their texts."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = lru_cache(8)(lambda text: shingles(text, rule.words))
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                u, v = sets(x), sets(y)
                common = len(u & v)
                keep.append(common > 0 and 100 * common >= rule.percent * (len(u) + len(v) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = docs.select(_id().alias("id"), text_bytes().alias("text"))
    both = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
            .select("a", "b", "ta", "tb"))
    return both.mapInArrow(per_batch, "a long, b long").distinct()


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct arrays, by products
    of 0/1 matrices over slices of the shared elements (exact below 2^24)."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    value, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, col = np.repeat(np.arange(n), [len(x) for x in sets]), at
    shared = count[at] > 1
    row, col = row[shared], (np.cumsum(count > 1) - 1)[col[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for first in range(0, int(col[-1]) + 1 if len(col) else 0, 1024):
        s = slice(*np.searchsorted(col, (first, first + 1024)))
        m = np.zeros((n, 1024), np.float32)
        m[row[s], col[s] - first] = 1
        out += m @ m.T
    return out


def cross_links(members: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Links ``a, b`` across components, in buckets (``key, id``) that hold several.

    Buckets with the same members count once.  All pairs across components are
    compared where they are, screened by the sketches and then on their
    shingle hashes; of the links that join the same components one is returned."""
    least = _least_equal(rule)
    m = members.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = (m.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"),
                                  F.bit_xor(F.xxhash64("id")).alias("h1"), F.bit_xor(F.xxhash64(F.lit("second"), "id")).alias("h2"))
             .where("x != y").groupBy("n", "h1", "h2").agg(F.min("key").alias("key"))
             .select("key", F.ceil(F.col("n") / _BLOCK).cast("int").alias("blocks")))
    texts = docs.select(_id().alias("id"), text_bytes().alias("text"))
    m = (m.join(mixed, "key").withColumn("mine", F.pmod(F.hash("id", "key"), F.col("blocks")))
         .join(classes.select("id", "sketch"), "id").join(texts, "id"))
    # a block meets every block once: (low, high) pairs of blocks
    m = (m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
         .select("key", "id", "component", "mine", "sketch", "text",
                 F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")))

    def per_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        label, block = pdf["component"].to_numpy(), pdf["mine"].to_numpy()
        sk = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1)
        near = np.zeros((len(pdf), len(pdf)), bool)
        for i in range(len(pdf)):
            near[i, i + 1:] = ((label[i + 1:] != label[i]) & ((block[i + 1:] != block[i]) | (key[1] == key[2]))
                               & ((sk[i + 1:] == sk[i]).sum(axis=1) >= least))
        links = []
        used = np.flatnonzero(near.any(axis=0) | near.any(axis=1))
        if len(used):
            near = near[np.ix_(used, used)]
            sets = shingle_hashes([pdf["text"].iloc[i] for i in used], rule.words)
            size = np.array([len(v) for v in sets])
            common = intersections(sets)
            for i in range(len(used)):
                c = common[i].astype(np.int64)
                near[i] &= (c > 0) & (100 * c >= rule.percent * (size[i] + size - c))
            parent = {v: v for v in label[used].tolist()}

            def find(v: int) -> int:
                while parent[v] != v:
                    v = parent[v]
                return v

            ids = pdf["id"].to_numpy()[used].tolist()
            for i, j in np.argwhere(near).tolist():
                u, v = find(int(label[used[i]])), find(int(label[used[j]]))
                if u != v:
                    parent[max(u, v)] = min(u, v)
                    links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return m.groupBy("key", "low", "high").applyInPandas(per_group, "a long, b long").distinct()


def same_document(sig: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` from an id that holds several sets (or a set and an empty
    text) to the class of each: they are one document."""
    held = sig.groupBy("id", "set_hash").agg(F.first("n_shingles").alias("n"))
    several = held.groupBy("id").agg(F.count("*").alias("sets")).where("sets > 1").select("id")
    return (held.where("n > 0").join(several, "id", "left_semi")
            .join(classes.select("set_hash", F.col("id").alias("b")), "set_hash")
            .where("id != b").select(F.col("id").alias("a"), "b"))


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    sig = staged(signatures(docs, rule), "signatures")
    classes = staged(sig.where("n_shingles > 0").groupBy("set_hash")
                     .agg(F.min(F.struct("id", "bands", "sketch")).alias("c")).select("set_hash", "c.*"), "classes")
    keyed = classes.select("id", F.explode("bands").alias("key"))
    first = keyed.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a != z").select("key", "a")
    members = staged(keyed.join(first, "key"), "buckets")
    star = members.where("id != a").select("a", F.col("id").alias("b")).distinct()
    links = staged(verified(screened(star, classes, rule), docs, rule).unionByName(same_document(sig, classes)), "links")
    labels = components(links)
    cross = staged(cross_links(members.select("key", "id"), labels, classes, docs, rule), "cross")
    more = staged(verified(cross, docs, rule), "more-links")
    if more.take(1):
        labels = components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    name = (classes.select("set_hash", "id").join(labels, "id", "left")
            .select("set_hash", F.coalesce("component", "id").alias("component")))
    # an empty text belongs to the document that has its id
    empty = (sig.where("n_shingles = 0").join(labels, "id", "left")
             .select("id", "n_shingles", F.coalesce("component", "id").alias("component")))
    own = (sig.where("n_shingles > 0").join(name, "set_hash", "left").select("id", "n_shingles", "component")
           .unionByName(empty)
           .select(F.nullif(F.col("id"), F.lit(_NULL_ID)).alias("doc_id"), "n_shingles",
                   F.nullif(F.coalesce("component", "id"), F.lit(_NULL_ID)).alias("component_id")))
    return own.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs``, all columns, with one document of each group (the smallest id).

    Of rows with equal id and text the one whose other columns are smallest
    stays (nulls first), so reruns agree."""
    keep = (near_duplicates(docs, rule).where("kept").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))
                                                             .alias("kept_document_id")).distinct())
    stay = docs.join(keep, _id() == keep["kept_document_id"], "left_semi")
    names = [f"c{i}" for i in range(len(docs.columns))]  # so that no column clashes
    at = [names[docs.columns.index(c)] for c in ("doc_id", "text")]
    rest = [c for c in names if c not in at]
    least = stay.toDF(*names).groupBy(*at).agg(F.min(F.struct(F.lit(0).alias("k"), *rest)).alias("rest"))
    return least.select(*[F.col(c) if c in at else F.col("rest")[c].alias(c) for c in names]).toDF(*docs.columns)


def link_documents(docs: DataFrame) -> DataFrame:
    """The contract of op2."""
    return near_duplicates(docs, CONTRACT)
