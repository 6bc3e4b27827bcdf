"""Document fingerprints by a randomised edit embedding.

A walk reads a text: at step j it writes the character under it and moves on
or stays, by a random bit of (j, character) that all texts share.  Two texts
read alike up to an edit, and after it the two walks meet again, mostly soon,
so a small edit distance becomes a small Hamming distance of what is written.
WALKS independent walks even out the cases that meet late.  A fingerprint
samples SLOTS coordinates of what they write (8 bits each, of the four
characters read there).  A slot samples the step of least random rank among
all steps of its walk, so texts of similar length sample the same steps and
every part of a text is equally likely to be sampled.  Likeness is the share
of equal slots.

``near_documents`` bands the slots and verifies all pairs that share a band on
all slots, in blocks of bounded size; ``near_classes`` gives every document its
class and number of links.  Work grows with the square of the different
fingerprints of a bucket, rows only where pairs are asked for; a group of equal
fingerprints is one.

Scale: a walk is a vector operation over thousands of texts at once, so its
memory is bounded by ``_GROUP_BYTES`` (and the longest text).  For the pairs
with the next document, documents are dealt to ranges of ids by quantiles
that are ids themselves; the first document of a range is also sent to the
range before, so neighbours meet without a global sort.  Ranges go to tasks by
number.  An id that fills whole ranges is cut by a hash of its texts.

Null text is empty; empty texts have one fingerprint.  A null id counts as
the smallest id.  Rows with one id are ordered by a hash of the text (xxhash64)
and are each other's next.  Very long texts are read whole, alone in their
group.  A single document is its own next; other columns, of whatever name, are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_of, staged, text_bytes, worker_cache
from .components import components

SLOTS = 128
WALKS = 4
BANDS = 32
_TAIL = 4  # characters of a sample, and pads after a text
_ROWS, _GROUP_BYTES = 8192, 24 << 20
_MAX_RANGES = 100_000  # a task takes one; beyond 0.8 billion documents they hold more, which a task streams
_BLOCK = 1024  # fingerprints of a block of near_documents
_SMALLEST = -(1 << 63)


class Walk:
    """The shared randomness: step bits of every walk, and which steps each slot samples."""

    def __init__(self, slots: int = SLOTS, walks: int = WALKS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bits = rng.integers(0, 2, (1 << 13, walks, 256), np.uint8)
        self.bits[:, :, 0] = 0  # a pad: the walk is over
        self.bits = self.bits.reshape(1 << 13, -1)
        self.slots, self.walks = slots, walks
        self.rngs = [np.random.default_rng((seed, k)) for k in range(slots)]
        self.records = [[0] for _ in range(slots)]  # steps of ever smaller rank
        self.ranks = [r.random() for r in self.rngs]
        self.until = 1

    def reach(self, steps: int) -> dict[int, list[int]]:
        """Extend the records beyond ``steps``; the walks that sample each step."""
        while self.until < steps:
            self.until *= 4
        for k, rng in enumerate(self.rngs):
            while self.records[k][-1] < self.until:
                self.records[k].append(self.records[k][-1] + int(rng.geometric(max(self.ranks[k], 1e-12))))
                self.ranks[k] *= rng.random()
        at: dict[int, set[int]] = {}
        for k, r in enumerate(self.records):
            for j in r:
                at.setdefault(j, set()).add(k % self.walks)
        return {j: sorted(w) for j, w in at.items()}

    def sampled(self, k: int, steps: int) -> int:
        """The step that slot k samples of a walk of ``steps`` steps."""
        return self.records[k][bisect.bisect_left(self.records[k], steps) - 1]

    def row(self, step: int) -> np.ndarray:
        return self.bits[(step ^ (step >> 13) * 0x9E5) & 0x1FFF]


def classes(text: str) -> np.ndarray:
    """Code points as 1..255, then pads (0)."""
    out = np.zeros(len(text) + _TAIL, np.uint8)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out[:len(text)] = (code * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(255) + 1
    return out


def fingerprints(texts: list[str], walk: Walk) -> np.ndarray:
    """uint8[len(texts), slots]."""
    parts = [classes(t) for t in texts]
    size = np.array([len(p) for p in parts], np.int64)
    if not len(parts):
        return np.zeros((0, walk.slots), np.uint8)
    flat = np.concatenate(parts)
    del parts
    n = len(texts)
    at = np.tile(np.cumsum(size) - size, walk.walks)  # one reader per walk and text
    text = np.tile(np.arange(n), walk.walks)
    base = np.repeat(np.arange(walk.walks) * 256, n)
    by_length = np.argsort(-size[text], kind="stable")
    at, text, base = at[by_length], text[by_length], base[by_length]
    out = np.zeros((n, walk.slots), np.uint8)
    symbols: dict[tuple[int, int], np.ndarray] = {}  # of each sampled step and walk, by text
    step = check = 0
    sampled = walk.reach(64)
    while len(at):
        check = max(check + 1, check + check // 32)
        if check >= walk.until:
            sampled = walk.reach(check + 1)
        for j in range(step, check):
            here = flat.take(at)
            for w in sampled.get(j, ()):
                mine = np.flatnonzero(base == 256 * w)
                place = at[mine]
                s = here[mine].astype(np.uint32)
                for k in range(1, _TAIL):
                    s = s * np.uint32(0x9E3779B1) + flat.take(np.minimum(place + k, len(flat) - 1)) * (here[mine] > 0)
                s ^= s >> np.uint32(15)
                s *= np.uint32(0x85EBCA6B)
                got = np.zeros(n, np.uint8)
                got[text[mine]] = (s >> np.uint32(24)).astype(np.uint8)
                symbols[j, w] = got
            at += walk.row(j).take(base + here)
        step = check
        over = flat.take(at) == 0
        if over.any():  # these walks took `check` steps, to within 1 in 32
            for k in range(walk.slots):
                w = k % walk.walks
                done = text[over & (base == 256 * w)]
                if len(done):
                    out[done, k] = symbols[walk.sampled(k, check), w][done]
            at, text, base = at[~over], text[~over], base[~over]
            if len(symbols) > 4 * walk.slots and len(text) < n:  # keep what can still be asked for
                live = {(walk.sampled(k, check), k % walk.walks) for k in range(walk.slots)}
                symbols = {j: v for j, v in symbols.items() if j in live}
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _quantiles(column: str, parts: int):
    """``parts`` - 1 values of ``column`` that cut its rows into equal parts."""
    return F.percentile_approx(column, [i / parts for i in range(1, parts)] or [0.5], 10 * parts + 1000)


def _splits(docs: DataFrame) -> list[tuple[int, int]]:
    """(key, text hash) that begin ranges of about _ROWS documents, in the order of :func:`with_next`.

    Quantiles of quantiles: the keys are cut into a square root of the parts,
    then each of these again.  A key that is met twice among the cuts holds
    whole ranges and is cut by the hash of its texts, at hashes that occur."""
    n, top = docs.agg(F.count("*"), F.max("key")).first()
    if not n:
        return []
    parts = min(_MAX_RANGES, -(-n // _ROWS))
    outer = math.ceil(math.sqrt(parts))
    inner = -(-parts // outer)
    cuts = docs.agg(_quantiles("key", outer)).first()[0] if outer > 1 else []
    often = {k for k, m in Counter(cuts).items() if m > 1}
    if inner > 1:
        bounds = np.array(sorted(set(cuts)), np.int64)

        @F.pandas_udf("int")
        def part(key: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds, key.to_numpy(np.int64), "right").astype(np.int32))

        keys = docs.select("key").where(~F.col("key").isin(*often)) if often else docs.select("key")
        for r in keys.groupBy(part("key").alias("part")).agg(_quantiles("key", inner).alias("cuts")).collect():
            often |= {k for k, m in Counter(r.cuts).items() if m > 1}
            cuts = cuts + r.cuts
    splits = {(k, _SMALLEST) for k in {top, *cuts} - often}
    if often:
        hot = docs.where(F.col("key").isin(*often))
        pieces = hot.groupBy("key").agg(F.ceil(F.count("*") / _ROWS).alias("pieces"))
        high = F.floor((F.shiftright(F.col("hash"), 32) + (1 << 31)) * F.col("pieces") / (1 << 32))
        splits |= {(r.key, r.hash) for r in hot.select("key", _hash().alias("hash")).join(pieces, "key")
                   .groupBy("key", high.alias("piece")).agg(F.min("hash").alias("hash")).collect()}
    return sorted(splits, key=lambda s: (-s[0], s[1]))


def _hash() -> Column:
    return F.xxhash64("text")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows ``range, halo, key, doc_id, text`` (bytes), dealt and sorted so that
    each document is followed by the next one; a range ends with a halo row."""
    docs = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_SMALLEST)).alias("key"),
                       text_bytes().alias("text"))
    splits = _splits(docs)
    begin = np.array([~k for k, _ in splits], np.int64)  # rising; ~ never overflows
    lowest = np.array([h for _, h in splits], np.int64)  # text hash that begins a range, of those of one key

    @F.pandas_udf("array<int>")
    def places(key: pd.Series, hashed: pd.Series) -> pd.Series:
        k, h = ~key.to_numpy(np.int64), hashed.to_numpy(np.int64)
        left, right = np.searchsorted(begin, k, "left"), np.searchsorted(begin, k, "right")
        at, first = right - 1, right > left
        for i in np.flatnonzero(right - left > 1).tolist():
            at[i] = left[i] + np.searchsorted(lowest[left[i]:right[i]], h[i], "right") - 1
        first &= (lowest[at] == h) | (lowest[at] == _SMALLEST)
        return pd.Series([[2 * a, 2 * ((a or len(begin)) - 1) + 1] if f else [2 * a] for a, f in zip(at.tolist(), first)])

    n = max(1, len(splits))
    return (docs.withColumn("hash", _hash()).withColumn("place", F.explode(places("key", "hash")))
            .select(F.floor(F.col("place") / 2).cast("int").alias("range"), (F.col("place") % 2).alias("halo"),
                    "key", "doc_id", "hash", "text")
            .repartitionById(n, "range")
            .sortWithinPartitions("range", "halo", F.desc("key"), "hash", "text").drop("hash"))


def fingerprint_documents(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The contract of op1: every text and its edited text, fingerprinted."""
    rows = with_next(docs)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = worker_cache().setdefault(("walk", slots), Walk(slots))

        def result(ids, ranges, halo, texts):
            prints = fingerprints(texts, walk)
            pairs = [i for i in range(len(texts) - 1) if not halo[i] and ranges[i] == ranges[i + 1]]
            new = [edited(texts[i], texts[i + 1]) for i in pairs]
            new_prints = fingerprints(new, walk)
            mine, following = prints[pairs], prints[[i + 1 for i in pairs]]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in pairs], kind), pa.array([len(texts[i]) for i in pairs], pa.int64()),
                 pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
                 pa.array([p.tobytes().hex() for p in mine], pa.string()),
                 pa.array([p.tobytes().hex() for p in new_prints], pa.string()),
                 pa.array(likeness(mine, new_prints)), pa.array(likeness(mine, following))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        held = ([], [], [], [])
        kind = pa.int64()
        for b in rows_of(batches, _GROUP_BYTES, "text", _ROWS):
            kind = b.column("doc_id").type
            new = (b.column("doc_id").to_pylist(), b.column("range").to_pylist(), b.column("halo").to_pylist(),
                   [t.decode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()])
            held = tuple(h + n for h, n in zip(held, new))
            yield result(*held)
            held = tuple(h[-1:] for h in held)  # waits for its next document

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(per_partition, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                           "edited_fingerprint string, near_edited double, near_next double")


def _in_blocks(prints: DataFrame, min_likeness: float, bands: int, result: Callable, schema: str) -> DataFrame:
    """Compare what shares a band, and give ``result`` the links of each pair of blocks.

    ``prints`` holds each ``fingerprint`` once, with ``node``, ``id`` and ``n``.
    Buckets with the same members count once (the one of the least band).  A
    pair counts in the first band that it shares, and nowhere else."""
    length = 2 * SLOTS // bands
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.struct(
        i.alias("band"), F.substring(F.col("fingerprint"), i * length + 1, F.lit(length)).alias("key"))))
    keyed = prints.select("node", band.alias("b")).select("node", "b.*")
    buckets = (keyed.groupBy("band", "key")
               .agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("h1"),
                    F.bit_xor(F.xxhash64(F.lit("second"), "node")).alias("h2"))
               .where("members > 1").groupBy("members", "h1", "h2").agg(F.min(F.struct("band", "key")).alias("b"))
               .select("b.*", F.ceil(F.col("members") / _BLOCK).cast("int").alias("blocks")))
    # a block meets every block once: (low, high) pairs of blocks
    m = (keyed.join(buckets, ["band", "key"]).withColumn("mine", F.pmod(F.hash("node", "key"), F.col("blocks")))
         .join(prints, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
         .select("band", "key", "node", "id", "n", "fingerprint", "mine",
                 F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")))

    def per_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        p = np.frombuffer(bytes.fromhex("".join(pdf["fingerprint"])), np.uint8).reshape(len(pdf), SLOTS)
        block, width = pdf["mine"].to_numpy(), SLOTS // bands

        def links() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for i in range(len(pdf) - 1):
                same = p[i + 1:] == p[i]
                share = same.mean(axis=1)
                at = np.flatnonzero((share >= min_likeness) & ((block[i + 1:] != block[i]) | (key[2] == key[3])))
                if len(at):
                    first = same[at, :bands * width].reshape(-1, bands, width).all(axis=2).argmax(axis=1)
                    at = at[first == key[0]]
                if len(at):
                    yield i, at + i + 1, share[at]

        return result(pdf, links())

    return m.groupBy("band", "key", "low", "high").applyInPandas(per_group, schema)


def _distinct(prints: DataFrame) -> DataFrame:
    """Each fingerprint once: its 128-bit ``node``, smallest ``id`` and number ``n`` of documents."""
    return (prints.groupBy("fingerprint").agg(F.min(_id()).alias("id"), F.count("*").alias("n"))
            .withColumn("node", F.md5(F.col("fingerprint").cast("binary"))))


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_SMALLEST))


def near_documents(prints: DataFrame, min_likeness: float = 0.8, bands: int = BANDS) -> DataFrame:
    """``doc_id, fingerprint`` -> all pairs ``doc_id_a < doc_id_b, likeness`` that share a band and are near.

    Equal fingerprints are one representative here (the smallest id);
    ``near_classes`` has a row for each document.  The pairs of a group of k
    different near copies are k^2 / 2 rows."""
    def pairs(pdf: pd.DataFrame, links: Iterator) -> pd.DataFrame:
        ids = pdf["id"].to_numpy(np.int64)
        out = [(np.minimum(ids[i], ids[at]), np.maximum(ids[i], ids[at]), share) for i, at, share in links]
        a, b, share = map(np.concatenate, zip(*out)) if out else ([], [], [])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64), "likeness": np.array(share, float)})

    found = _in_blocks(_distinct(prints), min_likeness, bands, pairs, "a long, b long, likeness double")
    # an id that rows with other texts repeat can be met twice, or meet itself
    return (found.where("a != b").groupBy("a", "b").agg(F.max("likeness").alias("likeness"))
            .select(F.nullif("a", F.lit(_SMALLEST)).alias("doc_id_a"), F.col("b").alias("doc_id_b"), "likeness"))


def near_classes(prints: DataFrame, min_likeness: float = 0.8, bands: int = BANDS) -> DataFrame:
    """``doc_id, fingerprint`` -> ``doc_id, class_id, n_links`` of every row.

    A class is what links connect, named by its smallest id; ``n_links`` counts
    the other rows that are near this one, copies included.  All pairs that
    share a band are compared, but only a row for each member leaves a block."""
    def members(pdf: pd.DataFrame, links: Iterator) -> pd.DataFrame:
        n, count, parent = pdf["n"].to_numpy(np.int64), np.zeros(len(pdf), np.int64), list(range(len(pdf)))

        def find(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for i, at, _ in links:
            count[i] += n[at].sum()
            count[at] += n[i]
            for j in at.tolist():
                u, v = find(i), find(j)
                parent[max(u, v)] = min(u, v)
        near, node = np.flatnonzero(count), pdf["node"].to_numpy(object)
        return pd.DataFrame({"a": node[near], "b": node[[find(i) for i in near.tolist()]], "n_links": count[near]})

    distinct = staged(_distinct(prints), "fingerprints")
    found = staged(_in_blocks(distinct, min_likeness, bands, members, "a string, b string, n_links long"), "near")
    count = found.groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("n_links"))
    labels = components(found.select("a", "b")).withColumnRenamed("id", "node")
    named = (distinct.join(labels, "node", "left").join(count, "node", "left")
             .select("node", "fingerprint", "id", F.coalesce("component", "node").alias("component"),
                     (F.col("n") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links")))
    names = named.groupBy("component").agg(F.min("id").alias("class_id"))
    own = named.join(names, "component").select("fingerprint", "class_id", "n_links")
    return prints.select("doc_id", "fingerprint").join(own, "fingerprint").select(
        "doc_id", F.nullif("class_id", F.lit(_SMALLEST)).alias("class_id"), "n_links")
