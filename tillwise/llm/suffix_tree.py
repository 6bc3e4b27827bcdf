"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``WINDOW`` consecutive words.  Every word covered by a window
whose words also start in a document with a smaller id is removed; windows
are judged on the input.

Whole copies of a text are settled by a 128-bit hash: they go (if they have
a window at all) and take no further part.  Then, in rounds over chunks
(``repeats``):

1. A window's least hash of ``GRAM`` consecutive words names it, so equal
   windows have equal names.  Names held by one document only cannot repeat;
   this leaves few suffixes and costs a few bytes per name.
2. The suffixes that begin the other windows are dealt by variable-length
   prefixes: a sampled histogram splits each prefix that exceeds its share of
   a group by one more word, until it fits (or the prefix is the window).
   Each chunk sends a distinct suffix once, with its smallest document id.
   A group sorts its suffixes by words and takes the depth common to
   neighbours: the internal nodes of its suffix tree, of which those of
   depth ``WINDOW`` or more are the repeats.  The smallest id under the node
   is the document that keeps its words.
3. Each chunk marks the windows that a smaller id holds and drops the words.

The words of a suffix are 32-bit codes; a 32-bit hash of the whole window is
compared as well.  A group's size follows ``BUCKET_BYTES``, never the number
of copies of one passage: that is one suffix per chunk.

Null or empty text has no words and comes back empty.  A null id counts as the smallest id.  Rows
with one id are one document: none removes words of the other.  Texts of
fewer words than a window keep all.  Other columns are kept as they are.  An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, staged, text_bytes
from .repeats import (
    ASKED, BUCKET_BYTES, NULL_ID, PER_BUCKET, Answers, answer_each, answered_values, ask_values, asked, chunked,
    collected, each_chunk, held_by_others, pack, pack_bits, sampled_places, split_by, unpack, unpack_bits, whole_copies,
)

WINDOW = 13
GRAM = 6
SAMPLE = 50_000  # suffixes in the prefix histogram at least, about

_M = np.uint64(0x9FB21C651E98DF25)
_SAMPLED = -1  # the bucket that carries histogram samples


def _fold(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = (h ^ x) * _M
    return h ^ (h >> np.uint64(29))


class Chunk:
    """The windows of the documents of one chunk."""

    def __init__(self, rows: pa.RecordBatch, answers: Answers, window: int):
        self.ids = rows.column("id").to_numpy()
        says = answers.get(0, {})
        self.copy = np.array([says.get(i) == b"copy" for i in range(rows.num_rows)], bool)
        self.texts = rows.column("text").to_pylist()
        digest = xxhash.xxh3_64_intdigest
        self.count, parts = [], []
        for t, c in zip(self.texts, self.copy):  # the words of one document at a time
            words = t.split()
            self.count.append(len(words))
            if not c:
                parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
        size = [0 if c else n for n, c in zip(self.count, self.copy)]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.flat, self.window = flat, window
        self.end = np.cumsum(size)
        doc = np.repeat(np.arange(len(size)), size)
        n = max(0, len(flat) - window + 1)
        starts = np.arange(n)
        self.starts = starts[starts + window <= self.end[doc[:n]]] if n else starts
        self.doc = doc[self.starts]
        # the least GRAM-word hash within each window
        g = np.zeros(max(0, len(flat) - GRAM + 1), np.uint64)
        for j in range(GRAM):
            g = _fold(g, flat[j:j + len(g)])
        g, span, reach = mix64(g), window - GRAM + 1, 1
        while reach < span:
            step = min(reach, span - reach)
            g = np.minimum(g[:len(g) - step], g[step:]) if len(g) > step else g[:0]
            reach += step
        self.name = g[self.starts] if n else np.zeros(0, np.uint64)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct names, and whether several documents of the chunk hold one."""
        if not len(self.name):
            return self.name, np.zeros(0, bool)
        new = np.flatnonzero(np.r_[True, (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])])
        name, ident = self.name[new], self.ids[self.doc[new]]
        order = np.lexsort((ident, name))
        name, ident = name[order], ident[order]
        first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        last = np.r_[first[1:], len(name)] - 1
        return name[first], ident[first] != ident[last]

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Places in ``starts`` of the windows whose name repeats (sorted names)."""
        if not len(repeated) or not len(self.name):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(repeated, self.name), len(repeated) - 1)
        return np.flatnonzero(repeated[at] == self.name)


def codes(flat: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """uint32[n, window]: the words of each suffix, as far as the window goes."""
    low = flat.astype(np.uint32)
    return np.stack([low[starts + j] for j in range(window)], 1) if len(starts) else np.zeros((0, window), np.uint32)


def prefix_group(suffix: np.ndarray, split: list[np.ndarray], groups: int) -> np.ndarray:
    """The group of each suffix: the hash of its shortest prefix that is not split."""
    h = np.zeros(len(suffix), np.uint64)
    active = np.ones(len(suffix), bool)
    for depth in range(suffix.shape[1]):
        h[active] = _fold(h[active], suffix[active, depth].astype(np.uint64) + np.uint64(depth + 1))
        if depth >= len(split):
            break
        active &= np.isin(h, split[depth])
        if not active.any():
            break
    return (mix64(h) % np.uint64(groups)).astype(np.int64)


def split_prefixes(sample: np.ndarray, groups: int) -> list[np.ndarray]:
    """Per depth the hashes of the prefixes that hold over half a group's share of the sample."""
    limit, split = max(2.0, len(sample) / (2 * groups)), []
    h, active = np.zeros(len(sample), np.uint64), np.ones(len(sample), bool)
    for depth in range(sample.shape[1] - 1):
        h[active] = _fold(h[active], sample[active, depth].astype(np.uint64) + np.uint64(depth + 1))
        value, count = np.unique(h[active], return_counts=True)
        heavy = value[count > limit]
        if not len(heavy):
            break
        split.append(heavy)
        active &= np.isin(h, heavy)
    return split


def _message(suffix: np.ndarray, check: np.ndarray, ident: np.ndarray) -> bytes:
    n = np.array([len(suffix)], "<i8").tobytes()
    return pack(n + suffix.T.tobytes() + check.tobytes() + ident.tobytes())


def _opened(message: bytes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = unpack(message)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    suffix = np.frombuffer(raw, np.uint32, n * window, 8).reshape(window, n).T
    return suffix, np.frombuffer(raw, np.uint32, n, 8 + 4 * n * window), np.frombuffer(raw, np.int64, n, 8 + 4 * n * (window + 1))


def tree_order(suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in the order of their words, and the depth (words) that each
    shares with the one before it: the suffix tree's internal nodes."""
    order = np.lexsort(suffix.T[::-1])
    s = suffix[order]
    differ = s[1:] != s[:-1]
    depth = np.where(differ.any(axis=1), differ.argmax(axis=1), s.shape[1])
    return order, np.r_[0, depth]


def smaller_ids(messages: list[bytes], window: int) -> list[bytes]:
    """One group: for each suffix of each message, whether a smaller id is under its node."""
    parts = [_opened(m, window) for m in messages]
    suffix = np.concatenate([p[0] for p in parts])
    check = np.concatenate([p[1] for p in parts])
    ident = np.concatenate([p[2] for p in parts])
    # the check is the last column: one more "word" at the deepest level
    order, depth = tree_order(np.column_stack([suffix, check]))
    node = np.cumsum(depth <= window) - 1  # leaves that agree in all words and the check
    least = np.full(node[-1] + 1 if len(node) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, node, ident[order])
    flag = np.empty(len(order), bool)
    flag[order] = least[node] < ident[order]
    ends = np.cumsum([len(p[0]) for p in parts])
    return [pack_bits(f) for f in np.split(flag, ends[:-1])]


def marked_rows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` reduced to the kept words (one space between), ``n_words`` and ``n_removed``."""
    docs = docs.drop("n_words", "n_removed")  # the new columns take these names
    names = [f"c{i}" for i in range(len(docs.columns))]  # so that no column clashes
    given = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    chunks = chunked(given.select(
        F.coalesce(F.col(names[docs.columns.index("doc_id")]).cast("long"), F.lit(NULL_ID)).alias("id"),
        text_bytes(text).alias("text"), *[n for n in names if n != text]))
    total = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    share = max(SAMPLE, PER_BUCKET * buckets) / max(1, total // 6)
    copies = staged(whole_copies(chunks), "copies")

    def ask_names(rows: pa.RecordBatch, answers: Answers) -> pa.Table:
        c = Chunk(rows, answers, window)
        name, _ = c.names()  # also those it has several times: others ask for them
        out = ask_values(name, buckets)
        chosen = sampled_places(len(c.starts), c.flat, share)
        if len(chosen):
            out.append((_SAMPLED, codes(c.flat, c.starts[chosen], window).tobytes()))
        return asked(out)

    round1 = staged(each_chunk(chunks, copies, ask_names, ASKED, keep="chunk"), "names")
    sample = np.frombuffer(collected(round1, _SAMPLED), np.uint32).reshape(-1, window)
    split = split_prefixes(sample, buckets)
    known = copies.unionByName(staged(answer_each(round1.where(F.col("bucket") != _SAMPLED), 1, held_by_others), "known"))

    def suffixes(rows: pa.RecordBatch, answers: Answers):
        """Distinct candidate suffixes of a chunk, by group and then by words."""
        c = Chunk(rows, answers, window)
        name, several = c.names()
        again = several | answered_values(name, buckets, answers.get(1, {}))
        at = c.candidates(name[again])
        whole = np.zeros(len(at), np.uint64)
        for j in range(window):
            whole = _fold(whole, c.flat[c.starts[at] + j])
        whole = mix64(whole)
        ident = c.ids[c.doc[at]]
        order = np.lexsort((ident, whole))
        first = np.flatnonzero(np.r_[True, whole[order][1:] != whole[order][:-1]]) if len(at) else np.zeros(0, np.int64)
        which = np.empty(len(at), np.int64)  # the distinct suffix of each candidate
        which[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(at)]))
        lead = at[order[first]]
        suffix = codes(c.flat, c.starts[lead], window)
        group = prefix_group(suffix, split, buckets)
        by = np.lexsort((whole[order[first]], suffix[:, 1], suffix[:, 0], group))
        return c, at, which, by, group[by], suffix[by], whole[order[first]][by].astype(np.uint32), ident[order[first]][by]

    def ask_suffixes(rows: pa.RecordBatch, answers: Answers) -> pa.Table:
        _, _, _, _, group, suffix, check, ident = suffixes(rows, answers)
        return asked([(g, _message(suffix[s], check[s], ident[s])) for g, s in split_by(group)])

    round2 = each_chunk(chunks, known, ask_suffixes, ASKED, keep="chunk")
    smaller = known.unionByName(answer_each(round2, 2, lambda m: smaller_ids(m, window)))

    def drop_words(rows: pa.RecordBatch, answers: Answers) -> pa.Table:
        c, at, which, by, group, _, _, ident = suffixes(rows, answers)
        flag, least = np.empty(len(by), bool), np.empty(len(by), np.int64)
        for g, s in split_by(group):
            flag[by[s]] = unpack_bits(answers[2][g], s.stop - s.start)
        least[by] = ident
        gone = flag[which] | (least[which] < c.ids[c.doc[at]])
        edge = np.zeros(len(c.flat) + 1, np.int32)
        np.add.at(edge, c.starts[at[gone]], 1)
        np.add.at(edge, c.starts[at[gone]] + window, -1)
        keep = np.cumsum(edge[:-1]) == 0
        texts, removed = [], []
        for t, copy, end in zip(c.texts, c.copy, c.end):
            words = t.split()
            if copy:
                kept = [] if len(words) >= window else words
            else:
                k = keep[end - len(words):end]
                kept = words if k.all() else [w for w, ok in zip(words, k.tolist()) if ok]
            texts.append(b" ".join(kept))
            removed.append(len(words) - len(kept))
        out = pa.Table.from_batches([rows.drop_columns(["id", "text"])])
        return (out.append_column(text, pa.array(texts, pa.binary()))
                .append_column("n_words", pa.array(c.count, pa.int64()))
                .append_column("n_removed", pa.array(removed, pa.int64())))

    fields = [f for f in given.schema if f.name != text]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + [f"{text} binary, n_words long, n_removed long"])
    out = each_chunk(chunks, smaller, drop_words, schema)
    return out.select(*[(F.col(n).cast("string") if n == text else F.col(n)).alias(c) for n, c in zip(names, docs.columns)],
                      "n_words", "n_removed")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """The contract of op7."""
    return (marked_rows(docs.select("doc_id", "text"))
            .select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")))
