"""Substring dedup of bytes by a range-partitioned sparse suffix array.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else (the same document included) is removed, all occurrences alike; strings
are judged on the input and never cross documents.

Copies of a whole text are settled by a 128-bit hash: all are removed (from
``LENGTH`` bytes on) and one of them stands for them in what follows.  Then,
in rounds over chunks (``repeats``):

1. The least hash of ``GRAM`` bytes within a window of ``LENGTH`` bytes is
   its anchor (the leftmost if equal), so equal windows have equal anchors
   at the same offset.  Anchors are about one position in eighty.  An anchor
   string that occurs once in all chunks cannot be in a repeat.
2. The suffixes that begin at the other anchors are range-partitioned by
   their leading 16 bytes, by splitters sampled from all chunks; equal
   leading bytes never part, so no match lies across a boundary.  A suffix
   travels with the bytes before it that its windows reach.  A bucket sorts
   its suffixes by multikey quicksort, eight bytes at a time within the
   groups still equal, and takes the length common to neighbours.  Two
   windows that begin ``a`` bytes before their anchors are equal if no
   neighbour between them in the array has less than ``LENGTH - a`` bytes in
   common and the ``a`` bytes before are equal too.
   Leading bytes that begin very many anchors (``HOT_ROWS``, estimated from
   one anchor in ``1 / HOT_SHARE``) would be one bucket, so their windows are
   not sorted there: each is asked for by its 128-bit hash, in buckets of the
   hash space.
3. Each chunk marks its repeated windows and drops the bytes.

A suffix with equal surroundings is sent once per chunk, and so is a window
of a hot lead: a passage in a third of all documents is a few rows per chunk,
and a line with a different text around it everywhere spreads over all
buckets.  Long texts are read in slices; memory follows the chunk.

Null text is empty.  A null id stands for itself.  Repeated rows are copies
of each other.  Texts below ``LENGTH`` bytes are kept.  Kept bytes need not
be valid UTF-8.  Other columns are kept.  An empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_bytes, mix64, staged, text_bytes
from .repeats import (
    ASKED, BUCKET_BYTES, PER_BUCKET, Answers, answer_each, answered_values, ask_values, asked, bucket_of, chunked,
    collected, each_chunk, held_by_others, pack, pack_bits, sampled_places, split_by, unpack, unpack_bits, whole_copies,
)

LENGTH = 200
GRAM = 32
SAMPLE = 20_000  # leading bytes that choose the splitters at least, about
_LEAD = 16
_SLICE = 1 << 17
HOT_ROWS, HOT_SHARE = 1 << 14, 1 / 64
_SAMPLED, _COUNTED = -1, -2
_M = np.uint64(0x9FB21C651E98DF25)


def anchors(flat: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor position, first and last window of each run of windows with one anchor."""
    size = np.diff(end, prepend=0)
    room = np.repeat(end, size)  # end of the document of each byte
    out = []
    for a in range(0, max(0, len(flat) - length + 1), _SLICE):
        n = min(_SLICE, len(flat) - length + 1 - a)
        h = flat[a:a + n + length - 1].astype(np.uint32) + np.uint32(1)
        width, power = 1, 0x01000193
        while width < GRAM:
            h = h[:-width] * np.uint32(power) + h[width:]
            width, power = 2 * width, power * power & 0xFFFFFFFF
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        m = h.astype(np.uint64) << np.uint64(32) | np.arange(len(h), dtype=np.uint64)
        span, reach = length - GRAM + 1, 1
        while reach < span:
            step = min(reach, span - reach)
            m = np.minimum(m[:-step], m[step:])
            reach += step
        start = np.arange(a, a + n)
        ok = start + length <= room[a:a + n]
        start, at = start[ok], (m & np.uint64(0xFFFFFFFF)).astype(np.int64)[:n][ok] + a
        if len(start):
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            last = np.r_[first[1:], len(at)] - 1
            out.append(np.stack([at[first], start[first], start[last]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    p, lo, hi = np.concatenate(out, axis=1)
    new = np.r_[True, p[1:] != p[:-1]]  # a run may go on in the next slice
    return p[new], lo[new], hi[np.r_[np.flatnonzero(new)[1:], len(p)] - 1]


class Chunk:
    """Anchors of the texts of one chunk; of copies only the first takes part."""

    def __init__(self, rows: pa.RecordBatch, answers: Answers, length: int):
        says = answers.get(0, {})
        self.copied = np.array([i in says for i in range(rows.num_rows)], bool)
        part = np.array([says.get(i, b"first") == b"first" for i in range(rows.num_rows)], bool)
        self.flat, at = flat_bytes(rows.column("text"))
        self.begin, self.size = at[:-1], np.diff(at)
        if not part.all():
            self.read = np.concatenate([self.flat[a:b] for a, b, ok in zip(at, at[1:], part) if ok] or [self.flat[:0]])
        else:
            self.read = self.flat
        end = np.cumsum(np.where(part, self.size, 0))
        self.shift = np.where(part, end - self.size, -1)  # place of each text in `read`
        self.p, self.lo, self.hi = anchors(self.read, end, length)
        self.gram = np.zeros(len(self.p), np.uint64)
        if len(self.p):
            words = np.ascontiguousarray(self.read[self.p[:, None] + np.arange(GRAM)]).view(np.uint64)
            for j in range(words.shape[1]):
                self.gram = (self.gram ^ words[:, j]) * _M
                self.gram ^= self.gram >> np.uint64(29)
            self.gram = mix64(self.gram)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor strings, and whether the chunk has several of one."""
        name, count = np.unique(self.gram, return_counts=True)
        return name, count > 1

    def leading(self, which: np.ndarray) -> np.ndarray:
        """The first bytes of the suffixes at these anchors."""
        if not len(which):
            return np.zeros(0, f"S{_LEAD}")
        return np.ascontiguousarray(self.read[self.p[which][:, None] + np.arange(_LEAD)]).view(f"S{_LEAD}").ravel()


def multikey_order(suffix: np.ndarray) -> np.ndarray:
    """Order of byte rows: sorted eight bytes at a time, within the groups that are still equal."""
    keys = np.ascontiguousarray(suffix).view(">u8").astype(np.uint64)
    order = np.argsort(keys[:, 0], kind="stable")
    group = np.cumsum(np.r_[True, keys[order[1:], 0] != keys[order[:-1], 0]])
    for j in range(1, keys.shape[1]):
        same = np.r_[group[1:] == group[:-1], False]
        open_ = np.flatnonzero(same | np.r_[False, same[:-1]])
        if not len(open_):
            break
        k = keys[order[open_], j]
        by = np.lexsort((k, group[open_]))
        order[open_], k = order[open_[by]], k[by]
        cut = np.r_[False, (k[1:] != k[:-1]) & (group[open_[1:]] == group[open_[:-1]])]
        new = np.zeros(len(group), np.int64)
        new[open_] = cut
        group = group + np.cumsum(new)
    return order


def common_lengths(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the row before it (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    for a in range(1, len(rows), 1 << 15):
        b = min(len(rows), a + (1 << 15))
        differ = rows[a:b] != rows[a - 1:b - 1]
        out[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def _message(left: np.ndarray, windows: np.ndarray, several: np.ndarray, context: list[bytes]) -> bytes:
    head = np.array([len(left)], "<i8").tobytes()
    return pack(head + left.astype("<u2").tobytes() + windows.astype("<u2").tobytes()
                + several.astype(np.uint8).tobytes() + b"".join(context))


def repeated_windows(messages: list[bytes], length: int) -> list[bytes]:
    """One bucket: for each window of each suffix of each message, whether it repeats."""
    left, windows, several, body = [], [], [], []
    for m in messages:
        raw = unpack(m)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        left.append(np.frombuffer(raw, "<u2", n, 8).astype(np.int64))
        windows.append(np.frombuffer(raw, "<u2", n, 8 + 2 * n).astype(np.int64))
        several.append(np.frombuffer(raw, np.uint8, n, 8 + 4 * n).astype(bool))
        body.append(np.frombuffer(raw, np.uint8, -1, 8 + 5 * n))
    count = [len(x) for x in left]
    left, windows, several, body = map(np.concatenate, (left, windows, several, body))
    n, size = len(left), windows + length - 1
    at = np.cumsum(size) - size
    wide = -(-length // 8) * 8
    suffix, column = np.zeros((n, wide), np.uint8), np.arange(length)
    reach = left.max() + 1
    before = np.zeros((n, reach), np.uint8)  # bytes before the anchor, nearest first
    for a in range(0, n, 1 << 14):
        s = slice(a, min(n, a + (1 << 14)))
        have = size[s] - left[s]
        suffix[s, :length] = np.where(column < have[:, None], body[np.minimum((at[s] + left[s])[:, None] + column, len(body) - 1)], 0)
        back = np.arange(reach)
        before[s] = body[np.maximum((at[s] + left[s] - 1)[:, None] - back, 0)]
    order = multikey_order(suffix)
    common = common_lengths(suffix[order])
    del suffix
    left_o, windows_o = left[order], windows[order]
    out = np.zeros(int(windows.sum()), bool)
    place = (np.cumsum(windows) - windows)[order]
    h = np.zeros(n, np.uint64)  # of the a bytes before the anchor
    before = before[order]
    for a in range(reach):
        if a:
            h = (h ^ before[:, a - 1] + np.uint64(a)) * _M
            h ^= h >> np.uint64(29)
        rows = np.flatnonzero((a <= left_o) & (a > left_o - windows_o))
        if not len(rows):
            continue
        node = np.cumsum(common < length - a)[rows]
        key = mix64(h[rows] + node.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        by = np.argsort(key, kind="stable")
        k = key[by]
        same = k[1:] == k[:-1]
        hit = rows[by[np.r_[same, False] | np.r_[False, same]]]
        out[place[hit] + left_o[hit] - a] = True
    out |= np.repeat(several, windows)
    ends = np.cumsum([int(x.sum()) for x in np.split(windows, np.cumsum(count)[:-1])])
    return [pack_bits(f) for f in np.split(out, ends[:-1])]


def asked_windows(raw: bytes, start: np.ndarray, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct window hashes in byte order, their buckets, whether several windows
    have one, and the place in them of each window that begins at ``start``."""
    digest = np.array([xxhash.xxh3_128_digest(raw[a:a + length]) for a in start.tolist()], "S16")
    value, which, count = np.unique(digest, return_inverse=True, return_counts=True)
    lead = np.frombuffer(value.tobytes(), ">u8")[::2].astype(np.uint64)
    return value, bucket_of(lead, buckets), count > 1, which


def windows_of_others(messages: list[bytes]) -> list[bytes]:
    """For each message a bit per window hash: whether another message has it too."""
    values = [np.frombuffer(unpack(m), "S16") for m in messages]
    every = np.sort(np.concatenate(values))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    return [pack_bits(np.isin(v, twice, assume_unique=True)) for v in values]


def hot_leads(counted: DataFrame) -> np.ndarray:
    """Leading bytes that begin HOT_ROWS anchors or more, from the counted ones of all chunks."""
    lead = F.explode(F.transform(F.sequence(F.lit(0), F.expr(f"length(message) div {_LEAD}") - 1),
                                 lambda i: F.substring(F.col("message"), i * _LEAD + 1, F.lit(_LEAD))))
    rows = (counted.select(lead.alias("lead")).groupBy("lead").agg(F.count("*").alias("n"))
            .where(F.col("n") >= max(2, HOT_ROWS * HOT_SHARE)).select("lead").collect())
    return np.sort(np.array([bytes(r.lead) for r in rows], f"S{_LEAD}"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with ``kept`` (bytes) for ``text``, ``n_bytes`` and ``spans`` (starts and ends of what was removed)."""
    docs = docs.drop("kept", "n_bytes", "spans")  # the new columns take these names
    names = [f"c{i}" for i in range(len(docs.columns))]  # so that no column clashes
    given = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    rest = [n for n in names if n != text]
    chunks = chunked(given.select(F.lit(0).cast("long").alias("id"), text_bytes(text).alias("text"), *rest))
    total = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    share, hot_share = max(SAMPLE, PER_BUCKET * buckets) / max(1, total // 80), HOT_SHARE
    copies = staged(whole_copies(chunks), "copies")

    def ask_names(rows: pa.RecordBatch, answers: Answers) -> pa.Table:
        c = Chunk(rows, answers, length)
        name, _ = c.names()  # also those it has several times: others ask for them
        out = ask_values(name, buckets)
        counted = sampled_places(len(c.p), c.read, hot_share)
        if len(counted):
            out.append((_COUNTED, c.leading(counted).tobytes()))
        chosen = sampled_places(len(c.p), c.read[::-1], share)  # by another hash than the counted ones
        if len(chosen):
            out.append((_SAMPLED, c.leading(chosen).tobytes()))
        return asked(out)

    round1 = staged(each_chunk(chunks, copies, ask_names, ASKED, keep="chunk"), "anchors")
    sample = np.sort(np.frombuffer(collected(round1, _SAMPLED), f"S{_LEAD}"))
    splitters = sample[[len(sample) * i // buckets for i in range(1, buckets)]] if len(sample) else sample
    hot = hot_leads(round1.where(F.col("bucket") == _COUNTED))
    known = copies.unionByName(staged(answer_each(round1.where("bucket >= 0"), 1, held_by_others), "known"))

    def suffixes(rows: pa.RecordBatch, answers: Answers):
        """The distinct suffixes of a chunk at repeated anchors, by bucket, and the windows of hot leads."""
        c = Chunk(rows, answers, length)
        name, several = c.names()
        again = several | answered_values(name, buckets, answers.get(1, {}))
        runs = np.flatnonzero(np.isin(c.gram, name[again]))
        raw = c.read.tobytes()
        is_hot = np.isin(c.leading(runs), hot)
        asks, runs = runs[is_hot], runs[~is_hot]
        own = c.hi[asks] - c.lo[asks] + 1
        start = np.repeat(c.lo[asks] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
        index: dict[bytes, int] = {}
        which = np.empty(len(runs), np.int64)
        for i, (p, lo, hi) in enumerate(zip(c.p[runs].tolist(), c.lo[runs].tolist(), c.hi[runs].tolist())):
            digest = xxhash.xxh3_128_digest(raw[lo:hi + length], p - lo)
            which[i] = index.setdefault(digest, len(index))
        first = np.unique(which, return_index=True)[1]
        bucket = np.searchsorted(splitters, c.leading(runs[first]), "right")
        by = np.argsort(bucket, kind="stable")
        return c, raw, runs, which, first, bucket[by], by, start

    def ask_suffixes(rows: pa.RecordBatch, answers: Answers) -> pa.Table:
        c, raw, runs, which, first, bucket, by, start = suffixes(rows, answers)
        several = np.bincount(which, minlength=len(first)) > 1
        out = []
        for b, s in split_by(bucket):
            r = runs[first[by[s]]]
            out.append((b, _message(c.p[r] - c.lo[r], c.hi[r] - c.lo[r] + 1, several[by[s]],
                                    [raw[lo:hi + length] for lo, hi in zip(c.lo[r].tolist(), c.hi[r].tolist())])))
        value, bucket, _, _ = asked_windows(raw, start, length, buckets)
        out += [(buckets + b, pack(value[s].tobytes())) for b, s in split_by(bucket)]
        return asked(out)

    def reply(bucket: int, messages: list[bytes]) -> list[bytes]:
        return repeated_windows(messages, length) if bucket < buckets else windows_of_others(messages)

    round2 = each_chunk(chunks, known, ask_suffixes, ASKED, keep="chunk")
    found = known.unionByName(answer_each(round2, 2, reply, by_bucket=True))

    def drop_bytes(rows: pa.RecordBatch, answers: Answers) -> pa.Table:
        c, raw, runs, which, first, bucket, by, asks = suffixes(rows, answers)
        windows = c.hi[runs] - c.lo[runs] + 1
        own = windows[first]  # of each distinct suffix
        flags = np.zeros(int(own.sum()), bool)
        place = np.cumsum(own) - own
        for b, s in split_by(bucket):
            mine = by[s]
            bits = unpack_bits(answers[2][b], int(own[mine].sum()))
            at = np.repeat(place[mine] - (np.cumsum(own[mine]) - own[mine]), own[mine]) + np.arange(len(bits))
            flags[at] = bits
        inside = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        hit = flags[np.repeat(place[which], windows) + inside]
        value, bucket, repeated, mine = asked_windows(raw, asks, length, buckets)
        for b, s in split_by(bucket):
            repeated[s] |= unpack_bits(answers[2][buckets + b], s.stop - s.start)
        start = np.r_[(np.repeat(c.lo[runs], windows) + inside)[hit], asks[repeated[mine]]]
        edge = np.bincount(start, minlength=len(c.read) + 1) - np.bincount(start + length, minlength=len(c.read) + 1)
        gone = np.cumsum(edge[:-1]) > 0
        kept, spans = [], []
        for i, (a, n, at, copied) in enumerate(zip(c.begin, c.size, c.shift, c.copied)):
            text = c.flat[a:a + n]
            if copied and n >= length:
                g = np.ones(n, bool)
            elif at >= 0:
                g = gone[at:at + n]
            else:
                g = np.zeros(n, bool)
            change = np.flatnonzero(np.diff(np.r_[0, g.astype(np.int8), 0]))
            kept.append(text[~g].tobytes())
            spans.append(change.tolist())
        out = pa.Table.from_batches([rows.drop_columns(["id", "text"])])
        return (out.append_column("kept", pa.array(kept, pa.binary()))
                .append_column("n_bytes", pa.array(c.size.astype(np.int64)))
                .append_column("spans", pa.array(spans, pa.list_(pa.int64()))))

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in given.schema if f.name != text]
                       + ["kept binary, n_bytes long, spans array<long>"])
    out = each_chunk(chunks, found, drop_bytes, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns) if n != text], "kept", "n_bytes", "spans")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """The contract of op8."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
