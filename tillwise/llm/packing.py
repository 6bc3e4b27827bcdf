"""Tokenise documents and pack them into sequences by vector best-fit.

A document is its token ids and an end id.  Only documents longer than the
window are cut: into pieces of exactly the window, the first one shorter.
Full pieces are sequences of their own.  The rest, at most one piece per
document, goes to sequences by vector best-fit decreasing: a sequence has
three capacities (tokens, documents, attention cost = sum of squared piece
lengths); an item may only go where all three hold, and of those it takes
the sequence whose residual vector after placing it has the least weighted
norm (or the greatest weighted dot product with the item's demand).

Scale: texts are read once and never shuffled; pieces of a few numbers are.
They are dealt by a hash of the row to groups of about
``group_pieces`` and each group is packed on its own, which leaves at most a
few open sequences a group.  Group count follows the number of pieces.

Null or empty text is the end id alone.  A special-token string in a text is
that token, as ``tokenizers`` has it.  Rows repeated in the input are packed
each.  Very long texts give many full pieces.  Other columns, of whatever name,
are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_bytes, rows_of, staged, text_bytes, worker_cache

WINDOW = 1024
END_ID = 2
GROUP_PIECES = 8192
MAX_DOCS, MAX_COST = WINDOW, WINDOW ** 2  # what a window of tokens implies: nothing else becomes infeasible
WEIGHTS = (1.0, 0.1, 0.1)
VOCABULARY = "byte_bpe_50k.json"

_SHORT = 64  # longer words would cost the square of their length
_LATIN_END = "\u0250"  # characters below have one class in every version of Unicode, so all libraries cut alike
# fixed value: the cuts of byte-level BPE
_CUTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def latin_encoding(tokenizer: dict):
    """The merges of a byte-level BPE as a ``tiktoken`` encoding for Latin text.

    None where ranks cannot stand for the merges: another model, another way
    to cut words, or ids that do not follow the order of the merges."""
    model, cutter = tokenizer["model"], tokenizer["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or tokenizer["normalizer"] or cutter.get("type") != "ByteLevel"
            or not cutter.get("use_regex") or cutter.get("add_prefix_space") or model.get("ignore_merges")):
        return None
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    added = {t["content"] for t in tokenizer["added_tokens"]}
    learned = {t: i for t, i in model["vocab"].items() if t not in added}
    if any(a >= b for a, b in zip(made, made[1:])) or len(learned) != 256 + len(made):
        return None
    # byte-level writing: visible Latin-1 characters are their own byte, the other bytes follow from U+0100
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in learned.items()}
    return tiktoken.Encoding("latin", pat_str=_CUTS, mergeable_ranks=ranks, special_tokens={})


class WordCache:
    """Token ids of a text through a bounded cache of its space-led words.

    Byte-level BPE never merges across a space that is followed by a visible
    character, so a text may be cut there and each word encoded once.  New
    words are encoded in one call: in their joined text, the tokens that
    begin with a space begin the words.  Short Latin words go through
    ``tiktoken``, given the merges of the same vocabulary as ranks, the others
    through ``tokenizers``; a vocabulary whose ids are not in the order of its
    merges goes through ``tokenizers`` alone."""

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        # texts that hold one of these strings are encoded whole, since the tokenizer finds them before it cuts words
        self.added = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}  # by the word without its space
        self.limit = limit
        vocab = self.encoder.get_vocab()
        self.leads = np.zeros(max(vocab.values()) + 1, bool)
        self.leads[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # the space, in this vocabulary's writing
        self.latin = latin_encoding(json.loads(self.encoder.to_str()))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        if self.latin is None:
            return self._joined(words, lambda text: self._ids([text])[0])
        short = [w for w in words if len(w) <= _SHORT and (w.isascii() or max(w) < _LATIN_END)]
        own = self._joined(short, lambda text: self.latin.encode_to_numpy(text, disallowed_special=()))
        if len(short) < len(words):
            own |= self._joined([w for w in words if w not in own], lambda text: self._ids([text])[0])
        return own

    def _joined(self, words: list[str], encode: Callable[[str], np.ndarray]) -> dict[str, bytes]:
        if not words:
            return {}
        ids = encode(" " + " ".join(words)).astype("<u4", copy=False)
        raw, at = ids.tobytes(), (4 * np.flatnonzero(self.leads[ids])).tolist()
        return dict(zip(words, [raw[i:j] for i, j in zip(at, at[1:] + [len(raw)])], strict=True))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian uint32 ids of each text, in blocks of about 2 MB."""
        at = 0
        while at < len(texts):
            size, begin = 0, at
            while at < len(texts) and (at == begin or size + len(texts[at]) <= 2 << 20):
                size += len(texts[at])
                at += 1
            yield from self._block(texts[begin:at])

    def _block(self, texts: list[str]) -> list[bytes]:
        known = self.known
        split = [t.split(" ") for t in texts]
        heads = [w.pop(0) for w in split]  # without a space before it
        found = [list(map(known.get, w)) for w in split]
        special = {i for i, t in enumerate(texts) if any(map(t.__contains__, self.added))}
        missing = {i: [k for k, f in enumerate(have) if f is None]
                   for i, have in enumerate(found) if None in have and i not in special}
        new = {split[i][k] for i, at in missing.items() for k in at}
        odd = {w for w in new if not w or w[0].isspace()}  # a run of white space is not cut
        if odd:
            special |= {i for i, at in missing.items() if any(split[i][k] in odd for k in at)}
        out = dict(zip(sorted(special), self._ids([texts[i] for i in sorted(special)])))
        own = self._words(list(new - odd))
        for i, at in missing.items():
            if i not in special:
                have, words = found[i], split[i]
                for k in at:
                    have[k] = own[words[k]]
        rest = [i for i in range(len(texts)) if i not in out]
        for i, head in zip(rest, self._ids([heads[i] for i in rest])):
            out[i] = head.tobytes() + b"".join(found[i])
        if len(known) + len(own) <= self.limit:
            known.update(own)
        return [out[i] if isinstance(out[i], bytes) else out[i].tobytes() for i in range(len(texts))]


def cut(n: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: only the first may be shorter."""
    first = n % window or window
    return [(0, first)] + [(at, window) for at in range(first, n, window)]


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``.

    ``vocabulary`` names a tokenizer file that every executor can open, or a
    file of the installed ``public_tokenizers`` package."""
    end = np.array([end_id], "<u4").tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        caches = worker_cache()
        if vocabulary not in caches:
            path = vocabulary
            if not os.path.exists(path):
                import public_tokenizers

                path = public_tokenizers.path(vocabulary)
            caches[vocabulary] = WordCache(path)
        cache = caches[vocabulary]
        for batch in rows_of(batches, 8 << 20, "text"):
            flat, at = flat_bytes(batch.column("text"))
            texts = [bytes(flat[a:b]).decode("utf-8", "replace") for a, b in zip(at, at[1:])]
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), cache.encode(texts)):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // 4, window)):
                    rows.append((doc_id, k, start, n, zlib.crc32(ids[4 * start:4 * (start + n)])))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")).mapInArrow(tokenise, _PIECES)


def best_fit(lengths: np.ndarray, tokens: int, max_docs: int | None = None, max_cost: float | None = None,
             weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item by vector best-fit decreasing.

    Demands and residuals are shares of the capacities (tokens, documents,
    cost); a capacity that is None never binds and has no part in the score.
    Items are taken by falling length (ties: input order); among feasible
    bins the best score wins (ties: the oldest bin)."""
    n = len(lengths)
    caps = np.array([tokens, max_docs or 1, max_cost or 1], float)
    use = np.array([True, max_docs is not None, max_cost is not None])
    w = np.where(use, np.array(weights), 0.0)
    left = np.empty((n, 3))  # residual capacities of the open bins, as counts
    name = np.empty(n, np.int64)
    made = active = 0
    at_bin, at_off = np.empty(n, np.int64), np.empty(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min()) if n else 0
    for step, i in enumerate(order):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        if np.any((need > caps) & use):
            raise ValueError("an item is larger than an empty sequence")
        after = left[:active] - need
        fits = np.all((after >= 0) | ~use, axis=1)
        best = -1
        if fits.any():
            share = after / caps
            score = (share ** 2 @ w) if rule == "norm" else -((left[:active] / caps) @ (w * need / caps))
            score[~fits] = np.inf
            best = int(np.argmin(score))
        if best < 0:
            left[active], name[active] = caps, made
            best, active, made = active, active + 1, made + 1
        at_bin[i], at_off[i] = name[best], int(tokens - left[best, 0])
        left[best] -= need
        if step % 64 == 63:  # bins that can take nothing more are closed
            live = (left[:active, 0] >= least) & (~use[1] | (left[:active, 1] >= 1)) & (~use[2] | (left[:active, 2] >= least ** 2))
            k = int(live.sum())
            left[:k], name[:k] = left[:active][live], name[:active][live]
            active = k
    return at_bin, at_off


def pack(rows: DataFrame, window: int = WINDOW, max_docs: int | None = None, max_cost: float | None = None,
         group_pieces: int = GROUP_PIECES, weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of at most ``window``.

    ``rows`` must be stable when read again (a written table)."""
    names = rows.columns
    rows = rows.withColumn("row_id", F.monotonically_increasing_id())
    alone = F.col("length") == window if (max_docs or 1) >= 1 and (max_cost or window ** 2) >= window ** 2 else F.lit(False)
    full = rows.where(alone).select(*names, (-1 - F.col("row_id")).alias("sequence_id"),
                                    F.lit(0).cast("long").alias("offset"))
    n_groups = -(-rows.where(~alone).count() // group_pieces) or 1
    part = rows.where(~alone).withColumn("group_id", F.pmod(F.xxhash64("row_id"), F.lit(n_groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "row_id")

    def one_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id").reset_index(drop=True)
        bins, off = best_fit(pdf["length"].to_numpy(), window, max_docs, max_cost, weights, rule)
        return pdf[names].assign(sequence_id=(int(key[0]) << 32) + bins, offset=off)

    packed = part.groupBy("group_id").applyInPandas(one_group, f"{schema}, sequence_id long, offset long")
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, max_docs: int | None = MAX_DOCS,
                   max_cost: float | None = MAX_COST, **kw) -> DataFrame:
    """The contract of op10: pieces with their sequence and place in it."""
    return pack(staged(pieces(docs, vocabulary), "pieces"), max_docs=max_docs, max_cost=max_cost, **kw)
