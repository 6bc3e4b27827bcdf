"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

# Functions of this package travel to the executors with the job, so these
# need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# The white space of every word rule here: space and U+0009..U+000D.  It is
# also what ``bytes.split()`` splits on, so UTF-8 bytes need no regex.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(col: str = "text") -> Column:
    """UTF-8 bytes of a text column; null text is empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def id_text(col: str = "doc_id") -> Column:
    """A document id as text; null is empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def held_out(col: str = "doc_id") -> Column:
    """True for ids whose crc32 (of the id as text) is a multiple of 5."""
    return F.crc32(id_text(col).cast("binary")) % 5 == 0


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker (over its tasks)."""
    name = "tillwise_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def give_back() -> None:
    """Freed memory of this Python worker goes back to the system: an idle worker
    stays alive beside the busy ones of its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def rows_of(batches: Iterator[pa.RecordBatch], max_bytes: int, col: str,
            max_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Regroup record batches by the bytes of binary column ``col``.

    A group holds at most ``max_rows`` rows and, unless it is one long row,
    about ``max_bytes`` bytes, whatever the incoming batch size."""
    held, rows, size = [], 0, 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        at, size_of = 0, np.diff(offsets(batch.column(col)))
        ends = np.cumsum(size_of)
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = int(np.searchsorted(ends, before + max_bytes - size, "right"))
            stop = min(max(stop, at if held else at + 1), batch.num_rows, at + max_rows - rows)
            if stop > at:
                held.append(batch.slice(at, stop - at))
                rows += stop - at
                size += int(ends[stop - 1] - before)
                at = stop
            if at < batch.num_rows or rows >= max_rows or size >= max_bytes:
                yield joined()
                held, rows, size = [], 0, 0
    if held:
        yield joined()


def offsets(col: pa.Array) -> np.ndarray:
    """Byte offsets of a binary or string array (no nulls), from its own start."""
    wide = np.int64 if pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], wide)[col.offset:col.offset + len(col) + 1].astype(np.int64)


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array as uint8, and the row offsets into them."""
    at = offsets(col) if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2] if len(col) else None
    flat = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return flat, at - at[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (two multiply-xorshift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
