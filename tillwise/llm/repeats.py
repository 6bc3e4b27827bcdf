"""Rounds over chunks of documents, for operators that look for repeats.

Documents are packed once into chunks of a few MB (compressed Arrow) in a
table bucketed by chunk, so no later round shuffles a text.  In a round each
chunk computes what it has to ask, sends it in one packed message per
bucket, and each bucket answers every chunk in the order of its message, one
bit or more per question.  A chunk asks for a value once, however often it
holds it, so a passage in a third of all documents is one question per
chunk.  Questions are recomputed from the text when the answers come; every
step is a function of its input alone, so lost tasks can run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import flat_bytes, give_back, mix64, rows_of

CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 48 << 20  # text per bucket, on average
PER_BUCKET = 4  # sampled strings per bucket at least, about
NULL_ID = -(1 << 63)

ASKED = "chunk long, bucket long, message binary"
ANSWERED = "chunk long, kind int, bucket long, message binary"


def pack(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def pack_rising(x: np.ndarray) -> bytes:
    """Sorted uint64 values as byte planes of their differences."""
    d = np.diff(x, prepend=np.uint64(0))
    return pack(d.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_rising(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_bits(flags: np.ndarray) -> bytes:
    return pack(np.packbits(flags).tobytes())


def unpack_bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(unpack(raw), np.uint8), count=n).astype(bool)


def chunked(docs: DataFrame) -> DataFrame:
    """``chunk, data, size``: all rows of ``docs`` (with ``doc_id`` and binary ``text``, no nulls there).

    Written in the shared folder, bucketed by chunk."""
    spark = docs.sparkSession

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for k, rows in enumerate(rows_of(batches, CHUNK_BYTES, "text")):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                out.write_batch(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([first + k]), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                 pa.array([len(rows.column("text").buffers()[2] or b"")], pa.int64())], names=["chunk", "data", "size"])

    name = f"llm_chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (docs.mapInArrow(per_partition, "chunk long, data binary, size long")
     .write.bucketBy(buckets, "chunk").option("compression", "uncompressed")
     .option("path", shared_path(spark, "llm", name)).saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are outside the warehouse
    return table


def opened(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_next_batch()


Answers = dict[int, dict[int, bytes]]  # kind -> bucket -> message


def each_chunk(chunks: DataFrame, answers: DataFrame | None, work: Callable[[pa.RecordBatch, Answers], pa.Table],
               schema: str, keep: str | None = None) -> DataFrame:
    """Run ``work`` on every chunk with its answers; ``keep`` names a column that gets the chunk id."""
    def tagged(chunk: int, out: pa.Table) -> pa.Table:
        return out.add_column(0, keep, pa.array([chunk] * out.num_rows, pa.int64())) if keep else out

    if answers is None:
        def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for chunk, data in zip(b.column("chunk").to_pylist(), b.column("data")):
                    yield from tagged(chunk, work(opened(data.as_py()), {})).to_batches()
                    give_back()

        return chunks.select("chunk", "data").mapInArrow(per_batch, schema)

    def per_chunk(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        got: Answers = {}
        for kind, bucket, message in zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "message"))):
            got.setdefault(kind, {})[bucket] = message
        parts = [tagged(key[0].as_py(), work(opened(d.as_py()), got)) for d in left.column("data")]
        give_back()
        return pa.concat_tables(parts)

    return (chunks.select("chunk", "data").groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(per_chunk, schema))


def asked(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()),
                     "message": pa.array([r[1] for r in rows], pa.binary())})


def answer_each(questions: DataFrame, kind: int, reply: Callable[..., list[bytes]], by_bucket: bool = False) -> DataFrame:
    """Answer all messages of a bucket together: one reply per message.

    With ``by_bucket``, ``reply`` takes the bucket before the messages."""
    def per_bucket(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("chunk").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        messages = table.column("message").to_pylist()
        out = reply(key[0].as_py(), messages) if by_bucket else reply(messages)
        n = table.num_rows
        return pa.table({"chunk": table.column("chunk"), "kind": pa.array([kind] * n, pa.int32()),
                         "bucket": table.column("bucket"), "message": pa.array(out, pa.binary())})

    return questions.groupBy("bucket").applyInArrow(per_bucket, ANSWERED)


def bucket_of(x: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hash space (rising values give rising buckets)."""
    return ((x >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def split_by(buckets: np.ndarray) -> list[tuple[int, slice]]:
    """(bucket, slice) of a rising bucket array."""
    at = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else np.zeros(0, np.int64)
    return [(int(buckets[a]), slice(int(a), int(b))) for a, b in zip(at, [*at[1:], len(buckets)])]


def ask_values(values: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """Messages that ask whether another chunk holds these values (sorted, distinct)."""
    return [(b, pack_rising(values[s])) for b, s in split_by(bucket_of(values, buckets))]


def held_by_others(messages: list[bytes]) -> list[bytes]:
    """For each message a bit per value: whether another message has it too."""
    values = [unpack_rising(m) for m in messages]
    every = np.concatenate(values)
    every.sort()  # in place: a bucket holds 8 bytes a distinct name of 48 MB of text
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    return [pack_bits(np.isin(v, twice, assume_unique=True)) for v in values]


def answered_values(values: np.ndarray, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
    """The answers to :func:`ask_values`, one flag per value."""
    out = np.zeros(len(values), bool)
    for b, s in split_by(bucket_of(values, buckets)):
        out[s] = unpack_bits(answers[b], s.stop - s.start)
    return out


def sampled_places(n: int, data: np.ndarray, share: float) -> np.ndarray:
    """Places below ``n``, each with probability ``share``, by a hash of the chunk's ``data`` and the place.

    So a sample of all chunks follows the share however short the chunks are."""
    seed = np.uint64(xxhash.xxh3_64_intdigest(np.ascontiguousarray(data)))
    h = mix64((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ seed)
    return np.flatnonzero((h >> np.uint64(11)).astype(float) < share * 2.0 ** 53)


def collected(questions: DataFrame, bucket: int) -> bytes:
    """The messages of one bucket, joined, on the driver (as Arrow: a message may be a few bytes)."""
    column = questions.where(F.col("bucket") == bucket).select("message").toArrow().column("message")
    return b"".join(flat_bytes(c)[0].tobytes() for c in column.chunks)


def whole_copies(chunks: DataFrame) -> DataFrame:
    """Answers of kind 0 about rows with equal texts: bucket is the row's place in
    its chunk, the message says ``first`` (the smallest id and place), ``same``
    (a copy under that id) or ``copy`` (under a greater id)."""
    def work(rows: pa.RecordBatch, _: Answers) -> pa.Table:
        digest = [xxhash.xxh3_128_digest(t) for t in rows.column("text").to_pylist()]
        return pa.table({"place": pa.array(np.arange(rows.num_rows)), "id": rows.column("id"),
                         "digest": pa.array(digest, pa.binary())})

    from .common import staged

    rows = staged(each_chunk(chunks, None, work, "chunk long, place long, id long, digest binary", keep="chunk"), "digests")
    groups = (rows.groupBy("digest").agg(F.min(F.struct("id", "chunk", "place")).alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "first"))
    says = (F.when((F.col("chunk") == F.col("first.chunk")) & (F.col("place") == F.col("first.place")), "first")
            .when(F.col("id") == F.col("first.id"), "same").otherwise("copy"))
    return rows.join(groups, "digest").select("chunk", F.lit(0).alias("kind"), F.col("place").alias("bucket"),
                                              says.cast("binary").alias("message"))
