"""The daily snapshot load as a Structured Streaming file source.

Batch loads read one dated folder (``sources.scan.read_dataset``).  The
same landing layout, ``<root>/<yyyy-MM-dd>/<file>``, can be followed as a
stream: each new day's files become a micro-batch, the snapshot date comes
from the folder name, and the row-level cleaning (flags, bands, gaps,
region labels) is applied per batch.  Operators that need a whole snapshot
(dedup survivors, imputation by group, modes) stay in the batch path.

Checkpoints and sink live in the shared folder (``spark.checkpoint.dir``),
so a restarted query resumes where it stopped after an executor or driver
loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean
from ..session import shared_path
from ..sources.schemas import FILE_NAMES, SCHEMAS

_DATE_IN_PATH = r"/(\d{4}-\d{2}-\d{2})/"

def stream_dataset(spark: SparkSession, root: str, name: str, fmt: str = "csv",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream every dated snapshot of ``name`` under ``root`` with the
    declared schema; ``file_received_date`` is taken from the folder."""
    reader = spark.readStream.schema(SCHEMAS[name])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = f"{root.rstrip('/')}/*/{FILE_NAMES[name]}"
    if fmt == "csv":
        df = reader.option("header", "true").csv(path)
    elif fmt == "parquet":
        df = reader.parquet(path)
    else:
        raise ValueError(f"unsupported snapshot format: {fmt!r}")
    day = F.regexp_extract(F.col("_metadata.file_path"), _DATE_IN_PATH, 1)
    return df.withColumn("file_received_date", F.to_date(day))


def start_snapshot_load(spark: SparkSession, root: str, name: str, sink: str | None = None,
                        fmt: str = "csv", available_now: bool = True,
                        checkpoint: str | None = None) -> StreamingQuery:
    """Append the cleaned rows of every new snapshot to a Parquet table
    partitioned by snapshot date.  ``available_now`` processes what has
    landed and stops (a scheduled daily run); otherwise it keeps polling."""
    sink = sink or shared_path(spark, "tillwise-stream", name, "table")
    # one checkpoint per sink: it records which snapshot files were loaded
    checkpoint = checkpoint or f"{sink.rstrip('/')}/_checkpoint"
    writer = (clean.clean_rows(stream_dataset(spark, root, name, fmt), name)
              .writeStream.format("parquet")
              .option("path", sink)
              .option("checkpointLocation", checkpoint)
              .partitionBy("file_received_date")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
