"""Dated snapshot scans: ``<root>/<yyyy-MM-dd>/<file>`` with declared schemas."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .schemas import DATASETS, FILE_NAMES, SCHEMAS


# CSV values keep their surrounding spaces both ways (Spark's CSV writer trims
# them by default); cleaning, not the file format, decides what to trim.
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _date_text(ingest_date) -> str:
    if isinstance(ingest_date, (dt.date, dt.datetime)):
        return ingest_date.strftime("%Y-%m-%d")
    return dt.date.fromisoformat(str(ingest_date)).isoformat()


def snapshot_dir(root: str, ingest_date) -> str:
    return f"{root.rstrip('/')}/{_date_text(ingest_date)}"


def snapshot_path(root: str, name: str, ingest_date) -> str:
    return f"{root.rstrip('/')}/{_date_text(ingest_date)}/{FILE_NAMES[name]}"


_BAD = "_malformed_line"


def _csv_lines(spark: SparkSession, root: str, name: str, ingest_date, malformed: bool) -> DataFrame:
    """The declared columns, and the line itself where it does not parse, of the
    lines that do not (or do) parse."""
    declared = SCHEMAS[name]
    lines = (spark.read.schema(StructType([*declared.fields, StructField(_BAD, StringType())]))
             .option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
             .options(**_KEEP_SPACES).csv(snapshot_path(root, name, ingest_date)))
    # The reader parses only the columns that a query needs, and calls a line
    # malformed by those alone.  A test that reads all columns (and is always
    # true) makes that the same for every query.
    whole = F.hash(*declared.names) >= -(1 << 31)
    return lines.where(whole & (F.col(_BAD).isNotNull() if malformed else F.col(_BAD).isNull()))


def read_dataset(spark: SparkSession, root: str, name: str, ingest_date,
                 fmt: str = "csv") -> DataFrame:
    """Scan one dataset of the snapshot taken on ``ingest_date``.

    The schema is declared, never inferred; CSV has a header row.  The date
    selects the folder, so a scan reads exactly one day's files.  CSV lines
    that do not parse are left out here, whatever columns a query reads;
    ``malformed_lines`` has them.
    """
    path = snapshot_path(root, name, ingest_date)
    reader = spark.read.schema(SCHEMAS[name])
    if fmt == "csv":
        return _csv_lines(spark, root, name, ingest_date, malformed=False).drop(_BAD)
    if fmt == "parquet":
        return reader.parquet(path)
    raise ValueError(f"unsupported snapshot format: {fmt!r}")


def malformed_lines(spark: SparkSession, root: str, name: str, ingest_date) -> DataFrame:
    """``dataset, file, line`` of the CSV lines that do not parse: a value that
    is not of its column's type, or too few or too many values."""
    return (_csv_lines(spark, root, name, ingest_date, malformed=True)
            .select(F.lit(name).alias("dataset"), F.col("_metadata.file_path").alias("file"), F.col(_BAD).alias("line")))


def header_mismatches(spark: SparkSession, root: str, name: str, ingest_date) -> DataFrame:
    """``dataset, file, header, expected`` of the CSV files whose first line is
    not the declared header (columns are read by position, so a renamed or
    moved column would otherwise go unnoticed).

    One pass over the lines as text; a file's first line is the one with the
    least row number of the block that starts the file."""
    expected = ",".join(SCHEMAS[name].names)
    lines = (spark.read.text(snapshot_path(root, name, ingest_date))
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
             .where("start = 0"))
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    return (first.where(~F.col("header").eqNullSafe(F.lit(expected)))
            .select(F.lit(name).alias("dataset"), "file", "header", F.lit(expected).alias("expected")))


def landing_violations(spark: SparkSession, root: str, ingest_date, names=None) -> DataFrame:
    """``rule, violations`` of the delivered CSV files: ``malformed:<dataset>``
    lines and ``header:<dataset>`` files, every dataset by partial counts."""
    frames = []
    for name in names or DATASETS:
        for rule, found in (("malformed", malformed_lines), ("header", header_mismatches)):
            frames.append(found(spark, root, name, ingest_date).agg(F.count(F.lit(1)).alias("violations"))
                          .select(F.lit(f"{rule}:{name}").alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, frames)


def stamp_ingest_date(df: DataFrame, ingest_date, column: str = "file_received_date") -> DataFrame:
    """Tag every row with the snapshot date it was delivered in (typed date)."""
    return df.withColumn(column, F.lit(_date_text(ingest_date)).cast("date"))


def write_snapshot(df: DataFrame, root: str, name: str, ingest_date,
                   fmt: str = "csv") -> str:
    """Land a dataset as one dated snapshot folder (overwrites that day only)."""
    path = snapshot_path(root, name, ingest_date)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").options(**_KEEP_SPACES).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported snapshot format: {fmt!r}")
    return path
