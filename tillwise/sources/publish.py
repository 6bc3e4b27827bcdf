"""Publication of a run's tables as one: write beside, then switch.

``<out>/runs/<id>/<key>`` holds the tables of one run.  ``<out>/CURRENT`` is a
small file with the id of the run that readers see; it is replaced by a single
rename, which the file systems of a cluster do atomically.  So readers find all
tables of one run or all of another, and a run that ends half-way is never seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CURRENT = "CURRENT"


def _files(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(conf), conf


class Publication:
    """One run's tables under ``out``."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out, self.run = spark, out.rstrip("/"), uuid.uuid4().hex

    def path(self, key: str) -> str:
        return f"{self.out}/runs/{self.run}/{key}"

    def publish(self) -> None:
        """Make this run the current one.  Call it when all tables are written."""
        jvm, fs, conf = _files(self.spark, self.out)
        new = jvm.org.apache.hadoop.fs.Path(f"{self.out}/{_CURRENT}.{self.run}")
        stream = fs.create(new, True)
        try:
            stream.write(self.run.encode())
        finally:
            stream.close()
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        new = fs.makeQualified(new)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf).rename(
            new, fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{self.out}/{_CURRENT}")), overwrite)


def current_run(spark: SparkSession, out: str) -> str | None:
    """The id of the published run, or None before the first."""
    jvm, fs, _ = _files(spark, out)
    at = jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/{_CURRENT}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_published(spark: SparkSession, out: str, key: str, fmt: str = "parquet") -> DataFrame:
    """A table of the published run."""
    run = current_run(spark, out)
    if run is None:
        raise FileNotFoundError(f"nothing has been published under {out}")
    return spark.read.format(fmt).option("header", "true").load(f"{out.rstrip('/')}/runs/{run}/{key}")
