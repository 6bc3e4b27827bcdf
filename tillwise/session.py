"""Session helpers: a tuned builder for tests/bench and the shared folder."""

from __future__ import annotations

import logging
import os
import tempfile

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Settings that matter at cluster scale as much as on local[N]:
#  - AQE re-plans joins from runtime sizes, coalesces small shuffle
#    partitions and splits skewed ones (hot store / product keys).
#  - session time zone fixed so date arithmetic is repeatable.
#  - no broadcast from static estimates (file-size guesses, compressed bytes,
#    can be far below the in-memory size); a join becomes a broadcast either
#    by an explicit hint on a dimension with a proven bound, or by AQE after
#    the side's stage has run and its real size is measured.
_DEFAULTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(master: str | None = None, app: str = "tillwise",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as given.  Only
    when the session has none and runs in local mode (tests) is a private
    folder created; a cluster session without one is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir adds a per-application uuid folder; share its parent
        return os.path.dirname(current.rstrip("/"))
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to the other executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        configured = tempfile.mkdtemp(prefix="tillwise-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/")] + [p.strip("/") for p in parts])


def scale_conf(input_bytes: int, target_partition_bytes: int = 512 << 20,
               min_partitions: int = 200, max_partitions: int | None = None) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of input.

    AQE can coalesce shuffle partitions and split skewed ones, but it never
    starts with more partitions than the initial count; 200 partitions over
    100 TB would mean half-terabyte reducers.  Start from one partition per
    ``target_partition_bytes`` of input and let AQE coalesce toward the
    advisory size.  ``max_partitions`` bounds the count where a cluster needs
    it; a warning tells when it does."""
    n = max(min_partitions, -(-int(input_bytes) // target_partition_bytes))
    if max_partitions and n > max_partitions:
        log.warning("%d shuffle partitions wanted for %d bytes, limited to %d",
                    n, input_bytes, max_partitions)
        n = max_partitions
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` from the file system's metadata (no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def apply_scale_conf(spark: SparkSession, path: str,
                     max_partitions: int | None = None) -> dict[str, str]:
    """Size the session's shuffles from the bytes of the input at ``path``."""
    conf = scale_conf(input_bytes(spark, path), max_partitions=max_partitions)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
