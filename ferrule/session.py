"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins/partition counts from runtime sizes, skew-join
# splits oversized shuffle partitions, and the session time zone pins date arithmetic.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # materialised intermediates (the reports' temp tables) are deleted once unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ferrule", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset so spark-submit decides; ``shuffle_partitions`` should be
    sized so one shuffle partition is ~128-256 MB at the target data volume (AQE coalesces down).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object-store) folder there.  Only a local-mode session without
    one (tests) gets an invented folder; on a cluster a missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder would lose the checkpoints with the executor that wrote them
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared (HDFS/object-store) folder")
        d = tempfile.mkdtemp(prefix="ferrule-ckpt-", dir=os.environ.get("FERRULE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
