"""Session helpers: one place that builds a session for tests and benches and
resolves the shared folder used for checkpoints and job outputs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and benches. On a cluster, build the session with the
    cluster's own settings instead; nothing here is required by the library."""
    builder = SparkSession.builder.master(master).appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    It is read from the session. Unset, it is an error on a cluster, where
    executors do not see the driver's disk; a local master gets a fresh folder,
    so ``Dataset.checkpoint()`` works in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared folder for one job output."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def written_out(df, *paths: str):
    """``df`` checkpointed in the shared folder, and the scratch ``paths`` that it was
    read from removed (on whatever file system they are)."""
    spark = df.sparkSession
    shared_dir(spark)
    out = df.checkpoint(eager=True)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return out
