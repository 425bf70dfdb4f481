"""SparkSession construction and cluster-aware settings.

On a cluster the session already exists and is configured by the platform;
`configure` only fills in settings that are unset, so cluster values for
`spark.sql.shuffle.partitions` or `spark.checkpoint.dir` always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every marketlake job relies on.  Values are defaults only: they are
# applied where the session does not already define the key.
_DEFAULTS = {
    # Naive timestamps everywhere; UTC keeps date arithmetic zone-free.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Adaptive execution: coalesce small shuffle partitions, split skewed join
    # partitions, and turn shuffled joins into broadcast joins when the
    # measured (not estimated) build side is below the session's
    # spark.sql.autoBroadcastJoinThreshold (no threshold of our own: what the
    # cluster allows must hold for measured sizes too).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "16MB",
    # Tasks of the marts sort and aggregate what they read several times over: about 50 MB
    # of memory for each MB of shuffled keys.  Small splits bound a task's memory; what grows with
    # the input is the number of tasks.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
    "spark.sql.files.maxPartitionBytes": "16MB",
    # Tables hold long texts, which zstd writes about a third smaller than snappy.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Let `row_number() <= k` run as a map-side partial group limit for the
    # route sample's k (the default only covers k <= 1000).
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply marketlake defaults where the session leaves a key unset."""
    conf = spark.conf
    for key, value in _DEFAULTS.items():
        if conf.get(key, None) is None:
            conf.set(key, value)
    checkpoint_dir(spark)
    return spark


_CHECKPOINT_ROOTS: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared root folder for checkpoints and intermediate tables.

    Read from `spark.checkpoint.dir` (the cluster names a shared, fault
    tolerant folder there).  Only when it is unset, as in local tests, a
    scratch folder is created once per session.  The RDD checkpoint
    directory is registered under the root if the context has none yet
    (skipped on sessions without a local SparkContext, e.g. Spark Connect).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions expose no SparkContext
        sc = None
    key = id(sc) if sc is not None else id(spark)
    if key in _CHECKPOINT_ROOTS:
        return _CHECKPOINT_ROOTS[key]
    root = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if root is None:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001
            root = None
    if root is None and sc is not None and sc.getCheckpointDir() is not None:
        # setCheckpointDir() appends a unique subfolder; its parent is the root.
        root = os.path.dirname(sc.getCheckpointDir().rstrip("/"))
    if root is None:
        # Local runs only: a cluster always names a shared folder.
        root = tempfile.mkdtemp(prefix="marketlake-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{root.rstrip('/')}/rdd")
    _CHECKPOINT_ROOTS[key] = root
    return root


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "marketlake") -> SparkSession:
    """A local session for tests and the bench (UI off, no server ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARKETLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
