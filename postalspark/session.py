"""Session construction and shared scratch space.

Scratch data (lineage cuts, round-tripped files, stream checkpoints) lives
under the folder named by ``spark.checkpoint.dir``: on a cluster that is a
shared file system every executor and a restarted driver can reach. A local
folder is only chosen when the session has none configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "postalspark") -> SparkSession:
    """Local session used by tests and the bench; cluster jobs get theirs from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or os.environ.get("POSTALSPARK_MASTER", "local[8]"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("POSTALSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    configured = sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        try:
            configured = spark.conf.get(_CHECKPOINT_KEY, None)
        except Exception:  # pragma: no cover - conf not readable through SQL conf
            configured = None
    if not configured:
        app = sc.applicationId
        if app not in _LOCAL_FALLBACK:
            # A folder of this machine serves tests and the local bench; executors elsewhere can't see it.
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share (master is {sc.master})")
            _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="postalspark-ckpt-")
        configured = _LOCAL_FALLBACK[app]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder on its own file system; False when there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
