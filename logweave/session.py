"""Session helpers.

The library reads the session's settings and never overrides cluster
configuration; ``get_session`` is only a convenience for tests and local runs.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Applications that already have the package: their workers can import it.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` does.

    Functions that run in Python workers are pickled by reference; a worker started
    in another folder, or on another machine, must be able to import their module.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="logweave-pkg-"), "logweave.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def get_session(
    master: str = "local[*]", shuffle_partitions: int = 8, app: str = "logweave", driver_memory: str = "12g"
) -> SparkSession:
    """Local session for tests and the benchmark (in local mode the driver JVM is the executor)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Session windows merge map-side first, so a hot request id does not bring all its rows to one task.
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    Uses ``spark.checkpoint.dir`` (the shared folder a cluster names) when it is
    set. Only a local-mode session without that setting (tests, laptops) gets a
    fresh temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster[...] has executors of its own
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS, S3, ...) "
            "so that checkpointed stages survive executor loss"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="logweave-ckpt-"))
    return sc.getCheckpointDir()
