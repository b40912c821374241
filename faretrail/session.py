"""Session helpers: building a session for local runs and locating shared storage.

Everything that must outlive a task (staged tables, checkpoints, landing
folders written by the tests) goes under the folder the cluster names in
``spark.checkpoint.dir``.  Only a local session without that setting gets a
folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Whether a query's shuffle files go when it ends (from Spark 4.1 on; unknown before, then without effect).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "faretrail") -> SparkSession:
    """Session for tests and local benchmarks (cluster jobs bring their own).

    ``spark.checkpoint.dir`` is left to the environment; :func:`shared_dir`
    falls back to a temp folder only for a local session without one.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    if master.startswith("local") and not master.startswith("local-cluster"):
        # a cluster names its own shared warehouse
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="faretrail-wh-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for staged data.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir).  A local-mode session without one gets a fresh temp folder; a cluster
    session without one is a configuration error, because a machine-local
    folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no driver-side context (remote session)
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/object store) so staged tables survive executor loss")
    root = tempfile.mkdtemp(prefix="faretrail-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir().rstrip("/")
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused location under the shared folder."""
    return f"{shared_dir(spark)}/faretrail/{label}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a location of :func:`scratch_path`; a missing one is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of each query of ``spark`` go when the query ends; else they stay
    until the driver collects its garbage, beside all that is written meanwhile."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, was)


def unique_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:10]}"
