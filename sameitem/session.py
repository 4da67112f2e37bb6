"""Spark session helpers.

The cluster names a shared checkpoint folder in ``spark.checkpoint.dir``;
we read it from the session and only fall back to a scratch folder when it
is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Runtime settings every job of this package relies on (set on the active
# session, so they also apply to a session the caller built).
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Local runs only: the driver JVM is the executor, so give it the heap.
LOCAL_CONF = {
    "spark.driver.memory": os.environ.get("SAMEITEM_DRIVER_MEMORY", "8g"),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sameitem", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; only when it is
    unset (local runs, tests) a fresh scratch folder is created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - conf not visible in this mode
            configured = None
    if not configured:
        # Only a local master may fall back: its driver and tasks see one disk.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="sameitem-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage like a checkpoint, but readers prune columns, push filters
    down and see sizes.  A lost executor costs no more than its running tasks.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, held: bool = False) -> DataFrame:
    """Deal a table of fewer splits than cores over all cores, for CPU-bound work on its rows.

    A file of one row group is one task however large it is; a table that has as
    many splits as cores is returned as it is, without an exchange.  ``held``: the dealt
    rows are staged, as Spark moves later filters, with all that they compute, below an exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > cores:
        return df
    dealt = df.repartition(cores)
    return stage(dealt, "dealt") if held else dealt


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per Spark context.

    Spark's file server hands the archive to every executor, also to those
    that replace lost ones, so nothing has to be installed on them.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_sameitem_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="sameitem-src-")
    archive = os.path.join(folder, "sameitem-src.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._sameitem_shipped = True
