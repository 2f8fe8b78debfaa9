"""Session factory (S17) and the shared staging folder.

Settings chosen for a large cluster; tests override the master and the partition count.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# Settings every run relies on. Sizes are for a cluster; AQE coalesces small shuffles at
# test scale, so the same values are safe on local[*].
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs an extra shuffle later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcast only below a measured size (AQE measures shuffle output at run time); beyond it
    # the join is sort-merge. 16 MB x 1000 executors stays a modest fan-out.
    "spark.sql.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    # reruns replace only the partitions they write
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# On a cluster: start every shuffle wide and let AQE merge it to ~256 MB partitions. 20,000 x
# 256 MB covers a 5 TB shuffle without spilling giant partitions; small shuffles collapse to a
# few tasks. (AQE merges partitions, it never splits them, so the start must be wide.)
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def get_session(master: str | None = None, app_name: str = "regfold",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Get or create the session. ``master`` and ``shuffle_partitions`` are for local runs only."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    apply_runtime_conf(spark, conf)
    if not shuffle_partitions and not spark.sparkContext.master.startswith("local"):
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)
    return spark


def apply_runtime_conf(spark: SparkSession, conf: dict | None = None) -> None:
    """Set the SQL settings on an existing session (the driver may hand us its own) and make
    this package importable by the Python workers."""
    for k, v in (conf or BASE_CONF).items():
        if k.startswith("spark.sql.") and k != "spark.sql.shuffle.partitions":
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an already running session
                pass
    ship_package(spark)


# Spark's own switch: a query's shuffle files go when it has ended. Else they stay until the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def frees_shuffles(job: Callable) -> Callable:
    """For a job of many queries (its first argument is the session), each of which runs once: the disk holds the shuffle files of
    the queries that are running, not of all so far. A query that runs again all the same computes its lost stages anew."""

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        before = spark.conf.get(FREE_SHUFFLES, None)
        spark.conf.set(FREE_SHUFFLES, "true")
        try:
            return job(spark, *args, **kwargs)
        finally:
            if before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)

    return run


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (like ``--py-files``).

    Executor-side Python (``mapInPandas`` for archives) imports it; the zip is written into the
    shared checkpoint folder so every executor can fetch it.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import io
    import zipfile

    from regfold.sources.files import filesystem_for

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = os.path.join(ensure_checkpoint_dir(spark), "regfold-pkg", f"{key}-{uuid.uuid4().hex[:8]}", "regfold.zip")
    filesystem, p = filesystem_for(target)
    filesystem.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(p) as out:
        out.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir``; only when it is unset (local tests) a scratch folder is
    made and set. On a cluster that setting must name a shared file system.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store): "
                           "staged tables must survive lost executors")
    if not path:  # local runs and tests only
        path = tempfile.mkdtemp(prefix="regfold-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # static on some versions; setCheckpointDir below still applies
            pass
    spark.sparkContext.setCheckpointDir(path)
    return path


def staging_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's staged tables, under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "regfold", f"{name}-{uuid.uuid4().hex[:12]}")
