"""Session set-up and environment profiles.

A profile bundles the stream trigger, the per-trigger file budget and the
monitoring interval that the stream runner uses.  Unknown profile names fall back to
``development``.  Scratch space for stream checkpoints and sink output is
always taken from ``spark.checkpoint.dir`` (a shared folder on a cluster);
only a local session without that setting gets a temporary directory, any
other one is refused.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Profile:
    name: str
    trigger_interval: str
    max_files_per_trigger: int
    monitoring: bool = True
    monitoring_interval_s: int = 30
    spark_conf: dict = field(default_factory=dict)


# File-source log settings shared by every profile.
STREAM_LOG_CONF = {
    "spark.sql.streaming.fileSource.log.deletion": "true",
    "spark.sql.streaming.fileSource.log.compactInterval": "10",
    "spark.sql.streaming.fileSource.log.cleanupDelay": "2000",
}

# Trigger interval and files per trigger of each profile.
PROFILES: dict[str, Profile] = {
    "development": Profile("development", "5 seconds", 5, True, 30, spark_conf=STREAM_LOG_CONF),
    "production": Profile("production", "30 seconds", 50, True, 60, spark_conf=STREAM_LOG_CONF),
    "testing": Profile("testing", "1 second", 1, False, 30, spark_conf=STREAM_LOG_CONF),
}


def get_profile(name: str | None = "development") -> Profile:
    return PROFILES.get(name or "development", PROFILES["development"])


BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Defaults for cluster sessions (not local ones), each applied only where
# neither the caller nor the launcher set it: many shuffle partitions that
# adaptive execution coalesces to ~256 MB each, and 256 MB scan splits, so
# neither a 100 TB scan nor its shuffles overfill a task.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def _launcher_conf() -> dict[str, str]:
    """What the launcher (spark-submit, spark-defaults) has set already, which defaults don't override."""
    sc = SparkContext._active_spark_context
    return dict((sc.getConf() if sc else SparkConf()).getAll())


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
    profile: Profile | str | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` is only set when given; on a cluster the launcher decides.
    A profile adds its own Spark settings (stream file-source log handling).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {k: v for k, v in BASE_CONF.items() if k not in _launcher_conf()}
    if profile is not None:
        conf.update((profile if isinstance(profile, Profile) else get_profile(profile)).spark_conf)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not is_local_master(spark.sparkContext.master):
        launcher = spark.sparkContext.getConf()
        for k, v in CLUSTER_CONF.items():
            if k not in conf and not launcher.contains(k):
                spark.conf.set(k, v)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared scratch folder named by ``spark.checkpoint.dir``.

    A local session without the setting (tests) gets a temporary one; on a
    cluster that would be a different folder on every machine, so it is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not is_local_master(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def is_local_master(master: str) -> bool:
    """One JVM on one machine (``local``, ``local[4]``); ``local-cluster`` has executors of their own."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, unique sub-folder of the shared root for one run, made on the root's own file system."""
    path = f"{shared_root(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"
    p, fs = _fs(spark, path)
    fs.mkdirs(p)
    return path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fs_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on any Hadoop file system (local, HDFS, object stores)."""
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def fs_list(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` on any Hadoop file system."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]



def fs_delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder on any Hadoop file system."""
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, True))


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package on the Python workers' path (where it isn't installed or shipped)."""
    env = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
    return df.mapInArrow(fn, schema)
