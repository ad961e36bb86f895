"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dims are joined through operators.joins, which checks sizes itself.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Partition folders hold text: dc=001 stays '001'.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Remove checkpoint files (staged ids, hot-key sets) once no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming batches run on their own JVM threads; give threads room for
    # deep expression trees and regex matching.
    "spark.driver.extraJavaOptions": "-Xss16m",
    "spark.executor.extraJavaOptions": "-Xss16m",
}


def build_session(master: str | None = None, app: str = "cdrflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from
    ``spark-submit``; only unset values fall back to the defaults here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def built_once(make):
    """Keep what ``make`` builds, column expressions, per process and arguments.

    Expressions name columns and hold no data or plan; building the larger ones
    takes thousands of calls to the JVM, which each query and micro-batch
    would repeat. A new JVM gets new ones.
    """
    made = {}

    @functools.wraps(make)
    def get(*args):
        key = (id(SparkContext._gateway), args)
        if key not in made:
            made[key] = make(*args)
        return made[key]
    return get


def text_partitions(spark: SparkSession) -> None:
    """Have ``spark`` read partition folder values as text, whoever made the session."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only when
    it is unset (local tests) a fresh local folder is taken.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="cdrflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/cdrflow/{name}-{uuid.uuid4().hex}"
