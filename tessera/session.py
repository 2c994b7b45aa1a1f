"""Session helpers.

``get_session`` is for scripts and tests; on a cluster pass your own session.
``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session (the shared
folder the cluster names) and only falls back to a scratch folder when the
setting is absent in a local session, as in tests.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tessera") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS") or "8"
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    b = b.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    event_dir = os.environ.get("TESSERA_EVENT_LOG_DIR")
    if event_dir:  # stage/task timings for scripts/stage_times.py
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


MB = 1 << 20


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """SQL confs sized to the input: scan splits and the initial shuffle width
    grow with the data (about ``target_partition_bytes`` each), and AQE
    coalesces small shuffles back down and splits skewed ones.  Apply with
    ``spark.conf.set`` (or ``scoped_conf``) before building the plans."""
    initial = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Where it is unset, a
    local session gets a scratch folder; a cluster session gets an error,
    since the driver's own disk is no place that executors share."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return conf


def parallelism(spark: SparkSession) -> int:
    """Cores available to a job (falls back to confs where the session has no
    SparkContext handle)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        return int(spark.conf.get("spark.default.parallelism", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def session_key(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def folder_version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in ``folder`` (any file system
    that Spark reads), to tell whether it has changed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    held = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in held))


def persist(df: DataFrame) -> DataFrame:
    """Keep an iterative input across jobs; spills to disk instead of failing,
    and lost blocks are recomputed from lineage if an executor goes away."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# Shuffle files of a finished query go at once instead of at some later
# garbage collection (4.1 has the setting; other versions ignore it).
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    local checkpoint).  What was shuffled to make it is then freed: the
    checkpoint needs it no more."""
    ensure_checkpoint_dir(df.sparkSession)
    with scoped_conf(df.sparkSession, FREE_SHUFFLES):
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made under the setting


# Iterative fits run one small aggregate per step (k or d+1 partial sums per
# task); adaptive re-planning has nothing to gain there and costs a stage
# round-trip per step.
ITERATION_CONF = {"spark.sql.adaptive.enabled": "false"}


@contextmanager
def scoped_conf(spark, settings: dict[str, str]):
    """Temporarily set SQL confs, restoring the previous values afterwards."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
