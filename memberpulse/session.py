"""SparkSession defaults and the shared scratch folder.

The operators never depend on session settings for correctness (calendar
arithmetic is zone-independent, ratios use ``try_divide``); the settings here
are for throughput: AQE with skew-join splitting and partition coalescing.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that adds a shuffle after the join:
    # a join output hash-partitioned by a hot key would otherwise feed a whole
    # hot group to one task in the operators that reuse that partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 records the Python call site of every Column call for error
    # messages (several JVM round trips per call); plan building is several
    # times faster without it.  Static: applies to sessions built here.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "memberpulse",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster, pass ``master=None`` and let ``spark-submit`` decide; size
    ``shuffle_partitions`` to the input (roughly input bytes / 128 MiB) or leave
    it to AQE's coalescing.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        # small inputs on one machine: a stage over a few MB keeps several tasks
        builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", str(256 << 10))
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Return a fresh folder under the cluster's shared checkpoint directory.

    The root is read from the session (``spark.checkpoint.dir`` or the
    SparkContext's checkpoint directory).  Only when neither is set — local
    tests — a private folder is created and registered as checkpoint dir.
    Every call returns a new, unique sub-folder, so concurrent or repeated runs
    never overwrite each other.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="memberpulse-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return os.path.join(root, "memberpulse", uuid.uuid4().hex)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder in whatever store Spark reaches it."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    fs, p = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files under ``paths``; paths that aren't there have none."""
    total = 0
    for path in paths:
        fs, p = _file_system(spark, path)
        total += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    return total


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI with its store's scheme and authority."""
    fs, p = _file_system(spark, path)
    return fs.makeQualified(p).toUri().toString()


def replace_path(spark: SparkSession, new: str, target: str) -> None:
    """Put the completely written folder ``new`` in the place of ``target``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(new), jvm.org.apache.hadoop.fs.Path(target)
    fs = dst.getFileSystem(conf)
    fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"could not move {new} to {target}")


#: What Spark's default of 200 shuffle partitions holds at the target size.
DEFAULT_SHUFFLE_BYTES = 200 * (256 << 20)


def sizing_conf(size: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for an input of ``size`` bytes (pass to ``get_session(conf=...)`` or set on a session).

    * scan splits of ``target_partition_bytes`` (columnar input decoded to a few
      times its size still fits an executor core's memory share);
    * initial shuffle partitions = input / target (floored at 200), which
      AQE then coalesces to ``target_partition_bytes`` per reducer — the
      aggregates here combine map-side, so shuffles are usually far smaller;
    * skew handling triggers for partitions over twice the target.

    At 100 TB this gives ~400k scan tasks and as many initial shuffle partitions,
    coalesced at run time.
    """
    shuffle = max(200, -(-size // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        # coalesce towards the advisory size (with the default "parallelism first"
        # AQE ignores it and only merges partitions below the minimum size)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }
