"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that every job in this package assumes.  AQE re-plans joins and
# coalesces partitions at runtime, and splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # streaming state lives in RocksDB on local disk (checkpointed), not on
    # the JVM heap: per-key state of millions of keys survives
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions start at input / target size (AQE coalesces small
    ones and splits skewed ones at runtime), never below twice the cores;
    input splits are ``target_partition_bytes``; broadcasts stay under
    64 MiB so every executor can hold a few at once."""
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str | None = None, app: str = "oreflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only in local mode (one machine, as in tests) may it be unset: a private
    folder is created and registered then.  On a cluster that is an error, as
    other executors could not read such a folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not d and (master.startswith("local-cluster") or not master.startswith("local")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="oreflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for materialised
    intermediate tables (lineage cuts, staged rewrites)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``oreflow`` importable in the Python workers of this session
    (what ``spark-submit --py-files`` does): zip the package once and
    ``addPyFile`` it.  Functions used in Arrow/pandas tasks are pickled by
    module reference, so workers must be able to import the package."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import zipfile
    import oreflow
    pkg_dir = os.path.dirname(os.path.abspath(oreflow.__file__))
    base = spark.conf.get("spark.checkpoint.dir", None) or ""
    local_base = base[len("file:"):] if base.startswith("file:") else base
    if not local_base.startswith("/"):
        local_base = tempfile.gettempdir()   # staging file for distribution only
    os.makedirs(local_base, exist_ok=True)
    target = os.path.join(local_base, f"oreflow-pkg-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(target)
    _SHIPPED.add(key)
