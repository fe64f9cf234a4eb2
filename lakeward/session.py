"""Session construction and the shared work folder.

Intermediate tables, stream checkpoints and change logs live under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared file system on a real cluster).
We only pick a folder of our own when the session has none and runs in local mode
(tests); on a cluster without the setting we refuse rather than write to a
machine-local temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins/partition counts at runtime,
# splits skewed shuffle partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle partitions to the advisory size (not to the core count): on a
    # large cluster this keeps tasks near 128 MB; set the initial partition number high
    # (``cluster_conf``) and let AQE merge.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming de-duplication state lives in RocksDB (off-heap, spills to local disk,
    # checkpointed to the shared folder) instead of executor JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "lakeward", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate may hand back an existing session: apply the runtime SQL settings.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and "catalogImplementation" not in k:
            spark.conf.set(k, v)
    return spark


def cluster_conf(input_bytes: int, cores: int) -> dict:
    """Settings for a large cluster: an initial shuffle partition count from the input size
    (about 128 MB per partition, at least 2 waves of the cluster's cores) that AQE then
    coalesces; scan splits of 128 MB."""
    parts = max(2 * cores, int(input_bytes // (128 * 1024 * 1024)) + 1)
    return {"spark.sql.shuffle.partitions": str(parts),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
            "spark.sql.files.maxPartitionBytes": "128m"}


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def work_dir(spark: SparkSession) -> str:
    """Root of the shared work folder: ``spark.checkpoint.dir`` of the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: lakeward needs a shared folder for "
                "intermediate tables and stream checkpoints")
        base = tempfile.mkdtemp(prefix="lakeward-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    if "://" not in base and not base.startswith("/"):
        base = os.path.abspath(base)
    return base.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never reused folder under the work root (one per run; nothing is deleted)."""
    return f"{work_dir(spark)}/lakeward/{name}-{uuid.uuid4().hex[:12]}"


def in_threads(spark: SparkSession, calls) -> None:
    """Run ``calls`` (driver code that waits for Spark jobs) at the same time, each under the
    caller's job group and properties; after all have ended, raise the first failure."""
    calls = list(calls)
    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
    for d in done:
        d.result()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the work root and read back: its lineage ends here."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
