"""Session defaults and the shared scratch location.

Scratch data (round-trip files, stream checkpoints, lineage cuts) lives under the
cluster's ``spark.checkpoint.dir``. We read it from the session and only set our
own when it is unset (local runs and tests).
"""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = 8, app: str = "tidemark", **extra: str) -> SparkSession:
    """A local session with the settings our tests and bench use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    Scan splits of ``target_partition_bytes``; shuffle partitions so that each
    holds about that much (shuffled data taken as the input size, at least three
    waves of tasks); adaptive execution to coalesce small partitions, split skewed
    joins and switch to broadcast only for sides measured below the threshold.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the context was given, else the one named by ``spark.checkpoint.dir``.

    Where neither is set, a local session gets a temporary folder; on a cluster that
    would be a different disk for every executor, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    given = spark.sparkContext.getCheckpointDir()
    # Spark itself gives the context a folder below the named one.
    root = named if named and (not given or _local_path(given).startswith(_local_path(named))) else given
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if not given:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _local_path(uri: str) -> str:
    return uri.removeprefix("file:").replace("//", "/").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


class _Scratch(threading.local):
    """The tables each thread has materialized: jobs in other threads keep theirs."""

    def __init__(self):
        self.paths: list[str] = []


_SCRATCH = _Scratch()


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from this table, not from the
    sources) and pins any run-dependent values (such as partition ids) as data.
    The path is remembered so a job can ``release_scratch`` once its outputs are
    written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _SCRATCH.paths.append(path)
    df.write.mode("overwrite").parquet(path)
    # The schema is known: skip the footer-reading inference job on the way back.
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    """A marker for ``release_scratch``: tables materialized after it belong to the caller."""
    return len(_SCRATCH.paths)


def release_scratch(spark: SparkSession, mark: int = 0) -> list[str]:
    """Delete the tables ``materialize`` wrote since ``mark`` (and only those).

    A job takes a mark when it starts and releases in ``finally`` after its last
    write. Marks count the calling thread's tables, so a job never releases what a
    job in another thread (such as a stream's callback) still reads.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    released = []
    while len(_SCRATCH.paths) > mark:
        path = _SCRATCH.paths.pop()
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
        released.append(path)
    return released
