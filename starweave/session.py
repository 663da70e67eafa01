"""Session helpers: conf defaults for local runs, and the shared folder for
materialised tables (read from the session; only set when it is unset)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PART_BYTES = 16 << 20    # of a shuffle, as sent, that one task takes
PART_ROWS = 250_000      # rows of the largest table for each part of a shuffle

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = 8, app: str = "starweave", **extra) -> SparkSession:
    """A local[N] session for tests and the bench."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and materialised tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set (local tests) a scratch folder is created and
    registered, so later ``checkpoint()`` calls use it too.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            # a driver-local folder is not visible to the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="starweave-")
        if sc is not None:
            sc.setCheckpointDir(d)
        else:
            spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared folder."""
    return f"{shared_dir(spark)}/starweave/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def fine_parts(spark: SparkSession, rows: int = 0) -> Iterator[None]:
    """Jobs run inside join the parts of a shuffle to ``PART_BYTES`` only, and
    cut it into one for every ``PART_ROWS`` of ``rows`` at least.  Keys and
    money compress to a sixteenth when they are sent, so the 64 MB to which
    parts are joined otherwise are a GB of a task that sorts or hashes them."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PART_BYTES),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts)}
    was = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Cluster settings sized to the data: shuffle partitions so that one
    partition is ~``target_partition_bytes`` (AQE coalesces small ones and
    splits skewed ones), file splits of 256 MB, at least 2 tasks per core."""
    slots = executors * cores_per_executor
    parts = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.files.maxRecordsPerFile": "50000000",
    }
