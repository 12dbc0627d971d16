"""Session construction and the shared scratch location.

Two rules drive this module:

* Join strategies are chosen per query (hints, ``plans/sizing``), never by a
  session-wide threshold, so that a plan is the same in every session.
* Anything written to disk (round trips, checkpoints) goes below the shared
  folder named by ``spark.checkpoint.dir``. Only a local session that has none
  gets a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # remove checkpoint files once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


PARTITION_BYTES = 128 << 20


def scale_settings(input_bytes: int, task_slots: int, partition_bytes: int = PARTITION_BYTES,
                   shuffle_fraction: float = 0.25) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``task_slots`` cores.

    Scan splits and post-shuffle partitions target ``partition_bytes``
    (128 MB): small enough for one task's memory with room for sort and hash
    buffers, large enough to keep per-task overhead low. The shuffled volume
    is a fraction of the input (pruned columns, map-side partial aggregates),
    ``shuffle_fraction``; the shuffle partition count covers it, is at least
    three waves of tasks and is rounded up to whole waves. AQE coalesces
    partitions that come out small and splits skewed ones.
    """
    slots = max(int(task_slots), 1)
    by_size = -(-int(max(input_bytes, 1) * shuffle_fraction) // partition_bytes)
    waves = max(3, -(-by_size // slots))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(waves * slots),
    }


def build_session(master: str | None = None, app: str = "cabwise",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None,
                  input_bytes: int | None = None, task_slots: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied.

    With ``input_bytes`` and ``task_slots`` the partition sizing of
    :func:`scale_settings` is applied; ``shuffle_partitions`` and ``conf``
    override it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if input_bytes is not None and task_slots is not None:
        settings.update(scale_settings(input_bytes, task_slots))
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the running context or ``spark.checkpoint.dir``; a local
    session without either gets a fresh temporary folder. A cluster session
    without a configured folder is an error: a machine-local path would not
    be visible to the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="cabwise-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused)."""
    root = checkpoint_root(spark)
    return f"{root}/cabwise-staging/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs a plain path (tests)."""
    return path[len("file:"):] if path.startswith("file:") else path
