"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock, local

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings the jobs are written for. A cluster session may already carry its own;
# nothing below depends on them for right results, only for speed.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(name: str, cores: str = "*", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Compressed input per shuffle partition.
BYTES_PER_PARTITION = 64 * 2**20
# Codec of written tables.
CODEC = "zstd"
# A join partition of this size and several times the median is split at hot keys.
SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Suit the shuffles to the input, for the jobs inside the block.

    The number of partitions is raised, never lowered: adaptive execution merges
    partitions that turn out small, but it does not split even ones that turn out
    large. Hot partitions are split earlier than by default, unless the session says
    when. The caller's settings are restored at the end.
    """
    key = "spark.sql.shuffle.partitions"
    wanted = input_bytes // BYTES_PER_PARTITION
    chosen = {k for k, _ in spark.sparkContext.getConf().getAll()}
    settings = {k: v for k, v in SKEW.items() if k not in chosen}
    if wanted > int(spark.conf.get(key)):
        settings[key] = str(wanted)
    before = {k: spark.conf.get(k) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# Whether a job's shuffle files go when it ends, not when the JVM collects its plan.
DROPS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_users: Counter[str] = Counter()
_before: dict[str, str | None] = {}
_lock = Lock()


@contextmanager
def dropped_shuffles(*sessions: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of a job as soon as it ends, for the jobs inside the block.

    Steps that write a table each would else hold the shuffles of all earlier steps on disk
    until the JVM happens to collect them. Blocks may overlap, in threads too; the callers'
    setting returns at the end of the last one. A result that is asked for twice inside
    the block is shuffled twice.
    """
    held = {s._jsparkSession.sessionUUID(): s for s in sessions}
    with _lock:
        for name, spark in held.items():
            if not _users[name]:
                _before[name] = spark.conf.get(DROPS, None)
                spark.conf.set(DROPS, "true")
            _users[name] += 1
    try:
        yield
    finally:
        with _lock:
            for name, spark in held.items():
                _users[name] -= 1
                if _users[name]:
                    continue
                del _users[name]
                before = _before.pop(name)
                if before is None:
                    spark.conf.unset(DROPS)
                else:
                    spark.conf.set(DROPS, before)


_written = local()


@contextmanager
def dropped_tables(spark: SparkSession) -> Iterator[None]:
    """Remove at its end what ``materialize`` wrote inside the block, in its thread.

    Nothing that is read later may depend on these tables.
    """
    outer, _written.paths = getattr(_written, "paths", None), []
    try:
        yield
    finally:
        paths, _written.paths = _written.paths, outer
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It comes from ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder; on a cluster the folder must be named,
    because executors on other machines have to reach it.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(
                f"set {CHECKPOINT_DIR} to a folder that all executors can reach"
            )
        root = tempfile.mkdtemp(prefix="punctual-")
        spark.conf.set(CHECKPOINT_DIR, root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the scratch folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the planner the
    file size, so that a later join is broadcast only when the table is small.
    """
    path = scratch_path(df.sparkSession, label)
    if getattr(_written, "paths", None) is not None:
        _written.paths.append(path)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)
