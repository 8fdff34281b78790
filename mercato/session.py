"""Sessions, shared scratch folders and shuffle sizing.

Spark's own defaults (adaptive execution, skew-join splitting) are relied on
and not restated; datetimes are zone-free, so no result depends on the
session's time zone.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "mercato",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster use the given one."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables below the shared folder that the
    cluster names in ``spark.checkpoint.dir``; where that is unset, below the
    warehouse, if that is shared too.  On a cluster whose warehouse is a local
    folder the setting is required."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        local_folder = "://" not in warehouse and (":" not in warehouse or warehouse.startswith("file:"))
        if local_folder and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = warehouse + "/_scratch"
    return f"{base.rstrip('/')}/{name}"


# Shuffle sizing: Parquet expands roughly this much when decoded, and each
# shuffle partition should hold about this many bytes so that a task's sort
# and aggregation buffers fit executor memory (spilling stays the exception).
PARQUET_EXPANSION = 4
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def table_bytes(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, int]:
    """Bytes of each table, ``{name: folder of its files}``, from a file listing
    by Spark (works on any file system; only file metadata is read)."""
    files = spark.read.format("binaryFile").load(list(paths.values()))
    folder = F.regexp_extract("path", r"([^/]+/[^/]+)/[^/]+$", 1)
    sizes = {r["folder"]: int(r["n"]) for r in
             files.groupBy(folder.alias("folder")).agg(F.sum("length").alias("n")).collect()}
    return {name: sizes.get("/".join(path.rstrip("/").split("/")[-2:]), 0) for name, path in paths.items()}


def partitions_for(spark: SparkSession, data_bytes: int) -> int:
    """Shuffle partitions for ``data_bytes`` of compressed input, at least the
    session's ``spark.sql.shuffle.partitions``; there is no upper limit."""
    wanted = -(-data_bytes * PARQUET_EXPANSION // TARGET_PARTITION_BYTES)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


# Steps that share one shuffle sort and aggregate each partition several times;
# a partition of this much compressed input keeps such a task below 1 GB.
SHARED_PARTITION_BYTES = 4 * 1024 * 1024
SHARED_FROM_BYTES = 64 * 1024 * 1024  # smaller tables are left to adaptive execution


def input_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Bytes of the files of tables, each a file or a folder (only file
    metadata is read)."""
    files = spark.read.format("binaryFile").load(list(paths))
    return int(files.agg(F.sum("length")).first()[0] or 0)


def shared_partitions(spark: SparkSession, data_bytes: int) -> int | None:
    """Partitions of a shuffle that several steps share, in proportion to the
    input and without an upper limit; None for small tables.  Not fewer than
    the session's shuffles have, so that other sides follow this one."""
    if data_bytes < SHARED_FROM_BYTES:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-data_bytes // SHARED_PARTITION_BYTES))


# Scans and shuffles of large tables hand a task this much compressed data, so that
# its sorts and hash tables, several in a report, fit an executor's share of memory.
TASK_BYTES = 16 * 1024 * 1024
# The layers' zstd files can be half of what Spark's broadcast threshold is made for.
TASK_SETTINGS = {"spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
                 "spark.sql.sources.fileCompressionFactor": "2.0"}


@contextmanager
def small_tasks(spark: SparkSession, data_bytes: int) -> Iterator[None]:
    """For ``data_bytes`` of compressed input, scans and merged shuffle partitions
    of ``TASK_BYTES`` inside, and file sizes count double where sides are chosen
    for a broadcast; small tables are left to the session's settings, which come
    back."""
    if data_bytes < SHARED_FROM_BYTES:
        yield
        return
    old = {key: spark.conf.get(key) for key in TASK_SETTINGS}
    for key, value in TASK_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


@contextmanager
def initial_partitions(spark: SparkSession, count: int) -> Iterator[None]:
    """Shuffles start with ``count`` partitions inside; adaptive execution
    coalesces what turns out small.  The session's own setting comes back."""
    old = spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.set(INITIAL_PARTITIONS, str(count))
    try:
        yield
    finally:
        if old in (None, ""):
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, old)
