"""Event streams: file source, watermark, windowed state, late data.

A stream reads a growing folder of Parquet files with ``availableNow``: each
run takes what has arrived since the last one, from the offsets and state
below its checkpoint folder, and stops.  State is one row per open window (or
session, or event id), in the RocksDB store, and is dropped when the watermark
passes; rows that come later still are counted, not applied.

The changed windows of every batch are appended to a Parquet change log whose
rows name their batch, so a batch that is run again after a failure replaces
its own rows; ``latest`` is the newest row of each window, an aggregate that
combines map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_events(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """The files of ``path`` (a folder, one file, or a pattern) as a stream,
    oldest first."""
    if not any(c in path for c in "*?[{"):
        path = f"{path[:-1]}[{path[-1]}]"  # a pattern may name a file, a plain path only a folder
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def windowed(events: DataFrame, ts: str, window: str, late_by: str, by: Sequence[str] = (),
             slide: str | None = None, **aggregates: Column) -> DataFrame:
    """Aggregates per time window and key; windows close ``late_by`` after
    their end, by the largest time seen."""
    at = F.window(ts, window, slide) if slide else F.window(ts, window)
    out = events.withWatermark(ts, late_by).groupBy(at, *by).agg(
        *(a.alias(name) for name, a in aggregates.items()))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *by, *aggregates)


def sessions(events: DataFrame, ts: str, gap: str, late_by: str, by: Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates per session of each key: state merges sessions that an
    event between them joins.  Rows leave when the session is closed (append
    mode only)."""
    out = events.withWatermark(ts, late_by).groupBy(F.session_window(ts, gap), *by).agg(
        *(a.alias(name) for name, a in aggregates.items()))
    return out.select(F.col("session_window.start").alias("session_start"),
                      F.col("session_window.end").alias("session_end"), *by, *aggregates)


def first_of_each(events: DataFrame, ts: str, late_by: str, by: Sequence[str]) -> DataFrame:
    """Events without repeats of their key that come within ``late_by``."""
    return events.withWatermark(ts, late_by).dropDuplicatesWithinWatermark(list(by))


@dataclass
class RunReport:
    batches: int = 0
    input_rows: int = 0
    late_rows: int = 0  # dropped: older than the watermark (rows of partial aggregates, as Spark counts them)
    state_rows: int = 0  # held at the end
    watermark: str | None = None
    changed: list[int] = field(default_factory=list)


def run_available(stream: DataFrame, log: str, checkpoint: str, mode: str = "update") -> RunReport:
    """Runs the stream over all that has arrived and appends the rows that it
    gives out to the change log."""
    spark = stream.sparkSession
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def append(batch: DataFrame, number: int) -> None:
        # One folder a batch: a batch that is run again overwrites its own.
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    try:
        query = (stream.writeStream.foreachBatch(append).outputMode(mode).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        if old is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    report = RunReport()
    for p in query.recentProgress:
        report.batches += 1
        report.input_rows += p["numInputRows"]
        report.changed.append(p["batchId"])
        report.watermark = p.get("eventTime", {}).get("watermark", report.watermark)
        for state in p["stateOperators"]:
            report.late_rows += state["numRowsDroppedByWatermark"]
            report.state_rows = state["numRowsTotal"]
    return report


def change_log(spark: SparkSession, log: str, schema: T.StructType) -> DataFrame:
    """All rows of the change log, with their ``batch``."""
    fields = [*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField("batch", T.LongType())]
    return spark.read.schema(T.StructType(fields)).parquet(log)


def latest(changes: DataFrame, by: Sequence[str]) -> DataFrame:
    """The newest row of each key of a change log."""
    rest = [c for c in changes.columns if c not in by and c != "batch"]
    newest = F.max_by(F.struct(*rest), "batch").alias("row")
    return changes.groupBy(*by).agg(newest).select(*by, *(F.col("row").getField(c).alias(c) for c in rest))


def table(stream: DataFrame, folder: str, by: Sequence[str]) -> DataFrame:
    """A stream of changing rows as a table: what has arrived is taken up, and
    every key has its newest row."""
    run_available(stream, f"{folder}/log", f"{folder}/checkpoint")
    return latest(change_log(stream.sparkSession, f"{folder}/log", stream.schema), by)
