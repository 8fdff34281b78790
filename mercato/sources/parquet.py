"""Parquet sources and sinks for the silver and gold layers.

Tables are replaced by version (``versions``): a write that fails leaves the
old table in place, and readers follow to the live one.  Row counts are taken with an ``Observation`` on the write itself, so saving
and counting is one job, not two.  Outputs keep their natural partitioning
(never ``coalesce(1)``): the wide reports are as large as the fact tables.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato.sources import versions

log = logging.getLogger("mercato")


# Output naming -- ``<name>_cleaned.parquet`` for silver
# tables, ``gold_<name>.parquet`` for reports.


#: The layers hold ids as text, which takes a quarter less than in the default codec.
CODEC = "zstd"


def silver_path(silver_dir: str, name: str) -> str:
    return f"{silver_dir.rstrip('/')}/{name}_cleaned.parquet"


def gold_path(gold_dir: str, name: str) -> str:
    return f"{gold_dir.rstrip('/')}/gold_{name}.parquet"


def bronze_path(bronze_dir: str, name: str) -> str:
    return f"{bronze_dir.rstrip('/')}/{name}.parquet"


def try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """Read a Parquet table, its live version where it has versions; None when
    its path does not exist (S9).  Any other failure (a folder without files,
    say) is raised."""
    try:
        return spark.read.parquet(versions.live_path(spark, path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class MissingTableError(FileNotFoundError):
    pass


def read_required(spark: SparkSession, path: str, what: str) -> DataFrame:
    """Read a table a later stage needs; a clear error when absent."""
    df = try_read(spark, path)
    if df is None:
        raise MissingTableError(f"required {what} table missing: {path}")
    return df


def write_observed(df: DataFrame, path: str, name: str, drop: tuple[str, ...] = (), **metrics: Column) -> dict[str, int]:
    """Replace the table at ``path`` by ``df``; the ``metrics`` (``rows`` is one)
    are counted as it is written.  Columns in ``drop`` only serve the metrics."""
    obs = Observation(f"rows_{name}")
    exprs = [m.alias(k) for k, m in metrics.items()]

    def write(folder: str) -> int:
        df.observe(obs, *exprs).drop(*drop).write.option("compression", CODEC).parquet(folder)
        return int(obs.get["rows"] or 0)

    versions.replace(df.sparkSession, path, write)
    return {k: int(v or 0) for k, v in obs.get.items()}


def write_counted(df: DataFrame, path: str, name: str) -> int:
    """Replace the table at ``path`` by ``df`` and return the rows written."""
    return write_observed(df, path, name, rows=F.count(F.lit(1)))["rows"]


class EmptyReportError(ValueError):
    pass


def write_gold(df: DataFrame, gold_dir: str, name: str) -> int:
    """Write a report, then raise if it is empty (the file stays)."""
    rows = write_counted(df, gold_path(gold_dir, name), name)
    log.info("Gold report %s saved (%d rows)", name.replace("_", " ").title(), rows)
    if rows == 0:
        raise EmptyReportError(f"report {name} is empty; check the silver sources")
    return rows


def write_silver(df: DataFrame, silver_dir: str, name: str) -> int:
    rows = write_counted(df, silver_path(silver_dir, name), name)
    log.info("Cleaned %s: %d rows saved", name.replace("_", " ").title(), rows)
    return rows
