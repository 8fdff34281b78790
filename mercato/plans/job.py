"""End-to-end job: bronze -> quality -> silver -> gold -> verify.

Stages exchange data only through Parquet tables below ``out_dir`` (a shared
folder on a cluster).  Each stage therefore starts from a short lineage: a
lost executor costs the recomputation of one stage's tasks, never the whole
pipeline, and each silver table is computed once for all fifteen reports.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import gold, quality, silver, verify
from mercato.session import initial_partitions, partitions_for, shared_partitions, small_tasks, table_bytes
from mercato.sources import bronze as bronze_src
from mercato.sources import parquet, versions

log = logging.getLogger("mercato")


@dataclass
class JobResult:
    ingest: list = field(default_factory=list)
    quality_rows: list = field(default_factory=list)
    silver_rows: dict = field(default_factory=dict)
    gold_rows: dict = field(default_factory=dict)
    verified: bool = False
    findings: list = field(default_factory=list)
    stage_seconds: dict = field(default_factory=dict)
    shuffle_partitions: int | None = None


def _layer(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def write_bronze(bronze: Mapping[str, DataFrame], bronze_dir: str) -> dict[str, int]:
    """Materialise given bronze DataFrames (for sources that are not CSV)."""
    return {t: parquet.write_counted(df, parquet.bronze_path(bronze_dir, t), t)
            for t, df in bronze.items() if t != "geo"}


@contextmanager
def sized(spark: SparkSession, bronze_dir: str, tables: Iterable[str],
          shuffle_partitions: int | None = None) -> Iterator[int]:
    """Inside, shuffles start from a partition count in proportion to the
    bronze tables and tasks stay small, so that no task has to sort or
    aggregate far more than fits its memory; gives the count."""
    folders = {t: versions.live_path(spark, parquet.bronze_path(bronze_dir, t)) for t in tables}
    sizes = table_bytes(spark, folders)
    by_order = sum(sizes.get(t, 0) for t in ("order_items", "orders"))
    if shuffle_partitions is None:
        shuffle_partitions = max(partitions_for(spark, max(sizes.values(), default=0)),
                                 shared_partitions(spark, by_order) or 0)
    with initial_partitions(spark, shuffle_partitions), small_tasks(spark, by_order):
        yield shuffle_partitions


def run_quality(spark: SparkSession, bronze: Mapping[str, DataFrame], report_dir: str,
                fail_on: Iterable[str] = ()) -> list:
    results = quality.run_guards(bronze)
    rows = results.collect()  # one row per rule
    res_df = spark.createDataFrame(rows, results.schema)
    summary_rows = quality.summary(res_df).collect()
    detail_rows = quality.detail(res_df).collect()
    report = quality.render_report(summary_rows, detail_rows)
    parquet.write_counted(res_df.coalesce(1), _layer(report_dir, "quality_results.parquet"), "quality")
    # Written by Spark, so that it lands on the file system of the tables.
    spark.createDataFrame([(report,)], "value string").coalesce(1).write.mode("overwrite").text(
        _layer(report_dir, "data_health_summary.md"))
    quality.check_gate(res_df, fail_on)
    return rows


def run_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], silver_dir: str,
               dedupe_order: Mapping | None = None) -> dict[str, int]:
    counts: dict[str, int] = {}
    first = silver.build_silver(bronze, dedupe_order)
    for name in silver.SILVER_TABLES:
        if name == "order_items":
            # Known orders come from the silver table just written.
            s_orders = parquet.read_required(spark, parquet.silver_path(silver_dir, "orders"), "silver")
            df = silver.clean_order_items(bronze["order_items"], s_orders)
        else:
            df = first[name]
        counts[name] = parquet.write_silver(df, silver_dir, name)
    return counts


def read_silver(spark: SparkSession, silver_dir: str) -> dict[str, DataFrame]:
    return {t: parquet.read_required(spark, parquet.silver_path(silver_dir, t), "silver")
            for t in silver.SILVER_TABLES}


def run_gold(spark: SparkSession, silver_dir: str, gold_dir: str, geo: DataFrame) -> dict[str, int]:
    tables = read_silver(spark, silver_dir)
    tables["geo"] = geo
    sizes = table_bytes(spark, {t: versions.live_path(spark, parquet.silver_path(silver_dir, t))
                                for t in ("order_items", "orders")})
    dealt = tables
    if partitions := shared_partitions(spark, sum(sizes.values())):
        # Large: the items move once, and meet their order's reviews where they lie.
        dealt = {**tables, "order_items": tables["order_items"].repartition(partitions, "order_id")}
    return {name: parquet.write_gold(build(dealt if name == "product_reviews" else tables), gold_dir, name)
            for name, build in gold.REPORTS.items()}


def run_job(spark: SparkSession, out_dir: str, *, csv_tables: Mapping[str, bronze_src.Paths] | None = None,
            bronze: Mapping[str, DataFrame] | None = None, geo: DataFrame | None = None,
            dedupe_order: Mapping | None = None, fail_on: Iterable[str] = (),
            csv_multiline: bool | Mapping[str, bool] = True, shuffle_partitions: int | None = None) -> JobResult:
    """Run all stages.  Give either ``csv_tables`` ({table: csv file, folder
    or list of files}) or ready ``bronze`` DataFrames; ``geo`` is the state
    document.  ``shuffle_partitions`` is the count that shuffles start with
    (adaptive execution coalesces them); by default it follows the bronze
    tables, and it holds for this job only."""
    result = JobResult()
    clock = [time.perf_counter()]

    def lap(stage: str) -> None:
        now = time.perf_counter()
        result.stage_seconds[stage] = round(now - clock[0], 3)
        clock[0] = now

    bronze_dir = _layer(out_dir, "bronze")
    if csv_tables is not None:
        result.ingest = bronze_src.ingest_all(spark, csv_tables, bronze_dir, csv_multiline)
    elif bronze is not None:
        result.ingest = write_bronze(bronze, bronze_dir)
        if geo is None:
            geo = bronze.get("geo")
    else:
        raise ValueError("give csv_tables or bronze")
    if geo is None:
        raise ValueError("the state document (geo) is required for the geo reports")
    lap("bronze")
    b = bronze_src.read_bronze(spark, bronze_dir, bronze_src.RAW_TYPES)
    missing = [t for t in bronze_src.RAW_TYPES if t not in b]
    if missing:
        raise parquet.MissingTableError("bronze tables missing (not ingested): " + ", ".join(missing))
    with sized(spark, bronze_dir, b, shuffle_partitions) as result.shuffle_partitions:
        result.quality_rows = run_quality(spark, b, _layer(out_dir, "reports"), fail_on)
        lap("quality")
        silver_dir, gold_dir = _layer(out_dir, "silver"), _layer(out_dir, "gold")
        result.silver_rows = run_silver(spark, b, silver_dir, dedupe_order)
        lap("silver")
        result.gold_rows = run_gold(spark, silver_dir, gold_dir, geo)
        lap("gold")
        result.verified, findings = verify.run_verification(spark, silver_dir, gold_dir)
        result.findings = findings.collect()
    lap("verify")
    log.info("verification %s", "PASSED" if result.verified else "FAILED")
    return result
