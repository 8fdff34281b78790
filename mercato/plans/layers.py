"""The written layers: raw CSV and JSON files, bronze, silver, gold and audit
of a whole job, each read back from the files of the layer before."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.plans import gold, job, verify
from mercato.session import scratch_dir
from mercato.sources import bronze as bronze_src
from mercato.sources import geo, parquet, testdata
from mercato.sources.bronze import split_bytes

#: The largest raw file is read in this many scan splits at least, so that small test files are split too.
RAW_SPLITS = 6

#: A remark on each order, with line breaks, commas and quotes in it.
NOTE = "concat('for customer ', customer_id, ',', chr(10), 'order \"', order_id, '\"', chr(10), 'end')"


@dataclass(frozen=True)
class Layers:
    ingest: list[bronze_src.IngestStatus]
    geo: str
    bronze: str
    silver: str
    gold: str


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def write_raw(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    """The raw tables as CSV files and the states as JSON documents."""
    raw = testdata.bronze_tables(spark, sf_dir)
    paths = {}
    for name in bronze_src.RAW_TYPES:
        table = raw[name]
        if name == "orders":
            table = table.withColumn("note", F.expr(NOTE))
        paths[name] = f"{folder}/{name}_dataset"
        # White space around a value is part of it.
        table.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(
            paths[name])
    # One document a file, as a multi-line document is read.
    raw["geo"].select(F.lit("FeatureCollection").alias("type"), "features").write.option(
        "maxRecordsPerFile", 1).json(f"{folder}/states")
    return paths


def run(spark: SparkSession, sf_dir: str) -> Layers:
    """Raw files to the audited gold layer, once per session and folder."""
    held = spark.__dict__.setdefault("_mercato_layers", {})
    key = sf_dir.rstrip("/")
    if key not in held:
        out = scratch_dir(spark, f"layers-{uuid.uuid4().hex}")
        paths = write_raw(spark, sf_dir, f"{out}/raw")
        largest = max(bronze_src.largest_file(spark, p) for p in (paths["orders"], paths["order_items"]))
        split = min(split_bytes(spark), max(4096, largest // RAW_SPLITS))
        with _setting(spark, "spark.sql.files.maxPartitionBytes", str(split)):
            ingest = bronze_src.ingest_all(spark, paths, f"{out}/bronze")
        tables = bronze_src.read_bronze(spark, f"{out}/bronze", bronze_src.RAW_TYPES)
        # Silver's deduplication keeps the row of the lowest number; the files hold text.
        for t, columns in testdata.DEDUPE_ORDER.items():
            tables[t] = tables[t].withColumns({c: F.col(c).cast("bigint") for c in columns})
        with job.sized(spark, f"{out}/bronze", tables):
            job.run_silver(spark, tables, f"{out}/silver", testdata.DEDUPE_ORDER)
            job.run_gold(spark, f"{out}/silver", f"{out}/gold", geo.read_geojson(spark, f"{out}/raw/states"))
        held[key] = Layers(ingest, f"{out}/raw/states", f"{out}/bronze", f"{out}/silver", f"{out}/gold")
    return held[key]


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per raw table: rows loaded, and values that did not fit."""
    rows = [(s.table, s.ok, s.rows, s.bad_values) for s in run(spark, sf_dir).ingest]
    return spark.createDataFrame(rows, "table_name string, ok boolean, rows bigint, bad_values bigint")


def bronze_table(name: str):
    return lambda spark, sf_dir: parquet.read_required(
        spark, parquet.bronze_path(run(spark, sf_dir).bronze, name), "bronze")


def silver_table(name: str):
    return lambda spark, sf_dir: parquet.read_required(
        spark, parquet.silver_path(run(spark, sf_dir).silver, name), "silver")


def gold_table(name: str):
    return lambda spark, sf_dir: parquet.read_required(spark, parquet.gold_path(run(spark, sf_dir).gold, name), "gold")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.explode_states(geo.read_geojson(spark, run(spark, sf_dir).geo))


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of both layers, and its verdict as a last finding."""
    layers = run(spark, sf_dir)
    passed, found = verify.run_verification(spark, layers.silver, layers.gold)
    verdict = spark.createDataFrame(
        [("all", None, "verdict", "OK" if passed else "MISSING", "audit passed" if passed else "audit failed", None)],
        verify.FINDINGS_SCHEMA)
    return found.unionByName(verdict)


QUERIES = {
    "layer_ingest": ingested,
    "layer_bronze_orders": bronze_table("orders"),
    "layer_silver_orders": silver_table("orders"),
    "layer_silver_order_items": silver_table("order_items"),
    "layer_gold_state_performance": gold_table("state_performance"),
    "layer_gold_product_reviews": gold_table("product_reviews"),
    "layer_states": states,
    "layer_findings": findings,
}
