"""Output audit (V1-V6): a findings DataFrame instead of log lines.

Severity ``MISSING`` (a table is absent) decides the verdict; ``WARN``
(lower-case text left in city/state columns, an empty gold report) and
``TYPE`` (an order date column that is not a zone-free datetime) are reported only.
The case check looks at the **whole** column -- "the first rows" of a
distributed table are not defined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions import datetime_columns
from mercato.plans.gold import REPORTS
from mercato.plans.silver import SILVER_TABLES
from mercato.sources import parquet, versions

FINDINGS_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("rows", T.LongType()),
])


def geo_text_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if "city" in c or "state" in c]


def case_counts(tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """V2: per city/state column of each table, rows holding a lower-case
    ASCII letter.  One aggregation per table that has such columns."""
    parts = []
    for name, df in tables.items():
        cols = geo_text_columns(df.columns)
        if not cols:
            continue
        agg = df.agg(*[F.count_if(F.col(c).rlike("[a-z]")).alias(f"n{i}") for i, c in enumerate(cols)])
        parts.append(agg.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(f"n{i}").cast("bigint").alias("lowercase_rows"))
            for i, c in enumerate(cols)]))))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V1: rows per table, one small aggregate per table, all in one job (a
    bare count over Parquet is answered from file metadata)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
             .select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def written_rows(spark: SparkSession, paths: Mapping[str, str], tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows of written tables: counted when the live version was written, of
    plain folders all in one job."""
    found = {name: versions.live(spark, path) for name, path in paths.items()}
    rows = {name: v.rows for name, v in found.items() if v is not None}
    plain = {name: tables[name] for name, v in found.items() if v is None}
    return rows | ({r["table_name"]: r["rows"] for r in row_counts(plain).collect()} if plain else {})


def verify_silver(spark: SparkSession, silver_dir: str,
                  tables: Sequence[str] = SILVER_TABLES) -> list[tuple]:
    """V1-V3 for the silver folder: existence, rows, case, datetime types."""
    findings = []
    present = {}
    for t in tables:
        df = parquet.try_read(spark, parquet.silver_path(silver_dir, t))
        if df is None:
            findings.append(("silver", t, "exists", "MISSING", "table not found", None))
            continue
        present[t] = df
        if t == "orders":
            for c in datetime_columns(df.columns):
                if not isinstance(df.schema[c].dataType, T.TimestampNTZType):
                    findings.append(("silver", t, "datetime_type", "TYPE",
                                     f"{c} is {df.schema[c].dataType.simpleString()}", None))
    rows = written_rows(spark, {t: parquet.silver_path(silver_dir, t) for t in present}, present)
    for t in present:  # V1
        findings.append(("silver", t, "exists", "OK", "table found", rows[t]))
    counts = case_counts(present)
    if counts is not None:
        for r in counts.collect():  # one row per city/state column
            if r["lowercase_rows"]:
                findings.append(("silver", r["table_name"], "upper_case", "WARN",
                                 f"{r['column_name']} holds lower-case text", r["lowercase_rows"]))
    return findings


def verify_gold(spark: SparkSession, gold_dir: str, reports: Sequence[str] = tuple(REPORTS)) -> list[tuple]:
    """V4-V5: every report exists (all fifteen) and is not empty."""
    findings = []
    present = {}
    for name in reports:
        df = parquet.try_read(spark, parquet.gold_path(gold_dir, name))
        if df is None:
            findings.append(("gold", name, "exists", "MISSING", "report not found", None))
        else:
            present[name] = df
    rows = written_rows(spark, {name: parquet.gold_path(gold_dir, name) for name in present}, present)
    for name in present:
        empty = rows[name] == 0
        findings.append(("gold", name, "not_empty", "WARN" if empty else "OK",
                         "report has 0 rows" if empty else "report has rows", rows[name]))
    return findings


def run_verification(spark: SparkSession, silver_dir: str, gold_dir: str) -> tuple[bool, DataFrame]:
    """V6: findings of both layers and the verdict (no MISSING finding)."""
    rows = verify_silver(spark, silver_dir) + verify_gold(spark, gold_dir)
    passed = not any(r[3] == "MISSING" for r in rows)
    return passed, spark.createDataFrame(rows, FINDINGS_SCHEMA)
