"""Bronze ingestion: raw CSV files become Parquet tables.

Every field is read as text and then cast to the type declared for its
column, so a number written in another form (``4.0`` for a whole number)
survives; a value that still does not fit becomes null and is counted in the
table's ``IngestStatus``.  No inference pass reads the data; columns the
pipeline does not name stay text.  Doubled quotes are unescaped; a quoted
empty string stays an empty string, and text such as ``007`` stays text.

A table is one file, a folder or a list of files, listed by Spark on any file
system.  Quoted fields may span lines.  Files of more than one scan split are
read in many tasks by ``split_csv``; a table with a quote where the format
has none is read in one task per *file*, as are small files.  A table known
to have no line breaks inside quotes is read with ``multiline=False``; Spark
then splits its files.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.sources import parquet, split_csv

log = logging.getLogger("mercato")

S, D, L = T.StringType(), T.DoubleType(), T.LongType()

# The raw columns the pipeline names, with the types declared
# for them; all other columns are read as text.
RAW_TYPES: dict[str, dict[str, T.DataType]] = {
    "customers": {"customer_id": S, "customer_unique_id": S, "customer_city": S, "customer_state": S},
    "orders": {"order_id": S, "customer_id": S, "order_status": S, "order_purchase_timestamp": S,
               "order_delivered_customer_date": S, "order_estimated_delivery_date": S},
    "order_items": {"order_id": S, "product_id": S, "seller_id": S, "price": D, "freight_value": D},
    "products": {"product_id": S, "product_category_name": S, "product_weight_g": D,
                 "product_length_cm": D, "product_height_cm": D, "product_width_cm": D},
    "product_category_name_translation": {"product_category_name": S, "product_category_name_english": S},
    "sellers": {"seller_id": S, "seller_city": S, "seller_state": S},
    "order_payments": {"order_id": S, "payment_type": S, "payment_installments": L, "payment_value": D},
    "order_reviews": {"review_id": S, "order_id": S, "review_score": L,
                      "review_creation_date": S, "review_answer_timestamp": S},
    "marketing_leads": {"mql_id": S, "first_contact_date": S, "origin": S},
    "closed_deals": {"mql_id": S, "won_date": S},
}

# A quoted empty field ("") is the empty string, an unquoted empty field is
# null.  Spark reports both as null by default, so quoted empties are read as
# a sentinel and mapped back to "" in the projection that follows the scan.
_QUOTED_EMPTY = "\u0000"

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    "quote": '"',
    "emptyValue": _QUOTED_EMPTY,
    "mode": "PERMISSIVE",
}


def table_name_for(file_name: str, prefix: str = "", suffix: str = "_dataset") -> str:
    """Table name from a file name: the stem without ``prefix`` and ``suffix``
    fragments (S2)."""
    stem = os.path.splitext(os.path.basename(file_name))[0]
    if prefix:
        stem = stem.replace(prefix, "")
    if suffix:
        stem = stem.replace(suffix, "")
    return stem


Paths = str | Sequence[str]


def discover_tables(spark: SparkSession, raw_dir: str, prefix: str = "", suffix: str = "_dataset") -> dict[str, Paths]:
    """``{table: path}`` for the CSV files below a folder on any file system:
    a file is a table, and so is a subfolder of part files.  Spark lists the
    files; only their names reach the driver."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.csv").load(raw_dir)
    found = [r["path"] for r in files.select("path").collect()]
    depth = min((p.count("/") for p in found), default=0)
    root = raw_dir.rstrip("/").split("/")[-1]
    tables: dict[str, Paths] = {}
    for p in sorted(found):
        steps = p.split("/")
        at = len(steps) - 1 - steps[::-1].index(root) if root in steps else depth - 1
        name = table_name_for(steps[at + 1], prefix, suffix)
        tables[name] = "/".join(steps[:at + 2])
    return tables


def _options(multiline: bool) -> dict[str, str]:
    return {**CSV_OPTIONS, "multiLine": "true" if multiline else "false"}


def _typed(text: Column, kind: T.DataType) -> Column:
    """Text as its declared type, null where it does not fit."""
    number = text.try_cast("double")
    if not isinstance(kind, T.LongType):
        return number
    return F.coalesce(text.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))


def largest_file(spark: SparkSession, path: Paths) -> int:
    """Bytes of the largest file of a table (only file metadata is read)."""
    paths = path if isinstance(path, str) else list(path)
    files = spark.read.format("binaryFile").load(paths)
    return files.agg(F.max("length")).first()[0] or 0


def split_bytes(spark: SparkSession) -> int:
    """``spark.sql.files.maxPartitionBytes``: bytes, or a number with a unit."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(size[-1:], 0)
    return int(size[:-1] if unit else size) << unit


def read_text(spark: SparkSession, path: Paths, multiline: bool = True, split: bool | None = None) -> DataFrame:
    """The fields of raw CSV files as text, named by the header.

    ``split`` reads files whose fields span lines in many tasks per file; by
    default where a file is larger than one scan split.  Then a column
    ``split_csv.ODD`` marks the records whose quotes do not allow that."""
    paths = path if isinstance(path, str) else list(path)
    # Only a header line is read to learn the names.
    names = spark.read.options(**_options(multiline)).csv(paths).columns
    if split is None:
        split = multiline and largest_file(spark, paths) > split_bytes(spark)
    if split:
        df = split_csv.read_text(spark, paths, names, CSV_OPTIONS)
    else:
        df = spark.read.options(**_options(multiline)).schema(
            T.StructType([T.StructField(c, S) for c in names])).csv(paths)
    return df.withColumns({c: F.when(F.col(c) == _QUOTED_EMPTY, F.lit("")).otherwise(F.col(c)) for c in names})


def _declared(df: DataFrame, table: str) -> dict[str, T.DataType]:
    types = RAW_TYPES.get(table, {})
    return {c: types[c] for c in df.columns if c in types and types[c] != S}


def read_csv(spark: SparkSession, path: Paths, table: str, multiline: bool = True,
             split: bool | None = None) -> DataFrame:
    """A raw table as a DataFrame with declared types.  Read in splits, a
    record with odd quotes raises; ``split=False`` reads such a table."""
    df = read_text(spark, path, multiline, split)
    if split_csv.ODD in df.columns:
        odd = F.raise_error(F.lit(f"{table}: odd quotes, read it with split=False"))
        df = df.where(F.when(F.col(split_csv.ODD), odd.cast("boolean")).otherwise(F.lit(True))).drop(split_csv.ODD)
    return df.withColumns({c: _typed(F.col(c), t) for c, t in _declared(df, table).items()})


@dataclass
class IngestStatus:
    table: str
    path: Paths
    rows: int | None
    ok: bool
    message: str
    bad_values: int | None = None  # not blank, and null after the cast


def ingest_csv(spark: SparkSession, table: str, csv_path: Paths, bronze_dir: str,
               multiline: bool = True, split: bool | None = None) -> IngestStatus:
    """S3: load one raw table into its bronze table, replacing it.  A missing
    file or a failure is reported and skipped, not raised.  A table read in
    splits whose quotes turn out odd is loaded again, one task a file."""
    try:
        df = read_text(spark, csv_path, multiline, split)
    except split_csv.UnbalancedQuotesError as e:
        log.warning("%s; one task reads each file of %s", e, table)
        return ingest_csv(spark, table, csv_path, bronze_dir, multiline, split=False)
    except Exception as e:  # noqa: BLE001 - reported as a status row
        log.error("Failed to read %s: %s", csv_path, e)
        return IngestStatus(table, csv_path, None, False, f"read failed: {e}")
    declared = _declared(df, table)
    bad = sum((F.coalesce((F.trim(c) != "") & _typed(F.col(c), t).isNull(), F.lit(False)).cast("int") for c, t in declared.items()), F.lit(0))
    # Counted on the text before it is cast; null and blank text are no bad values.
    counted = df.withColumns({"__bad": bad, **{c: _typed(F.col(c), t) for c, t in declared.items()}})
    odd = F.count_if(F.col(split_csv.ODD)) if split_csv.ODD in df.columns else F.max(F.lit(0))
    try:
        found = parquet.write_observed(counted, parquet.bronze_path(bronze_dir, table), table,
                                       drop=("__bad", split_csv.ODD), rows=F.count(F.lit(1)), bad=F.sum("__bad"),
                                       odd=odd)
        if found["odd"]:
            log.warning("%d records of %s have odd quotes; one task reads each of its files", found["odd"], table)
            return ingest_csv(spark, table, csv_path, bronze_dir, multiline, split=False)
    except Exception as e:  # noqa: BLE001
        log.error("Failed to load %s: %s", table, e)
        return IngestStatus(table, csv_path, None, False, f"load failed: {e}")
    log.info("Loaded %d rows into %s", found["rows"], table)
    if found["bad"]:
        log.warning("%d values of %s do not fit their declared type and are null", found["bad"], table)
    return IngestStatus(table, csv_path, found["rows"], True, "loaded", found["bad"])


def ingest_all(spark: SparkSession, tables: Mapping[str, Paths], bronze_dir: str,
               multiline: bool | Mapping[str, bool] = True) -> list[IngestStatus]:
    """Every table of the map, in order; ``multiline`` for all tables, or
    by table (true where not named)."""
    def of(table: str) -> bool:
        return multiline if isinstance(multiline, bool) else multiline.get(table, True)

    return [ingest_csv(spark, t, p, bronze_dir, of(t)) for t, p in tables.items()]


def read_bronze(spark: SparkSession, bronze_dir: str, tables) -> dict[str, DataFrame]:
    """Bronze tables written by ``ingest_all`` (missing ones are left out)."""
    out = {}
    for t in tables:
        df = parquet.try_read(spark, parquet.bronze_path(bronze_dir, t))
        if df is not None:
            out[t] = df
    return out


def preview(spark: SparkSession, df_or_path: DataFrame | str, limit: int = 5,
            order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``limit`` rows of a table, by ``order_by`` where given; an
    unreadable table gives an empty frame."""
    try:
        df = df_or_path if isinstance(df_or_path, DataFrame) else spark.read.parquet(df_or_path)
        return (df.orderBy(*order_by) if order_by else df).limit(limit)
    except Exception as e:  # noqa: BLE001
        log.error("Could not preview %s: %s", df_or_path, e)
        return spark.createDataFrame([], T.StructType([]))
