"""Shards by extendible hashing (operator 4), DataFrame only.

A document's address are the bits of md5(doc_id) and, should many rows share
an id, of md5(text) after them.  A bucket is a prefix of the address; a bucket
over the byte limit splits on its next bit, the others stay whole.  The bytes
of all prefixes down to a cell depth a few bits below the expected one come
from one aggregate (combined map-side); only cells still over the limit are
looked at again, some bits deeper.  The directory, one row per cell, is joined
to the rows; nothing of it passes through the driver.

Defined cases: a null doc_id hashes as the empty string, null text has no
bytes; rows equal in id and text share an address and stay together, and a
document larger than the limit fills a shard of its own, so such a shard may
exceed the limit; an empty table gives no rows; other columns pass through
``write_shards`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import read_table, written

SHARD_BYTES = 16 << 20
ADDRESS_BITS = 256
CELL_BITS = 3  # cells per expected shard, as a power of two
DEEPER = 12

# Hex digits as letters first, then each letter as its bits.
HEX, LETTERS = "0123456789abcdef", "ghijklmnopqrstuv"


def bits_sql(digest: str) -> str:
    """SQL (Spark and DuckDB) for the bits of a hex digest."""
    out = f"translate({digest}, '{HEX}', '{LETTERS}')"
    for i, letter in enumerate(LETTERS):
        out = f"replace({out}, '{letter}', '{i:04b}')"
    return out


ADDRESS_SQL = bits_sql("md5(coalesce(cast(doc_id as string), '')) || md5(coalesce(text, ''))")


def addressed(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``row`` (the carried columns), ``address`` and ``n_bytes``."""
    keys = docs.select(F.struct(*(docs[c].alias(c) for c in carried)).alias("row"),
                       docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return keys.select("row", F.expr(ADDRESS_SQL).alias("address"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))


def _prefix(bits: Column | str, depth) -> Column:
    return F.substring(bits, 1, depth) if isinstance(depth, int) else F.substr(bits, F.lit(1), depth)


def directory(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """Per cell (prefix of ``depth`` bits) its bucket: ``shard``, or null where
    the bucket lies deeper."""
    cells = rows.groupBy(_prefix("address", depth).alias("cell")).agg(
        F.sum("n_bytes").alias("n"), F.min("address").alias("low"), F.max("address").alias("high"))
    cells = written(cells, "cells")
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    buckets = levels.groupBy(_prefix(F.col("cell"), F.col("depth")).alias("shard"), "depth").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    whole = buckets.where((F.col("n") <= limit) | (F.col("low") == F.col("high"))).select("shard")
    inside = levels.select("cell", _prefix(F.col("cell"), F.col("depth")).alias("shard")).join(whole, "shard")
    # The shortest prefix that fits is the bucket.
    first = inside.groupBy("cell").agg(F.min_by("shard", F.length("shard")).alias("shard"))
    return cells.select("cell").join(first, "cell", "left")


def shards(rows: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``addressed`` rows with their ``shard``, the bits of its prefix."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(ADDRESS_BITS, math.ceil(math.log2(max(1, total / limit))) + CELL_BITS)
    names, out = rows.columns, rows.withColumn("shard", F.lit(None).cast("string"))
    deeper = rows
    while True:
        found = written(directory(deeper, depth, limit), "directory")
        cell = _prefix("address", depth)
        new = found.withColumnRenamed("shard", "found")
        out = out.join(new, cell == new["cell"], "left").select(
            *names, F.coalesce("shard", "found").alias("shard"))
        open_cells = found.where("shard is null").select("cell")
        if open_cells.isEmpty():
            return out
        deeper = deeper.join(open_cells, cell == open_cells["cell"], "left_semi")
        depth = min(ADDRESS_BITS, depth + DEEPER)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """The documents as Parquet, one folder ``shard=<bits>`` per shard (the
    root bucket of an unsplit table is ``shard=root``)."""
    rows = shards(addressed(docs, docs.columns), limit)
    name = F.when(F.col("shard") == "", "root").otherwise(F.concat(F.lit("b"), F.col("shard")))
    rows.select("row", name.alias("shard")).repartition("shard").write.partitionBy("shard").parquet(path)


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards(addressed(read_table(spark, sf_dir, "documents"), ["doc_id"]))
    return rows.select("row.doc_id", "n_bytes", "shard", F.length("shard").alias("depth"))


def oracle(limit: int = SHARD_BYTES) -> str:
    return f"""
WITH d AS (SELECT doc_id, {ADDRESS_SQL} AS address, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes
           FROM documents),
levels AS (SELECT address, n_bytes, k, substr(address, 1, k) AS shard
           FROM d, (SELECT CAST(unnest(range(0, {ADDRESS_BITS} + 1)) AS INTEGER) AS k)),
buckets AS (SELECT shard, k, sum(n_bytes) AS n, min(address) AS low, max(address) AS high
            FROM levels GROUP BY shard, k),
fit AS (SELECT address, min(k) AS depth FROM levels JOIN buckets USING (shard, k)
        WHERE n <= {limit} OR low = high GROUP BY address)
SELECT doc_id, n_bytes, substr(address, 1, depth) AS shard, depth FROM d JOIN fit USING (address)
"""
