"""Helpers shared by the training-data operators.

Intermediate tables go to the shared folder that the cluster names in
``spark.checkpoint.dir`` (``mercato.session.scratch_dir``).  A written table
cuts lineage and survives lost executors.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato.session import scratch_dir
from mercato.sources import versions


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name for one intermediate table."""
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    scratch_made(spark).append(path)
    return path


def scratch_made(spark: SparkSession) -> list[str]:
    """The scratch folders of this session that are still there, in order."""
    return spark.__dict__.setdefault("_mercato_scratch", [])


def remove_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Removes scratch folders whose tables nobody reads any more."""
    for path in paths:
        versions.remove(spark, path)
        scratch_made(spark).remove(path)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_scratch(df: DataFrame, path: str) -> None:
    """Writes ``df``; the shuffle files of that job are removed at its end, as
    the written table stands for them."""
    spark = df.sparkSession
    old = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        if old is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, old)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_scratch(df, path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(df: DataFrame) -> Column:
    """The text column, null as empty."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def chunks(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``max_bytes`` of text
    (one row at least), so that a task's memory does not depend on the number
    of rows in an Arrow batch."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Memory that was freed goes back to the system.  A Python worker stays
    for later tasks and counts beside its executor's JVM all the while."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def tidy(function: Callable) -> Callable:
    """A function on batches that gives freed memory back at a task's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()
    return run


def tidy_groups(function: Callable) -> Callable:
    """A function on two groups that gives freed memory back after each pair."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return function(left, right)
        finally:
            give_back()
    return run


def few_rows(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``most`` rows: each is copied whole on
    its way to the JVM, and there."""
    for start in range(0, batch.num_rows, most):
        yield batch.slice(start, most)


def block_count(df: DataFrame, target_bytes: int) -> int:
    """Blocks of about ``target_bytes`` of text that ``df`` fills."""
    total = df.agg(F.sum(F.octet_length(text_of(df)))).first()[0] or 0
    return max(1, -(-int(total) // target_bytes))


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Component of every vertex in ``edges`` (a, b): rows (v, c), ``c`` the
    smallest vertex reachable from ``v``.

    Alternating large-star and small-star steps: each is a minimum per
    vertex (combined map-side) joined back to the edges, so a vertex with
    very many neighbours is split like any skewed join key.  The edges of
    each round are written to the shared folder; only their number and one
    checksum, taken as they are written, reach the driver.
    """
    spark = edges.sparkSession
    a, b = F.col("a"), F.col("b")

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:  # every neighbour above u is linked to the smallest of u's neighbourhood
            e = e.select("a", "b").unionByName(e.select(b.alias("a"), a.alias("b")))
        low = e.groupBy(a.alias("u")).agg(F.min("b").alias("lo")).select("u", F.least("u", "lo").alias("m"))
        j = e.join(low, e["a"] == low["u"])
        if large:
            out = j.where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        else:
            out = j.select(b.alias("a"), F.col("m").alias("b")).unionByName(
                low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where(a != b)

    def settled(e: DataFrame) -> tuple[DataFrame, tuple]:
        seen, path = Observation(), scratch_path(spark, name)
        e = e.distinct()
        write_scratch(e.observe(seen, F.count(F.lit(1)).alias("n"),
                                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), path)
        return spark.read.schema(e.schema).parquet(path), (seen.get["n"], seen.get["sum"])

    edges, before = settled(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")))
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges, after = settled(star(star(edges, True), False))
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"{name}: components did not settle in {max_rounds} rounds")
    kind = edges.schema["a"].dataType
    if not before[0]:
        return spark.createDataFrame([], f"v {kind.simpleString()}, c {kind.simpleString()}")
    return edges.select(a.alias("v"), b.alias("c")).unionByName(
        edges.select(b.alias("v"), b.alias("c"))).distinct()


def split_rows(docs: DataFrame) -> DataFrame:
    """``row`` (every column but text, so no name can clash), ``text`` (null
    as empty) and ``had`` (false where the text was null)."""
    others = [docs[c].alias(c) for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("row"), text_of(docs).alias("text"),
                       docs["text"].isNotNull().alias("had"))


def joined_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The documents of ``split_rows`` with their new texts, in the old column
    order; ``n_chars`` is counted anew where it is present."""
    text = F.when(F.col("had") | (F.col("text") != ""), F.col("text"))

    def value(name: str) -> Column:
        if name == "text":
            return text.alias(name)
        old = F.col("row").getField(name)
        if name == "n_chars":
            return F.coalesce(F.length(text), F.lit(0)).cast(rows.schema["row"].dataType[name].dataType).alias(name)
        return old.alias(name)

    return rows.select(*(value(c) for c in columns))
