"""Token ids in ORC files (operator 6).

Documents are range-partitioned by doc_id, tokenized in order and written as
ORC: the ids are an ``array<int>`` column, stored with ORC's integer
run-length encoding; every stripe has row indexes, and a Bloom filter on
doc_id.  Readers split the files by stripe, and a filter on doc_id prunes
files, stripes and row groups by their statistics and Bloom filters.

Each row holds the ids of its part before it (``part_start``); the parts'
totals, read from that column alone, give the place in the whole stream.

Defined cases: a null or empty text holds the end id only; null doc_ids come
first; repeated rows are written once each, one after the other; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import chunks, read_table, scratch_path, text_of
from mercato.llm.tokens import worker_encoder

BATCH_BYTES = 4 << 20
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "10000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
ROWS = "part int, part_start long, doc_id long, n_tokens int, ids array<int>"


def write_token_orc(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Writes the ids of every document to ``path`` in ascending doc_id order."""

    def encode_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, start = worker_encoder(tokenizer), 0
        for batch in chunks(batches, "text", BATCH_BYTES):
            ids = encode(batch["text"].to_pylist())
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            ends = np.cumsum(sizes)
            flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            column = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch["part"], pa.array(start + ends - sizes), batch["doc_id"],
                 pa.array(sizes.astype(np.int32)), column],
                names=["part", "part_start", "doc_id", "n_tokens", "ids"])
            start += int(ends[-1])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    tie = F.xxhash64("text")  # a repeated id may span parts
    ordered = (rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie))
    parts = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    parts.mapInArrow(encode_part, ROWS).write.options(**ORC_OPTIONS).orc(path)


def _crc32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "part_start", "doc_id", "n_tokens"]
    for batch in batches:
        lists = batch["ids"]
        flat = memoryview(lists.values.to_numpy().astype("<u4")).cast("B")
        at = lists.offsets.to_numpy().astype(np.int64) * 4
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(sums, pa.int64())],
                                         names=[*names, "ids_crc32"])


def read_token_orc(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of the files in ``path``; with
    ``digest`` ids_crc32 in place of ids, taken where the file is read so that
    no ids are shuffled."""
    rows = spark.read.schema(ROWS).orc(path)
    totals = rows.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("n"))
    bases = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    if digest:
        rows = rows.mapInArrow(_crc32, ROWS.replace("ids array<int>", "ids_crc32 long"))
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"), rows.columns[-1])


def op6_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-orc")
    write_token_orc(read_table(spark, sf_dir, "documents"), path)
    return read_token_orc(spark, path, digest=True)
