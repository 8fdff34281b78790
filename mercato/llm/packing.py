"""Best-fit packing planned on the length histogram (operator 2).

1. Tasks tokenize whole texts and cut only those longer than a sequence.
2. The histogram of piece lengths (at most ``max_len`` rows, whatever the
   corpus size) goes to the driver, where best-fit decreasing runs over
   counts: a class of bins with the same room takes as many pieces of a
   length as fit, all at once.  Its output are ranges of ranks per length.
3. The ranges become one slot row per piece on the executors, and the pieces
   take their slots by an equi-join on (length, rank).  Ranks are row numbers
   within (length, hash bucket) on top of the buckets' running counts, so a
   length held by very many pieces is numbered by many tasks.

Defined cases: a null or empty text is one piece holding the end id; a null
doc_id is kept; repeated rows are packed once each; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import chunks, read_table, text_of, tidy, written
from mercato.llm.tokens import worker_encoder

MAX_LEN = 4096
BATCH_BYTES = 1 << 20
RANKS_PER_RANGE = 1 << 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, max_len: int = MAX_LEN, tokenizer: str | None = None,
           keep_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``max_len`` ids; ``ids`` (little-endian
    unsigned 32-bit) only with ``keep_ids``."""
    fields = [f for f in PIECES.split(", ") if keep_ids or not f.startswith("ids ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, step = worker_encoder(tokenizer), 4 * max_len
        for batch in chunks(batches, "text", BATCH_BYTES):
            rows: list[list] = [[] for _ in fields]
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode(batch["text"].to_pylist())):
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    values = (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for column, value in zip(rows, values):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                             names=[f.split()[0] for f in fields])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(tidy(cut), ", ".join(fields))


def plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, number of
    ranks, first sequence, offset).  Rank ``first + i`` of that length lies in
    sequence ``first sequence + i`` at ``offset``."""
    rows, room, rooms, sequences = [], {}, [], 0

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            room[left].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):  # the fullest bins that still hold this length
                left = rooms[at]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left]
                    rooms.pop(at)
            else:
                left, first, n = max_len, sequences, None
            each = left // length
            todo = count - rank
            if n is None:
                n = -(-todo // each)
                sequences += n
            full = min(n, todo // each)  # bins that take ``each`` pieces
            for k in range(each if full else 0):
                rows.append((length, rank, full, first, max_len - left + k * length))
                rank += full
            put(left - each * length, first, full)
            if full < n:
                some = min(count - rank, each - 1)  # the last pieces share one bin
                for k in range(some):
                    rows.append((length, rank, 1, first + full, max_len - left + k * length))
                    rank += 1
                if some:
                    put(left - some * length, first + full, 1)
                    full += 1
                put(left, first + full, n - full)
    return rows


def slots(spark: SparkSession, planned: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """One row per planned slot: (length, rank, sequence_id, offset)."""
    ranges = [(length, rank + i, min(RANKS_PER_RANGE, n - i), first + i, offset)
              for length, rank, n, first, offset in planned for i in range(0, n, RANKS_PER_RANGE)]
    df = spark.createDataFrame(ranges, "length long, rank0 long, n long, first long, offset long")
    return df.select("length", "offset", "rank0", "first",
                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i")).select(
        "length", (F.col("rank0") + F.col("i")).alias("rank"),
        (F.col("first") + F.col("i")).alias("sequence_id"), "offset")


def ranked(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds ``rank``: 0, 1, ... within each length, in a fixed order."""
    keys = [c for c in rows.columns if c != "ids"]
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    base = counts.select("length", "bucket", (F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("base"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*keys)) - 1
    return (rows.withColumn("own", own).join(base, ["length", "bucket"])
            .withColumn("rank", F.col("base") + F.col("own")).drop("bucket", "own", "base"))


def pack(docs: DataFrame, max_len: int = MAX_LEN, tokenizer: str | None = None,
         keep_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    rows = written(pieces(docs, max_len, tokenizer, keep_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in
                 rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= max_len rows
    buckets = max(64, sum(histogram.values()) // 100_000)
    planned = slots(spark, plan(histogram, max_len))
    out = ranked(rows, buckets).join(planned, ["length", "rank"])
    return out.select(*rows.columns, "sequence_id", "offset")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
