"""CSV files whose quoted fields span lines, read in many tasks per file.

Spark's multi-line CSV reader takes a file in one task, as only a scan from
the start tells whether a line break is inside quotes.  Here the files are
split as text, at line breaks, and the quotes are counted first:

1. One native aggregate takes the parity of quotes of each split (file and
   first byte); its prefix sums over a file's splits tell which splits start
   inside quotes.  Doubled quotes do not change a parity.
2. Each task joins the lines of its splits into records, starting inside or
   outside quotes as was found.  A record that goes on in the next split is
   sent as fragments, which are put together by file and place; only splits
   around such a place are read for them.
3. Records are parsed by ``from_csv`` with the reader's own options.

What reaches the driver, and the tasks, is a 64-bit number and a flag for
every split, some 10 bytes for each ``spark.sql.files.maxPartitionBytes`` of
input.  Both readings must split the files alike: a task raises on a split
whose state is not known.

A quote inside an unquoted field (``5" pipe``) is no part of the format that
can be split: ``odd_quotes`` tells such records, and ``bronze.ingest_csv``
then reads the table in one task per file.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need the Python libraries only

WHOLE, HEAD, MIDDLE, TAIL = range(4)  # what a row holds of a record
ODD = "__odd_quotes"


def text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(value, file, block, split) of every line; the lines of a split are in
    order.  Files are named by a number, as a path may be longer than a line."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return lines.select("value", F.xxhash64(file).alias("file"), block.alias("block"),
                        F.xxhash64(file, block).alias("split"))


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, split, before, inside, odd_file) of every split with
    lines: the split before it, whether it starts inside quotes, and whether
    its file's quotes do not add up."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    parity = lines.groupBy("file", "block", "split").agg((F.sum(quotes) % 2).alias("parity"))
    so_far = Window.partitionBy("file").orderBy("block")  # one small row for each split
    odd = F.sum("parity").over(Window.partitionBy("file")) % 2 == 1
    return parity.select("file", "block", "split", F.lag("split").over(so_far).alias("before"),
                         ((F.sum("parity").over(so_far) - F.col("parity")) % 2 == 1).alias("inside"),
                         odd.alias("odd_file"))


def records(lines: DataFrame, inside: dict[int, bool]) -> DataFrame:
    """(record, kind, file, block) of the records and fragments of ``lines``;
    the first record of each file, its header, is left out.  ``inside`` tells
    of every split whether it starts inside quotes."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, open_, header, kind = None, [], False, False, WHOLE
        file = block = None

        def rest() -> Iterator[pa.RecordBatch]:
            """What the split leaves unfinished."""
            if held:
                yield rows(["\n".join(held)], [MIDDLE if kind == HEAD else TAIL])

        def rows(texts: list, kinds: list) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(kinds, pa.int32()), pa.array(np.full(n, file)),
                 pa.array(np.full(n, block))], names=["record", "kind", "file", "block"])

        for batch in batches:
            splits = batch["split"].to_numpy()
            edges = np.r_[0, np.flatnonzero(splits[1:] != splits[:-1]) + 1, len(splits)]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if a == b:
                    continue
                if splits[a] != split:
                    yield from rest()
                    split, held = splits[a], []
                    file, block = batch["file"][a].as_py(), batch["block"][a].as_py()
                    if int(split) not in inside:
                        raise RuntimeError("a file is split in another way than before; set minPartitionNum")
                    open_ = inside[int(split)]
                    header, kind = block == 0, HEAD if open_ else WHOLE
                value = batch["value"].slice(a, b - a)
                odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False) % 2
                closed = (np.cumsum(odd) + open_) % 2 == 0  # outside quotes after the line
                ends = np.flatnonzero(closed)
                starts = np.r_[0, ends + 1]
                open_ = not closed[-1]
                if not len(ends):
                    held.extend(value.to_pylist())
                    continue
                texts = value.take(pa.array(ends)).to_pylist()  # most records are one line
                longer = np.flatnonzero(starts[:-1] < ends)
                if len(longer):
                    every = value.to_pylist()
                    for k, i, j in zip(longer.tolist(), starts[longer].tolist(), ends[longer].tolist()):
                        texts[k] = "\n".join(every[i:j + 1])
                texts[0] = "\n".join([*held, texts[0]])
                kinds = [kind] + [WHOLE] * (len(texts) - 1)
                kind = WHOLE
                held = value.slice(int(starts[-1])).to_pylist()
                if texts[0][-1:] == "\r" != texts[-1][-1:]:  # the file's last line may have no end
                    texts[-1] += "\r"
                if any(not t.strip("\r") for t in texts):  # no empty lines
                    full = [bool(t.strip("\r")) or k != WHOLE for t, k in zip(texts, kinds)]
                    texts, kinds = [*compress(texts, full)], [*compress(kinds, full)]
                if header and texts:
                    texts, kinds, header = texts[1:], kinds[1:], False
                yield rows(texts, kinds)
        yield from rest()

    return lines.mapInArrow(assemble, "record string, kind int, file long, block long")


def stitched(fragments: DataFrame) -> DataFrame:
    """(record) put together from the fragments of each record, in order of place."""
    in_order = Window.partitionBy("file").orderBy("block", "kind")  # a split's head is before its tail
    number = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(in_order)
    parts = fragments.withColumn("number", number).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"))
    return parts.select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))


def odd_quotes(record: Column) -> Column:
    """Whether a record has a quote that neither opens nor closes a field, nor
    is doubled inside one."""
    single = F.replace(record, F.lit('""'), F.lit(""))
    rest = F.regexp_replace(single, r'(^|,)"[^"]*"(?=,|$)', "$1")
    return F.contains(record, F.lit('"')) & F.contains(rest, F.lit('"'))


def _line_ends(record: Column) -> Column:
    """Where lines end in CR LF, the end goes, and one inside quotes becomes LF."""
    bare = F.replace(F.expr("left(record, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))
    return F.when(F.endswith(record, F.lit("\r")), bare).otherwise(record).alias("record")


class UnbalancedQuotesError(ValueError):
    pass


def read_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(record): the text of every record but the headers, read in splits."""
    lines = text_lines(spark, paths)
    states = split_states(lines).select("split", "before", "inside", "odd_file").toArrow()  # a row for each split
    if pc.any(states["odd_file"]).as_py():
        raise UnbalancedQuotesError(f"quotes do not add up in {paths}")
    inside = dict(zip(states["split"].to_pylist(), states["inside"].to_pylist()))
    whole = records(lines, inside).where(F.col("kind") == WHOLE).select("record")
    cut = states.filter(states["inside"])
    if not cut.num_rows:
        return whole.select(_line_ends(F.col("record")))
    near = spark.createDataFrame([(s,) for s in {*cut["split"].to_pylist(), *cut["before"].to_pylist()}], "near long")
    parts = records(lines.join(F.broadcast(near), lines["split"] == near["near"], "left_semi"), inside)
    every = whole.unionByName(stitched(parts.where(F.col("kind") != WHOLE)))
    return every.select(_line_ends(F.col("record")))


def read_text(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str],
              options: Mapping[str, str]) -> DataFrame:
    """The fields of CSV files as text columns ``names``, and whether the
    record has odd quotes."""
    schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in names)
    keep = {k: v for k, v in options.items() if k != "header"}
    parsed = read_records(spark, paths).select(F.from_csv("record", schema, keep).alias("row"),
                                               odd_quotes(F.col("record")).alias(ODD))
    return parsed.select("row.*", ODD)
