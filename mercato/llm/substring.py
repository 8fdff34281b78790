"""Substring dedup by content-defined chunking (operator 10).

A gear rolling hash over the last 32 bytes of a text sets the chunk ends, so
an insertion moves only the ends near it.  Every chunk has a 128-bit digest;
its first occurrence (smallest doc_id, then hash of the text, then place)
stays.  A run of neighbouring repeated chunks is extended to both sides as far
as its text and that of the first occurrences agree, in whole words, and cut
out when it then has ``min_run`` bytes at least, so that shorter common
phrases stay.

1. Tasks chunk whole texts and send one row per digest, slice of documents
   and block with the digest (combined within a slice before the shuffle).
2. The first occurrence of each digest is an aggregate that combines
   map-side; it is joined back to the rows, so that a digest in very many
   documents is split like any skewed join key.  Every block but that of the
   first occurrence is told of it.
3. Each block, of about ``BLOCK_BYTES`` of text, finds its runs and asks for
   the ``CONTEXT`` bytes before and after their first occurrences: each such
   place is read once by the block that holds it, and joined to who asked.
4. Each block extends its runs and cuts them out.  All passes over the
   documents read one shuffle of them.

Defined cases: null and empty texts have no chunks and stay as they are;
documents without doc_id take their order from a hash of the text; of
repeated rows the first keeps its text; texts of one doc_id are ordered by
their hash; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import block_count, chunks, joined_rows, read_table, split_rows, tidy, tidy_groups, written

MIN_CHUNK, MAX_CHUNK, MASK_BITS = 24, 256, 5  # about 56 bytes on average
MIN_RUN = 160  # bytes of a run, extended; 50 words have 250 or so
CONTEXT = 256  # bytes that a run is extended by at most, on either side
WORD = 64  # where no word ends within so many bytes, a run may end anywhere
SLICE_BYTES = 8 << 20  # of a scan partition, combined before the shuffle
BLOCK_BYTES = 8 << 20  # of text that a cutting group holds
GAP = 32  # bytes a 32-bit gear hash depends on


def gear_table(seed: int = 1) -> np.ndarray:
    """A random 32-bit value per byte; 0 for NUL, which parts documents."""
    values = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 32, 256, dtype=np.uint32)
    values[0] = 0
    return values


GEAR = gear_table()


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Ends of the chunks of each text, the last one at its length."""
    joined = np.frombuffer((b"\0" * GAP).join(texts) + b"\0" * GAP, np.uint8)
    state = GEAR[joined]
    for k in (1, 2, 4, 8, 16):  # state[i] = sum of gear[byte i - j] << j over 32 bytes
        shifted = state[:-k] << np.uint32(k)
        state[k:] += shifted
    cut = state[:-1] >> np.uint32(32 - MASK_BITS) == 0
    cut &= (joined[1:] & 0xC0) != 0x80  # not inside a character
    places = np.flatnonzero(cut) + 1
    starts = np.cumsum([0, *(len(t) + GAP for t in texts)])
    bounds = np.searchsorted(places, starts)
    out = []
    for i, text in enumerate(texts):
        ends, at, n = [], 0, len(text)
        for end in [*(places[bounds[i]:bounds[i + 1]] - starts[i]).tolist(), n]:
            if end > n or end < n and end - at < MIN_CHUNK:
                continue
            while end - at > MAX_CHUNK:
                at += MAX_CHUNK
                while text[at] & 0xC0 == 0x80:
                    at -= 1
                ends.append(at)
            if end > at and (end == n or end - at >= MIN_CHUNK):
                ends.append(end)
                at = end
        out.append(ends)
    return out


def digests(text: bytes, ends: list[int]) -> list[bytes]:
    digest = xxhash.xxh3_128_digest
    return [digest(text[a:b]) for a, b in zip([0, *ends], ends)]


def _first_in_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", SLICE_BYTES):
        texts, first = [t.encode() for t in batch["text"].to_pylist()], {}
        places = zip(*(batch[c].to_pylist() for c in ("key", "tie", "block")))
        for text, (key, tie, block), ends in zip(texts, places, chunk_ends(texts)):
            for digest, at in zip(digests(text, ends), [0, *ends]):
                old = first.get((digest, block))
                if old is None or (key, tie, at) < old:
                    first[digest, block] = (key, tie, at)
        halves = np.frombuffer(b"".join(d for d, _ in first), "<i8").reshape(-1, 2)
        blocks = np.array([b for _, b in first], np.int32)
        where = np.array(list(first.values()), np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c)) for c in (halves[:, 0], halves[:, 1], blocks, *where.T)],
            names=["hi", "lo", "block", "key", "tie", "at"])


def block_of(key, tie, blocks: int):
    return F.pmod(F.xxhash64(key, tie), F.lit(blocks)).cast("int")


def repeated_chunks(rows: DataFrame, blocks: int) -> DataFrame:
    """Per block the digests whose first occurrence (key, tie, at) lies in
    another block.  ``rows`` has the block of each document."""
    seen = rows.select("key", "tie", "block", "text").mapInArrow(
        tidy(_first_in_slice), "hi long, lo long, block int, key long, tie long, at long")
    first = seen.groupBy("hi", "lo").agg(
        F.min(F.struct("key", "tie", "at")).alias("first"), F.count("*").alias("n")).where("n > 1")
    told = seen.select("hi", "lo", "block").join(first.select("hi", "lo", "first.*"), ["hi", "lo"])
    return told.where(F.col("block") != block_of(F.col("key"), F.col("tie"), blocks))


RUNS = ("block int, key long, tie long, number int, n_chunks long, run int, begin long, end long, "
        "left_key long, left_tie long, left_at long, right_key long, right_tie long, right_at long")


def _runs(docs: pa.Table, repeated: pa.Table) -> pa.Table:
    """The runs of repeated chunks of a block's documents: (begin, end), and
    where the first occurrences of its first and last chunk begin and end.
    Each document has a row of run -1 as well."""
    halves = np.stack([repeated["hi"].to_numpy(), repeated["lo"].to_numpy()], 1).astype("<i8").tobytes()
    first = {halves[16 * i:16 * i + 16]: where for i, where in enumerate(
        zip(*(repeated[c].to_pylist() for c in ("key", "tie", "at"))))}
    own: dict[bytes, tuple[int, int, int]] = {}  # first occurrences in this block
    out, number, last = [], 0, None
    block = docs["block"][0].as_py() if docs.num_rows else 0
    docs = docs.take(pc.sort_indices(docs, [("key", "ascending"), ("tie", "ascending")]))
    texts = [t.encode() for t in docs["text"].to_pylist()]
    for text, key, tie, ends in zip(texts, docs["key"].to_pylist(), docs["tie"].to_pylist(), chunk_ends(texts)):
        number, last = number + 1 if last == (key, tie) else 0, (key, tie)
        head = (block, key, tie, number, len(ends))
        out.append((*head, -1, *[None] * 8))
        runs, begin = [], None
        for digest, at, end in zip(digests(text, ends), [0, *ends], ends):
            where = first.get(digest) or own.get(digest)
            if where in (None, (key, tie, at)) and digest not in own:
                own[digest] = (key, tie, at)
                begin = None
                continue
            if begin is None:
                begin = at
                runs.append([at, end, *where, *where])
            runs[-1][1], runs[-1][5:] = end, [where[0], where[1], where[2] + end - at]
        out.extend((*head, k, *run) for k, run in enumerate(runs))
    fields = [f.split() for f in RUNS.split(", ")]
    columns = zip(*out) if out else [[] for _ in fields]
    return pa.Table.from_arrays([pa.array(c, pa.int32() if kind == "int" else pa.int64())
                                 for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


CONTEXTS = "key long, tie long, at long, before boolean, context binary"


def _contexts(docs: pa.Table, asked: pa.Table) -> pa.Table:
    """The bytes before or after the places asked for, of a block's documents."""
    wanted = set(zip(asked["key"].to_pylist(), asked["tie"].to_pylist()))
    texts = {}
    for key, tie, text in zip(docs["key"].to_pylist(), docs["tie"].to_pylist(), docs["text"]):
        if (key, tie) in wanted and (key, tie) not in texts:
            texts[key, tie] = text.as_py().encode()
    context = [texts[key, tie][max(0, at - CONTEXT):at] if before else texts[key, tie][at:at + CONTEXT]
               for key, tie, at, before in zip(*(asked[c].to_pylist() for c in ("key", "tie", "at", "before")))]
    return pa.Table.from_arrays([*(asked[c] for c in ("key", "tie", "at", "before")), pa.array(context, pa.binary())],
                                names=["key", "tie", "at", "before", "context"])


def _agree(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def word_start(text: bytes, at: int, stop: int) -> int:
    """The first place from ``at`` on, up to ``stop``, where a word starts or
    white space; ``at``, moved to a character, where that is far."""
    for p in range(at, min(stop, at + WORD) + 1):
        if p in (0, len(text)) or text[p - 1:p].isspace() or text[p:p + 1].isspace():
            return p
    while at < stop and text[at] & 0xC0 == 0x80:
        at += 1
    return at


def word_end(text: bytes, at: int, stop: int) -> int:
    """The last place up to ``at``, from ``stop`` on, where a word ends or
    white space; ``at``, moved to a character, where that is far."""
    for p in range(at, max(stop, at - WORD) - 1, -1):
        if p in (0, len(text)) or text[p - 1:p].isspace() or text[p:p + 1].isspace():
            return p
    while stop < at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


def extended(text: bytes, runs: list[tuple[int, int, bytes, bytes]], min_run: int) -> list[tuple[int, int]]:
    """The parts to cut: runs (begin, end, bytes before the first occurrence,
    bytes after it) extended, cut back to whole words, and joined where they
    meet; those of ``min_run`` bytes at least."""
    spans: list[list[int]] = []
    for begin, end, before, after in runs:
        floor = spans[-1][1] if spans else 0
        own = text[max(floor, begin - len(before)):begin]
        begin -= _agree(own[::-1], before[::-1])
        end += _agree(text[end:end + len(after)], after)
        begin, end = max(begin, floor), max(end, floor)
        if spans and begin == floor:
            spans[-1][1] = end
        else:
            spans.append([begin, end])
    out = []
    for begin, end in spans:
        begin = word_start(text, begin, end)
        end = word_end(text, end, begin)
        if text[begin:begin + 1].isspace() and text[end - 1:end].isspace() and begin < end - 1:
            begin += 1  # the words around stay apart
        if end - begin >= min_run:
            out.append((begin, end))
    return out


def deduplicated(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """Rows (row, text, had) of ``split_rows`` with the texts cut, and per
    document n_chunks, n_repeated (passages cut) and spans: the character
    ranges cut out."""
    blocks = block_count(docs, BLOCK_BYTES)
    rows = split_rows(docs)
    rows = rows.withColumns({"key": F.coalesce(F.col("row.doc_id").cast("long"), F.xxhash64("text")),
                             "tie": F.xxhash64("text")})
    rows = rows.withColumn("block", block_of(F.col("key"), F.col("tie"), blocks))
    spans = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    kind = T.StructType([*rows.drop("key", "tie", "block").schema, T.StructField("n_chunks", T.LongType()),
                         T.StructField("n_repeated", T.LongType()), T.StructField("spans", spans)])

    def cut(docs: pa.Table, plan: pa.Table) -> pa.Table:
        runs: dict[tuple, list] = {}
        n_chunks: dict[tuple, int] = {}
        held = zip(*(plan[c].to_pylist() for c in (
            "key", "tie", "number", "n_chunks", "run", "begin", "end", "left", "right")))
        for key, tie, number, n, run, begin, end, left, right in sorted(held, key=lambda r: r[:5]):
            n_chunks[key, tie, number] = n
            if run >= 0:
                runs.setdefault((key, tie, number), []).append((begin, end, left, right))
        out: list[list] = [[], [], [], []]
        copies: dict[tuple, int] = {}
        for key, tie, text in zip(docs["key"].to_pylist(), docs["tie"].to_pylist(), docs["text"].to_pylist()):
            number = copies[key, tie] = copies.get((key, tie), -1) + 1  # of rows that are the same
            text = text.encode()
            at, kept, chars, place = 0, [], [], 0
            for a, b in extended(text, runs.get((key, tie, number), []), min_run):
                kept.append(text[at:a])
                begin_char = place + len(kept[-1].decode())
                place = begin_char + len(text[a:b].decode())
                chars.append({"begin": begin_char, "end": place})
                at = b
            for column, value in zip(out, (b"".join([*kept, text[at:]]).decode(), n_chunks[key, tie, number],
                                           len(chars), chars)):
                column.append(value)
        spans_kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.Table.from_arrays(
            [docs["row"], pa.array(out[0], pa.string()), docs["had"], pa.array(out[1], pa.int64()),
             pa.array(out[2], pa.int64()), pa.array(out[3], spans_kind)],
            names=["row", "text", "had", "n_chunks", "n_repeated", "spans"])

    dealt = rows.repartition("block")
    runs = dealt.groupBy("block").cogroup(repeated_chunks(rows, blocks).groupBy("block")).applyInArrow(tidy_groups(_runs), RUNS)
    runs = written(runs, "runs")
    sides = [(side, F.lit(side == "left")) for side in ("left", "right")]
    places = [runs.where("run >= 0").select(*(F.col(f"{side}_{c}").alias(c) for c in ("key", "tie", "at")),
                                            before.alias("before")) for side, before in sides]
    asked = places[0].unionByName(places[1]).distinct().withColumn(
        "block", block_of(F.col("key"), F.col("tie"), blocks))
    found = dealt.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(tidy_groups(_contexts), CONTEXTS)
    plan = runs
    for side, before in sides:
        of = found.where(F.col("before") == before).select(
            *(F.col(c).alias(f"{side}_{c}") for c in ("key", "tie", "at")), F.col("context").alias(side))
        plan = plan.join(of, [f"{side}_{c}" for c in ("key", "tie", "at")], "left")
    plan = plan.select("block", "key", "tie", "number", "n_chunks", "run", "begin", "end", "left", "right")
    return dealt.groupBy("block").cogroup(plan.groupBy("block")).applyInArrow(tidy_groups(cut), kind)


def dedup_substrings(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """The documents with repeated passages cut out of their texts."""
    return joined_rows(deduplicated(docs, min_run), docs.columns)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the text without repeated passages and what was cut."""
    out = deduplicated(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_chunks", "n_repeated",
                      removed.alias("n_removed"), "spans",
                      F.when(F.col("had"), F.col("text")).alias("text"))
