"""Context-tree weighting over bytes (operator 1).

A text is its UTF-8 bytes and an end symbol.  Each byte is eight binary
decisions; every decision keeps Krichevsky-Trofimov counts in the contexts of
0 to ``DEPTH`` preceding bytes, and the weighting mixes the estimates of all
depths:  P_w = 1/2 P_KT + 1/2 product of the children's P_w.

1. *Count*: tasks count the strings of ``DEPTH`` + 1 bytes (grams) and the
   words of their training documents, combined before the shuffle; grams of
   the other documents enter with count 0.
2. *Learn*: grams are dealt by their nearest ``CUT`` context bytes, so that
   whole subtrees are in one task; those are weighted bottom-up there.  The
   tree above has at most 256 * 255 nodes at depth 1, whatever the corpus;
   these are summed by Spark and finished on the driver.  Every gram gets its
   code length once.
3. *Score*: the most frequent grams and words, at most ``TOP_GRAMS`` and
   ``TOP_WORDS`` of them, are broadcast.  Blocks of documents of about
   ``BLOCK_BYTES`` of text ask for the others; the requests are joined with
   the model and each block scores its documents from the two.

Defined cases: null text is empty and codes its end symbol alone; a null
doc_id counts as the empty text (held out); repeated rows learn and score
once each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import block_count, chunks, few_rows, read_table, text_of, tidy, tidy_groups, written

DEPTH = 5
CUT = 2
FOLDS = 10  # documents whose crc32(doc_id) is 0 modulo this are held out
BLOCK_BYTES = 8 << 20
COUNTED_BYTES = 48 << 20  # text whose counts a task combines before it sends them
TOP_GRAMS, TOP_WORDS = 1 << 20, 1 << 19
SLICE_CODES = 1 << 20
TREE_GRAMS = 50_000  # grams weighted at a time
SENT_ROWS = 1 << 16  # rows of a batch that a task returns
START, END = 0xFE, 0xFF  # bytes that UTF-8 never holds
GRAM, WORD = 0, 1


def grams(texts: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """The gram at every byte and end: the symbol in the low byte, the
    preceding byte above it, and so on."""
    pad, end = bytes([START]) * depth, bytes([END])
    line = b"".join(x for t in texts for x in (pad, t, end))
    # Eight bytes from every place of the reversed line are a gram and what precedes it.
    wide = np.ndarray(len(line), "<u8", line[::-1] + bytes(8), strides=(1,))[::-1]
    return wide[np.frombuffer(line, np.uint8) != START] & np.uint64((1 << 8 * (depth + 1)) - 1)


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and their counts."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.diff(np.r_[first, len(codes)])


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def all_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z lower-cased, one after the other, and where
    those of each text begin and end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten()
    there = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end gives empty ones
    before = np.r_[0, np.cumsum(there)]
    edges = before[np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))].astype(np.int64)]
    return words.filter(pa.array(there)).cast(pa.binary()), edges


def listed(array: pa.Array) -> list:
    return array.to_numpy(zero_copy_only=False).tolist()


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, at most about twice ``BLOCK_BYTES`` at a time."""
    held, size, last = [], 0, None
    for batch in chunks(batches, "text", 1 << 20):
        blocks = batch["block"].to_numpy()
        edges = np.r_[0, np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, len(blocks)]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if held and (blocks[a] != last or size > 2 * BLOCK_BYTES):
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size, last = size + held[-1].nbytes, blocks[a]
    if held:
        yield pa.Table.from_batches(held)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes of several counts and the sums of their counts;
    ``parts`` is emptied, so that they are not held beside the result."""
    codes, n = (np.concatenate(c) for c in zip(*parts))
    parts.clear()
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def _kinds(codes: np.ndarray, keys: np.ndarray) -> pa.Array:
    return pa.array(np.repeat(np.array([GRAM, WORD], np.int8), [len(codes), len(keys)]))


def _counts(depth: int):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, size = {}, [], 0
        held, held_bytes = [], 0  # words not in ``words`` yet

        def full() -> Iterator[pa.RecordBatch]:
            take()
            codes, n = merged(parts)
            keys = np.fromiter(map(word_key, words), np.uint64, len(words))
            n = np.r_[n, np.fromiter(words.values(), np.int64, len(words))]
            words.clear()
            return few_rows(pa.RecordBatch.from_arrays(
                [_kinds(codes, keys), pa.array(np.r_[codes, keys].view(np.int64)), pa.array(n)],
                names=["kind", "key", "n"]), SENT_ROWS)

        def take() -> None:
            nonlocal held, held_bytes
            if held:
                found = pa.chunked_array(held).value_counts()
                for word, n in zip(listed(found.field("values")), listed(found.field("counts"))):
                    words[word] = words.get(word, 0) + n
                held, held_bytes = [], 0

        for batch in chunks(batches, "text", SLICE_CODES):
            texts, train = batch["text"].cast(pa.binary()).to_pylist(), batch["train"].to_pylist()
            held.append(all_words(batch["text"].filter(batch["train"]))[0])
            held_bytes += held[-1].nbytes
            if held_bytes > BLOCK_BYTES:
                take()
            parts.append(counted(grams([t for t, x in zip(texts, train) if x], depth)))
            asked = counted(grams([t for t, x in zip(texts, train) if not x], depth))[0]
            parts.append((asked, np.zeros(len(asked), np.int64)))
            if len(parts) > 16:
                parts.append(merged(parts))
            size += sum(map(len, texts))
            if size > COUNTED_BYTES:
                yield from full()
                size = 0
        if parts:
            yield from full()
    return counts


def _requests(depth: int, top):
    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_held, words_held = top.value  # sent as the tables to look in; a worker holds nothing beside them
        for block in _by_block(batches):
            words, parts = set(), []
            for batch in chunks(iter(block.to_batches()), "text", SLICE_CODES):
                codes = counted(grams(batch["text"].cast(pa.binary()).to_pylist(), depth))[0]
                codes = codes[~grams_held.holds(codes)]
                parts.append((codes, codes))
                words.update(listed(all_words(batch["text"])[0].unique()))
            codes = merged(parts)[0]
            keys = np.fromiter(map(word_key, words), np.uint64, len(words))
            keys = keys[~words_held.holds(keys)]
            at = np.full(len(codes) + len(keys), block["block"][0].as_py(), np.int32)
            yield from few_rows(pa.RecordBatch.from_arrays(
                [pa.array(at), _kinds(codes, keys), pa.array(np.r_[codes, keys].view(np.int64))],
                names=["block", "kind", "key"]), SENT_ROWS)
    return requests


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps up; x >= 1/2."""
    low = np.zeros_like(x)
    for k in range(8):
        low += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - low


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability of a zeros and b ones by Krichevsky and Trofimov."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


def decisions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decision nodes (1 to 255) and bits of each gram's symbol."""
    symbol = (codes & np.uint64(255))[:, None]
    step = np.arange(8, dtype=np.uint64)
    node = (np.uint64(1) << step) | (symbol >> (np.uint64(8) - step))
    bit = (symbol >> (np.uint64(7) - step)) & np.uint64(1)
    return node, bit.astype(bool)


def node_keys(codes: np.ndarray, node: np.ndarray, depth: int) -> np.ndarray:
    """Context of ``depth`` bytes above the decision node's number."""
    context = (codes >> np.uint64(8)) & np.uint64((1 << 8 * depth) - 1)
    return (context[:, None] << np.uint64(8)) | node


def weighted(a: np.ndarray, b: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(log P_w, posterior weight of stopping here); ``below``: the sum of
    the children's log P_w, None at the deepest level."""
    own = log_kt(a, b)
    if below is None:
        return own, np.ones_like(own)
    both = np.logaddexp(own, below) - np.log(2)
    return both, np.exp(own - np.log(2) - both)


def weigh_subtrees(codes: np.ndarray, n: np.ndarray, depth: int = DEPTH, cut: int = CUT):
    """Bottom-up weighting of whole subtrees below depth ``cut``.

    Returns the probability of each gram's eight bits mixed over the depths
    ``cut`` to ``depth``, and the nodes at depth ``cut``: keys, counts of zeros
    and ones, log P_w."""
    node, bit = decisions(codes)
    count = np.broadcast_to(n[:, None].astype(float), bit.shape)
    p = below = keys = log_w = None
    for d in range(depth, cut - 1, -1):
        at = node_keys(codes, node, d)
        old, (keys, where) = keys, np.unique(at, return_inverse=True)
        where = where.reshape(at.shape)
        ones = np.bincount(where[bit], weights=count[bit], minlength=len(keys))
        zeros = np.bincount(where[~bit], weights=count[~bit], minlength=len(keys))
        if old is not None:
            parent = ((old >> np.uint64(8) & np.uint64((1 << 8 * d) - 1)) << np.uint64(8)) | (old & np.uint64(255))
            below = np.bincount(np.searchsorted(keys, parent), weights=log_w, minlength=len(keys))
        log_w, stop = weighted(zeros, ones, below)
        one = (ones + 0.5) / (zeros + ones + 1)
        kt = np.where(bit, one[where], 1 - one[where])
        p = kt if p is None else stop[where] * kt + (1 - stop[where]) * p
    return p, keys, zeros, ones, log_w


def _subtrees(depth: int):
    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows)
            codes = table["key"].to_numpy().view(np.uint64)
            p, keys, zeros, ones, log_w = weigh_subtrees(codes, table["n"].to_numpy(), depth)
            packed, g, k = p.astype("<f4").tobytes(), len(codes), len(keys)
            nothing = np.zeros(g)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.r_[codes, keys].view(np.int64)),
                 pa.array([packed[32 * i:32 * i + 32] for i in range(g)] + [None] * k, pa.binary()),
                 pa.array(np.r_[table["n"].to_numpy(), np.zeros(k, np.int64)]),
                 *(pa.array(np.r_[nothing, x]) for x in (zeros, ones, log_w))],
                names=["key", "p", "n", "a", "b", "log_w"])

        held, size, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            trees = batch["tree"].to_numpy()
            edges = np.r_[0, np.flatnonzero(trees[1:] != trees[:-1]) + 1, len(trees)]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if size > TREE_GRAMS and trees[a] != last:
                    yield done(held)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size, last = size + b - a, trees[a]
        if held:
            yield done(held)
    return subtrees


def top_of_tree(nodes: list[tuple[int, float, float, float]]) -> list[tuple[np.ndarray, ...]]:
    """Levels 1 and 0: sorted keys, probability of a one, weight of stopping.
    ``nodes``: the at most 65,280 nodes at depth 1 (key, zeros, ones, sum of
    the children's log P_w)."""
    nodes = sorted(nodes)
    keys = np.array([r[0] for r in nodes], np.uint64)
    zeros, ones, below = (np.array([r[i] for r in nodes], float) for i in (1, 2, 3))
    out = []
    for _ in range(2):
        log_w, stop = weighted(zeros, ones, below)
        out.append((keys, (ones + 0.5) / (zeros + ones + 1), stop))
        keys, where = np.unique(keys & np.uint64(255), return_inverse=True)
        zeros, ones, below = (np.bincount(where, weights=x, minlength=len(keys)).astype(float)
                              for x in (zeros, ones, log_w))
    return out


def _code_lengths(top):
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch["key"].to_numpy().view(np.uint64)
            p = np.frombuffer(b"".join(batch["p"].to_pylist()), "<f4").reshape(-1, 8).astype(float)
            node, bit = decisions(codes)
            for d, (keys, one, stop) in zip((1, 0), top):
                where = np.searchsorted(keys, node_keys(codes, node, d))
                p = stop[where] * np.where(bit, one[where], 1 - one[where]) + (1 - stop[where]) * p
            yield pa.RecordBatch.from_arrays([batch["key"], batch["n"], pa.array(np.log2(p).sum(1))],
                                             names=["key", "n", "value"])
    return lengths


def code_lengths(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, n, value): log2 probability of each gram's symbol in its context,
    from the corpus counts (key, n)."""
    tree = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * CUT) - 1))
    dealt = counts.withColumn("tree", tree).repartition("tree").sortWithinPartitions("tree")
    model = written(dealt.mapInArrow(tidy(_subtrees(depth)), "key long, p binary, n long, a double, b double, log_w double"), "ctw")
    # A node's key holds its context above the decision number; depth 1 keeps the nearest byte.
    parent = F.col("key").bitwiseAND(F.lit(0xFFFF))
    depth1 = model.where("p is null").groupBy(parent.alias("key")).agg(F.sum("a"), F.sum("b"), F.sum("log_w"))
    top = top_of_tree([tuple(r) for r in depth1.collect()])  # at most 256 * 255 rows
    return model.where("p is not null").select("key", "p", "n").mapInArrow(
        tidy(_code_lengths(top)), "key long, n long, value double")


class Lookup:
    """Values by 64-bit key: tables of hashed slots, each with the keys that
    found their slot taken in those before.  A table has two to four slots a key."""

    ABSENT = -1e30

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels, salt = [], 0x9E3779B97F4A7C15
        while len(keys):
            bits = max(4, (2 * len(keys) - 1).bit_length())
            salt = salt * 0xD1342543DE82EF95 % (1 << 64) | 1
            slot = self.slots(keys, salt, bits)
            held, value = np.full(1 << bits, np.uint64((1 << 64) - 1)), np.zeros(1 << bits, values.dtype)
            held[slot] = keys
            placed = held[slot] == keys
            value[slot[placed]] = values[placed]
            self.levels.append((salt, bits, held, value))
            keys, values = keys[~placed], values[~placed]

    @staticmethod
    def slots(keys: np.ndarray, salt: int, bits: int) -> np.ndarray:
        return ((keys * np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        return self(keys, self.ABSENT) != self.ABSENT

    def __call__(self, keys: np.ndarray, absent: float = 0.0) -> np.ndarray:
        out, rest = np.full(len(keys), absent), None
        for salt, bits, held, value in self.levels:
            asked = keys if rest is None else keys[rest]
            slot = self.slots(asked, salt, bits)
            hit = held[slot] == asked
            if rest is None:
                out[hit] = value[slot[hit]]
                rest = np.flatnonzero(~hit)
            else:
                out[rest[hit]] = value[slot[hit]]
                rest = rest[~hit]
            if not len(rest):
                break
        return out


def found(first: Lookup, second: Lookup, keys: np.ndarray) -> np.ndarray:
    """Values from one table, those absent there from the other, else 0."""
    out = first(keys, Lookup.ABSENT)
    rest = np.flatnonzero(out == Lookup.ABSENT)
    out[rest] = second(keys[rest])
    return out


def frequent(values: DataFrame):
    """Threshold bins on a log scale of counts: at most ``TOP_GRAMS`` grams and
    ``TOP_WORDS`` words lie above theirs.  Returns the condition and the rows
    that meet it, as one table per kind."""
    scale = F.floor(F.log2(F.col("n") + 1) * 16).cast("int")
    sizes = values.groupBy("kind", scale.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()  # <= 2 * 16 * 64
    above = F.lit(False)
    for kind, most in ((GRAM, TOP_GRAMS), (WORD, TOP_WORDS)):
        least, held = 10_000, 0
        for b, n in sorted(((r["bin"], r["n"]) for r in sizes if r["kind"] == kind), reverse=True):
            if held + n > most:
                break
            least, held = b, held + n
        above = above | ((F.col("kind") == kind) & (scale >= least))
    rows = values.where(above).select("kind", "key", "value").toArrow()
    kind, key = rows["kind"].to_numpy(), rows["key"].to_numpy().view(np.uint64)
    value = rows["value"].to_numpy()
    return above, (Lookup(key[kind == GRAM], value[kind == GRAM].astype(np.float32)),
                   Lookup(key[kind == WORD], value[kind == WORD]))


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double, n_bytes long, bits_per_byte double")


def _score(n_train: int, n_distinct: int, n_docs: int, depth: int, top):
    def score(docs: pa.Table, model: pa.Table) -> pa.Table:
        kind, key = model["kind"].to_numpy(), model["key"].to_numpy().view(np.uint64)
        value = model["value"].to_numpy()
        own = [Lookup(key[kind == k], value[kind == k]) for k in (GRAM, WORD)]
        bits, count = (partial(found, *tables) for tables in zip(top.value, own))
        total = n_train + 0.1 * (n_distinct + 1)
        end = (np.log10((n_docs + 0.1) / total), n_docs > 0)
        columns: list[list] = [[] for _ in SCORES.split(", ")]
        memo: dict[bytes, float] = {}
        for batch in chunks(iter(docs.to_batches()), "text", SLICE_CODES):
            texts = batch["text"].cast(pa.binary()).to_pylist()
            words, edges = all_words(batch["text"])
            words = words.dictionary_encode()
            distinct, at = listed(words.dictionary), words.indices.to_numpy()
            new = [w for w in distinct if w not in memo]
            memo.update(zip(new, count(np.array([word_key(w) for w in new], np.uint64)).tolist()))
            counts = np.array([memo[w] for w in distinct], float)
            base = np.log10((counts + 0.1) / total)[at].tolist()
            known = np.r_[0, np.cumsum((counts > 0)[at])][edges].tolist()
            edges = edges.tolist()
            sizes = np.array([len(t) + 1 for t in texts])
            length = np.add.reduceat(bits(grams(texts, depth)), np.cumsum(sizes) - sizes)
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                values = (batch["doc_id"][i].as_py(), not batch["train"][i].as_py(), b - a + 1,
                          known[i + 1] - known[i] + end[1], n_train, sum(base[a:b]) + end[0],
                          length[i] * np.log10(2), int(sizes[i]) - 1, -length[i] / sizes[i])
                for column, v in zip(columns, values):
                    column.append(v)
        kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, pa.float64(), pa.float64(), pa.int64(), pa.float64()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                    names=[f.split()[0] for f in SCORES.split(", ")])
    return score


def scores(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Every document under the model of the training documents."""
    spark = docs.sparkSession
    doc_id = docs["doc_id"].cast("long")
    train = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS != 0
    rows = docs.select(doc_id.alias("doc_id"), text_of(docs).alias("text"), train.alias("train"))
    counts = written(rows.select("train", "text").mapInArrow(tidy(_counts(depth)), "kind byte, key long, n long")
                     .groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    word = F.col("kind") == WORD
    n_words, distinct = counts.where(word).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_docs = rows.where("train").count()
    n_train, n_distinct = n_words + n_docs, distinct + (n_docs > 0)
    values = written(code_lengths(counts.where(~word).select("key", "n"), depth).select(
        F.lit(GRAM).cast("byte").alias("kind"), "key", "n", "value"), "lengths").unionByName(
        counts.where(word).withColumn("value", F.col("n").cast("double")))
    above, held = frequent(values)
    top = spark.sparkContext.broadcast(held)
    blocks = block_count(docs, BLOCK_BYTES)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    # The requests and the scoring read the same shuffle of the documents.
    dealt = rows.withColumn("block", block).repartition("block")
    asked = dealt.sortWithinPartitions("block").mapInArrow(tidy(_requests(depth, top)), "block int, kind byte, key long")
    model = asked.join(values.where(~above).select("kind", "key", "value"), ["kind", "key"])
    return dealt.groupBy("block").cogroup(model.groupBy("block")).applyInArrow(
        tidy_groups(_score(n_train, n_distinct, n_docs, depth, top)), SCORES)


def op1_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(read_table(spark, sf_dir, "documents"))
