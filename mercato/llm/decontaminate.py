"""Benchmark decontamination by an FM-index per training shard (operator 7).

A shard is a slice of a task's documents of about ``SHARD_BYTES`` of text.
Its words become symbols of the test phrases' vocabulary (0: any other word),
and runs of known words too short for the shortest phrase are left out, which
can lose no occurrence.  Over the rest the task builds a suffix array, its
Burrows-Wheeler transform in a wavelet matrix, and suffix positions sampled
every ``SAMPLE`` places; all phrases are searched backward together, and
occurrences are located by stepping to the next sample.  Spans of hit words
are merged per document.  Nothing is shuffled.

The test phrases are taken in groups of about ``GROUP_BYTES`` of text, one
pass over the documents each; the passes but the last are written, so a plan,
a task and the driver hold the phrases of one group.

A phrase is ``WINDOW`` consecutive words of an item, or all words of a
shorter one.  Words: letters a-z (A-Z lower-cased), digits and every
character beyond ASCII.  Defined cases: null or empty texts have no words; an
item without words matches nothing; an item without id counts as the empty
id; repeated documents are treated one by one; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import chunks, joined_rows, read_table, split_rows, tidy, written

WINDOW = 10
SHARD_BYTES = 8 << 20
SAMPLE = 16
GROUP_BYTES = 32 << 20

_GAPS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Lower-cases A-Z and makes every character outside words a space.
FOLD = bytes(32 if c in _GAPS and not 65 <= c <= 90 else LOWER[c] for c in range(256))
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Phrases:
    """Distinct test phrases as symbol rows, and the items that hold each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.holders: list[list[str]] = []
        rows: dict[tuple[int, ...], int] = {}
        for item, text in items:
            words = (text or "").encode().translate(FOLD).split()
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                row = rows.setdefault(tuple(ids[i:i + window]), len(rows))
                if row == len(self.holders):
                    self.holders.append([])
                if item not in self.holders[row]:
                    self.holders[row].append(item)
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.shortest = int(self.lengths.min()) if rows else 0
        self.by_length = {}
        for n in sorted({len(r) for r in rows}):
            at = np.array([i for r, i in rows.items() if len(r) == n])
            self.by_length[n] = (at, np.array([r for r in rows if len(r) == n], np.int64))


class WaveletMatrix:
    """Rank queries over an array of symbols, one bit vector per symbol bit."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = []
        for bit in reversed(range(max(1, int(top).bit_length()))):
            ones = (symbols >> bit) & 1
            before = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(ones, out=before[1:])
            zeros = len(symbols) - int(before[-1])
            self.levels.append((bit, before, zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        low = np.zeros_like(at)
        for bit, before, zeros in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            low_ones, at_ones = before[low], before[at]
            low = np.where(one, zeros + low_ones, low - low_ones)
            at = np.where(one, zeros + at_ones, at - at_ones)
        return at - low


class FMIndex:
    """Backward search and location in ``text`` (symbols up to ``top``)."""

    def __init__(self, text: np.ndarray, top: int, sample: int = SAMPLE):
        order = suffix_array(text)
        self.last = text[order - 1]
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.tree = WaveletMatrix(self.last, top)
        kept = order % sample == 0
        self.kept, self.places = kept, order[kept]
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])

    def step(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[symbols] + self.tree.rank(symbols, at)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase row, first suffix, suffix after the last) of those found."""
        rows = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in reversed(range(phrases.shape[1])):
            symbols = phrases[rows, k]
            low, high = self.step(symbols, low), self.step(symbols, high)
            live = low < high
            rows, low, high = rows[live], low[live], high[live]
        return rows, low, high

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """Places of the suffixes: steps back to the next sampled one."""
        out, steps = np.empty_like(suffixes), 0
        live, at = np.arange(len(suffixes)), suffixes
        while len(live):
            found = self.kept[at]
            out[live[found]] = self.places[self.kept_before[at[found]]] + steps
            live, at = live[~found], at[~found]
            at = self.step(self.last[at], at)
            steps += 1
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of the cyclic text, by prefix doubling."""
    n = len(text)
    rank, k = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        key = rank * n + np.roll(rank, -k)
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or k >= n:
            return order
        k *= 2


def hits(texts: list[bytes], phrases: Phrases) -> tuple[list[np.ndarray], list[list[str]]]:
    """Per text of a shard: which of its words are hit, and the items found."""
    get = phrases.vocabulary.get
    words = [[get(w, 0) for w in t.translate(FOLD).split()] for t in texts]
    ends = np.cumsum([len(w) + 1 for w in words])  # a 0 after each text
    symbols = np.zeros(int(ends[-1]), np.int64)
    for w, end in zip(words, ends):
        symbols[end - 1 - len(w):end - 1] = w
    marks, found = np.zeros(len(symbols) + 1, np.int64), [[] for _ in texts]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], symbols != 0, [0]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= phrases.shortest if phrases.shortest else np.zeros(len(begin), bool)
    begin, end = begin[long], end[long]
    if len(begin):
        sizes = end - begin + 1  # each run with the 0 after it
        place = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        index = FMIndex(symbols[place], len(phrases.vocabulary))
        pairs = []
        for n, (ids, rows) in phrases.by_length.items():
            row, low, high = index.search(rows)
            count = high - low
            suffixes = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            at = place[index.locate(suffixes)]
            np.add.at(marks, at, 1)
            np.add.at(marks, at + n, -1)
            pairs.append(np.stack([np.searchsorted(ends, at, "right"), np.repeat(ids[row], count)], 1))
        for doc, phrase in np.unique(np.concatenate(pairs), axis=0):
            found[doc].extend(phrases.holders[phrase])
    covered = np.cumsum(marks[:-1]) > 0
    return [covered[e - 1 - len(w):e - 1] for w, e in zip(words, ends)], found


def spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Merged byte spans from the first to the last of consecutive hit words."""
    at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]]).astype(np.int8)))
    return [(at[i][0], at[j - 1][1]) for i, j in zip(edges[::2], edges[1::2])]


def phrase_groups(benchmark: DataFrame, window: int = WINDOW) -> Iterator[Phrases]:
    """The test phrases, at most about ``GROUP_BYTES`` of text at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-int(total) // GROUP_BYTES)
    for g in range(groups):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == g)
        yield Phrases([(r["item"], r["text"]) for r in part.collect()], window)


def _searched(docs: DataFrame, benchmark: DataFrame, window: int) -> tuple[DataFrame, Phrases]:
    """``split_rows`` searched for all groups of phrases but the last, and
    that one: the caller's pass over the documents searches it too."""
    out = split_rows(docs).withColumns({"n_words": F.lit(None).cast("long"), "hit": F.lit(None).cast("array<bigint>"),
                                        "item_ids": F.lit(None).cast("array<string>")})
    kind, last = out.schema, Phrases([])
    for i, phrases in enumerate(phrase_groups(benchmark, window)):
        if i:
            out = written(out.mapInArrow(tidy(_search(last)), kind), "searched")
        last = phrases
    return out, last


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (row, text and had of ``split_rows``, n_words, hit: the hit words'
    numbers as ranges [begin, end, begin, end, ...], item_ids found)."""
    rows, last = _searched(docs, benchmark, window)
    return rows.mapInArrow(tidy(_search(last)), rows.schema)


def _merged_hits(batch: pa.RecordBatch, phrases: Phrases) -> tuple[list[bytes], list[np.ndarray], list[list[str]]]:
    """The texts of a shard with their hit words and items, those of earlier
    groups of phrases included."""
    texts = [t.encode() for t in batch["text"].to_pylist()]
    covered, found = hits(texts, phrases)
    for hit, items, old, had in zip(covered, found, batch["hit"].to_pylist(), batch["item_ids"].to_pylist()):
        for i in range(0, len(old or ()), 2):
            hit[old[i]:old[i + 1]] = True
        items[:] = sorted({*items, *(had or ())})
    return texts, covered, found


def _search(phrases: Phrases):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", SHARD_BYTES):
            _, covered, items = _merged_hits(batch, phrases)
            ranges = [np.flatnonzero(np.diff(np.concatenate([[0], c, [0]]).astype(np.int8))) for c in covered]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["text"], batch["had"], pa.array([len(c) for c in covered], pa.int64()),
                 pa.array(ranges, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                names=["row", "text", "had", "n_words", "hit", "item_ids"])
    return search


def _cut(phrases: Phrases):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", SHARD_BYTES):
            texts, covered, _ = _merged_hits(batch, phrases)
            for i, hit in enumerate(covered):
                if hit.any():
                    at, parts = 0, []
                    for begin, end in spans(texts[i], hit):
                        parts.append(texts[i][at:begin])
                        at = end
                    texts[i] = b"".join([*parts, texts[i][at:]])
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array([t.decode() for t in texts], pa.string()), batch["had"]],
                names=["row", "text", "had"])
    return cut


def report(found: DataFrame) -> DataFrame:
    """One row per document: hit words and the digest of the items found."""
    n_hit = F.aggregate(F.transform("hit", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with every hit span cut out of their texts; the other
    columns are kept, ``n_chars`` is counted anew where it is present."""
    rows, last = _searched(docs, benchmark, window)
    return joined_rows(rows.mapInArrow(tidy(_cut(last)), rows.select("row", "text", "had").schema), docs.columns)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(contamination(read_table(spark, sf_dir, "documents"),
                                read_table(spark, sf_dir, "benchmark")))
