"""Periodic runs of words by recompression (operator 13).

A run is a stretch of words with smallest period q, as long as it can be, of
at least max(12, 2 q) words.

1. The words of a slice of documents are numbered and compressed into a
   run-length grammar: block compression names every maximal stretch of one
   letter, pair compression names the pairs of a letter of one class and the
   next of the other, and the two alternate until each document is one letter.
   A letter that stands for no block or pair is taken over unchanged.  A
   separator of its own on either side of a document is never compressed.
2. Candidates lie on a harmonic grid: a run of period q has at least
   max(q, 12 - q) word pairs (i, i + q) in a row that agree, so one of them
   has i divisible by that number.
3. A candidate whose pair agrees is extended to both sides by grammar LCE
   queries.  Equal stretches are parsed alike but for their ends, so a query
   climbs the levels while both sides start a name, passes at most one letter
   a level, and comes down again where the names differ.  All queries of a
   slice climb together as arrays.
4. Of the candidates with one stretch the smallest period stays (periods of
   one run of twice their length are multiples of the smallest).

Documents are independent: nothing is shuffled, and a task holds the words,
grammar and candidates of one slice (``SLICE_BYTES`` of text, or one longer
document, whose candidates are taken ``CANDIDATES`` at a time).

Defined cases: null, empty and white texts have no words and no runs;
repeated rows each give a row of their own; a null id is no tenth document of
the query; other columns are ignored by ``periodic_runs`` and kept by
``collapsed``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import chunks, read_table, text_of

LEAST = 12  # words of a run, and at least two periods
SLICE_BYTES = 2 << 20
GRID_WORDS = 1 << 14  # documents up to this length share one grid
CANDIDATES = 1 << 20
ROWS = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string")


class Level:
    """One sequence of the grammar.  ``letters``: names; ``starts``: word
    number of each letter (and the end); ``parent``: the letter above each;
    ``first``: of each letter above, its first letter here (and the end);
    ``blocks``: whether the letters above are blocks or pairs."""

    def __init__(self, letters: np.ndarray, starts: np.ndarray, parent=None, first=None, blocks=False):
        self.letters, self.starts, self.parent, self.first, self.blocks = letters, starts, parent, first, blocks

    def mirrored(self) -> Level:
        """The level of the same words read backwards."""
        parent = first = None
        if self.parent is not None:
            parent = self.parent[-1] - self.parent[::-1]
            first = len(self.letters) - self.first[::-1]
        return Level(self.letters[::-1], self.starts[-1] - self.starts[::-1], parent, first, self.blocks)


def _names(*columns: np.ndarray, above: int) -> np.ndarray:
    """A number from ``above`` on for each distinct row."""
    key = columns[0].astype(np.uint64)
    for column in columns[1:]:  # letters and counts are below 2 ** 32
        key = key << np.uint64(32) | column.astype(np.uint64)
    return np.unique(key, return_inverse=True)[1] + above


def grammar(letters: np.ndarray, separator: np.ndarray) -> list[Level]:
    """The levels of the run-length grammar of ``letters``; where
    ``separator`` is true nothing is compressed."""
    levels, starts, fresh = [], np.arange(len(letters) + 1), int(letters.max(initial=0)) + 1
    fixed, step = separator, 0
    while True:
        n, free = len(letters), ~fixed
        if not (free[1:] & free[:-1]).any():  # one letter a document
            levels.append(Level(letters, starts))
            return levels
        blocks = step % 2 == 0
        joined = np.zeros(n, bool)  # to the letter before
        if blocks:
            joined[1:] = (letters[1:] == letters[:-1]) & free[1:]
        else:
            mixed = (letters + (step << 32)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            left = mixed >> np.uint64(63) == 1  # the class of each letter on this level
            both = free[1:] & free[:-1]
            forth, back = left[:-1] & ~left[1:] & both, ~left[:-1] & left[1:] & both
            joined[1:] = forth if forth.sum() >= back.sum() else back
        step += 1
        if not joined.any():
            continue
        heads = np.flatnonzero(~joined)
        first, sizes = np.r_[heads, n], np.diff(np.r_[heads, n])
        above, many = letters[heads].copy(), np.flatnonzero(sizes > 1)
        second = sizes[many] if blocks else letters[heads[many] + 1]
        above[many] = _names(letters[heads[many]], second, above=fresh)
        fresh = max(fresh, int(above.max()) + 1)
        levels.append(Level(letters, starts, np.cumsum(~joined) - 1, first, blocks))
        letters, starts, fixed = above, starts[np.r_[heads, n]], fixed[heads]


def common_extension(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the words from a and from b,
    for arrays of positions a < b; the separator of b's document ends it."""
    x, y = a.copy(), b.copy()
    stop = np.full(len(a), -1)  # the level on which the letters differ
    on = np.arange(len(a))
    for h, level in enumerate(levels):
        if not len(on):
            break
        u, v, letters = x[on], y[on], level.letters
        differ = letters[u] != letters[v]
        if level.parent is not None:
            parent, first = level.parent, level.first
            inside = (first[parent[u]] != u) | (first[parent[v]] != v)
            move = np.flatnonzero(inside & ~differ)
            if level.blocks:  # to the end of the shorter rest of the blocks
                p, q = u[move], v[move]
                rest = np.minimum(first[parent[p] + 1] - p, first[parent[q] + 1] - q)
            else:
                rest = 1
            u[move] += rest
            v[move] += rest
            differ[move] = letters[u[move]] != letters[v[move]]
        x[on], y[on] = u, v
        stop[on[differ]] = h
        on = on[~differ]
        if level.parent is not None:
            x[on], y[on] = level.parent[x[on]], level.parent[y[on]]
    for h in range(int(stop.max(initial=0)), 0, -1):
        on = np.flatnonzero(stop >= h)
        level = levels[h - 1]
        u, v = level.first[x[on]], level.first[y[on]]
        end_u, end_v = level.first[x[on] + 1], level.first[y[on] + 1]
        same = np.flatnonzero(level.letters[u] == level.letters[v])
        rest = np.minimum(end_u - u, end_v - v)[same]  # a block shares its shorter length, a pair one letter
        if not level.blocks:
            rest = 1
        u[same] += rest
        v[same] += rest
        x[on], y[on] = u, v
    return levels[0].starts[x] - a


class Grid:
    """Candidates (i, j = i + q) of all periods q of a document, sorted by j,
    so that a shorter document's are the first ones."""

    def __init__(self):
        self.words, self.i, self.j = 0, np.empty(0, np.int32), np.empty(0, np.int32)

    @staticmethod
    def of_periods(n: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        q = np.arange(low, high, dtype=np.int64)
        step = np.maximum(q, LEAST - q)
        many = np.maximum(0, -(-(n - q) // step))
        i = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * np.repeat(step, many)
        return i, i + np.repeat(q, many)

    def __call__(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if n <= GRID_WORDS:
            if n > self.words:
                self.words = min(GRID_WORDS, max(1024, 2 * n))
                i, j = self.of_periods(self.words, 1, self.words // 2 + 1)
                order = np.argsort(j, kind="stable")
                self.i, self.j = i[order].astype(np.int32), j[order].astype(np.int32)
            k = np.searchsorted(self.j, n)
            yield self.i[:k], self.j[:k]
            return
        low = 1
        while low <= n // 2:  # about CANDIDATES at a time
            high = min(n // 2, max(low, low + int(low * CANDIDATES / n))) + 1
            yield self.of_periods(n, low, high)
            low = high


def runs_of(letters: np.ndarray, begins: np.ndarray, sizes: np.ndarray, grid: Grid, levels: list[Level]):
    """Arrays (start, length, period) of all runs, sorted by start and period;
    starts count from the first document's first word."""
    back = [level.mirrored() for level in levels]
    n = len(letters)
    found = [np.empty((3, 0), np.int64)]

    def extended(i: np.ndarray, j: np.ndarray) -> None:
        ahead = common_extension(levels, i, j)
        behind = common_extension(back, n - 1 - j, n - 1 - i)  # this word counts in both
        start, period = i - behind + 1, j - i
        length = j + ahead - start
        keep = length >= np.maximum(LEAST, 2 * period)
        rows = np.unique(np.array([start, length, period])[:, keep], axis=1)
        found.append(rows)

    held_i, held_j, held = [], [], 0
    for begin, size in zip(begins.tolist(), sizes.tolist()):
        if size < LEAST:
            continue
        for i, j in grid(size):
            own = letters[begin:begin + size]
            agree = np.flatnonzero(own[i] == own[j])
            held_i.append(i[agree].astype(np.int64) + begin)
            held_j.append(j[agree].astype(np.int64) + begin)
            held += len(agree)
            if held >= CANDIDATES:
                extended(np.concatenate(held_i), np.concatenate(held_j))
                held_i, held_j, held = [], [], 0
    if held:
        extended(np.concatenate(held_i), np.concatenate(held_j))
    start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    # sorted by start, length, period: the first of a stretch has its smallest period
    first = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][:len(start)]
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def altered(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words that the contract of the query looks at: every tenth
    document repeats a stretch of its words up to its end."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a, tail = h // 10 % n, 3 + h // 10 % 8
    p = 1 + (n - a) // tail
    return words[:a] + [words[a + k % p] for k in range(n - a)]


class Finder:
    """Runs of the documents of one slice."""

    def __init__(self):
        self.grid = Grid()

    def __call__(self, documents: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, length, period) arrays of each document."""
        sizes = np.array([len(d) for d in documents], np.int64)
        number = defaultdict(count(len(documents) + 1).__next__)
        begins = np.cumsum(sizes + 1) - sizes
        letters = np.empty(int(sizes.sum()) + len(documents) + 1, np.int64)
        for k, (d, at) in enumerate(zip(documents, begins.tolist())):
            letters[at - 1] = k
            letters[at:at + len(d)] = [number[w] for w in d]
        letters[-1] = len(documents)
        levels = grammar(letters, letters <= len(documents))
        start, length, period = runs_of(letters, begins, sizes, self.grid, levels)
        edges = np.searchsorted(start, np.r_[begins, len(letters)])
        for begin, a, b in zip(begins.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
            yield start[a:b] - begin, length[a:b], period[a:b]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """True for the words that no run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth)[:n] == 0


def digest(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple:
    start, length, period = runs
    best = (None,) * 4
    if len(start):
        k = np.lexsort((period, start, -length))[0]
        s, n, q = int(start[k]), int(length[k]), int(period[k])
        best = (s, n, q, 1000 * n // q)
        words = [w for w, kept in zip(words, kept_words(len(words), *runs).tolist()) if kept]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()))
    return (len(start), *best, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(words)).hexdigest())


def periodic_runs(docs: DataFrame, alter: bool = False) -> DataFrame:
    """Per document doc_id, its number of words and of runs, its longest run
    (start, length, period, exponent_milli) and digests of all runs and of the
    words that remain when every run keeps its first period only.  ``alter``
    looks at the contract's repeated words in place of the text's own."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in chunks(batches, "text", SLICE_BYTES):
            ids = batch["doc_id"].to_pylist()
            words = [t.encode().split() for t in batch["text"].to_pylist()]  # splits at ASCII white space only
            if alter:
                words = [altered(w, i) for w, i in zip(words, ids)]
            rows = [(i, len(w), *digest(w, runs)) for i, w, runs in zip(ids, words, finder(words))]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)

    schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in ROWS.split(", ")])
    names = schema.names
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(find, ROWS)


def collapsed(docs: DataFrame) -> DataFrame:
    """The documents with their texts' runs cut down to one period, words
    joined by one space; a text without a run, and null, stays as it is."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in chunks(batches, "text", SLICE_BYTES):
            texts = batch["text"].to_pylist()
            words = [(t or "").encode().split() for t in texts]
            for k, runs in enumerate(finder(words)):
                if len(runs[0]):
                    keep = kept_words(len(words[k]), *runs).tolist()
                    texts[k] = b" ".join(w for w, kept in zip(words[k], keep) if kept).decode()
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    columns = docs.select(F.struct(*(docs[c].alias(c) for c in docs.columns if c != "text")).alias("row"),
                          docs["text"].cast("string").alias("text"))
    return columns.mapInArrow(cut, columns.schema).select(
        *(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(read_table(spark, sf_dir, "documents"), alter=True)
