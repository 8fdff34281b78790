"""Hard negatives by coordinate pruning in length buckets (operator 11).

Vectors become integers, floor(256 x); a score is an integer inner product.
Anchors are the rows whose id is divisible by 100.  Their positives are the
best rows of their label; for each positive the best rows of other labels
whose scores lie between 30 and 90 per cent of the positive's.

1. Rows are written in order of their length (range-partitioned, so equal
   lengths split too); tasks cut them into buckets of similar length, each
   with a sorted list of every coordinate of the unit vectors.
2. Anchors are taken in rounds of bounded size, which are broadcast; the rows
   are never shuffled again.  A round first finds the positives, then the
   negatives of all its positives.
3. A bounded sample of the rows gives every anchor a score that its last
   result reaches at least; results found later raise it.  In a bucket this
   score, over both lengths, bounds the angle between anchor and row: a bucket
   where no angle is left is skipped, else each of the anchor's ``FOCUS``
   largest coordinates has a feasible range of values.  The narrowest range is
   read from its sorted list, the others narrow it, and the candidates left
   are scored exactly.  Where no range leaves out half of the bucket, the
   anchor is scored against the whole bucket by one matrix product.
4. A task keeps the best rows of each anchor (and positive); a top-k over the
   tasks' results ends each pass.

Defined cases: rows with a null id or label, a null vector, or a null or
non-finite component take no part, nor do components of 65,536 or more in
size, whose scores could exceed a long; vectors of different length have no
score; a row is not its own positive, nor is one with the same id; repeated
rows count each by itself, and a repeated anchor has its rows repeated; ties
go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import read_table, scratch_path, written
from mercato.llm.vectors import finite, matrices, packed, unpacked

SCALE = 256
LARGEST = 65536.0
POSITIVES = 5
NEGATIVES = 10
FLOOR, CEILING = 30, 90  # per cent of the positive's score
ANCHORS_EVERY = 100
ROUND_ANCHORS = 32768  # anchors of a round, at most, and of at most ROUND_BYTES
ROUND_BYTES = 16 << 20
SEED_ROWS = 2048
BUCKET_ROWS = 2048
BUCKET_SPREAD = 1.1  # longest over shortest vector of a bucket
FOCUS = 4
TILE = 1 << 21  # scores held at once
NONE = np.iinfo(np.int64).min
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, length, vec) of the rows that take part, as the query's
    contract labels them."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in matrices(batch["embedding"]):
                q = np.floor(SCALE * x)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].take(at), batch["label"].take(at), pa.array(np.sqrt((q * q).sum(1))), packed(q)],
                    names=["vec_id", "label", "length", "vec"])

    vec_id, label, x = vectors["vec_id"].cast("long"), vectors["label"].cast("int"), vectors["embedding"]
    small = F.forall(x, lambda v: F.abs(v.cast("double")) < LARGEST)
    rows = vectors.where(vec_id.isNotNull() & label.isNotNull() & finite(x) & small).select(
        vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, ((label.cast("long") + 1) % 10).cast("int")).otherwise(label).alias("label"),
        x.alias("embedding"))
    return rows.mapInArrow(scale, "vec_id long, label int, length double, vec binary")


def scores(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of q with all rows of p."""
    largest = np.abs(q).max(initial=0) * np.abs(p).max(initial=0) * q.shape[1]
    if largest < 2**53:
        return (q @ p.T).astype(np.int64)
    return q.astype(np.int64) @ p.astype(np.int64).T


def row_scores(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of q with the same rows of p."""
    return np.einsum("ij,ij->i", q.astype(np.int64), p.astype(np.int64))


class Best:
    """The k best (score, id) of each of n lists."""

    def __init__(self, n: int, k: int):
        self.score, self.id = np.full((n, k), NONE), np.zeros((n, k), np.int64)

    def least(self) -> np.ndarray:
        """What a new entry's score must reach, for each list."""
        return self.score[:, -1]

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(at):
            return
        k, lists = self.score.shape[1], np.unique(at)
        at = np.r_[at, np.repeat(lists, k)]
        score, ids = np.r_[score, self.score[lists].ravel()], np.r_[ids, self.id[lists].ravel()]
        order = np.lexsort((ids, -(score + (score == NONE)), at))  # -NONE would overflow
        at, score, ids = at[order], score[order], ids[order]
        first = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1]
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        keep = rank < k
        self.score[at[keep], rank[keep]], self.id[at[keep], rank[keep]] = score[keep], ids[keep]


class Bucket:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, p: np.ndarray, length: np.ndarray):
        self.p, self.longest = p, float(length.max())
        self.unit = p / np.maximum(length, 1e-300)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.lists = np.take_along_axis(self.unit, self.order, axis=0)

    def candidates(self, q: np.ndarray, length: np.ndarray, least: np.ndarray) -> Iterator[tuple]:
        """(anchor, row, score) arrays that hold every pair whose score
        reaches the anchor's ``least``."""
        n = len(self.p)
        size = length * self.longest
        bound = np.divide(least, size, out=np.where(least > 0, 2.0, 0.0), where=size > 0)  # of the cosine
        at = np.flatnonzero(bound <= 1 + 1e-9)  # a longer bound needs longer rows
        if not len(at):
            return
        q, length, bound = q[at], length[at], bound[at]
        unit = q / np.maximum(length, 1e-300)[:, None]
        k = min(FOCUS, q.shape[1])
        focus = np.argpartition(-np.abs(unit), k - 1, axis=1)[:, :k] if k else np.empty((len(at), 0), np.int64)
        values = np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1)
        # rows within the angle arccos(bound) of the anchor have this coordinate between
        own, angle = np.arccos(values), np.arccos(np.clip(bound, -1, 1))[:, None]
        low = np.cos(np.minimum(np.pi, own + angle)) - 1e-7
        high = np.cos(np.maximum(0, own - angle)) + 1e-7
        begin, end = np.zeros(focus.shape, np.int64), np.full(focus.shape, n)
        for f in np.unique(focus).tolist():
            i, j = np.nonzero(focus == f)
            begin[i, j] = np.searchsorted(self.lists[:, f], low[i, j], "left")
            end[i, j] = np.searchsorted(self.lists[:, f], high[i, j], "right")
        free = (bound <= 0) | (length == 0) | (np.full(len(at), k == 0))
        width = np.maximum(end - begin, 0)
        narrowest = width.argmin(1) if k else np.zeros(len(at), np.int64)
        most = width[np.arange(len(at)), narrowest] if k else np.full(len(at), n)
        dense = free | (2 * most > n)
        some = np.flatnonzero(dense)
        tile = max(1, TILE // n)
        for s in range(0, len(some), tile):
            part = some[s:s + tile]
            found = scores(q[part], self.p)
            i, j = np.nonzero(found >= least[at[part]][:, None])
            yield at[part[i]], j, found[i, j]
        some = np.flatnonzero(~dense)
        tile = max(1, TILE // max(1, 16 * self.p.shape[1]))
        ends = np.cumsum(most[some])
        s = 0
        while s < len(some):
            e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + tile, "right")))
            part, s = some[s:e], e
            many, j = most[part], narrowest[part]
            i = np.repeat(part, many)
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row = self.order[np.repeat(begin[part, j], many) + place, np.repeat(focus[part, j], many)]
            for c in range(k):
                x = self.unit[row, focus[i, c]]
                inside = (x >= low[i, c]) & (x <= high[i, c])
                i, row = i[inside], row[inside]
            found = row_scores(q[i], self.p[row])
            hit = found >= least[at[i]]
            yield at[i[hit]], row[hit], found[hit]


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Bucket]]:
    for batch in batches:
        width, length = np.array([len(v) for v in batch["vec"].to_pylist()], np.int64), batch["length"].to_numpy()
        order = np.lexsort((length, width))
        a = 0
        while a < len(order):
            own = order[a:a + BUCKET_ROWS]
            same = (width[own] == width[own[0]]) & (length[own] <= BUCKET_SPREAD * max(length[own[0]], 1.0))
            own = own[:int(same.argmin()) if not same.all() else len(own)]
            part = batch.take(pa.array(own))
            yield part, Bucket(unpacked(part["vec"]).reshape(len(own), -1), length[own])
            a += len(own)


class Round:
    """The anchors of one round: ids, labels and vectors by length."""

    def __init__(self, rows: list):
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.copies = np.array([r["copies"] for r in rows], np.int64)
        widths = np.array([len(r["vec"]) for r in rows])
        self.parts = {}
        for width in np.unique(widths).tolist():
            at = np.flatnonzero(widths == width)
            q = np.frombuffer(b"".join(bytes(rows[i]["vec"]) for i in at.tolist())).reshape(len(at), width // 8)
            self.parts[width // 8] = at, q, np.sqrt((q * q).sum(1))
        self.seeds = np.full((len(rows), POSITIVES), NONE)
        self.positives = np.zeros((len(rows), POSITIVES), np.int64), np.full((len(rows), POSITIVES), NONE)

    def best_positives(self, rows: Iterator[tuple[pa.RecordBatch, Bucket]]) -> Best:
        """The best rows of each anchor's label among ``rows``."""
        best = Best(len(self.ids), POSITIVES)
        for batch, bucket in rows:
            if bucket.p.shape[1] not in self.parts:
                continue
            at, q, length = self.parts[bucket.p.shape[1]]
            ids, labels = batch["vec_id"].to_numpy(), batch["label"].to_numpy()
            least = np.maximum(best.least(), self.seeds[:, 0])
            for i, j, score in bucket.candidates(q, length, least[at]):
                anchor = at[i]
                own = (self.labels[anchor] == labels[j]) & (self.ids[anchor] != ids[j])
                best.add(anchor[own], score[own], ids[j[own]])
        return best

    def ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of a negative of each positive; the least
        is above the largest where there is none."""
        score = self.positives[1]
        there = score != NONE
        whole, rest = np.divmod(np.where(there, score, 0), 100)
        low = FLOOR * whole - (-FLOOR * rest) // 100
        high = CEILING * whole + CEILING * rest // 100
        return np.where(there, low, 1), np.where(there, high, 0)

    def best_negatives(self, rows: Iterator[tuple[pa.RecordBatch, Bucket]]) -> Best:
        """The best rows of other labels in the range of each positive."""
        best = Best(len(self.ids) * POSITIVES, NEGATIVES)
        low, high = self.ranges()
        some = low <= high
        for batch, bucket in rows:
            if bucket.p.shape[1] not in self.parts:
                continue
            at, q, length = self.parts[bucket.p.shape[1]]
            ids, labels = batch["vec_id"].to_numpy(), batch["label"].to_numpy()
            floor = np.maximum(np.maximum(best.least().reshape(-1, POSITIVES), low), self.seeds)
            least = np.where(some, floor, np.iinfo(np.int64).max).min(1)[at]
            on = np.flatnonzero(some[at].any(1))
            for i, j, score in bucket.candidates(q[on], length[on], least[on]):
                anchor = at[on[i]]
                other = self.labels[anchor] != labels[j]
                anchor, j, score = anchor[other], j[other], score[other]
                for k in range(POSITIVES):
                    hit = some[anchor, k] & (score >= floor[anchor, k]) & (score <= high[anchor, k])
                    best.add(anchor[hit] * POSITIVES + k, score[hit], ids[j[hit]])
        return best


def best_rows(best: Best) -> Iterator[pa.RecordBatch]:
    at, _ = np.nonzero(best.score != NONE)
    there = best.score != NONE
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(best.score[there]), pa.array(best.id[there])],
                                     names=["list", "score", "id"])


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best entries of each list, ranked."""
    order = Window.partitionBy("list").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)."""
    spark = vectors.sparkSession
    rows = written(prepared(vectors).repartitionByRange("length", "vec_id").sortWithinPartitions("length"), "by-length")
    anchors = written(rows.where(F.col("vec_id") % ANCHORS_EVERY == 0).groupBy("vec_id", "label", "vec").agg(
        F.count("*").alias("copies")), "anchors")
    n, size = anchors.agg(F.count("*"), F.sum(F.octet_length("vec"))).first()
    rounds = max(1, -(-n // ROUND_ANCHORS), -(-(size or 0) // ROUND_BYTES))
    total, widest = rows.agg(F.count("*"), F.max(F.octet_length("vec"))).first()
    wanted = min(SEED_ROWS, ROUND_BYTES // max(8, widest or 8))
    share = int(min(1.0, wanted / max(1, total)) * (1 << 30))
    sample = rows.where(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(1 << 30)) < share).select(
        "vec_id", "label", "length", "vec").toArrow().combine_chunks().to_batches()
    path = scratch_path(spark, "hard-negatives")

    def searched(pass_name: str, shared) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from best_rows(getattr(shared.value, pass_name)(buckets(batches)))
        return rows.mapInArrow(search, "list long, score long, id long")

    of_round = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(rounds))
    for number in range(rounds):
        now = Round(anchors.where(of_round == number).collect())
        if not len(now.ids):
            continue
        now.seeds = np.repeat(now.best_positives(buckets(iter(sample))).least()[:, None], POSITIVES, axis=1)
        shared = spark.sparkContext.broadcast(now)
        found = top(searched("best_positives", shared), POSITIVES).collect()  # five for each anchor of the round
        shared.destroy()
        for r in found:
            now.positives[0][r["list"], r["rank"] - 1] = r["id"]
            now.positives[1][r["list"], r["rank"] - 1] = r["score"]
        now.seeds = np.full_like(now.seeds, NONE)
        now.seeds = now.best_negatives(buckets(iter(sample))).least().reshape(-1, POSITIVES).copy()
        shared = spark.sparkContext.broadcast(now)

        def named(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = shared.value
            for batch in batches:
                at, k = np.divmod(batch["list"].to_numpy(), POSITIVES)
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(held.ids[at]), pa.array(held.positives[0][at, k]), batch["rank"], batch["id"],
                     pa.array(held.positives[1][at, k]), batch["score"]], names=[c.split()[0] for c in RESULT.split(", ")])
                yield rows.take(pa.array(np.repeat(np.arange(len(at)), held.copies[at])))

        top(searched("best_negatives", shared), NEGATIVES).mapInArrow(named, RESULT).write.mode("append").parquet(path)
        shared.destroy()
    if not n:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(path)


def oracle() -> str:
    return f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % {ANCHORS_EVERY} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {FLOOR} * positive_score <= 100 * score AND 100 * score <= {CEILING} * positive_score
QUALIFY rank <= {NEGATIVES}"""


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))
