"""Near-duplicate documents by chosen-path similarity join (operator 5).

A document's set are its distinct shingles of five words.  Equal sets are
one class; only classes are joined.

1. Every class enters ``TREES`` independent trees.  A node of a tree is
   reached by a path of chosen minwise tokens: two classes go the same way
   with a probability equal to their similarity.  Nodes of at most ``LEAF``
   classes are compared exhaustively by sketch; larger ones branch on another
   minwise token, now and then on two, so that a pair at the threshold
   expects to stay together in one branch at any depth.  Near copies hardly
   part that way: what is larger after ``MAX_LEVELS`` is compared
   exhaustively as well, in pairs of blocks.
2. A node reports the components of its classes whose sketches agree as
   stars, at most n - 1 links, never its pairs.  The components of these links hold
   every linked pair that met in some tree.
3. Within each component the full sets are compared.  A component of more
   than ``BLOCK`` classes, or ``SET_BYTES`` of sets, is compared in pairs of
   blocks, each a task's group of its own.  Again only stars leave a group.

Recall: classes at the threshold similarity s meet in a tree with
probability s at a first-level leaf, and miss each other in all trees with
probability (1 - s) ** TREES, below 1e-12; deeper nodes lower this (about
1e-5 after five levels).  The 64-byte sketch drops a true link with
probability below 1e-7.

Defined cases: no words or null text: the empty set, linked with nothing;
fewer than five words: the whole sequence is the one shingle; repeated rows
are a class; null doc_ids are never the smallest of a component that has
another id, and a component without ids is null; other columns pass through
``deduplicated`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import chunks, connected_components, read_table, text_of, tidy, written

SHINGLE = 5
THRESHOLD = 85  # per cent
TOKENS = 64  # minwise tokens of a class
TREES = 16
LEAF = 2048
SPLIT_PER_CENT = 18  # nodes that branch twice: 1.18 branches * 0.85 = 1
MAX_LEVELS = 6
BLOCK = 2048  # classes that one side of an exact comparison holds at most, about
SET_BYTES = 32 << 20  # and bytes of their shingle sets
MATCHES = 38  # of 64 sketch bytes; a pair at 0.85 expects 54.5, deviation 2.9
SLICE_BYTES = 4 << 20

_RNG = np.random.Generator(np.random.PCG64(7))
BYTE_VALUES = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MULTIPLIERS = _RNG.integers(0, 1 << 32, TOKENS, dtype=np.uint32) | np.uint32(1)
OFFSETS = _RNG.integers(0, 1 << 32, TOKENS, dtype=np.uint32)


class Shingler:
    """Sets of 64-bit shingle hashes, by prefix sums of a polynomial hash."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 1 << 16)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, BASE, np.uint64)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, BASE_INVERSE, np.uint64)])

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct shingles of the whole text."""
        words = text.encode().lower().split()  # both fold and split ASCII only
        if not words:
            return np.empty(0, np.uint64)
        line = np.frombuffer(b" ".join(words), np.uint8)
        self.powers(len(line) + 1)
        sums = np.zeros(len(line) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[line] * self.up[:len(line)], out=sums[1:])
        gaps = np.flatnonzero(line == 32)
        starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(line)]
        n = max(1, len(words) - SHINGLE + 1)
        starts, ends = starts[:n], ends[len(words) - n:]
        x = (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        return np.unique(x)


def class_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else b""


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        part = (x[i:i + 1024, None] ^ OFFSETS) * MULTIPLIERS
        part ^= part >> np.uint32(15)
        out = np.minimum(out, (part * np.uint32(0x2C1B3C6D)).min(0))
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, hash: of the text, n_shingles, cls, tokens) of every document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in chunks(batches, "text", SLICE_BYTES):
            sets = [shingle(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["hash"], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_id(s) for s in sets], pa.binary()),
                 pa.array([minwise(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                names=["doc_id", "hash", "n_shingles", "cls", "tokens"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text_of(docs)).alias("hash"),
                       text_of(docs).alias("text"))
    return rows.mapInArrow(tidy(sign), "doc_id long, hash long, n_shingles long, cls binary, tokens binary")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _branch(level: int):
    """Children of each node row (node, id, sketch, tokens) by a minwise token
    chosen for the tree and level; ``node`` is the tree's number at level 0."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch["tokens"].to_pylist()), np.uint32).reshape(-1, TOKENS)
            ids = batch["id"]
            if level == 0:
                at = np.tile(np.arange(len(tokens)), TREES)
                tree = np.repeat(np.arange(TREES, dtype=np.uint64), len(tokens))
                node, tree = tree + np.uint64(1), tree
            else:
                node = batch["node"].to_numpy().view(np.uint64)
                tree, at = node % np.uint64(TREES), np.arange(len(node))
                twice = mix(node + np.uint64(level)) % np.uint64(100) < SPLIT_PER_CENT
                second = np.flatnonzero(twice)
                at, tree = np.r_[at, second], np.r_[tree, tree[second]]
                node = np.r_[node, node[second] ^ np.uint64(1 << 40)]
            # every node draws its token; trees differ at the first level
            drawn = tree * np.uint64(TOKENS // TREES) if level == 0 else mix(node + np.uint64(7919 * level))
            token = tokens[at, (drawn % np.uint64(TOKENS)).astype(np.int64)].astype(np.uint64)
            child = mix(mix(node * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level)) ^ token)
            child = child - child % np.uint64(TREES) + tree  # keeps the tree's number
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), ids.take(pa.array(at))], names=["node", "id"])
    return branch


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key of a stream sorted by it."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        edges = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def connected(n: int, neighbours) -> list[list[int]]:
    """Components of two or more of the vertices 0..n-1; ``neighbours(i,
    rest)`` tells which of the vertices ``rest`` are linked to vertex i.
    Every vertex is compared with every one not reached yet."""
    rest, out = np.arange(n), []
    while len(rest):
        members, at, rest = [int(rest[0])], 0, rest[1:]
        while at < len(members) and len(rest):
            hit = neighbours(members[at], rest)
            members.extend(rest[hit].tolist())
            rest = rest[~hit]
            at += 1
        if len(members) > 1:
            out.append(members)
    return out


def stars(components: list[list[int]], names) -> list[tuple]:
    """Each component as links from its smallest name to the others."""
    out = []
    for members in components:
        own = sorted({names[i] for i in members})
        out.extend((own[0], other) for other in own[1:])
    return out


def _leaf_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links: list[tuple[int, int]] = []

    def full() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)],
                                          names=["a", "b"])

    for node in groups(batches, "node"):
        if node.num_rows < 2:
            continue
        sketch = np.frombuffer(b"".join(node["sketch"].to_pylist()), np.uint8).reshape(-1, TOKENS)
        links.extend(stars(connected(len(sketch), lambda i, rest: (sketch[rest] == sketch[i]).sum(1) >= MATCHES),
                           node["id"].to_pylist()))
        if len(links) > 50_000:
            yield full()
            links = []
    yield full()


def in_pairs_of_blocks(nodes: DataFrame) -> DataFrame:
    """Rows (node, id) of nodes of n > ``LEAF`` classes, dealt so that any two
    classes of a node meet in a node of about 2 ``LEAF``."""
    blocks = F.ceil(F.col("n") / LEAF).cast("int")
    dealt = nodes.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block != other")
    return dealt.select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("node"), "id")


def candidate_clusters(classes: DataFrame) -> DataFrame:
    """(v, c): the classes (by 64-bit id) that may have a link, and a number
    of the cluster each belongs to.  ``classes``: id, tokens."""
    def low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = np.frombuffer(b"".join(batch["tokens"].to_pylist()), np.uint8).reshape(-1, 4)[:, 0]
            rows = sketch.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([rows[i:i + TOKENS] for i in range(0, len(rows), TOKENS)], pa.binary())],
                names=["id", "sketch"])

    def compared(nodes: DataFrame) -> DataFrame:
        found = (nodes.join(sketches, "id").select("node", "id", "sketch").repartition("node")
                 .sortWithinPartitions("node").mapInArrow(_leaf_links, "a long, b long"))
        return written(found.distinct(), "leaf-links")

    sketches = classes.mapInArrow(low_bytes, "id long, sketch binary")
    above, links = classes, None
    for level in range(MAX_LEVELS):
        nodes = above.mapInArrow(_branch(level), "node long, id long")
        if level:
            nodes = written(nodes, "nodes")
        sizes = nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        sizes = written(sizes, "node-sizes")
        found = compared(nodes.join(sizes.where(F.col("n") <= LEAF), "node"))
        links = found if links is None else links.unionByName(found)
        large = sizes.where(F.col("n") > LEAF)
        if large.isEmpty():
            break
        above = nodes.join(large, "node").join(classes, "id").select("node", "id", "tokens")
    else:
        links = links.unionByName(compared(in_pairs_of_blocks(nodes.join(large, "node"))))
    return connected_components(links, "clusters")


def jaccard_reaches(common: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    return 100 * common >= THRESHOLD * (n + sizes - common)


def set_components(sets: list[np.ndarray], side: np.ndarray) -> list[list[int]]:
    """Components of the exact similarity graph between sets of side 0
    and of side 1, or of all sets where every side is 0."""
    sizes = np.array([len(s) for s in sets])
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(number, kind="stable")
    holders, begins = owner[order], np.r_[0, np.cumsum(np.bincount(number))]
    starts = np.r_[0, np.cumsum(sizes)]
    both = bool(side.any())

    def neighbours(i: int, rest: np.ndarray) -> np.ndarray:
        mine = number[starts[i]:starts[i + 1]]
        a, n = begins[mine], begins[mine + 1] - begins[mine]
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(holders[at], minlength=len(sets))[rest]
        hit = jaccard_reaches(common, sizes[i], sizes[rest])
        return hit & (side[rest] != side[i]) if both else hit

    return connected(len(sets), neighbours)


def _exact_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in groups(batches, "pair"):
        cls = group["cls"].to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
        links = stars(set_components(sets, group["side"].to_numpy()), cls)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)],
                                         names=["a", "b"])


def confirmed_links(docs: DataFrame, classes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Links (a, b) with the components of the graph of similar full sets."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in chunks(batches, "text", SLICE_BYTES):
            sets = [shingle(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_id(s) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "shingles"])

    members = classes.join(clusters, classes["id"] == clusters["v"]).select(
        "cls", "doc_id", "n_shingles", F.col("c").alias("cluster"))
    members = written(members, "members")
    texts = docs.select(docs["doc_id"].cast("long").alias("of"), text_of(docs).alias("text"))
    wanted = members.select("doc_id").distinct()
    sets = texts.join(wanted, texts["of"].eqNullSafe(wanted["doc_id"]), "left_semi").select("text").mapInArrow(
        shingles, "cls binary, shingles binary").groupBy("cls").agg(F.first("shingles").alias("shingles"))
    # Large clusters are compared in pairs of blocks.
    by_bytes = F.ceil(F.sum("n_shingles") * 8 / SET_BYTES)
    count = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), by_bytes).cast("int").alias("blocks"))
    dealt = members.join(count, "cluster").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cls", F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("pair"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"))
    rows = dealt.join(sets, "cls")
    return (rows.select("pair", "cls", "side", "shingles").repartition("pair").sortWithinPartitions("pair")
            .mapInArrow(_exact_links, "a binary, b binary"))


def linked(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, hash, n_shingles, component): the smallest class
    reachable, null for the empty set."""
    signed = written(signatures(docs), "signatures")
    classes = written(signed.where("n_shingles > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"),
        F.first("tokens").alias("tokens")).withColumn(
        "id", F.xxhash64("cls")), "classes")
    clusters = candidate_clusters(classes.select("id", "tokens"))
    links = connected_components(confirmed_links(docs, classes, clusters), "classes")
    return signed.join(links, signed["cls"] == links["v"], "left").select(
        "doc_id", "hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("c", "cls")).alias("component"))


def components(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, n_shingles, component_id, kept)."""
    rows = written(linked(docs), "linked")
    lowest = rows.where("component is not null").groupBy(F.col("component").alias("of")).agg(
        F.min("doc_id").alias("lowest"))
    out = rows.join(lowest, rows["component"] == lowest["of"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component, with its columns: the one of smallest
    id (rows without id last), of repeated rows one."""
    key = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("hash")]
    rows = linked(docs).select(*key, "component")
    first = written(rows.where("component is not null").groupBy("component").agg(
        F.min(F.struct("no_id", "id", "hash")).alias("k")).select("k.*").unionByName(
        rows.where("component is null").select("no_id", "id", "hash")).distinct(), "kept")
    own = docs.select(F.struct(*(docs[c].alias(c) for c in docs.columns)).alias("row"),
                      docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text_of(docs)).alias("hash"))
    same = ["no_id", "id", "hash"]
    kept = own.select("row", *key).join(first, same, "left_semi")
    once = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(1)))
    return kept.withColumn("n", once).where("n = 1").select(
        *(F.col("row").getField(c).alias(c) for c in docs.columns))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read_table(spark, sf_dir, "documents"))
