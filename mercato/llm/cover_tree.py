"""Near-duplicate vectors by a dual traversal of cover trees (operator 12).

Distances are chords between unit vectors: a cosine of 0.9 is a chord of
sqrt(0.2).  Equal vectors are one class; only classes are compared.

1. Top of the tree: pivots taken farthest first from a bounded sample, so that
   every prefix of them is a net of some radius.  Every class falls to its
   nearest pivot; the largest distance is the covering radius of the cell.
   Cells larger than ``BLOCK_BYTES`` are dealt into blocks.
2. A block's task builds its cover tree: below a node of radius r, nets of
   radii r/2, r/4, ... (powers of two), each point below the net point that
   covers it.  Every node keeps its exact covering radius and size.
3. Pairs of blocks whose cells are too far apart never meet; of the others,
   the subtrees that cannot reach the other cell stay behind.  What is left
   of two blocks meets in one task.
4. The task walks both trees at once: a pair of nodes farther apart than both
   radii and the threshold is dropped, one closer than the threshold less both
   radii links all points below, anything else is opened at its larger node,
   against all its partners together.  Pairs of points are decided by their
   cosine.  A task reports links per point and one star per component.

The result is exact; bounds carry a slack of 1e-6 against rounding.  In data
without clusters nothing is farther than the bounds allow, and all pairs of
blocks meet; most of their pairs are then told apart in single precision, within
the bound on its rounding, and only the others by their exact cosine.

Defined cases: null and zero vectors and those with a null or non-finite
component link with nothing, nor do vectors of different length; repeated
rows link with each other; null vec_ids are never the smallest of a component
that has another id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import connected_components, read_table, written
from mercato.llm.neardup import groups
from mercato.llm.vectors import finite, matrices, packed, unpacked

COSINE = 0.9
SLACK = 1e-6
BLOCK_BYTES = 4 << 20  # of vectors in a block
PIVOTS = 1024  # at most, and at most PIVOT_BYTES
PIVOT_BYTES = 4 << 20
SAMPLE = 4  # rows of the sample for each pivot
LEAF = 16  # fewer points need no nets
TILE = 2 << 20  # cosines held at once
FLUSH = 1 << 20  # links held at once
SMALL = 8  # points of a subtree that are looked at one by one at once
DENSE = 32  # with a link in this many pairs, all are told exactly at once


def signed(vectors: DataFrame) -> DataFrame:
    """(vec_id, cls, unit): the class and unit vector of each row, null where
    the row links with nothing."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, unit = [None] * batch.num_rows, [None] * batch.num_rows
            there = np.flatnonzero(batch["embedding"].is_valid())
            for rows, x in matrices(batch["embedding"].drop_null()):
                largest = np.abs(x).max(1, initial=0)
                some = largest > 0
                x = x[some] / largest[some, None]
                y = x / np.sqrt((x * x).sum(1))[:, None] + 0.0  # no negative zeros
                for k, row in zip(there[rows[some]].tolist(), y):
                    unit[k] = row.tobytes()
                    cls[k] = xxhash.xxh3_128_digest(unit[k])
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(cls, pa.binary()), pa.array(unit, pa.binary())],
                                             names=["vec_id", "cls", "unit"])

    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"),
                          F.when(finite(vectors["embedding"]), vectors["embedding"]).alias("embedding"))
    return rows.mapInArrow(sign, "vec_id long, cls binary, unit binary")


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosine))


def cosines(x: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Those of the rows p[k] and q[k]."""
    out = np.empty(len(p))
    for at in range(0, len(p), 1 << 14):
        some = slice(at, at + (1 << 14))
        out[some] = np.einsum("ij,ij->i", x[p[some]], x[q[some]])
    return out


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """The first n rows of a farthest-first order."""
    order, gap = [0], chord(x @ x[0])
    while len(order) < min(n, len(x)):
        order.append(int(gap.argmax()))
        gap = np.minimum(gap, chord(x @ x[order[-1]]))
    return x[order]


class Tree:
    """Cover tree of unit vectors, as arrays in preorder: ``point`` (row of
    each node), ``size`` (nodes of its subtree), ``radius`` (largest distance
    to a node below), ``top`` (which child of the root holds the node)."""

    def __init__(self, x: np.ndarray):
        self.x, self.point, self.size, self.radius = x, [], [], []
        tops: list[int] = []
        rows = np.arange(1, len(x))
        self.grow(0, rows, chord(x[rows] @ x[0]), tops)
        self.point, self.size, self.radius = np.array(self.point), np.array(self.size), np.array(self.radius)
        self.top = np.zeros(len(x), np.int64)
        self.top[tops] = 1
        self.top = np.cumsum(self.top)

    def grow(self, p: int, rows: np.ndarray, gap: np.ndarray, children: list[int] | None = None) -> None:
        """Appends the subtree of point p over ``rows``, ``gap`` away from it."""
        at = len(self.point)
        self.point.append(p)
        self.size.append(1 + len(rows))
        self.radius.append(float(gap.max(initial=0.0)))
        children = [] if children is None else children
        while len(rows):
            farthest = float(gap.max())
            if len(rows) <= LEAF or farthest < SLACK:
                children.extend(range(len(self.point), len(self.point) + len(rows)))
                self.point.extend(rows.tolist())
                self.size.extend([1] * len(rows))
                self.radius.extend([0.0] * len(rows))
                return
            radius = 2.0 ** (np.ceil(np.log2(farthest)) - 1)  # the power of two below
            outer = gap > radius
            for centre, own, own_gap in self.net(rows[outer], radius):
                children.append(len(self.point))
                self.grow(centre, own, own_gap)
            rows, gap = rows[~outer], gap[~outer]

    def net(self, rows: np.ndarray, radius: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Points more than ``radius`` apart that cover ``rows``, each with
        the rows that it covers and their distances."""
        x, found = self.x, []
        while len(rows):
            some = rows[:256]
            apart, alive, taken = chord(x[some] @ x[some].T) > radius, np.ones(len(some), bool), []
            for k in range(len(some)):
                if alive[k]:
                    taken.append(k)
                    alive &= apart[k]
            centres = some[taken]
            cosine = x[rows] @ x[centres].T
            nearest = cosine.argmax(1)
            gap = chord(cosine[np.arange(len(rows)), nearest])
            nearest[taken], gap[taken] = np.arange(len(taken)), 0.0
            covered = gap <= radius
            covered[:len(some)] = True
            order = np.flatnonzero(covered)[np.argsort(nearest[covered], kind="stable")]
            for k, own in enumerate(np.split(order, np.searchsorted(nearest[order], np.arange(1, len(taken))))):
                own = own[rows[own] != centres[k]]
                found.append((int(centres[k]), rows[own], gap[own]))
            rows = rows[~covered]
        return iter(found)


def numbered(values: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, all below ``end``, and the place of each value among them."""
    there = np.zeros(end, bool)
    there[values] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[values]


def spread(first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of numbers, one after the other: (which range, number)."""
    of = np.repeat(np.arange(len(many)), many)
    return of, np.arange(len(of)) - (np.cumsum(many) - many)[of] + first[of]


class Join:
    """Links within a tree, or between two trees whose arrays stand one after
    the other (``split`` is the first node of the second)."""

    def __init__(self, x: np.ndarray, size: np.ndarray, radius: np.ndarray, depth: np.ndarray, copies: np.ndarray,
                 split: int, threshold: float = COSINE):
        self.x, self.size, self.radius, self.depth, self.copies = x, size, radius, depth, copies.astype(np.float64)
        self.rough = x.astype(np.float32)
        self.rounding = (x.shape[1] + 4) * 2.0 ** -23  # more than a rough cosine is off by
        n = len(x)
        self.threshold, self.reach = threshold, float(chord(np.float64(threshold)))
        self.links, self.whole, self.glued = np.zeros(n), np.zeros(n + 1), np.zeros(n + 1, np.int64)
        self.below = np.r_[0.0, np.cumsum(self.copies)]
        self.parent = np.arange(n)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.held_rows = 0
        self.parents()
        if split < n:
            pair = [np.array([p]) for p in (0, split)]
            self.visit(pair[0], np.array([False]), pair[1], np.array([False]))
        else:
            self.within(0)
        self.flush()
        self.links += np.cumsum(self.whole)[:n]
        glued = np.flatnonzero(np.cumsum(self.glued)[:n])  # united with the node before
        self.unite(glued, glued - 1)

    def parents(self) -> None:
        """The children of every node, in order: ``child[first[p]:first[p + 1]]``."""
        n, above = len(self.x), np.full(len(self.x), -1)
        at = np.flatnonzero(self.depth == 0)
        for level in range(1, int(self.depth.max(initial=0)) + 1):
            below = np.flatnonzero(self.depth == level)
            above[below] = at[np.searchsorted(at, below) - 1]
            at = below
        self.child = np.argsort(above, kind="stable")
        self.first = np.searchsorted(above[self.child], np.arange(n + 1))

    def opened(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes as their points and their children, small ones as all of their
        points: (node, is a bare point, which of ``nodes`` it is from)."""
        of, at = spread(self.first[nodes], self.first[nodes + 1] - self.first[nodes])
        children = self.child[at]
        small = self.size[children] <= SMALL
        which, below = spread(children, np.where(small, self.size[children], 1))
        return (np.r_[nodes, below], np.r_[np.ones(len(nodes), bool), small[which]],
                np.r_[np.arange(len(nodes)), of[which]])

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while True:
            above = self.parent[r]
            if (above == r).all():
                self.parent[x] = r
                return r
            r = above

    def unite(self, p: np.ndarray, q: np.ndarray) -> None:
        while len(p):
            a, b = self.roots(p), self.roots(q)
            differ = a != b
            p, q, a, b = p[differ], q[differ], a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def link(self, p: np.ndarray, q: np.ndarray) -> None:
        self.held.append((p, q))
        self.held_rows += len(p)
        if self.held_rows > FLUSH:
            self.flush()

    def flush(self) -> None:
        if self.held:
            p, q = (np.concatenate(c) for c in zip(*self.held))
            n = len(self.links)
            self.links += np.bincount(p, self.copies[q], n) + np.bincount(q, self.copies[p], n)
            self.unite(p, q)
            self.held, self.held_rows = [], 0

    def link_all(self, p: np.ndarray, q: np.ndarray) -> None:
        """Every point below p[k] is linked with every one below q[k]."""
        for a, b in ((p, q), (q, p)):
            many = self.below[b + self.size[b]] - self.below[b]
            np.add.at(self.whole, a, many)
            np.add.at(self.whole, a + self.size[a], -many)
            np.add.at(self.glued, a + 1, 1)
            np.add.at(self.glued, a + self.size[a], -1)
        self.unite(p, q)

    def within(self, p: int) -> None:
        """Links between the points of a subtree."""
        if self.size[p] == 1:
            return
        if 2 * self.radius[p] <= self.reach - SLACK:
            inside = slice(p, p + self.size[p])
            self.links[inside] += self.below[p + self.size[p]] - self.below[p] - self.copies[inside]
            self.glued[p + 1] += 1
            self.glued[p + self.size[p]] -= 1
            return
        nodes, bare, _ = self.opened(np.array([p]))
        self.visit(nodes, bare, nodes, bare, once=True)
        for child in nodes[~bare].tolist():
            self.within(child)

    def visit(self, a: np.ndarray, a_bare: np.ndarray, b: np.ndarray, b_bare: np.ndarray, once: bool = False,
              a_of: np.ndarray | None = None, b_of: np.ndarray | None = None, pairs: np.ndarray | None = None) -> None:
        """Links between the subtrees (or bare points) a and b, of those pairs
        whose origins ``pairs`` names; ``once``: of a list with itself, each
        pair once."""
        tile = max(1, TILE // len(b))
        for at in range(0, len(a), tile):
            some, others = slice(at, at + tile), slice(at if once else 0, None)
            todo = self.tile(a[some], a_bare[some], b[others], b_bare[others], once,
                             None if pairs is None else pairs[a_of[some]][:, b_of])
            for one, other, mine, theirs, their_bare in todo:
                # the nodes of one side are opened against all their partners together
                opens, i = numbered(one, len(mine))
                others, j = numbered(other, len(theirs))
                asked = np.zeros((len(opens), len(others)), bool)
                asked[i, j] = True
                nodes, bare, of = self.opened(mine[opens])
                del i, j, one, other
                self.visit(nodes, bare, theirs[others], their_bare[others], False, of, np.arange(len(others)),
                           None if asked.all() else asked)

    def near(self, a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray,
             asked: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The asked pairs (i, j) of nodes of these radii that may hold a link,
        and their cosines."""
        cosine = self.x[a] @ self.x[b].T
        least = 1 - np.minimum(2.0, self.reach + SLACK + ra[:, None] + rb) ** 2 / 2
        near = cosine >= np.minimum(least, self.threshold)
        if asked is not None:
            near &= asked
        i, j = np.nonzero(near)
        return i, j, cosine[i, j]

    def near_points(self, a: np.ndarray, b: np.ndarray,
                    asked: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The asked pairs (i, j) of points that are linked, and their cosines.
        Most pairs are far apart: those are told in single precision."""
        near = self.rough[a] @ self.rough[b].T >= np.float32(self.threshold - self.rounding)
        if asked is not None:
            near &= asked
        rows = np.flatnonzero(near.any(1))
        i, j = np.nonzero(near[rows])
        if DENSE * len(i) > near.size:
            cosine = (self.x[a[rows]] @ self.x[b].T)[i, j]
        else:
            cosine = cosines(self.x, a[rows][i], b[j])
        linked = cosine >= self.threshold
        return rows[i[linked]], j[linked], cosine[linked]

    def tile(self, a: np.ndarray, a_bare: np.ndarray, b: np.ndarray, b_bare: np.ndarray, once: bool,
             asked: np.ndarray | None) -> list[tuple]:
        """Decides the pairs that can be decided; the others, as (rows of the
        side to open, rows of the other side, the sides' nodes)."""
        ra, rb = np.where(a_bare, 0.0, self.radius[a]), np.where(b_bare, 0.0, self.radius[b])
        found = [(np.empty(0, np.int64),) * 2 + (np.empty(0),)]
        a_point, b_point = a_bare | (self.size[a] == 1), b_bare | (self.size[b] == 1)
        for some, others in ((a_point, b_point), (a_point, ~b_point), (~a_point, b_point), (~a_point, ~b_point)):
            rows, columns = np.flatnonzero(some), np.flatnonzero(others)
            if not (len(rows) and len(columns)):
                continue
            part = None if asked is None else asked[np.ix_(rows, columns)]
            if some is a_point and others is b_point:
                i, j, near = self.near_points(a[rows], b[columns], part)
            else:
                i, j, near = self.near(a[rows], ra[rows], b[columns], rb[columns], part)
            found.append((rows[i], columns[j], near))
        i, j, near = (np.concatenate(c) for c in zip(*found))
        if once:
            later = j > i
            i, j, near = i[later], j[later], near[later]
        points = a_bare[i] & b_bare[j]
        linked = points & (near >= self.threshold)
        self.link(a[i[linked]], b[j[linked]])
        i, j, near = i[~points], j[~points], near[~points]
        whole = ~(a_bare[i] | b_bare[j]) & (chord(near) + ra[i] + rb[j] <= self.reach - SLACK)
        self.link_all(a[i[whole]], b[j[whole]])
        i, j = i[~whole], j[~whole]
        # the larger side is opened; a bare point never is
        open_a = ~a_bare[i] & (b_bare[j] | (ra[i] >= rb[j]))
        todo = [(i[open_a], j[open_a], a, b, b_bare), (j[~open_a], i[~open_a], b, a, a_bare)]
        return [t for t in todo if len(t[0])]


def depths(size: np.ndarray) -> np.ndarray:
    """Depth of each node of a preorder with subtree sizes."""
    change = np.zeros(len(size) + 1, np.int64)
    np.add.at(change, np.arange(len(size)) + 1, 1)
    np.add.at(change, np.arange(len(size)) + size, -1)
    return np.cumsum(change)[:-1]


class Layout:
    """Cells of the pivots: covering radii, and the blocks of each."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray, blocks: np.ndarray, threshold: float):
        self.pivots, self.radius, self.blocks = pivots, radius, blocks
        self.first = np.cumsum(blocks) - blocks
        self.reach = float(chord(np.float64(threshold))) + SLACK
        self.cell = np.repeat(np.arange(len(pivots)), blocks)  # of each block

    def partners(self, cell: int) -> list[int]:
        gap = chord(self.pivots @ self.pivots[cell])
        near = (gap <= self.radius + self.radius[cell] + self.reach) & (self.blocks > 0)
        return np.flatnonzero(near | (np.arange(len(gap)) == cell)).tolist()


def links(classes: DataFrame, width: int, n: int, threshold: float) -> DataFrame:
    """Links of the ``n`` classes (cls, copies, unit) of vectors of ``width``
    components: rows (cls, root, links), of each pair of blocks the classes
    that have links, their number, and a class of their component."""
    size = max(1, 8 * width)
    wanted = max(1, min(PIVOTS, PIVOT_BYTES // size, -(-n * size // BLOCK_BYTES)))
    # the lowest digests are a fair sample; n times its share is at most a few more than asked for
    share = min(1.0, (SAMPLE * wanted + 16) / n)
    cut = min((1 << 64) - 1, int(share * (1 << 64))).to_bytes(8, "big")
    sample = [r[0] for r in classes.where(F.col("cls") <= F.lit(cut + b"\xff" * 8)).select("unit").collect()]
    if not sample:  # tiny tables only
        sample = [classes.first()["unit"]]
    pivots = farthest_first(np.frombuffer(b"".join(sorted(sample))).reshape(len(sample), -1), wanted)

    def placed(layout: Layout | None):
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                cosine = unpacked(batch["unit"]) @ pivots.T
                cell = cosine.argmax(1)
                gap = chord(cosine[np.arange(len(cell)), cell])
                if layout is None:
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(gap)], names=["cell", "gap"])
                else:
                    digest = unpacked(batch["cls"], np.uint64)[:, 1]
                    block = layout.first[cell] + (digest % layout.blocks[cell].astype(np.uint64)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block), batch["cls"], batch["copies"], batch["unit"]],
                        names=["block", "cls", "copies", "unit"])
        return place

    cells = classes.select("unit").mapInArrow(placed(None), "cell long, gap double").groupBy("cell").agg(
        F.count("*").alias("n"), F.max("gap").alias("radius")).collect()  # a row for each pivot at most
    count, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for r in cells:
        count[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
    layout = Layout(pivots, radius, -(-count * size // BLOCK_BYTES), threshold)
    many = int(layout.blocks.sum())

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "block"):
            block, tree = table["block"][0].as_py(), Tree(unpacked(table["unit"]))
            x, order = tree.x[tree.point], pa.array(tree.point)
            rows = table.select(["cls", "copies", "unit"]).take(order).combine_chunks()
            tops = np.flatnonzero(np.r_[True, tree.top[1:] != tree.top[:-1]])
            own = int(layout.cell[block])
            for cell in layout.partners(own):
                reach = tree.radius[tops] + layout.radius[cell] + layout.reach
                near = chord(x[tops] @ layout.pivots[cell]) <= reach
                near[0] = True  # the root
                for other in range(int(layout.first[cell]), int(layout.first[cell] + layout.blocks[cell])):
                    keep = np.flatnonzero(near[tree.top]) if other != block else np.arange(len(x))
                    if not len(keep):
                        continue
                    size = tree.size[keep]
                    size[0] = len(keep)
                    low, high = min(block, other), max(block, other)
                    sent = rows.take(pa.array(keep))
                    arrays = [pa.array(np.full(len(keep), low * many + high)),
                              pa.array(np.full(len(keep), int(block > other), np.int32)),
                              pa.array(np.arange(len(keep), dtype=np.int32)), pa.array(size.astype(np.int32)),
                              pa.array(tree.radius[keep]), *sent.columns]
                    yield from pa.Table.from_arrays(arrays, names=names).to_batches()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "pair"):
            side, sizes = table["side"].to_numpy(), table["size"].to_numpy().astype(np.int64)
            split = int(np.searchsorted(side, 1))
            low, high = divmod(table["pair"][0].as_py(), many)
            if low != high and split in (0, len(side)):
                continue
            found = Join(unpacked(table["unit"]), sizes, table["radius"].to_numpy(),
                         np.r_[depths(sizes[:split]), depths(sizes[split:])], table["copies"].to_numpy(), split, threshold)
            hit = np.flatnonzero(found.links)
            root = table["cls"].take(pa.array(found.roots(hit)))
            yield from pa.Table.from_arrays(
                [table["cls"].take(pa.array(hit)), root, pa.array(found.links[hit].astype(np.int64))],
                names=["cls", "root", "links"]).to_batches()

    names = ["pair", "side", "pos", "size", "radius", "cls", "copies", "unit"]
    placed_rows = classes.select("cls", "copies", "unit").mapInArrow(
        placed(layout), "block long, cls binary, copies long, unit binary")
    trees = placed_rows.repartition("block").sortWithinPartitions("block", "cls").mapInArrow(
        dealt, "pair long, side int, pos int, size int, radius double, cls binary, copies long, unit binary")
    return trees.repartition("pair").sortWithinPartitions("pair", "side", "pos").mapInArrow(
        joined, "cls binary, root binary, links long")


def near_duplicates(vectors: DataFrame, threshold: float = COSINE) -> DataFrame:
    """Per row (vec_id, n_links, component_id, kept)."""
    rows = signed(vectors)
    classes = written(rows.where("cls is not null").groupBy("cls").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("unit").alias("unit")), "classes")
    widths = classes.groupBy((F.octet_length("unit") / 8).cast("int").alias("width")).count().collect()
    found = None
    for width, n in sorted(map(tuple, widths)):
        part = links(classes.where(F.octet_length("unit") == 8 * width), width, n, threshold)
        found = part if found is None else found.unionByName(part)
    own = classes.select("cls", "copies", "least")
    if found is not None:
        found = written(found, "links")
        star = connected_components(found.select(F.col("root").alias("a"), F.col("cls").alias("b")), "components")
        total = found.groupBy("cls").agg(F.sum("links").alias("links"))
        own = own.join(total, "cls", "left").join(star, own["cls"] == star["v"], "left").select(
            "cls", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("c", "cls").alias("component"))
    else:
        own = own.select("cls", "least", F.lit(0).cast("long").alias("n_links"), F.col("cls").alias("component"))
    own = written(own, "linked")
    lowest = own.groupBy("component").agg(F.min("least").alias("lowest"))
    own = own.join(lowest, "component").select("cls", "n_links", "lowest")
    out = rows.select("vec_id", F.col("cls").alias("of")).join(own, F.col("of") == own["cls"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("lowest")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def oracle() -> str:
    return f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
linked AS (
  SELECT a.vec_id AS v, b.vec_id AS w FROM vectors a JOIN vectors b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
reached AS (
  SELECT v, w FROM linked UNION SELECT r.v, l.w FROM reached r JOIN linked l ON r.w = l.v),
degrees AS (SELECT v, count(*) AS n FROM linked GROUP BY v),
lowest AS (SELECT v, min(w) AS low FROM reached GROUP BY v)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degrees d ON d.v = e.vec_id LEFT JOIN lowest l ON l.v = e.vec_id"""


def op12_cover_tree_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
