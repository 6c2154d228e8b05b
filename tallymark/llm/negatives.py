"""Hard negatives of anchors: rows of another label that score nearly as high as a positive.

1. Candidates are dealt into blocks, and each block's vectors, augmented by one coordinate
   that makes all their norms equal, become a cover tree: nodes of a level lie apart by more
   than its radius, and each covers its points within a known distance. The trees are written.
2. Anchors go to all blocks, in groups of bounded size. A descent takes the most promising
   node first. Its radius bounds the inner products of what it covers from both sides, so
   nodes outside of the wanted windows, or below what is already found, are skipped.
   Points of the nodes that remain are scored exactly, in whole numbers.
3. The best of each block are merged. Positives are found first; their scores are the
   windows of the second descent.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.shared import written

SCALE = 256  # a component is taken as a whole number of 256ths
ANCHOR_STEP, RELABEL_STEP, LABELS = 100, 7, 10
BEST, LEAST_PERCENT = 5, 80
BLOCK_ROWS, BLOCK_BYTES, GROUP_ANCHORS = 2048, 16 << 20, 512
BASE, LEAF = 1.2, 64
EXACT = 2.0**53  # whole numbers up to here are exact in doubles, and so are their sums
LONG = 2**63 - 1
MOST = 1e100  # components are cut there; squares of them are doubles still
SLACK = 1e-9  # of the largest square; covers rounding in the bounds

TREES = "block int, rows binary, ids binary, labels binary, points binary, nodes binary, n_dims int"
POSITIVES = "anchor long, anchor_id long, row long, found_id long, score decimal(38,0)"
NEGATIVES = "anchor long, anchor_id long, positive long, found_id long, score decimal(38,0)"


def whole(vectors: list, n_dims: int) -> np.ndarray:
    """Components in 256ths, rounded down; shorter vectors are filled up with zeros. Whole
    doubles if all their inner products are exact, else whole numbers of any size."""
    out = np.zeros((len(vectors), n_dims))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    out = np.clip(out, -MOST, MOST)
    scaled = np.floor(out * SCALE) if np.abs(out).max(initial=0) < EXACT else out
    if n_dims * np.abs(scaled).max(initial=0) ** 2 < EXACT / 4 and scaled is not out:
        return scaled
    return np.array([[math.floor(x) * SCALE + math.floor((x - math.floor(x)) * SCALE) for x in row] for row in out.tolist()], object)


class Tree:
    """A cover tree. ``points`` are ordered so that every node's own points, those that no
    child covers, and its children's stand together.

    ``nodes``: center (a point), radius, first child and after the last one, first own point
    and after the last one. The root is node 0; children of a node follow each other.
    """

    def __init__(self, points: np.ndarray, nodes: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.points, self.ids, self.labels, self.rows = points, ids, labels, rows
        self.center = nodes[:, 0].astype(np.int64)
        self.radius = nodes[:, 1]
        self.child, self.child_end, self.own, self.own_end = nodes[:, 2:].astype(np.int64).T
        self.floats = points.astype(float)
        self.squares = (self.floats**2).sum(axis=1)
        self.most = self.squares.max(initial=0.0)
        self.largest = np.abs(self.floats).max(initial=0)

    @staticmethod
    def _pairs(points: np.ndarray) -> np.ndarray:
        squares = (points**2).sum(axis=1)
        return np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * points @ points.T, 0))

    @classmethod
    def grown(cls, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> Tree:
        """Level by level: of a node's points the first not yet covered becomes a child's
        center and covers those within the next radius, so centers lie apart by more."""
        plain = points.astype(float)
        squares = (plain**2).sum(axis=1)
        lifted = np.c_[plain, np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0))]
        order: list[int] = []
        nodes: list[list[float]] = [[0, 0, 0, 0, 0, 0]]
        queue = [(0, np.arange(len(points)))]
        while queue:
            node, members = queue.pop(0)
            reach = np.sqrt(((lifted[members] - lifted[members[0]]) ** 2).sum(axis=1))
            radius = float(reach.max())
            own, children = members, []
            if len(members) > LEAF and 0 < radius < math.inf:
                level = BASE ** (math.ceil(math.log(radius, BASE)) - 1)
                own, left = [], np.arange(len(members))
                apart = cls._pairs(lifted[members])
                while len(left):
                    near = apart[left[0], left] <= level
                    near[0] = True
                    covered = members[left[near]]
                    if len(covered) < LEAF:
                        own.extend(covered)  # a child of a few points needs no node
                    else:
                        children.append(covered)
                    left = left[~near]
                if not own and len(children) == 1:  # rounding: the level covers all
                    own, children = members, []
            nodes[node] = [members[0], radius, len(nodes), len(nodes) + len(children), len(order), len(order) + len(own)]
            order.extend(own)
            for covered in children:
                queue.append((len(nodes), covered))
                nodes.append([0, 0, 0, 0, 0, 0])
        place = np.empty(len(points), np.int64)
        place[order] = np.arange(len(order))
        table = np.array(nodes, float)
        table[:, 0] = place[table[:, 0].astype(np.int64)]
        return cls(points[order], table, ids[order], labels[order], rows[order])

    def bounds(self, node: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that a point below each node can have."""
        near = self.floats[self.center[node]] @ anchor
        square = float(anchor @ anchor) + self.most
        far = np.sqrt(np.maximum(square - 2 * near, 0))
        slack = SLACK * square + 1
        low = (square - (far + self.radius[node]) ** 2) / 2
        high = (square - np.maximum(far - self.radius[node], 0) ** 2) / 2
        spread = math.sqrt(float(anchor @ anchor)) * self.radius[node]  # the plain bound may be closer
        low, high = np.maximum(low, near - spread) - slack, np.minimum(high, near + spread) + slack
        # Beyond the range of doubles nothing is known.
        return np.where(np.isnan(low), -math.inf, low), np.where(np.isnan(high), math.inf, high)

    def best(self, anchor: np.ndarray, windows: list[tuple], n: int, fits: np.ndarray) -> tuple[list[list[tuple]], int]:
        """For each window (least score, greatest score) the ``n`` best of the points that fit:
        (score, id, row), highest score first, then smallest id; and the points scored."""
        plain = anchor.astype(float)
        exact = anchor.dtype != object and self.points.dtype != object and (
            len(anchor) * np.abs(plain).max(initial=0) * self.largest < EXACT
        )
        found: list[list[tuple]] = [[] for _ in windows]
        floor = np.array([float(low) for low, _ in windows])
        roof = np.array([float(high) for _, high in windows])
        low, high = self.bounds(np.zeros(1, np.int64), plain)
        heap, scored = [(-high[0], low[0], 0)], 0
        while heap:
            high, low, node = heapq.heappop(heap)
            if -high < floor.min(initial=math.inf):
                break
            if not ((-high >= floor) & (low <= roof)).any():
                continue
            begin, end = self.own[node], self.own_end[node]
            if end > begin:
                fit = begin + np.flatnonzero(fits[begin:end])
                scored += len(fit)
                if exact:
                    scores = (self.floats[begin:end] @ plain)[fit - begin]
                else:
                    scores = np.array([sum(int(x) * int(y) for x, y in zip(p, anchor)) for p in self.points[fit]], object)
                for i, (least, greatest) in enumerate(windows):
                    lowest = max(least, found[i][-1][0]) if len(found[i]) == n else least
                    inside = np.flatnonzero((scores >= lowest) & (scores <= greatest))
                    if len(inside):
                        found[i] = self._first(found[i], scores[inside], fit[inside], n)
                        if len(found[i]) == n:
                            floor[i] = max(floor[i], float(found[i][-1][0]))
            children = np.arange(self.child[node], self.child_end[node])
            if len(children):
                lows, highs = self.bounds(children, plain)
                useful = ((highs[:, None] >= floor) & (lows[:, None] <= roof)).any(axis=1)
                for child, least, greatest in zip(children[useful].tolist(), lows[useful].tolist(), highs[useful].tolist()):
                    heapq.heappush(heap, (-greatest, least, child))
        return found, scored

    def _first(self, known: list[tuple], scores: np.ndarray, points: np.ndarray, n: int) -> list[tuple]:
        """The first ``n`` of those known and of some points, by score, id and row."""
        if len(scores) > n:
            # All that tie with the last of the best stay in, and are told apart by id.
            high = scores >= np.partition(scores, len(scores) - n)[len(scores) - n]
            scores, points = scores[high], points[high]
        new = zip(map(int, scores.tolist()), self.ids[points].tolist(), self.rows[points].tolist())
        return sorted([*known, *new], key=lambda c: (-c[0], c[1], c[2]))[:n]


def candidates(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, label, vector`` of the rows that take part, with the new labels, written."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    ident, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    moved = F.when(ident % RELABEL_STEP == 0, F.pmod(label + 1, F.lit(LABELS))).otherwise(label)
    kept = vectors.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    named = kept.select(ident.alias("vec_id"), moved.alias("label"), values.alias("vector"))
    return written(named.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")


def _grow(n_dims: int) -> Callable[[pa.Table], pa.Table]:
    """A block's rows as one row: its tree."""

    def grow(block: pa.Table) -> pa.Table:
        points = whole(block.column("vector").to_pylist(), n_dims)
        ids = block.column("vec_id").fill_null(LONG).to_numpy()  # those without an id come last
        tree = Tree.grown(points, ids, block.column("label").to_numpy(), block.column("row").to_numpy())
        nodes = np.c_[tree.center, tree.radius, tree.child, tree.child_end, tree.own, tree.own_end]
        stored = tree.points.tobytes() if points.dtype != object else repr(tree.points.tolist()).encode()
        parts = [tree.rows.astype(np.int64), tree.ids.astype(np.int64), tree.labels.astype(np.int64)]
        columns = [block.column("block")[0].as_py(), *(p.tobytes() for p in parts), stored, nodes.astype(float).tobytes(), n_dims]
        names = ["block", "rows", "ids", "labels", "points", "nodes", "n_dims"]
        types = [pa.int32(), *[pa.binary()] * 5, pa.int32()]
        return pa.table([pa.array([c], t) for c, t in zip(columns, types)], names=names)

    return grow


def _stored(trees: pa.Table) -> Tree:
    row = {name: trees.column(name)[0].as_py() for name in ("rows", "ids", "labels", "points", "nodes", "n_dims")}
    rows, ids, labels = (np.frombuffer(row[name], np.int64) for name in ("rows", "ids", "labels"))
    if row["points"][:1] == b"[" and len(row["points"]) != 8 * len(rows) * row["n_dims"]:
        points = np.array([[int(x) for x in p.strip("[] ").split(",")] for p in row["points"].decode()[1:-1].split("],")], object)
    else:
        points = np.frombuffer(row["points"]).reshape(len(rows), row["n_dims"])
    return Tree(points, np.frombuffer(row["nodes"]).reshape(-1, 6), ids, labels, rows)


def grow_trees(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """The trees of all rows, one a block, written; the number of blocks and of components."""
    n, n_dims = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    n_dims = max(1, n_dims or 0)
    fit = max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * n_dims)))
    n_blocks = max(1, math.ceil(n / fit))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int"))
    return written(dealt.groupBy("block").applyInArrow(_grow(n_dims), TREES), "trees"), n_blocks, n_dims


def _asked(anchors: DataFrame, trees: DataFrame, n_blocks: int, search: Callable, schema: str) -> DataFrame:
    """``search`` over every block's tree and every group of anchors, a task for each of both."""
    n_groups = max(1, math.ceil(anchors.count() / GROUP_ANCHORS))
    grouped = anchors.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(n_groups)).cast("int"))
    left = trees.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("group"))
    right = grouped.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    return left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(search, schema)


def _rows(schema: str, found: Iterator[tuple]) -> pa.Table:
    names = [part.split()[0] for part in schema.replace("(38,0)", "").split(", ")]
    columns = list(zip(*found)) or [()] * len(names)
    types = [*[pa.int64()] * (len(names) - 1), pa.decimal128(38, 0)]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _held(score: int) -> int:
    """Scores beyond 37 digits are cut there."""
    return max(-(10**37), min(10**37, score))


def _positives(n: int, n_dims: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(trees: pa.Table, anchors: pa.Table) -> pa.Table:
        def found() -> Iterator[tuple]:
            if not len(trees) or not len(anchors):
                return
            tree = _stored(trees)
            points = whole(anchors.column("vector").to_pylist(), n_dims)
            for anchor, *of in zip(points, *(anchors.column(c).to_pylist() for c in ("row", "vec_id", "label"))):
                row, ident, label = of
                alike = (tree.labels == label) & (tree.rows != row)
                ((best,), _) = tree.best(anchor, [(-math.inf, math.inf)], n, alike)
                for score, of_id, at in best:
                    yield row, ident, at, None if of_id == LONG else of_id, _held(score)

        return _rows(POSITIVES, found())

    return search


def _negatives(n: int, least_percent: int, n_dims: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(trees: pa.Table, anchors: pa.Table) -> pa.Table:
        def found() -> Iterator[tuple]:
            if not len(trees) or not len(anchors):
                return
            tree = _stored(trees)
            points = whole(anchors.column("vector").to_pylist(), n_dims)
            names = ("row", "vec_id", "label", "positives")
            for anchor, *of in zip(points, *(anchors.column(c).to_pylist() for c in names)):
                row, ident, label, positives = of
                scores = [int(p["score"]) for p in positives]
                windows = [(-((-least_percent * s) // 100), s) for s in scores]
                other = tree.labels != label
                best, _ = tree.best(anchor, windows, n, other)
                for positive, rows in zip(positives, best):
                    for score, of_id, _ in rows:
                        yield row, ident, positive["row"], None if of_id == LONG else of_id, _held(score)

        return _rows(NEGATIVES, found())

    return search


def mine(
    vectors: DataFrame, anchor_step: int = ANCHOR_STEP, n_positives: int = BEST, n_negatives: int = BEST,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose ``vec_id`` is divisible by ``anchor_step``. Scores are inner
    products of the components in whole 256ths, rounded down. A positive is one of the
    ``n_positives`` best other rows with the anchor's label; its negatives are the
    ``n_negatives`` best rows of other labels that score no more than it, and at least
    ``least_percent`` of it. Ties go to the smaller ``vec_id``, a null one last. A row with a
    null label, a null vector, or a component that is null or not finite takes no part; an
    empty vector scores 0, a shorter one as if filled up with zeros. Repeated rows are rows
    of their own, as anchors, positives and negatives. Other columns are not read. No rows,
    or none that fit, give no rows. Components are cut at 1e100. Scores are exact up to 37
    digits, and cut there; those that a long cannot hold are cut to its ends in the result, after they have been ranked.
    """
    rows = candidates(vectors)
    trees, n_blocks, n_dims = grow_trees(rows)
    anchors = rows.where(F.col("vec_id") % anchor_step == 0)

    near = _asked(anchors, trees, n_blocks, _positives(n_positives, n_dims), POSITIVES)
    order = [F.desc("score"), F.asc_nulls_last("found_id"), F.asc("row")]
    first = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    positives = written(near.withColumn("nth", first).where(F.col("nth") <= n_positives).drop("nth"), "positives")

    wanted = positives.groupBy("anchor").agg(F.collect_list(F.struct("row", "score")).alias("positives"))
    asking = written(anchors.join(wanted.withColumnRenamed("anchor", "row"), "row"), "anchors")
    hard = _asked(asking, trees, n_blocks, _negatives(n_negatives, least_percent, n_dims), NEGATIVES)
    order = [F.desc("score"), F.asc_nulls_last("found_id")]
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order))
    ranked = hard.withColumn("rank", rank).where(F.col("rank") <= n_negatives)
    of = positives.select("anchor", F.col("row").alias("positive"), F.col("found_id").alias("positive_id"), F.col("score").alias("of_score"))

    def as_long(score: str) -> F.Column:
        ends = F.greatest(F.least(F.col(score), F.lit(LONG).cast("decimal(38,0)")), F.lit(-LONG).cast("decimal(38,0)"))
        return ends.cast("long")

    return ranked.join(of, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"),
        as_long("of_score").alias("positive_score"), as_long("score").alias("negative_score"),
    )
