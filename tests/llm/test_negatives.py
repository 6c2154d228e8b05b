"""Hard negatives against scoring all pairs, and what the trees promise."""

import math
import random

import numpy as np
import pytest

from tallymark.llm import negatives
from tallymark.llm.negatives import LONG, Tree, whole

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, step=100, n_positives=5, n_negatives=5, least=80):
    taken = []
    for ident, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if ident is not None and ident % 7 == 0:
            label = (label + 1) % 10
        taken.append((ident, [math.floor(x) * 256 + math.floor((x - math.floor(x)) * 256) for x in vector], label))

    def cut(score):
        return max(-LONG, min(LONG, score))

    out = []
    for at, (anchor, a, label) in enumerate(taken):
        if anchor is None or anchor % step:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b)), LONG if i is None else i, other == label)
            for j, (i, b, other) in enumerate(taken) if j != at
        )
        for positive, of, _ in [s for s in scored if s[2]][:n_positives]:
            inside = [s for s in scored if not s[2] and least * -positive <= 100 * -s[0] <= 100 * -positive]
            for rank, (score, ident, _) in enumerate(inside[:n_negatives], 1):
                out.append((anchor, of if of != LONG else None, rank, ident if ident != LONG else None, cut(-positive), cut(-score)))
    return sorted(out, key=repr)


def mined(spark, rows, **how):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    frame = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), **how)
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def vectors(seed, n, dims=6, clusters=4):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(clusters)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centers)], rng.randrange(10)) for i in range(n)]
    return rows


DIFFICULT = [
    (None, [1.0, 0.5], 3), (0, [1.0, 0.5], 3), (0, [1.0, 0.5], 3), (100, None, 3), (200, [1.0, 0.5], None),
    (300, [math.nan, 1.0], 3), (400, [math.inf, 1.0], 3), (500, [None, 1.0], 3), (600, [], 3), (700, [0.0, 0.0], 3),
    (800, [-1.0, -0.5], 3), (1, [1.0, 0.5], 4), (2, [1.0, 0.4], 4), (3, [0.9, 0.5], 4), (4, [1.0], 4), (5, [1.0, 0.5, 9.0], 3),
    (6, [0.001, -0.001], 4), (None, [1.0, 0.5], 4),
]


@pytest.mark.parametrize("rows,step", [(vectors(1, 400), 20), (vectors(2, 300, 2, 1), 25), (DIFFICULT, 100), ([], 100)])
def test_same_as_scoring_all(spark, rows, step):
    assert mined(spark, rows, anchor_step=step) == plain(rows, step)


def test_many_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 64)
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", 7)
    rows = vectors(3, 500) + [(1000 + i, [1.0] * 6, i % 3) for i in range(150)]  # a third are copies
    assert mined(spark, rows, anchor_step=10, n_positives=3, n_negatives=4, least_percent=60) == plain(rows, 10, 3, 4, 60)


def test_huge_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([1e12, 3.5, -1e9, 1e15, 0.1]) for _ in range(3)], i % 3) for i in range(60)]
    assert mined(spark, rows, anchor_step=5) == plain(rows, 5)


def test_components_at_the_end_of_doubles(spark):
    rows = [(i, [1.7e308 if i % 4 else -1.7e308, 1.0 * i], i % 2) for i in range(80)]
    assert all(r[0] % 10 == 0 for r in mined(spark, rows, anchor_step=10))


def test_other_columns_are_not_read(spark):
    rows = vectors(5, 120)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "block", "group", "vector", "anchor", "score"):
        frame = frame.selectExpr("*", f"1 AS `{name}`")
    found = negatives.mine(frame, 10).collect()
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found) == sorted(plain(rows, 10))


@pytest.mark.parametrize("dims,clusters,spread", [(2, 1, 1.0), (8, 5, 0.05), (48, 1, 1.0)])
def test_tree(dims, clusters, spread):
    rng = np.random.default_rng(dims)
    centers = rng.normal(size=(clusters, dims))
    points = np.floor(256 * (centers[rng.integers(clusters, size=1500)] + spread * rng.normal(size=(1500, dims))))
    points[700:900] = points[0]
    ids = np.arange(1500)
    tree = Tree.grown(points, ids, ids % 10, ids)
    # Every point is held once, and lies as far from a node's center as its radius at most.
    assert sorted(tree.rows) == list(range(1500))

    def below(node):
        own = list(range(tree.own[node], tree.own_end[node]))
        return own + [p for child in range(tree.child[node], tree.child_end[node]) for p in below(child)]

    squares = (tree.points**2).sum(axis=1)
    lifted = np.c_[tree.points, np.sqrt(squares.max() - squares)]
    anchor = np.floor(256 * rng.normal(size=dims))
    for node in range(len(tree.radius)):
        under = below(node)
        apart = np.sqrt(((lifted[under] - lifted[tree.center[node]]) ** 2).sum(axis=1))
        assert apart.max() <= tree.radius[node] + 1e-6
        (low,), (high,) = tree.bounds(np.array([node]), anchor)
        scores = tree.points[under] @ anchor
        assert low <= scores.min() and scores.max() <= high
    # Centers of one node's children lie apart by more than the level they cover.
    for node in range(len(tree.radius)):
        children = lifted[tree.center[tree.child[node] : tree.child_end[node]]]
        if len(children) > 1:
            level = negatives.BASE ** (math.ceil(math.log(tree.radius[node], negatives.BASE)) - 1)
            apart = np.sqrt(((children[:, None] - children[None]) ** 2).sum(axis=2))
            assert apart[~np.eye(len(children), dtype=bool)].min() > level * (1 - 1e-6)


def test_descent_skips_most_of_clustered_points():
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(40, 16))
    points = np.floor(256 * (centers[np.arange(4000) % 40] + 0.02 * rng.normal(size=(4000, 16))))
    ids = np.arange(4000)
    tree = Tree.grown(points, ids, ids % 10, ids)
    everything = np.ones(4000, bool)
    anchor = points[0]
    (best,), scored = tree.best(anchor, [(-math.inf, math.inf)], 5, everything)
    exact = sorted(((-int(s), i) for i, s in zip(ids.tolist(), points @ anchor)))[:5]
    assert [(-s, i) for s, i, _ in best] == exact
    assert scored < 1000


def test_whole_numbers():
    assert whole([[0.5, -0.001], [1.0]], 3).tolist() == [[128.0, -1.0, 0.0], [256.0, 0.0, 0.0]]
    assert whole([[1e30]], 1).tolist() == [[int(1e30) * 256]]
