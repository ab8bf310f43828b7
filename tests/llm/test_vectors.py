"""Operators 11 and 12 against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest

from foldmill.llm import hard_negatives
from foldmill.llm.hard_negatives import mine
from foldmill.llm.vector_links import Grid, near_vectors, rotated

ROWS = "vec_id long, label string, vector array<long>, cluster string"
VECTORS = "vec_id long, embedding array<double>, vector string"


def mined(rows, anchors, k=5, m=5, lowest=80, highest=100):
    """rows: id -> (label, vector)."""
    out = set()
    for a in anchors:
        label, own = rows[a]
        scores = sorted((-sum(x * y for x, y in zip(own, v)), i, l) for i, (l, v) in rows.items() if i != a)
        for ps, p in [(-s, i) for s, i, l in scores if l == label][:k]:
            fit = [(i, -s) for s, i, l in scores if l != label and lowest * ps <= -100 * s <= highest * ps]
            out |= {(a, p, n + 1, i, ps, s) for n, (i, s) in enumerate(fit[:m])}
    return out


def clustered(rng, n, dims, spread):
    centres = rng.normal(size=(6, dims))
    return np.floor(40 * (centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dims)))).astype(int)


@pytest.mark.parametrize("spread, clusters, block", [(0.05, 6, 40), (0.5, 3, 2048), (2.0, 1, 100)])
def test_hard_negatives(spark, spread, clusters, block):
    rng = np.random.default_rng(clusters)
    vectors = clustered(rng, 400, 8, spread)
    vectors[:9] = vectors[9]          # ties
    vectors[20] = 0
    rows = {i: ("abc"[int(rng.integers(0, 3))], v.tolist()) for i, v in enumerate(vectors)}
    df = spark.createDataFrame([(i, l, v, "clash") for i, (l, v) in rows.items()], ROWS)
    found = mine(df, df.filter("vec_id % 10 = 0"), clusters=clusters, block=block).collect()
    assert {tuple(r) for r in found} == mined(rows, range(0, 400, 10)) and len(found) == len(set(found))


def test_walk_stops_where_the_bound_certifies():
    vectors = np.zeros((2000, 2))
    vectors[:, 0] = np.arange(2000, 0, -1)
    scores = hard_negatives.walk(np.array([[1.0, 0.0]]), np.ones(1), lambda s, at: np.full(
        len(at), 1990.0), vectors[:, 0], vectors)
    assert np.isfinite(scores).sum() == hard_negatives.STEP


def test_hard_negatives_of_odd_rows(spark):
    rows = [(0, "a", [3, 4], ""), (0, "a", [3, 4], ""), (1, "a", [3, 4], ""), (2, "b", [3], ""), (3, "b", [3, 4], ""),
            (3, "b", [9, 9], ""), (4, None, [3, 4], ""), (5, "b", None, ""), (6, "b", [1, None], ""), (None, "b", [3, 4], ""),
            (7, "b", [0, 0], ""), (8, "a", [-3, -4], ""), (9, "b", [4, 3], "")]
    df = spark.createDataFrame(rows, ROWS)
    want = mined({0: ("a", [3, 4]), 1: ("a", [3, 4]), 2: ("b", [3, 0]), 3: ("b", [3, 4]), 7: ("b", [0, 0]),
                  8: ("a", [-3, -4]), 9: ("b", [4, 3])}, [0, 7, 8])
    assert {tuple(r) for r in mine(df, df.filter("vec_id in (0, 7, 8)")).collect()} == want
    assert mine(df, df.limit(0)).collect() == mine(df.limit(0), df.limit(0)).collect() == []


def linked(vectors, cosine=0.95):
    """vectors: id -> list or None. id -> (n_links, component)."""
    fit = {i: v for i, v in vectors.items() if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    near = defaultdict(set)
    for i, u in fit.items():
        for j, v in fit.items():
            if i < j and np.dot(u, v) / math.sqrt(np.dot(u, u) * np.dot(v, v)) >= cosine:
                near[i].add(j)
                near[j].add(i)
    label = {i: i for i in vectors}
    changed = True
    while changed:
        changed = False
        for i in near:
            least = min([label[i], *(label[j] for j in near[i])])
            changed |= least != label[i]
            label[i] = least
    return {(i, len(near[i]), label[i], label[i] == i) for i in vectors}


@pytest.mark.parametrize("dims, block", [(8, None), (2, 17), (4, 120)])
def test_near_vectors(spark, dims, block):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(60, 12))
    vectors = base[rng.integers(0, 60, 500)] + 0.25 * rng.normal(size=(500, 12)) * rng.random((500, 1))
    vectors[:40] = vectors[50] + 0.02 * rng.normal(size=(40, 12))    # a dense group
    vectors[100:110] = vectors[110]
    vectors[200] = 7 * vectors[201]
    given = {i: v.tolist() for i, v in enumerate(vectors)}
    df = spark.createDataFrame([(i, v, "clash") for i, v in given.items()], VECTORS)
    assert {tuple(r) for r in near_vectors(df, dims=dims, block=block).collect()} == linked(given)


def test_near_vectors_of_odd_rows(spark):
    given = {1: [1.0, 0.0], 2: [1.0], 3: None, 4: [0.0, 0.0], 5: [float("nan"), 1.0], 6: [float("inf"), 1.0], 7: [None, 1.0],
             8: [], 9: [1e300, 0.0], 10: [1e-300, 1e-300], 11: [1.0, 1.0]}
    rows = [(i, v, "") for i, v in given.items()] + [(None, [1.0, 0.0], ""), (1, [1.0, 0.0], "")]
    df = spark.createDataFrame(rows, VECTORS)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    want = {i: (0, i, True) for i in given} | {1: (2, 1, True), 2: (2, 1, False), 9: (2, 1, False),
                                               10: (1, 10, True), 11: (1, 10, False)}
    assert found == want
    assert near_vectors(df.limit(0)).collect() == []


def test_rotation_keeps_angles_and_every_near_pair_meets():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(200, 30))
    points = rotated(vectors, 32)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    assert np.allclose(points @ points.T, unit @ unit.T)
    assert np.array_equal(rotated(vectors[50:60], 32), points[50:60])
    grid = Grid(30, 0.5, 8, 8)
    met = set()
    cells = defaultdict(list)
    for space, rows, code, home in grid.places(points):
        for r, c in zip(rows.tolist(), code.tolist()):
            cells[space, c].append((r, home))
    for own in cells.values():
        met |= {frozenset((a, b)) for a, x in own for b, y in own if a != b and (x or y)}
    near = np.argwhere(np.triu(unit @ unit.T >= 0.5, 1))
    assert len(near) and all(frozenset(p.tolist()) in met for p in near)
