import math
import random

import numpy as np
import pytest

from barloom.llm import cover_tree
from test_simhash import plain_components


def clustered(rng, count, size=8):
    centres = rng.normal(size=(5, size))
    noise = rng.choice([0.02, 0.1, 1.0], (count, 1))
    return cover_tree.unit(centres[rng.integers(0, 5, count)] + noise * rng.normal(size=(count, size)))


@pytest.mark.parametrize("similarity", [0.98, 0.5, -1.0])
def test_pairs_match_brute_force(similarity):
    rng = np.random.default_rng(3)
    points = np.concatenate([clustered(rng, 150), clustered(rng, 1)[[0, 0, 0]]])
    found = [p for i, j in cover_tree.linked(points, None, similarity) for p in zip(np.minimum(i, j).tolist(), np.maximum(i, j).tolist())]
    i, j = np.nonzero(np.triu(points @ points.T >= similarity - 1e-12, 1))
    assert len(found) == len(set(found)) and set(found) == set(zip(i.tolist(), j.tolist()))
    other = clustered(rng, 80)
    across = [p for i, j in cover_tree.linked(points, other, similarity) for p in zip(i.tolist(), j.tolist())]
    i, j = np.nonzero(points @ other.T >= similarity - 1e-12)
    assert len(across) == len(set(across)) and set(across) == set(zip(i.tolist(), j.tolist()))


def test_tree_invariants():
    points = clustered(np.random.default_rng(4), 300)
    tree = cover_tree.CoverTree(points)
    assert sorted(tree.order) == list(range(300)) and tree.end[0] == 300
    for node in range(len(tree.point)):
        members = tree.order[tree.start[node]:tree.end[node]]
        assert tree.point[node] in members
        assert np.linalg.norm(points[members] - points[tree.point[node]], axis=1).max() <= tree.radius[node] + 1e-12
        children = tree.parts(node)
        if tree.count[node]:
            assert tree.start[children[0]] == tree.start[node] and tree.end[children[-1]] == tree.end[node]


def plain(rows):
    def fine(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    usable = [(k, l, np.array(v, float)) for k, v, l in rows if k is not None and l is not None and fine(v)]
    near = [
        (a, b) for n, (a, la, va) in enumerate(usable) for b, lb, vb in usable[:n]
        if la == lb and len(va) == len(vb) and va @ vb / math.sqrt(va @ va) / math.sqrt(vb @ vb) >= 0.98
    ]
    keys = [k for k, _, _ in rows if k is not None]
    component = plain_components(keys, near)
    return {k: (sum(k in p for p in near), component[k], component[k] == k) for k in keys}


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_vectors(spark, block_rows):
    rng = np.random.default_rng(9)
    points = clustered(rng, 120) * rng.choice([0.5, 1.0, 3.0], (120, 1))
    order = random.Random(2).sample(range(1000), 120)
    rows = [(k, p.tolist(), int(rng.integers(0, 3))) for k, p in zip(order, points)]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(9)] + [(2000, [x * 2 for x in rows[5][1]], rows[5][2])]
    rows += [(1100, None, 1), (1101, [0.0] * 8, 1), (1102, [float("nan")] + [1.0] * 7, 1), (1103, [None] + [1.0] * 7, 1),
             (1104, [float("inf")] + [1.0] * 7, 1), (1105, [], 1), (1106, rows[5][1], None), (1107, [1.0, 2.0], 1),
             (1108, [1.0, 2.0], 1), (None, rows[5][1], rows[5][2]), (1109, [1e-30] + [0.0] * 7, 7), (1110, [5.0] + [-0.0] * 7, 7)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, n_links STRING")
    rows = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for k, v, l in rows]
    found = cover_tree.near_vectors(df, block_rows=block_rows).collect()
    assert len(found) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found if r.vec_id is not None} == plain(rows)
    assert [tuple(r) for r in found if r.vec_id is None] == [(None, 0, None, False)]
    pairs = {tuple(r) for r in cover_tree.links(cover_tree.vector_classes(df), 0.98, block_rows, pairs=True).collect()}
    assert all(a < b for a, b in pairs) and (1107, 1108) not in pairs
    empty = df.limit(0)
    assert cover_tree.near_vectors(empty).count() == 0


def nearly_equal(rng, size):
    """Float32 vectors one unit apart in a component or in many, and float32 copies scaled by 3."""
    base = rng.normal(size=(3, size)).astype(np.float32)
    up = np.nextafter(base, np.float32(np.inf))
    one = np.where(np.arange(size) == 1, up, base)
    some = np.where(rng.random((3, size)) < 0.5, up, base)
    return np.concatenate([base, one, up, some, base * np.float32(3), some * np.float32(3)]).astype(float)


@pytest.mark.parametrize("size", [2, 8, 64, 1000])
def test_vectors_that_are_almost_equal_end(size, monkeypatch):
    monkeypatch.setattr(cover_tree, "COMPARED", 5)
    # A tree that never ends would fill the memory; the nodes of one that ends are bounded.
    net = cover_tree.CoverTree._net
    monkeypatch.setattr(cover_tree.CoverTree, "_net", lambda *a, calls=iter(range(5000)): (next(calls), net(*a[1:]))[1])
    rng = np.random.default_rng(12)
    for finest in (cover_tree.FINEST, 0):
        monkeypatch.setattr(cover_tree, "FINEST", finest)
        points = cover_tree.unit(nearly_equal(rng, size))
        found = [p for i, j in cover_tree.linked(points, None, 0.98) for p in zip(np.minimum(i, j).tolist(), np.maximum(i, j).tolist())]
        i, j = np.nonzero(np.triu(points @ points.T >= 0.98, 1))
        assert len(found) == len(set(found)) and set(found) == set(zip(i.tolist(), j.tolist()))


def test_almost_equal_rows(spark):
    points = nearly_equal(np.random.default_rng(5), 8).tolist()
    rows = [(k, p, 1) for k, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(df).collect()}
    assert found == plain(rows)
