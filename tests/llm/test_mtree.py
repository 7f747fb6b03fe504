from __future__ import annotations

import numpy as np
import pytest

from precis.llm import mtree

EXTRA = "x string, cell int, kind int, tree string, _key long, score long"


def brute(rows, k=5, every=50):
    """`{(query, vector): [(vec, score), ...]}` by definition."""
    good = {}
    for key, v in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            good.setdefault((key, tuple(int(np.floor(256 * c)) for c in v)))
    size = max((len(x) for _, x in good), default=0)
    good = {(key, x + (0,) * (size - len(x))) for key, x in good}
    out = {}
    for key, x in good:
        if key is not None and key % every == 0:
            all_of = [(-sum(a * b for a, b in zip(x, y, strict=True)), other is None, other) for other, y in good if other != key]
            best = sorted(all_of, key=lambda t: (t[0], t[1], t[2] or 0))[:k]
            out[key, x] = [(other, -s) for s, _, other in best]
    return out


def run(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x", 1, 1, "t", 1, 1) for r in rows], f"vec_id long, embedding array<double>, {EXTRA}").repartition(3)
    got = {}
    for r in mtree.nearest(df, **settings).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def vectors(n, dim, seed, groups=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    if groups:
        v = rng.normal(size=(groups, dim))[rng.integers(0, groups, n)] + v * 0.01
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).tolist()


@pytest.mark.parametrize("groups", [0, 6])
def test_equals_all_products(spark, groups):
    rows = list(enumerate(vectors(900, 12, 3, groups)))
    got = run(spark, rows, page=8, tree_rows=100, rows_per_route=150)
    for (key, _), want in brute(rows).items():
        assert [(v, s) for _, v, s in sorted(got[key])] == want
        assert [r for r, _, _ in sorted(got[key])] == [1, 2, 3, 4, 5]


def test_odd_rows_ties_and_copies(spark):
    rows = [
        (0, [1.0, 0.0]), (50, [0.5, -0.25]), (100, [1.0]), (150, []), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]),
        (4, [float("inf"), 0.0]), (None, [0.9, 0.9]), (None, [0.9, 0.9]), (5, [2.0, 0.0]), (5, [2.0, 0.0]), (200, [0.1, 0.2]),
        *((i, [0.7, 0.7]) for i in range(300, 400)), (-50, [-3.0, 2.0]), (6, [1.5, 0.1]), (7, [1.5, 0.1]),
    ]
    got, want = run(spark, rows, page=4, tree_rows=10, rows_per_route=20), brute(rows)
    assert sorted(got) == sorted(key for key, _ in want)
    for (key, _), best in want.items():
        assert [(v, s) for _, v, s in sorted(got[key])] == best


def test_few_candidates_and_none(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == {0: [(1, 1, 256 * 512)]}
    assert run(spark, [(0, [1.0])]) == {}
    assert run(spark, [(0, None)]) == {}
    assert run(spark, []) == {}


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**22 + i), 3.0 * i]) for i in range(60)]
    got = run(spark, rows, page=4, tree_rows=16)
    for (key, _), best in brute(rows).items():
        assert [(v, s) for _, v, s in sorted(got[key])] == best


def test_bounds_spare_distances():
    x = np.floor(256 * np.array(vectors(4000, 16, 5, 40))).astype(np.int64)
    most = int((x**2).sum(axis=1).max())
    tree = mtree.build(np.arange(4000), np.ones(4000, bool), x, most, page=32)
    for page in range(len(tree.radius)):  # a page's ball holds the balls below and its entries
        for below in tree.children[page]:
            assert tree.to_parent[below] <= tree.radius[page] + 1e-6
        own = mtree.lifted(tree.entries[tree.first[page] : tree.last[page]], most)
        if len(own):
            gaps = mtree.apart(own, tree.centre[page][None])[:, 0]
            assert gaps.max() <= tree.radius[page] + 1e-6 and np.allclose(gaps, tree.distances[tree.first[page] : tree.last[page]], atol=1e-3)
    assert sorted(tree.keys.tolist()) == list(range(4000))
    found = mtree.nothing_yet(20, 5)
    worked, avoided = mtree.search(tree, np.arange(20), x[:20], most, found)
    assert worked < 20 * 4000 / 4 and avoided > 0
    scores = x[:20] @ x.T
    for q in range(20):
        order = [i for i in np.lexsort((np.arange(4000), -scores[q])) if i != q][:5]
        assert found.keys[q].tolist() == order
