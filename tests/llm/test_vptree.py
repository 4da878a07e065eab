import math

import numpy as np
import pytest

from tidelog.llm import vptree

SHAPE = "vec_id long, embedding array<float>, label int, rank string"


def brute(rows, k=20, every=20):
    good = [(i, np.array(v, dtype=np.float64)) for i, v, *_ in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = []
    for q, x in good:
        if q % every == 0:
            found = sorted((-float((x * y).sum()), i) for i, y in good if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def _rows(n, dim, seed=0, scale=False):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dim))
    x = centres[r.integers(0, 5, n)] + 0.4 * r.normal(size=(n, dim))
    if not scale:
        x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, [float(np.float32(c)) for c in v], 0, None) for i, v in enumerate(x)]


def _same(got, want):
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)


@pytest.mark.parametrize("scale", [False, True])
def test_exact(spark, monkeypatch, scale):
    monkeypatch.setattr(vptree, "SHARD_POINTS", 128)
    rows = _rows(900, 12, scale=scale)
    rows += [(900 + i, rows[40][1], 0, None) for i in range(90)]  # a group of copies larger than k
    df = spark.createDataFrame(rows, SHAPE).repartition(4)
    _same(vptree.nearest(df).collect(), brute(rows))


def test_relaxed_pruning_keeps_recall(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_POINTS", 256)
    rows = _rows(1500, 24, 5)
    want = {w[:1] + w[2:3] for w in brute(rows)}
    got = {(r.query_id, r.vec_id) for r in vptree.nearest(spark.createDataFrame(rows, SHAPE), factor=1.5).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_edges(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 0.0], 0, "x"), (20, [0.0, 1.0], 0, None), (1, None, 0, None), (2, [0.0, 0.0], 0, None), (3, [nan, 1.0], 0, None), (4, [1.0, None], 0, None),
        (5, [float("inf"), 1.0], 0, None), (6, [], 0, None), (7, [1.0, 0.0], 0, None), (None, [1.0, 1.0], 0, None), (8, [1.0, 1.0, 1.0], 0, None), (40, [2.0, 2.0, 2.0], 0, None),
        (0, [1.0, 0.0], 0, "again"), (9, [-1.0, 0.0], 0, None),
    ]
    got = vptree.nearest(spark.createDataFrame(rows, SHAPE)).collect()
    unique = [r for i, r in enumerate(rows) if r[:2] not in [x[:2] for x in rows[:i]]]
    _same(got, brute(unique))
    assert vptree.nearest(spark.createDataFrame([], SHAPE)).count() == 0
    assert vptree.nearest(spark.createDataFrame([(0, [1.0], 0, None)], SHAPE)).count() == 0


def test_tree_prunes():
    r = np.random.default_rng(2)
    raw = r.normal(size=(4000, 3))
    top = np.linalg.norm(raw, axis=1).max()
    tree = vptree.Tree(vptree._augment(raw, top), raw, leaf=32)
    seen = []
    scan = tree._scan
    tree._scan = lambda rows, active: (seen.append(len(rows) * len(active)), scan(rows, active))
    q = r.normal(size=(50, 3))
    best, rows = tree.search(vptree._query(q, top), q, 5, np.full(50, np.inf), np.arange(4000))
    want = np.argsort(-(q @ raw.T), axis=1)[:, :5]
    assert (rows == want).all() and np.allclose(best, np.take_along_axis(q @ raw.T, want, axis=1)) and sum(seen) < 0.3 * 50 * 4000


@pytest.mark.parametrize("scale", [1.0, 2.0**20, 2.0**-20])
def test_ties(spark, monkeypatch, scale):
    """Vectors of few small integers, whose products tie often: ids decide."""
    monkeypatch.setattr(vptree, "SHARD_POINTS", 512)
    r = np.random.default_rng(11)
    x = np.unique(r.integers(-2, 3, (2600, 8)), axis=0)
    r.shuffle(x)
    rows = [(i, [float(c) * scale for c in v], 0, None) for i, v in enumerate(x) if v.any()]
    df = spark.createDataFrame(rows, SHAPE.replace("float", "double")).repartition(3)
    got = sorted((g.query_id, g["rank"], g.vec_id) for g in vptree.nearest(df).collect())
    assert got == [w[:3] for w in brute(rows)]
