import random

import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import dedup

from .conftest import prose


def _sets(texts):
    nodes, bounds, h, tf = dedup.shingles(texts)
    w = dedup.Weights(np.full((2, dedup.CELLS), 250, dtype=np.uint8)).of(h, tf)
    return [(h[a:z], w[a:z]) for a, z in zip(bounds[:-1], bounds[1:], strict=True)], bounds, h, w


def test_shingles():
    nodes, bounds, h, tf = dedup.shingles(["a b c d e f", "A b  c d e\tf", "a b", "", None, "a b c d e a b c d e a b c d e"])
    assert (nodes[0] == nodes[1]).all() and np.diff(bounds).tolist() == [2, 2, 1, 0, 0, 5]
    assert tf[bounds[5] :].tolist().count(3) == 1 and not nodes[3].any()
    assert all((np.diff(h[a:z].astype(object)) > 0).all() for a, z in zip(bounds[:-1], bounds[1:], strict=True))


def test_samples_estimate_weighted_jaccard():
    base = prose(1, 300).split()
    for changed in (3, 12, 40):
        other = list(base)
        for i in range(changed):
            other[i * 7] = f"new{i}"
        (a, b), bounds, h, w = _sets([" ".join(base), " ".join(other)])
        s = dedup.signatures(bounds, h, w, 1500)
        assert abs((s[0] == s[1]).mean() - dedup.weighted_jaccard(a, b)) < 0.05
    assert dedup.weighted_jaccard(a, a) == 1 and dedup.weighted_jaccard(a, (a[0][:0], a[1][:0])) == 0


def _corpus():
    r = random.Random(7)
    texts = []
    for g in range(6):
        base = prose(100 + g, 150).split()
        for k in range(8):
            own = list(base)
            for i in r.sample(range(150), k % 3):
                own[i] = f"x{g}{k}{i}"
            texts.append(" ".join(own))
    shared = prose(500, 60)
    texts += [prose(600 + i, 150) + " " + shared for i in range(10)]
    texts += [prose(700 + i, 50) for i in range(20)]
    return texts


def _classes(texts):
    sets, *_ = _sets(texts)
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if dedup.weighted_jaccard(sets[i], sets[j]) >= 0.8 and top(i) != top(j):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(texts))]


def test_classes_match_all_pairs(spark, monkeypatch):
    texts = _corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = _classes(texts)
    for block in (128, 3):  # 3: buckets are split into blocks
        monkeypatch.setattr(dedup, "BLOCK", block)
        got = {r.doc_id: r.class_id for r in dedup.near_duplicates(df).collect()}
        assert [got[i] for i in range(len(texts))] == want
    kept = dedup.keep_one(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


def _random_sets(r, n, words):
    """Sets drawn from few shingles, so that similarities spread around the threshold and chains are long."""
    base = np.sort(r.choice(10**6, words, replace=False)).astype(np.uint32)
    out = []
    for _ in range(n):
        own = np.unique(np.concatenate([base[r.random(words) > r.choice([0.02, 0.1, 0.2])], r.integers(10**6, 2 * 10**6, r.integers(0, words // 6)).astype(np.uint32)]))
        out.append((own, r.choice(np.array([1, 1.25, 2], dtype=np.float32), len(own))))
    return out


def test_links_join_what_all_pairs_join():
    r = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 60):
        sets = _random_sets(r, n, 60)
        pairs = [(i, j) for i in range(n) for j in range(i) if dedup.weighted_jaccard(sets[i], sets[j]) >= 0.8]

        def classes(links, start):
            root = list(start)
            for i, j, *_ in links:
                root = [root[i] if x == root[j] else x for x in root]
            return [root.index(x) for x in root]

        raw = [h.tobytes() for h, _ in sets], [w.tobytes() for _, w in sets]
        found = dedup.links_in(*raw, 0.8)
        assert classes(found, range(n)) == classes(pairs, range(n)) and len(found) == n - len(set(classes(pairs, range(n))))
        assert all(abs(s - dedup.weighted_jaccard(sets[i], sets[j])) < 1e-9 for i, j, s in found)
        given = r.integers(0, 5, n)
        probes = r.random(n) < 0.3
        across = [(i, j) for i, j in pairs if probes[i] != probes[j]]
        assert classes(dedup.links_in(*raw, 0.8, given, probes), given) == classes(across, given)


def test_clashing_columns(spark, docs):
    from pyspark.sql import functions as F

    clash = docs.withColumn("node_a_", F.lit(1)).withColumn("NODE_B_", F.lit(2)).withColumn("id_", F.lit(3)).withColumn("row_", F.lit(4)).withColumn("x_", F.lit(5)).withColumn("root", F.lit(6))
    kept = dedup.keep_one(clash)
    assert kept.columns == clash.columns and kept.count() == dedup.keep_one(docs).count()


def test_texts_without_ids_link(spark):
    """A chain whose middle has no id is one class."""
    words = prose(9, 200).split()
    end = [*words[:8], *[f"new{i}" for i in range(24)], *words[32:]]
    middle = [*words[:8], *[f"new{i}" for i in range(12)], *words[20:]]
    (a, b, c), *_ = _sets([" ".join(x) for x in (words, middle, end)])
    assert min(dedup.weighted_jaccard(a, b), dedup.weighted_jaccard(b, c)) > 0.8 > dedup.weighted_jaccard(a, c)
    df = spark.createDataFrame([(-5, " ".join(words)), (None, " ".join(middle)), (7, " ".join(end)), (None, "no id here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id) for r in dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(-5, -5), (7, -5), (None, -5), (None, None)], key=str)


def test_edges(spark, docs, none):
    got = {(r.doc_id, r.class_id) for r in dedup.near_duplicates(docs).collect()}
    assert {(0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 7), (None, None)} <= got
    assert dedup.near_duplicates(docs).count() == docs.count()
    kept = dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted([r.doc_id for r in kept.collect()], key=lambda x: (x is None, x or 0))
    assert ids == [0, 3, 4, 5, 6, 7, 9, 10, 11, 12, 99, None]
    assert dedup.near_duplicates(none).count() == 0 and dedup.keep_one(none).count() == 0


def test_components(spark):
    r = random.Random(3)
    pairs = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    root = {x: x for p in pairs for x in p}
    for _ in range(100):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    wide = spark.createDataFrame(pairs, "a long, b long").selectExpr("cast(a as decimal(38,0)) a", "cast(b as decimal(38,0)) b")
    assert {int(x.id): int(x.root) for x in dedup.components(wide).collect()} == {x.id: x.root for x in dedup.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    got = {x.id: x.root for x in dedup.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got.get(x, x) == m for x, m in root.items())
    empty = spark.createDataFrame([], "a long, b long")
    assert dedup.components(empty).where(F.col("id") != F.col("root")).count() == 0
