import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import quality

from .conftest import prose


def _corpus(n=240):
    rows, labels = [], []
    for i in range(n):
        r = random.Random(i)
        text = prose(i, 60)
        kind = i % 4
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split()) if r.random() < 0.5 else " ".join(f"{w}###" for w in text.split())
        rows.append((i, text))
        labels.append((i, int(kind != 0), 0))
    return rows, labels


def test_learns_and_ignores_held_out_labels(spark):
    rows, labels = _corpus()
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs, known)
    got = {r.doc_id: r for r in quality.score_documents(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == labels[i][1] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    # Labels of held-out rows change nothing.
    other = known.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs, other)
    assert np.array_equal(model.weights, again.weights) and (model.scale, model.shift) == (again.scale, again.shift)


def test_edges(spark, docs, none):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (3, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    out = quality.score_documents(docs, model)
    assert dict(out.dtypes)["score"] == "double" and out.columns.count("score") == 1
    assert quality.score_documents(none, model).count() == 0
    blank = quality.train(docs, labels.where("false"))
    assert {round(r.score, 6) for r in quality.score_documents(docs, blank).collect()} == {0.5}
    assert quality.train(none, labels).weights.any() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    r = np.random.default_rng(0)
    rows = [np.sort(r.choice(12, 5, replace=False)) for _ in range(40)]
    y = np.where(np.array([3 in x for x in rows]), 1.0, -1.0)
    ratio = r.normal(size=12)
    cost = np.full(40, 1.0)
    w, b = quality.dual_coordinate_descent(rows, y, ratio, cost, epochs=400)
    x = np.zeros((40, 13))
    for i, own in enumerate(rows):
        x[i, own] = ratio[own] / np.sqrt(len(own))
    x[:, 12] = 1
    loss = lambda v: v @ v / 2 + np.maximum(0, 1 - y * (x @ v)).sum()
    best, v = np.inf, np.zeros(13)
    for t in range(1, 20_000):  # subgradient steps as a plain reference
        g = v - x.T @ (y * (y * (x @ v) < 1))
        v = v - g / (t + 10)
        best = min(best, loss(v))
    assert loss(np.append(w, b)) <= best * 1.01 + 1e-6


def test_sample_bounds(spark):
    rows, labels = _corpus(80)
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert np.isfinite(quality.train(docs, known, max_rows=20).weights).all()
    assert np.isfinite(quality.train(docs, known, max_values=3000).weights).all()


def test_sample_is_cut_in_md5_order(spark):
    rows, labels = _corpus(80)
    rows = [(i, t + " " + prose(i + 500, 20 * (i % 7))) for i, t in rows]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    total, first = 0, []
    for i in sorted((i for i, _ in rows if zlib.crc32(str(i).encode()) % 5), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
        total += len(quality.features([rows[i][1]], quality.BITS)[0])
        if total > 5000:
            break
        first.append(i)
    assert 4 < len(first) < 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = quality.train(docs, known.where(F.col("doc_id").isin(first)))
    for order in (rows, rows[::-1]):
        got = quality.train(spark.createDataFrame(order, "doc_id long, text string").coalesce(1), known, max_values=5000)
        assert np.array_equal(got.weights, want.weights) and (got.scale, got.shift) == (want.scale, want.shift)
