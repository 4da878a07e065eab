"""Quality classifier: naive Bayes support vectors (NBSVM).

n-gram indicators of a text, each scaled by the log-ratio of its smoothed counts
in the two classes, go to a linear hinge-loss model fitted by dual coordinate
descent. Features are hashed to ``BITS`` bits, so a model has a fixed size (a few
MB) whatever the input, and that is all that is broadcast.

Features, over the whole text: n-grams of words as they stand, and n-grams of
word shapes (case, length, marks at the end, and whether the word repeats one
just before it), which carry over to words never seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec
from .common import crc_of, slices, written

BITS = 18
#: The fit takes at most this many labelled rows, and feature values of all of them together.
MAX_ROWS = 6000
MAX_VALUES = 30_000_000
#: How far back a word can be repeated: this many words.
REPEAT = 24
THRESHOLD = 0.3


def _shapes(w: textvec.Words) -> np.ndarray:
    """A small code for the look of each word, hashed."""
    data, s, e = w.data, w.starts, w.ends
    is_upper = (data >= 65) & (data <= 90)
    is_letter = is_upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    is_digit = (data >= 48) & (data <= 57)
    sums = lambda x: np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    up, letters, digits = sums(is_upper), sums(is_letter), sums(is_digit)
    n = e - s
    upper, letter, digit = up[e] - up[s], letters[e] - letters[s], digits[e] - digits[s]
    case = np.select([letter == 0, upper == 0, (upper == 1) & is_upper[s], upper * 2 >= letter], [0, 1, 2, 3], 4)
    other = np.minimum(n - letter - digit, 3)
    last = np.where(is_letter[e - 1] | is_digit[e - 1], 0, data[e - 1]).astype(np.int64)
    before = np.where(n > 1, data[np.maximum(e - 2, s)], 0)
    before = np.where((last > 0) & (before < 128) & ~((before >= 97) & (before <= 122) | (before >= 65) & (before <= 90)), before, 0).astype(np.int64)
    size = np.minimum(np.log2(n).astype(np.int64), 6)
    repeated = np.zeros(len(n), dtype=bool)
    owner = w.owners
    if len(n) > 2:
        # The same three words in a row stand a little before.
        three = textvec.combine([w.hashes[:-2], w.hashes[1:-1], w.hashes[2:]])
        for d in range(1, REPEAT + 1):
            if len(three) > d:
                repeated[d:-2] |= (three[d:] == three[:-d]) & (owner[d:-2] == owner[: -d - 2]) & (owner[d + 2 :] == owner[: -d - 2])
    twice = np.zeros(len(n), dtype=bool)
    twice[1:] = (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])
    code = case + 5 * (other + 4 * (size + 7 * ((digit > 0) + 2 * (repeated + 2 * twice))))
    return textvec.mix((code + (last << 12) + (before << 20)).astype(np.uint64) + np.uint64(1 << 40))


def features(texts: list, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text: indices, and bounds by text."""
    w = textvec.words(texts)
    shapes = textvec.Words(_shapes(w), w.bounds, w.starts, w.ends, w.data)
    parts = [textvec.ngrams(w, n) for n in (1, 2)] + [textvec.ngrams(shapes, n) for n in (1, 2, 3)]
    keys = []
    for i, (h, owner) in enumerate(parts):
        h = textvec.mix(h + np.uint64(i + 1)) >> np.uint64(64 - bits)
        keys.append((owner.astype(np.uint64) << np.uint64(bits)) | h)
    key = np.sort(np.concatenate(keys))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    owner = (key >> np.uint64(bits)).astype(np.int64)
    return (key & np.uint64((1 << bits) - 1)).astype(np.int32), np.searchsorted(owner, np.arange(len(w) + 1))


@dataclass
class Model:
    """score = sigmoid(scale * (bias + sum of weights over features / sqrt of their number) + shift)."""

    weights: np.ndarray
    bias: float
    scale: float
    shift: float
    bits: int = BITS

    def margins(self, index: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = np.diff(bounds)
        owner = np.repeat(np.arange(len(n)), n)
        return np.bincount(owner, weights=self.weights[index], minlength=len(n)) / np.sqrt(np.maximum(n, 1)) + self.bias

    def scores(self, texts: list) -> np.ndarray:
        margin = self.margins(*features(texts, self.bits))
        return 1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -30, 30)))


def log_ratios(rows: list[np.ndarray], y: np.ndarray, bits: int = BITS) -> np.ndarray:
    """log of the classes' smoothed shares of each feature."""
    size = 1 << bits
    counts = [np.ones(size), np.ones(size)]
    for r, label in zip(rows, y, strict=True):
        counts[int(label > 0)][r] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int = 15, seed: int = 5) -> tuple[np.ndarray, float]:
    """Hinge-loss weights (on scaled indicators) and bias: min |w|^2/2 + sum cost_i * max(0, 1 - y_i w.x_i).

    One variable a row; the best step for one is exact, in turn over a random order.
    """
    w, bias = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(y))
    xs = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    squares = np.array([float(x @ x) for x in xs]) + 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            gradient = y[i] * (w[rows[i]] @ xs[i] + bias) - 1
            new = min(max(alpha[i] - gradient / squares[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * xs[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, cost: float = 1.0) -> Model:
    """Fits weights on all rows, and the score's scale on margins of rows held out of a fit (two folds).

    With no rows, or one class only, the score is the smoothed share of label 1.
    """
    y = np.where(labels > 0, 1.0, -1.0)
    share = (float((y > 0).sum()) + 1) / (len(y) + 2)
    if len(y) < 4 or min((y > 0).sum(), (y < 0).sum()) < 2:
        return Model(np.zeros(1 << bits), 0.0, 1.0, float(np.log(share / (1 - share))), bits)

    def one(chosen: np.ndarray) -> Model:
        own, t = [rows[i] for i in chosen], y[chosen]
        ratio = log_ratios(own, t, bits)
        balance = np.where(t > 0, len(t) / (2 * max(1, (t > 0).sum())), len(t) / (2 * max(1, (t < 0).sum())))
        w, bias = dual_coordinate_descent(own, t, ratio, cost * balance)
        return Model(w * ratio, bias, 1.0, 0.0, bits)

    margin = np.zeros(len(y))
    # Folds deal each class out in turn, in the order of the rows.
    fold = np.zeros(len(y), dtype=int)
    for sign in (1, -1):
        own = np.flatnonzero(y == sign)
        fold[own] = np.arange(len(own)) % 2
    for k in (0, 1):
        m = one(np.flatnonzero(fold != k))
        for i in np.flatnonzero(fold == k):
            margin[i] = m.margins(rows[i], np.array([0, len(rows[i])]))[0]
    model = one(np.arange(len(y)))
    model.scale, model.shift = _platt(margin, y)
    return model


def _platt(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic fit of the label on the margin, with Platt's softened targets; Newton steps with a small ridge."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    a = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        g = x.T @ (p - t) + 1e-3 * a
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        a = a - step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a[0], 1e-3)), float(a[1])


def held_out(doc_id: Column) -> Column:
    return crc_of(doc_id) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_values: int = MAX_VALUES, bits: int = BITS) -> Model:
    """Fits on a bounded sample of the labelled rows that are not held out.

    The sample: the ``max_rows`` labelled ids least in md5 order, cut at the first
    with which their features pass ``max_values``. Null labels and ids are left out; an id
    labelled twice takes the higher label; of repeated documents one is used.
    Only ids and features of the sample come to the driver.
    """
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("quality") > 0).cast("int")).alias("quality"))
    chosen = known.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(max_rows)
    pairs = [(r["doc_id"], r["quality"]) for r in chosen.collect()]
    if not pairs:
        return fit([], np.array([]), bits)
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    ids = spark.createDataFrame([(i,) for i, _ in pairs], T.StructType([T.StructField("doc_id", kind)]))
    own = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, bounds = features(b.column(1).to_pylist(), bits)
            values = [index[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values, pa.binary())], names=["doc_id", "index"])

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("index", T.BinaryType())])
    values = own.mapInArrow(run, schema).groupBy("doc_id").agg(F.min("index").alias("index"))
    values = written(values.withColumn("n", (F.length("index") / F.lit(4)).cast("long")), "quality-sample")
    count = {r["doc_id"]: r["n"] for r in values.select("doc_id", "n").collect()}  # max_rows at most
    wanted, total = [], 0
    for i, _ in pairs:
        total += count.get(i, 0)
        if total > max_values:
            break
        wanted.append((i,))
    fetched = values.select("doc_id", "index").join(F.broadcast(spark.createDataFrame(wanted, ids.schema)), "doc_id")
    found = {r["doc_id"]: bytes(r["index"]) for r in fetched.toLocalIterator(prefetchPartitions=True)}
    kept = [(found[i], q) for i, q in pairs if i in found]
    return fit([np.frombuffer(v, dtype=np.int32) for v, _ in kept], np.array([q for _, q in kept]), bits)


def score_documents(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score (double) and predicted (int, score >= threshold) to all rows; a null text is an empty one.

    Columns of those names are replaced; all others, the text among them, stay.
    """
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("score", "predicted")]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(b.schema.get_field_index(text))
            scores = np.empty(b.num_rows)
            # Some MB of text at a time, and a long text alone.
            for a, z in slices(texts):
                scores[a:z] = m.scores(texts.slice(a, z - a).to_pylist())
            columns = [b.column(b.schema.get_field_index(f.name)) for f in kept]
            columns += [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)
