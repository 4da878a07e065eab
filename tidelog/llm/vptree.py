"""Approximate nearest neighbours: vantage-point trees per shard.

Largest inner products become least distances: each vector gets one more
coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and a query is scaled to
norm M with 0 there. Vectors fall into cells by their nearest pivot, large cells
are dealt into shards by hash, and every shard builds one tree.

Pruning uses the triangle inequality twice: whole cells (distance to the pivot
less the cell's radius) and subtrees (distance to the vantage point against the
range of its points). Each lower bound is multiplied by ``factor`` before it is
compared with the query's k-th best distance: 1 is exact search, larger values
prune more and lose some neighbours.

Equal vectors are one point with its least ids, so a group of copies costs one
point, and only the k + 1 ids that can appear in an answer are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

LEAF = 256
#: Points in a shard, pivots at most, sampled points that pivots and first bounds come from.
SHARD_POINTS = 32_768
MAX_PIVOTS = 256
SAMPLE = 4096
#: Queries that search a shard at once.
BLOCK = 1024
#: Rounding of distances, as a share of the largest norm, and of their squares: bounds are eased by as much.
SLACK, SQUARE_SLACK = 1e-6, 1e-11
#: Products that are added up exactly at once.
EXACT = 1 << 22


class Tree:
    """A vantage-point tree over rows of ``points``; searches many queries together.

    ``raw``: the vectors that the points stand for; their products with a query, added
    up from the first component on, are what neighbours are ranked by. Distances only
    rule points out, so their rounding changes nothing.
    """

    def __init__(self, points: np.ndarray, raw: np.ndarray, leaf: int = LEAF, seed: int = 4):
        self.points, self.raw, self.leaf = points, raw, leaf
        self.scale = float(np.sqrt((points**2).sum(axis=1).max())) if len(points) else 0.0
        self.rng = np.random.default_rng(seed)
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (vantage, inner node, inner range, outer node, outer range) or (None, begin, end)
        self.root = self._build(0, len(points))

    def _build(self, begin: int, end: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        rows = self.order[begin:end]
        if end - begin > self.leaf:
            vantage = self.points[self.rng.choice(rows)]
            d = np.sqrt(np.maximum(((self.points[rows] - vantage) ** 2).sum(axis=1), 0))
            half = len(rows) // 2
            part = np.argpartition(d, half)
            near, far = d[part[:half]], d[part[half:]]
            if d.max() > 0:
                self.order[begin:end] = rows[part]
                inner, outer = self._build(begin, begin + half), self._build(begin + half, end)
                self.nodes[at] = (vantage, inner, (near.min(), near.max()), outer, (far.min(), far.max()))
                return at
        self.nodes[at] = (None, begin, end)
        return at

    def search(self, queries: np.ndarray, raw: np.ndarray, k: int, bound: np.ndarray, ids: np.ndarray, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """(products, rows), k for each query, largest product first, ties to the smaller id; row -1: none.

        ``queries``: points of the same norm, ``raw`` the vectors behind them. ``bound``: distances
        beyond which nothing is wanted.
        """
        self.q, self.asked, self.k, self.ids, self.factor = queries, raw, k, ids, factor
        self.best = np.full((len(queries), k), -np.inf)
        self.square = np.full((len(queries), k), np.inf)
        self.rows = np.full((len(queries), k), -1)
        self.limit = bound.copy()
        self.squares = (self.points**2).sum(axis=1)
        # First each query's home leaf, which gives close bounds; then every node once, with all queries that may need it.
        self.home = np.full(len(queries), -1)
        self._descend(self.root, np.arange(len(queries)))
        self._walk(self.root, np.arange(len(queries)))
        return self.best, self.rows

    def _descend(self, at: int, active: np.ndarray) -> None:
        node = self.nodes[at]
        if node[0] is None:
            self.home[active] = at
            self._scan(self.order[node[1] : node[2]], active)
            return
        vantage, inner, inner_range, outer, outer_range = node
        near = self._to(vantage, active) < (inner_range[1] + outer_range[0]) / 2
        for child, own in ((inner, active[near]), (outer, active[~near])):
            if len(own):
                self._descend(child, own)

    def _to(self, vantage: np.ndarray, active: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.q[active] - vantage) ** 2).sum(axis=1))

    def _walk(self, at: int, active: np.ndarray) -> None:
        node = self.nodes[at]
        if node[0] is None:
            active = active[self.home[active] != at]
            if len(active):
                self._scan(self.order[node[1] : node[2]], active)
            return
        vantage, inner, inner_range, outer, outer_range = node
        d = self._to(vantage, active)
        for child, span in ((inner, inner_range), (outer, outer_range)):
            lower = np.maximum(np.maximum(d - span[1], span[0] - d), 0)
            go = lower * self.factor <= self.limit[active] + SLACK * self.scale
            if go.any():
                self._walk(child, active[go])

    def _scan(self, rows: np.ndarray, active: np.ndarray) -> None:
        q = self.q[active]
        square = (q**2).sum(axis=1)[:, None] + self.squares[rows][None, :] - 2 * (q @ self.points[rows].T)
        np.maximum(square, 0, out=square)
        # Only queries to which some point of the leaf comes close enough go on.
        slack = SQUARE_SLACK * self.scale**2
        near = square.min(axis=1) <= self.limit[active] ** 2 + slack
        if not near.any():
            return
        active, square = active[near], square[near]
        keep = min(self.k, len(rows))
        if keep < len(rows):
            # Ties at the edge matter: all points as near as the keep-th, but for rounding, take part.
            edge = np.partition(square, keep - 1, axis=1)[:, keep - 1] + slack
            width = int((square <= edge[:, None]).sum(axis=1).max())
            part = np.argpartition(square, min(width, len(rows)) - 1, axis=1)[:, :width] if width < len(rows) else np.broadcast_to(np.arange(len(rows)), square.shape)
            square = np.take_along_axis(square, part, axis=1)
            own = rows[part]
        else:
            own = np.broadcast_to(rows, square.shape)
        score = np.empty(square.shape)
        step = max(1, EXACT // (square.shape[1] * self.raw.shape[1]))
        for a in range(0, len(active), step):
            products = self.raw[own[a : a + step]] * self.asked[active[a : a + step], None, :]
            score[a : a + step] = np.cumsum(products, axis=2)[:, :, -1]
        best = np.concatenate([self.best[active], score], axis=1)
        square = np.concatenate([self.square[active], square], axis=1)
        found = np.concatenate([self.rows[active], own], axis=1)
        ids = np.where(found >= 0, self.ids[found], np.iinfo(np.int64).max)
        order = np.lexsort((ids, -best), axis=1)[:, : self.k]
        for kept, new in ((self.best, best), (self.square, square), (self.rows, found)):
            kept[active] = np.take_along_axis(new, order, axis=1)
        self.limit[active] = np.minimum(self.limit[active], np.sqrt(self.square[active].max(axis=1) + slack))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows of the commonest finite, non-zero kind: (row numbers, vectors as doubles)."""
    import pyarrow.compute as pc

    length = pc.list_value_length(column)
    valid = pc.fill_null(pc.greater(length, 0), False).to_numpy(zero_copy_only=False)
    rows, vectors = [], []
    for i in np.flatnonzero(valid):
        v = column[int(i)].values
        if v.null_count:
            continue
        x = v.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            rows.append(i)
            vectors.append(x + 0.0)
    return np.array(rows, dtype=np.int64), vectors, len(column)


def distinct_vectors(table: DataFrame, key: str, vector: str, keep: int, every: int) -> DataFrame:
    """(vkey, vector, ids, asked): each vector that takes part once, with its ``keep`` least ids.

    ``asked``: some row of it is a query. Each task first merges its own copies, so
    a group of copies reaches the merge as one row a batch.
    """
    schema = T.StructType([T.StructField("vkey", T.BinaryType()), T.StructField("vector", T.BinaryType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("asked", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            rows, vectors, _ = _matrix(b.column(1))
            ids = b.column(0)
            groups: dict[bytes, list] = {}
            for i, v in zip(rows, vectors, strict=True):
                if (n := ids[int(i)].as_py()) is not None:
                    groups.setdefault(v.tobytes(), []).append(n)
            out = [(hashlib.blake2b(v, digest_size=16).digest(), v, sorted(set(n))[:keep], any(x % every == 0 for x in n)) for v, n in groups.items()]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.bool_())], names=schema.names)

    part = table.select(F.col(key).cast("long"), vector).mapInArrow(run, schema)
    # Two steps, so that no task gathers what all tasks hold of one vector.
    salted = part.withColumn("salt", F.spark_partition_id() % 64)
    for keys in (["vkey", "salt"], ["vkey"]):
        salted = salted.groupBy(*keys).agg(
            F.first("vector").alias("vector"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"), F.max("asked").alias("asked")
        )
    return salted


def nearest(table: DataFrame, k: int = 20, every: int = 20, factor: float = 1.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product for each query.

    Queries: rows whose id is divisible by ``every``; candidates: all rows but the
    query's own. Ties go to the smaller id. Null ids, and vectors that are null,
    empty, zero or hold null or non-finite components take no part; vectors of
    different lengths are never neighbours of each other. Fewer candidates give
    fewer rows, an empty table none. A repeated id with equal vectors counts once.

    Pivots and first bounds come from the ``SAMPLE`` least vectors in hash order;
    every vector is indexed.
    """
    spark = table.sparkSession
    keep = k + 1
    base = written(distinct_vectors(table, key, vector, keep, every).withColumn("dim", F.length("vector") / 8), "ann-vectors")
    sizes = {r["dim"]: r["n"] for r in base.groupBy("dim").agg(F.count("*").alias("n")).orderBy("dim").collect()}
    out = None
    for dim, n in sizes.items():
        found = _nearest_of(base.where(F.col("dim") == dim), int(dim), n, keep, factor)
        out = found if out is None else out.unionByName(found)
    shape = "query_id long, rank int, vec_id long, score double"
    if out is None:
        return spark.createDataFrame([], shape)
    asked = (
        table.select(F.col(key).cast("long").alias("query_id"), vector)
        .where(F.col("query_id") % every == 0)
    )
    answers = out.select("vkey", "answer")
    keyed = _keyed(asked, vector).dropDuplicates(["query_id", "vkey"])
    joined = keyed.join(answers, "vkey")
    own = F.slice(F.filter("answer", lambda a: a["vec_id"] != F.col("query_id")), 1, k)
    return (
        joined.select("query_id", F.posexplode(own).alias("at", "a"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), F.col("a.score").alias("score"))
    )


def _keyed(rows: DataFrame, vector: str) -> DataFrame:
    """(query_id, vkey) of the rows whose vectors take part."""
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vkey", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            at, vectors, _ = _matrix(b.column(1))
            keys = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in vectors]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(keys, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _nearest_of(base: DataFrame, dim: int, n: int, keep: int, factor: float) -> DataFrame:
    spark = base.sparkSession
    sample = [r["vector"] for r in base.orderBy("vkey").limit(SAMPLE).select("vector").collect()]
    sample = np.frombuffer(b"".join(map(bytes, sample)), dtype=np.float64).reshape(-1, dim)
    norms = _map_one(base, lambda x: np.sqrt((x**2).sum(axis=1)), dim)
    top = float(norms.agg(F.max("value")).first()[0]) * (1 + 1e-12)
    wide = _augment(sample, top)
    pivots = wide[: max(1, min(MAX_PIVOTS, n // (SHARD_POINTS // 8), len(wide)))]
    shared = spark.sparkContext.broadcast((pivots, wide, top))  # MAX_PIVOTS + SAMPLE vectors at most

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, _, m = shared.value
        for b in batches:
            x = _augment(_stack(b.column(b.schema.get_field_index("vector")), dim), m)
            d = _distances(x, p)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(x)), cell], pa.float64())], names=[*b.schema.names, "cell", "radius"])

    placed = base.mapInArrow(place, T.StructType([*base.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType())]))
    placed = written(placed, "ann-cells")
    # A row a cell: MAX_PIVOTS at most.
    cells = {r["cell"]: (r["n"], r["radius"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("radius")).collect()}
    salts = {c: -(-size // SHARD_POINTS) for c, (size, _) in cells.items()}
    salt = F.element_at(F.create_map(*[F.lit(x) for c, s in salts.items() for x in (c, s)]), F.col("cell"))
    points = placed.select("cell", F.pmod(F.xxhash64("vkey"), salt).cast("int").alias("salt"), "vkey", "vector", "ids")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, w, m = shared.value
        names = np.array(sorted(cells))
        radius = np.array([cells[c][1] for c in names])
        for b in batches:
            x = _stack(b.column(1), dim)
            for a in range(0, len(x), 256):
                q = _query(x[a : a + 256], m)
                near = np.sort(_distances(q, w), axis=1)
                # The k-th of the sample bounds the k-th of all.
                limit = near[:, keep - 1] if near.shape[1] >= keep else np.full(len(q), np.inf)
                lower = np.maximum(_distances(q, p[names]) - radius, 0)
                for i, hits in enumerate(lower * factor <= limit[:, None] + SLACK * m):
                    own = [(int(c), s) for c in names[hits] for s in range(salts[int(c)])]
                    one = b.slice(a + i, 1)
                    take = pa.array(np.zeros(len(own), dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c for c, _ in own], pa.int32()), pa.array([s for _, s in own], pa.int32()), one.column(0).take(take), one.column(1).take(take), pa.array(np.full(len(own), limit[i]), pa.float64())],
                        names=["cell", "salt", "vkey", "vector", "bound"],
                    )

    asked = base.where("asked").select("vkey", "vector").mapInArrow(route, "cell int, salt int, vkey binary, vector binary, bound double")
    answer = T.StructType([T.StructField("vkey", T.BinaryType()), T.StructField("score", T.DoubleType()), T.StructField("ids", T.ArrayType(T.LongType()))])

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"vkey": pd.Series(dtype=object), "score": pd.Series(dtype=float), "ids": pd.Series(dtype=object)})
        _, _, m = shared.value
        left = left.sort_values("vkey", kind="stable", ignore_index=True)
        x = np.frombuffer(b"".join(left["vector"]), dtype=np.float64).reshape(-1, dim)
        tree = Tree(_augment(x, m), x)
        least = np.array([i[0] for i in left["ids"]], dtype=np.int64)
        keys, scores, ids = [], [], []
        for a in range(0, len(right), BLOCK):
            part = right.iloc[a : a + BLOCK]
            q = np.frombuffer(b"".join(part["vector"]), dtype=np.float64).reshape(-1, dim)
            found, rows = tree.search(_query(q, m), q, keep, part["bound"].to_numpy() * (1 + SLACK), least, factor)
            for key, own, hits in zip(part["vkey"], found, rows, strict=True):
                own, hits = own[hits >= 0], hits[hits >= 0]
                keys += [key] * len(hits)
                scores += own.tolist()
                ids += [left["ids"].iat[j] for j in hits]
        return pd.DataFrame({"vkey": pd.Series(keys, dtype=object), "score": pd.Series(scores, dtype=float), "ids": pd.Series(ids, dtype=object)})

    found = points.groupBy("cell", "salt").cogroup(asked.groupBy("cell", "salt")).applyInPandas(search, answer)
    order = Window.partitionBy("vkey").orderBy(F.desc("score"), F.element_at("ids", 1))
    best = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= keep)
    one = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("vec_id")))
    merged = F.slice(F.array_sort(F.flatten(F.collect_list(one))), 1, keep)
    ranked = best.groupBy("vkey").agg(merged.alias("a"))
    return ranked.select("vkey", F.transform("a", lambda a: F.struct(a["vec_id"].alias("vec_id"), (-a["minus"]).alias("score"))).alias("answer"))


def _stack(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)


def _augment(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(top**2 - (x**2).sum(axis=1), 0))[:, None]], axis=1)


def _query(q: np.ndarray, top: float) -> np.ndarray:
    scaled = q * (top / np.sqrt((q**2).sum(axis=1)))[:, None]
    return np.concatenate([scaled, np.zeros((len(q), 1))], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0))


def _map_one(base: DataFrame, f, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _stack(b.column(0), dim)
            yield pa.RecordBatch.from_arrays([pa.array(f(x) if len(x) else [], pa.float64())], names=["value"])

    return base.select("vector").mapInArrow(run, "value double")
