"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles.

1. Every text becomes a *node*, a 128-bit hash of its words, so exact copies meet
   at once. Document frequencies of all shingles go into a count-min sketch of
   fixed size, merged from all tasks.
2. A text's weighted shingles (five words; tf and idf below) are sampled ``BANDS *
   ROWS`` times by improved consistent weighted sampling. Samples of a band make
   one bucket.
3. Texts that share a bucket are compared exactly by weighted Jaccard similarity.
   Large buckets are dealt into blocks, each text to one of them. A block takes its most
   typical texts first, each against all others at once, and stops when all
   are joined; it returns a forest, never all pairs.
4. Links make classes. Where a large bucket still falls into several classes, the
   texts outside its largest class meet all blocks that they have not met yet, so no
   link is lost; what the links have joined is not compared again.

The idf is ``1 + IDF * ln(M / df) / ln(M)``, M all shingles, tf ``1 + ln(count)``. A
strong idf would take copies apart: what a large group of near copies shares is
common, what sets them apart is rare, so their similarity would sink with the
group's size. ``IDF`` keeps weights within a quarter of each other. A sketch of fixed
size counts too much once shingles outnumber its cells by far: all idfs then near
their common floor, and the similarity nears that of tf alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec
from .common import drop, free_names, new_path, slices, small_batches, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 5
IDF = 0.25
#: Count-min sketch: two rows of so many cells, whatever the input; merged in segments.
CELLS = 1 << 22
SEGMENTS = 64
#: Texts in a block of a large bucket.
BLOCK = 128
#: Parts that the edges of one id are dealt into.
SALTS = 16
#: Bits of the filter that picks the texts to compare: 16 a text, at most 2**27 (16 MB). A full
#: filter lets more texts through than are needed; the join behind it drops them.
MAX_BITS = 1 << 27
_PAIR = "na long, nb long"
#: A text's id: its least doc_id (none: after all others) before 62 bits of its node; the least id of a class names it.
_ID = T.DecimalType(38, 0)
_LOW, _HALF = 1 << 62, 1 << 125


# --- shingles -------------------------------------------------------------------------------------------------


def shingles(texts: list, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, bounds, hashes, counts): 128-bit node of each text, and its distinct shingles in hash order.

    A text of fewer than ``n`` words has one shingle, all its words; a text
    without words has none. Case of A-Z doesn't count.
    """
    w = textvec.words(texts, lower=True)
    h, _ = textvec.ngrams(w, n)
    counts = w.counts
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        lone = np.array([textvec.combine([w.hashes[w.bounds[i] + j : w.bounds[i] + j + 1] for j in range(counts[i])])[0] for i in short], dtype=np.uint64)
    # A node: two hashes of the words in order.
    place = (np.arange(len(w.hashes)) - np.repeat(w.bounds[:-1], counts)).astype(np.uint64)
    nodes = np.zeros((len(texts), 2), dtype=np.uint64)
    full = counts > 0
    starts = w.bounds[:-1][full]
    for k, seed in enumerate((0x632BE59BD9B4E019, 0xD6E8FEB86659FD93)):
        if len(starts):
            nodes[full, k] = textvec.mix(np.add.reduceat(textvec.mix(w.hashes + textvec.mix(place + np.uint64(seed))), starts) + counts[full].astype(np.uint64))
    each = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    limits = np.concatenate([[0], np.cumsum(each)])
    if len(short):
        every = np.empty(limits[-1], dtype=np.uint64)
        is_short = np.repeat((counts > 0) & (counts < n), each)
        every[is_short], every[~is_short] = lone, h
        h = every
    for a, z in zip(limits[:-1], limits[1:], strict=True):
        h[a:z].sort()
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    new[limits[:-1][each > 0]] = True
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    return nodes, np.searchsorted(at, limits), h[at], tf


def _cells(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(CELLS - 1)).astype(np.int64), ((h >> np.uint64(40)) & np.uint64(CELLS - 1)).astype(np.int64)


class Weights:
    """Weights from a sketch of document frequencies, held as one byte a cell: idf at a 250th of its range."""

    def __init__(self, levels: np.ndarray, strength: float = IDF):
        self.levels = levels
        self.table = (1 + strength * np.arange(256) / 250).astype(np.float32)

    def of(self, h: np.ndarray, tf: np.ndarray) -> np.ndarray:
        a, b = _cells(h)
        idf = self.table[np.maximum(self.levels[0][a], self.levels[1][b])]  # the least count: the greatest idf
        w = idf.copy()
        many = tf > 1
        w[many] *= (1 + np.log(tf[many])).astype(np.float32)
        return w


# --- sampling -------------------------------------------------------------------------------------------------


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x), in the middle of n cells."""
    u = (np.arange(n) + 0.5) / n
    x = -np.log1p(-u) + 1.0
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - u) / np.maximum(x * np.exp(-x), 1e-300), 1e-9)
    return x.astype(np.float32)


_R = _gamma_quantiles(256)
_INV_R = (1 / _R).astype(np.float32)
_LN_C = np.log(_gamma_quantiles(65536)).astype(np.float32)
_CHUNK = 1 << 15


def signatures(bounds: np.ndarray, h: np.ndarray, w: np.ndarray, samples: int) -> np.ndarray:
    """``samples`` weighted samples of each set (Ioffe's scheme): hashes of (shingle, quantised weight).

    r and c are Gamma(2, 1) and beta uniform, read off tables by the bits of a hash of
    shingle and sample number; equal draws go to the shingle of smaller hash.
    Sets without shingles get zeros.
    """
    out = np.zeros((len(bounds) - 1, samples), dtype=np.uint64)
    low = (h ^ (h >> np.uint64(32))).astype(np.uint32)
    ln_w = np.log(w).astype(np.float32)
    begin = 0
    n = len(bounds) - 1
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + _CHUNK, side="right")) - 1)
        a, z = bounds[begin], bounds[end]
        own = np.flatnonzero(np.diff(bounds[begin : end + 1]))
        starts = (bounds[begin:end] - a)[own]
        lengths = np.diff(np.append(starts, z - a))
        if z > a:
            x0, lw, hh = low[a:z], ln_w[a:z], h[a:z]
            for k in range(samples):
                x = x0 ^ np.uint32((0x9E3779B9 * (k + 1)) & 0xFFFFFFFF)
                x *= np.uint32(0x85EBCA6B)
                x ^= x >> np.uint32(15)
                x *= np.uint32(0xC2B2AE35)
                x ^= x >> np.uint32(13)
                x *= np.uint32(0x27D4EB2F)
                x ^= x >> np.uint32(16)
                cell = x >> np.uint32(24)
                beta = ((x >> np.uint32(16)) & np.uint32(255)).astype(np.float32) * np.float32(1 / 256)
                t = lw * np.take(_INV_R, cell)
                t += beta
                np.floor(t, out=t)
                v = t - beta
                v += np.float32(1)
                v *= np.take(_R, cell)
                np.subtract(np.take(_LN_C, x & np.uint32(0xFFFF)), v, out=v)
                least = np.minimum.reduceat(v, starts)
                hits = np.flatnonzero(v == np.repeat(least, lengths))
                first = hits[np.searchsorted(hits, starts)]
                out[begin + own, k] = hh[first] + (t[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        begin = end
    return out


def buckets(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.empty((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        x = np.full(len(signature), textvec.ngram_seed(b + 100), dtype=np.uint64)
        for r in range(rows):
            x = textvec.mix(x + signature[:, b * rows + r] * np.uint64(0x9E3779B97F4A7C15))
        out[:, b] = x
    return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of lesser over sum of greater weights of two sets of (sorted hashes, weights)."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    shared = float(np.minimum(a[1][same], b[1][at[same]]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - shared
    return shared / total if total else 0.0


# --- stages ---------------------------------------------------------------------------------------------------


def _text_batches(b: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list]]:
    texts = b.column(column)
    for a, z in slices(texts):
        yield a, z, texts.slice(a, z - a).to_pylist()


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _nodes_and_sketch(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, na, nb) with a node for each document, and (segment, counts) of each task's sketch."""
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(_PAIR + ", segment int, counts binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        counts = np.zeros((2, CELLS), dtype=np.uint32)
        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            na, nb, full = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows, dtype=bool)
            for a, z, texts in _text_batches(b, 1):
                nodes, bounds, h, _ = shingles(texts)
                na[a:z], nb[a:z], full[a:z] = _signed(nodes[:, 0]), _signed(nodes[:, 1]), np.diff(bounds) > 0
                for row, cells in zip(counts, _cells(h), strict=True):
                    cell, n = _grouped(cells)
                    row[cell] += n
            none = pa.nulls(b.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(na, mask=~full), pa.array(nb, mask=~full), none, pa.nulls(b.num_rows, pa.binary())], names=schema.names
            )
        if kind is not None:
            pack = zstandard.ZstdCompressor(level=1)
            for s, part in enumerate(np.split(counts.reshape(-1), SEGMENTS)):
                yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([s], pa.int32()), pa.array([pack.compress(part.tobytes())])], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _grouped(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cells = np.sort(cells)
    at = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.empty(0, dtype=np.int64)
    return cells[at], np.diff(np.append(at, len(cells))).astype(np.uint32)


def _merged_sketch(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches, streamed by segment in two steps; counts beyond 2**32 stay there."""
    parts = parts.select("segment", "counts", (F.spark_partition_id() % 32).alias("salt"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        now, total = None, None
        for b in batches:
            for s, c in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                part = np.frombuffer(unpack.decompress(c.as_py()), dtype=np.uint32).astype(np.uint64)
                if s != now and now is not None:
                    yield _segment(now, total, pack)
                    total = None
                now, total = s, part if total is None else total + part
        if now is not None:
            yield _segment(now, total, pack)

    for keys in (["segment", "salt"], ["segment"]):
        cols = ["segment", "counts", *keys[1:]]
        placed = parts.select(*cols).repartition(*keys).sortWithinPartitions("segment")
        parts = placed.select("segment", "counts").mapInArrow(add, "segment int, counts binary")
        if len(keys) > 1:
            parts = written(parts, "dedup-sketch")
    out = np.zeros((SEGMENTS, 2 * CELLS // SEGMENTS), dtype=np.uint32)
    import zstandard

    for r in parts.collect():  # SEGMENTS rows of a fixed size
        out[r["segment"]] += np.frombuffer(zstandard.ZstdDecompressor().decompress(r["counts"]), dtype=np.uint32)
    return out.reshape(2, CELLS)


def _segment(s: int, total: np.ndarray, pack) -> pa.RecordBatch:
    value = np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()
    return pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([pack.compress(value)])], names=["segment", "counts"])


def _levels(counts: np.ndarray) -> np.ndarray:
    total = max(2.0, float(counts[0].sum(dtype=np.float64)))
    idf = np.log(total / np.maximum(counts, 1)) / np.log(total)
    return np.round(np.clip(idf, 0, 1) * 250).astype(np.uint8)


def _bucket_rows(docs: DataFrame, weights) -> DataFrame:
    """(bucket, na, nb): BANDS rows for each text; copies inside a batch give theirs once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for b in batches:
            for _, _, texts in _text_batches(b, 0):
                nodes, bounds, h, tf = shingles(list(dict.fromkeys(texts)))
                full = np.diff(bounds) > 0
                found = buckets(signatures(bounds, h, w.of(h, tf), BANDS * ROWS))[full]
                own = nodes[full]
                arrays = [pa.array(_signed(found).reshape(-1)), *[pa.array(np.repeat(_signed(own[:, i]), BANDS)) for i in (0, 1)]]
                yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "na", "nb"])

    return docs.select("text").mapInArrow(run, "bucket long, " + _PAIR)


def _filter_of(nodes: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter over nodes, three bits each, from SQL bit sums; its size is bounded by MAX_BITS."""
    n = max(1, nodes.count())
    bits = min(MAX_BITS, 1 << max(12, (16 * n - 1).bit_length()))
    mask = F.lit(bits - 1).cast("long")
    parts = [F.col("na"), F.col("nb"), F.shiftrightunsigned("na", 30)]
    at = F.explode(F.array(*[p.bitwiseAND(mask) for p in parts]))
    one = F.expr("shiftleft(1L, cast(at % 32 as int))")
    words = nodes.select(at.alias("at")).groupBy(F.shiftright("at", 5).cast("int").alias("i")).agg(F.bit_or(one).alias("w"))
    out = np.zeros(bits // 32, dtype=np.uint32)
    for b in words.toArrow().to_batches():
        out[b.column(0).to_numpy()] = b.column(1).to_numpy().astype(np.uint32)
    return out, bits


def _may_hold(words: np.ndarray, bits: int, nodes: np.ndarray) -> np.ndarray:
    out = np.ones(len(nodes), dtype=bool)
    for part in (nodes[:, 0], nodes[:, 1], nodes[:, 0] >> np.uint64(30)):
        at = (part & np.uint64(bits - 1)).astype(np.int64)
        out &= (words[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)).astype(bool)
    return out


def _weighted_sets(docs: DataFrame, weights, chosen) -> DataFrame:
    """(na, nb, hashes, weights) of the texts in the filter, once for each batch they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, (words, bits) = weights.value, chosen.value
        for b in batches:
            for _, _, texts in _text_batches(b, 0):
                texts = list(dict.fromkeys(texts))
                nodes, bounds, h, tf = shingles(texts)
                keep = np.flatnonzero((np.diff(bounds) > 0) & _may_hold(words, bits, nodes))
                if not len(keep):
                    continue
                weight, short = w.of(h, tf), (h >> np.uint64(32)).astype(np.uint32)
                sets, own = [], []
                for i in keep:
                    a, z = bounds[i], bounds[i + 1]
                    sets.append(short[a:z].tobytes())
                    own.append(weight[a:z].tobytes())
                yield pa.RecordBatch.from_arrays([*[pa.array(_signed(nodes[keep, i])) for i in (0, 1)], pa.array(sets, pa.binary()), pa.array(own, pa.binary())], names=["na", "nb", "hashes", "weights"])

    return docs.select("text").mapInArrow(run, _PAIR + ", hashes binary, weights binary")


def _text_id(rep: Column, na: Column, nb: Column) -> Column:
    high = F.coalesce(rep.cast(_ID), F.lit(Decimal(1 << 63))) * F.lit(Decimal(_LOW)) + F.lit(Decimal(_HALF))
    return (high.cast(_ID) + F.shiftrightunsigned(F.xxhash64(na, nb), 2).cast(_ID)).cast(_ID)


def _least_doc(id_: str) -> Column:
    """The doc_id in a text's id."""
    return F.when(F.col(id_) < F.lit(Decimal(2 * _HALF)), F.expr(f"({id_} - {id_} % {_LOW} - {_HALF}) div {_LOW}"))


class Block:
    """Weighted sets side by side, for comparing one with all at once."""

    def __init__(self, hashes: list, weights: list):
        self.sizes = np.array([len(h) for h in hashes]) // 4
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        self.weights = np.frombuffer(b"".join(weights), dtype=np.float32).astype(np.float64)
        shingles_, self.place = np.unique(np.frombuffer(b"".join(hashes), dtype=np.uint32), return_inverse=True)
        self.row = np.zeros(len(shingles_))
        self.totals = np.add.reduceat(self.weights, self.bounds[:-1])

    def typical(self) -> np.ndarray:
        """Texts by falling share of what others have too."""
        often = np.bincount(self.place)[self.place]
        return np.argsort(-np.add.reduceat(self.weights * often, self.bounds[:-1]) / self.totals, kind="stable")

    def similarity(self, i: int) -> np.ndarray:
        """Weighted Jaccard similarity of text ``i`` with every text."""
        own = slice(self.bounds[i], self.bounds[i + 1])
        self.row[self.place[own]] = self.weights[own]
        shared = np.add.reduceat(np.minimum(self.weights, self.row[self.place]), self.bounds[:-1])
        self.row[self.place[own]] = 0
        return shared / (self.totals[i] + self.totals - shared)


def links_in(hashes: list, weights: list, threshold: float, classes: np.ndarray | None = None, probes: np.ndarray | None = None) -> list[tuple[int, int, float]]:
    """Links (i, j, similarity) that join what is similar: a forest over the classes given, or over the texts.

    With ``probes`` only pairs of a probe and another text count. Texts of one class
    are not compared.
    """
    root = np.arange(len(hashes)) if classes is None else classes.copy()
    if len(root) < 2 or (root == root[0]).all():
        return []
    block, out = Block(hashes, weights), []
    order = block.typical()
    for i in order if probes is None else [i for i in order if probes[i]]:
        open_ = root != root[i]
        if probes is not None:
            open_ &= ~probes
        if not open_.any():
            if probes is None:
                break
            continue
        found = block.similarity(i)
        for j in np.flatnonzero(open_ & (found >= threshold * (1 - 1e-12))):
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                out.append((int(i), int(j), float(found[j])))
    return out


def _links_in_groups(members: DataFrame, group: list[str], threshold: float) -> DataFrame:
    """(a, b, similarity) of the links inside each group; rows come sorted by group.

    Columns of ``members``: those of ``group``, id, class, probe, hashes, weights. A null
    probe: all texts of the group are compared with each other.
    """
    schema = T.StructType([T.StructField("a", _ID), T.StructField("b", _ID), T.StructField("similarity", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, left, right, how = None, [], [], [], []

        def close() -> None:
            if len(rows) > 1:
                ids, classes, probe, hashes, weights = zip(*rows, strict=True)
                number = {c: i for i, c in enumerate(dict.fromkeys(classes))}
                probes = None if probe[0] is None else np.array(probe)
                for i, j, s in links_in(list(hashes), list(weights), threshold, np.array([number[c] for c in classes]), probes):
                    left.append(ids[i])
                    right.append(ids[j])
                    how.append(s)

        def flush() -> pa.RecordBatch:
            kind = pa.decimal128(38, 0)
            out = pa.RecordBatch.from_arrays([pa.array(left, kind), pa.array(right, kind), pa.array(how, pa.float64())], names=schema.names)
            for x in (left, right, how):
                x.clear()
            return out

        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if r[: len(group)] != now:
                    close()
                    now, rows = r[: len(group)], []
                rows.append(r[len(group) :])
            if len(left) > 10_000:
                yield flush()
        close()
        yield flush()

    return members.mapInArrow(run, schema)


def _compared(members: DataFrame, sets: DataFrame, group: list[str], threshold: float, name: str) -> DataFrame:
    rows = members.join(sets, ["na", "nb"]).select(*group, "id", "class", "probe", "hashes", "weights")
    rows = rows.repartition(*group).sortWithinPartitions(*group, "id")
    with small_batches(members.sparkSession):
        return written(_links_in_groups(rows, group, threshold), name)


def _rest(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, block, part, na, nb, id, class, probe): what is left to compare in large buckets.

    Of each bucket whose texts are not all of one class, the texts outside the
    largest class are probes; parts of at most about ``BLOCK`` probes meet each block.
    """
    large = shared.where(F.col("n") > BLOCK).join(roots, "id", "left").withColumn("class", F.coalesce("root", "id")).drop("root")
    large = written(large, "dedup-large")
    held = large.groupBy("bucket", "class").agg(F.count("*").alias("m"))
    most = held.groupBy("bucket").agg(F.max(F.struct("m", "class")).alias("most"), F.sum("m").alias("all"))
    most = most.select("bucket", F.col("most.class").alias("largest"), (F.col("all") - F.col("most.m")).alias("outside")).where("outside > 0")
    open_ = written(large.join(most, "bucket"), "dedup-open")
    blocks, parts = _blocks(F.col("n")), _blocks(F.col("outside"))
    pick = lambda n: F.pmod(F.xxhash64("id", "bucket"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["bucket", "block", "part", "na", "nb", "id", "class"]
    texts = open_.withColumn("block", pick(blocks)).withColumn("part", every(parts)).select(*columns, F.lit(False).alias("probe"))
    probes = open_.where("class <> largest").withColumn("part", pick(parts)).withColumn("block", every(blocks)).select(*columns, F.lit(True).alias("probe"))
    return texts.unionByName(probes)


def _blocks(n: Column) -> Column:
    return F.ceil(n / F.lit(float(BLOCK))).cast("int")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): the least id of each connected component, for ids in ``edges`` (large-star, small-star rounds).

    Every round's edges are written to the shared folder; ids and edges stay on the executors.
    """
    spark = edges.sparkSession
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    path, before = None, None

    def to_least(rows: DataFrame, least: DataFrame) -> DataFrame:
        """(u, v, m): rows with their u's least neighbour. A component's centre has most of its edges, so they are salted."""
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        return salted.join(least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge"), ["u", "salt"])

    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = to_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = to_least(large, least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        old, path = path, new_path(spark, "edges")
        small.distinct().write.parquet(path)
        now = spark.read.parquet(path)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if old:
            drop(spark, old)
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, na, nb, class_id): a row for each input row; class_id is the least doc_id of its class.

    Needs doc_id (an integer) and text. Texts without words, null ones among them,
    are classes of their own. Texts of fewer than five words have one shingle, so
    only copies match. Rows that repeat share a class. A null doc_id belongs to
    the class of its text, which it links like any other, and has a null class if no
    row of the class has an id. An empty table gives no rows. Case of A-Z and kinds
    of white space don't count. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    first = written(_nodes_and_sketch(docs), "dedup-nodes")
    own = first.where("segment is null").select("doc_id", "na", "nb")
    weights = spark.sparkContext.broadcast(Weights(_levels(_merged_sketch(first.where("segment is not null")))))

    rows = written(_bucket_rows(docs, weights).distinct(), "dedup-buckets")
    # Buckets with the same texts are one: bands agree on most groups.
    full = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.xxhash64("na", "nb").cast("decimal(38,0)")).alias("s")).where("n > 1")
    full = full.groupBy("n", "s").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    texts = own.where("na is not null").groupBy("na", "nb").agg(F.min("doc_id").alias("rep"))
    texts = written(texts.select("na", "nb", _text_id(F.col("rep"), F.col("na"), F.col("nb")).alias("id")), "dedup-texts")
    shared = written(rows.join(full, "bucket").join(texts, ["na", "nb"]), "dedup-shared")
    nodes = shared.select("na", "nb").distinct()
    chosen = spark.sparkContext.broadcast(_filter_of(nodes))
    sets = _weighted_sets(docs, weights, chosen).groupBy("na", "nb").agg(F.first("hashes").alias("hashes"), F.first("weights").alias("weights"))

    block = F.pmod(F.xxhash64("id", "bucket"), _blocks(F.col("n"))).cast("int")
    members = shared.select("bucket", block.alias("block"), "na", "nb", "id", F.col("id").alias("class"), F.lit(None).cast("boolean").alias("probe"))
    links = _compared(members, sets, ["bucket", "block"], threshold, "dedup-links")
    roots = components(links)
    if shared.where(F.col("n") > BLOCK).limit(1).count():
        roots = written(roots, "dedup-roots")
        more = _compared(_rest(shared, roots), sets, ["bucket", "block", "part"], threshold, "dedup-links")
        if more.limit(1).count():
            roots = components(links.unionByName(more))
    named = texts.join(roots, "id", "left").select("na", "nb", F.coalesce("root", "id").alias("root"))
    out = own.join(named, ["na", "nb"], "left")
    return out.select("doc_id", "na", "nb", F.coalesce(_least_doc("root"), F.col("doc_id").cast("long")).alias("class_id"))


def _with_nodes(docs: DataFrame, names: list[str]) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes = np.zeros((b.num_rows, 2), dtype=np.uint64)
            for a, z, texts in _text_batches(b, b.schema.get_field_index("text")):
                nodes[a:z] = shingles(texts)[0]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(_signed(nodes[:, i])) for i in (0, 1)]], names=schema.names)

    return docs.mapInArrow(run, schema)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, all columns of any name: one of each class, that of the least (doc_id, node).

    Rows without words all stay but for repeats with the same id; of rows without
    an id, or in classes without one, one of each text stays. An empty table stays empty.
    """
    found = near_duplicates(docs, threshold)
    group = F.when(F.col("na").isNull() | F.col("class_id").isNull(), F.struct(F.col("doc_id").alias("c"), F.coalesce("na", F.lit(0)).alias("x"), F.coalesce("nb", F.lit(0)).alias("y"))).otherwise(
        F.struct(F.col("class_id").alias("c"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    )
    least = found.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", F.coalesce("na", F.lit(0)).alias("a"), F.coalesce("nb", F.lit(0)).alias("b"))).alias("k"))
    id_, x, y, a, b, row = free_names(docs, "id", "x", "y", "node_a", "node_b", "row")
    kept = least.select(F.col("k.doc_id").alias(id_), F.col("k.a").alias(x), F.col("k.b").alias(y)).distinct()
    rows = _with_nodes(docs, [a, b])
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(a) == F.col(x)) & (F.col(b) == F.col(y))
    once = Window.partitionBy(a, b, "doc_id").orderBy(F.lit(1))
    joined = rows.join(kept, same, "left_semi").withColumn(row, F.row_number().over(once)).where(F.col(row) == 1)
    return joined.select(*[f"`{c}`" for c in docs.columns])
