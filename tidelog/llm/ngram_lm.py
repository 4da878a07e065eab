"""Language-model scoring from a log-frequency Bloom filter.

Counts of all n-grams (up to ``ORDER``) of the training documents are quantised,
level 1 + floor(log2(count)), and an n-gram of level q puts the q keys (n-gram, 1)
.. (n-gram, q) into a Bloom filter. A count is read by probing levels until one
is missing. The filter's size follows the number of keys, ``BITS_A_KEY`` each; no
n-gram is left out at any size.

A filter of up to ``MAX_BITS`` is broadcast to the workers. A larger one stays in
files, a row a segment, and is probed by a shuffle: slices of texts ask each
segment for the levels of their n-grams. Both ways read the same bits, so scores
don't depend on the way. Counts behind ``base_score`` are exact: tokens of at least
``1 / FREQUENT`` of all (there can't be more than ``FREQUENT`` of them) are broadcast,
all others are looked up by a shuffle.

Probability of a token after a context: (c(context token) + K * P(token after the
shorter context)) / (c(context) + K), down to (c(token) + 0.1) / (N + 0.1 (V + 1)).
A level stands for the least count that it covers in a numerator and for the greatest
in a denominator, so quantising never takes a context's sum past 1. What false
positives add is held down by sub-sequences: an n-gram's level is at most that of
its last token and of its context.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec
from .common import crc_of, new_path, slices, small_batches, written

ORDER = 2
BITS_A_KEY = 10
PROBES = 4
#: The largest filter that is broadcast.
MAX_BITS = 1 << 30
#: The filter is built and addressed in segments by the first bits of a hash.
SEGMENTS = 1024
FREQUENT = 1 << 18
K = 6.0
#: Rows here hold up to megabytes: pages are closed by size, so that the buffers they are compressed in stay small.
PACKED = {"parquet.page.size.row.check.min": "4", "parquet.page.size.row.check.max": "16", "parquet.block.size": str(32 << 20)}
#: Tokens counted before a task hands on its counts.
FLUSH = 1_500_000
END, BEGIN = np.uint64(0x5E2D58D8B3BCDEF3), np.uint64(0x1F83D9ABFB41BD6B)
_SHORT = 40


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): lower-cased words of each text, then one end."""
    w = textvec.words(texts, lower=True)
    n = w.counts + 1
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.full(bounds[-1], END)
    is_word = np.ones(len(out), dtype=bool)
    is_word[bounds[1:] - 1] = False
    out[is_word] = w.hashes
    return out, bounds


def ngram_hashes(h: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that ends at each token; places before a text's first token count as beginnings."""
    if n == 1:
        return h
    place = np.arange(len(h)) - np.repeat(bounds[:-1], np.diff(bounds))
    parts = []
    for back in range(n - 1, -1, -1):
        x = np.full(len(h), BEGIN)
        x[back:] = h[: len(h) - back]
        x[place < back] = BEGIN
        parts.append(x)
    return textvec.combine(parts)


def context_hashes(h: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that ends right before each token (for the first token: all beginnings)."""
    own = ngram_hashes(h, bounds, n)
    before = np.empty_like(own)
    before[1:] = own[:-1]
    begin = textvec.combine([np.full(1, BEGIN)] * n)[0] if n > 1 else BEGIN
    before[bounds[:-1]] = begin
    return before


def level(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1


#: The least and the greatest count that a level covers.
LEAST = np.array([0.0] + [2.0 ** (q - 1) for q in range(1, 64)])
MOST = 2.0 ** np.arange(64) - 1


def _grouped(h: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and their summed counts."""
    if counts is None:
        h = np.sort(h)
    else:
        order = np.argsort(h, kind="stable")
        h, counts = h[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, dtype=np.int64)
    sums = np.diff(np.append(at, len(h))) if counts is None else (np.add.reduceat(counts, at) if len(at) else counts)
    return h[at], sums.astype(np.int64)


# --- counts ---------------------------------------------------------------------------------------------------


def _pack(h: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Short hashes (the 40 bits after the segment) in five bytes each, and compressed counts."""
    import zstandard

    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes(), zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").tobytes())


def _unpack(h: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    short = np.frombuffer(h, dtype=np.uint8).reshape(-1, 5)
    out = np.zeros((len(short), 8), dtype=np.uint8)
    out[:, :5] = short
    return out.view("<u8").reshape(-1).astype(np.uint64), np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), dtype="<i8").astype(np.int64)


def _segmented(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment, and the 40 bits after it."""
    bits = SEGMENTS.bit_length() - 1
    return (h >> np.uint64(64 - bits)).astype(np.int64), (h >> np.uint64(64 - bits - _SHORT)) & np.uint64((1 << _SHORT) - 1)


def _count_rows(h: np.ndarray, kind: int) -> tuple[list, list, list, list]:
    h, counts = _grouped(h)
    segment, short = _segmented(h)
    cut = np.searchsorted(segment, np.arange(SEGMENTS + 1))
    rows: tuple[list, list, list, list] = ([], [], [], [])
    for s in np.flatnonzero(np.diff(cut)):
        a, b = _pack(short[cut[s] : cut[s + 1]], counts[cut[s] : cut[s + 1]])
        for column, x in zip(rows, (kind, int(s), a, b), strict=True):
            column.append(x)
    return rows


def _counts(docs: DataFrame, order: int) -> DataFrame:
    """(kind, segment, hashes, counts): sums over all rows of ``docs``. Kind 1: tokens; kind 0: longer n-grams, with beginnings."""
    shape = "kind int, segment int, hashes binary, counts binary"
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def batch(rows: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["kind", "segment", "hashes", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            yield batch(_count_rows(np.concatenate([x for x, _ in held]), 1))
            longer = [y for _, y in held if len(y)]
            if longer:
                yield batch(_count_rows(np.concatenate(longer), 0))

        for b in batches:
            texts = b.column(0)
            for a, z in slices(texts):
                h, bounds = tokens(texts.slice(a, z - a).to_pylist())
                longer = [ngram_hashes(h, bounds, n) for n in range(2, order + 1)]
                # Contexts made of beginnings only: one for each text and length.
                longer += [np.full(z - a, textvec.combine([np.full(1, BEGIN)] * n)[0] if n > 1 else BEGIN) for n in range(1, order)]
                held.append((h, np.concatenate(longer) if longer else np.empty(0, dtype=np.uint64)))
                size += len(h)
                if size >= FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, size = None, [], 0

        def one() -> list[tuple[np.ndarray, np.ndarray]]:
            return [_grouped(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]))]

        def row() -> pa.RecordBatch:
            h, c = one()[0]
            return batch(([now[0]], [now[1]], *[[x] for x in _pack(h, c)]))

        for b in batches:
            for kind, segment, h, c in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if (kind, segment) != now:
                    if now:
                        yield row()
                    now, parts, size = (kind, segment), [], 0
                parts.append(_unpack(h, c))
                size += len(parts[-1][0])
                if len(parts) > 1 and size > 2 * len(parts[0][0]) + 1_000_000:
                    parts = one()
                    size = len(parts[0][0])
        if now:
            yield row()

    parts = docs.select("text").mapInArrow(count, shape)
    placed = parts.repartition("kind", "segment").sortWithinPartitions("kind", "segment")
    with small_batches(docs.sparkSession, 250):
        return written(placed.mapInArrow(merge, shape), "lm-counts", **PACKED)


# --- filter ---------------------------------------------------------------------------------------------------


def _positions(short: np.ndarray, q: int, size: np.ndarray | int) -> list[np.ndarray]:
    """PROBES bits of a segment of ``size`` bits: 32-bit hashes scaled to the size."""
    x = textvec.mix(short * np.uint64(0x9E3779B97F4A7C15) + np.uint64((q * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF))
    a, b = x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    size, low = np.asarray(size, dtype=np.uint64), np.uint64(0xFFFFFFFF)
    return [(((a + np.uint64(j) * b) & low) * size >> np.uint64(32)).astype(np.int64) for j in range(PROBES)]


@dataclass
class Filter:
    """Bits of all segments behind one another; ``offset`` and ``size`` by segment, in bits."""

    bits: np.ndarray
    offset: np.ndarray
    size: np.ndarray

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Level of each n-gram by repeated probes: 0 if it isn't there."""
        return self.levels_at(*_segmented(h))

    def levels_at(self, segment: np.ndarray, short: np.ndarray) -> np.ndarray:
        out = np.zeros(len(short), dtype=np.int64)
        live = np.flatnonzero(self.size[segment] > 0)
        q = 1
        while len(live) and q < 63:
            s = segment[live]
            offset, size = self.offset[s], self.size[s]
            x = short[live]
            keep = np.ones(len(live), dtype=bool)
            for at in _positions(x, q, size):
                at += offset
                keep &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            live = live[keep]
            out[live] = q
            q += 1
        return out


def _joined(rows: list[tuple[int, bytes]]) -> Filter:
    """A filter of the segments in ``rows``; the others are empty."""
    offset, width = np.zeros(SEGMENTS, dtype=np.int64), np.zeros(SEGMENTS, dtype=np.int64)
    at = 0
    for segment, value in rows:
        offset[segment], width[segment] = at, 8 * len(value)
        at += 8 * len(value)
    return Filter(np.frombuffer(b"".join(v for _, v in rows) or b"\0", dtype=np.uint8), offset, width)


def _filter(counts: DataFrame, max_bits: int) -> tuple[Filter, str | None]:
    """Builds every segment's bits from its counts on the executors: gathered up to max_bits in all, else an empty filter and the path of the rows."""

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                n = np.bincount(level(_unpack(h, c)[1]), minlength=64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(64), pa.int32()), pa.array(n, pa.int64())], names=["level", "n"])

    seen = counts.select("hashes", "counts").mapInArrow(histogram, "level int, n long").groupBy("level").agg(F.sum("n").alias("n"))
    by_level = np.zeros(64, dtype=np.int64)
    for r in seen.collect():  # 64 rows
        by_level[r["level"]] = r["n"]
    # Each segment is rounded up to 64 bits.
    fits = int((by_level * np.arange(64)).sum()) * BITS_A_KEY + 64 * SEGMENTS <= max_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, []

        def row() -> pa.RecordBatch:
            short, q = np.concatenate([x for x, _ in own]), np.concatenate([y for _, y in own])
            keys = int(q.sum())
            size = max(64, -(-keys * BITS_A_KEY // 64) * 64)
            bits = np.zeros(size, dtype=bool)
            for n in range(1, int(q.max(initial=0)) + 1):
                for at in _positions(short[q >= n], n, size):
                    bits[at] = True
            value = np.packbits(bits, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([value], pa.binary())], names=["segment", "bits"])

        for b in batches:
            for s, h, c in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if s != now:
                    if now is not None:
                        yield row()
                    now, own = s, []
                short, n = _unpack(h, c)
                own.append((short, level(n)))
        if now is not None:
            yield row()

    placed = counts.select("segment", "hashes", "counts").repartition("segment").sortWithinPartitions("segment")
    with small_batches(counts.sparkSession):
        bits = placed.mapInArrow(build, "segment int, bits binary")
        if not fits:
            path = new_path(counts.sparkSession, "lm-filter")
            bits.write.parquet(path)
            return _joined([]), path
        # One row a segment, max_bits in all; a partition at a time, so that the driver holds them once.
        return _joined([(r["segment"], bytes(r["bits"])) for r in bits.toLocalIterator()]), None


# --- scores ---------------------------------------------------------------------------------------------------


@dataclass
class Model:
    filter: Filter
    order: int
    total: int
    distinct: int
    frequent: np.ndarray  # short hash with segment, sorted
    frequent_counts: np.ndarray
    segments: int  # of the lookups of the other tokens, and of n-grams where the filter is stored
    stored: str | None = None  # path of the filter's segments where it is too large to broadcast

    @property
    def floor(self) -> float:
        return self.total + 0.1 * (self.distinct + 1)


def _full(segment: np.ndarray, short: np.ndarray) -> np.ndarray:
    return (segment.astype(np.uint64) << np.uint64(_SHORT)) | short


def train(docs: DataFrame, order: int = ORDER, max_bits: int = MAX_BITS) -> tuple[Model, DataFrame]:
    """The model, and the exact token counts as (segment, hashes, counts), from all rows of ``docs``."""
    counts = _counts(docs, order)
    single = counts.where("kind = 1").select("segment", "hashes", "counts")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [_unpack(h, c)[1] for h, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([int(c.sum()) for c in both], pa.int64()), pa.array([len(c) for c in both], pa.int64())], names=["n", "v"])

    row = single.select("hashes", "counts").mapInArrow(sums, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    total, distinct = int(row[0] or 0), int(row[1] or 0)
    least = total / FREQUENT

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, h, c in zip(*[x.to_pylist() for x in b.columns], strict=True):
                short, n = _unpack(h, c)
                keep = n > least
                yield pa.RecordBatch.from_arrays([pa.array(_full(np.full(keep.sum(), s), short[keep]).view(np.int64)), pa.array(n[keep])], names=["h", "n"])

    found = single.mapInArrow(often, "h long, n long").toArrow()
    h = found.column(0).to_numpy().view(np.uint64)
    rank = np.argsort(h)
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    segments = min(SEGMENTS, 1 << max(4, (size >> 25).bit_length()))
    bits, stored = _filter(counts, max_bits)
    return Model(bits, order, total, distinct, h[rank], found.column(1).to_numpy()[rank], segments, stored), single


def _log_probabilities(m: Model, h: np.ndarray, bounds: np.ndarray, single: np.ndarray, back: np.ndarray) -> np.ndarray:
    """log10 of each token's probability; ``single``: levels of the distinct tokens, ``back``: which one each token is."""
    own = single[back]
    p = (LEAST[single] + 0.1)[back] / m.floor
    for n in range(2, m.order + 1):
        if n == 2:
            context = np.empty(len(h), dtype=np.int64)
            context[1:] = own[:-1]
            context[bounds[:-1]] = m.filter.levels(np.array([BEGIN]))[0]
        else:
            context = m.filter.levels(context_hashes(h, bounds, n - 1))
        joint = np.minimum(m.filter.levels(ngram_hashes(h, bounds, n)), np.minimum(own, context))
        p = (LEAST[joint] + K * p) / (MOST[context] + K)
    return np.log10(np.maximum(p, 1e-300))


def _nodes(h: np.ndarray, bounds: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each text's tokens in order."""
    place = (np.arange(len(h)) - bounds[:-1][owner]).astype(np.uint64)
    return [textvec.mix(np.add.reduceat(textvec.mix(h + textvec.mix(place + np.uint64(k))), bounds[:-1])).view(np.int64) for k in (11, 23)]


@dataclass
class Answers:
    """Levels of the sorted n-grams that a slice of texts asked for, read like a filter."""

    hashes: np.ndarray
    found: np.ndarray

    def levels(self, h: np.ndarray) -> np.ndarray:
        return self.found[np.searchsorted(self.hashes, h)]


def _asked(h: np.ndarray, bounds: np.ndarray, order: int) -> np.ndarray:
    """All n-grams whose levels ``_log_probabilities`` reads, sorted."""
    longer = [ngram_hashes(h, bounds, n) for n in range(2, order + 1)] + [context_hashes(h, bounds, n) for n in range(2, order)]
    return np.unique(np.concatenate([h, [BEGIN], *longer]))


def _stored_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(na, nb, looked): the score of each text, with the stored filter's segments probed by shuffle.

    Slices of texts are written with their requests, a row a part of the filter;
    answers, one byte an n-gram, meet their slice again under its number.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    shape = "slice long, part int, first int, value binary"
    names, kinds = ["slice", "part", "first", "value"], [pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [()] * 4, kinds, strict=True)], names=names)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        import zstandard

        m, pack = shared.value, zstandard.ZstdCompressor(level=1)
        shift = np.uint64(SEGMENTS.bit_length() - 1 + _SHORT - (m.segments.bit_length() - 1))
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for a, z in slices(b.column(0)):
                texts = list(dict.fromkeys(b.column(0).slice(a, z - a).to_pylist()))
                key = _full(*_segmented(_asked(*tokens(texts), m.order)))
                cut = np.searchsorted((key >> shift).astype(np.int64), np.arange(m.segments + 1))
                rows = [(number, -1, -1, pack.compress(pickle.dumps(texts)))]
                for s in np.flatnonzero(np.diff(cut)):
                    rows.append((number, int(s), -1, pack.compress(np.diff(key[cut[s] : cut[s + 1]], prepend=np.uint64(0)).tobytes())))
                yield batch(rows)
                number += 1

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by part, the filter's segments first."""
        import zstandard

        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        now, own, bits = None, [], None
        for b in batches:
            out = []
            for number, part, first, value in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if part != now:
                    now, own, bits = part, [], None
                if first >= 0:
                    own.append((first, value))
                    continue
                bits = bits or _joined(own)
                key = np.cumsum(np.frombuffer(unpack.decompress(value), dtype=np.uint64), dtype=np.uint64)
                found = bits.levels_at((key >> np.uint64(_SHORT)).astype(np.int64), key & np.uint64((1 << _SHORT) - 1))
                out.append((number, part, -1, pack.compress(found.astype(np.uint8).tobytes())))
            yield batch(out)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by slice: its texts, then the answers in the order of the parts."""
        import pickle

        import zstandard

        m, unpack = shared.value, zstandard.ZstdDecompressor()
        now, texts, found = None, [], []

        def row() -> pa.RecordBatch:
            h, bounds = tokens(texts)
            distinct, back = np.unique(h, return_inverse=True)
            levels = Answers(_asked(h, bounds, m.order), np.frombuffer(b"".join(found), dtype=np.uint8).astype(np.int64))
            logp = _log_probabilities(replace(m, filter=levels), h, bounds, levels.levels(distinct), back)
            owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
            arrays = [*_nodes(h, bounds, owner), np.bincount(owner, weights=logp, minlength=len(texts))]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["na", "nb", "looked"])

        for b in batches:
            for number, part, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                if number != now:
                    if now is not None:
                        yield row()
                    now, texts, found = number, [], []
                if part < 0:
                    texts = pickle.loads(unpack.decompress(value))
                else:
                    found.append(unpack.decompress(value))
        if now is not None:
            yield row()

    ratio = SEGMENTS // model.segments
    with small_batches(spark, 250):
        rows = written(docs.select("text").mapInArrow(ask, shape), "lm-requests", **PACKED)
        bits = spark.read.parquet(model.stored).select(F.lit(-1).cast("long").alias("slice"), (F.col("segment") / F.lit(ratio)).cast("int").alias("part"), F.col("segment").alias("first"), F.col("bits").alias("value"))
        both = bits.unionByName(rows.where("part >= 0")).repartition("part").sortWithinPartitions("part", F.desc("first"))
        levels = written(both.mapInArrow(answer, shape), "lm-levels", **PACKED)
        back = rows.where("part < 0").unionByName(levels).repartition("slice").sortWithinPartitions("slice", "part")
        scores = written(back.mapInArrow(score, "na long, nb long, looked double"), "lm-looked")
    # Equal texts in several slices have the same score.
    return scores.groupBy("na", "nb").agg(F.first("looked").alias("looked"))


def score_documents(docs: DataFrame, model: Model, single: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of doc_id, text.

    Null texts are empty: one token, the end. Nothing trained (N = 0): every
    token is unknown. Repeated rows score alike. Each text's rare tokens are
    looked up by shuffle and meet its row again under a hash of the text.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    own = [docs.schema["doc_id"], T.StructField("held_out", T.BooleanType())]
    shape = "na long, nb long, n_tokens long, n_known long, base double, score double, part int, request binary"
    schema = T.StructType([*own, *T._parse_datatype_string(shape).fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        shift = np.uint64(SEGMENTS.bit_length() - 1 + _SHORT - (m.segments.bit_length() - 1))
        for b in batches:
            texts = b.column(2)
            for a, z in slices(texts, 1 << 18):
                h, bounds = tokens(texts.slice(a, z - a).to_pylist())
                n = np.diff(bounds)
                owner = np.repeat(np.arange(len(n)), n)
                order = np.argsort(h)
                sorted_h = h[order]
                new = np.concatenate([[True], sorted_h[1:] != sorted_h[:-1]])
                back = np.empty(len(h), dtype=np.int64)
                back[order] = np.cumsum(new) - 1
                distinct = sorted_h[new]
                full = _full(*_segmented(distinct))
                at = np.minimum(np.searchsorted(m.frequent, full), max(0, len(m.frequent) - 1))
                is_often = m.frequent[at] == full if len(m.frequent) else np.zeros(len(full), dtype=bool)
                often = is_often[back]
                logs = np.zeros(len(full))
                logs[is_often] = np.log10(m.frequent_counts[at[is_often]] + 0.1)
                node = _nodes(h, bounds, owner)
                known = np.bincount(owner, weights=often, minlength=len(n)).astype(np.int64)
                base = np.bincount(owner, weights=logs[back], minlength=len(n)) - n * np.log10(m.floor)
                none = len(n)
                if m.stored:
                    total = pa.nulls(none, pa.float64())
                else:
                    logp = _log_probabilities(m, h, bounds, m.filter.levels(distinct), back)
                    total = pa.array(np.bincount(owner, weights=logp, minlength=none))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), b.column(1).slice(a, z - a), *[pa.array(x) for x in node], pa.array(n), pa.array(known), pa.array(base), total, pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())],
                    names=schema.names,
                )
                # Requests: for each part of the hashes, which text has which rare token; equal texts ask once.
                first = np.zeros(len(n), dtype=bool)
                first[np.unique(node[0], return_index=True)[1]] = True
                rare = np.flatnonzero(~often & first[owner])
                key = full[back[rare]]
                part = (key >> shift).astype(np.int64)
                order = np.argsort(part, kind="stable")
                rare, key, part = rare[order], key[order], part[order]
                cut = np.searchsorted(part, np.arange(m.segments + 1))
                ids, blobs = [], []
                for s in np.flatnonzero(np.diff(cut)):
                    who = owner[rare[cut[s] : cut[s + 1]]]
                    blobs.append(np.stack([node[0][who], node[1][who], key[cut[s] : cut[s + 1]].view(np.int64)]).tobytes())
                    ids.append(int(s))
                none = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(none, b.column(0).type), pa.nulls(none, pa.bool_()), *[pa.nulls(none, pa.int64())] * 4, *[pa.nulls(none, pa.float64())] * 2, pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())],
                    names=schema.names,
                )

    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text").mapInArrow(score, schema)
    with small_batches(spark, 250):
        rows = written(rows, "lm-scores", **PACKED)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by part, the counts first: for each request the sums of its texts."""
        now, table, counts = None, [], []
        keys = values = None
        for b in batches:
            for part, first, h, c in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if part != now:
                    now, table, counts, keys = part, [], [], None
                if first >= 0:
                    short, n = _unpack(h, c)
                    table.append(_full(np.full(len(short), first), short))
                    counts.append(n)
                    continue
                if keys is None:
                    keys = np.concatenate(table) if table else np.empty(0, dtype=np.uint64)
                    values = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
                    order = np.argsort(keys)
                    keys, values = keys[order], values[order]
                na, nb, key = np.frombuffer(h, dtype=np.int64).reshape(3, -1)
                key = key.view(np.uint64)
                at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
                n = np.where(keys[at] == key, values[at], 0) if len(keys) else np.zeros(len(key), dtype=np.int64)
                order = np.lexsort((nb, na))
                na, nb, n = na[order], nb[order], n[order]
                start = np.flatnonzero(np.concatenate([[True], (na[1:] != na[:-1]) | (nb[1:] != nb[:-1])]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(na[start]), pa.array(nb[start]), pa.array(np.full(len(start), part), pa.int32()), pa.array(np.add.reduceat((n > 0).astype(np.int64), start)), pa.array(np.add.reduceat(np.log10(n + 0.1), start))],
                    names=["na", "nb", "part", "known", "logs"],
                )

    ratio = SEGMENTS // model.segments
    table = single.select((F.col("segment") / F.lit(ratio)).cast("int").alias("part"), F.col("segment").alias("first"), "hashes", "counts")
    asked = rows.where("part is not null").select("part", F.lit(-1).alias("first"), F.col("request").alias("hashes"), F.lit(None).cast("binary").alias("counts"))
    both = table.unionByName(asked).repartition("part").sortWithinPartitions("part", F.desc("first"))
    with small_batches(spark, 250):
        sums = written(both.mapInArrow(answer, "na long, nb long, part int, known long, logs double"), "lm-answers", **PACKED)
    # Equal texts in several batches asked for the same: one answer each.
    sums = sums.groupBy("na", "nb", "part").agg(F.first("known").alias("known"), F.first("logs").alias("logs"))
    sums = sums.groupBy("na", "nb").agg(F.sum("known").alias("known"), F.sum("logs").alias("logs"))
    texts = rows.where("part is null").drop("part", "request")
    out = texts.join(sums, ["na", "nb"], "left")
    if model.stored:
        out = out.drop("score").join(_stored_scores(docs, model).withColumnRenamed("looked", "score"), ["na", "nb"], "left")
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        "score",
    )


def held_out(doc_id: str):
    return crc_of(F.col(doc_id)) % 10 == 0


def score_corpus(docs: DataFrame, order: int = ORDER, max_bits: int = MAX_BITS) -> DataFrame:
    """Scores every row with a model of those that are not held out."""
    docs = docs.select("doc_id", "text")
    model, single = train(docs.where(~held_out("doc_id")), order, max_bits)
    return score_documents(docs, model, single)
