"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled by a hash of their id. A document's
virtual finish time is its source's cumulative words, passes counted, divided by
the source's target. All (document, pass) pairs sorted by that time, up to the
total budget, make the mix: at any point of the order each source has given
words in proportion to its target.

No step needs all rows of a source, or all rows, in one task:

* the running sum inside a source is taken over (source, hash bucket) groups,
  with the sums of the earlier buckets added, so a source that holds a third of
  the rows is spread over ``BUCKETS`` groups;
* the global order is a range-sort: passes are range-partitioned by time bin (times
  are uniform in words by construction, so bins are even) and sorted inside; words
  before a bin come from sums by bin, of which there is a bounded number.

Only figures a source, and a row for each, meet in one task (``source_targets``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, word_count, written

BUCKETS = 4096
BINS = 4096
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3


def order_hash(doc_id: Column, seed: int) -> Column:
    """60 bits of md5, as a long; the shuffled order inside a source."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES, share: float = 1.0) -> DataFrame:
    """(source, source_size, source_rank, target) from (source, source_size).

    Sources by code point, null last, take the weights in turn and share
    ``share`` of all words. Targets stop at ``max_passes`` times the source's
    size; the excess is shared by weight among the others, until none is above.
    The level at which that ends is found in one sorted pass over the sources.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name).cast("long")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("source_rank", rank).withColumn("weight", w)
    ranked = ranked.withColumn("limit", F.col("source_size").cast("double") * max_passes)
    budget = F.least(F.sum("source_size").over(everything) * F.lit(float(share)), F.sum("limit").over(everything))
    full_at = F.col("limit") / F.col("weight")
    up_to = Window.orderBy("full_at", "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("full_at", "source_rank").rowsBetween(0, Window.unboundedFollowing)
    level = (budget - F.coalesce(F.sum("limit").over(up_to), F.lit(0.0))) / F.sum("weight").over(rest)
    leveled = ranked.withColumn("full_at", full_at).withColumn("level", level)
    open_level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "source_rank", "level"))).over(everything)
    target = F.coalesce(F.least(F.col("limit"), F.col("weight") * open_level["level"]), F.col("limit"))
    return leveled.select("source", "source_size", "source_rank", target.alias("target"))


def _bin(time: Column) -> Column:
    """Bins of even width below 1, then ``BINS`` a doubling; never falls as the time rises."""
    power = F.floor(F.log2(F.greatest(time, F.lit(1.0))))
    above = (power + 1) * BINS + F.floor((time / F.pow(F.lit(2.0), power) - 1) * BINS)
    return F.when(time < 1, F.floor(time * BINS)).otherwise(above).cast("long")


def mix_sources(docs: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES, share: float = 1.0, seed: int = 9) -> DataFrame:
    """The mix: (doc_id, source, size, source_size, target, copies, taken, text_hash), a row per input row.

    ``docs`` needs doc_id, text and source; other columns are ignored. Null texts
    and texts without words have size 0, and are taken 0 words. Null sources
    are a source of their own, the last. Repeated rows are mixed as rows of their
    own. An empty table gives no rows. Ties in time go by source, hash, id, pass;
    the result depends on the rows alone, not on their order or partitions.
    """
    sized = written(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
        .withColumn("spread", order_hash(F.col("doc_id"), seed)),
        "mix-sizes",
    )
    # A key that is never null: joins and windows meet on the same one.
    sized = sized.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    sized = sized.withColumn("bucket", F.shiftright("spread", 60 - 12).cast("int"))

    by_bucket = sized.groupBy("key", "bucket").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")))
    sources = by_bucket.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    targets = source_targets(sources.select("source", "source_size"), weights, max_passes, share)
    targets = targets.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    offsets = offsets.select("key", "bucket", "offset").join(targets, "key")

    inside = Window.partitionBy("key", "bucket").orderBy("spread", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    timed = (
        sized.join(offsets, ["key", "bucket"])
        .withColumn("reached", F.sum("size").over(inside) + F.col("offset"))
        .select("doc_id", "source", "size", "text_hash", "spread", "source_rank", "source_size", "target", "reached")
    )
    timed = written(timed, "mix-times")

    def time(n: int) -> Column:
        """Virtual finish time in pass n; null if the source never comes so far."""
        words = F.lit(n) * F.col("source_size") + F.col("reached")
        return F.when((F.col("target") > F.lit(n) * F.col("source_size")) & (F.col("size") > 0), words / F.col("target"))

    passes = timed.withColumn("passes", F.array(*[F.struct(F.lit(n).alias("pass"), time(n).alias("time")) for n in range(max_passes)]))
    passes = passes.select("doc_id", "size", "spread", "source_rank", F.explode("passes").alias("p")).where("p.time is not null")
    passes = passes.select("*", "p.pass", "p.time").withColumn("bin", _bin(F.col("time")))
    cut = _cut(_in_order(passes), timed, share)
    if cut is None:
        copies = F.lit(0)
    else:
        copies = sum(
            (
                F.when(time(n).isNotNull() & (F.struct(time(n), "source_rank", "spread", "doc_id", F.lit(n)) <= cut), 1).otherwise(0)
                for n in range(max_passes)
            ),
            F.lit(0),
        )
    return timed.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies.cast("long") * F.col("size")).alias("taken"), "text_hash"
    )


_KEY = ["time", "source_rank", "spread", "doc_id", "pass"]


def _in_order(passes: DataFrame) -> DataFrame:
    """All passes range-sorted by virtual finish time, ``sum``: the words up to and with each."""
    sums = passes.groupBy("bin").agg(F.sum("size").alias("words"))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("bin", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")).alias("before"))
    inside = Window.partitionBy("bin").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, 0)
    ranged = passes.repartitionByRange("bin").join(F.broadcast(offsets), "bin")  # BINS rows for each doubling of the time at most
    return ranged.withColumn("sum", F.col("before") + F.sum("size").over(inside))


def _cut(ordered: DataFrame, timed: DataFrame, share: float) -> Column | None:
    """The last (time, source_rank, spread, doc_id, pass) that the budget allows, as a literal: two single rows come to the driver."""
    budget = timed.agg(F.sum("size") * F.lit(float(share))).first()[0]
    if not budget:
        return None
    last = ordered.where(F.col("sum") <= F.lit(budget)).agg(F.max(F.struct(*_KEY)).alias("k")).first()["k"]
    if last is None:
        return None
    kinds = dict(ordered.dtypes)
    return F.struct(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in last.asDict().items()])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes them, all columns, whatever their names.

    Rows of equal doc_id, source and text share what they are given together. Rows
    come in no order: texts are not moved once more for that.
    """
    id_, source_, hash_, copies_, rows_, n_, own_, again_ = free_names(docs, "id", "source", "hash", "copies", "rows", "n", "own", "again")
    given = mix_sources(docs, **options).groupBy(F.col("doc_id").alias(id_), F.col("source").alias(source_), F.col("text_hash").alias(hash_))
    given = given.agg(F.sum("copies").alias(copies_), F.count("*").alias(rows_)).where(F.col(copies_) > 0)
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").cast("string").eqNullSafe(F.col(source_)) & (F.xxhash64("text") == F.col(hash_))
    order = Window.partitionBy(id_, source_, hash_).orderBy(F.lit(1))
    joined = docs.join(given, same).withColumn(n_, F.row_number().over(order))
    own = F.floor(F.col(copies_) / F.col(rows_)) + (F.col(n_) <= F.col(copies_) % F.col(rows_)).cast("long")
    repeated = joined.withColumn(own_, own).where(F.col(own_) > 0).withColumn(again_, F.explode(F.sequence(F.lit(1).cast("long"), F.col(own_))))
    return repeated.select(*[f"`{c}`" for c in docs.columns])
