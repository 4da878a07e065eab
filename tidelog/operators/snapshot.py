"""Bounded, resumable, key-ordered snapshots as change records.

A snapshot of a table is one range scan: rows whose key is above the last one read
and at most the end found when it began. Both bounds are literals in the
plan, so they reach the Parquet or JDBC scan. Several tables are one union of
scans that Spark runs side by side, each split into as many tasks as it has input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.position import Position, PositionType, SnapshotPosition, snapshot_position
from ..sources.catalog import CatalogError, check_key
from ..sources.options import FETCH_SIZE


class SnapshotError(ValueError):
    pass


@dataclass
class Bounds:
    last_read: int | None = 0
    snapshot_end: int | None = None


def validate_request(table: str, key: str, position: Position | None) -> None:
    errors = []
    if not table:
        errors.append("table name is required")
    if not key:
        errors.append("table key required")
    if position and position.type == PositionType.CDC:
        errors.append("invalid position type CDC")
    if errors:
        raise SnapshotError("\n".join(errors))


def bounds_of(table: str, position: Position | None, include_nonpositive: bool = False) -> Bounds:
    """Where a snapshot of a table goes on. Unknown tables begin at 0, or before all keys; an end of 0 is found anew."""
    found = (position.snapshots or {}).get(table) if position else None
    if found:
        return Bounds(found.last_read, found.snapshot_end or None)
    return Bounds(None if include_nonpositive else 0)


def end_of(df: DataFrame, key: str) -> Column:
    return F.coalesce(F.max(F.col(key).cast("bigint")), F.lit(0).cast("bigint"))


def snapshot_end(df: DataFrame, key: str) -> int:
    """The greatest key, 0 for an empty table. Parquet answers from its footers where it can."""
    return int(df.agg(end_of(df, key).alias("k")).first()["k"])


def snapshot_ends(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(collection, snapshot_end) of several tables."""
    out = None
    for name, (df, key) in tables.items():
        one = df.agg(end_of(df, key).alias("snapshot_end")).select(F.lit(name).alias("collection"), "snapshot_end")
        out = one if out is None else out.unionByName(one)
    return out


def scan(df: DataFrame, key: str, last_read: int | None, end: int, ordered: bool = False) -> DataFrame:
    """Rows with ``last_read`` < key <= ``end``; ``ordered`` sorts by key over all partitions."""
    k = F.col(key)
    rows = df.where(k <= end) if last_read is None else df.where((k > last_read) & (k <= end))
    return rows.orderBy(k) if ordered else rows


def cursor_text(table: str, key: str, last_read: int, end: int) -> str:
    """The scan as SQL, for sources that are given a query."""
    from ..sources.catalog import quote_ident

    k = quote_ident(key)
    return f"SELECT * FROM {table} WHERE {k} > {last_read} AND {k} <= {end} ORDER BY {k}"


def snapshot(df: DataFrame, table: str, key: str, position: Position | None = None, include_nonpositive: bool = False) -> DataFrame:
    """Records of a table: collection, operation, lsn, position, key, before, after, present.

    ``position`` of each row says how far the snapshot is when that row is done.
    """
    validate_request(table, key, position)
    check_key(df.schema, table, key)
    b = bounds_of(table, position, include_nonpositive)
    end = snapshot_end(df, key) if b.snapshot_end is None else b.snapshot_end
    k = F.col(key).cast("bigint")
    after = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return scan(df, key, b.last_read, end).select(
        F.lit(table).alias("collection"),
        F.lit("snapshot").alias("operation"),
        F.lit(None).cast("bigint").alias("lsn"),
        snapshot_position(table, k, F.lit(end)).alias("position"),
        F.struct(F.col(f"`{key}`")).alias("key"),
        F.lit(None).cast(df.schema).alias("before"),
        after.alias("after"),
        F.array(*[F.lit(c) for c in df.columns]).alias("present"),
    )


def common_envelope(records: DataFrame) -> DataFrame:
    """The same records with key and images as JSON, so that tables of any columns can stand in one feed."""
    json = lambda c: F.to_json(c).alias(c)
    return records.select("collection", "operation", "lsn", "position", json("key"), json("before"), json("after"), "present")


def snapshot_tables(tables: dict[str, tuple[DataFrame, str]], position: Position | None = None, include_nonpositive: bool = False) -> DataFrame:
    """One feed of several tables. All tables are checked first; all that is wrong is reported together."""
    errors = []
    for name, (df, key) in tables.items():
        try:
            validate_request(name, key, position)
            check_key(df.schema, name, key)
        except (SnapshotError, CatalogError) as e:
            errors.append(f'failed to validate table fetcher "{name}" config: {e}')
    if errors:
        raise SnapshotError("\n".join(errors))
    out = None
    for name, (df, key) in tables.items():
        one = common_envelope(snapshot(df, name, key, position, include_nonpositive))
        out = one if out is None else out.unionByName(one)
    return out


def end_position(tables: dict[str, tuple[DataFrame, str]], last_lsn: str = "") -> Position:
    """The position after a whole snapshot of all tables."""
    ends = {r["collection"]: r["snapshot_end"] for r in snapshot_ends(tables).collect()}  # a row a table
    return Position(PositionType.SNAPSHOT, {t: SnapshotPosition(e, e) for t, e in ends.items()}, last_lsn)


def pages(df: DataFrame, key: str, size: int = FETCH_SIZE, last_read: int | None = 0) -> DataFrame:
    """(batch, n, lo, hi): the pages of ``size`` rows in key order.

    Rows are range-partitioned by key, numbered inside each partition, and moved on by
    the counts of the partitions before; no task sorts all rows.
    """
    size = size or FETCH_SIZE
    keys = (df if last_read is None else df.where(F.col(key) > last_read)).select(F.col(key).alias("k")).where("k is not null")
    # Bounds of the ranges come from the keys' quantiles, so they don't change between the two uses below.
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    marks = keys.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    part = F.lit(0)
    for m in sorted(set(marks or [])):
        part = part + (F.col("k") > m).cast("int")
    parted = keys.withColumn("part", part)
    counts = parted.groupBy("part").agg(F.count("*").alias("rows"))
    before = counts.withColumn("offset", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    number = F.row_number().over(Window.partitionBy("part").orderBy("k")).cast("bigint") - 1
    placed = parted.withColumn("r", number).join(F.broadcast(before.select("part", "offset")), "part")  # a row a partition
    return placed.groupBy(F.floor((F.col("r") + F.col("offset")) / F.lit(size)).cast("bigint").alias("batch")).agg(
        F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")
    )
