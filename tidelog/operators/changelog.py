"""Raw change rows to change records.

A change row has lsn, seq (order inside one lsn), kind (insert, update, delete and
others, which are ignored), relation, and the old and new images as structs of
the table's columns; ``unchanged`` lists columns whose value the feed left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.position import cdc_position
from .asof import as_of

#: Change kinds and the operations they become; all other kinds of messages give no record.
OPERATIONS = {"insert": "create", "update": "update", "delete": "delete"}
ENVELOPE = ["collection", "operation", "lsn", "position", "key", "before", "after", "present"]


class ChangeError(ValueError):
    pass


def operation(kind: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, o in OPERATIONS.items():
        out = F.when(kind == k, o).otherwise(out)
    return out


def records(changes: DataFrame, key: str, full_before: bool = True) -> DataFrame:
    """Records from (lsn, kind, relation, old, new[, unchanged]).

    The key comes from the new image, for deletes from the old one. Updates and
    deletes have the before image that the feed carries, whole or key only; an absent
    one is null. Without ``full_before`` it is what a table's default identity
    gives, whatever the feed holds: none for updates, the key for deletes.
    """
    names = changes.schema["new"].dataType.names
    op = operation(F.col("kind"))
    source = F.when(F.col("kind") == "delete", F.col("old")).otherwise(F.col("new"))
    key_only = F.struct(*[(F.col(f"old.`{n}`") if n == key else F.lit(None).cast(changes.schema["new"].dataType[n].dataType)).alias(n) for n in names])
    old = F.col("old") if full_before else F.when(F.col("kind") == "delete", key_only)
    unchanged = F.col("unchanged") if "unchanged" in changes.columns else F.array().cast("array<string>")
    everything = F.array(*[F.lit(n) for n in names])
    return changes.where(op.isNotNull()).select(
        F.col("relation").alias("collection"),
        op.alias("operation"),
        "lsn",
        cdc_position(F.col("lsn")).alias("position"),
        F.struct(source[key].alias(key)).alias("key"),
        F.when(F.col("kind") != "insert", old).alias("before"),
        F.when(F.col("kind") != "delete", F.col("new")).alias("after"),
        F.when(F.col("kind") != "delete", F.array_except(everything, F.coalesce(unchanged, F.array().cast("array<string>")))).alias("present"),
    )


def after_lsn(df: DataFrame, start: int, lsn: str = "lsn") -> DataFrame:
    """Changes beyond a position; those at or before it have been seen."""
    return df.where(F.col(lsn) > start)


def before_image(changes: DataFrame, key: str, order: str, value: str) -> Column:
    """The key's value in the change before, for feeds that don't carry it."""
    return F.lag(value).over(Window.partitionBy(key).orderBy(order))


def micro_batches(changes: DataFrame, ts: str, order: str, size: int, window: str = "hour") -> DataFrame:
    """(flush_window, batch, n, lo, hi): changes flushed at each tick of time, and at ``size`` changes in between."""
    tick = F.date_trunc(window, ts).cast(changes.schema[ts].dataType).alias("flush_window")
    ranked = changes.select(tick, F.col(order).alias("o"))
    rn = F.row_number().over(Window.partitionBy("flush_window").orderBy("o"))
    batch = F.floor((rn - 1) / F.lit(max(1, size))).cast("bigint")
    return ranked.select("flush_window", batch.alias("batch"), "o").groupBy("flush_window", "batch").agg(F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi"))


def check_commits(messages: DataFrame) -> DataFrame:
    """(lsn, final_lsn): commits whose position is not the one that their transaction announced. Empty if all is well.

    Messages: (seq, kind, lsn) with kind begin (lsn: the announced position) or commit.
    A commit's begin is the last one before it.
    """
    marks = messages.where(F.col("kind").isin("begin", "commit"))
    seen = as_of(marks, [], F.col("kind") == "begin", F.col("lsn"), "final_lsn")
    return seen.where((F.col("kind") == "commit") & ~F.col("lsn").eqNullSafe(F.col("final_lsn"))).select("lsn", "final_lsn")


def split_key_changes(recs: DataFrame) -> DataFrame:
    """Updates that change the key, as a delete of the old key and a create of the new one."""
    key = recs.schema["key"].dataType.names
    old = F.struct(*[F.col(f"before.`{k}`").alias(k) for k in key])
    moved = (F.col("operation") == "update") & F.col("before").isNotNull() & ~old.eqNullSafe(F.col("key"))
    both = F.when(moved, F.array(F.lit("delete"), F.lit("create"))).otherwise(F.array("operation"))
    rows = recs.withColumn("old_", old).withColumn("moved_", moved).select("*", F.posexplode(both).alias("step", "op_"))
    gone = F.col("moved_") & (F.col("op_") == "delete")
    return rows.select(
        "collection", F.col("op_").alias("operation"), "lsn", "position",
        F.when(gone, F.col("old_")).otherwise(F.col("key")).alias("key"),
        F.when(F.col("moved_") & (F.col("op_") == "create"), None).otherwise(F.col("before")).alias("before"),
        F.when(~gone, F.col("after")).alias("after"), F.when(~gone, F.col("present")).alias("present"), "step",
    )
