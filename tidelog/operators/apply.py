"""Applying change records to a table: the net effect of a batch, in one shuffle on the key.

Records of a key are merged in order: a delete ends what came before it; later
records set the columns they carry. All of this is a ``max_by`` per column
over the records after the key's last delete, which combines before the shuffle.
The merged changes then meet the target in a full outer join on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KNOWN = ("create", "snapshot", "update", "delete")


class ApplyError(ValueError):
    pass


def without_key(keys: list[str]) -> Column:
    """Some part of the record's key is missing, or its table has none."""
    out = F.lit(not keys)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def rejected(recs: DataFrame, keys: list[str]) -> DataFrame:
    """(operation, n): updates and deletes without a key, and unknown operations; any of them fails the whole batch."""
    no_key = without_key(keys)
    bad = ~F.coalesce(F.col("operation").isin(*KNOWN), F.lit(False)) | (F.col("operation").isin("update", "delete") & no_key)
    return recs.where(bad).groupBy("operation").agg(F.count("*").alias("n"))


def check_batch(recs: DataFrame, keys: list[str]) -> None:
    for r in rejected(recs, keys).collect():  # a row an operation
        if r["operation"] not in KNOWN:
            raise ApplyError(f'invalid operation "{r["operation"]}"')
        raise ApplyError(f"key must be provided on {r['operation']} actions")


def last_per_key(recs: DataFrame, keys: list[str], order: Column, columns: list[str]) -> DataFrame:
    """The last record of each key: its columns as they stand there."""
    return recs.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in columns])


def net_changes(recs: DataFrame, keys: list[str], columns: list[str], order: list[str], present: str | None = "present") -> DataFrame:
    """One row a key: its columns, ``set_<column>`` (some record after the last delete carries it), deleted, cleared.

    ``deleted``: the last record is a delete. ``cleared``: there was a delete, so
    what the target holds no longer counts. ``present`` names the array of
    columns that a record carries; without it every record carries all.
    """
    at = F.struct(*[F.col(c) for c in order])
    marked = recs.withColumn("at_", at).withColumn("del_", F.when(F.col("operation") == "delete", F.col("at_")))
    last_delete = marked.groupBy(*keys).agg(F.max("del_").alias("del_"))
    if present is None:
        # Every record carries all columns, so the last one says it all: no second pass.
        out = marked.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in columns], F.col("operation").alias("op_")), F.col("at_")).alias("r"), F.max("del_").isNotNull().alias("cleared"))
        gone = F.col("r.op_") == "delete"
        return out.select(*keys, *[F.col(f"r.{c}").alias(c) for c in columns], *[(~gone).alias(f"set_{c}") for c in columns], gone.alias("deleted"), "cleared")
    own = marked.drop("del_").join(last_delete, keys)
    live = own.where(F.col("del_").isNull() | (F.col("at_") >= F.col("del_")))
    carried = lambda c: (F.col("operation") != "delete") & F.array_contains(present, c)
    aggregates = []
    for c in columns:
        when = F.when(carried(c), F.col("at_"))
        aggregates += [F.max_by(F.col(c), when).alias(c), F.max(when).isNotNull().alias(f"set_{c}")]
    last = F.max_by("operation", "at_").alias("last_")
    out = live.groupBy(*keys).agg(*aggregates, last, F.max("del_").isNotNull().alias("cleared"))
    return out.withColumn("deleted", F.col("last_") == "delete").drop("last_")


def merge(target: DataFrame, net: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The target after the net changes. Columns that no record carries keep their values, unless the row was cleared."""
    n, t = net.alias("n"), target.alias("t")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"t.`{k}`") == F.col(f"n.`{k}`"))
    joined = t.join(n, same, "full_outer")
    touched = F.col("n.deleted").isNotNull()
    out = [F.coalesce(F.col(f"n.`{k}`"), F.col(f"t.`{k}`")).alias(k) for k in keys]
    for f in target.schema.fields:
        if f.name in keys:
            continue
        kept = F.when(~F.coalesce(F.col("n.cleared"), F.lit(False)), F.col(f"t.`{f.name}`"))
        value = F.when(touched & F.col(f"n.`set_{f.name}`"), F.col(f"n.`{f.name}`")).otherwise(kept) if f.name in columns else kept
        out.append(value.cast(f.dataType).alias(f.name))
    return joined.where(~F.coalesce(F.col("n.deleted"), F.lit(False))).select(*out).select(*target.columns)


def apply_changes(target: DataFrame, recs: DataFrame, keys: list[str], columns: list[str], order: list[str], present: str | None = "present", check: bool = True) -> DataFrame:
    """``target`` with a batch of flat records (keys, columns, operation, order columns[, present]) applied, in order.

    Creates, snapshots and updates upsert; deletes remove, absent rows included
    without effect; a delete followed by a create in the same batch keeps nothing of
    the old row. Without keys every record but deletes is appended, and so is a
    create or snapshot record of a keyed table whose key is null. ``order`` must tell
    any two records of a key apart: (lsn, seq), not the lsn alone.
    """
    if check:
        check_batch(recs, keys)
    if not keys:
        return append(target, recs, columns)
    loose = without_key(keys)
    merged = merge(target, net_changes(recs.where(~loose), keys, columns, order, present), keys, columns)
    return append(merged, recs.where(loose), [*keys, *columns])


def append(target: DataFrame, recs: DataFrame, columns: list[str]) -> DataFrame:
    """``target`` and a row for each record that is no delete."""
    rows = recs.where(F.col("operation") != "delete").select(*[F.col(c) for c in columns])
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def insert_if_absent(target: DataFrame, recs: DataFrame, keys: list[str]) -> DataFrame:
    """Records that carry nothing but their key: rows are added where there is none."""
    new = recs.select(*keys).distinct().join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def delete_keys(target: DataFrame, deleted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the deleted ones; an anti join, which reads no more than the keys of the right side."""
    return target.join(deleted.select(*keys), keys, "left_anti")
