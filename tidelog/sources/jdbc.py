"""Snapshots from, and changes to, a database over JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import quote_ident, single_key


def read_table(spark: SparkSession, url: str, table: str, key: str, last_read: int | None, end: int, partitions: int = 8, fetch_size: int = 50_000, **options: str) -> DataFrame:
    """A bounded scan: the key range is pushed to the database and split into ``partitions`` connections.

    A database snapshot id can be bound with ``sessionInitStatement``; without one
    partitions may see different states, and the change feed makes up for it.
    """
    low = last_read if last_read is not None else -(2**63)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", str(fetch_size))
    for k, v in options.items():
        reader = reader.option(k, v)
    if last_read is not None and end > low:
        reader = reader.option("partitionColumn", key).option("lowerBound", str(low + 1)).option("upperBound", str(end)).option("numPartitions", str(max(1, min(partitions, end - low))))
    df = reader.load()
    return df.where((F.col(key) > low) & (F.col(key) <= end))


def greatest_key(spark: SparkSession, url: str, table: str, key: str, **options: str) -> int:
    query = f"SELECT COALESCE(MAX({key}), 0) AS K FROM {table}"
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in options.items():
        reader = reader.option(k, v)
    return int(reader.load().first()[0])


def primary_key(spark: SparkSession, url: str, table: str, driver: str | None = None) -> str:
    """The single key column, from the driver's metadata."""
    jvm = spark.sparkContext._jvm
    if driver:
        jvm.java.lang.Class.forName(driver)
    connection = jvm.java.sql.DriverManager.getConnection(url)
    try:
        found, rows = [], connection.getMetaData().getPrimaryKeys(None, None, table)
        while rows.next():
            found.append(rows.getString("COLUMN_NAME"))
    finally:
        connection.close()
    return single_key(table, found)


def merge_statements(table: str, staging: str, keys: list[str], columns: list[str]) -> list[str]:
    """MERGEs of a staged batch: each column where a change carries it (``set_<column>``), then deletes and inserts."""
    q = quote_ident
    begin = f"MERGE INTO {q(table)} t USING {q(staging)} s ON " + " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    rest = [c for c in columns if c not in keys]
    every = [*keys, *rest]
    update = [f"{begin} WHEN MATCHED AND s.{q('deleted_')} = 0 AND s.{q(f'set_{c}')} = 1 THEN UPDATE SET {q(c)} = s.{q(c)}" for c in rest]
    return [
        *update,
        f"{begin} WHEN MATCHED AND s.{q('deleted_')} = 1 THEN DELETE "
        f"WHEN NOT MATCHED AND s.{q('deleted_')} = 0 THEN INSERT ({', '.join(map(q, every))}) VALUES ({', '.join(f's.{q(c)}' for c in every)})",
    ]


def apply_batch(net: DataFrame, url: str, table: str, keys: list[str], columns: list[str], driver: str | None = None, batch_size: int = 10_000) -> None:
    """Net changes (one row a key, as of ``net_changes``) to a database table: staged in parallel, merged in one transaction.

    Columns that no change carries (``set_<column>`` is false) keep what the table
    holds, or become null where the row was deleted in between (``cleared``).
    Without those columns every change carries all. The staging table's name is new.
    """
    spark = net.sparkSession
    staging = f"{table}_{uuid.uuid4().hex[:12]}".upper()
    rest = [c for c in columns if c not in keys]
    cleared = F.coalesce(F.col("cleared"), F.lit(False)) if "cleared" in net.columns else F.lit(False)
    given = {c: F.coalesce(F.col(f"set_{c}"), F.lit(False)) if f"set_{c}" in net.columns else F.lit(True) for c in rest}
    values = [F.when(given[c], F.col(c)).alias(c) for c in rest]
    marks = [(given[c] | cleared).cast("int").alias(f"set_{c}") for c in rest]
    staged = net.select(*keys, *values, *marks, F.col("deleted").cast("int").alias("deleted_"))
    writer = staged.write.format("jdbc").option("url", url).option("dbtable", quote_ident(staging)).option("batchsize", str(batch_size))
    if driver:
        writer = writer.option("driver", driver)
    writer.mode("errorifexists").save()
    jvm = spark.sparkContext._jvm
    connection = jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for merge in merge_statements(table, staging, keys, columns):
            statement.executeUpdate(merge)
        statement.executeUpdate(f"DROP TABLE {quote_ident(staging)}")
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
