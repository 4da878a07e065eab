"""Streams over Parquet files, run until all that is there has been read."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.apply import last_per_key
from .store import VersionedTable


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share: under spark.checkpoint.dir, or, in local mode alone, a temporary one."""
    import tempfile

    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        root = tempfile.mkdtemp(prefix="tidelog-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tidelog/{name}-{uuid.uuid4().hex}"


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, to_records: Callable[[DataFrame], DataFrame], keys: list[str], order: str) -> DataFrame:
    """The last record of each key, kept up by micro-batches in a versioned table.

    Each batch is merged with the state by ``max_by`` on the order, so batches may
    come in any division and more than once with the same result.
    """
    state = VersionedTable(spark, shared_path(spark, "state"))

    def merge(batch: DataFrame, number: int) -> None:
        if state.batch >= number:
            return
        recs = to_records(batch)
        before = state.read()
        rows = recs if before is None else before.unionByName(recs)
        state.write(last_per_key(rows, keys, F.col(order), [c for c in rows.columns if c not in keys]), number)

    query = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(path)
        .writeStream.foreachBatch(merge).option("checkpointLocation", shared_path(spark, "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return state.read()


def stream_counts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(batches, n): what the progress of a stream over ``path`` adds up to."""
    query = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(path)
        .writeStream.foreachBatch(lambda df, _: df.write.format("noop").mode("overwrite").save())
        .option("checkpointLocation", shared_path(spark, "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    seen = [p for p in query.recentProgress if p["numInputRows"]]
    return spark.createDataFrame([(len(seen), sum(p["numInputRows"] for p in seen))], "batches long, n long")
