"""Pipelines: start, stop, resume, progress, removal."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.apply import ApplyError, apply_changes
from ..operators.routing import routed
from ..sources.hybrid import HybridSource
from ..sources.options import SinkOptions, SourceOptions, option
from .store import VersionedSet


@dataclass
class Target:
    """A table that changes are applied to: its schema and key columns (none: rows are appended)."""

    schema: T.StructType
    keys: list[str]


@dataclass
class TableView:
    """One of a pipeline's tables, as its last whole batch left it."""

    tables: VersionedSet
    name: str

    def read(self) -> DataFrame | None:
        return self.tables.read(self.name)


@dataclass
class Pipeline:
    """A hybrid source applied to versioned tables under ``path``, all tables of a batch at once.

    ``route`` says which target a record goes to: a name, or an expression between {{
    and }} over collection, operation, lsn, seq, position, key and payload.
    """

    spark: SparkSession
    path: str
    options: dict[str, str]
    targets: dict[str, Target]
    trigger: str | None = None
    route: str = SinkOptions.table
    query: StreamingQuery | None = field(default=None, init=False)

    @property
    def tables(self) -> VersionedSet:
        return VersionedSet(self.spark, f"{self.path}/tables")

    def table(self, name: str) -> TableView:
        return TableView(self.tables, name)

    def start(self, trigger: str | None = None) -> StreamingQuery:
        """Goes on where the checkpoint says, on ticks of ``trigger``; where none is given, of the option batch.delay."""
        SinkOptions(url="spark://local", table=self.route).validate()
        self.spark.dataSource.register(HybridSource)
        stream = self.spark.readStream.format("tidelog")
        for k, v in self.options.items():
            stream = stream.option(k, v)
        writer = stream.load().writeStream.foreachBatch(self._apply).option("checkpointLocation", f"{self.path}/checkpoint")
        tick = trigger or self.trigger or option(self.options, "batch.delay") or SourceOptions.batch_delay
        self.query = writer.trigger(processingTime=tick).start()
        return self.query

    def run_available(self, timeout: float | None = None) -> None:
        """Applies all that is there now, then stops."""
        query = self.start("0 seconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
            if timeout:
                query.awaitTermination(int(timeout))

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()
            self.query = None

    def _apply(self, batch: DataFrame, number: int) -> None:
        tables = self.tables
        if tables.batch >= number:
            return  # applied before a restart
        batch = routed(batch, self.route).persist()
        try:
            names = [r["target_table"] for r in batch.select("target_table").distinct().collect()]  # a row a table
            unknown = sorted(str(n) for n in names if n not in self.targets)
            if unknown:
                raise ApplyError(f"no target for table {', '.join(unknown)}")
            after = {n: self._after(tables, n, batch.where(F.col("target_table") == n)) for n in names}
            missing = [n for n in self.targets if n not in after and n not in tables.versions()]
            after |= {n: self.spark.createDataFrame([], self.targets[n].schema) for n in missing}
            if after:
                tables.write(after, number)
        finally:
            batch.unpersist()

    def _after(self, tables: VersionedSet, name: str, own: DataFrame) -> DataFrame:
        target = self.targets[name]
        before = tables.read(name)
        if before is None:
            before = self.spark.createDataFrame([], target.schema)
        columns = [f.name for f in target.schema.fields]
        parsed = F.from_json(F.coalesce("payload", F.lit("{}")), target.schema)
        flat = own.withColumn("p_", parsed).select(
            "operation", F.coalesce("lsn", F.lit(0).cast("bigint")).alias("order_"), F.coalesce("seq", F.lit(0).cast("bigint")).alias("seq_"),
            *[(F.coalesce(F.col("p_")[c], F.col("key").cast(target.schema[c].dataType)) if [c] == target.keys else F.col("p_")[c]).alias(c) for c in columns],
            F.coalesce(F.json_object_keys("payload"), F.array().cast("array<string>")).alias("present"),
        )
        rest = [c for c in columns if c not in target.keys]
        return apply_changes(before, flat, target.keys, rest if target.keys else columns, ["order_", "seq_"])

    def progress(self) -> list[dict]:
        """Rows and offsets of the batches so far."""
        if self.query is None:
            return []
        return [{"batch": p["batchId"], "rows": p["numInputRows"], "end": p["sources"][0]["endOffset"]} for p in self.query.recentProgress]

    def drop(self, cleanup: bool | None = None) -> None:
        """Stops, and removes the checkpoint and the tables unless ``cleanup``, by default the option logrepl.autoCleanup, is off."""
        self.stop()
        if cleanup is None:
            cleanup = (option(self.options, "logrepl.autoCleanup") or "true").lower() in ("true", "1", "t")
        if cleanup:
            VersionedSet(self.spark, f"{self.path}/checkpoint").drop()
            self.tables.drop()


def evolve(versions: list[DataFrame]) -> DataFrame:
    """One frame of several schema versions: columns that a version lacks are null."""
    out = versions[0]
    for v in versions[1:]:
        out = out.unionByName(v, allowMissingColumns=True)
    return out
