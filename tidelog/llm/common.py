"""Storage and small helpers that the operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all word counts here: 0x20 and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one where that is unset, but only if all runs in this process."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        path = tempfile.mkdtemp(prefix="tidelog-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; removed when the driver ends."""
    path = f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    return path


def drop(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            drop(spark, path)
        except Exception:  # the JVM may have gone first; nothing else can be done at exit
            return


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written as Parquet to the shared folder, by the writer's options, and read again.

    Cuts the lineage: later stages read files that survive lost executors, and no
    part of the plan before them runs twice.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (f"{w}{'_' * k}" for k in range(1, len(taken) + 2)) if n.lower() not in taken) for w in wanted]


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_of(column: Column) -> Column:
    """crc32 of the value's text; a null counts as an empty text."""
    return F.crc32(F.encode(F.coalesce(column.cast("string"), F.lit("")), "UTF-8"))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside; for rows that hold packed arrays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(texts: pa.Array, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, or of one row: what a worker takes at once."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(size):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += int(n)
    if len(size):
        yield begin, len(size)
