"""Token counts by separator scan over flat token files.

A token file is nothing but little-endian identifiers, documents one after
another, each followed by the end-of-document identifier; there is no index. Blocks of
all files are searched independently with one vectorised comparison each. A
document may begin in one block and end in another: a prefix scan over the
blocks' summaries (number of separators, position of the last) stitches them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import spm
from .common import new_path, slices, written

#: Tokens in a block.
BLOCK = 1 << 20
DTYPES = {2: "<u2", 4: "<u4"}


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri("file://" + os.path.abspath(path.removeprefix("file:")))


def write_token_files(docs: DataFrame, model: bytes, eod: int, width: int = 2) -> DataFrame:
    """Encodes all whole texts into flat token files in the shared folder, one a task.

    Returns the manifest (doc_id, file, ordinal, size), a row per input row. Every
    attempt of a task writes a file of its own, and the manifest, written once,
    names those of the attempts that counted; so a lost executor costs a rerun only.
    Null and empty texts are documents without tokens.
    """
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("file string, ordinal long, size long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        e = spm.encoder_of(shared.value)
        path = f"{folder}/part-{TaskContext.get().partitionId()}-{uuid.uuid4().hex}.bin"
        store, inner = _open(path)
        store.create_dir(inner.rpartition("/")[0], recursive=True)
        ordinal, size, rows = 0, 0, []
        with store.open_output_stream(inner) as out:
            for b in batches:
                for a, z in slices(b.column(1), spm.SLICE):
                    ids, bounds = e.ids_of(b.column(1).slice(a, z - a))
                    data = np.insert(ids, bounds[1:], eod).astype(DTYPES[width])
                    out.write(data.tobytes())
                    size += len(data) * width
                rows.append((b.column(0), ordinal))
                ordinal += b.num_rows
        for ids, first in rows:  # ids only; the file's size is known now
            n = len(ids)
            yield pa.RecordBatch.from_arrays([ids, pa.array([path] * n, pa.string()), pa.array(np.arange(first, first + n)), pa.array(np.full(n, size), pa.int64())], names=schema.names)

    return written(docs.select("doc_id", "text").mapInArrow(run, schema), "token-manifest")


def files_in(spark: SparkSession, path: str) -> DataFrame:
    """(file, size) of the files of a folder, or of one file, in any store that Spark reads; names only, no contents."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("size"))


def scan_blocks(files: DataFrame, eod: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(file, block, n_tokens, ends): positions in the file of the separators in each block, from (file, size)."""
    if block < 1:
        raise ValueError("a block needs a token at least")
    tokens = F.floor(F.col("size") / F.lit(width)).cast("long")
    count = F.ceil(F.floor(F.col("size") / F.lit(width)) / F.lit(block)).cast("long")
    ranges = files.where(F.col("size") >= width).select("file", tokens.alias("all"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, every, i in zip(*[c.to_pylist() for c in b.columns], strict=True):
                n = min(block, every - i * block)
                store, inner = _open(file)
                with store.open_input_file(inner) as f:
                    data = np.frombuffer(f.read_at(n * width, i * block * width), dtype=DTYPES[width])
                if len(data) != n:
                    raise OSError(f"{file} is shorter than listed")
                ends = np.flatnonzero(data == eod).astype(np.int64) + i * block
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([i], pa.int64()), pa.array([n], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], names=["file", "block", "n_tokens", "ends"])

    return ranges.repartition("file", "block").mapInArrow(run, "file string, block long, n_tokens long, ends array<long>")


def stitch(blocks: DataFrame) -> DataFrame:
    """(file, ordinal, begin, n_tokens, ended) of each document, from ``scan_blocks``.

    ``n_tokens`` is without the separator; tokens after a file's last separator
    are a document that has not ended. Two separators in a row hold an empty document.
    """
    last = F.element_at("ends", -1)
    found = F.size("ends").cast("long")
    summary = blocks.select("file", "block", "n_tokens", found.alias("n"), F.when(F.size("ends") > 0, last).alias("last"))
    along = Window.partitionBy("file").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    upto = F.sum("n_tokens").over(along.rowsBetween(Window.unboundedPreceding, 0))
    final = F.lead("block").over(along).isNull()
    summed = summary.select(
        "file", "block", "n", "last", upto.alias("upto"), final.alias("final"),
        F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first"),
        F.coalesce(F.max("last").over(before), F.lit(-1).cast("long")).alias("open"),
    )
    # Only summaries, a row a block, meet in a file's order; the positions stay with their blocks.
    placed = blocks.select("file", "block", "ends").hint("merge").join(summed.hint("merge"), ["file", "block"])
    unended = F.col("final") & (F.coalesce("last", "open") < F.col("upto") - 1)
    stops = F.concat("ends", F.when(unended, F.array("upto")).otherwise(F.array().cast("array<long>")))
    each = placed.select("file", "first", "n", F.concat(F.array("open"), "ends").alias("starts"), F.posexplode(stops).alias("i", "stop"))
    start = F.element_at("starts", F.col("i") + 1)
    return each.select("file", (F.col("first") + F.col("i")).alias("ordinal"), (start + 1).alias("begin"), (F.col("stop") - start - 1).alias("n_tokens"), (F.col("i") < F.col("n")).alias("ended"))


def count_tokens(docs: DataFrame, model: bytes, eod: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_tokens) of every row: writes flat token files, scans them, and names the documents by the manifest."""
    manifest = write_token_files(docs, model, eod, width)
    found = stitch(written(scan_blocks(manifest.select("file", "size").distinct(), eod, width, block), "token-blocks"))
    # Both sides grow with the documents; paths compress so well that their shuffled size would pass for a small table.
    counts = found.select("file", "ordinal", "n_tokens").hint("merge")
    return manifest.select("doc_id", "file", "ordinal").hint("merge").join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
