"""A training corpus from raw documents: four of the llm operators in a row.

Each stage works on all rows its predecessor kept and returns the columns of
``documents``; the last returns the encoded texts. Extra columns, of whatever name,
pass through all stages; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import dedup, mixing, quality, spm
from tidelog.llm.common import table, written

#: The stages' models and samples have no equal in SQL; tests compare them with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, held-out ones included.

    Null and empty texts are scored like any other, and so are rows that repeat or
    have no id; a score equal to the threshold is accepted. Without any labelled
    row all texts have the same score.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).where("predicted = 1").select(*[f"`{c}`" for c in docs.columns])


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the least (doc_id, text hash).

    Texts without words, null ones among them, all stay, but rows that repeat with the
    same id are one. Rows without an id count as the last of their class.
    """
    return dedup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as it takes them, at most three times.

    Null texts and texts without words are never taken; a null source is a source of
    its own. Ties in virtual time go by source, hash, id and pass.
    """
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them.

    Null and empty texts have no ids; rows that repeat are encoded each.
    """
    import public_tokenizers

    return spm.encode_documents(docs, spm.load(public_tokenizers.path("piece_bpe_32k.model")), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i}")
    return docs
