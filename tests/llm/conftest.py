import random

import pytest
from pyspark.sql import types as T

MODEL = "piece_bpe_32k.model"

#: Documents with columns whose names clash with what the operators add.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()), T.StructField("size", T.StringType()), T.StructField("n_tokens", T.StringType()),
    ]
)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 8))) for _ in range(n))


def rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), prose(2, 80), "", None, "  \t\n", "two words", "two words", prose(3, 30_000), "é" * 50 + " 日本語 🎉", "\x00 nul", prose(4, 6)]
    out = [(i, t, "en", f"s{i % 3}", None, "x", "y", "z") for i, t in enumerate(texts)]
    out[3] = (3, texts[3], None, None, None, None, None, None)
    return [*out, out[3], (None, prose(5, 20), None, None, None, None, None, None), (99, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def model():
    tokenizers = pytest.importorskip("public_tokenizers")
    from tidelog.llm import spm

    return spm.load(tokenizers.path(MODEL))
