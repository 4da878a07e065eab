import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import spm, token_scan

from .conftest import MODEL, prose


def library():
    tokenizers, sentencepiece = pytest.importorskip("public_tokenizers"), pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=tokenizers.path(MODEL))


def test_encode_and_decode_like_the_library(model):
    sp, e, r = library(), spm.Encoder(model), random.Random(5)
    texts = ["", " ", "  ", "a", " a", "▁", "▁▁ a", "hello  world\n\tfoo", "日本語🎉é", "\x00ab", "</s><s> <0x41><unk>", " " * 60 + "x", "a" * 3000, "ab" * 900, "\r\n", "é", "the" * 400]
    texts += ["".join(r.choice("abcde  thein▁ é日🎉\n.,") for _ in range(r.randint(1, 60))) for _ in range(1500)]
    r.shuffle(texts)
    every, bounds = e.ids_of(pa.array([*texts, None, *texts]))
    digests = e.digests(every, bounds)
    assert len(bounds) == 2 * len(texts) + 2 and bounds[len(texts)] == bounds[len(texts) + 1]
    for i, t in enumerate(texts):
        ids = sp.encode(t)
        assert e.encode(t) == ids, t
        assert e.decode(ids) == sp.decode(ids), t
        for j in (i, i + len(texts) + 1):
            assert every[bounds[j] : bounds[j + 1]].tolist() == ids, t
        assert digests[0][i] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[1][i] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert e.ids_of(pa.array([], pa.string()))[0].tolist() == [] and e.ids_of(pa.array([None, ""], pa.string()))[1].tolist() == [0, 0, 0]


def test_segments_are_what_merging_gives(model):
    e, r = spm.Encoder(model), random.Random(6)
    for _ in range(400):
        t = "".join(r.choice("▁thesaoinr") for _ in range(r.randint(1, 14)))
        assert e._segments(t) == e._merged(t)


def test_pairs_merge_back(model):
    e, r = spm.Encoder(model), random.Random(8)
    tokens = sorted(t for t in e.reachable if len(t) < 6)
    for _ in range(3000):
        a, b = r.choice(tokens), r.choice(tokens)
        assert e._compatible(a, b) == (e._merged(a + b) == [a, b]), (a, b)


def test_small_tables_give_the_same(model, monkeypatch):
    text = pa.array([prose(i, 200) for i in range(20)])
    want = spm.encoder_of(model).ids_of(text)
    for name, value in (("PAIRS", 300), ("TOGETHER", 100), ("LONGEST", 3)):
        monkeypatch.setattr(spm, name, value)
        got = spm.Encoder(model).ids_of(text)
        assert all((x == y).all() for x, y in zip(got, want, strict=True))


def test_documents(docs, none, model):
    sp = library()
    got = spm.encode_documents(docs, model, with_ids=True)
    assert got.columns.count("n_tokens") == 1 and "text" not in got.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got.collect():
        assert r.ids == sp.encode(texts[r.doc_id] or "") and r.n_tokens == len(r.ids)
    assert spm.encode_documents(none, model).count() == 0


def _brute(data, eod):
    out, begin = [], 0
    for i, x in enumerate(data):
        if x == eod:
            out.append((begin, i - begin, True))
            begin = i + 1
    return out + ([(begin, len(data) - begin, False)] if begin < len(data) else [])


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_scan_stitches_blocks(spark, tmp_path, block):
    r = np.random.default_rng(block)
    streams = {
        "a": r.choice([0, 1, 1, 5], 60), "none": np.full(20, 5), "only": np.zeros(9), "tail": np.array([5, 0, 5, 5]), "one": np.array([0]), "x": np.array([5]), "empty": np.array([]),
    }
    for name, x in streams.items():
        (tmp_path / f"{name}.bin").write_bytes(x.astype("<u2").tobytes())
    files = token_scan.files_in(spark, str(tmp_path))
    got = {}
    for x in token_scan.stitch(token_scan.scan_blocks(files, 0, 2, block)).orderBy("file", "ordinal").collect():
        got.setdefault(x.file.rsplit("/", 1)[1][:-4], []).append((x.begin, x.n_tokens, x.ended))
    for name, x in streams.items():
        assert got.get(name, []) == _brute(x.tolist(), 0), name


def test_counts(docs, none, model):
    sp = library()
    texts = docs.select("doc_id", "text").collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted([(r.doc_id, len(sp.encode(r.text or ""))) for r in texts], key=key)
    got = sorted([tuple(r) for r in token_scan.count_tokens(docs, model, 2, block=64).collect()], key=key)
    assert got == want
    assert token_scan.count_tokens(none, model, 2).count() == 0
