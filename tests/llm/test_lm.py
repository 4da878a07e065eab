import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import ngram_lm as lm

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def brute(rows):
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 10:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, [(i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t in rows]


def test_base_score_is_exact(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n, want = brute(rows)
    got = lm.score_corpus(docs).collect()
    assert {r.train_tokens for r in got} == {n}
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    for g, w in zip(sorted([(r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got], key=key), sorted(want, key=key), strict=True):
        assert g[:3] == w[:3] and math.isclose(g[3], w[3], rel_tol=1e-9)
    assert lm.score_corpus(none).count() == 0


def test_rare_tokens_by_shuffle(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 8)  # nearly all tokens are looked up
    _, want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = lm.score_corpus(docs).collect()
    assert sorted(round(r.base_score, 6) for r in got) == sorted(round(w[3], 6) for w in want)


def test_filter_never_misses_and_levels_grow(spark):
    text = " ".join(f"w{i % 37}" for i in range(4000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    model, _ = lm.train(df)
    h, bounds = lm.tokens([text])
    for n in (1, 2):
        x = lm.ngram_hashes(h, bounds, n)
        values, counts = np.unique(x, return_counts=True)
        assert (model.filter.levels(values) >= lm.level(counts)).all()
    unseen = np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64)
    assert (model.filter.levels(unseen) > 0).mean() < 0.02


def test_model_beats_base_and_is_bounded(spark):
    r = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    chain = {w: r.choice(words, 3).tolist() for w in words}

    def text(n):
        out = [str(r.choice(words))]
        for _ in range(n):
            out.append(str(r.choice(chain[out[-1]])))
        return " ".join(out)

    df = spark.createDataFrame([(i, text(60)) for i in range(150)], "doc_id long, text string")
    for order in (2, 3):
        s = lm.score_corpus(df, order=order).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
        assert s[0] > s[1] * 0.75  # logarithms: less negative
    small, _ = lm.train(df, max_bits=1 << 14)
    assert 8 * len(small.filter.bits) <= 1 << 14


def test_score_equals_brute_force_and_sums_to_one_at_most(spark, monkeypatch):
    monkeypatch.setattr(lm, "BITS_A_KEY", 64)  # hardly any false positive
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{int(x)}" for x in r.zipf(1.4, 40) % 50)) for i in range(80)] + [(200, ""), (201, None), (202, "w1 never seen w2")]
    trained = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    one, two, begin = Counter(), Counter(), len(trained)
    for _, t in trained:
        own = tokens(t)
        one.update(own)
        two.update(zip(["^", *own[:-1]], own, strict=True))
    floor = sum(one.values()) + 0.1 * (len(one) + 1)
    least = lambda c: 2 ** (c.bit_length() - 1) if c else 0
    most = lambda c: 2 ** c.bit_length() - 1
    context = lambda a: begin if a == "^" else one[a]
    p = lambda a, w: (least(two[a, w]) + lm.K * (least(one[w]) + 0.1) / floor) / (most(context(a)) + lm.K)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score_corpus(df).collect()}
    for i, t in rows:
        own = tokens(t)
        assert math.isclose(got[i], sum(math.log10(p(a, w)) for a, w in zip(["^", *own[:-1]], own, strict=True)), rel_tol=1e-9)
    for a in ["^", "never", *(w for w in one if w)]:
        assert sum(p(a, w) for w in [*one, "never"]) <= 1


def test_stored_filter_leaves_nothing_out(spark, docs):
    # A filter too large to broadcast gives the scores of a broadcast one, for tokens seen once as well.
    for order in (2, 3):
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score)
        want, got = (sorted(lm.score_corpus(docs, order=order, max_bits=b).collect(), key=key) for b in (lm.MAX_BITS, 1 << 12))
        assert got == want
    model, _ = lm.train(docs, max_bits=1 << 12)
    assert model.stored and 8 * len(model.filter.bits) <= 1 << 12
