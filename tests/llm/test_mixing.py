import hashlib
import random
import re

import pytest

from tidelog.llm import mixing

SHAPE = "doc_id long, text string, source string, size string, target int, copies int"


def brute(rows, weights=(5, 2, 1), most=3, seed=9):
    docs = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    names = sorted({s for _, s, _ in docs if s is not None}, key=lambda s: s.encode()) + ([None] if any(s is None for _, s, _ in docs) else [])
    size = {n: sum(z for _, s, z in docs if s == n) for n in names}
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total = sum(size.values())
    target, left, open_ = {}, float(total), list(names)
    while open_:
        level = left / sum(weight[n] for n in open_)
        above = [n for n in open_ if weight[n] * level > most * size[n]]
        if not above:
            target |= {n: weight[n] * level for n in open_}
            break
        for n in above:
            target[n] = float(most * size[n])
            left -= target[n]
            open_.remove(n)
    h = lambda i: int(hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:15], 16)
    entries = []
    for r, n in enumerate(names):
        own, reached = sorted((h(i), i is not None, i or 0, z) for i, s, z in docs if s == n), 0
        for hh, _, i, z in own:
            reached += z
            for p in range(most):
                if z and target[n] > p * size[n]:
                    entries.append(((p * size[n] + reached) / target[n], r, hh, i, p, n, z))
    taken, used = {}, 0
    for e in sorted(entries):
        used += e[6]
        if used > total:
            break
        taken[(e[3], e[5])] = taken.get((e[3], e[5]), 0) + e[6]
    return target, size, taken


def _text(r, n):
    return " ".join("w" * r.randint(1, 3) for _ in range(n))


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    r = random.Random(seed)
    names = ["b", "a", "é", "z", "B", None][: 3 + seed]
    rows = [(i, _text(r, r.choice([0, 1, 5, 30])) if r.random() > 0.05 else None, names[0] if r.random() < 0.4 else r.choice(names)) for i in range(300)]
    df = spark.createDataFrame([(*x, None, None, None) for x in rows], SHAPE).repartition(4)
    target, size, taken = brute(rows)
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(rows)
    for g in got:
        assert abs(g.target - target[g.source]) < 1e-6 * (1 + g.target) and g.source_size == size[g.source]
        assert g.taken == taken.get((g.doc_id, g.source), 0) and g.taken == g.copies * g.size <= 3 * g.size
    assert sum(g.taken for g in got) <= sum(size.values())
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted((g.doc_id, g.taken) for g in again) == sorted((g.doc_id, g.taken) for g in got)


def test_edges(spark, docs, none):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == docs.count() and all(g.taken == 0 for g in got if g.size == 0)
    assert mixing.mix_sources(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    blank = docs.where("text is null or trim(text) = ''")
    assert all(g.taken == 0 for g in mixing.mix_sources(blank).collect()) and mixing.mixed_documents(blank).count() == 0


def test_documents_come_as_often_as_taken(spark, docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = {}
    for g in mixing.mix_sources(docs).collect():
        want[g.doc_id] = want.get(g.doc_id, 0) + g.copies
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_clashing_columns(docs):
    clash = docs.withColumn("copies_", docs["doc_id"]).withColumn("ID_", docs["text"]).withColumn("hash_", docs["lang"]).withColumn("bin", docs["lang"])
    mixed = mixing.mixed_documents(clash)
    assert mixed.columns == clash.columns and mixed.count() == mixing.mixed_documents(docs).count()


def test_no_python_in_the_plan(docs):
    plan = mixing.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
