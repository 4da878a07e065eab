import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import textvec

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b\x0c\r\x1f 🎉", max_size=30)), max_size=8)


@settings(deadline=None, max_examples=60)
@given(texts)
def test_words_match_the_pattern(batch):
    w = textvec.words(batch)
    for i, t in enumerate(batch):
        own = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        assert w.counts[i] == len(own)
        alone = textvec.words([x for x in own]).hashes if own else []
        assert list(w.hashes[w.bounds[i] : w.bounds[i + 1]]) == list(alone)


def test_hashes_don_t_depend_on_the_place_and_differ():
    r = random.Random(0)
    words = sorted({"".join(r.choice("abcdef") for _ in range(r.randint(1, 12))) for _ in range(5000)})
    h = textvec.words([" ".join(words)]).hashes
    assert len(set(h.tolist())) == len(words)
    order = list(range(len(words)))
    r.shuffle(order)
    assert list(textvec.words([" ".join(words[i] for i in order)]).hashes) == [h[i] for i in order]


def test_words_across_and_beyond_the_span():
    long = "x" * (textvec._SPAN + 10)
    batch = ["a " * 10, long, "b " * (textvec._SPAN // 2) + "tail", long]
    w = textvec.words(batch)
    assert w.counts.tolist() == [10, 1, textvec._SPAN // 2 + 1, 1]
    assert w.hashes[10] == w.hashes[-1] == textvec.words([long]).hashes[0]
    assert w.hashes[-2] == textvec.words(["tail"]).hashes[0]


def test_lower_and_ngrams():
    w = textvec.words(["The CAT É sat", "the cat", ""], lower=True)
    assert w.hashes[0] == w.hashes[4] and w.hashes[1] == w.hashes[5]
    h, owner = textvec.ngrams(w, 2)
    assert owner.tolist() == [0, 0, 0, 1] and h[0] == h[3]
    assert len(textvec.ngrams(w, 5)[0]) == 0
    a = textvec.combine([np.array([1], dtype=np.uint64), np.array([2], dtype=np.uint64)])
    b = textvec.combine([np.array([2], dtype=np.uint64), np.array([1], dtype=np.uint64)])
    assert a[0] != b[0]
