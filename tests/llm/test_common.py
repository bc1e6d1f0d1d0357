import re

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from emporium.llm.common import HashIndex, shingles, steps, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é_1,.\n漢😀İ", max_size=40), max_size=6))
def test_words_are_the_regular_expressions(texts):
    h, first = words(texts)
    expected = [re.findall(r"\w+", t.lower()) for t in texts]
    expected = [["".join(c for c in w) for w in ws] for ws in expected]
    names = {}
    for i, ws in enumerate(expected):
        if any(not c.isalnum() and c != "_" for w in ws for c in w):
            continue  # marks that the expression counts as part of a word
        got = h[first[i] : first[i + 1]].tolist()
        assert len(got) == len(ws)
        for a, b in zip(ws, got):
            assert names.setdefault(a, b) == b
    assert len(set(names.values())) == len(names)


def test_shingles_stay_inside_their_text():
    h, first = words(["a b c d e f", "a b c", "", "b c d e f"])
    s, begin = shingles(h, first, 5)
    assert np.diff(begin).tolist() == [2, 0, 0, 1]
    assert s[1] == s[2] != s[0]


def test_word_spans_are_code_points():
    text = "Ab 😀 çd, x"
    _, _, start, end = words([text], spans=True)
    assert [text[a:b] for a, b in zip(start, end)] == ["Ab", "çd", "x"]


def test_hash_index_finds_what_it_holds():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    index = HashIndex(keys[::2])
    found = index.find(keys)
    assert (found[::2] == np.arange(len(keys[::2]))).all() and (found[1::2] == -1).all()
    assert HashIndex(keys[:0]).find(keys[:3]).tolist() == [-1, -1, -1]


def test_steps_cover_all_rows():
    pdf = pd.DataFrame({"text": ["a" * 30, None, "b" * 5, "c" * 100, ""]})
    parts = list(steps(pdf, chars=32))
    assert len(parts) > 1
    assert pd.concat(parts)["text"].tolist() == ["a" * 30, "", "b" * 5, "c" * 100, ""]
    assert list(steps(pdf[:0])) == []
