"""The numpy kernel against plain splitting."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepool.llm import word_hash as W


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abAé  \t\n\x0b", max_size=30)), max_size=8))
def test_words_and_windows(texts):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = {}
    for part in W.column_words(pa.array(texts, pa.string())):
        mine = words[part.first_row:part.first_row + len(part.counts)]
        assert list(part.counts) == [len(w) for w in mine]
        for w, h in zip([x for row in mine for x in row], part.hashes[0]):
            assert seen.setdefault(w, h) == h
        pair, rows, at = W.window_hashes(part, 2)
        assert list(zip(rows, at)) == [(r, i) for r, w in enumerate(mine) for i in range(len(w) - 1)]
    assert len(set(map(int, seen.values()))) == len(seen)


def test_long_texts_are_hashed_alike(monkeypatch):
    texts = ["start " + "word é " * 3000 + "x" * 5000 + " end", "word é", None, "a b" * 4000]
    whole = [list(w.hashes[0]) for w in W.column_words(pa.array(texts))]
    monkeypatch.setattr(W, "BLOCK", 1 << 12)
    cut = [list(w.hashes[0]) for w in W.column_words(pa.array(texts))]
    flat = lambda parts: [int(h) for p in parts for h in p]
    a, b = flat(whole), flat(cut)
    assert len(a) == len(b)
    differ = [i for i, (x, y) in enumerate(zip(a, b)) if x != y]
    assert differ == [6001]  # only the word that is longer than a block


def test_lower():
    a, b = (next(iter(W.column_words(pa.array([t]), True))).hashes[0] for t in ("ABC É", "abc É"))
    assert np.array_equal(a, b)
