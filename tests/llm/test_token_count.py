"""The compiled transducer against the tokenizer's own library."""

import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepool.llm import token_count as tc

from .brute import canon, docs_frame, edge_docs, empty_docs

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def machine():
    return tc.compiled(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tc.model_path(MODEL))


def same(machine, library, text, chunk=tc.CHUNK):
    assert tc.offsets(machine, text, chunk)[-1] == len(library.encode(text, num_threads=1)), text[:200]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab cdethe ing  \n\t▁éÀ日本語\U0001f600.,;{}()'\"\r/*01x\x00", max_size=80), st.integers(1, 9))
def test_odd_letters(machine, library, text, chunk):
    same(machine, library, text)
    same(machine, library, text, chunk)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(machine, library, text):
    same(machine, library, text)


def test_runs_of_pieces(machine, library):
    pick, pieces = random.Random(3), list(machine.scores)
    for _ in range(3000):
        same(machine, library, "".join(pick.choice(pieces) for _ in range(pick.randint(0, 12))), pick.choice([3, 7, tc.CHUNK]))


def test_long_runs(machine, library):
    for k in [*range(70), 1000, 5000]:
        for text in (" " * k, " " * k + "a", "x" + " " * k + "\n", "a" * k, "the" * k, "日" * k):
            same(machine, library, text)
            same(machine, library, text, 16)


def test_special_strings_are_ordinary_text(machine, library):
    for text in ("<s>hi</s>", "<unk>", "<0x0A>", "</s>", "﻿", "a▁b"):
        same(machine, library, text)


def test_transitions_are_built_again_beyond_the_bound(machine, library, monkeypatch):
    monkeypatch.setattr(tc, "KEPT", 50)
    small = tc.Transducer(machine.scores)
    for _, text, _, _ in edge_docs():
        same(small, library, (text or "")[:3000])


def test_chunk_maps_compose(machine):
    """Compositions agree however they are bracketed, chunks without a meeting place included."""
    text = " some words, and averyveryverylongwordwithoutanyspace  then \n more"
    for size in (1, 3, 8):
        maps = [machine.chunk_map(text[i:i + size]) for i in range(0, len(text), size)]
        left = maps[0]
        for m in maps[1:]:
            left = left.then(m)
        right = maps[-1]
        for m in reversed(maps[:-1]):
            right = m.then(right)
        want = machine.run(machine.start, text)
        assert left.apply(machine.start) == right.apply(machine.start) == want
        scan = tc.prefix_scan(maps, machine.start)
        assert [n for _, n in scan] == [machine.run(machine.start, text[:i])[1] for i in [*range(0, len(text), size), len(text)]]


def test_models_that_change_texts_are_refused():
    with pytest.raises(ValueError):
        tc.Transducer({" ": 0.0, "a": 0.0, "b": 0.0, "a b": -1.0})


def test_report(spark, library):
    got = tc.report(docs_frame(spark), chunk=700).collect()
    want = []
    for i, text, _, _ in edge_docs():
        n = len(library.encode(text or "", num_threads=1))
        want.append((i, len((text or "").encode()), n, n > 4096))
    assert canon(got) == canon(want)
    assert tc.report(empty_docs(spark)).count() == 0


def test_offsets_of_chunks(spark, library):
    row = next(r for r in tc.count_tokens(docs_frame(spark), chunk=10_000).collect() if r.doc_id == 10)
    assert row.offsets[0] == 0 and row.offsets == sorted(row.offsets) and row.offsets[-1] < row.n_tokens
    assert len(row.offsets) == -(-len(edge_docs()[9][1]) // 10_000)
