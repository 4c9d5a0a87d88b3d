import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from subscope.llm import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB é日\t\n x\x0b", max_size=30)), max_size=8)


def spans(batch, d):
    own = slice(batch.first[d], batch.first[d + 1])
    return [batch.raw[s:e].tobytes().decode() for s, e in zip(batch.starts[own], batch.ends[own])]


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(values):
    batch = words.words_of(pa.array(values, pa.string()), lower=False)
    for d, text in enumerate(values):
        assert spans(batch, d) == WORD.findall(text or "")


@settings(max_examples=100, deadline=None)
@given(texts)
def test_equal_words_and_windows_have_equal_hashes(values):
    batch = words.words_of(pa.array(values, pa.string()))
    shown = [w for d in range(len(values)) for w in spans(batch, d)]
    assert len(set(zip(shown, batch.hashes.tolist()))) == len(set(shown)) == len(set(batch.hashes.tolist()))
    hashes, at = words.windows(batch, 2)
    pairs = [tuple(shown[i : i + 2]) for i in at]
    assert len(set(pairs)) == len(set(hashes.tolist()))
    assert len(pairs) == sum(max(0, len(spans(batch, d)) - 1) for d in range(len(values)))


def test_only_latin_capitals_are_lowered():
    batch = words.words_of(pa.array(["ABC abc ÀB"]))
    assert batch.hashes[0] == batch.hashes[1]
    assert spans(batch, 0)[2] == "Àb"


def test_spans_longer_than_a_block():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 123, size=3 * words.BLOCK + 50).astype(np.uint8)
    again = np.concatenate((raw, [32], raw, [32], raw[:-1], [33])).astype(np.uint8)
    n = len(raw)
    starts, ends = np.array([0, n + 1, 2 * n + 2]), np.array([n, 2 * n + 1, 3 * n + 2])
    a, b, c = words.span_hashes(again, starts, ends)
    assert a == b != c


def test_sliced_arrays():
    batch = words.words_of(pa.array(["zero", "one two", None, "three"]).slice(1, 3))
    assert [spans(batch, d) for d in range(3)] == [["one", "two"], [], ["three"]]
