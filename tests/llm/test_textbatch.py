import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import textbatch as tb

TEXT = st.text(alphabet=st.sampled_from(list("ab Bé\n\t\x0b\xa0.ñ")), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 40))
def test_words_and_windows_equal_plain_python(texts, size):
    at = 0
    for s in tb.slices(pa.array(texts, pa.string()), size):
        assert s.first == at
        w = tb.words(s)
        h, row, _ = tb.ngrams(w, 3, short=True)
        for r in range(s.rows):
            expected = re.findall(r"[^\x20\x09-\x0D]+", texts[at + r] or "")
            found = [s.data[a:b].tobytes().decode() for a, b in zip(w.start[w.row == r], w.end[w.row == r], strict=True)]
            assert found == expected
            windows = [tuple(expected[i : i + 3]) for i in range(len(expected) - 2)] or ([tuple(expected)] if expected else [])
            assert len(set(h[row == r].tolist())) == len(set(windows)) and (row == r).sum() == len(windows)
        at += s.rows
    assert at == len(texts)


def test_hash_does_not_depend_on_position_even_over_the_table_wrap():
    long = "x" * (tb._TABLE - 3) + " hello " + "y" * 50 + " hello"
    (s,) = tb.slices(pa.array([long]))
    w = tb.words(s)
    (t,) = tb.slices(pa.array(["hello"]))
    assert w.hash[1] == w.hash[3] == tb.words(t).hash[0]


def test_lower_changes_only_ascii():
    (s,) = tb.slices(pa.array(["AÉz"]))
    assert s.lower().text(0) == "aÉz"
    assert np.array_equal(s.offsets, s.lower().offsets)
