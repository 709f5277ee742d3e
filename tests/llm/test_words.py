import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from costwatch.llm.words import find_words, slices, text_bytes, word_slices

TEXT = st.lists(st.none() | st.text(alphabet="aB \t\n\x0b\x0c\r é漢#", max_size=12), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_words_are_runs_between_ascii_blanks(texts):
    words = find_words(*text_bytes(pa.array(texts, pa.string())))
    found = [
        [bytes(words.data[words.starts[k] : words.ends[k]]) for k in range(a, b)]
        for a, b in zip(words.first[:-1], words.first[1:])
    ]
    assert found == [(t or "").encode().lower().split() for t in texts]


@settings(max_examples=50, deadline=None)
@given(TEXT)
def test_hashes_depend_on_bytes_alone(texts):
    spelled = {}
    for _, _, words in word_slices(pa.array(["pad " * 3, *texts], pa.string())):
        for start, end, h in zip(words.starts, words.ends, words.hashes()):
            assert spelled.setdefault(bytes(words.data[start:end]), h) == h
    assert len(set(spelled.values())) == len(spelled)


def test_slices_cover_all_rows_and_follow_an_offset():
    column = pa.array(["aa bb", None, "c" * 50, "", "dd"], pa.string()).slice(1)
    data, offsets = text_bytes(column)
    assert list(slices(offsets, 10)) == [(0, 1), (1, 3), (3, 4)] or sum(
        b - a for a, b in slices(offsets, 10)
    ) == 4
    words = find_words(data, offsets)
    assert np.diff(words.first).tolist() == [0, 1, 0, 1]
