import numpy as np
import pyarrow as pa
from awkward import corpus, words
from hypothesis import given, settings
from hypothesis import strategies as st

from statquarry.llm.arrays import (
    Rolling, as_binary, hash_slices, join_words, ranges, sliced, split_words, utf8, window_minima,
)


@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 12))
def test_window_minima_are_the_leftmost_least(values, size):
    got = window_minima(np.array(values, np.uint64), size).tolist()
    assert got == [k + int(np.argmin(values[k : k + size])) for k in range(len(values) - size + 1)]


@given(st.lists(st.one_of(st.none(), st.text(alphabet="a bé\n\t\x1f\x0b", max_size=20)), max_size=8))
def test_words_of_many_texts(texts):
    buf, offsets = utf8(pa.array(texts, pa.string()))
    found = split_words(buf, offsets)
    got = [bytes(buf[a:b]).decode() for a, b in zip(found.start, found.end)]
    assert [got[a:b] for a, b in zip(found.first[:-1], found.first[1:])] == [words(t) for t in texts]
    joined = as_binary(*join_words(buf, found.start, found.end, found.first), text=True).to_pylist()
    assert joined == [" ".join(words(t)) for t in texts]


@given(st.lists(st.binary(max_size=30), min_size=1, max_size=30))
def test_hashes_agree_exactly_for_equal_runs(runs):
    buf, offsets = utf8(pa.array(runs, pa.binary()))
    hashes = hash_slices(buf, offsets[:-1], offsets[1:]).tolist()
    assert [[a == b for b in hashes] for a in hashes] == [[a == b for b in runs] for a in runs]


@given(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 6))
def test_rolling_hashes_agree_for_equal_windows(values, size):
    spread = np.array([11400714819323198485, 7046029254386353131, 1609587929392839161], np.uint64)[values]
    got = Rolling(spread).windows(size).tolist()
    plain = [tuple(values[k : k + size]) for k in range(len(values) - size + 1)]
    assert len(set(got)) == len(set(plain)) and len(got) == len(plain)
    assert Rolling(spread).of(np.arange(len(got)), np.arange(len(got)) + size).tolist() == got


@given(st.lists(st.lists(st.booleans(), max_size=8), max_size=6))
def test_marked_runs_stay_inside_their_text(marks):
    first = np.cumsum([0, *map(len, marks)])
    lists, number = ranges(np.array(sum(marks, []), bool), first)
    covered = [[any(r["start"] <= k < r["end"] for r in rs) for k in range(len(m))] for m, rs in zip(marks, lists.to_pylist())]
    assert covered == marks and number.tolist() == [len(r) for r in lists.to_pylist()]


@settings(max_examples=20)
@given(st.integers(1, 4000))
def test_slices_hold_every_row_once(limit):
    texts = [t for _, t in corpus()]
    parts = list(sliced([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])], "text", limit))
    assert sum([p.column("text").to_pylist() for p in parts], []) == texts
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= limit for p in parts)
