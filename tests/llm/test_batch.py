import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import batch as bt

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n,", max_size=30)), max_size=8)


def split(t):
    return [w for w in __import__("re").split("[ \t-\r]+", t or "") if w]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_shingles_identify_equal_runs(texts):
    data, off = bt.as_bytes(pa.array(texts, pa.string()))
    h, woff = bt.words(data, off)
    sh, soff = bt.shingles(h, woff, 3)
    seen, grams = {}, {}
    for i, t in enumerate(texts):
        w = split(t)
        assert woff[i + 1] - woff[i] == len(w)
        for x, y in zip(w, h[woff[i]:woff[i + 1]]):
            assert seen.setdefault(x, y) == y
        want = [tuple(w[k:k + 3]) for k in range(len(w) - 2)] or ([tuple(w)] if w else [])
        got = sh[soff[i]:soff[i + 1]]
        assert len(got) == len(want)
        for x, y in zip(want, got):
            assert grams.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen) and len(set(grams.values())) == len(grams)
    k1, k2 = bt.sequence_keys(h, woff)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (split(a) == split(b)) == ((k1[i], k2[i]) == (k1[j], k2[j]))


def test_slices_and_long_words():
    texts = ["x" * (bt._WINDOW + 5) + " b", "", "a b", "x" * (bt._WINDOW + 5)]
    data, off = bt.as_bytes(pa.array(texts))
    assert [r for r in bt.slices(off, 10)] == [(0, 1), (1, 3), (3, 4)]
    h, woff = bt.words(data, off)
    assert np.diff(woff).tolist() == [2, 0, 2, 1]
    assert h[0] == h[4] and h[1] == h[3]


def test_sliced_and_empty_arrays():
    arr = pa.array(["a b", None, "c"])[1:]
    data, off = bt.as_bytes(arr)
    assert off.tolist() == [0, 0, 1] and bytes(data) == b"c"
    data, off = bt.as_bytes(pa.array([], pa.string()))
    assert len(bt.words(data, off)[0]) == 0
