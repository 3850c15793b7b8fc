"""Recursive splitter invariants and fixed windows."""
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import chunk as E

TEXTS = st.text(alphabet=st.sampled_from(list("abc de\n\n.")), max_size=400)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([5, 17, 50, 200]))
def test_splitter_invariants(text, size):
    chunks = E.split_text(text, size, 0)
    for c in chunks:
        assert len(c) <= size
        assert c == c.strip() and c
    squash = lambda s: re.sub(r"\s+", "", s)
    assert squash("".join(chunks)) == squash(text)


def test_splitter_overlap_and_examples():
    text = "a" * 10 + " " + "b" * 10 + " " + "c" * 10
    assert E.split_text(text, 12, 0) == ["a" * 10, "b" * 10, "c" * 10]
    assert E.split_text("", 10) == []
    assert E.split_text("   \n\n  ", 10) == []
    assert E.split_text("x" * 25, 10) == ["x" * 10, "x" * 10, "x" * 5]
    out = E.split_text("one two three four five six", 10, 4)
    assert all(len(c) <= 10 for c in out)


def test_fixed_chunk_windows(spark):
    df = spark.createDataFrame([("abcdefghij",), ("",), ("abc",)], "t string")
    rows = df.select(E.fixed_chunk_col("t", 4, 1).alias("w")).collect()
    assert [x["text"] for x in rows[0]["w"]] == ["abcd", "defg", "ghij"]
    assert rows[1]["w"] == []
    assert [x["text"] for x in rows[2]["w"]] == ["abc"]
