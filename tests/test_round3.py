"""Round 3: steps whose time or Python memory grew with the input."""
import shutil

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F


def _peak_mb(run) -> float:
    """MB that Python and numpy held at most while ``run()`` ran."""
    import tracemalloc

    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_compare_chunk_sizes_cleans_the_corpus_once(spark, sf_small, tmp_path, monkeypatch):
    from tessera.plans import catalog

    for t in ("documents", "benchmark"):
        shutil.copy(f"{sf_small}/{t}.parquet", tmp_path)
    cleaned, clean = [], catalog._clean
    monkeypatch.setattr(catalog, "_clean", lambda *a: cleaned.append(a) or clean(*a))
    rows = catalog.REGISTRY["compare_chunk_sizes"](spark, str(tmp_path)).count()
    assert rows > 0 and len(cleaned) == 1
    catalog.REGISTRY["compare_chunk_sizes"](spark, str(tmp_path))
    assert len(cleaned) == 1  # both collections are stored


def test_vectors_hash_each_distinct_token_once_and_equal_the_plain_form(spark, sf_small, monkeypatch):
    from tessera.operators import embed as EM

    rows = [(-1, None), (-2, ""), (-3, " ..."), (-4, "Ünï 😀 x😀y x X")]
    d = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in d.select("doc_id", EM.bucket_ids("text").alias("b"), EM.hashed_embedding("text").alias("v")).collect():
        if r.b is None:
            assert r.v is None and r.doc_id == -1
            continue
        want = np.bincount(np.array(r.b, dtype=np.int64), minlength=EM.DIM).astype(np.float64)
        norm = np.sqrt(want @ want)
        assert r.v == (want / norm if norm else want).astype(np.float32).tolist()
    asked, sha = [], EM.hashlib.sha256
    monkeypatch.setattr(EM.hashlib, "sha256", lambda t: asked.append(t) or sha(t))
    EM._count_vectors(pa.array([["a", "b"] * 50, None, [], ["b", "c"]]), EM.DIM)
    assert sorted(asked) == [b"a", b"b", b"c"]


def test_fixed_windows_read_a_text_once(spark):
    from tessera.operators.chunk import fixed_chunk_col

    texts = [None, "", "a", "abc\r\n d😀e\u0085f", "x" * 9]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fixed_chunk_col("t", 3).alias("w"))
    assert "substring" not in df._jdf.queryExecution().optimizedPlan().toString()
    for r in df.collect():
        want = [(r.t or "")[i:i + 3] for i in range(0, len(r.t or ""), 3)]
        assert [(x.chunk_no, x.text) for x in r.w] == list(enumerate(want))


def test_best_match_pass_holds_a_slice_of_articles(spark):
    from types import SimpleNamespace

    from tessera.operators import match as M

    held = M.Passages([(i, [f"w{j}" for j in range(i, i + 40)]) for i in range(200)])
    none = np.zeros(200, dtype=np.int64), np.full(200, np.iinfo(np.int64).max)
    tokens = pa.array([[f"w{j}" for j in range(i % 97, i % 97 + 300)] for i in range(5000)] + [None, []])
    batch = pa.RecordBatch.from_arrays([pa.array(range(5002)), tokens], names=["did", "dtoks"])
    found = []
    peak = _peak_mb(lambda: found.extend(M._closed_pass([batch], SimpleNamespace(value=(held, *none)))))
    assert peak < 150
    best = {p: (s, d) for p, s, d in zip(*(c.to_pylist() for c in found[0].columns))}
    assert best[0] == (100, 0) and best[199] == (100, 0)
    # several slices and one give the same
    step, M.SLICE_ARTICLES = M.SLICE_ARTICLES, 7
    try:
        assert next(iter(M._closed_pass([batch], SimpleNamespace(value=(held, *none))))).equals(found[0])
    finally:
        M.SLICE_ARTICLES = step


def test_training_counts_trigrams_in_bounded_memory(monkeypatch):
    from collections import Counter

    from tessera.operators import language as L

    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeé"), 6)) for _ in range(400)]
    texts = [" ".join(rng.choice(words, 300)) for _ in range(4000)] + [None, "", "1 2"]
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y"] * 2000 + ["x"] * 3), pa.array(texts)], names=["lang", "text"])
    found = []
    L._letters()
    assert _peak_mb(lambda: found.extend(L._doc_gram_counts([batch]))) < 100
    want = Counter((lang, L.decode_gram(int(k))) for lang, t in zip(["x", "y"] * 50, texts[:100]) for k in L.gram_keys(t))
    monkeypatch.setattr(L, "HELD_GRAMS", 500)  # many counts and several frames
    got = Counter()
    for b in L._doc_gram_counts([batch.slice(0, 60), batch.slice(60, 40)]):
        for lang, gram, c in zip(*(x.to_pylist() for x in b.columns)):
            got[lang, gram] += c
    assert got == want


def test_search_copies_no_whole_block_of_scores():
    from tessera.operators import retrieve as R

    rng = np.random.default_rng(5)
    q, v = np.round(rng.normal(size=(1000, 8)), 1), np.round(rng.normal(size=(4000, 8)), 1)
    for metric, scores in (("ip", q @ v.T), ("l2", -((q[:, None] - v[None]) ** 2).sum(-1))):
        got = []
        peak = _peak_mb(lambda: got.extend(R._local_topk(np.arange(1000), q, np.arange(4000), v, 3, metric)))
        assert peak < 32 + 16  # the scores themselves are 32 MB
        found = {(int(a), int(b)) for f in got for a, b in zip(f["qid"], f["chunk_id"])}
        key = np.round(scores, R.ROUND)
        cut = np.sort(key, axis=1)[:, -3:-2]
        assert {(int(a), int(b)) for a, b in zip(*np.nonzero(key > cut + 1e-6))} <= found
        assert found <= {(int(a), int(b)) for a, b in zip(*np.nonzero(key >= cut - 1e-6))}


def test_cells_meet_without_an_object_for_each_vector():
    import pytest
    from tessera.operators import retrieve as R

    many = pa.chunked_array([pa.array([[float(i), 1.0] for i in range(5)]), pa.array([[9.0, 9.0]])])
    assert R._matrix(many).tolist() == [[float(i), 1.0] for i in range(5)] + [[9.0, 9.0]]
    with pytest.raises(ValueError):
        R._matrix(pa.chunked_array([pa.array([[1.0], [1.0, 2.0], [3.0, 4.0, 5.0]])]))
