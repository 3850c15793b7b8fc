"""Steps whose time or memory has to follow the input: searches, cleaning, encoding, mapping."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import retrieve as R
from tessera.plans import catalog, rag


def _vectors(ids, mat):
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(list(mat), type=pa.list_(pa.float32()))], names=["cid", "cv"])


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_a_task_returns_one_top_k_however_many_blocks_it_has(metric):
    rng = np.random.default_rng(3)
    mat = rng.integers(-2, 3, (3000, 4)).astype(np.float32)  # many ties
    ids = [f"c{i:05d}" for i in rng.permutation(3000)]
    q, k = rng.integers(-2, 3, (7, 4)).astype(np.float64), 3
    schema = pa.schema([("qid", pa.int64()), ("chunk_id", pa.string()), ("score", pa.float64()), ("l2_sq", pa.float64())])
    batches = [_vectors(ids[i:i + 1000], mat[i:i + 1000]) for i in range(0, 3000, 1000)]
    got = pa.Table.from_batches(R._task_topk(batches, np.arange(7), q, k, metric, 128, schema), schema).to_pandas()
    assert len(got) <= 8 * k * 7
    got["key"] = got.l2_sq if metric == "l2" else -got.score
    for i, rows in got.groupby("qid"):
        far = ((mat - q[i]) ** 2).sum(axis=1) if metric == "l2" else -(mat @ q[i])
        want = [c for _, c in sorted(zip(far, ids))][:k]
        assert rows.sort_values(["key", "chunk_id"]).chunk_id.tolist()[:k] == want


def test_equal_search_texts_are_encoded_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def encoder(texts):
        seen.add(len(texts))
        return np.array([[len(t) % 5 + 1.0, t.count("a") + 1.0] for t in texts])

    q = spark.createDataFrame([(i, "What grows? Solar cells. A map.") for i in range(6)], "example_id long, question string")
    chunks = spark.createDataFrame([(f"{i}-0", i, f"text {i}") for i in range(5)], "chunk_id string, origin_doc_id long, page_content string")
    vectors = spark.createDataFrame([(f"{i}-0", [float(i), 1.0]) for i in range(5)], "chunk_id string, embedding array<float>")
    rows = rag.retrieve(q, vectors, chunks, "multi_query", k=2, encoder=encoder).collect()
    assert {r.example_id for r in rows} == set(range(6)) and len({tuple(r)[1:] for r in rows}) * 6 == len(rows)
    assert seen.value <= 8  # of 6 questions with 17 search texts each


def test_run_evaluation_cleans_once(spark, sf_small, monkeypatch):
    calls, plain = [], catalog._clean
    monkeypatch.setattr(catalog, "_clean", lambda *a: calls.append(1) or plain(*a))
    monkeypatch.setattr(catalog.coll, "collection_is_empty", lambda *a: True)
    assert catalog.REGISTRY["run_evaluation"](spark, sf_small).count() == 40
    assert len(calls) == 1


def test_detection_sorts_no_text(spark, monkeypatch):
    """Same languages as by the sorted trigrams, which the dense table replaces."""
    from tessera.operators import language as L

    rows = [("the cat sat on the mat", "en"), ("le chat est là, très loin", "fr"), ("die Katze läuft über Straßen", "de")]
    profile = L.train_profile(spark.createDataFrame(rows, "text string, lang string"))
    texts = ["", None, "İstanbul the ΑΣ", "中文", "t", "a1b\x85c é", "le  chat -- 9 là", "x" * 40 + " Straßen", "the cat " * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    fast = L.detect_language(df, "id", "text", profile).orderBy("id").collect()
    table = L.GramTable.of(np.array(sorted(L.encode_gram(r["gram"]) for r in profile.weights.collect()), dtype=np.int64))
    assert table is not None
    monkeypatch.setattr(L.GramTable, "MOST", 0)
    assert L.GramTable.of(np.array([L.encode_gram("the")])) is None
    assert L.detect_language(df, "id", "text", profile).orderBy("id").collect() == fast
    keys = np.array(sorted(L.encode_gram(r["gram"]) for r in profile.weights.collect()), dtype=np.int64)
    for t in filter(None, texts):
        at = table.places(t)
        every = L.gram_keys(t)
        assert sorted(keys[at[at > 0] - 1]) == sorted(every[np.isin(every, keys)])


def test_a_strip_looks_at_the_ends_only(spark):
    from tessera.functions import text as tx

    texts = [" \x1c\x85a  b　\n", "᠎a​", "", "   ", "a\n", "\x1f  "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    assert [r.s for r in df.select("id", tx.py_strip("t").alias("s")).orderBy("id").collect()] == [t.strip() for t in texts]
    assert "regexp" not in df.select(tx.py_strip("t"))._jdf.queryExecution().optimizedPlan().toString()


def test_articles_are_split_in_arrow_slices(spark, monkeypatch):
    from tessera.functions.text import fuzz_normalize, token_set
    from tessera.operators import match as M

    texts = ["b a  b, Ä é ß_ß", "", "  ", "a", "zé zz ΑΣ Σ İx", "c" * 50 + " d", "10 2 1"]
    df = spark.createDataFrame(list(enumerate(texts)), "did long, c string")
    want = [(r.did, r.t) for r in df.select("did", token_set(fuzz_normalize("c")).alias("t")).orderBy("did").collect()]
    monkeypatch.setattr(M, "SPLIT_BYTES", 20)
    batch = df.select("did", fuzz_normalize("c").alias("text")).orderBy("did").toArrow().to_batches()
    got = [(d, sorted(t)) for b in M._tokenised(batch) for d, t in zip(b["did"].to_pylist(), b["dtoks"].to_pylist())]
    assert got == want and len(list(M._tokenised(batch))) > 1


def test_vectors_come_from_texts_split_in_arrow(spark, monkeypatch):
    from tessera.operators import embed as EM

    texts = ["b a  b, Ä é", "", None, " ,, ", "ΑΣ Σ İx_y 10", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in df.select("id", EM.bucket_ids("t").alias("b"), EM.hashed_embedding("t").alias("v")).collect():
        if r.b is None:
            assert r.v is None
            continue
        n = np.bincount(r.b, minlength=EM.DIM).astype(float)
        assert np.allclose(r.v, n / max(1, np.sqrt((n * n).sum())), atol=1e-6)
    monkeypatch.setattr(EM, "_HASHES", {})
    EM._count_vectors(pa.array([["a", "b"]]), EM.DIM)
    EM._count_vectors(pa.array([["b", "", "a"]]), EM.DIM)
    assert set(EM._HASHES) == {b"a", b"b"}


def test_latin_texts_are_trained_without_sorting(monkeypatch):
    from collections import Counter

    from tessera.operators import language as L

    texts = ["The cat, the CAT", "", None, "Über STRASSE ÿ ª÷×", "a", "x1y\nZ", "İx Σ", "ab " * 500]
    want = Counter((lang, L.decode_gram(int(k))) for lang, t in zip("xy" * 4, texts) for k in L.gram_keys(t or ""))
    for held in (1 << 20, 64):  # all at once, and many windows and counts
        monkeypatch.setattr(L, "HELD_GRAMS", held)
        got = Counter()
        for b in L._doc_gram_counts([pa.RecordBatch.from_arrays([pa.array(list("xy" * 4)), pa.array(texts)], names=["lang", "text"])]):
            for lang, gram, c in zip(*(x.to_pylist() for x in b.columns)):
                got[lang, gram] += c
        assert got == want
    keys = L._latin_counts(L._latin()[0].join([b"\0", b"\0"]))[0]
    assert len(keys) == len(set(keys.tolist())) and sorted(keys) == keys.tolist()
    monkeypatch.setattr(L, "gram_keys", lambda t: pytest.fail(f"sorted: {t}"))
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "x"]), pa.array(["Über", "cat"])], names=["lang", "text"])
    assert sum(b.num_rows for b in L._doc_gram_counts([batch])) == 7


def test_latin_texts_are_detected_by_bytes():
    from tessera.operators import language as L

    keys = np.array(sorted({int(k) for t in ("the cat Über ÿ", "straße là ΣΑ") for k in L.gram_keys(t)}), dtype=np.int64)
    table, plain = L.GramTable.of(keys), L.GramTable.of(keys)
    plain.latin = None
    for t in ("", "T", "The CAT ÜBER Ÿ ß", "là\x85×là", "ΣΑΣ the", "İ the", "".join(map(chr, range(256)))):
        assert table.places(t).tolist() == plain.places(t).tolist()
    assert table.latin is not None


def test_windows_are_made_once(spark):
    """Spark's filter on the size of an exploded array made every window a second time."""
    from tessera.operators.chunk import fixed_chunk

    texts = ["abcdefg", "", None, "é\nxyz", "abc"]
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row_id long, id long, content string")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("url", "domain", "title", "author", "date")])
    for overlap in (0, 1):
        chunks = fixed_chunk(df, 3, overlap)
        plan = chunks._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == (overlap == 0) and plan.count("sequence(") == (overlap == 1)
        got = sorted((r.chunk_id, r.origin_doc_id, r.chunk_no, r.page_content) for r in chunks.collect())
        want = [(i, n, t[at:at + 3]) for i, t in enumerate(texts) if t
                for n, at in enumerate(range(0, max(1, len(t) - overlap), 3 - overlap))]
        assert got == sorted((f"{i}-{n}", i, n, w) for i, n, w in want)


def test_ascii_texts_are_looked_up_by_bytes(spark):
    from tessera.functions import text as tx
    from tessera.operators import embed as EM
    from tessera.operators import match as M

    texts = ["".join(map(chr, range(128))), "", None, "A_b C-9", "É Über_x", "İstanbul ΣΑΣ", "a\x85b", "﻿Q", "  Two  words "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for also, normal in (("", tx.spaced_tokens("t")), ("_", tx.fuzz_normalize("t"))):
        rows = df.select("id", tx.unless_ascii("t", normal).alias("sent"), normal.alias("want")).orderBy("id").toArrow()
        got = tx.translated(rows["sent"].combine_chunks(), tx.byte_table(also))
        assert [t.split() for t in got.to_pylist()] == [(t or "").split() for t in rows["want"].to_pylist()]
        part = tx.translated(rows["sent"].combine_chunks().slice(3, 2), tx.byte_table(also))
        assert part.to_pylist() == got.to_pylist()[3:5]
    ascii_only = rows["sent"].to_pylist()
    assert ascii_only[3] == "A_b C-9" and ascii_only[2] is None
    bad = spark.sql("SELECT cast(x'41ff42' AS string) AS t")  # not UTF-8: Spark's expressions see it, not the table
    assert bad.select(tx.unless_ascii("t", tx.spaced_tokens("t")).alias("s")).first().s == "a b"
    rows = pa.array(["ab cd", None, "x" * 30, "", "y"])
    EM_BYTES, EM.SLICE_BYTES = EM.SLICE_BYTES, 6
    try:
        assert [s.to_pylist() for s in EM._slices(rows)] == [["ab cd", None], ["x" * 30], ["", "y"]]
    finally:
        EM.SLICE_BYTES = EM_BYTES
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["Beta alpha, BETA_x"])], names=["did", "text"])
    assert sorted(next(M._tokenised([batch]))["dtoks"][0].as_py()) == ["alpha", "beta", "beta_x"]
