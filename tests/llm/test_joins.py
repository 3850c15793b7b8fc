"""N-gram join, embedding join and components against brute force, with hot groups cut into small blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import ngramjoin, vecdup
from tessera.llm.graph import connected_components
from tessera.llm.ngramjoin import keep_one_of_each_group, least_matches, link_report, ngram_jaccard_join
from tessera.llm.vecdup import embedding_near_dups, plan_tables


def grams(t, k=5):
    w = (t or "").lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(n)]


def near_copies(seed, base, copies, edits):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(5000)}" for _ in range(base)]
    out = [" ".join(words)]
    for _ in range(copies):
        v = list(words)
        for _ in range(edits):
            v[rng.randrange(len(v))] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(v))
    return out


@pytest.fixture(scope="module")
def texts():
    rows = near_copies(1, 300, 40, 3) + near_copies(2, 80, 5, 1) + ["same words here once more"] * 30
    rows += ["One two", "one TWO", "", None, "   ", "q " * 5000, "q " * 5001]
    rng = random.Random(3)
    return rows + [" ".join(f"r{rng.randrange(10 ** 5)}" for _ in range(60)) for _ in range(40)]


SCHEMA = "doc_id long, text string, node string, row int"


def test_ngram_join_equals_brute_force(spark, texts, monkeypatch):
    monkeypatch.setattr(ngramjoin, "BLOCK_ROWS", 8)
    monkeypatch.setattr(ngramjoin, "BUCKET_ROWS", 8)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: r for r in link_report(ngram_jaccard_join(docs)).collect()}
    sets = [grams(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j]
             and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    degree, root = [0] * len(texts), components(len(texts), links)
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    assert sorted(got) == list(range(len(texts)))
    for i in range(len(texts)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (degree[i], root[i], root[i] == i), texts[i]
    first = texts.index("same words here once more")
    assert got[first + 7].class_id == first and got[first + 7].n_links == 29


def test_one_of_each_group_stays_with_all_columns(spark, texts):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    rows += [(None, texts[0], "n", 2), (5000, texts[0], "n", 3), (5000, texts[0], "n", 3), (None, "alone " * 9, "n", 4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = keep_one_of_each_group(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 1 and 5000 not in ids and 0 in ids
    sets = {i: grams(t) for i, t in enumerate(texts)}
    kept_ids = [i for i in ids if i is not None]
    assert all(not (sets[a] and sets[a] == sets[b]) for a in kept_ids for b in kept_ids if a < b)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert link_report(ngram_jaccard_join(docs)).count() == 0
    vecs = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_near_dups(vecs).count() == 0
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    least = least_matches(0.8, 1e-6)
    assert least == sorted(least) and least[-1] < 0.8 * ngramjoin.HASHES
    for step, m in enumerate(least):
        n = (step + 1) * ngramjoin.STEP
        lost = sum(math.comb(n, k) * 0.8 ** k * 0.2 ** (n - k) for k in range(m))
        assert lost < 1e-5


@pytest.mark.parametrize("broadcast_rows", [200_000, 5, 1])
def test_components_of_chains_and_stars(spark, broadcast_rows):
    """Also with so few rows to broadcast that only the heaviest nodes' minima are."""
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (300, 299)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), broadcast_rows=broadcast_rows).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(60)} == {100}
    assert got[300] == got[299] == 299 and len(got) == 41 + 60 + 2


def vectors(seed=0, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, dim))
    rows = []
    for c in range(12):
        for _ in range(25 if c == 0 else 4):
            rows.append((base[c] + rng.standard_normal(dim) * 0.12 * np.sqrt(c + 1)).tolist())
    rows += [rows[0]] * 6 + rng.standard_normal((60, dim)).tolist()
    table = [(i, v, i % 2) for i, v in enumerate(rows)]
    n = len(table)
    bad = [None, [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [], [None] + [1.0] * (dim - 1)]
    table += [(n + i, v, 0) for i, v in enumerate(bad)] + [(n + 10, rows[0], None), (n + 11, rows[0][:4], 0), (None, rows[0], 0)]
    return table


@pytest.mark.parametrize("blocks", [4, 512])
def test_embeddings_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(vecdup, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(vecdup, "BUCKET_ROWS", blocks)
    table = vectors()
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                           T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType())])
    df = spark.createDataFrame([(*r, "x") for r in table], schema)

    def usable(r):
        return r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    def cosine(a, b):
        return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))

    links = [(i, j) for i in range(len(table)) for j in range(i) if usable(table[i]) and usable(table[j])
             and table[i][2] == table[j][2] and len(table[i][1]) == len(table[j][1]) and cosine(table[i][1], table[j][1]) >= 0.93]
    assert len(links) > 100
    root, degree = components(len(table), links), [0] * len(table)
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    got = {r.vec_id: r for r in embedding_near_dups(df).collect()}
    for i, (v, _, _) in enumerate(table):
        members = [table[k][0] for k in range(len(table)) if root[k] == root[i] and table[k][0] is not None]
        want = min(members) if members else None
        assert (got[v].n_links, got[v].component_id) == (degree[i], want)
        assert got[v].kept == (v == want)


def test_table_plan_grows_with_the_data():
    few, many = plan_tables(1000, 0.93, 1e-6), plan_tables(10 ** 8, 0.93, 1e-6)
    assert few[0] < many[0] and few[1] < many[1]
    agree = 1 - math.acos(0.93) / math.pi
    assert all((1 - agree ** b) ** t <= 1e-6 for b, t in (few, many))


def test_no_cross_join_in_the_plans(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    plan = link_report(ngram_jaccard_join(docs)).select(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
