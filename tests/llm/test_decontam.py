"""Leak search: planted passages, scores against a plain BM25, edge cases."""

import random
from collections import Counter
from math import log1p

import pytest

from tessera.llm import decontam
from tessera.llm.decontam import B, K1, SEGMENT, decontaminate, find_leaks

SCHEMA = "doc_id long, text string, row string"


def vocabulary(n, seed):
    rng = random.Random(seed)
    return [f"w{i}" for i in range(n)], rng


@pytest.fixture(scope="module")
def items():
    words, rng = vocabulary(400, 1)
    out = []
    for i in range(60):
        q = " ".join(rng.choices(words, k=rng.randrange(8, 40)))
        a = " ".join(rng.choices(words, k=rng.randrange(2, 8)))
        out.append((i, f"{q.capitalize()}. {a}."))
    out.append((60, " ".join(rng.choices(words, k=300)) + ". long answer here."))
    return out


@pytest.fixture(scope="module")
def docs(items):
    words, rng = vocabulary(400, 2)
    rows, planted = [], set()
    for d in range(120):
        w = rng.choices(words, k=rng.randrange(0, 500))
        if d % 3 == 0:
            i, text = items[rng.randrange(len(items))]
            at = rng.randrange(len(w) + 1)
            w = w[:at] + [text.upper().replace(" ", "\n") if d % 2 else text] + w[at:]
            planted.add((d, i))
        rows.append((d, " ".join(w), "x"))
    return rows, planted


def test_all_planted_and_no_other(spark, items, docs):
    rows, planted = docs
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = find_leaks(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    left = decontaminate(d, b)
    assert left.columns == d.columns
    assert {r.doc_id for r in left.collect()} == {r[0] for r in rows} - {p[0] for p in planted}


def test_several_indexes_give_the_same(spark, items, docs, monkeypatch):
    rows, planted = docs
    monkeypatch.setattr(decontam, "INDEX_BYTES", 4000)
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame(rows, SCHEMA)
    assert len(decontam.build_indexes(b, 0.5)) > 3
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, b).collect()} == planted
    assert decontaminate(d, b).count() == len(rows) - len({p[0] for p in planted})


def test_scores_equal_plain_bm25(spark, items, docs):
    """overlap 0 returns every item whose score reaches the threshold."""
    rows, _ = docs
    import re

    def tokens(t):
        return re.findall(r"[a-z0-9]+", t.lower())

    item_words = {i: tokens(t) for i, t in items}
    df = Counter(w for t in item_words.values() for w in set(t))
    mean = sum(map(len, item_words.values())) / len(items)
    segments = [(i, w[s:s + SEGMENT]) for i, w in item_words.items() for s in range(0, len(w), SEGMENT)]
    weights = []
    for i, w in segments:
        tf = Counter(w)
        x = {t: log1p((len(items) - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(w) / mean)) for t, n in tf.items()}
        total = sum(x.values())
        weights.append((i, {t: v / total for t, v in x.items()}))
    want = {}
    for d, text, _ in rows:
        w = tokens(text)
        for s in range(0, len(w), SEGMENT):
            query = set(w[s:s + 2 * SEGMENT])
            for i, x in weights:
                score = sum(v for t, v in x.items() if t in query)
                if score >= 0.3:
                    want[d, i] = max(want.get((d, i), 0), score)
    got = find_leaks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), threshold=0.3, overlap=0.0)
    got = {(r.doc_id, r.item_id): r.score for r in got.collect()}
    assert set(got) == set(want) and len(got) > 60
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_question_and_answer_columns(spark):
    b = spark.createDataFrame([(1, "which of the planets is the largest one here", "jupiter of course")], "item_id long, q string, a string")
    docs = spark.createDataFrame([(1, "Which of the planets is the largest one here? Jupiter, of course!"),
                                  (2, "Which of the planets is the largest one here? Nobody knows that.")], "doc_id long, text string")
    got = find_leaks(docs, b.withColumnRenamed("q", "text"), threshold=0.4, answer_col="a")
    assert [(r.doc_id, r.item_id) for r in got.collect()] == [(1, 1)]


def test_edges(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    b = spark.createDataFrame([(1, text), (1, text), (2, None), (None, text), (3, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (None, text, "b"), (2, None, "c"), (3, "", "d"), (4, "x " * 20000 + text, "e")], SCHEMA)
    got = sorted(find_leaks(docs, b).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 1), (1, 1), (4, 1), (None, 1)]
    assert sorted(r.doc_id for r in decontaminate(docs, b).collect()) == [2, 3]
    none = b.limit(0)
    assert find_leaks(docs, none).count() == 0 and decontaminate(docs, none).count() == 6
    assert find_leaks(docs.limit(0), b).count() == 0 and decontaminate(docs.limit(0), b).count() == 0


def test_ids_of_any_type(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([("d-1", text), ("d-2", "nothing here"), (None, text)], "name string, text string")
    b = spark.createDataFrame([("set/1", text), ("set/2", "other words that no text of these would ever hold")], "item_id string, text string")
    got = find_leaks(docs, b, id_col="name")
    assert dict(got.dtypes)["doc_id"] == dict(got.dtypes)["item_id"] == "string"
    assert sorted((str(r.doc_id), r.item_id) for r in got.collect()) == [("None", "set/1"), ("d-1", "set/1")]
    assert find_leaks(docs, b.limit(0), id_col="name").count() == 0
    assert [r.name for r in decontaminate(docs, b).collect()] == ["d-2"]


def test_short_items_are_no_test_items(spark):
    docs = spark.createDataFrame([(1, "The end of the day"), (2, "one two three four five")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "The"), (2, "the end"), (3, "one two three four five")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in find_leaks(docs, b).collect()] == [(2, 3)]
    assert {(r.doc_id, r.item_id) for r in find_leaks(docs, b, min_words=1).collect()} == {(1, 1), (1, 2), (2, 3)}


def test_unspaced_scripts_and_typographic_marks(spark):
    item = "\u5730\u7403\u7ed5\u7740\u592a\u9633\u8f6c\u52a8\u4e00\u5468\u9700\u8981\u591a\u957f\u65f6\u95f4"
    quoted = "Which word did she call \u201cthe longest\u201d \u2014 and why\u2026"
    plain = 'which word did she call "the longest" - and why'
    other = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed\u6563\u6b65"
    docs = spark.createDataFrame([(1, other + item + "\u3002" + other), (2, other), (3, "x " * 30 + plain + " y" * 30)], "doc_id long, text string")
    b = spark.createDataFrame([(1, item), (2, quoted)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in find_leaks(docs, b).collect()) == [(1, 1), (3, 2)]
