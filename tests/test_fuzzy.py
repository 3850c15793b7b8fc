"""Token-set ratio: kernels against a naive DP, and the pruned Spark plan against brute force."""
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import fuzzy
from tessera.operators import match as M


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[-1]))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcde ", max_size=40), st.text(alphabet="abcde ", max_size=90))
def test_bit_parallel_lcs_equals_dp(a, b):
    assert fuzzy.lcs_len(a, b) == lcs_dp(a, b)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.text(max_size=60))
def test_ratio_symmetric_and_bounded(a, b):
    r = fuzzy.token_set_ratio(a, b)
    assert r == fuzzy.token_set_ratio(b, a)
    assert 0 <= r <= 100


def test_known_values():
    assert fuzzy.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert fuzzy.token_set_ratio("", "abc") == 0
    assert fuzzy.token_set_ratio("the cat", "the cat") == 100
    assert fuzzy.char_bound("aab", "abb") >= fuzzy.lcs_len("aab", "abb")


def _brute(passages, docs):
    out = {}
    for pid, ptext in passages:
        best, bid = 0, None
        for did, content, cid in docs:  # docs in source order
            s = fuzzy.token_set_ratio(ptext, content)
            if s > best:
                best, bid = s, cid
        out[pid] = (best, bid)
    return out


def test_tie_rule_and_no_match(spark):
    docs = [(1, "alpha beta gamma", 11), (2, "alpha beta gamma", 12), (3, "zzz yyy", 13)]
    passages = [(100, "alpha beta gamma"), (101, "qqqq"), (102, "")]
    P = spark.createDataFrame(passages, "example_id long, relevant_chunk string")
    D = spark.createDataFrame(docs, "row_id long, content string, id long")
    got = {r[0]: (r[1], r[2]) for r in M.best_match(P, D).collect()}
    assert got == _brute(passages, docs)
    assert got[100] == (100, 11)


def test_pruned_exact_equals_brute_force(spark):
    rnd = random.Random(7)
    vocab = ["solar", "wind", "grid", "power", "net", "zero", "energy", "storage", "hydrogen", "the", "a", "of",
             "battery", "carbon", "price", "eu", "plan", "green", "deal", "emission", "x", "yy"]
    docs = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 40))), 1000 + i) for i in range(60)]
    docs.append((60, "", 1060))
    passages = [(j, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 15)))) for j in range(25)]
    passages.append((99, "Ünïcödé qqq"))
    P = spark.createDataFrame(passages, "example_id long, relevant_chunk string")
    D = spark.createDataFrame(docs, "row_id long, content string, id long")
    got = {r[0]: (r[1], r[2]) for r in M.best_match(P, D, exact=True).collect()}
    assert got == _brute(passages, docs)


def test_no_cartesian_product_in_plan(spark):
    P = spark.createDataFrame([(1, "a b")], "example_id long, relevant_chunk string")
    D = spark.createDataFrame([(1, "a c", 5)], "row_id long, content string, id long")
    plan = M.best_match(P, D, exact=False)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan

