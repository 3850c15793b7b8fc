"""Source divergence against the formula over all kept terms."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import divergence as D


def plain(rows, min_docs=3, top=200):
    df, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        count[lang or "", source or ""].update(words)
        df[lang or ""].update(set(words))
    out = []
    for (lang, source), mine in count.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        whole = Counter()
        for (x, _), c in count.items():
            if x == lang:
                whole.update(c)

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p, q = share(mine), share(whole)
        pairs = [(sum((p[t] - x[t])**2 // x[t] for t in kept), s) for (y, s), c in count.items()
                 if y == lang and s != source for x in [share(c)]]
        terms = [((p[t] - q[t])**2 // q[t], t) for t in kept if mine[t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, v, i) for i, (v, item) in enumerate(items[:most], 1)]
    return sorted(out)


def corpus(seed, n=150):
    rnd = random.Random(seed)
    rows = [("en", "solo", None), ("en", "digits", "1 2 3"), ("xx", "one", "alone"), ("xx", "two", "apart"), (None, None, "A a É"),
            ("", None, "a a a É"), (None, "s", "a é É"), ("en", "s1", "word " * 30000), ("zz", "only", "t t"), ("zz", "only", "t"), ("zz", "only", "t u")]
    for _ in range(n):
        t = " ".join(rnd.choice(["Alpha", "beta", "don't", "x" + "y" * rnd.randint(0, 12), "münze", "ÄÖ", "c3po", "_", "漢字", "ſ"])
                     for _ in range(rnd.randint(0, 30)))
        rows.append((rnd.choice(["en", "en", "de"]), f"s{min(rnd.randint(0, 6), rnd.randint(0, 6))}", t))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 1.0) for r in rows], "lang string, source string, text string, n int, p double").repartition(3)


def got(df):
    assert dict(df.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,min_docs,top,block,small", [(1, 3, 200, 400_000, 200_000), (2, 3, 4, 10, 2), (3, 10**6, 200, 10, 200_000), (4, 1, 200, 50, 3)])
def test_equals_the_formula(spark, monkeypatch, seed, min_docs, top, block, small):
    rows = corpus(seed)
    out = got(D.source_divergence(frame(spark, rows), min_docs=min_docs, top=top, block_rows=block, broadcast_rows=small))
    assert out == plain(rows, min_docs, top)


def test_no_rows(spark):
    assert got(D.source_divergence(spark.createDataFrame([], "lang string, source string, text string"))) == []


def test_unequal_terms_with_equal_keys(monkeypatch):
    """Keys of three bits: the byte comparison sets the terms apart."""
    mix, seen = D.bt.mix, Counter()
    monkeypatch.setattr("tessera.llm.words.bt.hash_spans", lambda data, s, e: (e - s).astype(np.uint64))
    text = "ab cd ab ef cd gh ab"
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array(["s", "s"]), pa.array([text, "ab ij"])], ["l", "s", "t"])
    for b in D._count_terms(iter([batch])):
        for r in b.to_pylist():
            seen[r["term"]] += r["n"]
            assert (r["term"], r["docs"]) in {("ab", 2), ("cd", 1), ("ef", 1), ("gh", 1), ("ij", 1)}
    assert seen == {"ab": 4, "cd": 2, "ef": 1, "gh": 1, "ij": 1} and D.bt.mix is mix


def test_corrections_in_steps_and_large_values(monkeypatch):
    """Pairs worked on a few at a time; values near 10**18 are added exactly."""
    monkeypatch.setattr(D, "STEP", 5)
    rnd = random.Random(5)
    rows = [(s, t, rnd.choice([1, 2, 10**9, 999_999_937]), 1 + i) for i, s in enumerate("abcd") for t in "uvwxyz" if rnd.random() < 0.8]
    table = pa.table({"lang": ["l"] * len(rows), "source": [r[0] for r in rows], "term": [r[1] for r in rows],
                      "p": pa.array([r[2] for r in rows], pa.int64()), "p0": pa.array([r[3] for r in rows], pa.int64())})
    f = lambda p, q: (p - q)**2 // q
    want, out = Counter(), Counter()
    for s, t, p, p0 in rows:
        for s2, t2, q, q0 in rows:
            if t == t2 and s != s2:
                want[s, s2] += f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    for r in D._corrections(table).to_pylist():
        out[r["a"], r["b"]] += (r["high"] << 30) + r["low"]
    assert out == want
