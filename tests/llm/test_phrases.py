"""Phrase mining against a plain count of all word runs."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import phrases as P


def plain(rows, least=100, share=100, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        rows = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                 for k in range(1, len(p)))
            longer = (q for q, c in counts.items() if len(q) > len(p) and c >= least and 100 * c >= share * a)
            if not any(q[i:i + len(p)] == p for q in longer for i in range(len(q) - len(p) + 1)):
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        rows.sort()
        out += [(lang, i, ph.decode(), -a, l, r, n[lang], -s) for i, (s, a, ph, l, r) in enumerate(rows[:top], 1)]
    return sorted(out)


def corpus(seed=3):
    rnd = random.Random(seed)
    word = ["a", "b", "c", "Dé", "e f", "g", "h", "ÄÖ"]
    rows = []
    for i in range(120):
        t = []
        for _ in range(rnd.randint(0, 60)):
            t.append(rnd.choice(["a b c Dé g", "New York City", "x" + str(rnd.randint(0, 50)), rnd.choice(word), "h h h"]))
            t.append(rnd.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b"]))
        rows.append((rnd.choice(["en", "en", "de", None]), "".join(t)))
    return rows + [("fr", None), ("fr", ""), (None, "A B a b A B " * 40), ("en", "one two " * 20000)]


def frame(spark, rows):
    return spark.createDataFrame([(x, t, 1, 2) for x, t in rows], "lang string, text string, n int, p int").repartition(3)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least,share,budget,rows", [(5, 100, 500_000, 200_000), (3, 100, 4, 200_000), (3, 80, 1, 3), (100, 100, 9, 200_000)])
def test_equals_plain_counts(spark, least, share, budget, rows):
    """Also with budgets so small that prefixes of every length are prolonged, and with nothing broadcast."""
    data = corpus()
    out = got(P.collocations(frame(spark, data), least=least, share=share, budget=budget, broadcast_rows=rows))
    assert out == plain(data, least, share) and out


def test_top_and_ties(spark):
    data = [("en", "p q. r s. t u. v w x")] * 4
    out = got(P.collocations(frame(spark, data), least=2, top=3))
    assert out == plain(data, 2, top=3) and [r[2] for r in out] == ["p q", "r s", "t u"]


def test_nothing_frequent_and_no_rows(spark):
    assert got(P.collocations(frame(spark, [("en", "a b c"), (None, None)]))) == []
    assert got(P.collocations(spark.createDataFrame([], "lang string, text string"))) == []


def test_products_beyond_64_bits(spark):
    a, n = 10**15, 9 * 10**15
    df = spark.createDataFrame([(a, n, 3 * 10**15 + 1, 7 * 10**14 + 3)], "a long, n long, l long, r long")
    d = {c: f"CAST({c} AS DECIMAL(16,0))" for c in df.columns}
    got = df.selectExpr(f"(CAST(1000 AS DECIMAL(4,0)) * {d['a']} * {d['n']}) div ({d['l']} * {d['r']}) AS s").first()["s"]
    assert got == 1000 * a * n // ((3 * 10**15 + 1) * (7 * 10**14 + 3))


def test_equal_keys_of_unequal_words_are_seen(monkeypatch):
    """Words whose keys collide inside a slice are handed on apart, so that the check of unique keys finds them."""
    import pyarrow as pa
    monkeypatch.setattr(P.bt, "mix", lambda x: x & np.uint64(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["ab cd ab ef cd gh ab"])], ["lang", "text"])
    seen = Counter()
    for b in P._counted_words(0)(iter([batch])):
        for r in b.to_pylist():
            seen[r["word"]] += r["n"]
    assert seen == {"ab": 3, "cd": 2, "ef": 1, "gh": 1}


def test_bitmap(spark):
    keys = [0, 1, 7, 8, P.BITS - 1, P.BITS + 5, -1, -P.BITS, 123456789012345]
    bits = P._bitmap(spark.createDataFrame([(k,) for k in keys], "key long"), P.F.col("key"))
    every = np.array(keys, dtype=np.int64).view(np.uint64)
    assert P._has(bits, every).all()
    assert np.unpackbits(bits).sum() == len({k % P.BITS for k in keys})
    a, b = spark.createDataFrame([(-5, 2**62 + 3)], "k1 long, k2 long").select(P._pair_column("k1", "k2")).first()[0], \
        P._pair_hash(np.array([-5]).view(np.uint64), np.array([2**62 + 3]).view(np.uint64)).view(np.int64)[0]
    assert a == b
