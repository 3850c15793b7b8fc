"""Mixing, licences, token lengths and shards on small tables with every edge case."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import batch as bt
from tessera.llm import shards, sql
from tessera.llm.lengths import length_histogram, length_quantiles, token_lengths, truncated_total
from tessera.llm.licenses import HINT, known_sentences, scan_licenses
from tessera.llm.mixing import mix_plan, mixed
from tessera.llm.tokens import encoder

SCHEMA = "doc_id long, text string, source string, size int, r string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for i in range(400):
        source = ["a", "b", "B", "é", "zz", None, ""][min(int(rng.integers(0, 12)), 6)]
        out.append((i, " ".join(["w"] * int(rng.integers(0, 60))) + "\x0b\x0cend", source, 1, "x"))
    out += [(500, None, "a", 1, "x"), (501, "", "empty", 1, "x"), (502, None, "empty", 1, "x"), (503, "one word", "tiny", 1, "x"),
            (None, "null id", "a", 1, "x"), (None, "null id", "a", 1, "x"), (7, "repeated id", "a", 1, "x"), (504, "long " * 30000, "b", 1, "x")]
    return out


def water_fill(sizes, weights, cap=3):
    """Share by weight, stop at the cap, share the excess again until none is above."""
    target, open_ = {s: 0.0 for s in sizes}, set(sizes)
    rest = float(sum(sizes.values()))
    while open_ and rest > 1e-9:
        total = sum(weights[s] for s in open_)
        add = {s: rest * weights[s] / total for s in open_}
        rest = 0.0
        for s, x in add.items():
            target[s] += x
            if target[s] >= cap * sizes[s]:
                rest += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def test_mixing_contract_and_sql(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mix_plan(docs).toPandas()
    import re
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows]
    assert sorted(got["size"]) == sorted(words)
    sizes = {}
    for (_, _, s, *_), n in zip(rows, words):
        sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = water_fill(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    for s, g in got.groupby(got.source.map(lambda x: x if isinstance(x, str) else None), dropna=False):
        s = s if isinstance(s, str) else None
        assert abs(g.target.iloc[0] - want[s]) < 1e-6 and (g.source_size == sizes[s]).all()
    assert (got.taken == got.copies * got["size"]).all() and (got.taken <= 3 * got["size"]).all()
    again = mix_plan(docs.repartition(2)).toPandas()
    key = ["doc_id", "size", "copies"]
    assert got[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source", "size", "r"])
    frame["doc_id"] = frame.doc_id.astype("Int64")
    con.register("documents", frame)
    duck = con.execute(sql.MIXING).df()
    cols = ["doc_id", "size", "source_size", "target", "copies", "taken"]
    a, b = (x[cols].astype(float).sort_values(cols).to_numpy() for x in (got, duck))
    assert np.allclose(a, b, equal_nan=True)


def test_mixed_rows_and_empty(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixed(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    total = sum(len((r.text or "").split()) for r in out.collect())
    assert 0.5 < total / sum(len((t or "").split()) for _, t, *_ in rows) < 1.5
    assert mix_plan(docs.limit(0)).count() == 0 and mixed(docs.limit(0)).count() == 0


def test_mixing_comes_near_its_targets(spark, sf_small):
    got = mix_plan(spark.read.parquet(sf_small.replace("0.001", "0.01") + "/documents.parquet")).toPandas()
    g = got.groupby("source").agg(t=("target", "first"), k=("taken", "sum"))
    assert ((g.k / g.t - 1).abs() < 0.05).all()


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def test_licences(spark):
    rows = [(1, "Words.\nReleased under the MIT License."), (2, MIT), (3, "no permission at all"), (4, None), (5, ""),
            (6, "LICENSED UNDER CC BY-NC 4.0!\nThis work is licensed under the GNU General Public License, version 3."),
            (7, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
            (8, "x " * 50000 + "\nLicensed under the Apache License, Version 2.0."), (None, "Released under the MIT License"), (1, "twice")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licenses string")
    got = [(r.doc_id, r.licenses) for r in scan_licenses(docs).collect()]
    assert got == [(1, "MIT"), (2, "MIT"), (3, ""), (4, ""), (5, ""), (6, "CC-BY-NC-4.0,GPL-3.0"), (7, ""), (8, "Apache-2.0"), (None, "MIT"), (1, "")]
    assert scan_licenses(docs.limit(0)).count() == 0
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    assert sorted(map(str, con.execute(sql.LICENSES).df().licenses)) == sorted(x for _, x in got)


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def licenses_of(spark, texts):
    return [r.licenses for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()]


def test_licence_files_with_heading_and_copyright_line(spark):
    files = [f"MIT License\n\nCopyright (c) 2020 Jane Doe\n\n{MIT}", f"ISC License\n \nCopyright (c) 2020, Jane Doe\n\t\n{ISC}",
             f"Copyright (C) 2020  Jane Doe\n\n{GPL}", f"Copyright (C) 2020  Jane Doe\r\n\r\n{GPL}".replace("\n", "\r\n"),
             "\n".join(f" * {x}" for x in f"Copyright (C) 2020  Jane Doe\n\n{GPL}".split("\n")), MIT.replace("\n", "\n\n")]
    assert licenses_of(spark, files) == ["MIT", "ISC", "GPL-3.0-or-later", "GPL-3.0-or-later", "GPL-3.0-or-later", "MIT"]


def test_licence_notices_across_breaks_and_blanks(spark):
    texts = ["Released\nunder CC0 1.0.", "released  under CC0 1.0.", "This is free and unencumbered software released into the public\ndomain.",
             "This is free and unencumbered software released into the public \t domain."]
    assert licenses_of(spark, texts) == ["CC0-1.0", "CC0-1.0", "Unlicense", "Unlicense"]
    known, _ = known_sentences()
    assert set(licenses_of(spark, [k.replace(" ", "\r\n ") for k in known if k.startswith("released under")])) == {"MIT", "Apache-2.0", "CC0-1.0"}


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """
3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_longest_licence_rule_covers_the_shorter(spark):
    head = "Copyright (c) 2020, Jane Doe\nAll rights reserved.\n\n"
    joined = " ".join(BSD.split())
    texts = [head + BSD + THIRD.format("the copyright holder"), head + BSD + THIRD.format("Example University"),
             head + BSD + THIRD.format("Example,\n   Inc. of N. Y."), head + BSD, head + BSD + THIRD.format("X") + "\nOther part:\n\n" + BSD,
             "\n".join(x.strip() for x in joined.replace(". ", ".\n").replace(": ", ":\n").split("\n")) + THIRD.format("X"),
             "Released under the MIT License.\n" + BSD + THIRD.format("X") + BSD + THIRD.format("Y")]
    assert licenses_of(spark, texts) == ["BSD-3-Clause", "BSD-3-Clause", "BSD-3-Clause", "BSD-2-Clause", "BSD-2-Clause,BSD-3-Clause",
                                         "BSD-3-Clause", "BSD-3-Clause,MIT"]
    two = [("X", ["One licence line"]), ("Y", ["One licence line"]), ("Z", ["One licence line", "Two licence lines"])]
    docs = spark.createDataFrame([(1, "One licence line. One licence line."), (2, "One licence line. Two licence lines.")], "doc_id long, text string")
    assert [r.licenses for r in scan_licenses(docs, rules=two).collect()] == ["X,Y", "Z"]


def test_every_known_sentence_has_a_hint():
    import re
    known, patterns = known_sentences()
    assert all(re.search(HINT, s) for s in known) and len(set(known)) == len(known)
    plan = patterns[3][1].strip(",").split(",")
    assert patterns[3][0] == "MIT" and len(plan) == 3


TOKENS = ["", None, "plain words here", "  two  spaces\n\nand\tlines ", "é wide space here", "\n", "a" * 3000, "it's 12 'll <|endoftext|> ###$$$ |",
          "ends with space ", " starts", "日本語 テキスト　です", "same same same same", "x\r\n\r\ny \x0b z"]


def test_cached_encoder_equals_plain():
    e = encoder()
    for _ in range(2):
        data, off = bt.as_bytes(pa_texts(TOKENS))
        ids, at = e.encode(data, off)
        assert (e.counts(data, off) == np.diff(at)).all()
        for i, t in enumerate(TOKENS):
            assert ids[at[i]:at[i + 1]].tolist() == e.plain.encode_ordinary(t or ""), t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é's   \t\n1.$", max_size=40), max_size=4))
def test_cached_encoder_property(texts):
    e = encoder()
    data, off = bt.as_bytes(pa_texts(texts))
    ids, at = e.encode(data, off)
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == e.plain.encode_ordinary(t)


def pa_texts(texts):
    import pyarrow as pa
    return pa.array(texts, pa.string())


def token_table(spark):
    rows = [(i, t, "x") for i, t in enumerate(TOKENS)] + [(None, "null id", "y"), (3, "again", "z"), (99, "word " * 9000, "w")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, slot string")


def test_length_histogram(spark):
    rows, docs = token_table(spark)
    lens = np.array([len(encoder().plain.encode_ordinary(t or "")) for _, t, _ in rows])
    hist = length_histogram(token_lengths(docs))
    got = hist.toPandas().set_index("length")
    assert sorted(got.index) == sorted(set(lens.tolist()))
    for n, r in got.iterrows():
        assert (r.docs, r.tokens) == ((lens == n).sum(), n * (lens == n).sum())
        assert (r.docs_at_least, r.tokens_at_least) == ((lens >= n).sum(), lens[lens >= n].sum())
        assert r.truncated_tokens == np.minimum(lens, n).sum() and r.tokens_all == lens.sum() and r.docs_all == len(lens)
        assert abs(r.docs_share - (lens <= n).mean()) < 1e-12
    for limit in (0, 1, 7, 5000, 10 ** 6):
        t = truncated_total(hist, limit).first()
        assert (t.truncated_tokens, t.docs_cut) == (np.minimum(lens, limit).sum(), (lens > limit).sum())
    q = {r.share: r.length for r in length_quantiles(hist, [0.1, 0.5, 1.0]).collect()}
    assert q == {s: int(np.quantile(lens, s, method="inverted_cdf")) for s in (0.1, 0.5, 1.0)}
    assert length_histogram(token_lengths(docs.limit(0))).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2 ** 31))
def test_feistel_is_a_permutation(n, key):
    seq = np.arange(n)
    slot = shards.slots_of(seq, n, key)
    assert np.array_equal(np.sort(slot), seq) and np.array_equal(shards.sequences_of(slot, n, key), seq)


@pytest.mark.parametrize("stored_as_file", [True, False])
def test_shards_round_trip(spark, tmp_path, stored_as_file):
    rows, docs = token_table(spark)
    docs = docs.repartition(3)
    if stored_as_file:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    s = shards.write_shards(docs, length=64, per_shard=16, key=9)
    got = shards.read_slots(spark, s).toPandas().sort_values("slot")
    assert got.slot.tolist() == list(range(s["sequences"]))
    seq = shards.sequences_of(got.slot.to_numpy(), s["sequences"], 9)
    flat = np.stack(got.ids.to_numpy())[np.argsort(seq)].ravel()
    index = s["index"].collect()
    want = sorted(tuple(encoder().plain.encode_ordinary(t or "")) + (50256,) for _, t, _ in rows)
    assert sorted(tuple(flat[r.sequence * 64 + r.position:][:r.n_ids].tolist()) for r in index) == want
    used = sum(r.n_ids for r in index)
    assert s["sequences"] * 64 - used < 64 * 8 and all(r.shard == r.slot // 16 for r in index)
    part = shards.read_slots(spark, s, 20, 13).toPandas().sort_values("slot")
    assert part.slot.tolist() == list(range(20, 33))
    assert all(a.tolist() == b.tolist() for a, b in zip(part.ids, got.ids[20:33]))
    r = index[0]
    import glob
    path = glob.glob(f"{s['path'].removeprefix('file:')}/shard={r.shard}/part-*")
    assert len(path) == 1
    with open(path[0], "rb") as f:
        f.seek(r.byte_offset)
        assert int.from_bytes(f.read(2), "little") == flat[r.sequence * 64 + r.position]


def test_shards_stay_and_are_read_by_path_in_another_session(spark):
    """Text ids, no path given: the shards lie outside the folder that goes with the application."""
    rows = [("b", "one two three " * 50), ("a", None), (None, "four " * 90), ("a", "five")]
    s = shards.write_shards(spark.createDataFrame(rows, "name string, text string"), id_col="name", length=16, per_shard=4)
    assert f"tables-{spark.sparkContext.applicationId}" not in s["path"]
    index = s["index"].collect()
    assert sorted(str(r.doc_id) for r in index) == ["None", "a", "a", "b"]
    assert all(r.path == f"{s['path']}/shard={r.shard}" for r in index)
    other = spark.newSession()
    found = shards.open_shards(other, s["path"])
    assert found == {k: v for k, v in s.items() if k != "index"}
    assert sorted(map(tuple, shards.read_slots(other, found).collect())) == sorted(map(tuple, shards.read_slots(spark, s).collect()))


def test_shards_of_nothing(spark):
    s = shards.write_shards(spark.createDataFrame([], "doc_id long, text string"))
    assert s["sequences"] == 0 and s["index"].count() == 0 and shards.read_slots(spark, s).count() == 0


def test_licences_equal_their_sql_on_every_branch(spark):
    """All readings, covering, holders' names of any length, spellings, identifiers and hints over other characters."""
    head = "Copyright (c) 2020, Jane Doe\nAll rights reserved.\n\n"
    mpl = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. {}. If a copy of the MPL was not\n"
           "distributed with this file, You can obtain one at the address below.")
    lgpl = ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
            "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.")
    cases = {
        head + BSD + THIRD.format("X" * 5000): "BSD-3-Clause",
        head + BSD + THIRD.format("Example,\n   Inc. of N. Y."): "BSD-3-Clause",
        head + BSD + THIRD.format("X") + BSD: "BSD-2-Clause,BSD-3-Clause",
        BSD + THIRD.format("X") + BSD + THIRD.format("Y"): "BSD-3-Clause",
        "Neither the name of the game.\nReleased under the MIT License.\n" + "word. " * 500 + "Nor the names of its players.": "MIT",
        "Neither the name of " * 3 + "it.\nReleased under CC0 1.0": "CC0-1.0",
        mpl.format("2.0"): "MPL-2.0", mpl.format("3.0"): "", mpl.format("2.0").replace("v. ", "v.\n"): "MPL-2.0",
        'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file '
        "except in compliance with the License.": "MPL-1.1",
        lgpl: "LGPL-2.1-or-later",
        lgpl.replace("library", "program").replace("Lesser", "Affero").replace("software;", "software:").replace("n; either", "n, either")
        .replace("2.1", "3"): "AGPL-3.0-or-later",
        "// SPDX-License-Identifier: MIT\nint main;": "MIT", "/* SPDX-License-Identifier: GPL-2.0 */": "GPL-2.0",
        "# SPDX-License-Identifier: GPL-2.0+": "GPL-2.0-or-later", "SPDX-License-Identifier: LGPL-2.1-only": "LGPL-2.1",
        "SPDX-License-Identifier: MIT OR Apache-2.0": "",
        "Released\n\n  under * CC0 1.0.": "CC0-1.0", "free--software; public\ndomain": "", GPL: "GPL-3.0-or-later",
        MIT: "MIT", MIT.replace("\n", "\n\n"): "MIT", "\n".join(f" * {x}" for x in GPL.split("\n")): "GPL-3.0-or-later",
        "": "", "no hint": "", "Licensed under CC BY 4.0! Licensed under CC BY 4.0!": "CC-BY-4.0"}
    rows = [(i, t) for i, t in enumerate(cases)] + [(None, None), (3, "Released under the MIT License")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licenses string")
    got = [tuple(r) for r in scan_licenses(docs).collect()]
    assert [r[3] for r in got] == [*cases.values(), "", "MIT"]
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    key = lambda r: tuple(map(str, r))
    assert sorted(con.execute(sql.LICENSES).fetchall(), key=key) == sorted(got, key=key)


def test_unended_holder_clauses_are_read_once(spark):
    text = "neither the name of " * 20000 + "\nReleased under the MIT License"
    assert licenses_of(spark, [text]) == ["MIT"]
