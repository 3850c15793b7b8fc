"""Licence scan by sentence rules (operator 8): DataFrame functions only, no shuffle.

A text is cut into sentences, each is normalised (lower case, letters and digits) and mapped to its number among the
known licence sentences; the ordered numbers of a text are matched against ordered rules. A rule applies when its
numbers stand next to each other, in order, among the recognised sentences; rules are tried from the longest down, and a
match covers its sentences for the shorter ones. Texts are read three times: with each line
break as a sentence end (statements on a line of their own), with lines without letters and digits as sentence ends
(wrapped licence texts below a heading or copyright line) and with all line breaks as spaces (blank lines in a sentence).
The holder's own name in the third BSD clause (of any length) is put before the clause as sentences of its own, so
nothing between "neither the name of" and a far "nor the names of" is lost.
``SPDX-License-Identifier`` lines count with one identifier; expressions of several (``AND``, ``OR``, ``WITH``) are no
known sentence. Texts without any word that all known sentences share are skipped before the cutting.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, in the order in which the rule needs them.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["Released under the MIT License"]),
    ("MIT", ["Licensed under the MIT License"]),
    ("MIT", ["This project is licensed under the MIT License"]),
    ("MIT", [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"]),
    ("Apache-2.0", ["Licensed under the Apache License, Version 2.0"]),
    ("Apache-2.0", ["Released under the Apache License, Version 2.0"]),
    ("Apache-2.0", [
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "you may not use this file except in compliance with the License"]),
    ("Apache-2.0", [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License"]),
    ("GPL-2.0", ["This work is licensed under the GNU General Public License, version 2"]),
    ("GPL-3.0", ["This work is licensed under the GNU General Public License, version 3"]),
    ("GPL-3.0-or-later", [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"]),
    ("GPL-2.0-or-later", [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version"]),
    ("LGPL-2.1-or-later", [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
        "version"]),
    ("LGPL-3.0-or-later", [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version"]),
    ("AGPL-3.0-or-later", [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version"]),
    ("LGPL-3.0", ["This work is licensed under the GNU Lesser General Public License, version 3"]),
    ("AGPL-3.0", ["This work is licensed under the GNU Affero General Public License, version 3"]),
    ("BSD-2-Clause", [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution"]),
    ("BSD-3-Clause", [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission"]),
    ("ISC", [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies"]),
    ("MPL-2.0", ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"]),
    ("MPL-1.1", [
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")",
        "you may not use this file except in compliance with the License"]),
    ("Unlicense", ["This is free and unencumbered software released into the public domain"]),
    ("CC0-1.0", ["Released under CC0 1.0"]),
    ("CC-BY-4.0", ["Licensed under CC BY 4.0"]),
    ("CC-BY-SA-4.0", ["Licensed under CC BY-SA 4.0"]),
    ("CC-BY-NC-4.0", ["Licensed under CC BY-NC 4.0"]),
    ("CC-BY-4.0", ["This work is licensed under a Creative Commons Attribution 4.0 International License"]),
    ("CC-BY-SA-4.0", ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"]),
    ("CC-BY-NC-4.0", ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"]),
]
# Public short identifiers that a source file's licence line may name.
SPDX = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
        "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-1.1",
        "MPL-2.0", "Unlicense", "Zlib"]
#: The older spelling ``GPL-2.0`` of an identifier ``GPL-2.0-only`` is the same licence; rules name it without the ending.
RULES += [(name.removesuffix("-only"), [f"SPDX-License-Identifier {spelt}"])
          for name in SPDX for spelt in dict.fromkeys([name, name.removesuffix("-only")])]
#: Every known sentence holds one of these (checked by a test).
HINT = "licen|free software|warrant|redistribut|copyright|permission|public domain|released under"
#: The same hints for texts that are not normalised yet: any run of other characters may stand between two words.
RAW_HINT = HINT.replace(" ", "[^a-z0-9]+")
SENTENCE_END = r"[.!?:;]+([ \t\n\f\r]+|\z)|\n+"
PARAGRAPH_END = r"[.!?:;]+([ \t\n\f\r]+|\z)|\n[^a-z0-9\n]*\n"
#: What is written otherwise before the cutting, so that no full stop or colon stands in a name, and "+" is not lost.
SPELLINGS = [(r"\bv\.[ \t\n\f\r]+([0-9])", "v {0}"),
             (r"\b(spdx-license-identifier):?[ \t]+([a-z0-9.-]*[0-9])\+", "{0} {1}-or-later"),
             (r"\b(spdx-license-identifier):[ \t]+", "{0} ")]
#: The holder's own name in the third BSD clause (full stops and line breaks included) makes room for the known sentence's.
HOLDER_START = r"\bneither[^a-z0-9]+the[^a-z0-9]+name[^a-z0-9]+of[^a-z0-9]"
HOLDER_END = r"[^a-z0-9]nor[^a-z0-9]+the[^a-z0-9]+names[^a-z0-9]+of\b"
NAMED = ". {0}. neither the name of the copyright holder nor the names of"
WRAP = r"[ \t\f\r]*\n[ \t\f\r]*"


def _cut(text: str) -> list[str]:
    text = text.lower()
    for pattern, spelt in SPELLINGS:
        text = re.sub(pattern, spelt.format(r"\1", r"\2"), text)
    parts = re.split(r"[.!?:;]+(?:[ \t\n\f\r]+|\Z)|\n+", text)
    return [p for p in (re.sub(r"[^a-z0-9]+", " ", x).strip() for x in parts) if p]


def known_sentences(rules=RULES) -> tuple[list[str], list[tuple[str, str]]]:
    """The distinct normalised sentences (number = position + 1) and each rule as (licence, ',n,n,')."""
    known: list[str] = []
    patterns = []
    for name, sentences in rules:
        numbers = []
        for s in sentences:
            for part in _cut(s):
                if part not in known:
                    known.append(part)
                numbers.append(known.index(part) + 1)
        patterns.append((name, "," + ",".join(map(str, numbers)) + ","))
    return known, patterns


def _numbers(lowered: Column, known: list[str], end: str = SENTENCE_END) -> Column:
    sentences = F.split(lowered, end)
    table = F.array(*(F.lit(s) for s in known))
    found = F.transform(sentences, lambda s: F.array_position(table, F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))))
    return F.array_join(F.transform(F.filter(found, lambda n: n > 0), lambda n: n.cast("string")), ",")


def _without_holders(lowered: Column) -> Column:
    """The text cut before each start of the clause; each piece is read once, so a start without an end costs nothing more."""
    pieces = F.split(lowered, f"(?={HOLDER_START})")
    return F.array_join(F.transform(pieces, lambda x: F.regexp_replace(x, rf"(?s)\A{HOLDER_START}(.+?){HOLDER_END}", NAMED.format("$1"))), "")


def _spaced(ids: str) -> str:
    """',1,2,' as ',1,,2,': neighbours share no comma, so a replaced match leaves the next one whole."""
    return "," + ids.strip(",").replace(",", ",,") + ","


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per input row: doc_id, sentence_ids, n_sentences, licenses.

    ``sentence_ids`` are the numbers of the known sentences in order (lines as sentences; if that finds none,
    paragraphs, then with all lines joined), ``licenses`` the sorted licences whose rules apply, both as comma-separated text. Null and empty texts have
    empty text and 0. Texts of any length are read whole. Repeated rows and null ids stay; other columns are ignored.
    """
    known, patterns = known_sentences(rules)
    low = F.lower(F.col(text_col).cast("string"))
    hit = F.coalesce(low.rlike(RAW_HINT), F.lit(False))
    for pattern, spelt in SPELLINGS:
        low = F.regexp_replace(low, pattern, spelt.format("$1", "$2"))
    low = _without_holders(low)
    readings = {"a": _numbers(low, known), "b": _numbers(low, known, PARAGRAPH_END), "c": _numbers(F.regexp_replace(low, WRAP, " "), known)}
    seen = docs.select(F.col(id_col).alias("doc_id"), *(F.when(hit, r).otherwise("").alias(k) for k, r in readings.items()))
    names: dict[str, list[str]] = {}
    for name, ids in sorted(patterns, key=lambda x: -x[1].count(",")):  # the longest sequence first
        names.setdefault(_spaced(ids), []).append(name)
    table = F.array(*(F.struct(F.lit(p).alias("ids"), F.array(*map(F.lit, n)).alias("names")) for p, n in names.items()))
    whole = {k: F.concat(F.lit(","), F.replace(F.col(k), F.lit(","), F.lit(",,")), F.lit(",")) for k in readings}
    part = {k: reduce(or_, (F.contains(whole[j], whole[k]) & ((F.col(j) != F.col(k)) | F.lit(j > k)) for j in readings if j != k)) for k in readings}
    # a reading that is part of another sees the same sentences, and would show the shorter rule of a longer match again
    texts = F.concat_ws("|", *(F.when(~part[k], whole[k]) for k in readings))
    none = F.struct(texts.alias("rest"), F.array().cast("array<string>").alias("names"))
    found = F.aggregate(table, none, lambda done, x: F.when(F.contains(done["rest"], x["ids"]), F.struct(
        F.replace(done["rest"], x["ids"], F.lit(",0,")).alias("rest"), F.concat(done["names"], x["names"]).alias("names"))).otherwise(done),
        lambda done: F.array_join(F.array_sort(F.array_distinct(done["names"])), ","))
    ids = F.when(F.col("a") != "", F.col("a")).when(F.col("b") != "", F.col("b")).otherwise(F.col("c"))
    return seen.select("doc_id", ids.alias("sentence_ids"),
                       F.when(ids == "", 0).otherwise(F.size(F.split(ids, ","))).cast("long").alias("n_sentences"),
                       F.when(ids == "", "").otherwise(found).alias("licenses"))
