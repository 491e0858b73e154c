"""Licence scans: normalised text against licence templates, by the Dice coefficient of word bigrams.

Segments are the whole text, its lines and its sentences, in lower case, cut into words. A segment with `a`
distinct bigrams can reach the threshold t with a template of `b` only if a * t / (2 - t) <= b <=
a * (2 - t) / t; only templates within these bounds are compared. A segment that reaches it shares at least
b * t / (2 - t) bigrams, so that it has one of a few words or bigrams (`marks`): texts and segments with none of these
are never cut into words. The templates are few and fixed, so they are literals of the plan: all of it is
DataFrame functions on the row, without a shuffle.

Defined cases: a null or empty text, and one without two words in a row, matches nothing; of templates that
match equally well, the first by name counts; repeated rows are scanned each on its own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.arrow import kept_columns

THRESHOLD = 0.8
# Words from this length on are looked for by themselves.
LONG_WORD = 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SENTENCE_ENDS = r"[.!?;]+[\x20\t\r]+|\n"

# Public licence notices and short licence texts, by SPDX identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version.",
    ),
    "GPL-3.0": (
        "Licensed under the GNU General Public License, version 3.",
        "This program is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software.",
    ),
}

RESULTS = ["licenses"]


def words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.translate(str.maketrans(_UPPER, _LOWER))) if w]


def bigrams(text: str) -> list[str]:
    own = words(text)
    return sorted({f"{a} {b}" for a, b in zip(own, own[1:], strict=False)})


def _segment_words(segment: Column) -> Column:
    return F.filter(F.split(segment, SEPARATORS), lambda w: w != "")


def _distinct_bigrams(own: Column) -> Column:
    n = F.size(own)
    at = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.concat(F.get(own, i), F.lit(" "), F.get(own, i + 1))))


def _bounds(size: int, threshold: float) -> tuple[float, float]:
    """Sizes a set may have to reach the threshold with one of this size."""
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def marks(forms: Sequence[Sequence[str]], threshold: float) -> list[str]:
    """Long words and, where these do not do, bigrams, one of which is in every segment that reaches the threshold
    with one of the forms.

    Such a segment has at least `b * t / (2 - t)` bigrams of a form, so that marks which lie in more of its
    bigrams than it may lack cannot all be missing.
    """
    found: list[str] = []

    def covered(form: Sequence[str]) -> set[str]:
        return {b for b in form if any(m == b or any(m in w for w in b.split(" ")) for m in found)}

    for form in sorted(forms, key=len, reverse=True):
        # An error of the division must not ask for too little.
        may_lack = len(form) - max(1, math.ceil(len(form) * threshold / (2 - threshold) - 1e-9))
        long = {w for b in form for w in b.split(" ") if len(w) >= LONG_WORD}
        for mark in [*sorted(long, key=lambda w: (-len(w), w)), *sorted(form, key=lambda b: (-len(b), b))]:
            before = covered(form)
            if len(before) > may_lack:
                break
            found.append(mark)
            if len(covered(form)) == len(before):
                found.pop()
    # A word that holds another one is not needed.
    return [m for m in found if not any(v != m and any(v in w for w in m.split(" ")) for v in found)]


def _marked(value: Column, needed: Sequence[str]) -> Column:
    """Has a text in lower case one of the marks? What is cheap is asked first."""

    def one(mark: str) -> Column:
        own = mark.split(" ")
        found = reduce(lambda a, b: a & b, [F.contains(value, F.lit(w)) for w in own])
        return found & F.rlike(value, F.lit(SEPARATORS.join(own))) if len(own) > 1 else found

    return reduce(lambda a, b: a | b, [one(m) for m in needed])


def find_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """`docs` with `licenses`: (license, score) of each template set that a segment matches, best first."""
    columns = kept_columns(docs, RESULTS, keep)
    forms = [(name, bigrams(form)) for name in sorted(templates) for form in templates[name]]
    least = min(_bounds(len(b), threshold)[0] for _, b in forms)
    most = max(_bounds(len(b), threshold)[1] for _, b in forms)

    needed = marks([form for _, form in forms], threshold)
    # `lower` is cheaper than `translate`, and treats what the marks are made of alike.
    source = docs.select(
        *[F.col(f"`{c}`").alias(f"_{k}_") for k, c in enumerate(columns)],
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text_"),
    ).select("*", F.lower("_text_").alias("_lower_"))
    value = F.translate("_text_", _UPPER, _LOWER)
    segments = F.concat(F.array(value), F.split(value, r"\n"), F.split(value, SENTENCE_ENDS))
    # A segment has fewer bigrams than characters, so that short ones fall out at once.
    segments = F.array_distinct(F.filter(segments, lambda s: (F.length(s) > int(least)) & _marked(s, needed)))
    # Step by step, so that no list is made again for each of its elements.
    sets = F.transform(F.transform(segments, _segment_words), _distinct_bigrams)
    sets = F.filter(sets, lambda b: F.size(b).between(least, most))
    sets = F.when(_marked(F.col("_lower_"), needed), sets).otherwise(F.array().cast("array<array<string>>"))
    rows = source.select(*[F.col(f"_{k}_").alias(c) for k, c in enumerate(columns)], sets.alias("_sets_"))

    def score(name: str, form: list[str]) -> Column:
        low, high = _bounds(len(form), threshold)
        own = F.array(*[F.lit(b) for b in form])
        near = F.filter("_sets_", lambda b: F.size(b).between(low, high))
        dice = F.transform(near, lambda b: F.size(F.array_intersect(b, own)) * 2.0 / (F.size(b) + len(form)))
        return F.struct(F.lit(name).alias("license"), F.coalesce(F.array_max(dice), F.lit(0.0)).alias("score"))

    best: dict[str, list[Column]] = {}
    for name, form in forms:
        best.setdefault(name, []).append(score(name, form))
    every = F.array(*[F.array_max(F.array(*scores)) for scores in best.values()])
    # Most texts have no segment of the right size.
    found = F.when(F.size("_sets_") > 0, F.filter(every, lambda s: s["score"] >= threshold))
    none = F.array().cast("array<struct<license:string,score:double>>")
    ordered = F.array_sort(F.transform(F.coalesce(found, none), lambda s: F.struct(-s["score"], s["license"])))
    licenses = F.transform(ordered, lambda s: F.struct(s["license"].alias("license"), (-s["col1"]).alias("score")))
    return rows.select(*[F.col(f"`{c}`") for c in columns], licenses.alias("licenses"))
