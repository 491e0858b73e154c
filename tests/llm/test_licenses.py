"""Licence scans against plain Python."""

from __future__ import annotations

import random
import re

import pytest

from eventmart.llm import licenses

MIT = licenses.TEMPLATES["MIT"][2]
MARKS = licenses.marks([licenses.bigrams(f) for forms in licenses.TEMPLATES.values() for f in forms], licenses.THRESHOLD)


def plain(text, threshold=licenses.THRESHOLD):
    lowered = (text or "").translate(str.maketrans(licenses._UPPER, licenses._LOWER))
    segments = [lowered, *lowered.split("\n"), *re.split(licenses.SENTENCE_ENDS, lowered)]
    sets = [set(licenses.bigrams(s)) for s in segments]
    found = []
    for name, forms in licenses.TEMPLATES.items():
        own = [set(licenses.bigrams(f)) for f in forms]
        score = max([2.0 * len(s & f) / (len(s) + len(f)) for s in sets for f in own if s] or [0.0])
        if score >= threshold:
            found.append((name, score))
    return sorted(found, key=lambda x: (-x[1], x[0]))


CASES = [
    None, "", "x", "Released under the MIT License.", "prose first. released under the mit license! More prose",
    "a\nLicensed under the Apache License, Version 2.0.\nb", MIT, MIT.upper(), MIT.replace(" ", "\n  "), MIT + " " + "word " * 300,
    "This work is licensed under the GNU General Public License, version 3.", "the license of this fish shop",
    "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.", "é " * 5000 + "\nReleased under CC0 1.0.", "a b " * 20_000,
    licenses.TEMPLATES["GPL-3.0"][2].replace("version 3", "version 2"),
]


def test_cases(documents):
    rows = [(n, t) for n, t in enumerate(CASES)] + [(3, CASES[3]), (None, CASES[3])]
    out = licenses.find_licenses(documents(rows).selectExpr("*", "1 as LICENSES", "2 as more"))
    assert out.columns == ["doc_id", "text", "lang", "source", "more", "licenses"] and out.count() == len(rows)
    for r in out.collect():
        got = [(x["license"], x["score"]) for x in r["licenses"]]
        want = plain(r["text"])
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1] for g in got] == pytest.approx([w[1] for w in want])
    assert licenses.find_licenses(documents([])).count() == 0


def test_some_are_found():
    assert [x[0] for x in plain(CASES[3])] == ["MIT"] and plain(CASES[11]) == []
    assert plain(CASES[6])[0] == ("MIT", 1.0)


def test_marks_are_in_every_text_that_matches():
    dice = random.Random(5)
    for forms in licenses.TEMPLATES.values():
        for form in forms:
            own = licenses.words(form)
            for _ in range(300):
                # As many words gone or replaced as may be, in blocks and single.
                some = list(own)
                for _ in range(dice.randint(1, max(1, len(some) // 4))):
                    at = dice.randrange(len(some))
                    some[at : at + dice.randint(1, 3)] = dice.choice([[], ["zq"]])
                    some = some or ["zq"]
                text = " ".join(some)
                if plain(text):
                    assert any(m in text for m in MARKS), text


def test_marks_with_other_thresholds():
    for threshold in (0.3, 0.5, 0.95, 1.0):
        assert licenses.marks([["a b", "b c"], ["x y"]], threshold)
