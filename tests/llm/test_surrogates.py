"""Surrogates: type, format, distinctness, coreference, and texts without any."""

from __future__ import annotations

import re

import pytest

from eventmart.llm import surrogates

KEY = "k"
TEXTS = [
    "write to Ann.Lee7@mail3.example.com or ann.lee7@MAIL3.example.com",
    "call +1 (551) 555-0826 or +1 551 555 0826, from 10.20.30.40.",
    "card 4539 1488 0343 6467 and 4952935900253051; ssn 078-05-1120",
    "Mr. John Smith met Mrs Jane Smith and Mr Smith; господин Иван Петров, κυρία Ελένη Παππά",
    "nothing here: 12.5 and 3.4.5, version 1.2.3.4.5, a@b, 1234567, 2024-05-06",
    "",
    None,
    "ann.lee7@mail3.example.com again, 10.20.30.40 too",
    "x " * 20_000 + "b@c.de",
]


@pytest.fixture(scope="module")
def out(documents):
    rows = documents(list(enumerate(TEXTS))).selectExpr("*", "1 as N_entities")
    return {r["doc_id"]: r for r in surrogates.replace_personal_data(rows, KEY).collect()}


def luhn(number: str) -> bool:
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def test_nothing_personal_is_left_and_the_rest_stays(out):
    for n, text in enumerate(TEXTS):
        for value in re.findall(surrogates.ANY.replace("++", "+").replace("*+", "*").replace(r"\p{Lu}", r"\w").replace(r"\p{L}", r"\w"), text or ""):
            assert value not in out[n]["text"]
    for n in (4, 5, 6):
        assert out[n]["text"] == TEXTS[n] and out[n]["n_entities"] == 0
    assert out[8]["text"].startswith("x " * 20_000) and out[8]["n_entities"] == 1


def test_the_same_entity_has_the_same_surrogate(out):
    first, second = re.findall(r"\S+@\S+", out[0]["text"])
    assert first == second == re.findall(r"[^\s,]+@[^\s,]+", out[7]["text"])[0]
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@[a-z]{4}\d\.[a-z]{7}\.example", first)
    ip = re.search(r"\d+\.\d+\.\d+\.\d+", out[1]["text"])[0]
    assert ip in out[7]["text"] and all(0 < int(x) < 255 for x in ip.split("."))
    a, b = re.findall(r"\+1 \(?\d{3}\)? \d{3}[- ]\d{4}", out[1]["text"])
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    assert out[0]["entity_kinds"] == ["email"] and out[0]["n_entities"] == 1


def test_formats_gender_and_script(out):
    spaced, plain = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", out[2]["text"])
    assert luhn(spaced) and not luhn(plain) and spaced[0] == "4" and plain[0] == "4"
    assert re.search(r"ssn \d{3}-\d{2}-\d{4}$", out[2]["text"])
    names = re.match(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+) and Mr (\w+); господин (\w+) (\w+), κυρία (\w+) (\w+)$", out[3]["text"])
    assert names[1] in surrogates.NAMES["latin", "m"].split() and names[3] in surrogates.NAMES["latin", "f"].split()
    assert names[6] in surrogates.NAMES["cyrillic", "m"].split() and re.fullmatch("[А-Яа-яё]+", names[7])
    assert names[8] in surrogates.NAMES["greek", "f"].split() and re.fullmatch(r"[Ͱ-Ͽ]+", names[9])


def test_surrogates_are_one_to_one_and_no_real_entity(spark):
    """Few possible surrogates, so that most collide at first."""
    frame = spark.createDataFrame([("ssn", f"{n:03d}") for n in range(300)], "kind string, entity string")
    found = [tuple(r) for r in surrogates.assign(frame, KEY).collect()]
    assert len(found) == 300 and len({s for _, _, s in found}) == 300
    assert not {s for _, _, s in found} & {e for _, e, _ in found}


def test_there_is_an_end_where_a_shape_has_too_few_surrogates(spark):
    """More names of two letters, and numbers of two digits, than there are surrogates of that shape."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [("name", f"m {a}{b}") for a in letters for b in letters][:600]
    numbers = [("phone", f"{n:02d}") for n in range(100)]
    frame = spark.createDataFrame(names + numbers, "kind string, entity string")
    found = [tuple(r) for r in surrogates.assign(frame, KEY).collect()]
    assert len(found) == 700 and len({(k, s) for k, _, s in found}) == 700
    assert not {s for k, _, s in found if k == "phone"} & {e for _, e in numbers}
    assert max(len(s) for _, _, s in found) <= 6


def test_names_are_replaced_whole(documents):
    texts = ["Mr. McDonald left", "Mrs. Smith-Jones left", "Mr O'Brien left", "Señor Juan Carlos Garcia left", "Ms. D’Arcy-Lee left"]
    rows = surrogates.replace_personal_data(documents(list(enumerate(texts))), KEY).collect()
    for r in rows:
        title = texts[r["doc_id"]].split(" ")[0]
        assert re.fullmatch(rf"{re.escape(title)} [\w'’-]+( \w+)? left", r["text"]), r["text"]
        for part in re.findall(r"\w{4,}", texts[r["doc_id"]].removeprefix(title).removesuffix("left")):
            assert part not in r["text"]


def test_keys_repeats_and_empty_tables(documents):
    rows = documents([(1, TEXTS[0]), (1, TEXTS[0]), (None, TEXTS[0])])
    same = {r["text"] for r in surrogates.replace_personal_data(rows, KEY).collect()}
    other = {r["text"] for r in surrogates.replace_personal_data(rows, "another").collect()}
    assert len(same) == len(other) == 1 and same != other
    assert surrogates.replace_personal_data(rows, KEY).count() == 3
    assert surrogates.replace_personal_data(documents([]), KEY).count() == 0


def test_no_python_runs_in_the_plan(documents):
    plan = surrogates.replace_personal_data(documents([(1, "a@b.cd")]), KEY)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("PythonSQL", ""))
