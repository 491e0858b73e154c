"""Language identification: held-out accuracy, rejection, and edge cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from eventmart.llm import language
from eventmart.llm.queries import queries
from tests.llm import brute

SYLLABLES = {"aa": "ka ro mi ten ba lu", "bb": "sch ung ein zwo pf tz", "cc": "ção ñu és lle qua ió"}


def texts(name: str, count: int, rng: random.Random) -> list[str]:
    parts = SYLLABLES[name].split()
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    return [" ".join(word() for _ in range(rng.choice([3, 20, 200]))) for _ in range(count)]


@pytest.fixture(scope="module")
def model_and_rows(documents):
    rng = random.Random(5)
    rows = [(n, t, name, None) for name in SYLLABLES for n, t in enumerate(texts(name, 40, rng))]
    rows += [(900, None, "aa", None), (901, "", "bb", None), (902, "karo", None, None), (None, "karo", "aa", None)]
    return language.train(documents(rows)), rng


def test_new_texts_are_told_apart(documents, model_and_rows):
    model, rng = model_and_rows
    rows = [(k, t, name, None) for name in SYLLABLES for k, t in enumerate(texts(name, 30, rng))]
    found = language.identify(documents(rows), model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 88
    assert not any(r["rejected"] for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_other_scripts_and_no_letters_are_rejected(documents, model_and_rows):
    model, rng = model_and_rows
    shouted = " ".join(texts("aa", 200, rng)).upper()
    rows = [(1, "Быстрая лиса прыгает через собаку " * 20), (2, "12345 %%% ..."), (3, None), (4, ""), (5, "漢字かな" * 30),
            (6, "xqvwjxk wqxvkj " * 40), (6, shouted), (7, "ª")]
    found = sorted((r["doc_id"], r["lang_pred"], r["rejected"], r["score"]) for r in language.identify(documents(rows), model).collect())
    by = {(i, r): (p, s) for i, p, r, s in found}
    assert all((i, True) in by for i in (1, 2, 3, 4, 5, 6)) and by[6, False][0] == "aa"
    assert [by[i, True] for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert by[1, True][0] in SYLLABLES and (7, "und") not in [(i, p) for i, p, *_ in found]


def test_nothing_to_learn_from_and_empty_tables(documents):
    assert language.train(documents([])) is None
    assert language.train(documents([(1, "a", None, None)])) is None
    found = language.identify(documents([(1, "abc")]).selectExpr("*", "2 as Score"), None)
    assert [tuple(r)[-3:] for r in found.collect()] == [("und", 0.0, True)]
    assert found.columns == ["doc_id", "text", "lang", "source", "lang_pred", "score", "rejected"]
    one = language.train(documents([(1, "karo mi", "aa", None)]))
    assert language.identify(documents([(2, "karo")]), one).first()["lang_pred"] == "aa"


def test_query_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = queries()["op4_language_id"](spark, sf_dir).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_prediction_uses_only_the_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs.filter(~language.held_out(F.col("doc_id"), 3, 1)))
    plain = language.identify(docs, model, keep=["doc_id"])
    moved = docs.select((-F.col("doc_id")).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit(None).cast("string").alias("source"))
    other = language.identify(moved, model, keep=["doc_id"]).select((-F.col("doc_id")).alias("doc_id"), "lang_pred", "score", "rejected")
    assert plain.exceptAll(other).count() == 0
