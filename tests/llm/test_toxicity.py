"""Toxicity: features and fit against plain versions, held-out accuracy, and edge cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventmart.llm import language, toxicity
from eventmart.llm.queries import queries
from tests.llm import brute

LABELS = "doc_id long, toxic int"
INSULTS = ["blarg", "snotfix", "gruntle"]


def written(rng: random.Random, toxic: bool) -> str:
    word = lambda: "".join(rng.choice("ka ro mi ten ba lu sho".split()) for _ in range(rng.randint(1, 4)))
    words = [word() for _ in range(rng.choice([8, 60, 600]))]
    if toxic:
        for _ in range(2):
            words[rng.randrange(len(words))] = rng.choice(INSULTS) + rng.choice(["", "s", "ed", "!"])
    return " ".join(words)


def corpus(seed: int, count: int) -> list[tuple[int, str, int]]:
    rng = random.Random(seed)
    return [(i, written(rng, i % 6 == 0), int(i % 6 == 0)) for i in range(count)]


@pytest.fixture(scope="module")
def trained(spark, documents):
    rows = corpus(1, 600)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    docs = documents([(i, t) for i, t, _ in rows])
    return docs, labels, toxicity.train(docs, labels)


def test_new_texts_are_told_apart(documents, trained):
    rows = corpus(2, 300)
    found = {r["doc_id"]: r for r in toxicity.score(documents([(i, t) for i, t, _ in rows]), trained[2]).collect()}
    assert sum(found[i]["predicted"] == y for i, _, y in rows) >= 297
    assert not any(found[i]["predicted"] for i, _, y in rows if not y)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())


def plain_grams(text: str) -> set[str]:
    spaced = " " + "".join(c if c.isalnum() else " " for c in text.lower()) + " "
    spaced = re.sub(" +", " ", spaced)
    found = {spaced[i : i + n] for n in (3, 4, 5) for i in range(len(spaced) - n + 1)}
    return {g for g in found if " " not in g[1:-1]}


def test_features_are_the_distinct_ngrams():
    texts = ["", "a", "Ünï CÖDE  x-y_z", "漢字かな 12 3", "ab" * 3000, "a.b.c", "  ", "İstanbul ẞ", None, "😀 ok😀ok"]
    grams = toxicity.Grams()
    columns, of = grams.distinct(pa.array(texts, pa.string()))
    own = [set(columns[of == k].tolist()) for k in range(len(texts))]
    numbers = {}
    for text in texts:
        for gram in plain_grams(text or ""):
            got, _ = grams(pa.array([gram.strip(" ")]))
            numbers[gram] = None
    # As many columns as n-grams (no two of these few share one), and the same for the same text alone.
    assert [len(o) for o in own] == [len(plain_grams(t or "")) for t in texts]
    for k, text in enumerate(texts):
        assert set(grams.distinct(pa.array([text], pa.string()))[0].tolist()) == own[k]
    assert len(set().union(*own)) == len(numbers)


def test_ratios_and_selection_against_plain_counts(documents, trained):
    docs, labels, (columns, _, _) = trained
    rows = docs.join(labels, "doc_id").select("text", "toxic").collect()
    counts = {0: Counter(), 1: Counter()}
    grams = toxicity.Grams()
    for text, y in rows:
        counts[y].update(grams.distinct(pa.array([text]))[0].tolist())
    n1, n = sum(y for _, y in rows), len(rows)
    n0 = n - n1

    def evidence(g):
        p, q = counts[1][g], counts[0][g]
        cells = [(p, n1, p + q), (q, n0, p + q), (n1 - p, n1, n - p - q), (n0 - q, n0, n - p - q)]
        return 2 * sum(o * math.log(o * n / (own * all_)) for o, own, all_ in cells if o)

    chosen = {g for g in counts[0].keys() | counts[1].keys() if evidence(g) >= toxicity.EVIDENCE}
    assert chosen == set(columns.tolist())
    seen = toxicity._seen(docs.join(labels, "doc_id").select("text", F.col("toxic").alias("label"), F.lit(False).alias("sampled")))
    again, ratios = toxicity._selected(seen, n0, n1)
    assert (again == columns).all()
    want = [math.log((counts[1][g] + n1 / n) / (n1 + n1 / n) / ((counts[0][g] + n0 / n) / (n0 + n0 / n))) for g in again.tolist()]
    assert np.allclose(ratios, want)


def test_fit_is_at_the_minimum():
    rng = np.random.default_rng(4)
    columns = [np.flatnonzero(rng.random(30) < 0.2) for _ in range(200)]
    labels = (np.array([c.sum() % 3 == 0 for c in columns])).astype(float)
    ratios = rng.normal(size=30)
    w, b = toxicity.fit(columns, labels, ratios)
    dense = np.zeros((200, 30))
    for k, c in enumerate(columns):
        dense[k, c] = ratios[c]
    p = 1 / (1 + np.exp(-(dense @ w + b)))
    assert np.abs(dense.T @ (p - labels) + toxicity.PENALTY * w).max() < 0.05
    assert abs((p - labels).sum()) < 0.05


def test_edge_cases(spark, documents, trained):
    model = trained[2]
    clash = documents([(1, None), (1, ""), (2, "..."), (3, "blarg! BLARG snotfix gruntle")]).withColumn("Score", F.lit("x"))
    found = toxicity.score(clash, model)
    assert found.columns == ["doc_id", "text", "lang", "source", "score", "predicted"]
    rows = sorted((r["doc_id"], r["score"], r["predicted"]) for r in found.collect())
    assert rows[0][1] == rows[1][1] == rows[2][1] < 0.5 and rows[3][2] == 1
    assert toxicity.score(documents([]), model).count() == 0

    def of(labels):
        docs = documents([(1, "abc def"), (2, "blarg"), (2, "blarg"), (None, "x")])
        return [r["score"] for r in toxicity.score(docs, toxicity.train(docs, spark.createDataFrame(labels, LABELS))).collect()]

    assert of([]) == of([(1, 0), (2, None), (None, 1), (9, 1), (2, 7)]) == [0.0] * 4
    assert of([(1, 1), (1, 0)]) == [1.0] * 4
    assert all(0 < s < 1 for s in of([(1, 0), (2, 1)]))


def test_query_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries()["op13_toxicity"](spark, sf_dir).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % 3 == 1) for r in rows)
    # Held-out labels are not read, nor are the other columns.
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = language.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.train(docs.filter(~held).select("doc_id", "text"), labels.filter(~held).select("doc_id", "toxic"))
    again = {(r[0], r[1]) for r in toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", "score").collect()}
    assert {(r["doc_id"], r["score"]) for r in rows} == again
