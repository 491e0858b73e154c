"""The mix against its targets, and the schedule against its definition."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventmart.llm import mixing
from eventmart.llm.queries import queries
from tests.llm import brute


def words(n: int) -> str:
    return " ".join(["w"] * n)


ROWS = (
    [(n, words(n % 17 * 9), None, "alpha") for n in range(200)]
    + [(1000 + n, words(400), None, "beta") for n in range(30)]
    + [(2000, words(3), None, "gamma"), (2001, None, None, "gamma"), (2002, "", None, "delta"), (2003, " \t ", None, None)]
    + [(3000 + n, words(50), None, None) for n in range(9)]
    + [(4000, words(9000), None, "Émile")]
)


@pytest.fixture(scope="module")
def mixed(documents):
    docs, schedule = mixing.mix(documents(ROWS))
    return docs.collect(), schedule.collect()


def test_targets_and_what_is_taken(mixed):
    docs, _ = mixed
    sizes = defaultdict(int)
    for _, text, _, source in ROWS:
        sizes[source] += len(brute.SPACE_WORDS.findall(text or ""))
    want = brute.targets(sizes)
    taken = defaultdict(int)
    for r in docs:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] <= 3 * r["size"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(taken[s] == int(want[s] + 1e-6) for s in sizes)
    assert len(docs) == len(ROWS)


def test_schedule_takes_equal_blocks_in_golden_order(mixed):
    docs, schedule = mixed
    slots, sources = defaultdict(int), {}
    for r in schedule:
        slots[r["slot"]] += r["n_words"]
        sources[r["slot"]] = r["source"]
    assert max(slots.values()) == mixing.LEAST_BLOCK
    # Only the last block of a source is shorter.
    assert sum(n < mixing.LEAST_BLOCK for n in slots.values()) <= len(set(sources.values()))
    total, targets = sum(slots.values()), defaultdict(int)
    for s, n in slots.items():
        targets[sources[s]] += n
    # Every stretch of the schedule is close to the weights.
    seen, begun = defaultdict(int), sorted(slots)[: len(slots) // 2]
    for s in begun:
        seen[sources[s]] += 1
    for source, n in targets.items():
        assert abs(seen[source] / len(begun) - n / total) < 0.02 + 3 / len(begun)
    by_doc = defaultdict(int)
    for r in schedule:
        by_doc[r["id"], r["copy"]] += r["n_words"]
    assert {(r["id"], r["copy"]): r["taken"] for r in docs if r["taken"]} == dict(by_doc)


def test_word_count(spark):
    texts = [None, "", " ", "a", " a b\t\x0bc\r\n\x0c d ", "é x y", "a  b"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in frame.select("t", mixing.n_words(F.col("t"))).collect()]
    assert got == [(t, len(brute.SPACE_WORDS.findall(t or ""))) for t in texts]


def test_repeats_null_ids_empty_tables_and_reruns(documents):
    rows = [(1, words(5), None, "a")] * 3 + [(None, words(7), None, "a"), (None, words(7), None, "b"), (2, None, None, None)]
    frame = documents(rows).selectExpr("*", "9 as SIZE", "8 as rank")
    first = sorted(map(str, mixing.mix(frame)[0].collect()))
    assert len(first) == 6 and first == sorted(map(str, mixing.mix(documents(rows, parts=1))[0].collect()))
    assert mixing.mix(documents([]))[0].count() == 0
    assert mixing.mix(documents([(1, None), (2, "")]))[0].agg(F.sum("taken")).first()[0] == 0


def test_query_on_the_table(spark, sf_dir):
    rows = queries()["op8_mix_sources"](spark, sf_dir).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r["size"] == len(brute.SPACE_WORDS.findall(docs[r["doc_id"]]["text"]))
        taken[docs[r["doc_id"]]["source"]] += r["taken"]
        target[docs[r["doc_id"]]["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) < 1 + 1e-6 for s in target)
