"""Decontamination against brute force, and the FM-index against a scan."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmart.llm.decontaminate import find_contamination, remove_contamination
from eventmart.llm.fmindex import END, GAP, FMIndex
from eventmart.llm.queries import queries
from tests.llm import brute

W = "one two three four five six seven eight nine ten eleven twelve".split()


@settings(max_examples=60, deadline=None)
@given(
    runs=st.lists(st.lists(st.integers(2, 5), min_size=1, max_size=30), min_size=1, max_size=6),
    patterns=st.lists(st.lists(st.integers(2, 6), min_size=1, max_size=12), min_size=1, max_size=8),
    sample=st.integers(1, 9),
)
def test_index_finds_every_occurrence(runs, patterns, sample):
    text = [s for run in runs for s in (*run, GAP)] + [END]
    index = FMIndex(np.array(text), 7, sample)
    width = max(map(len, patterns))
    table = np.array([p + [0] * (width - len(p)) for p in patterns])
    low, high = index.search(table, np.array([len(p) for p in patterns]))
    for p, a, b in zip(patterns, low, high, strict=True):
        found = sorted(index.locate(np.arange(a, b)).tolist())
        assert found == [i for i in range(len(text)) if text[i : i + len(p)] == p]


def rows_of(frame):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], sorted(r["items"])) for r in frame.collect()}


CASES = [
    (1, " ".join(W)),
    (2, "x " + " ".join(W[:11]).upper() + ", y"),
    (3, " ".join(W[:9])),
    (4, None),
    (5, ""),
    (6, "short item! And a Short  item again"),
    (7, "été naïve " * 3),
    (8, " ".join(W[:6]) + " gap " + " ".join(W[6:])),
    (9, " ".join(["la"] * 40)),
    (10, " ".join(W * 400)),
]
ITEMS = [
    (1, " ".join(W)),
    (2, "short item"),
    (3, None),
    (4, "..."),
    (5, " ".join(["la"] * 12)),
    (6, " ".join(W)),
    (7, "Naïve été naïve été"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_edge_cases(spark, documents, block_bytes):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = find_contamination(documents(CASES), benchmark, block_bytes=block_bytes)
    assert rows_of(found) == brute.contamination(CASES, ITEMS)


def test_query_on_the_table(spark, sf_dir, small):
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute.contamination(small, benchmark)
    for r in queries()["op10_decontaminate"](spark, sf_dir).collect():
        n, hit, items = expected[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(items), hit > 0)
        assert r["items_sha256"] == brute.sha(",".join(items))


def test_spans_are_cut_and_clean_texts_stay(spark, documents):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in remove_contamination(documents(CASES), benchmark).collect()}
    assert kept[2] == "x , y" and kept[8] == dict(CASES)[8] and kept[4] is None and kept[5] == ""
    assert kept[6] == "! And a  again"
    # Of these no word is left.
    assert 1 not in kept and 9 not in kept and 10 not in kept


def test_empty_tables_repeats_and_clashing_columns(spark, documents):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_contamination(documents([]), benchmark).count() == 0
    assert rows_of(find_contamination(documents(CASES), benchmark.limit(0)))[1] == (12, 0, [])
    twice = documents(CASES[:2] * 2 + [(None, "short item")]).selectExpr("*", "'mine' as N_WORDS", "1 as extra")
    found = find_contamination(twice, benchmark)
    assert found.columns == ["doc_id", "text", "lang", "source", "extra", "n_words", "n_hit", "hit_spans", "items"]
    assert found.count() == 5 and found.filter("doc_id is null").first()["n_hit"] == 2


def test_an_item_without_an_id_is_searched(spark, documents):
    words = [f"w{k}" for k in range(12)]
    docs = [(1, " ".join(words[:11])), (2, "nothing of it"), (3, " ".join(words))]
    items = [(None, " ".join(words[:10])), ("a", " ".join(words[2:12])), (None, None)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    for block in (1 << 20, 8):
        found = find_contamination(documents(docs), benchmark, block_bytes=block).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found} == brute.contamination(docs, items[:2])
    alone = find_contamination(documents(docs), benchmark.filter("item_id is null")).collect()
    assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in alone} == {1: (10, []), 2: (0, []), 3: (10, [])}
