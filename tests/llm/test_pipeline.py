"""The corpus pipeline against brute force, stage by stage."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from eventmart.llm.queries import queries
from tests.llm import brute


def write(frame, path):
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path)


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Each stage's input and output."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        made = write(function(spark, docs, sf_dir), f"{root}/{name}")
        out[name] = (docs, made)
        docs = made
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_all_but_the_last_return_the_columns_of_documents(spark, sf_dir, stages):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name in list(stages)[:-1]:
        assert stages[name][1].dtypes == docs.dtypes
    assert list(stages) == ["language_id", "near_duplicates", "decontamination", "secrets", "mixing"]


def test_language_keeps_clean_documents(stages):
    before, after = map(texts, stages["language_id"])
    assert after.items() <= before.items()
    assert len(after) >= 0.98 * len(before)


def test_one_of_each_group_stays(stages):
    before, after = map(texts, stages["near_duplicates"])
    groups = brute.components(list(before.items()), 5, 80)
    assert set(after) == {i for i, (_, root) in groups.items() if i == root}
    assert after.items() <= before.items()


def test_benchmark_passages_are_cut(spark, sf_dir, stages):
    before, after = map(texts, stages["decontamination"])
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.contamination(list(before.items()), benchmark)
    assert any(hit for _, hit, _ in found.values())
    for i, (n, hit, _) in found.items():
        if not hit:
            assert after[i] == before[i]
        elif hit == n:
            assert i not in after
        else:
            assert len(brute.ALNUM_WORDS.findall(brute.lower(after[i]))) == n - hit


def test_secrets_are_redacted(stages):
    before, after = map(texts, stages["secrets"])
    for i, text in before.items():
        spans = [tuple(map(int, s.split(":")[1:])) for s in brute.secrets(text)[1].split(",") if s]
        if spans:
            assert "[secret]" in after[i] and not any(text[a:b] in after[i] for a, b in spans)
        else:
            assert after[i] == text
    counts = {r["doc_id"]: (r["n_chars"], len(r["text"])) for r in stages["secrets"][1].collect()}
    assert all(a == b for a, b in counts.values())


def test_the_mix_meets_its_targets(stages):
    before, after = stages["mixing"]
    sizes: dict = {}
    for r in before.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    want, taken = brute.targets(sizes), dict.fromkeys(sizes, 0)
    for r in after.collect():
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) < 1 + 1e-6 for s in sizes)


def test_run_is_the_stages_one_after_the_other(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).exceptAll(stages["mixing"][1]).count() == 0


def test_edge_cases_go_through_all_stages(spark, documents, tmp_path):
    spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    prose = "the quick brown fox jumps over the lazy dog and runs away from here "
    rows = [(1, prose * 2, "en", "s"), (1, prose * 2, "en", "s"), (None, prose * 3, None, None), (2, None, None, None), (3, "", "en", None),
            (4, "a b c d e f g h i j k " + prose, "en", "s"), (5, "x " * 50_000, "en", "t")]
    for start in (rows, []):
        docs = documents(start).selectExpr("*", "length(text) as n_chars", "'own' as ROW", "2 as size")
        names = docs.columns
        for n, (_, function) in enumerate(corpus_pipeline.STAGES):
            docs = write(function(spark, docs, str(tmp_path)), f"{tmp_path}/{len(start)}-{n}")
            if n < 4:
                assert docs.columns == names
        assert docs.count() == 0 or start


def test_queries_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries()) == list(range(1, 14))
