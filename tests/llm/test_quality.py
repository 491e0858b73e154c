"""The rule ledger against brute force, policies and ablations."""

from __future__ import annotations

from collections import Counter

from eventmart.llm import quality
from eventmart.llm.queries import queries
from tests.llm import brute

GOOD = " ".join(f"plain{k} words" for k in range(40))
CASES = [
    (1, None), (2, ""), (3, GOOD), (4, "a b c " * 40), (5, "a b c a b c"), (6, "x\nx\n\n x\nx"), (7, "### $$$ " * 40 + GOOD),
    (8, "é ü ß  \t\x0b\x0c\r\n z"), (9, "one two three " + GOOD + " one two three"), (10, "w " * 30_000),
    (11, "1 2 3 4 5 6 " * 30 + GOOD), (12, "supercalifragilisticexpialidocious" * 3 + " " + "x" * 40), (3, GOOD), (None, GOOD),
]


def test_measures(documents):
    out = quality.apply_policy(quality.ledger(documents(CASES).selectExpr("*", "1 as RULE_BITS", "2 as extra")))
    assert out.count() == len(CASES)
    for r in out.collect():
        want = brute.quality(r["text"])
        assert {k: r[k] for k in want} == want, r
        assert not (r["kept"] and r["base_failed"])
    assert "extra" in out.columns and out.columns.count("rule_bits") == 1
    assert quality.ledger(documents([])).count() == 0


def test_each_rule_has_a_bit_of_its_own(documents):
    rows = {r["doc_id"]: r["rule_bits"] for r in quality.ledger(documents(CASES)).collect()}
    has = lambda doc, rule: bool(rows[doc] & quality.BITS[rule])
    assert rows[3] == 0
    assert has(4, "repeated_words") and has(1, "too_few_words") and has(7, "symbols") and has(6, "repeated_lines")
    assert has(11, "few_letters") is False and has(12, "long_words") and has(10, "short_words")


def test_ablation_equals_applying_each_policy(documents, monkeypatch):
    rows = quality.ledger(documents(CASES)).cache()
    for version, policy in list(quality.POLICIES.items()):
        found = {r["rule"]: (r["kept"], r["kept_without"], r["only_failure"]) for r in quality.ablation(rows, version).collect()}
        assert set(found) == {"", *policy.rules}
        kept = quality.apply_policy(rows, version).filter("kept").count()
        for rule, (a, b, only) in found.items():
            rest = tuple(r for r in policy.rules if r != rule)
            monkeypatch.setitem(quality.POLICIES, "less", quality.Policy("less", rest, policy.may_fail))
            assert a == kept and b == quality.apply_policy(rows, "less").filter("kept").count() and only == b - a
    assert quality.ablation(quality.ledger(documents([]))).count() == 0


def test_query_on_the_table(spark, sf_dir, small):
    texts = dict(small)
    rows = queries()["op7_quality_rules"](spark, sf_dir).collect()
    for r in rows:
        want = brute.quality(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
    assert Counter(r["doc_id"] for r in rows) == Counter(texts.keys())


def test_good_labels_are_kept(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries()["op7_quality_rules"](spark, sf_dir).filter("not base_failed").join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert all(good) and sum(bad) < 0.6 * len(bad)
