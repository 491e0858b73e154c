"""Token alignment: cuts, links and counts against brute force, and edge cases."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import alignment
from eventmart.llm.queries import TOKENIZERS, queries
from tests.llm import brute

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

ODD = [
    None, "", " ", "  two  spaces ", "tab\tand\nnewline\r\n\n\n  x", "<|endoftext|> <s> </s> <unk> <0x41>", "▁x", "a ▁ b",
    "naïve café ÀÉÎ", "漢字かなカナ 한국어", "😀😀 👩‍👩‍👧", "x" * 3000, "Ünïcödé" * 40, "a\u0000b", "   wide", "ﬁ ligature ①",
    "don't we'll I'VE 's", "1234567890 12 3", "\u0085\u001c\u001d .", "١٢٣ אבג", "the the the", "é é", "﻿bom", "​",
]


def test_against_brute_force(documents, small):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(1000 + i, t and t[:700]) for i, t in small[:40]] + [(5, "the the the")]
    unique = [(k, t) for k, (_, t) in enumerate(rows)]
    expected = brute.alignment(unique, A, B)
    found = alignment.align_tokens(documents(unique), A, B).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found} == expected
    assert sum(v[0] > 0 for v in expected.values()) > 55


def test_query_on_the_table(spark, sf_dir, small):
    expected = brute.alignment([(i, t) for i, t in small if t is None or len(t) < 3000], A, B)
    found = {r["doc_id"]: r for r in queries()["op12_align_tokens"](spark, sf_dir).collect()}
    assert len(found) == len(small)
    for doc_id, (n_a, n_b, n_groups, n_links, _, _, groups) in expected.items():
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        row = found[doc_id]
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups_sha256"]) == (n_a, n_b, n_groups, n_links, digest)
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in found.values())
    assert all(r["n_best"] <= r["n_links"] <= r["count_sum"] for r in found.values())


@pytest.mark.parametrize("density", [0.0, 0.002, 0.3, 1.0])
def test_cuts_are_the_common_ends(density):
    rng = np.random.default_rng(3)
    cuts = np.cumsum(rng.integers(1, 60, 300))
    size = int(cuts[-1]) + 1
    shared = rng.random(size) < density
    kind = rng.integers(0, 3, size)
    a = np.union1d(np.flatnonzero(shared | (kind == 1)), cuts)
    b = np.union1d(np.flatnonzero(shared | (kind == 2)), cuts)
    whole = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
    assert (a[whole] == np.intersect1d(a, b)).all()
    # The same in two runs, and in none.
    half = np.searchsorted(a, cuts[150]) + 1
    parts = alignment.shared_cuts(a, b, np.array([0, half]), np.array([half, len(a)]))
    assert (parts == whole).all()


def test_a_long_run_without_a_cut_is_one_group():
    a, b = np.append(np.arange(0, 200_000, 2), 200_001), np.append(np.arange(1, 200_000, 2), 200_001)
    assert alignment.shared_cuts(a, b, np.array([0]), np.array([len(a)])).tolist() == [len(a) - 1]


def test_both_encoders_of_a_agree():
    """Characters that go to the fast encoder, in all kinds of neighbourhoods."""
    coder = alignment.ByteBpe(Path(A).read_bytes())
    rng = random.Random(1)
    below = [chr(c) for c in range(ord(alignment._SETTLED))]
    texts = [f"a{c}b {c} {c}{c}1{c}\n{c} " for c in below]
    texts += ["".join(rng.choices(below, k=40)) for _ in range(2000)]
    texts += ["".join(rng.choices(" \t\n\r\x0b\x0c\x85\xa0'sldmvret1a", k=30)) for _ in range(2000)]
    assert coder.encode(texts) == [coder._encode_any(t) for t in texts]


def test_empty_tables_and_clashing_columns(documents):
    none = alignment.align_tokens(documents([]), A, B)
    assert none.count() == 0
    clash = documents([(1, "some text"), (1, "some text"), (2, None)]).withColumn("N_A", F.lit("x")).withColumn("_piece", F.lit(1))
    found = alignment.align_tokens(clash, A, B)
    assert found.columns == ["doc_id", "text", "lang", "source", "_piece", *COLUMNS]
    rows = sorted(tuple(r) for r in found.select("doc_id", "n_a", "count_sum").collect())
    assert rows[0] == rows[1] and rows[0][2] == 2 * rows[0][1] and rows[2] == (2, 0, 0)
    invalid = documents([(1, "x")]).select("doc_id", F.expr("cast(unhex('61ff') as string)").alias("text"))
    assert alignment.align_tokens(invalid, A, B).first()["n_a"] == 0
