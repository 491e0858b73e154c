"""Benchmark decontamination: an FM-index for each shard of the documents, searched for test phrases.

The words of a shard become symbols: one for each word that some test phrase has, and a gap for a run of
others, which no phrase can cross. All phrases of a block of the benchmark are searched backwards at
once through wavelet-matrix ranks; occurrences are located by sampled suffix positions, and their spans
merged. A shard is a few megabytes of one task's documents, so an index is small and lives while its
shard is scanned. The benchmark goes to the tasks in blocks of bounded size, one pass over the documents
for each.

Words are compared by 64-bit hashes.

Defined cases: a null text has no words; an item without words matches nothing; rows with the same id
are documents of their own; rows of the benchmark with the same id are one item with all their phrases;
the phrases of an item without an id are searched as well, and it is in no list of items; an empty benchmark
finds nothing.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.arrow import kept_columns, map_texts, utf8
from eventmart.llm.fmindex import GAP, FMIndex
from eventmart.llm.words import ALPHANUMERIC, LOWER, bounds, hashes
from eventmart.sources.staging import stage

WINDOW = 10
# Benchmark text sent to the tasks at once.
BLOCK_BYTES = 4 << 20

SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]), False
)
RESULTS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        # Bytes of the UTF-8 text, from the first to the last word of each merged span.
        T.StructField("hit_spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


@dataclass
class Phrases:
    """The phrases of a block of benchmark items."""

    vocabulary: np.ndarray  # hashes, ascending; word k is symbol k + 2
    patterns: np.ndarray  # one row each, left-aligned
    lengths: np.ndarray
    owner_rows: np.ndarray  # phrase of each (phrase, item)
    owners: np.ndarray  # item of each (phrase, item)
    items: list[str]

    @classmethod
    def of(cls, rows: list[tuple[str | None, str]], window: int) -> Phrases:
        data, offsets = utf8(pa.array([text for _, text in rows], pa.large_string()))
        data = LOWER[data]
        starts, ends, at = bounds(data, offsets, ALPHANUMERIC)
        words = hashes(data, starts, ends)
        vocabulary = np.unique(words)
        symbols = np.searchsorted(vocabulary, words) + 2
        items = sorted({item for item, _ in rows if item is not None})
        number = {item: k for k, item in enumerate(items)}
        found: dict[tuple[int, ...], set[int]] = {}
        for k, (item, _) in enumerate(rows):
            own = symbols[at[k] : at[k + 1]]
            for i in range(max(1, len(own) - window + 1) if len(own) else 0):
                owners = found.setdefault(tuple(own[i : i + window].tolist()), set())
                if item is not None:
                    owners.add(number[item])
        lengths = np.array([len(p) for p in found], np.int64)
        patterns = np.zeros((len(found), window), np.int64)
        for k, p in enumerate(found):
            patterns[k, : len(p)] = p
        pairs = [(k, i) for k, own in enumerate(found.values()) for i in own]
        pairs = np.array(pairs, np.int64).reshape(-1, 2)
        return cls(vocabulary, patterns, lengths, pairs[:, 0], pairs[:, 1], items)


def _symbols(words: np.ndarray, phrases: Phrases, likely: np.ndarray) -> np.ndarray:
    """The symbol of each word, GAP where no phrase has it."""
    out = np.full(len(words), GAP, np.int64)
    maybe = np.flatnonzero(likely[(words & np.uint64(0xFFFF)).astype(np.int64)])
    place = np.minimum(np.searchsorted(phrases.vocabulary, words[maybe]), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[place] == words[maybe]
    out[maybe[known]] = place[known] + 2
    return out


def _shard(symbols: np.ndarray, cuts: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence to index, and the word each of its symbols stands for.

    Runs of words that phrases have, within a text, each followed by a gap. A run with fewer words than
    the shortest phrase cannot hold one and is left out.
    """
    known = symbols != GAP
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    inner = cuts[(cuts > 0) & (cuts < len(known))]
    begins[inner] = known[inner]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = np.cumsum(begins) - 1
    sizes = np.bincount(run[known], minlength=len(starts))
    use = known & (sizes[np.maximum(run, 0)] >= shortest)
    words = np.flatnonzero(use)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new_run = np.concatenate([[False], run[words][1:] != run[words][:-1]])
    place = np.arange(len(words)) + np.cumsum(new_run)
    text = np.full(place[-1] + 3, GAP, np.int64)
    text[place] = symbols[words]
    text[-1] = 0
    where = np.full(len(text), -1, np.int64)
    where[place] = words
    return text, where


def _search(phrases: Phrases):
    likely = np.zeros(1 << 16, bool)
    likely[(phrases.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
    shortest = int(phrases.lengths.min(initial=1 << 30))
    by_phrase = np.argsort(phrases.owner_rows, kind="stable")
    owners = phrases.owners[by_phrase]
    owner_at = np.searchsorted(phrases.owner_rows[by_phrase], np.arange(len(phrases.lengths) + 1))

    def find(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are hit, and the (text, item) pairs found."""
        hit = np.zeros(len(words) + 1, np.int64)
        none = np.zeros(0, np.int64)
        if not len(phrases.lengths) or not len(words):
            return hit[:-1] > 0, none, none
        text, where = _shard(_symbols(words, phrases, likely), at, shortest)
        if not len(text):
            return hit[:-1] > 0, none, none
        index = FMIndex(text, len(phrases.vocabulary) + 2)
        low, high = index.search(phrases.patterns, phrases.lengths)
        counts = high - low
        phrase = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = where[index.locate(np.repeat(low, counts) + within)]
        np.add.at(hit, first, 1)
        np.add.at(hit, first + phrases.lengths[phrase], -1)
        document = np.searchsorted(at, first, side="right") - 1
        # One row for each text and phrase, then for each text and item.
        pairs = np.unique(document * len(counts) + phrase)
        document, phrase = pairs // len(counts), pairs % len(counts)
        n = owner_at[phrase + 1] - owner_at[phrase]
        own = np.repeat(owner_at[phrase], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        many = max(len(phrases.items), 1)
        pairs = np.unique(np.repeat(document, n) * many + owners[own])
        return np.cumsum(hit)[:-1] > 0, pairs // many, pairs % many

    return find


def _items(benchmark: DataFrame, item_id: str, text: str, size: int) -> tuple[DataFrame, int]:
    """The items that have a text, and in how many blocks of about `size` bytes they are taken."""
    items = benchmark.select(
        F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text")
    ).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return items, -(-total // size)


def _block(items: DataFrame, k: int, blocks: int) -> list[tuple[str | None, str]]:
    """One block. All rows of an item are in one."""
    own = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k) if blocks > 1 else items
    return [(r[0], r[1]) for r in own.collect()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    cut: bool = False,
) -> DataFrame:
    """`docs` with the words hit by benchmark phrases, their spans in the text and the items found.

    A phrase is `window` consecutive words of an item, or a whole item that is shorter. Columns named
    like a result are replaced. With `cut` there is also the text without its spans, `_cut_`.
    """
    columns = kept_columns(docs, RESULTS.fieldNames(), keep)
    carried = list(dict.fromkeys([*columns, text]))
    items, blocks = _items(benchmark, item_id, item_text, block_bytes)
    out = docs
    for k in range(max(blocks, 1)):
        if k:
            out = stage(out, "decontaminate")[0]
        phrases = Phrases.of(_block(items, k, blocks), window)
        out = _scan(out, text, phrases, carried, again=k > 0, cut=cut and k + 1 >= blocks)
    return out.select(*[F.col(f"`{c}`") for c in columns], *RESULTS.fieldNames(), *["_cut_"] * cut)


def _scan(docs: DataFrame, text: str, phrases: Phrases, keep: list[str], again: bool, cut: bool) -> DataFrame:
    """One block's findings, joined to those of the blocks before."""
    # Plain arrays, so that executors need no copy of the package.
    own = (phrases.vocabulary, phrases.patterns, phrases.lengths, phrases.owner_rows, phrases.owners, phrases.items)
    sent = docs.sparkSession.sparkContext.broadcast(own)

    def make():
        phrases = Phrases(*sent.value)
        find = _search(phrases)

        def work(texts, batch):
            data, offsets = utf8(texts)
            data = LOWER[data]
            starts, ends, at = bounds(data, offsets, ALPHANUMERIC)
            hit, document, item = find(hashes(data, starts, ends), at)
            n = len(texts)
            items: list[list[str]] = [[] for _ in range(n)]
            for d, i in zip(document.tolist(), item.tolist(), strict=True):
                items[d].append(phrases.items[i])
            if again:
                for k, (spans, known) in enumerate(
                    zip(batch.column("_also_spans").to_pylist(), batch.column("_also_items").to_pylist(), strict=True)
                ):
                    items[k] = sorted({*items[k], *known})
                    own = starts[at[k] : at[k + 1]]
                    for s in spans:
                        a, b = np.searchsorted(own + 0, [s["start"] + offsets[k], s["end"] + offsets[k]])
                        hit[at[k] + a : at[k] + b] = True
            spans: list[list[dict]] = [[] for _ in range(n)]
            if hit.any():
                begins = hit.copy()
                begins[1:] &= ~hit[:-1]
                last = hit.copy()
                last[:-1] &= ~hit[1:]
                cuts = at[(at > 0) & (at < len(hit))]
                begins[cuts] = hit[cuts]
                last[cuts - 1] = hit[cuts - 1]
                first, end = np.flatnonzero(begins), np.flatnonzero(last)
                whose = np.searchsorted(at, first, side="right") - 1
                for d, a, b in zip(whose.tolist(), first.tolist(), end.tolist(), strict=True):
                    spans[d].append({"start": starts[a] - offsets[d], "end": ends[b] - offsets[d]})
            total = np.concatenate([[0], np.cumsum(hit)])
            out = {"n_words": np.diff(at), "n_hit": total[at[1:]] - total[at[:-1]], "hit_spans": spans, "items": items}
            if cut:
                out["_cut_"] = texts if not hit.any() else [_cut(t, s) for t, s in zip(texts.to_pylist(), spans, strict=True)]
            return out

        return work

    also = {"spans": F.col("hit_spans"), "items": F.col("items")} if again else None
    # A text column of its own is kept for the next block.
    results = T.StructType([*RESULTS.fields, T.StructField("_cut_", T.StringType())]) if cut else RESULTS
    return map_texts(docs, text, results, make, keep, also)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` without the spans that benchmark phrases cover.

    A text that is hit loses those bytes; one that is not stays as it is. A document of which no word
    is left goes. Texts are cut in the pass that finds their last spans.
    """
    found = find_contamination(docs, benchmark, text, cut=True, **options)
    left = found.filter((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
    return left.select(*[F.col("_cut_").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def _cut(value: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return value
    raw, kept, end = value.encode(), [], 0
    for s in spans:
        kept.append(raw[end : s["start"]])
        end = s["end"]
    return b"".join([*kept, raw[end:]]).decode()


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
