"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by a byte-level BPE (A, of a space and the text) and by a SentencePiece BPE (B, which
adds that space itself). Byte offsets at which tokens of both end are cuts. They are found by divide and
conquer: in a run of A tokens, a token's end near the middle is looked up by bisection among B's ends, then
those further and further from it, in rings that double; at the first shared one the run is halved, and a run
without any is a group. All runs of a piece of texts are halved at once.

Two tokens are linked where their byte ranges overlap. How often an id pair is linked is counted over all
documents: pieces of texts give their distinct pairs, which are summed in a shuffle, and get back the sums of
their own pairs. Nothing is held per vocabulary but the highest count of each id of B.

Defined cases: a text that is null, empty or not UTF-8, or whose tokens' bytes are not those of a space and the
text (B changes some characters), has no tokens: all counts are 0 and its groups the empty string. Repeated rows
are documents of their own and all count. An empty table gives an empty result. Columns of the input named like
a result are replaced. A text is encoded whole, however long; one longer than a piece is a piece of its own.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.arrow import _arrow_type, kept_columns, pieces, release, utf8
from eventmart.llm.buckets import pack, unpack
from eventmart.sources.staging import stage

# Bytes of text whose distinct pairs are asked for together.
PIECE_BYTES = 4 << 20
# Bytes of text handed to B's encoder at once.
_BATCH = 1 << 18
# Fixed value: how A's pre-tokenizer splits a text (the published pattern of this kind of vocabulary).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Below this code point both of A's encoders split texts alike; their tables of characters may be of
# different Unicode versions beyond.
_SETTLED = "ɐ"

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
SUMS = ("n_best", "count_sum")


# -- encoders


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Vocabulary:
    """The bytes of all ids, end to end."""

    data: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> Vocabulary:
        offsets = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum([len(t) for t in tokens], out=offsets[1:])
        return Vocabulary(np.frombuffer(b"".join(tokens), np.uint8), offsets)

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.offsets[ids + 1] - self.offsets[ids]

    def joined(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, end to end."""
        return self.data[_ranges(self.offsets[ids], lengths)]


class ByteBpe:
    """A: a byte-level BPE in the JSON format of the tokenizers library."""

    def __init__(self, file: bytes):
        import tiktoken

        self._file, self._slow = file, None
        vocabulary = json.loads(file)["model"]["vocab"]
        byte_of = _byte_of()
        tokens: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            tokens[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.vocabulary = Vocabulary.of(tokens)
        special = {t["content"] for t in json.loads(file).get("added_tokens", [])}
        ranks = {tokens[n]: n for t, n in vocabulary.items() if t not in special}
        self._fast = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list:
        return [self._fast.encode_ordinary(t) if t.isascii() or max(t) < _SETTLED else self._encode_any(t) for t in texts]

    def _encode_any(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_str(self._file.decode())
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids


class PieceBpe:
    """B: a SentencePiece model with byte fallback."""

    def __init__(self, file: bytes):
        import sentencepiece

        self._coder = sentencepiece.SentencePieceProcessor(model_proto=file)
        tokens = []
        for k in range(self._coder.get_piece_size()):
            piece = self._coder.id_to_piece(k)
            tokens.append(bytes([int(piece[3:5], 16)]) if self._coder.is_byte(k) else piece.replace("▁", " ").encode())
        self.vocabulary = Vocabulary.of(tokens)

    def encode(self, texts: list[str]) -> list:
        return self._coder.encode(texts, num_threads=1)


def _encoded(coder, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, end to end, and where each text's begin and the last one's end."""
    ids, counts, batch, size = [], [], [], 0
    for k, text in enumerate(texts):
        batch.append(text)
        size += len(text)
        if size >= _BATCH or k + 1 == len(texts):
            for found in coder.encode(batch):
                counts.append(len(found))
                ids.append(np.array(found, np.int32))
            batch, size = [], 0
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), offsets


# -- cuts


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of each range [start, start + length), one range after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _nearest_shared(a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each range [low, high] of numbers of ends in `a`, the one nearest to its middle that is in `b`, or -1.

    Of two as near, the earlier one.
    """
    found = np.full(len(low), -1, np.int64)
    middle = (low + high) // 2
    open_, inner, outer = np.arange(len(low)), 0, 0
    while len(open_):
        # A ring: distances from `inner` to `outer` on both sides of the middle.
        own = middle[open_]
        left = np.maximum(own - outer, low[open_])
        right = np.minimum(own + outer, high[open_])
        spans = [(left, np.maximum(own - inner + 1 - left, 0)), (own + max(inner, 1), np.maximum(right - own - max(inner, 1) + 1, 0))]
        best = np.full(len(open_), np.iinfo(np.int64).max)
        for side, (start, length) in enumerate(spans):
            at = _ranges(start, length)
            who = np.repeat(np.arange(len(open_)), length)
            ends = a[at]
            where = np.searchsorted(b, ends)
            hit = b[np.minimum(where, len(b) - 1)] == ends
            np.minimum.at(best, who[hit], 2 * np.abs(at[hit] - own[who[hit]]) + side)
        got = best < np.iinfo(np.int64).max
        distance = best[got] // 2
        found[open_[got]] = own[got] + np.where(best[got] % 2 == 1, distance, -distance)
        rest = ~got & ((own - outer > low[open_]) | (own + outer < high[open_]))
        open_ = open_[rest]
        inner, outer = outer + 1, 2 * outer + 1
    return found


def shared_cuts(a: np.ndarray, b: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Numbers of the tokens of A that end a group, ascending.

    `a` and `b` are ascending ends. Each run [first, last) of A's tokens ends where a token of B does.
    """
    first, last = firsts, lasts
    cuts = [last - 1]
    while len(first):
        inside = last - first > 1
        first, last = first[inside], last[inside]
        at = _nearest_shared(a, b, first, last - 2)
        halved = at >= 0
        at, first, last = at[halved], first[halved], last[halved]
        cuts.append(at)
        # In the order of the bytes, which keeps the bisections near each other.
        first, last = np.stack([first, at + 1], 1).ravel(), np.stack([at + 1, last], 1).ravel()
    return np.sort(np.concatenate(cuts))


@dataclass
class Aligned:
    """Tokens of a few texts. Offsets are by text, ends are byte offsets in all texts end to end."""

    a: np.ndarray
    a_of: np.ndarray
    b: np.ndarray
    b_of: np.ndarray
    # The tokens of A and B up to each group's end, and the groups up to each text's.
    a_cut: np.ndarray
    b_cut: np.ndarray
    group_of: np.ndarray
    # The tokens of each link, and the links up to each text's end.
    link_a: np.ndarray
    link_b: np.ndarray
    link_of: np.ndarray


def _kept_tokens(ids: np.ndarray, of: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(of)
    ids = ids[np.repeat(keep, counts)]
    offsets = np.zeros(len(of), np.int64)
    np.cumsum(np.where(keep, counts, 0), out=offsets[1:])
    return ids, offsets


def _same_bytes(words: Vocabulary, ids: np.ndarray, of: np.ndarray, whole: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether each text's tokens are its bytes: `whole` holds all texts, `sizes` their bytes."""
    lengths = words.lengths(ids)
    total = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(lengths, out=total[1:])
    same = total[of[1:]] - total[of[:-1]] == sizes
    starts = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    own = same & (sizes > 0)
    tokens = words.joined(ids[np.repeat(own, np.diff(of))], lengths[np.repeat(own, np.diff(of))])
    bytes_ = whole[np.repeat(own, sizes)]
    off = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum(tokens != bytes_, out=off[1:])
    ends = np.cumsum(sizes[own])
    same[own] = off[ends] == off[ends - sizes[own]]
    return same


def align_texts(texts: list[str], a: ByteBpe, b: PieceBpe) -> Aligned:
    """Tokens, groups and links of texts, none of them empty. Those whose bytes differ have no tokens."""
    spaced = [" " + t for t in texts]
    encoded = [s.encode() for s in spaced]
    sizes = np.array([len(e) for e in encoded], np.int64)
    whole = np.frombuffer(b"".join(encoded), np.uint8)
    a_ids, a_of = _encoded(a, spaced)
    b_ids, b_of = _encoded(b, texts)
    keep = _same_bytes(a.vocabulary, a_ids, a_of, whole, sizes) & _same_bytes(b.vocabulary, b_ids, b_of, whole, sizes)
    a_ids, a_of = _kept_tokens(a_ids, a_of, keep)
    b_ids, b_of = _kept_tokens(b_ids, b_of, keep)
    a_end, b_end = np.cumsum(a.vocabulary.lengths(a_ids)), np.cumsum(b.vocabulary.lengths(b_ids))

    has = a_of[1:] > a_of[:-1]
    cuts = shared_cuts(a_end, b_end, a_of[:-1][has], a_of[1:][has])
    a_cut, b_cut = cuts + 1, np.searchsorted(b_end, a_end[cuts]) + 1

    # Every stretch of bytes between two ends lies in one token of each: a link.
    ends = np.sort(np.concatenate([a_end, b_end]), kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    link_a, link_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
    return Aligned(
        a_ids, a_of, b_ids, b_of, a_cut, b_cut,
        np.searchsorted(a_cut, a_of, side="right"), link_a, link_b, np.searchsorted(link_a, a_of),
    )


_COMMA, _BAR, _SEMICOLON = b",|;"


def _decimals(ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Right-aligned digits of each id and the separator after them, and which of these show."""
    places = len(str(ids.max(initial=0)))
    out = np.zeros((len(ids), places + 1), np.uint8)
    show = np.ones((len(ids), places + 1), bool)
    out[:, places] = separators
    left = ids
    for place in range(places - 1, -1, -1):
        rest = left // 10
        out[:, place] = 48 + left - 10 * rest
        show[:, place] = (left > 0) if place < places - 1 else True
        left = rest
    return out, show


def group_texts(found: Aligned) -> Iterator[bytes]:
    """The groups of each text as `a1,a2|b1;a3|b2,b3`."""
    after_a = np.full(len(found.a), _COMMA, np.uint8)
    after_a[found.a_cut - 1] = _BAR
    after_b = np.full(len(found.b), _COMMA, np.uint8)
    after_b[found.b_cut - 1] = _SEMICOLON
    # A group's tokens of A stand before its tokens of B.
    n_a, n_b = np.diff(found.a_cut, prepend=0), np.diff(found.b_cut, prepend=0)
    total = len(found.a) + len(found.b)
    ids, after = np.zeros(total, np.int32), np.zeros(total, np.uint8)
    at = np.arange(len(found.a)) + np.repeat(found.b_cut - n_b, n_a)
    ids[at], after[at] = found.a, after_a
    at = np.arange(len(found.b)) + np.repeat(found.a_cut, n_b)
    ids[at], after[at] = found.b, after_b
    digits, show = _decimals(ids, after)
    written = digits[show].tobytes()
    sizes = np.zeros(total + 1, np.int64)
    np.cumsum(show.sum(axis=1), out=sizes[1:])
    bounds = sizes[found.a_of + found.b_of]
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        # The last separator ends the text.
        yield written[begin : max(begin, end - 1)]


# -- over a table


def _pairs(found: Aligned, ids_of_b: int) -> np.ndarray:
    """A number for the id pair of each link."""
    return found.a[found.link_a].astype(np.int64) * ids_of_b + found.b[found.link_b]


def align_tokens(
    docs: DataFrame,
    byte_bpe: str,
    piece_bpe: str,
    text: str = "text",
    keep: list[str] | None = None,
    digest: bool = False,
) -> DataFrame:
    """`docs` with token, group and link counts, how common its links are, and its groups as text.

    `byte_bpe` and `piece_bpe` are paths of vocabulary files on the driver. Of the links of a text, `n_best`
    have the highest count of all pairs of their id of B, and `count_sum` is the sum of their counts. With
    `digest` there is `groups_sha256`, the lower-case hex digest of the groups (empty without any), in place
    of `groups`.
    """
    spark = docs.sparkSession
    last = "groups_sha256" if digest else "groups"
    names = [*COUNTS, *SUMS, last]
    columns = kept_columns(docs, names, keep)
    kept = [docs.schema[c] for c in columns]
    files = spark.sparkContext.broadcast((Path(byte_bpe).read_bytes(), Path(piece_bpe).read_bytes()))

    made = [
        *[T.StructField(n, T.LongType()) for n in COUNTS],
        T.StructField(last, T.StringType()),
        T.StructField("_piece", T.LongType()),
        # Of a text: its distinct pairs. Of a piece, whose rows have no counts: those of all its texts.
        T.StructField("_pairs", T.BinaryType()),
        T.StructField("_times", T.BinaryType()),
        T.StructField("_ids_of_b", T.LongType()),
    ]
    fields = [T.StructField(f"_kept_{k}", f.dataType) for k, f in enumerate(kept)] + made
    kinds = [_arrow_type(f.dataType) for f in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        a = b = None
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch, "_text_", PIECE_BYTES):
                if a is None:
                    a, b = ByteBpe(files.value[0]), PieceBpe(files.value[1])
                rows, whole = _of_piece(piece, a, b, digest)
                n, width = piece.num_rows, len(b.vocabulary.offsets) - 1
                values = [*rows[:5], [number] * n, *rows[5:], [width] * n]
                arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(columns)], *arrays], [f.name for f in fields])
                if whole is not None:
                    values = [[None]] * 5 + [[number], [whole[0]], [whole[1]], [width]]
                    arrays = [pa.nulls(1, c.type) for c in piece.columns[: len(columns)]]
                    arrays += [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])
                number += 1
            release()

    source = docs.select(
        *[F.col(f"`{c}`").alias(f"_kept_{k}") for k, c in enumerate(columns)],
        F.col(f"`{text}`").cast("string").cast("binary").alias("_text_"),
    )
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    staged, _ = stage(source.mapInArrow(run, nullable), "alignment")
    return _with_sums(staged, kept, last).select(
        *[F.col(f"_kept_{k}").alias(c) for k, c in enumerate(columns)], *names
    )


def _of_piece(piece: pa.RecordBatch, a: ByteBpe, b: PieceBpe, digest: bool):
    """Result columns for the texts of a piece, and the packed pairs of all of them."""
    data, offsets = utf8(piece.column("_text_"))
    raw = data.tobytes()
    texts, own = [], []
    for k in range(piece.num_rows):
        try:
            decoded = raw[offsets[k] : offsets[k + 1]].decode()
        except UnicodeDecodeError:
            continue
        if decoded:
            texts.append(decoded)
            own.append(k)
    n = piece.num_rows
    counts = np.zeros((4, n), np.int64)
    groups, pairs, times = [""] * n, [b""] * n, [b""] * n
    whole = None
    if texts:
        found = align_texts(texts, a, b)
        for row, of in enumerate((found.a_of, found.b_of, found.group_of, found.link_of)):
            counts[row, own] = np.diff(of)
        for k, written in zip(own, group_texts(found), strict=True):
            if written:
                groups[k] = hashlib.sha256(written).hexdigest() if digest else written.decode()
        ids_of_b = len(b.vocabulary.offsets) - 1
        keys = _pairs(found, ids_of_b)
        for k, begin, end in zip(own, found.link_of[:-1], found.link_of[1:], strict=True):
            if end > begin:
                distinct, how_often = np.unique(keys[begin:end], return_counts=True)
                pairs[k], times[k] = pack(distinct, "<u8"), pack(how_often, "<u4")
        if len(keys):
            distinct, how_often = np.unique(keys, return_counts=True)
            whole = pack(distinct, "<u8"), pack(how_often, "<u4")
    return [*counts, groups, pairs, times], whole


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, pairs, times, width in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            keys = unpack(pairs, "<u8").astype(np.int64)
            counts = unpack(times, "<u4").astype(np.int64)
            ids = (keys % width).astype(np.int32)
            pieces_ = pa.array(np.full(len(keys), piece))
            yield pa.RecordBatch.from_arrays([pieces_, pa.array(keys), pa.array(ids), pa.array(counts)], ["_piece", "pair", "b", "n"])


def _with_sums(staged: DataFrame, kept: list[T.StructField], last: str) -> DataFrame:
    """The rows of texts, with the sums over their pairs' counts in all texts."""
    of_pieces = staged.filter("n_a is null").select("_piece", "_pairs", "_times", "_ids_of_b")
    asked = of_pieces.mapInArrow(_unpacked, "_piece long, pair long, b int, n long")
    counts = asked.groupBy("pair", "b").agg(F.sum("n").alias("count"))
    counts, _ = stage(counts, "pair-counts")
    # One row for each id of B, so its size is bounded by the vocabulary.
    highest = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("_highest")))
    counts = counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("_highest")).alias("best"))
    answers = asked.select("_piece", "pair").join(counts, "pair").select("_piece", "pair", "count", "best")
    texts = staged.filter("n_a is not null").drop("_ids_of_b")

    fields = [T.StructField(f"_kept_{k}", f.dataType) for k, f in enumerate(kept)]
    fields += [T.StructField(n, T.LongType()) for n in (*COUNTS, *SUMS)] + [T.StructField(last, T.StringType())]
    names = [f.name for f in fields]

    def summed(rows: pa.Table, sums: pa.Table) -> pa.Table:
        keys = sums.column("pair").to_numpy()
        order = np.argsort(keys)
        keys = keys[order]
        count, best = sums.column("count").to_numpy()[order], sums.column("best").to_numpy()[order]
        n_best, count_sum = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        for k, (pairs, times) in enumerate(zip(rows.column("_pairs"), rows.column("_times"), strict=True)):
            if packed := pairs.as_py():
                at = np.searchsorted(keys, unpack(packed, "<u8").astype(np.int64))
                n = unpack(times.as_py(), "<u4").astype(np.int64)
                n_best[k], count_sum[k] = n[best[at]].sum(), (n * count[at]).sum()
        out = rows.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))
        return out.select(names)

    both = texts.groupBy("_piece").cogroup(answers.groupBy("_piece"))
    return both.applyInArrow(summed, T.StructType(fields))
