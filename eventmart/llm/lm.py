"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions; a decision's context is the bytes before it, up to `DEPTH`, and the
bits of its own byte so far. Every node of the context tree has a Krichevsky-Trofimov estimate from the
zeros and ones seen there, and the tree mixes the estimates of all depths by the weights of the training
data: P(node) = 1/2 KT(node) + 1/2 P(children). A text's score is the log probability of its bytes and an
end mark (byte 0), each given the four before it; bytes before the first are 0.

The counts cover all training documents, and are made by jobs: n-grams are counted in tasks and summed by
key. Every context seen is kept, as a row of counts in a table that grows with the corpus: buckets of it hold
all contexts that end in some pairs of bytes, and weigh depths 4 to 2; of what is above, 256 contexts and
the root, sums are made by a job. Each piece of texts asks the buckets for its distinct n-grams. A bucket
answers them as they come, so that a task holds one bucket and no more.

`train` gives a tree of bounded size instead: it holds the most frequent contexts, and what is seen at a
node and not below it goes to one further child. Scores do not use it.

Beside it stands an add-one unigram model of lower-cased words over exact counts of all words.

Defined cases: a null text is empty and has its end only; rows with a null id are scored, and not learned
from; repeated rows are documents of their own; with nothing to learn from, every bit has probability 1/2
and no token is known.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.arrow import emit, kept_columns, release, utf8
from eventmart.llm.buckets import bucket_count, pack, slices, text_bytes, unpack
from eventmart.llm.words import LOWER, NOT_SPACE, bounds, hashes
from eventmart.sources.staging import stage

DEPTH = 4
CONTEXTS = 1 << 14
# Distinct n-grams a task holds before it passes them on.
_HELD = 1 << 20


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with zeros before and an end mark after each; where bytes to predict are; where texts begin
    among those."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    begin = offsets[:-1] + np.arange(n) * (DEPTH + 1) + DEPTH
    line = np.zeros(len(data) + n * (DEPTH + 1), np.uint8)
    line[np.arange(len(data)) + np.repeat(begin - offsets[:-1], lengths)] = data
    places = offsets[:-1] + np.arange(n)
    at = np.arange(len(data) + n) + np.repeat(begin - places, lengths + 1)
    return line, at, places


def _keys(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each byte to predict with its context: the byte lowest, then the nearest before it."""
    key = line[at].astype(np.uint64)
    for d in range(1, DEPTH + 1):
        key |= line[at - d].astype(np.uint64) << np.uint64(8 * d)
    return key


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(counts, heads)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of n-grams, ascending, and which of them each key is."""
    if len(keys) > 1 << 24:
        return np.unique(keys, return_inverse=True)
    # A key has 40 bits, so that key and place sort as one number.
    both = keys << np.uint64(24)
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    keys = both >> np.uint64(24)
    both &= np.uint64((1 << 24) - 1)
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    keys, rank = keys[head], np.cumsum(head)
    rank -= 1
    place = np.empty(len(head), np.int64)
    place[both.view(np.int64)] = rank
    return keys, place


def _ngrams(training: DataFrame, text: str) -> DataFrame:
    """(key, n): how often each byte follows each context."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])

    def make():
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def passed_on():
            if not held:
                return None
            keys, counts = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            held.clear()
            return keys, counts

        def work(texts, batch):
            line, at, _ = _padded(*utf8(texts))
            keys = np.sort(_keys(line, at))
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            held.append((keys[heads], np.diff(np.append(heads, len(keys)))))
            if sum(len(k) for k, _ in held) < 2 * _HELD:
                return None
            keys, counts = passed_on()
            if len(keys) < _HELD:
                held.append((keys, counts))
                return None
            return {"key": keys.astype(np.int64), "n": counts}

        def last():
            found = passed_on()
            return found and {"key": found[0].astype(np.int64), "n": found[1]}

        work.last = last
        return work

    return emit(training, text, schema, make).groupBy("key").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma(x) for x > 0, by Stirling's series from 8 on."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    inverse = 1 / (y * y)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def _bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones seen at the 255 decisions of a byte, from the counts of its 256 values."""
    heap = np.zeros((len(counts), 512))
    heap[:, 256:] = counts
    for i in range(255, 0, -1):
        heap[:, i] = heap[:, 2 * i] + heap[:, 2 * i + 1]
    return heap[:, 2:512:2], heap[:, 3:512:2]


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - math.log(math.pi)


class ContextTree:
    """A context tree with fixed counts, as two tables: where a byte of context leads, and the log10
    probabilities of the next byte."""

    def __init__(self, contexts: list[tuple[int, int]], counts: np.ndarray):
        """`contexts`: (depth, bytes) of each node, the nearest byte lowest; parents before children, the
        root first. `counts`: how often each byte followed."""
        n = len(contexts)
        number = {c: k for k, c in enumerate(contexts)}
        parent = np.zeros(n, np.int64)
        # A state below n is a node that may go on; state n + k has ended at node k.
        step = np.repeat(np.concatenate([np.arange(n, 2 * n)] * 2).astype(np.uint16)[:, None], 256, axis=1)
        rest = counts.astype(np.float64).copy()
        for k, (depth, context) in enumerate(contexts[1:], 1):
            parent[k] = number[depth - 1, context & ((1 << (8 * (depth - 1))) - 1)]
            step[parent[k], context >> (8 * (depth - 1))] = k
            rest[parent[k]] -= counts[k]
        depths = np.array([d for d, _ in contexts])
        weighted = np.zeros((n, 255))
        below = np.zeros((n, 255))
        stop = np.zeros((n, 255))
        for depth in range(DEPTH, -1, -1):
            for own in np.array_split(np.flatnonzero(depths == depth), 1 + np.sum(depths == depth) // 1024):
                kt = _log_kt(*_bits(counts[own]))
                if depth == DEPTH:
                    weighted[own], stop[own] = kt, 1.0
                else:
                    split = below[own] + _log_kt(*_bits(rest[own]))
                    weighted[own] = np.logaddexp(kt, split) - math.log(2)
                    stop[own] = 1 / (1 + np.exp(np.minimum(split - kt, 700)))
                if depth:
                    np.add.at(below, parent[own], weighted[own])
        # Down the tree: what the nodes above give, and the weight left for those below.
        given, left = below, weighted
        table = np.zeros((n, 256), np.float32)
        for depth in range(DEPTH + 1):
            for own in np.array_split(np.flatnonzero(depths == depth), 1 + np.sum(depths == depth) // 1024):
                zeros, ones = _bits(counts[own])
                above = given[parent[own]] if depth else np.zeros((len(own), 255))
                weight = left[parent[own]] if depth else np.ones((len(own), 255))
                one = above + weight * stop[own] * (ones + 0.5) / (zeros + ones + 1)
                given[own], left[own] = one, weight * (1 - stop[own])
                zeros, ones = _bits(rest[own])
                one = one + left[own] * (ones + 0.5) / (zeros + ones + 1)
                log = np.zeros((len(own), 512))
                for i in range(1, 256):
                    log[:, 2 * i] = log[:, i] + np.log10(1 - one[:, i - 1])
                    log[:, 2 * i + 1] = log[:, i] + np.log10(one[:, i - 1])
                table[own] = log[:, 256:]
        self.step, self.table = step, table

    def log10(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each byte to predict, given those before it."""
        step, n = self.step.reshape(-1), len(self.table)
        state = step[line[at - 1]].astype(np.int32)
        for d in range(2, DEPTH + 1):
            state = step[(state << 8) | line[at - d]].astype(np.int32)
        state[state >= n] -= n
        return self.table.reshape(-1)[(state << 8) | line[at]]


def train(training: DataFrame, text: str = "text", contexts: int = CONTEXTS) -> ContextTree:
    """The tree of all texts of `training`."""
    grams, _ = stage(_ngrams(training, text), "ngrams")
    grams = grams.withColumn("byte", F.col("key").bitwiseAND(F.lit(255)))
    depth = F.explode(F.sequence(F.lit(0), F.lit(DEPTH)))
    every = grams.withColumn("depth", depth)
    mask = F.expr("shiftleft(1L, 8 * depth) - 1")
    every = every.withColumn("context", F.shiftright("key", 8).bitwiseAND(mask))
    sums = every.filter("depth > 0").groupBy("depth", "context").agg(F.sum("n").alias("n"))
    # A parent is at least as frequent as its children and comes before them.
    rows = sums.orderBy(F.desc("n"), "depth", "context").limit(contexts).collect()
    nodes = [(0, 0), *((r["depth"], r["context"]) for r in rows)]
    known = grams.sparkSession.createDataFrame(
        [(k, d, c) for k, (d, c) in enumerate(nodes)], "node int, depth int, context long"
    )
    counted = every.join(F.broadcast(known), ["depth", "context"]).groupBy("node", "byte").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    counts = np.zeros((len(nodes), 256))
    counts[found["node"].to_numpy(np.int64), found["byte"].to_numpy(np.int64)] = found["n"].to_numpy()
    return ContextTree(nodes, counts)


class TopContexts:
    """The root and the contexts of one byte: what they give to a bit being one, and the weight left for
    those below, at (byte << 8 | node)."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        z, o, b = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 16)
        z[nodes], o[nodes], b[nodes] = zeros, ones, below
        kt = _kt(z, o)
        stop = _stop(kt, b)
        weighted = np.logaddexp(kt, b) - math.log(2)
        z0, o0 = z.reshape(256, 256).sum(axis=0), o.reshape(256, 256).sum(axis=0)
        stop0 = _stop(_kt(z0, o0), weighted.reshape(256, 256).sum(axis=0))
        given, left = np.tile(stop0 * (o0 + 0.5) / (z0 + o0 + 1), 256), np.tile(1 - stop0, 256)
        self.given, self.left = given + left * stop * (o + 0.5) / (z + o + 1), left * (1 - stop)


_SMALL = 1 << 12
_LOG_HALF, _LOG_ONE = _log_gamma(np.arange(_SMALL) + 0.5), _log_gamma(np.arange(_SMALL) + 1.0)


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """`_log_kt` of whole numbers, most of which are small."""
    total = zeros + ones
    out = np.empty(len(total))
    small = total < _SMALL
    out[small] = _LOG_HALF[zeros[small]] + _LOG_HALF[ones[small]] - _LOG_ONE[total[small]] - math.log(math.pi)
    out[~small] = _log_kt(zeros[~small].astype(np.float64), ones[~small].astype(np.float64))
    return out


def _stop(kt: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The weight of a node's own estimate against those below it."""
    return 1 / (1 + np.exp(np.minimum(below - kt, 700)))


def _ordered(keys: np.ndarray) -> np.ndarray:
    """Keys with the nearest byte of the context highest and the byte to predict lowest."""
    flipped = keys & np.uint64(255)
    for d in range(1, DEPTH + 1):
        flipped |= ((keys >> np.uint64(8 * d)) & np.uint64(255)) << np.uint64(8 * (DEPTH + 1 - d))
    return flipped.astype(np.int64)


class BucketContexts:
    """All contexts of two to four bytes of a bucket, in ascending ordered keys, bit by bit of the next byte."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.bits, self.top, self.own = keys, [], None, None
        grams = [(keys, counts)]
        for _ in range(DEPTH - 2):
            last, n = grams[-1]
            grams.append(_summed((last >> 16) << 8 | (last & 255), n) if len(last) else (last, n))
        rows = []
        for k in range(8):
            levels, ids, weighted = [], None, None
            for own, n in grams:
                found, zeros, ones = self._nodes(own, n, k)
                kt = _kt(zeros, ones)
                if ids is None:
                    weighted, stop = kt, np.ones(len(found))
                else:
                    below = np.bincount(np.searchsorted(found, self._parent(ids)), weighted, len(found))
                    weighted, stop = np.logaddexp(kt, below) - math.log(2), _stop(kt, below)
                ids = found
                levels.append((ids, stop, (ones + 0.5) / (zeros + ones + 1)))
            self.bits.append(levels[::-1])
            rows.append((self._parent(ids), zeros, ones, weighted))
        # What the contexts of one byte sum up.
        self.above = [np.concatenate(c) for c in zip(*rows, strict=True)]

    @staticmethod
    def _parent(ids: np.ndarray) -> np.ndarray:
        return (ids >> 16) << 8 | (ids & 255)

    @staticmethod
    def _nodes(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context << 8 | node) at the k-th bit, with its zeros and ones."""
        if not len(keys):
            return keys, counts, counts
        byte = keys & 255
        ids = (keys >> 8) << 8 | 1 << k | byte >> (8 - k)
        heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        total = np.add.reduceat(counts, heads)
        ones = np.add.reduceat(counts * (byte >> (7 - k) & 1), heads)
        return ids[heads], total - ones, ones

    def _path(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys))
        byte = keys & 255
        for k, levels in enumerate(self.bits):
            node = 1 << k | byte >> (8 - k)
            at = (keys >> 8 * DEPTH) << 8 | node
            one, left = self.top.given[at], self.top.left[at]
            for d, (ids, stop, p) in enumerate(levels, 2):
                wanted = (keys >> 8 * (DEPTH + 1 - d)) << 8 | node
                place = np.searchsorted(ids, wanted)
                seen = np.flatnonzero(place < len(ids))
                seen = seen[ids[place[seen]] == wanted[seen]]
                # Below what was not seen either bit is as likely.
                share, mean = np.ones(len(keys)), np.full(len(keys), 0.5)
                share[seen], mean[seen] = stop[place[seen]], p[place[seen]]
                one, left = one + left * share * mean, left * (1 - share)
            out += np.log10(np.where(byte >> (7 - k) & 1, one, 1 - one))
        return out

    def log10(self, keys: np.ndarray, top: TopContexts) -> np.ndarray:
        """Of the byte of each ordered key, given its context."""
        if self.top is not top:
            self.top = top
            cuts = range(0, len(self.keys), _HELD >> 2)
            self.own = np.concatenate([np.zeros(0), *[self._path(self.keys[i : i + (_HELD >> 2)]) for i in cuts]])
        place = np.searchsorted(self.keys, keys)
        out = np.zeros(len(keys))
        seen = np.flatnonzero(place < len(self.keys))
        seen = seen[self.keys[place[seen]] == keys[seen]]
        out[seen] = self.own[place[seen]]
        rest = np.ones(len(keys), bool)
        rest[seen] = False
        out[rest] = self._path(keys[rest])
        return out


_MODEL = "bucket int, keys binary, counts binary, node int, zeros long, ones long, below long"
# What is summed by a job is summed in whole numbers, so that its order does not matter.
_FIXED = 1 << 24


def _bucket_of(prefix, buckets: int):
    """The bucket of a context's nearest two bytes, of an array or a Column."""
    return (prefix * 40503) % 65536 % buckets


def all_contexts(training: DataFrame, text: str, buckets: int) -> tuple[DataFrame, TopContexts]:
    """(bucket, keys, counts) of every context seen, and those above the buckets."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        keys = _ordered(rows["key"].to_numpy().astype(np.uint64))
        order = np.argsort(keys)
        keys, counts = keys[order], rows["n"].to_numpy(np.int64)[order]
        bucket = int(rows["bucket"].iloc[0])
        node, zeros, ones, below = BucketContexts(keys, counts).above
        below = np.rint(below * _FIXED).astype(np.int64)
        above = pd.DataFrame({"node": node, "zeros": zeros, "ones": ones, "below": below}).groupby("node").sum().reset_index()
        own = pd.DataFrame({"bucket": [bucket], "keys": [pack(keys, "<i8")], "counts": [pack(counts, "<i8")]})
        release()
        made = pd.concat([own, above]).reindex(columns=[c.split()[0] for c in _MODEL.split(", ")])
        return made.astype({c: "Int64" for c in ("bucket", "node", "zeros", "ones", "below")}).replace({np.nan: None})

    prefix = F.shiftright("key", 8).bitwiseAND(F.lit(65535))
    grams = _ngrams(training, text).withColumn("bucket", _bucket_of(prefix, buckets).cast("int"))
    model, _ = stage(grams.groupBy("bucket").applyInPandas(reduce, _MODEL), "contexts")
    # At most one row for each byte and node, whatever the corpus.
    above = model.filter("node is not null").groupBy("node")
    above = above.agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toPandas()
    top = TopContexts(*[above[c].to_numpy(np.int64) for c in ("node", "zeros", "ones")], above["below"].to_numpy() / _FIXED)
    return model.filter("keys is not null").select("bucket", "keys", "counts"), top


_PIECES = T.StructType(
    [T.StructField("piece", T.LongType())]
    + [T.StructField(c, T.BinaryType()) for c in ("documents", "learns", "offsets", "data")]
)


def _pieces(docs: DataFrame, key: Column, learns: Column, text: str) -> DataFrame:
    """The texts in packed pieces, staged, so that a piece keeps its name in all that is made of it."""

    def make():
        def work(texts, batch):
            data, offsets = utf8(texts)
            return {
                "piece": [int.from_bytes(os.urandom(8), "little", signed=True)],
                "documents": [pack(batch.column("_also_key").to_numpy(), "<i8")],
                "learns": [pack(batch.column("_also_learns").to_numpy(zero_copy_only=False), "u1")],
                "offsets": [pack(offsets, "<i8")],
                "data": [zlib.compress(data.tobytes(), 1)],
            }

        return work

    return stage(emit(docs, text, _PIECES, make, {"key": key, "learns": learns}), "pieces")[0]


def _opened(data: bytes, offsets: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zlib.decompress(data), np.uint8), unpack(offsets, "<i8")


def _asked(pieces: DataFrame, names: list[str], ask) -> DataFrame:
    """(piece, bucket, ...): what each piece asks the buckets, a row for each that it asks. `ask` gives
    the columns from the data, offsets and learning documents of a piece."""
    schema = T.StructType(
        [T.StructField("piece", T.LongType()), T.StructField("bucket", T.IntegerType())]
        + [T.StructField(c, T.BinaryType()) for c in names]
    )
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, learns, offsets, data in zip(*batch.columns, strict=True):
                columns = ask(*_opened(data.as_buffer(), offsets.as_buffer()), unpack(learns.as_buffer(), "u1"))
                made = [[piece.as_py()] * len(columns[0]), *columns]
                made = [pa.array(c, kind) for c, kind in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(made, schema.fieldNames())
            release()

    return pieces.select("piece", "learns", "offsets", "data").mapInArrow(run, schema)


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct keys by bucket, and where each bucket begins and the last one ends."""
    prefix = (keys >> np.uint64(8)).astype(np.int64) & 65535
    own = _bucket_of(prefix, buckets).astype(np.uint16)
    order = np.argsort(own, kind="stable")
    return order, np.searchsorted(own[order], np.arange(buckets + 1))


_LOGS = T.StructType(
    [T.StructField("piece", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("logs", T.BinaryType())]
)


def _byte_logs(pieces: DataFrame, training: DataFrame, text: str, buckets: int) -> DataFrame:
    """(piece, bucket, logs): log10 of each distinct n-gram of a piece that is of the bucket, in order."""
    model, top = all_contexts(training, text, buckets)

    def ask(data, offsets, learns):
        line, at, _ = _padded(data, offsets)
        keys = _keys(line, at)
        del line, at
        keys.sort()
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        order, cuts = _by_bucket(keys, buckets)
        keys = _ordered(keys[order])
        own = np.flatnonzero(cuts[1:] > cuts[:-1])
        return own, [pack(keys[cuts[b] : cuts[b + 1]], "<i8") for b in own]

    asked = _asked(pieces, ["keys"], ask)
    asked = asked.select("bucket", "piece", "keys", F.lit(None).cast("binary").alias("counts"))
    model = model.select("bucket", F.lit(None).cast("long").alias("piece"), "keys", "counts")
    # A bucket's contexts come before what is asked of it.
    dealt = model.unionByName(asked).repartition(buckets, "bucket")
    dealt = dealt.sortWithinPartitions("bucket", F.col("counts").isNull())
    # Plain arrays, so that executors need no copy of the package.
    sent = pieces.sparkSession.sparkContext.broadcast((top.given, top.left))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, left = sent.value
        top, current, contexts = SimpleNamespace(given=given, left=left), None, None
        # What many pieces ask of a bucket is answered at once: a piece asks ever less of each of more buckets.
        held: list[tuple[int, np.ndarray]] = []

        def answered() -> Iterator[pa.RecordBatch]:
            if held:
                cuts = np.cumsum([0, *(len(own) for _, own in held)])
                logs = contexts.log10(np.concatenate([own for _, own in held]), top)
                logs = [pack(logs[a:b], "<f4") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [[piece for piece, _ in held], [current] * len(held), logs]
                made = [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int32(), pa.binary()), strict=True)]
                held.clear()
                yield pa.RecordBatch.from_arrays(made, _LOGS.fieldNames())

        size = 0
        for batch in batches:
            for bucket, piece, keys, counts in zip(*batch.columns, strict=True):
                if bucket.as_py() != current or size >= _HELD >> 2:
                    yield from answered()
                    size = 0
                if bucket.as_py() != current:
                    none = np.zeros(0, np.int64)
                    current, contexts = bucket.as_py(), BucketContexts(none, none)
                own = unpack(keys.as_buffer(), "<i8")
                if counts.is_valid:
                    contexts = BucketContexts(own, unpack(counts.as_buffer(), "<i8"))
                    continue
                held.append((piece.as_py(), own))
                size += len(own)
        yield from answered()
        release()

    return dealt.mapInArrow(answer, _LOGS)


# Bytes of text for each bucket of words, of which a piece asks once for each.
_WORD_BUCKET = 32 << 20
_COUNTS = "piece long, bucket int, counts binary, distinct long, tokens long"


def _word_counts(pieces: DataFrame, buckets: int) -> tuple[DataFrame, int, int]:
    """(piece, bucket, counts): how often each distinct word of a piece that is of the bucket is in training
    documents, in order; distinct training words, and training words.

    No row is about a document: a piece sends each of its words once and gets a count for it, however many
    documents and buckets there are.
    """

    def ask(data, offsets, learns):
        words, documents = _words(data, offsets)
        words, place = np.unique(words, return_inverse=True)
        times = np.bincount(place, learns[documents], len(words))
        cuts = slices(words, buckets)
        own = np.flatnonzero(cuts[1:] > cuts[:-1])
        hashed, times = ([pack(c[cuts[b] : cuts[b + 1]], kind) for b in own] for c, kind in ((words, "<u8"), (times, "<u4")))
        return own, hashed, times

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        words = [unpack(b, "<u8") for b in rows["hash"]]
        cuts = np.cumsum([0, *map(len, words)])
        words = np.concatenate(words)
        times = np.concatenate([unpack(b, "<u4") for b in rows["times"]]).astype(np.int64)
        order = np.argsort(words)
        heads = np.flatnonzero(np.concatenate([[True], words[order][1:] != words[order][:-1]]))
        seen = np.add.reduceat(times[order], heads)
        count = np.empty(len(words), np.int64)
        count[order] = np.repeat(seen, np.diff(np.append(heads, len(words))))
        bucket = int(rows["bucket"].iloc[0])
        out = [
            (piece, bucket, pack(count[a:b], "<i8"), 0, 0)
            for piece, a, b in zip(rows["piece"].tolist(), cuts[:-1], cuts[1:], strict=True)
        ]
        out.append((None, bucket, None, int((seen > 0).sum()), int(seen.sum())))
        found = pd.DataFrame(out, columns=[c.split()[0] for c in _COUNTS.split(", ")])
        found["piece"] = pd.array([r[0] for r in out], "Int64")
        release()
        return found

    asked = _asked(pieces, ["hash", "times"], ask)
    counts, seen = stage(
        asked.groupBy("bucket").applyInPandas(reduce, _COUNTS), "words", distinct=F.sum("distinct"), tokens=F.sum("tokens")
    )
    counts = counts.filter("piece is not null").select("piece", "bucket", "counts")
    return counts, int(seen["distinct"] or 0), int(seen["tokens"] or 0)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each lower-cased word, and its text."""
    data = LOWER[data]
    starts, ends, at = bounds(data, offsets, NOT_SPACE)
    return hashes(data, starts, ends), np.repeat(np.arange(len(offsets) - 1), np.diff(at))


_SUMS = "_sum_key_ long, _words_ long, _known_ long, _weight_ double, score double"


def _sums(pieces: DataFrame, logs: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """(_sum_key_, _words_, _known_, _weight_, score) of each document."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bucket")
        own = rows[rows["data"].notna()].iloc[0]
        data, offsets = _opened(own["data"], own["offsets"])
        line, at, first = _padded(data, offsets)
        keys = _keys(line, at)
        del line, at
        keys, place = _distinct(keys)
        order, _ = _by_bucket(keys, buckets)
        logs = np.empty(len(keys))
        logs[order] = np.concatenate([unpack(b, "<f4") for b in rows["logs"].dropna()])
        score = np.add.reduceat(logs[place], first)
        del keys, place, order, logs
        words, documents = _words(data, offsets)
        words, place = np.unique(words, return_inverse=True)
        counts = np.concatenate([np.zeros(0, np.int64), *[unpack(b, "<i8") for b in rows["counts"].dropna()]])[place]
        n = len(score)
        made = {
            "_sum_key_": unpack(own["documents"], "<i8"),
            "_words_": np.bincount(documents, minlength=n),
            "_known_": np.bincount(documents, counts > 0, n).astype(np.int64),
            "_weight_": np.bincount(documents, np.log10(counts + 1.0), n),
            "score": score,
        }
        release()
        return pd.DataFrame(made)

    both = pieces.drop("learns").unionByName(logs, allowMissingColumns=True)
    sums = both.unionByName(counts, allowMissingColumns=True).groupBy("piece").applyInPandas(add, _SUMS)
    # Rows alike in id and text have one key and the same sums.
    names = [c.split()[0] for c in _SUMS.split(", ")]
    return sums.groupBy(names[0]).agg(*[F.max(c).alias(c) for c in names[1:]])


RESULTS = T.StructType(
    [
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def score(
    docs: DataFrame,
    learn: Column,
    id_: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """`docs` with both models' log10 probabilities of each text. The models learn from rows where `learn`
    is true; `held_out` is where it is false."""
    columns = kept_columns(docs, RESULTS.fieldNames(), keep)
    value = F.col(f"`{text}`").cast("string")
    key = F.xxhash64(F.col(f"`{id_}`").cast("string"), value)
    # A null condition teaches nothing and holds nothing out.
    learns = F.coalesce(learn, F.lit(False))
    training = docs.filter(learns)
    # A context's nearest two bytes are in one bucket.
    n_bytes = text_bytes(docs, text)
    buckets = min(bucket_count(n_bytes), 1 << 15)
    pieces = _pieces(docs, key, learns, text)
    counts, distinct, tokens = _word_counts(pieces, bucket_count(n_bytes, _WORD_BUCKET))
    logs = _byte_logs(pieces, training, text, buckets)
    sums = _sums(pieces, logs, counts, buckets)
    size = F.coalesce(F.octet_length(value), F.lit(0)) + 1
    scored = docs.select(*[F.col(f"`{c}`") for c in columns], key.alias("_key_"), size.alias("_size_"),
                         F.coalesce(~learn, F.lit(False)).alias("_held_"))

    documents = training.count()
    distinct, tokens = distinct + (documents > 0), tokens + documents
    joined = scored.join(sums, F.col("_key_") == F.col("_sum_key_"))
    n_tokens = F.col("_words_") + 1
    known = F.col("_known_") + int(documents > 0)
    weight = F.col("_weight_") + math.log10(documents + 1)
    return joined.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_held_").alias("held_out"),
        n_tokens.alias("n_tokens"),
        known.alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (weight - n_tokens * math.log10(tokens + distinct + 1)).alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / F.col("_size_")).alias("bits_per_byte"),
    )
