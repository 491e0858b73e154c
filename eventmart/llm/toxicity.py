"""Toxicity by a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A text is lower-cased, and every run of other characters than letters and digits is one space. Its features are which n-grams
of three to five characters it has, within words and with the spaces around them, hashed to `FEATURES` columns. A
column's value is the log ratio of how common it is among training documents of label 1 and of label 0; the
columns' counts cover all of them. Columns with evidence of `EVIDENCE` or more (G-squared of column and label) are
kept, at most the `SELECTED` best. Their weights are those of a logistic regression with an L2 penalty.

The regression is fitted on a sample, which is the one bound here: of each label at most `SAMPLE` documents, those
with the smallest hashes of their ids. Its intercept is then moved from the sample's share of label 1 to that of all
training documents.

Defined cases: a null text counts as empty, and an empty text has the score of the intercept alone. Labels without
an id or a value teach nothing; a document with several labels has the largest; repeated documents count each.
With documents of one label alone, or none, the score is the share of label 1, or 0. An empty table gives an
empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.arrow import emit, map_texts, utf8
from eventmart.llm.buckets import pack, unpack
from eventmart.sources.staging import stage

BITS = 20
FEATURES = 1 << BITS
SIZES = (3, 4, 5)
SELECTED = 1 << 14
# Least evidence of a column: it is above this by chance in one column of a thousand.
EVIDENCE = 10.83
SAMPLE = 3000
PENALTY = 1.0
# Score from which a text is called toxic.
THRESHOLD = 0.7

RESULTS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SPACE = 32


class Grams:
    """The n-grams of texts. It remembers which characters are letters or digits."""

    def __init__(self):
        self._known = np.zeros(0, bool)

    def _in_words(self, codes: np.ndarray) -> np.ndarray:
        top = int(codes.max(initial=0)) + 1
        if top > len(self._known):
            top = min(0x110000, max(0x400, 2 * top))
            self._known = np.fromiter((chr(c).isalnum() for c in range(top)), bool, top)
        return self._known[codes]

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The columns of all n-grams, and the text of each, ascending."""
        data, offsets = utf8(texts)
        raw = data.tobytes()
        spaced = [f" {raw[a:b].decode(errors='replace').lower()} " for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        codes = np.frombuffer("".join(spaced).encode("utf-32-le"), np.uint32)
        text = np.repeat(np.arange(len(spaced)), [len(s) for s in spaced])
        codes = np.where(self._in_words(codes), codes, _SPACE)
        # One space for a run of them.
        use = np.ones(len(codes), bool)
        use[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE) | (text[1:] != text[:-1])
        codes, text = codes[use].astype(np.uint64), text[use]
        space = codes == _SPACE
        found, owners = [], []
        hashed, inner = codes, np.zeros(max(len(codes) - 1, 0), bool)
        for size in range(2, SIZES[-1] + 1):
            hashed = hashed[:-1] * _STEP + codes[size - 1 :]
            if size > 2:
                inner = inner[:-1] | space[size - 2 : -1]
            if size in SIZES:
                own = np.flatnonzero(~inner & (text[: len(hashed)] == text[size - 1 :]))
                found.append((((hashed[own] + np.uint64(size)) * _SPREAD) >> np.uint64(64 - BITS)).astype(np.int64))
                owners.append(text[own])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(owners)

    def distinct(self, texts, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct columns of each text, of the chosen ones, and the text of each, ascending."""
        columns, text = self(texts)
        if chosen is not None:
            use = chosen[columns]
            columns, text = columns[use], text[use]
        keys = np.unique((text << BITS) | columns)
        return keys & (FEATURES - 1), keys >> BITS


# -- learning

_SEEN = T.StructType(
    [
        # Of a column: in how many documents of each label it is. Of a sampled document: its label and columns.
        T.StructField("column", T.IntegerType()),
        T.StructField("zeros", T.LongType()),
        T.StructField("ones", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("columns", T.BinaryType()),
    ]
)


def _seen(known: DataFrame) -> DataFrame:
    """Counts of columns by task, and the columns of sampled documents."""

    def make():
        grams = Grams()
        counts = np.zeros((2, FEATURES), np.int32)

        def work(texts, batch):
            columns, text = grams.distinct(texts)
            labels = np.array(batch.column("_also_label").to_pylist(), np.int64)
            of = labels[text]
            for label in (0, 1):
                counts[label] += np.bincount(columns[of == label], minlength=FEATURES).astype(np.int32)
            sampled = np.flatnonzero(np.array(batch.column("_also_sampled").to_pylist(), bool))
            bounds = np.searchsorted(text, np.append(sampled, 0)), np.searchsorted(text, np.append(sampled, 0), side="right")
            packed = [pack(columns[a:b], "<u4") for a, b in zip(bounds[0][:-1], bounds[1][:-1], strict=True)]
            none = [None] * len(sampled)
            return {"column": none, "zeros": none, "ones": none, "label": labels[sampled].tolist(), "columns": packed}

        def last():
            own = np.flatnonzero(counts.any(axis=0))
            none = pa.nulls(len(own))
            return {"column": own, "zeros": counts[0][own], "ones": counts[1][own], "label": none, "columns": none}

        work.last = last
        return work

    return emit(known, "text", _SEEN, make, {"label": F.col("label"), "sampled": F.col("sampled")})


def _selected(seen: DataFrame, zeros: int, ones: int) -> tuple[np.ndarray, np.ndarray]:
    """The columns with the most evidence, ascending, and their log-count ratios."""
    counts = seen.filter("column is not null").groupBy("column").agg(F.sum("zeros").alias("q"), F.sum("ones").alias("p"))
    total = zeros + ones

    def share(count, own: int, all_: int):
        # One document more is shared out by the labels, so that what no document has is even.
        return (count + own / total) / (all_ + own / total)

    ratio = F.log(share(F.col("p"), ones, ones) / share(F.col("q"), zeros, zeros))

    def part(observed, of: int, columns):
        expected = columns * of / total
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    present, absent = F.col("p") + F.col("q"), F.lit(total) - F.col("p") - F.col("q")
    evidence = 2 * (
        part(F.col("p"), ones, present) + part(F.col("q"), zeros, present)
        + part(F.lit(ones) - F.col("p"), ones, absent) + part(F.lit(zeros) - F.col("q"), zeros, absent)
    )
    rows = counts.select("column", ratio.alias("ratio"), evidence.alias("evidence"))
    best = rows.filter(F.col("evidence") >= EVIDENCE).orderBy(F.desc("evidence"), "column").limit(SELECTED).select("column", "ratio").collect()
    best.sort()
    return np.array([r[0] for r in best], np.int64), np.array([r[1] for r in best], np.float64)


def fit(columns: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the selected columns and the intercept, by Newton's method with conjugate gradients.

    `columns` are the numbers of the selected columns each document has.
    """
    sizes = np.array([len(c) for c in columns])
    flat = np.concatenate(columns) if len(columns) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(columns)), sizes)
    values = ratios[flat]
    n, width = len(columns), len(ratios)

    def forward(w):
        return np.bincount(row, values * w[flat], minlength=n) + w[width]

    def backward(g):
        return np.append(np.bincount(flat, values * g[row], minlength=width), g.sum())

    ridge = np.append(np.full(width, PENALTY), 1e-6)

    def loss(margin, w):
        return np.logaddexp(0, -(2 * labels - 1) * margin).sum() + 0.5 * (ridge * w * w).sum()

    w = np.zeros(width + 1)
    margin = forward(w)
    for _ in range(30):
        p = 1 / (1 + np.exp(-margin))
        gradient = backward(p - labels) + ridge * w
        if np.abs(gradient).max() < 1e-4 * max(n, 1):
            break
        curve = p * (1 - p)
        step, left = np.zeros_like(w), -gradient
        direction, size = left.copy(), left @ left
        first = size
        for _ in range(40):
            product = backward(curve * forward(direction)) + ridge * direction
            rate = size / (direction @ product)
            step += rate * direction
            left = left - rate * product
            new = left @ left
            if new < 1e-4 * first:
                break
            direction, size = left + new / size * direction, new
        scale, now = 1.0, loss(margin, w)
        while scale > 1e-4 and loss(forward(w + scale * step), w + scale * step) > now + 1e-4 * scale * (gradient @ step):
            scale /= 2
        w = w + scale * step
        margin = forward(w)
    return w[:width], float(w[width])


_FITTED = "weights binary, intercept double"


def train(
    docs: DataFrame, labels: DataFrame, id_: str = "doc_id", text: str = "text", label: str = "toxic"
) -> tuple[np.ndarray, np.ndarray, float]:
    """The model of documents that `labels` knows by id: columns, what each adds to the log odds, and the intercept."""
    own = F.col(f"`{id_}`").cast("string")
    known = labels.select(own.alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.filter("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    known = known.withColumn("key", F.xxhash64("id"))
    texts = docs.select(own.alias("id"), F.col(f"`{text}`").alias("text")).filter("id is not null")
    bound = F.lit(None).cast("long")
    for value in (0, 1):
        # The sampled documents of a label are those up to its bound.
        keys = known.filter(F.col("label") == value).select("key").orderBy("key").limit(SAMPLE)
        highest = keys.agg(F.max("key")).first()[0]
        bound = F.when(F.col("label") == value, F.lit(highest).cast("long")).otherwise(bound)
    # Labels grow with the documents, so neither side is sent to all executors, however few there are.
    rows = texts.join(known.hint("merge"), "id").select("text", "label", (F.col("key") <= bound).alias("sampled"))
    seen, _ = stage(_seen(rows), "toxicity")
    # A document is counted with the labels, not by its columns: an empty text has none.
    totals = {r[0]: r[1] for r in texts.join(known, "id").groupBy("label").count().collect()}
    zeros, ones = totals.get(0, 0), totals.get(1, 0)
    none = np.zeros(0, np.int64), np.zeros(0)
    if not zeros or not ones:
        return *none, np.inf if ones else -np.inf
    columns, ratios = _selected(seen, zeros, ones)

    def fitted(batches):
        found, labels_ = [], []
        for batch in batches:
            for value, packed in zip(batch.column("label").to_pylist(), batch.column("columns"), strict=True):
                own = unpack(packed.as_py(), "<u4").astype(np.int64)
                found.append(own)
                labels_.append(value)
        y = np.array(labels_, np.float64)
        weights, intercept = fit(found, y, ratios)
        intercept += np.log(ones / zeros) - np.log(max(y.sum(), 1) / max((1 - y).sum(), 1))
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([intercept])], ["weights", "intercept"])

    def narrowed(batches):
        for batch in batches:
            packed = []
            for blob in batch.column("columns"):
                own = unpack(blob.as_py(), "<u4").astype(np.int64)
                packed.append(pack(np.searchsorted(columns, own[np.isin(own, columns)]), "<u4"))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(packed, pa.binary())], ["label", "columns"])

    sample = seen.filter("label is not null").select("label", "columns").mapInArrow(narrowed, "label int, columns binary")
    # In one order, whatever the files, so that the same rows give the same weights.
    ordered = sample.repartition(1).sortWithinPartitions("label", "columns")
    row = ordered.mapInArrow(fitted, _FITTED).first()
    return columns, np.frombuffer(row["weights"], np.float64) * ratios, row["intercept"]


def score(docs: DataFrame, model: tuple, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with the score, from 0 to 1, and whether it reaches the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        columns, values, intercept = sent.value
        grams = Grams()
        chosen, weights = np.zeros(FEATURES, bool), np.zeros(FEATURES)
        chosen[columns], weights[columns] = True, values

        def work(texts, batch):
            own, of = grams.distinct(texts, chosen)
            odds = np.bincount(of, weights[own], minlength=len(texts)) + intercept
            found = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
            found[odds == -np.inf], found[odds == np.inf] = 0.0, 1.0
            return {"score": found, "predicted": (found >= THRESHOLD).astype(np.int32)}

        return work

    return map_texts(docs, text, RESULTS, make, keep)
