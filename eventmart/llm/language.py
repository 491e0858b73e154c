"""Language identification by the nearest of several centroids for each language.

A text is a vector of TF-IDF weights of its byte n-grams (two and three bytes of lower-cased letters, words
set apart by one space), hashed to `FEATURES` columns and scaled to length one. The n-grams' document
frequencies cover all training documents. Each language has up to `CLUSTERS` centroids, from spherical
k-means over a sample of at most `SAMPLE` of its training documents, those with the smallest hashes of
their ids; the sample is the one bound here and only the centroids and the rejection distances depend on
it. Texts are compared with all centroids by cosine; the nearest decides.

A text is rejected if it is further from its centroid than almost any sampled text of its size: its cosine
is below `SLACK` times the smallest of its size class (a power of two of n-grams, or the nearest class
that was sampled).

Defined cases: a null text, or one without a letter, is `und` with score 0 and is rejected; so is every
text if there is no training document. Ties go to the language that comes first by code point. Rows with a
null id are never trained on. Repeated rows are documents of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.arrow import emit, map_texts, utf8
from eventmart.sources.staging import stage

BITS = 12
FEATURES = 1 << BITS
CLUSTERS = 4
SAMPLE = 400
ROUNDS = 12
SLACK = 0.6
UNKNOWN = "und"
# Documents turned into dense rows at once.
_ROWS = 128
_SIZES = 32

RESULTS = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)

# Bytes as the n-grams see them: ASCII letters in lower case, all other ASCII is space. Bytes beyond ASCII
# stay, but for the capitals of Latin-1, which are handled with the byte before them.
_SEEN = np.arange(256, dtype=np.uint8)
_SEEN[:128] = 32
_SEEN[97:123] = np.arange(97, 123)
_SEEN[65:91] = np.arange(97, 123)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of all texts, and the text of each."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = _SEEN[data]
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    seen = np.where(capital, seen + 0x20, seen).astype(np.uint32)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    # One space for a run of them.
    use = np.ones(len(seen), bool)
    use[1:] = (seen[1:] != 32) | (seen[:-1] != 32) | (text[1:] != text[:-1])
    seen, text = seen[use], text[use]
    two = (seen[:-1] << np.uint32(8)) | seen[1:]
    three = (two[:-1] << np.uint32(8)) | seen[2:]
    keep_two = (text[:-1] == text[1:]) & (two != 0x2020)
    keep_three = text[:-2] == text[2:]
    codes = np.concatenate([two[keep_two] | np.uint32(1 << 24), three[keep_three]]).astype(np.uint64)
    codes = (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    return codes.astype(np.int64), np.concatenate([text[:-1][keep_two], text[:-2][keep_three]])


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of n-gram counts for each text."""
    n = len(offsets) - 1
    codes, text = _grams(data, offsets)
    return np.bincount(text * FEATURES + codes, minlength=n * FEATURES).reshape(n, FEATURES)


def _weights(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts).astype(np.float32) * idf
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length == 0, 1, length)


def _size_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts.sum(axis=1), 1)).astype(np.int64), _SIZES - 1)


def _dense(texts, rows: int = _ROWS):
    """(first row, n-gram counts) for a few texts at a time."""
    data, offsets = utf8(texts)
    for a in range(0, len(texts), rows):
        own = offsets[a : a + rows + 1]
        yield a, _counts(data[own[0] : own[-1]], own - own[0])


def _has_letter(texts) -> np.ndarray:
    data, offsets = utf8(texts)
    ascii_letter = np.zeros(len(data) + 1, np.int32)
    np.cumsum((_SEEN[data] != 32) & (data < 128), out=ascii_letter[1:])
    found = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for k in np.flatnonzero(~found):
        value = texts[int(k)].as_py()
        found[k] = value is not None and any(c.isalpha() for c in value)
    return found


@dataclass
class Model:
    """Centroids with their language, weights of the n-grams, and the least cosine by size class."""

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the centroid, cosine, rejected."""
        cosine = np.clip(_weights(counts, self.idf) @ self.centroids.T, 0.0, 1.0)
        best = cosine.argmax(axis=1)
        score = cosine[np.arange(len(best)), best].astype(np.float64)
        return best, score, score < self.least[_size_class(counts)]


def _cluster(rows: np.ndarray) -> np.ndarray:
    """Spherical k-means, from rows far from each other."""
    chosen = [0]
    near = rows @ rows[0]
    while len(chosen) < min(CLUSTERS, len(rows)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centers = rows[chosen]
    for _ in range(ROUNDS):
        own = (rows @ centers.T).argmax(axis=1)
        sums = np.stack([rows[own == k].sum(axis=0) if (own == k).any() else centers[k] for k in range(len(centers))])
        centers = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return centers.astype(np.float32)


_SEEN_ROWS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("key", T.LongType()),
        T.StructField("columns", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)


def train(docs: DataFrame, id_: str = "doc_id", lang: str = "lang", text: str = "text") -> Model | None:
    """The model of labelled documents: rows whose id or language is null teach nothing."""
    known = docs.select(
        F.col(f"`{id_}`").cast("string").alias("id"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{text}`").alias("text"),
    ).filter("id is not null and lang is not null and text is not null")
    known = known.withColumn("key", F.xxhash64("id"))
    # The sampled documents of a language are those below its bound.
    keys = known.groupBy("lang", "key").agg(F.lit(1).alias("_"))
    ranked = keys.selectExpr("lang", "key", "row_number() over (partition by lang order by key) as at")
    bounds = {r[0]: r[1] for r in ranked.filter(F.col("at") <= SAMPLE).groupBy("lang").agg(F.max("key")).collect()}
    if not bounds:
        return None

    def make():
        frequency = np.zeros(FEATURES, np.int64)
        total = 0

        def work(texts, batch):
            nonlocal total
            languages = batch.column("_also_lang").to_pylist()
            keys = batch.column("_also_key").to_pylist()
            sample = [k for k, (name, key) in enumerate(zip(languages, keys, strict=True)) if key <= bounds[name]]
            taken = set(sample)
            columns, counts = [], []
            for a, rows in _dense(texts):
                frequency[:] += (rows > 0).sum(axis=0)
                total += len(rows)
                for k in range(len(rows)):
                    if a + k in taken:
                        own = np.flatnonzero(rows[k])
                        columns.append(own.astype("<u2").tobytes())
                        counts.append(rows[k][own].astype("<u4").tobytes())
            out = {"lang": [languages[k] for k in sample], "key": [keys[k] for k in sample]}
            return out | {"columns": columns, "counts": counts}

        def last():
            own = np.flatnonzero(frequency)
            return {"lang": [None], "key": [total], "columns": [own.astype("<u2").tobytes()],
                    "counts": [frequency[own].astype("<u4").tobytes()]}

        work.last = last
        return work

    columns = {"lang": F.col("lang"), "key": F.col("key")}
    seen, _ = stage(emit(known, "text", _SEEN_ROWS, make, columns), "language")
    return _fit(seen)


def _fit(seen: DataFrame) -> Model | None:
    """Centroids of each language's sample, made in a task of its own."""
    frequency = seen.filter("lang is null").mapInPandas(_unpack, "at int, n long").groupBy("at").agg(F.sum("n"))
    count = seen.filter("lang is null").agg(F.sum("key")).first()[0]
    idf = np.zeros(FEATURES, np.float32)
    for at, n in frequency.collect():
        idf[at] = np.log((1 + count) / (1 + n)) + 0.05
    if not count:
        return None

    def centroids(rows: pd.DataFrame) -> pd.DataFrame:
        # A row repeated in the table is one sampled document.
        rows = rows.sort_values(["key", "columns", "counts"]).drop_duplicates(["key", "columns", "counts"])
        counts = np.zeros((len(rows), FEATURES), np.int64)
        for k, (own, n) in enumerate(zip(rows["columns"], rows["counts"], strict=True)):
            counts[k, np.frombuffer(own, "<u2")] = np.frombuffer(n, "<u4")
        vectors, sizes = _weights(counts, idf), _size_class(counts)
        use = counts.sum(axis=1) > 0
        if not use.any():
            vectors, sizes, use = vectors[:1], sizes[:1], np.ones(1, bool)
        vectors, sizes = vectors[use], sizes[use]
        centers = _cluster(vectors)
        cosine = (vectors @ centers.T).max(axis=1)
        least = np.full(_SIZES, np.inf)
        np.minimum.at(least, sizes, cosine)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "centers": [centers.tobytes()], "least": [least.tobytes()]})

    fitted = (
        seen.filter("lang is not null").groupBy("lang")
        .applyInPandas(centroids, "lang string, centers binary, least binary").collect()
    )
    fitted.sort(key=lambda r: r[0])
    groups = [np.frombuffer(r[1], np.float32).reshape(-1, FEATURES) for r in fitted]
    least = np.min([np.frombuffer(r[2], np.float64) for r in fitted], axis=0)
    known = np.flatnonzero(np.isfinite(least))
    # A class that was not sampled has the bound of the nearest one; smaller texts are never held to a
    # stricter bound than larger ones.
    least = least[known[np.abs(known[None, :] - np.arange(_SIZES)[:, None]).argmin(axis=1)]]
    least = np.minimum.accumulate(least[::-1])[::-1] * SLACK
    languages = [r[0] for r, g in zip(fitted, groups, strict=True) for _ in g]
    return Model(languages, np.concatenate(groups), idf, least)


def _unpack(batches):
    for rows in batches:
        for own, n in zip(rows["columns"], rows["counts"], strict=True):
            yield pd.DataFrame({"at": np.frombuffer(own, "<u2").astype(np.int32), "n": np.frombuffer(n, "<u4").astype(np.int64)})


def identify(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with the predicted language, the cosine to its nearest centroid, and whether it is rejected."""
    # Plain arrays, so that executors need no copy of the package.
    own = None if model is None else (model.languages, model.centroids, model.idf, model.least)
    sent = docs.sparkSession.sparkContext.broadcast(own)

    def make():
        model = None if sent.value is None else Model(*sent.value)

        def work(texts, batch):
            n = len(texts)
            score, rejected = np.zeros(n), np.ones(n, bool)
            names = np.full(n, UNKNOWN, object)
            letters = _has_letter(texts)
            if model is not None:
                languages = np.array(model.languages, object)
                for a, rows in _dense(texts):
                    best, cosine, far = model.predict(rows)
                    own = slice(a, a + len(rows))
                    names[own] = np.where(letters[own], languages[best], UNKNOWN)
                    score[own] = np.where(letters[own], cosine, 0.0)
                    rejected[own] = far | ~letters[own]
            return {"lang_pred": names, "score": score, "rejected": rejected}

        return work

    return map_texts(docs, text, RESULTS, make, keep)


def held_out(id_: Column, folds: int, fold: int) -> Column:
    """Whether a document's id falls in this fold. A null id does not."""
    return F.coalesce(F.crc32(id_.cast("string")) % folds == fold, F.lit(False))
