"""Keys dealt to buckets as packed blobs: one shuffled row for each piece of texts and bucket.

Packed columns of many small values move and sort in numpy, without a row in the JVM for each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text for each bucket.
BUCKET_BYTES = 16 << 20


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0


def bucket_count(n_bytes: int, size: int = BUCKET_BYTES) -> int:
    return max(1, -(-n_bytes // size))


def pack(values: np.ndarray, kind: str) -> bytes:
    """Fixed-width values byte plane by byte plane, which compresses well when they are sorted."""
    flat = np.ascontiguousarray(values.astype(kind))
    width = flat.dtype.itemsize
    return flat.view(np.uint8).reshape(-1, width).T.tobytes()


def unpack(blob: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(blob, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def slices(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in ascending 64-bit keys; buckets are equal ranges of them."""
    edges = [(k << 64) // buckets for k in range(buckets)]
    inner = np.searchsorted(keys, np.array(edges, np.uint64))
    return np.append(inner, len(keys))
