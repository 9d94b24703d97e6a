"""Blocks of documents: bounded groups that one task can hold as arrays.

Operators that compare every window of a corpus would shuffle one row per word. They
deal the documents into blocks of bounded text instead, and exchange sorted arrays of
hashes between blocks: a few bytes per word and no row overhead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Compresses byte planes of sorted numbers; the shuffle's own codec has no entropy coding.
_CODEC = "zstd"


def block_count(docs: DataFrame, text: str, block_bytes: int) -> int:
    """Blocks needed for about ``block_bytes`` of text each; one aggregate over the texts."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-int(total) // block_bytes))


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: the planes of close numbers shrink well."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    return pa.compress(planes.tobytes(), codec=_CODEC, asbytes=True)


def unpacked(data: bytes, dtype: str, count: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = pa.decompress(data, decompressed_size=count * width, codec=_CODEC, asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, count)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()
