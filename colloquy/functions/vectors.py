"""Vector expressions; sums run in double precision and in order."""

from __future__ import annotations

from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CLAMP = 1e-10


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.greatest(F.sqrt(dot(a, a)), F.lit(CLAMP))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


#: What stands between words: letters, digits and _ of ASCII are told by themselves, which is much faster than by their classes.
NON_WORDS = r"(?U)[^a-zA-Z0-9_\w]+"


def _codes(words: pa.Array, dimensions: int) -> np.ndarray:
    """The number below 2 * dimensions of each word, by the head of its MD5; that of the empty word is -1."""
    coded = words.dictionary_encode()
    numbers = [int(md5(w.encode()).hexdigest()[:8], 16) % (2 * dimensions) if w else -1 for w in coded.dictionary.to_pylist()]
    return np.array(numbers, np.int64)[coded.indices.to_numpy()]


@lru_cache
def _signed_counts(dimensions: int):
    """Words as a vector: how often each number below dimensions occurs, less the one that far above it; of length one."""

    @F.arrow_udf("array<float>")
    def counts(texts: pa.Array) -> pa.Array:
        out = []
        # So many rows at a time that their counts stay small.
        for lo in range(0, len(texts), 1024):
            some = texts.slice(lo, 1024)
            size = np.nan_to_num(some.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            code, row = _codes(some.flatten(), dimensions), np.repeat(np.arange(len(some)), size)
            n = np.bincount((row * 2 * dimensions + code)[code >= 0], minlength=len(some) * 2 * dimensions).reshape(len(some), 2, dimensions)
            sums = (n[:, 0] - n[:, 1]).astype(np.float64)
            scaled = (sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), CLAMP)).astype(np.float32)
            ends = np.arange(len(some) + 1, dtype=np.int32) * dimensions
            out.append(pa.ListArray.from_arrays(ends, scaled.ravel(), mask=some.is_null()))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.float32()))

    return counts


def hashed_embedding(text: Column, dimensions: int = 64) -> Column:
    """A model-free stand-in for a sentence embedding: hashed words with signs, counted in one pass, of length one."""
    return _signed_counts(dimensions)(F.split(F.lower(text), NON_WORDS))
