"""Sets of hashed word runs, many texts at a time."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.text import SHINGLE_WORDS

CACHE_WORDS = 300_000
_ODD = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class WordRuns:
    """Texts to sets of 64-bit hashes of their runs of k words. Words are hashed once for each worker; the runs
    of all texts of a batch are put together with array operations."""

    def __init__(self, k: int = SHINGLE_WORDS):
        self.k, self.cache = k, {}

    def words(self, text: str) -> list[int]:
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        cache, out = self.cache, []
        for w in text.split():
            h = cache.get(w)
            if h is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                h = cache[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            out.append(h)
        return out

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Items in order of text and value, each once in a text; first index of each text, and the end.
        A text of fewer than k words is one item, one without words none."""
        k = self.k
        per = [self.words(t) if t else [] for t in texts]
        size = np.fromiter(map(len, per), np.int64, len(per))
        flat = np.fromiter((h for p in per for h in p), np.uint64, int(size.sum()))
        runs = np.where(size >= k, size - k + 1, np.minimum(size, 1))
        doc = np.repeat(np.arange(len(per)), runs)
        start = np.concatenate([[0], np.cumsum(size)])[:-1]
        first = np.concatenate([[0], np.cumsum(runs)])[:-1]
        at = np.arange(len(doc)) - first[doc] + start[doc]
        width = np.minimum(size, k)[doc]
        h = width.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for j in range(k):
            inside = width > j
            h[inside] += flat[at[inside] + j] * _ODD[j]
        h = mix(h)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        return h, np.searchsorted(doc, np.arange(len(per) + 1))


def run_hashes(c: Column, k: int = SHINGLE_WORDS) -> Column:
    """Sorted distinct hashes of the runs of k words of a text as it is after normalisation. Null gives none."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def hashes(it: pd.Series) -> pd.Series:
        h, at = WordRuns(k)(it.tolist())
        h = h.view(np.int64)
        return pd.Series([h[at[i] : at[i + 1]] for i in range(len(it))], dtype=object)

    return hashes(c)
