"""Public tokenizers, loaded once per Python worker. Their folder is a parameter."""

from __future__ import annotations

import base64
import functools
import os
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_DIR = os.environ.get("GRANARY_TOKENIZERS", "/opt/tokenizers")
DEFAULT_NAME = "byte_bpe_multi_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that belongs to the byte-level vocabularies.
BYTE_BPE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A chunk is white space with the word after it: the pattern never matches across its borders.
_CHUNK = re.compile(r"\s*\S+|\s+")
CACHE_WORDS = 400_000


class Tokenizer:
    """``encode`` and ``count`` over one of the public vocabulary files."""

    def __init__(self, name: str = DEFAULT_NAME, folder: str = DEFAULT_DIR):
        path = os.path.join(folder, name)
        self._cache: dict[str, int] = {}
        self._chunked = name.endswith(".tiktoken")
        if self._chunked:
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding(name, pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = enc.encode_ordinary
            self.eos = self.size = len(ranks)
        elif name.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda t: sp.encode(t, num_threads=1)
            self.eos, self.size = sp.eos_id(), sp.get_piece_size()
        else:
            import tokenizers

            tk = tokenizers.Tokenizer.from_file(path)
            tk.encode_special_tokens = True
            self.encode = lambda t: tk.encode(t, add_special_tokens=False).ids
            self.eos, self.size = tk.token_to_id("<|endoftext|>"), tk.get_vocab_size()

    def count(self, text: str) -> int:
        """Number of tokens; byte-level vocabularies are counted chunk by chunk through a cache,
        which gives the same number as encoding the whole text."""
        if not self._chunked:
            return len(self.encode(text))
        cache, n = self._cache, 0
        for c in _CHUNK.findall(text):
            k = cache.get(c)
            if k is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                k = cache[c] = len(self.encode(c))
            n += k
        return n


@functools.lru_cache(maxsize=4)
def tokenizer(name: str = DEFAULT_NAME, folder: str = DEFAULT_DIR) -> Tokenizer:
    return Tokenizer(name, folder)


def token_count(c: Column, name: str = DEFAULT_NAME, folder: str = DEFAULT_DIR) -> Column:
    """Tokens of a text; null counts as no text and gives 0."""

    @F.pandas_udf("long")
    def count(s: pd.Series) -> pd.Series:
        tk = tokenizer(name, folder)
        return s.map(lambda t: 0 if t is None else tk.count(t)).astype("int64")

    return count(c)


def token_ids(c: Column, name: str = DEFAULT_NAME, folder: str = DEFAULT_DIR) -> Column:
    """Token ids of a text; null gives an empty array."""

    @F.pandas_udf("array<int>")
    def ids(s: pd.Series) -> pd.Series:
        tk = tokenizer(name, folder)
        return s.map(lambda t: [] if t is None else list(tk.encode(t)))

    return ids(c)
