"""Vocabulary pieces, new tokens and how many tokens a character takes."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import tokenizers as tok
from granary.functions.text import strip

# Fixed value: names of control pieces.
CONTROL = ("<unk>", "<s>", "</s>", "<pad>")
WORD_MARK = "▁"


def plain_pieces(vocab: DataFrame) -> DataFrame:
    """Pieces without the empty one, control pieces and anything in angle brackets."""
    p = F.col("piece")
    return vocab.where((p != "") & ~p.isin(*CONTROL) & ~(F.startswith(p, F.lit("<")) & F.endswith(p, F.lit(">"))))


def surface(piece: Column) -> Column:
    """Text of a piece: the word mark is a blank."""
    return F.translate(piece, WORD_MARK, " ")


def first_ranked(surfaces: DataFrame, max_new: int) -> DataFrame:
    """(new_rank from 0, piece_rank, surface): each surface at its first rank, the first ``max_new`` of them. A
    vocabulary is at most some hundred thousand pieces, so the numbering takes one task."""
    s = surfaces.groupBy("surface").agg(F.min("piece_rank").alias("piece_rank")).orderBy("piece_rank").limit(max_new)
    return s.select((F.row_number().over(Window.orderBy("piece_rank")) - 1).alias("new_rank"), "piece_rank", "surface")


def select_new_tokens(vocab: DataFrame, max_new: int, min_len: int = 2, name: str = tok.DEFAULT_NAME, folder: str = tok.DEFAULT_DIR) -> DataFrame:
    """``first_ranked`` of the surfaces of two or more characters that the base tokenizer does not have as one token."""
    s = plain_pieces(vocab).select("piece_rank", surface(F.col("piece")).alias("surface"))
    s = s.where(F.length(strip(F.col("surface"))) >= min_len)
    return first_ranked(s.where(tok.token_count(F.col("surface"), name, folder) >= 2), max_new)


def assign_token_ids(new: DataFrame, base_size: int) -> DataFrame:
    """New tokens with ids that follow those of the base vocabulary."""
    return new.withColumn("token_id", F.col("new_rank") + base_size)


def vocab_anti_join(vocab: DataFrame, base: DataFrame) -> DataFrame:
    """Pieces whose surface is not a surface of ``base``."""
    have = base.select(surface(F.col("piece")).alias("__s")).distinct()
    return vocab.withColumn("surface", surface(F.col("piece"))).join(have, F.col("surface") == F.col("__s"), "left_anti")


def fertility(df: DataFrame, n_tokens: Column, text_col: str = "text", by: list[str] | None = None) -> DataFrame:
    """Tokens by characters, as a ratio of sums; NaN where there are no characters."""
    rows = df.where(F.col(text_col) != "").select(*(by or []), n_tokens.cast("long").alias("t"), F.length(text_col).cast("long").alias("c"))
    sums = rows.groupBy(*(by or [])).agg(F.coalesce(F.sum("t"), F.lit(0)).alias("n_tokens"), F.coalesce(F.sum("c"), F.lit(0)).alias("n_chars"))
    return sums.withColumn("fertility", F.when(F.col("n_chars") == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.col("n_tokens").cast("double"), F.col("n_chars"))))


def vocab_path(model_path: str) -> str:
    """Path of the vocabulary list that belongs to a model file."""
    return model_path.replace(".model", ".vocab")


def extended_tokenizer(surfaces: list[str], name: str = "byte_bpe_50k.json", folder: str = tok.DEFAULT_DIR):
    """A JSON tokenizer with ``surfaces`` (bounded by the cap on new tokens) added as plain tokens; their ids follow
    those of the base in the order given."""
    return _extended(name, folder, json.dumps(surfaces, ensure_ascii=False))


def expansion_meta(spark: SparkSession, model: str, base_vocab: int, added: int, tied: bool, before: float | None, after: float | None) -> DataFrame:
    """One row that tells how a vocabulary was grown; fertilities are null where there was no sample."""
    row = (model, base_vocab, added, base_vocab + added, tied, before, after)
    return spark.createDataFrame([row], "model string, base_vocab long, added long, new_vocab long, tied_embeddings boolean, fertility_tokens_per_char_before double, fertility_tokens_per_char_after double")


def extended_token_count(c: Column, surfaces: list[str], name: str = "byte_bpe_50k.json", folder: str = tok.DEFAULT_DIR) -> Column:
    """Tokens under a JSON tokenizer with ``surfaces`` (bounded by the cap on new tokens) added as plain tokens."""
    added = json.dumps(list(surfaces), ensure_ascii=False)

    @F.pandas_udf(T.LongType())
    def count(it: pd.Series) -> pd.Series:
        tk = _extended(name, folder, added)
        texts = [x or "" for x in it]
        return pd.Series([len(e.ids) for e in tk.encode_batch(texts, add_special_tokens=False)], dtype="int64")

    return count(c)


_tokenizers: dict = {}


def _extended(name: str, folder: str, added: str):
    key = (name, folder, added)
    if key not in _tokenizers:
        import os

        import tokenizers

        tk = tokenizers.Tokenizer.from_file(os.path.join(folder, name))
        tk.encode_special_tokens = True
        tk.add_tokens([tokenizers.AddedToken(s, normalized=False, special=False) for s in json.loads(added)])
        _tokenizers.clear()
        _tokenizers[key] = tk
    return _tokenizers[key]
