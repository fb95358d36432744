"""Growing a vocabulary: new tokens, their embedding rows, the grown tokenizer and what is known about it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import tokenizers as tok
from granary.operators import embeddings, vocab
from granary.session import materialize
from granary.sources import sinks

BASE = "byte_bpe_50k.json"


def new_tokens(pieces: DataFrame, max_new: int, base: str = BASE, folder: str = tok.DEFAULT_DIR) -> DataFrame:
    """(token_id, surface, ids): tokens to add, with the ids the base tokenizer splits them into."""
    size = tok.tokenizer(base, folder).size
    new = vocab.assign_token_ids(vocab.select_new_tokens(pieces, max_new, name=base, folder=folder), size)
    return materialize(new.select("token_id", "surface", tok.token_ids(F.col("surface"), base, folder).alias("ids")), "new-tokens")


def sample_fertility(sample: DataFrame, counts: list, text_col: str = "text") -> list[float]:
    """Tokens by characters of a sample for each of the token counts."""
    row = sample.where(F.col(text_col) != "").agg(F.sum(F.length(text_col)), *[F.sum(c) for c in counts]).first()
    return [v / row[0] if row[0] else float("nan") for v in row[1:]]


def expand(spark: SparkSession, pieces: DataFrame, out: str | None, matrix: DataFrame | None = None, output: str | None = None, sample: DataFrame | None = None, max_new: int = 16_000, base: str = BASE, folder: str = tok.DEFAULT_DIR) -> DataFrame:
    """Select, number, average and write; gives the one row of metadata.

    pieces: piece_rank, piece. matrix: vec_id, embedding and, where the output matrix is one of its own, the column
    ``output``. With ``out``: new_rows (if there is a matrix), tokenizer.json and meta.json there. At most ``max_new`` surfaces
    come to the driver, for the tokenizer. Nothing new is no error: the tokenizer stays as it was."""
    new = new_tokens(pieces, max_new, base, folder)
    surfaces = [r.surface for r in new.orderBy("token_id").select("surface").collect()]
    before = after = None
    if sample is not None:
        before, after = sample_fertility(sample, [tok.token_count(F.col("text"), base, folder), vocab.extended_token_count(F.col("text"), surfaces, base, folder)])
    meta = vocab.expansion_meta(spark, base, tok.tokenizer(base, folder).size, len(surfaces), output is None, before, after)
    if out is not None:
        out = out.rstrip("/")
        if matrix is not None:
            rows = embeddings.new_rows(new, matrix, output=output).join(new.select("token_id", "surface"), "token_id")
            sinks.write_new_rows(rows, f"{out}/new_rows")
        sinks.write_tokenizer(spark, vocab.extended_tokenizer(surfaces, base, folder), out)
        sinks.write_meta(spark, meta.first().asDict(), f"{out}/meta.json")
    return meta
