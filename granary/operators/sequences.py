"""Streams of tokens cut into sequences of one length, and mixing two streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import tokenizers as tok
from granary.operators.prefix import running_sum
from granary.session import materialize


def shard_files(df: DataFrame, index: Column, world: int, workers: int) -> DataFrame:
    """Rank and worker of each file by its place in the sorted list: every world-th file is a rank's, and of
    those every workers-th one a worker's."""
    return df.withColumns({"rank": F.pmod(index, F.lit(world)).cast("int"), "worker": F.pmod(F.floor(index / world), F.lit(workers)).cast("int")})


def pack_offsets(df: DataFrame, order: list[Column], n_tokens: Column, by: list[str]) -> DataFrame:
    """First position of each document in the token stream of its group; each has one end token."""
    return running_sum(df, order, n_tokens + 1, "first_position", by)


def chunk_counts(df: DataFrame, n_tokens: Column, by: list[str], seq_len: int) -> DataFrame:
    """Full sequences of each group's stream, and the tokens left over."""
    t = df.groupBy(*by).agg(F.sum((n_tokens + 1).cast("long")).alias("n_tokens"))
    return t.select(*by, F.expr(f"n_tokens div {seq_len}").alias("n_sequences"), (F.col("n_tokens") % seq_len).alias("n_left"))


def replay_mix(main: DataFrame, replay: DataFrame, order: list[Column], ratio: float, by: list[str] | None = None, shift: Column | None = None, seed: int = 1234) -> DataFrame:
    """Both streams, all rows once, so interleaved that a share ``ratio`` of the draws is replay while both last,
    within each group ``by``.

    The k-th row of a stream has the key k / weight, moved within one draw by a hash; the result has ``stream``
    (0 main, 1 replay) and ``mix_key`` to order by. A ratio of 0 leaves the replay out. ``shift`` is a number from 0
    to 999 made of ``__seed``, ``__stream`` and ``__at``, the number of the row in its stream, instead of the hash."""
    out = None
    for i, (df, w) in enumerate(((main, 1 - ratio), (replay, ratio))):
        if w <= 0:
            continue
        at = running_sum(df, order, F.lit(1), "__at", by).withColumns({"__seed": F.lit(seed), "__stream": F.lit(i)})
        moved = shift if shift is not None else F.pmod(F.xxhash64("__seed", "__stream", "__at"), F.lit(1000))
        part = at.select(*df.columns, F.lit(i).alias("stream"), ((F.col("__at") + moved / 1000.0) / w).alias("mix_key"))
        out = part if out is None else out.unionByName(part)
    return out


def pack_ids(df: DataFrame, order: list[Column], by: list[str], seq_len: int, ids: Column, eos: int) -> DataFrame:
    """(by..., seq_no, input_ids, labels): the token ids of each group's rows in order, with an end token after each,
    cut every ``seq_len`` tokens across rows; the rest of a group is dropped. Rows with null ids are skipped.

    Positions come from a running sum of sizes, so each piece of a row finds its sequences alone; pieces meet by
    sequence number, where no group is larger than a sequence."""
    rows = df.withColumn("__ids", F.concat(ids, F.array(F.lit(eos)))).where("__ids is not null")
    rows = materialize(rows.withColumn("__n", F.size("__ids").cast("long")), "tokens")
    at = running_sum(rows, order, F.col("__n"), "__at", by)
    piece = F.explode(F.sequence(F.expr(f"__at div {seq_len}"), F.expr(f"(__at + __n - 1) div {seq_len}"))).alias("seq_no")
    p = at.select(*by, "__at", "__ids", piece)
    start = F.greatest(F.lit(0), F.col("seq_no") * seq_len - F.col("__at"))
    end = F.least(F.size("__ids").cast("long"), (F.col("seq_no") + 1) * seq_len - F.col("__at"))
    cut = p.select(*by, "seq_no", F.struct((F.col("__at") + start).alias("at"), F.slice("__ids", (start + 1).cast("int"), (end - start).cast("int")).alias("ids")).alias("x"))
    seqs = cut.groupBy(*by, "seq_no").agg(F.flatten(F.transform(F.sort_array(F.collect_list("x")), lambda x: x.ids)).alias("input_ids"))
    return seqs.where(F.size("input_ids") == seq_len).withColumn("labels", F.col("input_ids"))


def pack_sequences(df: DataFrame, order: list[Column], by: list[str], seq_len: int, text_col: str = "text", name: str = tok.DEFAULT_NAME, folder: str = tok.DEFAULT_DIR) -> DataFrame:
    """``pack_ids`` of the tokens of texts under a public tokenizer. Null and empty texts are skipped."""
    ids = tok.token_ids(F.col(text_col), name, folder)
    kept = df.where(F.col(text_col) != "").withColumn("__t", ids).drop(text_col)
    return pack_ids(kept, order, by, seq_len, F.col("__t"), tok.tokenizer(name, folder).eos)


def first_steps(batched: DataFrame, steps: int) -> DataFrame:
    """Batches of the first ``steps`` steps; the cap is what this operator is for."""
    return batched.where(F.col("batch_no") < steps)


def batches(seqs: DataFrame, size: int, by: list[str]) -> DataFrame:
    """Sequences collated into batches of ``size`` by their number, with a mask of ones; the last may be smaller."""
    b = seqs.withColumn("batch_no", F.expr(f"seq_no div {size}"))
    return b.groupBy(*by, "batch_no").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("seq_no", "input_ids", "labels"))), lambda x: x.input_ids).alias("input_ids"),
        F.transform(F.sort_array(F.collect_list(F.struct("seq_no", "input_ids", "labels"))), lambda x: x.labels).alias("labels"),
    ).withColumn("attention_mask", F.transform("input_ids", lambda r: F.array_repeat(F.lit(1), F.size(r))))
