"""Merging corpora, counting what each gives, and the lines of their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import normalize_text, strip, text_hash, words
from granary.operators.prefix import running_sum
from granary.session import materialize


def merge(parts: list[DataFrame]) -> DataFrame:
    """Union of corpora in the order given, as ``src_prio``; columns one lacks are null."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("src_prio", F.lit(i))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def source_stats(all_: DataFrame, kept: DataFrame, by: str = "source") -> DataFrame:
    """Rows in and rows kept of each source; a source without kept rows has 0."""
    k = kept.groupBy(by).agg(F.count("*").alias("kept"))
    n = all_.groupBy(by).agg(F.count("*").alias("n_in"))
    return n.join(k, n[by].eqNullSafe(k[by]), "left").select(n[by].alias(by), "n_in", F.coalesce("kept", F.lit(0)).alias("kept"))


def rate(n: Column, seconds: Column) -> Column:
    """Rows by second; the time counts as a billionth of a second at least."""
    return n / F.greatest(seconds, F.lit(1e-9))


def corpus_stats(df: DataFrame, id_col: str = "doc_id", min_chars: int = 200) -> DataFrame:
    """By source: documents in, past the length gate, and left after exact deduplication. Texts are read once;
    only lengths and hashes go on. A null source is a source of its own."""
    ok = F.length(strip(F.col("text"))) >= F.lit(max(1, min_chars))
    rows = df.select(F.col(id_col).alias("id"), "source", F.length("text").alias("chars"), F.coalesce(ok, F.lit(False)).alias("ok"), text_hash(F.col("text")).alias("h"))
    rows = materialize(rows, "hashes")
    first = rows.where("ok").groupBy("h").agg(F.min_by(F.struct("source", "chars"), "id").alias("x")).select("x.*")
    k = first.groupBy("source").agg(F.count("*").alias("n_kept"), F.sum(F.col("chars").cast("long")).alias("kept_chars"))
    n = rows.groupBy("source").agg(F.count("*").alias("n_in"), F.sum(F.col("ok").cast("long")).alias("n_gated"))
    return n.join(k, n["source"].eqNullSafe(k["source"]), "left").select(n["source"].alias("source"), "n_in", "n_gated", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_kept", "kept_chars")])


def lines(df: DataFrame, id_col: str, text_col: str = "text", min_chars: int = 8) -> DataFrame:
    """(id, line_no from 0, line): lines at line feeds, stripped, with at least ``min_chars`` code points.
    Null and empty texts have none."""
    at = df.where(F.col(text_col) != "").select(F.col(id_col), F.posexplode(F.split(text_col, "\n", -1)).alias("line_no", "l"))
    return at.select(id_col, "line_no", strip(F.col("l")).alias("line")).where(F.length("line") >= min_chars)


def byte_cap(df: DataFrame, order: list[Column], size: Column, max_bytes: int) -> DataFrame:
    """Rows in order until ``max_bytes`` are reached; the row that crosses the limit is the last."""
    return running_sum(df, order, size, "bytes_before").where(F.col("bytes_before") < max_bytes)


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each word of the normalised texts occurs."""
    return df.select(F.explode(words(normalize_text(F.col(text_col)))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def training_lines(df: DataFrame, order: list[str], text_col: str = "text", min_chars: int = 8, max_bytes: int = 4_000_000_000, max_line_bytes: int = 16_384, max_lines: int = 10_000_000, seed: int = 0) -> DataFrame:
    """(order columns, line_no, line): what a vocabulary is trained on. Lines in order up to ``max_bytes`` in all (the
    crossing line included), without those longer than ``max_line_bytes``, and of these a random ``max_lines``,
    chosen by the MD5 of seed, order and number of the line. Both caps are what the operator is for."""
    at = df.where(F.col(text_col) != "").select(*order, F.posexplode(F.split(text_col, "\n", -1)).alias("line_no", "l"))
    rows = at.select(*order, "line_no", strip(F.col("l")).alias("line")).where(F.length("line") >= min_chars)
    by = [F.col(c) for c in (*order, "line_no")]
    rows = byte_cap(rows, by, F.octet_length("line"), max_bytes).where(F.octet_length("line") <= max_line_bytes)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), *by))
    return rows.orderBy(key, *by).limit(max_lines).select(*order, "line_no", "line")
