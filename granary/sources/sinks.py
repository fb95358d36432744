"""Writers and readers of what the stages leave behind."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.prefix import running_count
from granary.session import materialize
from granary.sources import files


def write_numbered(df: DataFrame, path: str, total: int, position: str = "position", shard_docs: int = 200_000, columns: tuple[str, ...] | None = None) -> None:
    """Rows numbered from 1 to ``total`` as shards of exactly ``shard_docs`` rows in order, the last one shorter, each
    one file of zstd Parquet. ``columns`` are written, or all but the number. Earlier output is replaced. An empty table gives
    the success marker and a file without rows. A shard is a partition: rows cross the network once."""
    out = df.repartitionById(max(1, -(-total // shard_docs)), F.expr(f"cast(({position} - 1) div {shard_docs} as int)")).sortWithinPartitions(position)
    out.select(*(columns or [c for c in df.columns if c != position])).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_shards(df: DataFrame, path: str, order: list[Column], shard_docs: int = 200_000) -> int:
    """``write_numbered`` of rows in an order; gives their number."""
    held = materialize(running_count(df, order, "__position"), "numbered")
    total = held.count()
    write_numbered(held, path, total, "__position", shard_docs)
    return total


def write_corpus(df: DataFrame, path: str, shard_docs: int = 200_000) -> None:
    """Shards of at most ``shard_docs`` rows without numbering the rows first."""
    df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", shard_docs).parquet(path)


def write_meta(spark: SparkSession, meta: dict, path: str) -> None:
    files.write_text(spark, path, json.dumps(meta, ensure_ascii=False, indent=1))


def read_meta(spark: SparkSession, path: str) -> dict:
    """A file of ``write_meta``; empty where there is none."""
    text = files.read_text(spark, path)
    return json.loads(text) if text else {}


def write_new_rows(rows: DataFrame, path: str) -> None:
    """Rows of new tokens: token_id, surface, input, output (null for tied matrices)."""
    rows.select("token_id", "surface", "input", "output").write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_new_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_tokenizer(spark: SparkSession, tokenizer, folder: str) -> None:
    """The JSON of a tokenizer in a folder of its own, as other tools load it."""
    files.write_text(spark, f"{folder.rstrip('/')}/tokenizer.json", tokenizer.to_str())
