"""The same gate and exact deduplication over a stream of JSON lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary.functions.text import text_hash
from granary.operators.dedup import first_by_key, min_chars_gate
from granary.sources.readers import drop_bad


def line_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Lines of text files as they arrive in a folder, with their time of arrival; files are not too old for it."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).option("maxFileAge", "36500d").text(folder)
    return raw.select(F.col("value").alias("line"), F.col("_metadata.file_modification_time").alias("arrived"))


def gated(lines: DataFrame, min_chars: int = 200) -> DataFrame:
    """Corpus rows of a line stream that pass the gate, with the hash of the normalised text."""
    return min_chars_gate(drop_bad(lines), "text", min_chars).withColumn("h", text_hash(F.col("text")))


def add_batch(rows: DataFrame, batch: int, out: str) -> None:
    """Write the first of each hash that no other batch has written. The output is the table of hashes seen, so
    none is forgotten and no late row is lost; a batch that is run again replaces its own folder."""
    new = first_by_key(rows, "h", F.struct("arrived", "text"))
    try:
        seen = rows.sparkSession.read.parquet(out)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        new = new.join(seen.where(F.col("batch") != batch).select("h"), "h", "left_anti")
    new.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch}")


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, min_chars: int = 200) -> StreamingQuery:
    """Run until the folder's files are done, writing Parquet by batch; the checkpoint folder lets it resume."""
    w = gated(line_stream(spark, folder), min_chars).writeStream.foreachBatch(lambda rows, batch: add_batch(rows, batch, out))
    return w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
