"""Lines that one site repeats over its records: found through bitmaps and removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import line_key, site
from granary.session import materialize

MIN_RECORDS = 10
SMALL_LINES = 500_000


def line_places(df: DataFrame, id_col: str, text: Column, where: Column) -> DataFrame:
    """One row for each line with letters: id, number of the line from 1, and 128 bits of hash of its site and
    key. Two 64-bit hashes stand for the key, so long lines travel in 16 bytes."""
    lines = df.select(F.col(id_col).alias("id"), where.alias("site"), F.posexplode(F.split(text, "\n", -1)).alias("at", "line"))
    keyed = lines.select("id", "site", (F.col("at") + 1).alias("line_no"), line_key(F.col("line")).alias("key")).where(F.length("key") > 0)
    return keyed.select("id", "line_no", F.xxhash64("site", "key").alias("h1"), F.xxhash64(F.lit(11), "key", "site").alias("h2"))


def line_bitmaps(places: DataFrame) -> DataFrame:
    """(h1, h2, w, word): the records of each line as a bitmap, compressed by keeping only the 64-bit words that
    have a bit set. Lines that differ only in case or in what is not a letter or mark have one key, so OR-ing words
    by key unites the bitmaps of the variants, first in the task and then over all."""
    return places.groupBy("h1", "h2", F.shiftright("id", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(id & 63 as int)))").alias("word"))


def repeated_places(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", url_col: str = "url", source_col: str = "source", min_records: int = MIN_RECORDS, small_lines: int = SMALL_LINES) -> DataFrame:
    """Places (id, line_no) of lines that stand in ``min_records`` or more records of their site.

    Lines are split, lowered and hashed once, into a table of places, and the bitmaps of their records are a table,
    too. Bits are counted exactly by line. A line is deleted where the bitmap of a frequent line has the record's bit:
    that lookup is a join on line and word, and a word covers 64 ids, so a line that a third of all records carry is
    as many keys as it needs. The decision goes back from lines to their words in a join of two tables, which
    adaptive execution splits where a line is hot. Where the frequent lines are at most ``small_lines`` (16 bytes each,
    counted first), they are also sent to all tasks to thin the places out before that lookup; the result is the same.

    Null or empty texts have no lines. Null ids are left out. An id that comes twice counts as one record.
    Without url and source the site is null, which is one site of its own. Other columns are ignored."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), site(F.col(url_col), F.col(source_col)).alias("s")).where("id is not null and t is not null")
    places = materialize(line_places(rows, "id", F.col("t"), F.coalesce("s", F.lit("\0"))), "places", "lz4")
    words = materialize(line_bitmaps(places), "bitmaps", "lz4")
    frequent = words.groupBy("h1", "h2").agg(F.sum(F.bit_count("word")).alias("records")).where(F.col("records") >= min_records)
    frequent = materialize(frequent.select("h1", "h2"), "frequent")
    if frequent.count() <= small_lines:
        places = places.join(F.broadcast(frequent), ["h1", "h2"], "left_semi")
    bitmaps = words.join(frequent, ["h1", "h2"])
    hit = places.withColumn("w", F.shiftright("id", 6)).join(bitmaps, ["h1", "h2", "w"]).where(F.expr("shiftright(word, cast(id & 63 as int)) & 1L = 1"))
    return hit.select(F.col("id").alias(id_col), "line_no")


def remove_lines(df: DataFrame, places: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``df`` with the lines named by ``places`` taken out of the text, and their number in ``removed_lines``.

    Records without such lines, null ids and null texts come out unchanged, with 0. All columns are kept but for an earlier ``removed_lines``."""
    gone = places.groupBy(F.col(id_col).alias("__id")).agg(F.collect_set("line_no").alias("__gone"))
    kept = F.filter(F.split(text_col, "\n", -1), lambda x, i: ~F.array_contains("__gone", i + 1))
    out = df.join(gone, F.col(id_col) == F.col("__id"), "left")
    return out.select(
        *[F.when(F.col("__gone").isNull(), F.col(c)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else F.col(c) for c in df.columns if c != "removed_lines"],
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).alias("removed_lines"),
    )
