"""A mix in which each source has its share of the tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import tokenizers as tok
from granary.session import materialize

BUCKET_ROWS = 20_000
BUCKET_BITS = 24
SEED = 1234


def source_key(c: Column) -> Column:
    """Sources that differ only in letter case and blanks are one; null is the empty source."""
    return F.coalesce(F.lower(F.regexp_replace(c, r"\s+", "")), F.lit(""))


def random_key(id_: Column, seed: int = SEED) -> Column:
    """Key of 63 bits, never negative: the hash of the id."""
    return F.shiftrightunsigned(F.xxhash64(id_, F.lit(seed)), 1)


def md5_key(id_: Column) -> Column:
    """The same from the first 60 bits of the MD5 of the id, which other engines can follow."""
    return F.shiftleft(F.conv(F.left(F.md5(id_.cast("string")), F.lit(15)), 16, 10).cast("long"), 3)


def sized_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", name: str = tok.DEFAULT_NAME, folder: str = tok.DEFAULT_DIR, size: Column | None = None) -> DataFrame:
    """(id, src, n): documents with their size, tokens unless another is given, in a table of the shared folder.
    Null ids and texts and documents without size are left out."""
    n = size if size is not None else tok.token_count(F.col(text_col), name, folder)
    out = df.select(F.col(id_col).cast("long").alias("id"), source_key(F.col(source_col)).alias("src"), n.cast("long").alias("n"))
    return materialize(out.where("id is not null and n > 0"), "mix-sizes")


def _plan(sized: DataFrame, targets: DataFrame, total_tokens: int | None, fill: bool) -> DataFrame:
    """Target rows with their budget. Equal sources in the list add up, with the largest repeat cap.

    With ``fill`` what a source cannot reach goes to those that can, in proportion to their shares: with sources in
    order of what they can give by share, the first whose fair part of what is left is within its means sets the
    level for itself and all after it. The list of targets is small, so this is one window over it."""
    t = targets.where("target_share > 0 and max_repeats > 0").groupBy(source_key(F.col("source")).alias("src")).agg(
        F.min("source").alias("source"), F.sum("target_share").alias("target_share"), F.max("max_repeats").cast("long").alias("max_repeats"))
    have = sized.groupBy("src").agg(F.sum("n").alias("available"), F.count("*").alias("documents"))
    rows = t.join(have, "src", "left").select("src", "source", "target_share", "max_repeats", F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("documents", F.lit(0)).alias("documents"))
    whole = Window.partitionBy()
    size = F.lit(total_tokens).cast("long") if total_tokens is not None else F.sum("available").over(whole)
    rows = rows.withColumn("planned", size)
    share = F.col("target_share")
    if fill:
        order = Window.orderBy(F.col("available") * F.col("max_repeats") / share, "src")
        rows = rows.withColumn("can", F.col("available") * F.col("max_repeats"))
        rows = rows.withColumn("before", F.coalesce(F.sum("can").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        rows = rows.withColumn("after", F.sum(share).over(order.rowsBetween(0, Window.unboundedFollowing)))
        level = (F.col("planned") - F.col("before")) / F.col("after")
        first = F.when(level * share <= F.col("can"), F.struct(F.row_number().over(order).alias("at"), level.alias("level")))
        rows = rows.withColumn("first", first).withColumn("level", F.min("first").over(whole).getField("level"))
        # Rounded first, as the level is a quotient.
        budget = F.floor(F.round(F.least(F.col("can").cast("double"), F.coalesce(F.col("level") * share, F.col("can").cast("double"))), 3))
        rows = rows.withColumn("budget", budget.cast("long")).drop("can", "before", "after", "first", "level")
    else:
        rows = rows.withColumn("budget", F.floor(share * F.col("planned")).cast("long"))
    return rows


def mix(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, key: Column | None = None, bucket_rows: int = BUCKET_ROWS, fill: bool = False) -> DataFrame:
    """Rows id, source, epoch, start, n_tokens, tokens: the documents of the mix in the order ``start`` of their
    source. ``tokens`` is what counts; only the last document of a source is cut, at the exact budget.

    Each document has a random key of 63 bits, by default the hash of its id. Keys are cut into ranges of equal width
    within the source; sums of the ranges and a running sum within each range give the position of every document among
    the tokens of its source, without a task that sees more than one range. Ranges are cut from the upper bits of the
    same key that orders the rows within one, so their number (by ``bucket_rows``) changes no result. Position
    plus whole epochs below the budget decide how often a document comes; a source is never taken more than
    ``max_repeats`` times.

    ``total_tokens`` is the planned size; without it, all tokens of the listed sources. ``fill`` shares out what a
    source cannot reach. Sources that are not listed take no part; a listed source without documents gives no row.
    Ties of keys are ordered by id, and repeated rows count as documents of their own."""
    n_buckets = 1
    while n_buckets * bucket_rows < sized.count() and n_buckets < 1 << BUCKET_BITS:
        n_buckets *= 2
    plan = _plan(sized, targets, total_tokens, fill)
    rows = sized.join(plan.select("src"), "src", "left_semi").select("id", "src", "n", (key if key is not None else random_key(F.col("id"))).alias("key"))
    rows = rows.withColumn("bucket", F.expr(f"cast((key >> {63 - BUCKET_BITS}) * {n_buckets} div {1 << BUCKET_BITS} as int)"))
    sums = rows.groupBy("src", "bucket").agg(F.sum("n").alias("tokens"))
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("src", "bucket", before.alias("offset")).join(plan, "src")
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("src", "bucket").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("inner", inner).join(offsets, ["src", "bucket"])
    at = F.col("offset") + F.col("inner")
    epochs = F.least(F.col("max_repeats"), F.ceil((F.col("budget") - at) / F.col("available")))
    out = placed.where(at < F.col("budget")).select("id", "source", "n", "budget", "available", at.alias("at"), F.explode(F.sequence(F.lit(1).cast("long"), epochs.cast("long"))).alias("epoch"))
    start = (F.col("epoch") - 1) * F.col("available") + F.col("at")
    return out.select("id", "source", F.col("epoch").cast("int").alias("epoch"), start.alias("start"), F.col("n").alias("n_tokens"), F.least(F.col("n"), F.col("budget") - start).alias("tokens"))


def shares(mixed: DataFrame, sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, fill: bool = False) -> DataFrame:
    """By listed source: target_share, max_repeats, available tokens, budget, tokens taken, repeats (tokens by
    available; null if there is none), planned_share (tokens by planned size; null if that is 0), actual_share (tokens
    by actual size; null if the mix is empty) and whether the budget was reached."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    p = _plan(sized, targets, total_tokens, fill).join(got, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    all_ = F.sum("tokens").over(Window.partitionBy())
    return p.select(
        "source", "target_share", F.col("max_repeats").cast("int").alias("max_repeats"), "documents", "available", "budget", "tokens",
        F.try_divide(F.col("tokens"), F.col("available")).alias("repeats"), F.try_divide(F.col("tokens"), F.col("planned")).alias("planned_share"),
        F.try_divide(F.col("tokens"), all_).alias("actual_share"), (F.col("tokens") >= F.col("budget")).alias("reached"),
    )
