"""Exact and near duplicates where the first seen wins."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.text import normalize_text, shingles, strip, text_hash
from granary.functions.wordruns import WordRuns, run_hashes
from granary.operators.sketch import code_table, id_filter, keep_ids, table_bits
from granary.operators.skew import HEAVY_ROWS, join_back
from granary.session import discard, materialize

LANES = 128


def min_chars_gate(df: DataFrame, text_col: str = "text", min_chars: int = 200) -> DataFrame:
    """Rows whose text, stripped, has at least ``min_chars`` code points. Null and empty texts go."""
    return df.where(F.length(strip(F.col(text_col))) >= F.lit(max(1, min_chars)))


def first_by_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The first row of each key by ``order``; partial aggregation before the shuffle keeps one row for each
    key and task. Null keys are one key."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.col(key).alias("__k")).agg(F.min_by(row, order).alias("__r")).select("__r.*")


def exact_first(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Rows whose normalised text was not seen at a lesser id. Only ids and hashes are shuffled for the choice.
    Null texts are one text; ids must be unique."""
    hashed = df.select(F.col(id_col), text_hash(F.col(text_col)).alias("__h"))
    first = hashed.groupBy("__h").agg(F.min(id_col).alias("__id"))
    return df.join(first.select("__id"), F.col(id_col) == F.col("__id"), "left_semi")


def shingle_hashes(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, items): distinct hashes of five-word runs; texts without words have no row."""
    some = df.where(F.length(strip(F.col(text_col))) > 0)
    return some.select(F.col(id_col).alias("id"), run_hashes(F.col(text_col)).alias("items"))


def md5_shingles(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """The same with the first 60 bits of the MD5 of each run, which other engines can follow."""
    items = F.transform(shingles(normalize_text(F.col(text_col))), lambda s: F.conv(F.left(F.md5(F.encode(s, "utf-8")), F.lit(15)), 16, 10).cast("long"))
    return df.where(F.length(strip(F.col(text_col))) > 0).select(F.col(id_col).alias("id"), items.alias("items"))


def _packed_sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = WordRuns()
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                h, at = sets(part.column(1).to_pylist())
                n = np.diff(at)
                keep = np.nonzero(n)[0]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep)), pa.array(n[keep].astype(np.int32)), pa.array([h[at[i] : at[i + 1]].tobytes() for i in keep], pa.binary())], ["id", "n", "items"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where("id is not null and t is not null").mapInArrow(run, "id long, n int, items binary")


def _flat(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(b.column(b.schema.get_field_index("items")).to_pylist()), np.uint64)


def _offers(codes: Broadcast, bits: int, p: int, q: int):
    """(token, id, n, pos): the items of each set that a partner must share one of, the rarest ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codes.value
        for b in batches:
            if not b.num_rows:
                continue
            n, h = b.column(1).to_numpy().astype(np.int64), _flat(b)
            doc = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((h, table[(h >> np.uint64(64 - bits)).astype(np.int64)], doc))
            pos = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            keep = pos < (n + (-n * p // q) + 1)[doc]
            doc = doc[keep]
            yield pa.RecordBatch.from_arrays([pa.array(h[order][keep].view(np.int64)), pa.array(b.column(0).to_numpy()[doc]), pa.array(n[doc].astype(np.int32)), pa.array(pos[keep].astype(np.int32))], ["token", "id", "n", "pos"])

    return run


def _meeting(offer: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs (a, b) of sets that meet on an item, a the smaller, where sizes and places still allow the overlap."""
    a, b = offer.select("token", F.col("id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa")), offer.select("token", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    reach = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    fits = smaller & (F.col("na") * q >= F.col("nb") * p) & (reach * (p + q) >= (F.col("na") + F.col("nb")) * p)
    return a.join(b, "token").where(fits).select("a", "b").distinct()


def _jaccard(p: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, sims = [], []
            for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(v, u)
                at[at == len(v)] = 0
                both = int((v[at] == u).sum())
                union = len(u) + len(v) - both
                if both * q >= union * p:
                    keep.append(i)
                    sims.append(both / union)
            k = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(k), b.column(1).take(k), pa.array(sims, pa.float64())], ["a", "b", "jaccard"])

    return run


def jaccard_pairs(df: DataFrame, id_col: str, text_col: str = "text", threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """Pairs (a < b, jaccard) of texts whose five-word runs share at least ``threshold`` of their union.

    Each set offers its rarest items, as many as a partner must hit at least one of; how rare an item is says a
    count table over all sets, whose collisions cost time and no results. Pairs that meet on an item, with sizes
    and places that still allow the overlap, are verified on the sorted sets. Only sets of such pairs travel. Both
    sides of the join are plain exchanges, so adaptive execution can split the lists of frequent items. Items are
    64-bit hashes. Null ids and texts without words take no part; ids must be unique. Texts that are equal should
    be removed first: each pair of them comes out."""
    p, q = threshold.numerator, threshold.denominator
    sets = materialize(_packed_sets(df, id_col, text_col), "sets", "none")
    bits = table_bits(sets.agg(F.sum("n").alias("n")).first().n or 0)
    codes = df.sparkSession.sparkContext.broadcast(code_table(sets.select("items"), _flat, bits)[0])
    offer = sets.mapInArrow(_offers(codes, bits, p, q), "token long, id long, n int, pos int")
    cand = materialize(_meeting(offer, p, q), "pairs")
    ids = cand.select("a").union(cand.select("b"))
    lists = keep_ids(sets.select("id", "items"), id_filter(ids, 2 * cand.count()))
    both = cand.join(lists.select(F.col("id").alias("a"), F.col("items").alias("xa")), "a").join(lists.select(F.col("id").alias("b"), F.col("items").alias("xb")), "b")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "xa", "xb").mapInArrow(_jaccard(p, q), "a long, b long, jaccard double")


def lsh_layout(threshold: float, lanes: int = LANES) -> tuple[int, int]:
    """Bands and rows that make the sum of the areas of wrong hits and misses least."""
    s = (np.arange(2000) + 0.5) / 2000
    best = (np.inf, 1, 1)
    for b in range(1, lanes + 1):
        for r in range(1, lanes // b + 1):
            hit = 1 - (1 - s**r) ** b
            cost = hit[s < threshold].sum() + (1 - hit[s >= threshold]).sum()
            best = min(best, (cost, b, r))
    return best[1], best[2]


def lane_constants(lanes: int = LANES, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Factors and addends of the hash functions x -> (x * factor + addend) mod 2**64."""
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, lanes, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, lanes, dtype=np.uint64)


def minhash(items: Column, lanes: int = LANES, seed: int = 1) -> Column:
    """Upper halves of the least values of the items under ``lanes`` hash functions; an empty set gives the greatest
    value everywhere."""
    mul, add = lane_constants(lanes, seed)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(s: pd.Series) -> pd.Series:
        out = []
        for x in s:
            if x is None or len(x) == 0:
                out.append(np.full(lanes, 2**32 - 1, np.int64))
                continue
            h = np.asarray(x, np.int64).view(np.uint64)
            least = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
            for lo in range(0, len(h), 4096):
                least = np.minimum(least, (h[lo : lo + 4096, None] * mul + add).min(0))
            out.append((least >> np.uint64(32)).astype(np.int64))
        return pd.Series(out)

    return run(items)


def signatures(df: DataFrame, id_col: str, text_col: str = "text", lanes: int = LANES, items: DataFrame | None = None) -> DataFrame:
    """(id, sig) of the sets ``items`` (id, items), or else of the five-word runs of the texts."""
    sets = items if items is not None else shingle_hashes(df, id_col, text_col)
    return sets.select("id", minhash(F.col("items"), lanes).alias("sig"))


def band_buckets(sig: DataFrame, threshold: float = 0.8, lanes: int = LANES) -> DataFrame:
    """(ord, band, bucket): one bucket for each band of a signature."""
    b, r = lsh_layout(threshold, lanes)
    bands = F.transform(F.sequence(F.lit(0), F.lit(b - 1)), lambda i: F.struct(i.alias("band"), F.xxhash64(i, F.slice("sig", i * r + 1, r)).alias("bucket")))
    return sig.select(F.col("id").alias("ord"), F.explode(bands).alias("x")).select("ord", "x.band", "x.bucket")


def lsh_candidates(sig: DataFrame, threshold: float = 0.8, lanes: int = LANES) -> DataFrame:
    """(id, band, first_id, n): for each bucket with several members one row for each of them, with the least
    member and their number. A bucket of many members is rows, not pairs, and no task holds one as a whole."""
    rows = materialize(band_buckets(sig, threshold, lanes), "buckets")
    per = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("ord").alias("first_id")).where("n > 1").withColumn("size", F.col("n"))
    return join_back(rows, per, "bucket", rows.count()).select(F.col("ord").alias("id"), "band", "first_id", F.col("size").alias("n"))


def greedy_first(members: DataFrame) -> DataFrame:
    """Ids to drop when ids come in order and one is dropped if it shares a bucket with a kept one before it.

    Rounds over (ord, bucket): an id falls as soon as a kept one with a lesser id is in one of its buckets, and
    stays as soon as it is the least open one in all of them. Rows of decided buckets leave, each round is a
    table in the shared folder that replaces the one before, and the number of rounds is the length of the longest
    chain of decisions. Buckets that hold many rows are joined by ``join_back``."""
    members = materialize(members.select("ord", "bucket"), "members")
    multi = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    open_ = materialize(join_back(members, multi, "bucket", members.count(), how="left_semi").distinct().withColumn("kept", F.lit(False)), "greedy")
    discard(members)
    dropped = None
    while True:
        total = open_.count()
        low = open_.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.when(F.col("kept"), F.col("ord"))).alias("mk"), F.min(F.when(~F.col("kept"), F.col("ord"))).alias("mu"))
        state = join_back(open_, low, "bucket", total).where(~F.col("kept")).groupBy("ord").agg(
            F.coalesce(F.max(F.col("mk") < F.col("ord")), F.lit(False)).alias("fall"), F.min(F.col("mu") == F.col("ord")).alias("stay"))
        state = materialize(state.where("fall or stay").select("ord", "fall"), "decided")
        fall = state.where("fall").select("ord")
        dropped = fall if dropped is None else dropped.union(fall)
        if state.isEmpty():
            return dropped
        nxt = open_.join(state, "ord", "left").where("fall is null or not fall").select("ord", "bucket", (F.col("kept") | F.col("fall").isNotNull()).alias("kept"))
        # Read twice, three times where keys are heavy.
        nxt = materialize(nxt, "next") if total > HEAVY_ROWS else nxt
        alive = nxt.groupBy("bucket").agg(F.count("*").alias("n"), F.max(~F.col("kept")).alias("alive")).where("alive").drop("alive")
        last, open_ = open_, materialize(join_back(nxt, alive, "bucket", total, how="left_semi"), "greedy")
        discard(last)
        discard(nxt)


def near_dedup_lsh(df: DataFrame, id_col: str, text_col: str = "text", threshold: float = 0.8, items: DataFrame | None = None) -> DataFrame:
    """Rows left after dropping each whose signature meets a kept earlier one in a band, without verification.
    A pair at the threshold meets with a probability of about 0.4 only; ``near_dedup_verified`` is exact."""
    gone = greedy_first(band_buckets(signatures(df, id_col, text_col, items=items), threshold))
    return df.join(gone, F.col(id_col) == F.col("ord"), "left_anti")


def near_dedup_verified(df: DataFrame, id_col: str, text_col: str = "text", threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """The same with the true similarity: a row goes if a kept earlier one is at least ``threshold`` alike."""
    pairs = materialize(jaccard_pairs(df, id_col, text_col, threshold).select("a", "b"), "pairs")
    edge = pairs.withColumn("bucket", F.xxhash64("a", "b"))
    gone = greedy_first(edge.select(F.col("a").alias("ord"), "bucket").union(edge.select("b", "bucket")))
    return df.join(gone, F.col(id_col) == F.col("ord"), "left_anti")
