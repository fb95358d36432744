"""Pairs of records whose sets of five-word runs share at least 0.8 of their union."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.wordruns import WordRuns
from granary.operators.sketch import code_table, id_filter, keep_ids, table_bits
from granary.operators.skew import join_back
from granary.session import discard, materialize

THRESHOLD = Fraction(4, 5)
# Weight of a step of binary search against one of the merge, in the choice of the number of long lists.
MU = 0.002
PROBES = 32
SET_SCHEMA = "id long, c1 long, c2 long, n int, items binary"


def need(n: np.ndarray, t: Fraction = THRESHOLD) -> np.ndarray:
    """Least overlap of a set of n items with any partner: ceil(t * n)."""
    return -(-n * t.numerator // t.denominator)


def long_lists(n: np.ndarray, longest: int, t: Fraction = THRESHOLD, mu: float = MU) -> np.ndarray:
    """How many of the n lists of a set are set aside as long: L = T / (mu * log2 M + 1), where T is the least
    overlap and M the length of the longest list of all; at most T - 1, so that T - L occurrences are left to count."""
    least = need(n, t)
    return np.maximum(0, np.minimum(least - 1, np.floor(least / (mu * np.log2(max(2, longest)) + 1)).astype(np.int64)))


def shingle_sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, 128-bit hash of the set (c1, c2), its size and its sorted 64-bit items.

    Null texts and texts without words have no set and are left out, as are null ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = WordRuns()
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                h, at = sets(part.column(1).to_pylist())
                n = np.diff(at)
                keep = np.nonzero(n)[0]
                ids = part.column(0).to_numpy(zero_copy_only=False)[keep]
                items = [h[at[i] : at[i + 1]].tobytes() for i in keep]
                c = [xxhash.xxh3_128_digest(x) for x in items]
                both = np.frombuffer(b"".join(c), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(n[keep].astype(np.int32)), pa.array(items, pa.binary())], ["id", "c1", "c2", "n", "items"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where("id is not null and t is not null").mapInArrow(run, SET_SCHEMA)


def _flat(b: pa.RecordBatch, name: str = "items") -> np.ndarray:
    return np.frombuffer(b"".join(b.column(b.schema.get_field_index(name)).to_pylist()), np.uint64)


class ListLengths:
    """Lengths of the inverted lists, by item, from a count table over all sets; and how a set is divided by them."""

    def __init__(self, codes: np.ndarray, longest: int, t: Fraction, mu: float):
        self.codes, self.bits, self.longest, self.t, self.mu = codes, len(codes).bit_length() - 1, longest, t, mu

    def divide(self, n: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the items h of sets of sizes n, shortest list first within each set; the place of each in
        that order; and the number of short lists of each set."""
        doc = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((h, self.codes[(h >> np.uint64(64 - self.bits)).astype(np.int64)], doc))
        pos = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        return order, pos, n - long_lists(n, self.longest, self.t, self.mu)


def list_lengths(sets: DataFrame, t: Fraction = THRESHOLD, mu: float = MU) -> tuple[Broadcast, int]:
    """The lengths for all tasks, and that of the longest list. The table has about one cell for each item up to the largest size of ``sketch``; beyond that, lists that are
    shorter than the noise of a cell (about three times the root of items by cells) come in any order. Which lists are
    short decides how long the search takes and never what it finds."""
    bits = table_bits(sets.agg(F.sum("n").alias("n")).first().n or 0)
    codes, longest = code_table(sets.select("items"), _flat, bits)
    return sets.sparkSession.sparkContext.broadcast(ListLengths(codes, longest, t, mu)), longest


def set_classes(sets: DataFrame, lengths: Broadcast) -> DataFrame:
    """(c1, c2, rep, n, short): one row for each different set, with its least id and the items of its short lists,
    shortest first. Copies are brought together before any item leaves the row, so they add no postings; a set with many
    copies is one row from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n = b.column(3).to_numpy().astype(np.int64)
            h = _flat(b)
            order, pos, short = lengths.value.divide(n, h)
            keep = pos < np.repeat(short, n)
            packed, ends = h[order][keep].tobytes(), np.cumsum(8 * short)
            parts = pa.array([packed[e - 8 * k : e] for e, k in zip(ends.tolist(), short.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), parts], ["id", "c1", "c2", "n", "short"])

    rows = sets.mapInArrow(run, "id long, c1 long, c2 long, n int, short binary")
    return rows.groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("short").alias("short"))


def short_lists(classes: DataFrame) -> DataFrame:
    """Postings (token, rep, n, pos) of the short lists; pos counts from 0 in the order of the lists' lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = _flat(b, "short")
            k = np.fromiter((len(x) // 8 for x in b.column(2).to_pylist()), np.int64, b.num_rows)
            pos = np.arange(len(h)) - np.repeat(np.cumsum(k) - k, k)
            doc = np.repeat(np.arange(b.num_rows), k)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column(0).take(pa.array(doc)), b.column(1).take(pa.array(doc)), pa.array(pos.astype(np.int32))], ["token", "rep", "n", "pos"])

    return classes.select("rep", "n", "short").mapInArrow(run, "token long, rep long, n int, pos int")


def _long(n: Column, longest: int, t: Fraction, mu: float) -> Column:
    """``long_lists`` as a column."""
    least = F.ceil(n * t.numerator / F.lit(t.denominator))
    return F.greatest(F.lit(0), F.least(least - 1, F.floor(least / F.lit(mu * float(np.log2(max(2, longest))) + 1))))


def merge_short(postings: DataFrame, longest: int, t: Fraction = THRESHOLD, mu: float = MU) -> DataFrame:
    """Pairs (a, b, hits): sets with their number of common short lists, where that is at least T - L.

    The merge is a sort-merge join of the lists with themselves, and the count is taken by pair; T is the overlap
    that the two sizes need, ceil(t / (1 + t) (na + nb)). Lists are in one order for all sets. Of two sets, let a's last
    short list come no later than b's: then what they share among a's short lists is short for both, and only a's L long
    lists can hold more of it. So hits >= T - max(La, Lb) for any pair that is to be found. A posting is skipped
    where sizes, or the items before and after it, do not allow T. Both sides of the join are plain exchanges of the same
    rows: adaptive execution reads one for both, and splits lists that are hot."""
    a = postings.select("token", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    b = postings.select("token", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    p, q = t.numerator, t.denominator
    na, nb, pa_, pb_ = (F.col(c) for c in ("na", "nb", "pa", "pb"))
    reach = F.least(pa_, pb_) + 1 + F.least(na - pa_ - 1, nb - pb_ - 1)
    fits = ((na < nb) | ((na == nb) & (F.col("a") < F.col("b")))) & (na * q >= nb * p) & (reach * (p + q) >= (na + nb) * p)
    pairs = a.join(b, "token").where(fits).groupBy("a", "b").agg(F.count("*").alias("hits"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    least = F.ceil((na + nb) * p / F.lit(p + q))
    return pairs.where(F.col("hits") >= least - F.greatest(_long(na, longest, t, mu), _long(nb, longest, t, mu))).select("a", "b", F.col("hits").cast("int").alias("hits"))


def _found_in(x: np.ndarray, y: np.ndarray) -> int:
    if not len(x) or not len(y):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def probe_long(hits: int, x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], least: int) -> int:
    """Overlap of two sets (short, long: sorted items), given their hits on short lists. Items on long lists are
    looked up by binary search in the other set, some at a time, until ``least`` is out of reach; then -1."""
    (xs, xl), (ys, yl) = x, y
    for items, other in ((xl, yl), (xl, ys), (yl, xs)):
        # An item of x's long lists is in one of y's halves, so the second look takes no more than is left.
        for lo in range(0, len(items), PROBES):
            hits += _found_in(items[lo : lo + PROBES], other)
            if items is xl and other is yl and hits + len(xl) - min(len(xl), lo + PROBES) + min(len(xl), len(ys)) + min(len(yl), len(xs)) < least:
                return -1
    return hits


def _verify(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, q = t.numerator, t.denominator
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(2, 7)]
            keep, sims = [], []
            for i, (hits, sx, lx, sy, ly) in enumerate(zip(*cols)):
                x, y = tuple(np.frombuffer(v, np.uint64) for v in (sx, lx)), tuple(np.frombuffer(v, np.uint64) for v in (sy, ly))
                size = len(x[0]) + len(x[1]) + len(y[0]) + len(y[1])
                both = probe_long(hits, x, y, -(-size * p // (p + q)))
                if both * (p + q) >= size * p:
                    keep.append(i)
                    sims.append(both / (size - both))
            k = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(k), b.column(1).take(k), pa.array(sims, pa.float64())], ["a", "b", "similarity"])

    return run


def _halves(lengths: Broadcast):
    """(id, short, long): the items of each set by the length of their lists, each half sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            items = [np.frombuffer(x, np.uint64) for x in b.column(1).to_pylist()]
            n = np.fromiter(map(len, items), np.int64, len(items))
            h = np.concatenate(items)
            order, pos, short = lengths.value.divide(n, h)
            h, at = h[order], np.cumsum(n) - n
            s = [np.sort(h[i : i + k]).tobytes() for i, k in zip(at, short)]
            rest = [np.sort(h[i + k : i + m]).tobytes() for i, k, m in zip(at, short, n)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.binary()), pa.array(rest, pa.binary())], ["id", "short", "long"])

    return run


class NearDuplicates:
    """``members``: id, c1, c2, rep (least id with the same set). ``links``: a < b, similarity: pairs of
    representatives of different sets."""

    def __init__(self, members: DataFrame, links: DataFrame):
        self.members, self.links = members, links

    def pairs(self) -> DataFrame:
        """All pairs of records: those of linked sets and those of one set. Every pair comes once."""
        m = self.members.select("id", "rep")
        x, y = m.select(F.col("id").alias("ia"), F.col("rep").alias("a")), m.select(F.col("id").alias("ib"), F.col("rep").alias("b"))
        across = self.links.select("a", "b").join(x, "a").join(y, "b").select(F.least("ia", "ib").alias("rec_id_a"), F.greatest("ia", "ib").alias("rec_id_b"))
        within = x.join(y, F.col("a") == F.col("b")).where("ia < ib").select(F.col("ia").alias("rec_id_a"), F.col("ib").alias("rec_id_b"))
        return across.unionByName(within).where("rec_id_a < rec_id_b").distinct()


def near_duplicates(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", t: Fraction = THRESHOLD, mu: float = MU) -> NearDuplicates:
    """T-occurrence search by DivideSkip.

    1. Texts become sets of 64-bit items, kept as a table. 2. A count table over all sets gives the lengths of the
    inverted lists; each set divides its lists into L long ones and the short rest. 3. Short lists are merged and
    occurrences counted by pair; pairs with T - L of them are candidates. 4. Long lists are probed by binary search for the
    candidates, which gives the exact overlap, and those that reach T stay. No pair at or above ``t`` is lost.

    Items are 64-bit and sets 128-bit hashes; the result is exact but for collisions of these. Null and empty texts and
    null ids take no part; a repeated row changes nothing; equal sets are one class whose least id represents it. A
    text of fewer than five words is one item. Other columns are ignored."""
    sets = materialize(shingle_sets(df, id_col, text_col), "sets", "none")
    lengths, longest = list_lengths(sets, t, mu)
    classes = materialize(set_classes(sets, lengths), "classes", "none")
    pairs = materialize(merge_short(short_lists(classes), longest, t, mu), "candidates")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    lists = keep_ids(sets.select("id", "items"), id_filter(ids, 2 * pairs.count())).mapInArrow(_halves(lengths), "id long, short binary, long binary")
    la, lb = lists.select(F.col("id").alias("a"), F.col("short").alias("sa"), F.col("long").alias("la")), lists.select(F.col("id").alias("b"), F.col("short").alias("sb"), F.col("long").alias("lb"))
    both = pairs.join(la, "a").join(lb, "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "hits", "sa", "la", "sb", "lb")
    links = both.mapInArrow(_verify(t), "a long, b long, similarity double")
    members = sets.select("id", "c1", "c2").join(classes.select("c1", "c2", "rep"), ["c1", "c2"]).select("id", "c1", "c2", "rep")
    return NearDuplicates(members, materialize(links.dropDuplicates(["a", "b"]), "links"))


def groups(found: NearDuplicates) -> DataFrame:
    """id, class_id (least id with an equal set), links (other classes it is linked to), group_id (least id of
    all records that are connected by links). Labels move by alternating large-star and small-star steps; each
    round is a table in the shared folder that replaces the one before, and holds no more rows than there are links. The
    center of a star can have many rows; they are joined by ``join_back``."""
    edges = found.links.select("a", "b")
    e, before, last = edges, None, None
    while True:
        both = materialize(e.union(e.select("b", "a")), "both")
        total = both.count()
        near = both.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("m")).select("a", "n", F.least("a", "m").alias("m"))
        large = join_back(both, near, "a", total).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = materialize(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "down")
        low = down.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("m"))
        small = join_back(down, low, "a", total).select(F.col("b").alias("x"), "m").union(low.select(F.col("a").alias("x"), "m")).where("x <> m").distinct()
        e = materialize(small.select(F.col("x").alias("a"), F.col("m").alias("b")), "star")
        for old in (both, down, *([last] if last is not None else [])):
            discard(old)
        last = e
        state = e.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("h")).first()
        if before == (state.n, state.h):
            break
        before = (state.n, state.h)
    label = e.groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("root"))
    degree = edges.union(edges.select("b", "a")).groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("links"))
    known = materialize(found.members.select("rep").distinct().join(label, "rep", "left").join(degree, "rep", "left"), "labels")
    m = found.members.join(known, "rep").distinct()
    return m.select("id", F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("group_id"))
