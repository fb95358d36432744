"""Texts assigned to sequences of a fixed number of tokens."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions import tokenizers as tok
from granary.session import materialize

GROUP_ITEMS = 8_000
LINEAR_COST = 1.0
QUADRATIC_COST = 1.0 / 4096
GROUPS_A_TASK = 50


def pack_sizes(sizes: np.ndarray, capacity: int, linear: float = LINEAR_COST, quadratic: float = QUADRATIC_COST, open_share: float | None = None) -> np.ndarray:
    """Sequence number for each size (1..capacity). Sizes are taken in descending order; each goes to the
    sequence of least cost, ``linear * tokens + quadratic * sum(size ** 2)``, among those with room for it;
    where none has room a new one is opened. Ties go to the older sequence. ``open_share`` of the least number
    of sequences are open from the start, so that costs are level from the first text on; without it, all but
    half of the mean size by capacity: the smaller the texts, the more sequences can be filled to the brim.

    For each amount of room there is a heap of sequences by cost, and over the amounts a tree of least costs:
    one placement takes a number of steps in the logarithm of the capacity."""
    out = np.zeros(len(sizes), np.int64)
    width = 1 << capacity.bit_length()
    inf = float("inf")
    tree = [inf] * (2 * width)
    heaps: list[list] = [[] for _ in range(capacity + 1)]
    room: list[int] = []
    cost: list[float] = []

    def fix(r: int) -> None:
        i = width + r
        tree[i] = heaps[r][0][0] if heaps[r] else inf
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            v = a if a <= b else b
            if tree[i] == v:
                break
            tree[i] = v
            i >>= 1

    def push(s: int) -> None:
        r = room[s]
        heapq.heappush(heaps[r], (cost[s], s))
        if heaps[r][0][1] == s:
            fix(r)

    def open_() -> int:
        room.append(capacity)
        cost.append(0.0)
        return len(room) - 1

    if open_share is None:
        open_share = 1 - sizes.mean() / (2 * capacity) if len(sizes) else 0
    for _ in range(int(open_share * sizes.sum() / capacity)):
        push(open_())
    for i in np.argsort(-sizes, kind="stable"):
        w = int(sizes[i])
        # The least cost among amounts of room from w on.
        lo, hi, best, node = width + w, 2 * width, inf, 0
        while lo < hi:
            if lo & 1:
                if tree[lo] < best:
                    best, node = tree[lo], lo
                lo += 1
            if hi & 1:
                hi -= 1
                if tree[hi] < best:
                    best, node = tree[hi], hi
            lo >>= 1
            hi >>= 1
        if node == 0:
            s = open_()
        else:
            while node < width:
                node = 2 * node if tree[2 * node] <= tree[2 * node + 1] else 2 * node + 1
            r = node - width
            s = heapq.heappop(heaps[r])[1]
            fix(r)
        out[i] = s
        room[s] -= w
        cost[s] += linear * w + quadratic * w * w
        push(s)
    return out


def token_sizes(df: DataFrame, id_col: str, text_col: str, name: str = tok.DEFAULT_NAME, folder: str = tok.DEFAULT_DIR) -> DataFrame:
    """(item, n_tokens) of all texts; null texts have 0 tokens."""
    return df.select(F.col(id_col).alias(id_col), tok.token_count(F.col(text_col), name, folder).alias("n_tokens"))


def pack(sized: DataFrame, capacities: DataFrame, id_col: str = "doc_id", group_items: int = GROUP_ITEMS) -> DataFrame:
    """Place (id_col, n_tokens) into sequences of each capacity (pack_name, seq_len; a handful of rows, collected).

    Result, one row for each piece: pack_name, seq_len, group_no, seq_no (within the group), id, part_no,
    first_token, n_tokens, seq_tokens. An item longer than the capacity is cut into full sequences of its own
    and a rest that is packed; no other is split. Items without tokens, null ids and null or non-positive
    capacities give no row; a repeated row is an item of its own, equal capacity names stay apart by seq_len.

    Items are spread by the hash of their id over groups of about ``group_items``, so no task holds more at a time,
    whatever the input; a group wastes at most what its last sequences leave open. A task takes up to fifty groups
    one after the other, and no two tasks share one."""
    packs = [(r.pack_name, r.seq_len) for r in capacities.where("seq_len > 0").select("pack_name", "seq_len").distinct().collect()]
    packs.sort(key=lambda x: (x[1], x[0] or ""))
    n_groups = max(1, round(sized.count() / group_items))
    tasks = max(min(n_groups, 4 * sized.sparkSession.sparkContext.defaultParallelism), -(-n_groups // GROUPS_A_TASK))
    items = sized.where(F.col(id_col).isNotNull() & (F.col("n_tokens") > 0)).select(
        F.col(id_col).cast("long").alias("id"), F.col("n_tokens").cast("long").alias("n"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_groups)).cast("int").alias("group_no")
    )
    schema = f"pack_name string, seq_len int, group_no int, seq_no int, {id_col} long, part_no int, first_token long, n_tokens int, seq_tokens int"
    names, kinds = zip(*[x.strip().split(" ") for x in schema.split(",")])
    arrow = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}

    def place(ids: np.ndarray, n: np.ndarray, group: int) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((ids, -n))
        ids, n = ids[order], n[order]
        for name, cap in packs:
            full, rest = n // cap, n % cap
            # Full pieces of long items.
            long_ = np.repeat(np.arange(len(n)), full)
            part = np.arange(len(long_)) - np.repeat(np.cumsum(full) - full, full)
            r = np.nonzero(rest)[0]
            seq = pack_sizes(rest[r], cap)
            k = int(seq.max()) + 1 if len(seq) else 0
            used = np.bincount(seq, weights=rest[r], minlength=k).astype(np.int64)
            filled = np.nonzero(used)[0]
            number = np.zeros(max(k, 1), np.int64)
            number[filled] = np.arange(len(filled))
            pieces = np.concatenate([full[r], part])
            rows = len(pieces)
            cols = (
                [name] * rows, np.full(rows, cap), np.full(rows, group), np.concatenate([number[seq], len(filled) + np.arange(len(long_))]), np.concatenate([ids[r], ids[long_]]),
                pieces, pieces * cap, np.concatenate([rest[r], np.full(len(long_), cap)]), np.concatenate([used[seq], np.full(len(long_), cap)]),
            )
            yield pa.RecordBatch.from_arrays([pa.array(c, arrow[t]) for c, t in zip(cols, kinds)], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        group = -1
        for b in batches:
            ids, n, g = (b.column(i).to_numpy() for i in range(3))
            cuts = [0, *(np.nonzero(np.diff(g))[0] + 1).tolist(), len(g)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and g[lo] != group:
                    yield from place(*map(np.concatenate, zip(*held)), group)
                    held = []
                group = int(g[lo])
                held.append((ids[lo:hi], n[lo:hi]))
        if held:
            yield from place(*map(np.concatenate, zip(*held)), group)

    return items.repartitionById(tasks, F.expr(f"group_no % {tasks}").cast("int")).sortWithinPartitions("group_no").mapInArrow(run, schema)


def pack_documents(df: DataFrame, capacities: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = tok.DEFAULT_NAME, folder: str = tok.DEFAULT_DIR) -> DataFrame:
    """Tokenize once, keep the sizes in the shared folder, pack for every capacity."""
    return pack(materialize(token_sizes(df, id_col, text_col, name, folder), "sizes"), capacities, id_col)


def report(packed: DataFrame) -> DataFrame:
    """By capacity: pieces, tokens, sequences, least possible number of sequences, share filled, and the spread
    of the estimated cost over the sequences."""
    seqs = packed.groupBy("pack_name", "seq_len", "group_no", "seq_no").agg(
        F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"),
        F.sum(LINEAR_COST * F.col("n_tokens") + QUADRATIC_COST * F.col("n_tokens") * F.col("n_tokens")).alias("cost"),
    )
    return seqs.groupBy("pack_name", "seq_len").agg(
        F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens"), F.count("*").alias("sequences"),
        F.ceil(F.sum("tokens") / F.first("seq_len")).alias("least_sequences"),
        (F.sum("tokens") / (F.count("*") * F.first("seq_len"))).alias("filled"),
        (F.stddev_pop("cost") / F.avg("cost")).alias("cost_spread"),
    )


def checked(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """By capacity: items, pieces and tokens placed, sequences over their capacity, items that are split though they
    fit, and items with a gap or an overlap between their pieces; the last three must be 0."""
    seqs = packed.groupBy("pack_name", "seq_len", "group_no", "seq_no").agg(F.sum("n_tokens").alias("t")).groupBy("pack_name", "seq_len").agg(F.sum((F.col("t") > F.col("seq_len")).cast("long")).alias("overfull"))
    items = packed.groupBy("pack_name", "seq_len", id_col).agg(F.count("*").alias("k"), F.sum(F.col("n_tokens").cast("long")).alias("t"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"))
    by = items.groupBy("pack_name", "seq_len").agg(
        F.count("*").alias("items"), F.sum("k").alias("pieces"), F.sum("t").alias("tokens"),
        F.sum(((F.col("k") > 1) & (F.col("t") <= F.col("seq_len"))).cast("long")).alias("split"), F.sum((F.col("end") != F.col("t")).cast("long")).alias("gaps"))
    return by.join(seqs, ["pack_name", "seq_len"]).select("pack_name", "seq_len", "items", "pieces", "tokens", "overfull", "split", "gaps")
