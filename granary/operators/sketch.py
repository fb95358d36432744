"""Hash tables of bounded size that count over all rows, and filters made of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.wordruns import mix

CHUNK_BITS = 16
FAN_IN = 32
# Largest table: 2**25 cells, 64 MB in a task and 32 MB where it is broadcast.
MIN_BITS, MAX_BITS = 16, 25
BITS_PER_ID = 8


def table_bits(n: int) -> int:
    """Bits of a table for ``n`` values: about one cell for each up to the largest table."""
    return min(MAX_BITS, max(MIN_BITS, int(n).bit_length()))


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b, max_output_size=4 << CHUNK_BITS), dtype=np.uint32)


def _sum(t: pa.Table) -> pa.Table:
    total = np.zeros(1 << CHUNK_BITS, np.uint32)
    for b in t.column("packed"):
        total += _unpack(b.as_py())
    return pa.table([[t.column("chunk")[0].as_py()], [t.column("part")[0].as_py()], [_pack(total)]], schema=pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("packed", pa.binary())]))


def _chunks(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Counts of 64-bit hashes over all rows of ``df`` in 2**bits cells, chosen by the top bits, a chunk at a time.

    Every task counts into a table of its own, in 16 bits a cell; a full cell stays full, which only concerns values a
    task has more than 65,535 times. Tables travel compressed in chunks and are added up in a tree, at most 32 at a
    time, so neither a task nor the driver holds more than a fixed number of bytes however many tasks there are."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(1 << bits, np.uint16)
        some = False
        for b in batches:
            h = hashes(b)
            if len(h):
                some = True
                at, n = np.unique((h >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
                counts[at] = np.minimum(65_535, counts[at] + n)
        if some:
            part = TaskContext.get().partitionId()
            for c, a in enumerate(counts.reshape(-1, 1 << CHUNK_BITS)):
                if a.any():
                    yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "part": pa.array([part], pa.int32()), "packed": pa.array([_pack(a.astype(np.uint32))], pa.binary())})

    schema = "chunk int, part int, packed binary"
    parts, width = df.mapInArrow(tables, schema), max(1, df.rdd.getNumPartitions())
    while width > 1:
        parts = parts.withColumn("part", F.expr(f"cast(part div {FAN_IN} as int)")).groupBy("chunk", "part").applyInArrow(_sum, schema)
        width = -(-width // FAN_IN)
    for r in parts.select("chunk", "packed").toLocalIterator():
        yield slice(r.chunk << CHUNK_BITS, (r.chunk + 1) << CHUNK_BITS), _unpack(bytes(r.packed))


def count_table(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """All cells of the table."""
    bits = max(bits, CHUNK_BITS)
    total = np.zeros(1 << bits, np.uint32)
    for at, n in _chunks(df, hashes, bits):
        total[at] = n
    return total


def log_codes(counts: np.ndarray) -> np.ndarray:
    """One byte for each cell, growing with the count."""
    return np.minimum(255, np.round(8 * np.log2(1.0 + counts))).astype(np.uint8)


def code_table(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> tuple[np.ndarray, int]:
    """``log_codes`` of all cells, made chunk by chunk, and the greatest count."""
    bits = max(bits, CHUNK_BITS)
    codes, most = np.zeros(1 << bits, np.uint8), 0
    for at, n in _chunks(df, hashes, bits):
        codes[at] = log_codes(n)
        most = max(most, int(n.max()))
    return codes, most


def _spread(x: np.ndarray) -> np.ndarray:
    return mix(mix(x.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)))


def id_filter(ids: DataFrame, n: int) -> Broadcast | None:
    """Bits of the ids (one long column, about ``n`` rows) for ``keep_ids``. None where they would need more than
    the largest table: there the join that follows has to do without."""
    bits = max(MIN_BITS, int(BITS_PER_ID * n).bit_length())
    if bits > MAX_BITS:
        return None
    table = np.zeros((1 << bits) // 8, np.uint8)
    for at, n in _chunks(ids, lambda b: _spread(b.column(0).to_numpy()), bits):
        table[at.start // 8 : at.stop // 8] = np.packbits(n > 0)
    return ids.sparkSession.sparkContext.broadcast((bits, table))


def keep_ids(df: DataFrame, wanted: Broadcast | None) -> DataFrame:
    """Rows whose first column may be one of the ids of the filter: all that are, and a few others."""
    if wanted is None:
        return df

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, table = wanted.value
        for b in batches:
            k = (_spread(b.column(0).to_numpy()) >> np.uint64(64 - bits)).astype(np.int64)
            yield b.filter(pa.array((table[k >> 3] >> (7 - (k & 7)).astype(np.uint8)) & 1 == 1))

    return df.mapInArrow(only, df.schema)
