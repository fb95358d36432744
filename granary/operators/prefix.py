"""Running sums over all rows in order, without putting them in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import materialize


def _same(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Is each value equal to the one before it? Nulls are equal. The first is not."""
    a, b = col.slice(1), col.slice(0, max(0, len(col) - 1))
    eq = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null()))
    return np.concatenate([[False], eq.to_numpy(zero_copy_only=False)]) if len(col) else np.zeros(0, bool)


def _local_sums(n_by: int, out: str):
    """Sums before each row within runs of equal group columns (the first ``n_by``) of a sorted partition; the
    value is the last column but one, the number of the partition the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list | None = None
        total = 0
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(b.num_columns - 2).to_numpy()
            new = np.ones(b.num_rows, bool)
            if n_by:
                new = ~np.logical_and.reduce([_same(b.column(i)) for i in range(n_by)])
                new[0] = last is None or [b.column(i)[0].as_py() for i in range(n_by)] != last
            else:
                new[:] = False
                new[0] = last is None
            before = np.cumsum(v) - v
            starts = np.nonzero(new)[0]
            base = np.zeros(b.num_rows, np.int64)
            run_no = np.cumsum(new) - 1
            if len(starts):
                base = np.where(run_no >= 0, before[starts][np.maximum(run_no, 0)], 0)
            local = before - base + np.where(run_no < 0, total, 0)
            total = int(local[-1] + v[-1])
            last = [b.column(i)[b.num_rows - 1].as_py() for i in range(n_by)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local, pa.int64())], [*b.schema.names, out])

    return run


def running_sum(df: DataFrame, order: list[Column], value: Column, out: str = "before", by: list[str] | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each row (0 for the first), within groups ``by``.

    Rows are range-partitioned by group and order, once; each sorted partition is summed up as it passes through
    Arrow and written to the shared folder. What lies before a partition comes from the totals, of which there are
    as many as partitions and groups in them. The order must be total for a unique result. Null values count as
    0; null groups are one group."""
    by = by or []
    keys = [F.col(c) for c in by]
    rest = [c for c in df.columns if c not in by]
    parts = df.withColumn("__v", F.coalesce(value.cast("long"), F.lit(0).cast("long"))).repartitionByRange(*keys, *order)
    ordered = parts.sortWithinPartitions(*keys, *order).select(*by, *rest, "__v", F.spark_partition_id().alias("__p"))
    schema = T.StructType([*ordered.schema.fields, T.StructField("__s", T.LongType())])
    held = materialize(ordered.mapInArrow(_local_sums(len(by), "__s"), schema), "ordered")
    totals = held.groupBy(*by, "__p").agg(F.sum("__v").alias("__t"))
    w = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col("__p").alias("__q"), F.coalesce(F.sum("__t").over(w), F.lit(0)).alias("__o"))
    match = F.col("__p") == F.col("__q")
    for i, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    return held.join(offsets, match).select(*df.columns, (F.col("__s") + F.col("__o")).alias(out))


def running_count(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """``df`` with the number of each row in order, from 1."""
    return running_sum(df, order, F.lit(1), out).withColumn(out, F.col(out) + 1)
