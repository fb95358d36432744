"""Joins of rows with an aggregate of theirs where one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_ROWS = 200_000
HEAVY_KEYS = 5_000


def join_back(rows: DataFrame, agg: DataFrame, key: str, total: int, n: str = "n", how: str = "inner") -> DataFrame:
    """``rows`` joined with ``agg``, one row for each key with the number ``n`` of its rows; ``total`` is their sum.

    Adaptive execution does not split a join side that is an aggregate, so a hot key would be one task. Keys
    with more than max(HEAVY_ROWS, total / HEAVY_KEYS) rows are at most HEAVY_KEYS in number whatever the input: they
    are broadcast and their rows stay where they are; all others meet in a shuffled join. ``how`` is inner or
    left_semi; ``n`` is left out of the result. ``rows`` are read twice and should be a table."""
    limit = max(HEAVY_ROWS, total // HEAVY_KEYS)
    if total <= limit:
        return rows.join(agg.drop(n), key, how)
    heavy, light = agg.where(F.col(n) > limit).drop(n), agg.where(F.col(n) <= limit).drop(n)
    hot = rows.join(F.broadcast(heavy), key, how)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return hot.unionByName(rest.join(light, key, how))
