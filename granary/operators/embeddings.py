"""Rows of embedding matrices: means, new rows, updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BLOCK = 64


def mean_vectors(df: DataFrame, by: list[str], vec: str, dims: int) -> DataFrame:
    """(by, ``mean``): the mean of the vectors of each group in double precision. A vector goes through the
    aggregation in blocks of 64 dimensions, so plans do not grow with its width; one that fits a block stays whole."""
    def means(of: str, n: int) -> Column:
        return F.array(*[F.avg(F.get(F.col(of), F.lit(i)).cast("double")) for i in range(n)])

    if dims <= BLOCK:
        return df.groupBy(*by).agg(means(vec, dims).alias("mean"))
    parts = df.select(*by, F.explode(F.sequence(F.lit(0), F.lit((dims - 1) // BLOCK))).alias("__b"), vec).select(*by, "__b", F.slice(vec, F.col("__b") * BLOCK + 1, BLOCK).alias("__x"))
    blocks = parts.groupBy(*by, "__b").agg(means("__x", BLOCK).alias("__m"))
    whole = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("__b", "__m"))), lambda x: x["__m"]))
    return blocks.groupBy(*by).agg(F.slice(whole, 1, dims).alias("mean"))


def width(emb: DataFrame) -> int:
    """Dimensions of the matrix, from its first row."""
    r = emb.select(F.size("embedding").alias("d")).where("d > 0").first()
    return r.d if r else 0


def global_mean(emb: DataFrame) -> DataFrame:
    """One row, ``mean``: the mean of all rows of the matrix."""
    return mean_vectors(emb, [], "embedding", width(emb))


def mean_init(ids: DataFrame, emb: DataFrame, key: str, ids_col: str = "ids") -> DataFrame:
    """(key, mean): the mean of the rows of each key's ids, repeated ids counted as often as they stand; ids
    outside the matrix are ignored, and a key without any valid id gets the mean of the whole matrix."""
    d = width(emb)
    parts = ids.select(key, F.explode(ids_col).alias("vec_id")).join(emb.select("vec_id", "embedding"), "vec_id")
    own = mean_vectors(parts, [key], "embedding", d)
    whole = global_mean(emb).select(F.col("mean").alias("__all"))
    return ids.select(key).join(own, key, "left").crossJoin(F.broadcast(whole)).select(key, F.coalesce("mean", "__all").alias("mean"))


def new_rows(ids: DataFrame, matrix: DataFrame, key: str = "token_id", ids_col: str = "ids", output: str | None = None) -> DataFrame:
    """(key, input, output): rows of new tokens for the input matrix (vec_id, embedding) and, if ``output`` names a
    column with a second one, for the output matrix; tied matrices have null there."""
    own = mean_init(ids, matrix, key, ids_col).withColumnRenamed("mean", "input")
    if output is None:
        return own.withColumn("output", F.lit(None).cast("array<double>"))
    second = mean_init(ids, matrix.select("vec_id", F.col(output).alias("embedding")), key, ids_col).withColumnRenamed("mean", "output")
    return own.join(second, key)


def apply_init(emb: DataFrame, new: DataFrame) -> DataFrame:
    """The matrix with the rows of ``new`` (vec_id, embedding) in place of its own."""
    n = new.select(F.col("vec_id").alias("__v"), F.col("embedding").alias("__e"))
    return emb.join(n, F.col("vec_id") == F.col("__v"), "left").withColumn("embedding", F.coalesce("__e", "embedding")).drop("__v", "__e")


def unnest(df: DataFrame, key: str, vec: str = "mean", places: int = 6) -> DataFrame:
    """(key, dim from 1, value) with rounded values."""
    return df.select(key, F.posexplode(vec).alias("d", "v")).select(key, (F.col("d") + 1).alias("dim"), F.round(F.col("v").cast("double"), places).alias("value"))


