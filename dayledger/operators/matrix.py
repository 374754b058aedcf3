"""Distributed matrices as entry frames ``(i, j, x)`` and Gram matrices of array columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entry product: join on the inner index, then sums with map-side combine."""
    left = a.select("i", F.col("j").alias("k"), F.col("x").alias("ax"))
    right = b.select(F.col("i").alias("k"), F.col("j"), F.col("x").alias("bx"))
    return left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("ax") * F.col("bx")).alias("x"))


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "x")


def partial_gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One width × width sum of products per partition, whatever its number of rows."""
    total = None
    for b in batches:
        if len(b):
            m = np.stack(b["v"].to_numpy())
            g = m.T @ m
            total = g if total is None else total + g
    if total is not None:
        n = total.shape[0]
        i, j = np.divmod(np.arange(n * n), n)
        yield pd.DataFrame({"i": i, "j": j, "x": total.ravel()})


def gram(vectors: DataFrame) -> DataFrame:
    """Column-by-column products of an array column ``v``; the shuffle carries partition sums only."""
    parts = vectors.select("v").mapInPandas(partial_gram, "i long, j long, x double")
    return parts.groupBy("i", "j").agg(F.sum("x").alias("x"))


def column_cosines(vectors: DataFrame) -> DataFrame:
    g = gram(vectors)
    norm = g.filter("i = j").select(F.col("i").alias("k"), F.sqrt("x").alias("norm"))
    left, right = norm.toDF("i", "ni"), norm.toDF("j", "nj")
    return g.filter("i < j").join(left, "i").join(right, "j").select(
        "i", "j", (F.col("x") / (F.col("ni") * F.col("nj"))).alias("cosine")
    )


def sampled_column_cosines(vectors: DataFrame, width: int, threshold: float, accuracy: float = 2.0) -> DataFrame:
    """(i, j, cosine, sigma): column cosines from a sample of the entries, and the deviation that each estimate may have.

    ``vectors`` are (id, v). An entry of a column of norm n is kept with the probability min(1, r / n), by a hash of its place,
    and weighs the more for it; r grows with ``accuracy``, the logarithm of the width and the inverse of the threshold. So
    a dense column gives about r entries a unit of its norm, whatever its length, and a pair above the threshold is met often.
    """
    reach = float(np.sqrt(accuracy * np.log(max(width, 2)) / threshold))
    entries = vectors.select("id", F.posexplode("v").alias("i", "x"))
    norms = entries.groupBy("i").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    by_column = norms.agg(F.array_sort(F.collect_list(F.struct("i", "norm"))).getField("norm").alias("norms"))  # one number a column
    keep = lambda i: F.least(F.lit(1.0), F.lit(reach) / F.element_at("norms", i + 1))
    drawn = lambda i: F.pmod(F.xxhash64("id", i), F.lit(1 << 40)) / F.lit(float(1 << 40)) < keep(i)
    weigh = lambda x, i: F.when(drawn(i), x / F.element_at("norms", i + 1) / keep(i)).otherwise(0.0)
    # the norms, one number a column, go to the tasks as a constant
    columns = F.array(*[F.lit(float(x)) for x in by_column.first()[0]])
    sampled = vectors.withColumn("norms", columns).select(F.transform("v", weigh).alias("v"))
    pairs = gram(sampled).filter("i < j").select("i", "j", F.col("x").alias("cosine"))
    # variance of a sum of independently kept products: their squares times (1 / p - 1), estimated from those kept
    squares = gram(sampled.select(F.transform("v", lambda x: x * x).alias("v"))).filter("i < j").select("i", "j", F.sqrt("x").alias("sigma"))
    return pairs.join(squares, ["i", "j"])
