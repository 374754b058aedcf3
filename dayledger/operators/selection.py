"""Exact quantiles without sorting all rows: counts between sampled bounds, then only the ranges that hold a wanted rank."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.session import TASK_ROWS, materialize

BOUNDS = 1000
GRAIN = 1 << 40


def sampled_bounds(values: DataFrame, n: int, seed: int) -> list[float]:
    """About ``BOUNDS`` distinct values from a bounded sample of (value, salt); the driver holds no more than the sample."""
    want = 20 * BOUNDS
    drawn = values
    if n > want:
        drawn = values.filter(F.pmod(F.xxhash64("salt", F.lit(seed)), F.lit(GRAIN)) < int(GRAIN * want / n))
    seen = np.sort(drawn.select("value").limit(2 * want).toArrow()["value"].to_numpy())
    return sorted({float(x) for x in seen[:: max(1, len(seen) // BOUNDS)]})


def in_ranges(values: DataFrame, bounds: list[float]) -> DataFrame:
    """Adds ``range``: the number of bounds at or below the value."""
    edges = [-float("inf"), *bounds, float("inf")]
    cut = Bucketizer(splits=edges, inputCol="value", outputCol="range", handleInvalid="keep")
    return cut.transform(values).withColumn("range", F.col("range").cast("int"))


def at_ranks(counts: DataFrame, wanted: DataFrame, order: Sequence[str]) -> DataFrame:
    """For each wanted (of, cell, rank, left) the row of ``counts`` (of, cell, ..., n), in ``order``, that holds it, with
    ``left``, the rank within that row. Windows run over rows of counts, not of values."""
    w = Window.partitionBy("of", "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    steps = counts.withColumn("upto", F.sum("n").over(w)).withColumnsRenamed({"of": "o", "cell": "c"})
    held = (F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("n"))
    met = wanted.join(steps, F.col("of").eqNullSafe(F.col("o")) & (F.col("cell") == F.col("c"))).filter(held)
    return met.withColumn("left", F.col("left") - F.col("upto") + F.col("n")).drop("upto", "o", "c")


def values_at(df: DataFrame, of: str, value: Column, salt: Column, wanted: DataFrame, range_rows: int = TASK_ROWS) -> DataFrame:
    """(of, rank, value): the value at each 0-based rank of ``wanted`` (of, rank) among the non-null values of its group.

    Rows are counted between sampled bounds, and only the ranges that hold a wanted rank go on; these are cut again, by bounds
    from their own rows, until few rows or one value are left, whose distinct values are counted. So no group is sorted, and
    a value that fills a third of the rows is one count. ``salt`` tells the rows of a sample apart, such as a key.
    """
    rows = df.select(F.col(of).alias("of"), F.lit("").alias("cell"), value.cast("double").alias("value"), salt.cast("string").alias("salt"))
    rows = rows.filter("value IS NOT NULL")
    wanted = materialize(wanted.select("of", F.lit("").alias("cell"), "rank", F.col("rank").alias("left")), "ranks")
    cells, depth, edges = ["of", "cell"], 0, set()
    while True:
        sizes = rows.agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).first()
        if sizes["n"] <= range_rows or sizes["lo"] == sizes["hi"]:
            break
        ranged = in_ranges(rows, sorted(edges.union(sampled_bounds(rows, sizes["n"], depth))))
        counts = ranged.groupBy(*cells, "range").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        hit = materialize(at_ranks(materialize(counts, "range-counts"), wanted, ["range"]), "ranks-in-ranges")
        inner = F.concat_ws("/", "cell", "range")
        # no more ranges than wanted ranks
        ranges = hit.select(*cells, "range").distinct()
        ranges = F.broadcast(ranges.toDF("o", "c", "r"))
        same = F.col("of").eqNullSafe(F.col("o")) & (F.col("cell") == F.col("c")) & (F.col("range") == F.col("r"))
        left = ranged.join(ranges, same).select("of", inner.alias("cell"), "value", "salt")
        rows = materialize(left, "range-rows")
        wanted = hit.select("of", inner.alias("cell"), "rank", "left")
        depth += 1
        # the greatest value and the middle of each range are bounds too, so that every round cuts it: one row a wanted rank
        open_ranges = hit.filter("lo < hi").select("lo", "hi").distinct().collect()
        if not open_ranges:
            break
        edges = {r["hi"] for r in open_ranges} | {r["lo"] / 2 + r["hi"] / 2 for r in open_ranges}
    counts = rows.groupBy(*cells, "value").agg(F.count("*").alias("n"))
    return at_ranks(counts, wanted, ["value"]).select("of", "rank", "value")


def quantiles(df: DataFrame, of: str, value: Column, salt: Column, shares: Sequence[float], range_rows: int = TASK_ROWS) -> DataFrame:
    """(of, share, value): exact quantiles of each group, between two neighbouring values where a share falls between them."""
    sizes = materialize(df.filter(value.cast("double").isNotNull()).groupBy(F.col(of).alias("of")).agg(F.count("*").alias("n")), "sizes")
    places = sizes.select("of", F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share"), "n")
    places = places.withColumn("place", F.col("share") * (F.col("n") - 1)).withColumn("rank", F.floor("place"))
    places = places.withColumn("next", F.least(F.col("rank") + 1, F.col("n") - 1))
    wanted = places.select("of", F.explode(F.array("rank", "next")).alias("rank")).distinct()
    found = materialize(values_at(df, of, value, salt, wanted, range_rows), "values")
    low = found.select(F.col("of").alias("o1"), F.col("rank").alias("rank"), F.col("value").alias("low"))
    high = found.select(F.col("of").alias("o2"), F.col("rank").alias("next"), F.col("value").alias("high"))
    both = places.join(low, (F.col("of").eqNullSafe(F.col("o1"))) & (places["rank"] == low["rank"])).join(
        high, (F.col("of").eqNullSafe(F.col("o2"))) & (places["next"] == high["next"])
    )
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - places["rank"])
    return both.select("of", "share", between.alias("value"))
