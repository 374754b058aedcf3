"""Joins and groupings along time: as-of, range, sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.operators.hot import SLICE, by_ranges
from dayledger.session import materialize


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, carry: str, order: Sequence[str]) -> DataFrame:
    """Each left row with ``carry`` of the latest right row of its key at or before its time.

    Both sides go into one frame, cut in ranges of key and time; the right
    value is carried forward inside a range, and one row per key and range
    brings in the last value of earlier ranges. Right rows sort before left
    rows of the same time.
    """
    cols = left.columns
    lhs = left.withColumns({"_side": F.lit(1), "_v": F.lit(None).cast(right.schema[carry].dataType)})
    rhs = right.select(*[c for c in right.columns if c in cols], F.col(carry).alias("_v")).withColumn("_side", F.lit(0))
    by = [time, "_side", *order]
    df = by_ranges(lhs.unionByName(rhs, allowMissingColumns=True), [key], by)
    w = Window.partitionBy(key, SLICE).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    last = F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*by))).alias("_last")
    per_slice = df.groupBy(key, SLICE).agg(last)
    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    brought = per_slice.select(
        F.col(key).alias("_k"), F.col(SLICE).alias("_s"), F.last("_last", ignorenulls=True).over(earlier).alias("_brought")
    )
    here = df.withColumn("_here", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1")
    joined = here.join(brought, here[key].eqNullSafe(brought["_k"]) & (here[SLICE] == brought["_s"]))
    return joined.withColumn(carry, F.coalesce("_here", "_brought")).select(*cols, carry)


def band_join(points: DataFrame, at: Column, bands: DataFrame, start: Column, end: Column) -> DataFrame:
    """Points with the bands ``start <= at < end`` that hold them, on an equi key of dyadic cells.

    A band belongs to the least power of two that is as wide as itself, and
    meets at most two cells of that width. A point has one cell for each width
    that some band uses, so for one if the bands are alike, and for a few dozen
    at most. Empty and reversed bands, and nulls, hold nothing.
    """
    wide = bands.filter(start < end).withColumn("_level", F.ceil(F.log2((end - start).cast("double"))).cast("int"))
    cell = lambda x: F.floor(x.cast("double") / F.pow(F.lit(2.0), F.col("_level")))
    placed = wide.withColumn("_cell", F.explode(F.array_distinct(F.array(cell(start), cell(end)))))
    levels = [r[0] for r in wide.select("_level").distinct().collect()]  # bounded by the exponents of a double
    spread = points.withColumn("_level", F.explode(F.lit(levels).cast("array<int>"))).withColumn("_cell", cell(at))
    return spread.join(placed, ["_level", "_cell"]).filter((at >= start) & (at < end)).drop("_level", "_cell")


def range_join(points: DataFrame, at: str, ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Points with the ranges of time ``start <= at < end`` that hold them: a band join on microseconds."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    p = points.withColumn("_at", micros(at))
    r = ranges.withColumns({"_start": micros(start), "_end": micros(end)})
    return band_join(p, F.col("_at"), r, F.col("_start"), F.col("_end")).drop("_at", "_start", "_end")


def sessions(df: DataFrame, key: str, time: str, gap_seconds: int, measures: dict[str, tuple[Column, str]]) -> DataFrame:
    """Sessions per key split where the gap is reached: start, last event, and measures.

    ``measures`` maps a name to (aggregate over events, SQL aggregate that
    joins partial values). Sessions are built inside ranges of key and time.
    Only the first and the last of a key in a range can go on in another: a
    window over those, two per range at most, joins them.
    """
    gap = F.expr(f"interval {gap_seconds} seconds")
    rows = by_ranges(df, [key], [time])
    w = Window.partitionBy(key, SLICE).orderBy(time)
    prev = F.lag(time).over(w)
    marked = rows.withColumn("_new", F.when(prev.isNull() | (F.col(time) >= prev + gap), 1).otherwise(0))
    number = F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0))
    parts = materialize(
        marked.withColumn("_s", number).groupBy(key, SLICE, "_s")
        .agg(F.min(time).alias("start"), F.max(time).alias("last"), *[a.alias(n) for n, (a, _) in measures.items()]),
        "sessions",
    )
    ends = parts.groupBy(F.col(key).alias("_k"), F.col(SLICE).alias("_l")).agg(F.max("_s").alias("_most"))
    parts = parts.join(ends, parts[key].eqNullSafe(ends["_k"]) & (parts[SLICE] == ends["_l"]))
    out = [key, "start", "last", *measures]
    inner = parts.filter((F.col("_s") > 1) & (F.col("_s") < F.col("_most"))).select(out)
    w = Window.partitionBy(key).orderBy("start", SLICE, "_s")
    before = F.lag("last").over(w)
    border = parts.filter((F.col("_s") == 1) | (F.col("_s") == F.col("_most")))
    border = border.withColumn("_new", F.when(before.isNull() | (F.col("start") >= before + gap), 1).otherwise(0))
    border = border.withColumn("_n", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = border.groupBy(key, "_n").agg(
        F.min("start").alias("start"), F.max("last").alias("last"), *[F.expr(f"{joiner}({n})").alias(n) for n, (_, joiner) in measures.items()]
    )
    return inner.unionByName(joined.select(out))
