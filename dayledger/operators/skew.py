"""Salted aggregates and joins for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.session import HOT_ROWS_DEFAULT, HOT_ROWS_KEY, materialize


def salted_agg(
    df: DataFrame,
    keys: Sequence[str],
    salt_on: Sequence[str],
    partial: dict[str, Column],
    final: dict[str, Column],
    salts: int = 64,
) -> DataFrame:
    """Two-step aggregate: first on (key, hash of ``salt_on``), then on the key."""
    salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts))
    first = df.withColumn("_salt", salt).groupBy(*keys, "_salt").agg(
        *[c.alias(n) for n, c in partial.items()]
    )
    return first.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()])


def hot_salts(big: DataFrame, key: str, rows: int) -> DataFrame:
    """(key, salts) of the keys of more than ``rows`` rows, one salt for each so many. At most rows of ``big`` / rows: written, so counted once."""
    counts = big.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows)
    return materialize(counts.select(F.col(key).alias("_hot"), F.ceil(F.col("_n") / rows).cast("int").alias("_salts")), "hot-salts")


def salted_sides(big: DataFrame, small: DataFrame, key: str, salt_on: Sequence[str], rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: rows of hot keys are dealt over their salts, and only their partners are repeated."""
    hot = hot_salts(big, key, rows)
    salts = F.coalesce("_salts", F.lit(1))
    left = big.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_on), salts).cast("int"))
    right = small.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.drop("_hot", "_salts"), right.drop("_hot", "_salts")


def salted_join(big: DataFrame, small: DataFrame, key: str, salt_on: Sequence[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Equi join whose big side spreads its hot keys, those of more than ``rows`` rows, over several tasks.

    ``how`` may be ``inner`` or ``left``: the repeated side must not be kept on its own.
    """
    left, right = salted_sides(big, small, key, salt_on, rows or int(big.sparkSession.conf.get(HOT_ROWS_KEY, str(HOT_ROWS_DEFAULT))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def rows_at_group_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows whose value is the largest of their group; ties stay, null values drop.

    An aggregate with map-side combine and a join back, in place of a window:
    no group has to fit one task.
    """
    top = df.groupBy(*keys).agg(F.max(value).alias("_top"))
    top = top.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_top")
    cond = df[value] == top["_top"]
    for k in keys:
        cond = cond & df[k].eqNullSafe(top[f"_k_{k}"])
    return df.join(top, cond, "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` per key, as one aggregate (no sort, no window)."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)
