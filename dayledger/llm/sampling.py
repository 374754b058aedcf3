"""Bounded samples of rows for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_mod(column: str, m: int) -> Column:
    """crc32 of the id as text, modulo m; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % m


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows, all where there are no more, chosen by a hash of their keys: the same rows each time.

    The share follows from a count, so each task keeps only its part of the
    sample. Equal keys are drawn together; the last limit holds the bound
    where one key has many rows.
    """
    n = df.count()
    if n > rows:
        grain = 1 << 40
        df = df.filter(F.pmod(F.xxhash64(*keys), F.lit(grain)) < int(grain * rows / n))
    return df.limit(2 * rows)
