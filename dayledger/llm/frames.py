"""Small helpers on frames and their schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extended(schema: T.StructType, added: str) -> T.StructType:
    """A new schema: ``schema`` with the fields of a DDL text at its end."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(added).fields])


def boxed(df: DataFrame, *without: str) -> DataFrame:
    """All columns, but for some names, in the one column ``row``: working columns beside it cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in without]).alias("row"))
