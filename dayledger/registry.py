"""Named jobs: a builder and, where the answer can be written in SQL, its check text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.session import prepare

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Job:
    name: str
    build: Builder
    sql: str | None


JOBS: dict[str, Job] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def add(build: Builder) -> Builder:
        if name in JOBS:
            raise ValueError(f"job {name} is registered twice")
        JOBS[name] = Job(name, build, sql.strip() if sql else None)
        return build

    return add


def plain_types(df: DataFrame) -> DataFrame:
    """Results in types every engine prints alike: long, double, text, boolean."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.ArrayType) and not isinstance(
            t.elementType, (T.ArrayType, T.StructType, T.MapType)
        ):
            c = F.array_join(c.cast("array<string>"), ",", "null")
        elif isinstance(t, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        elif isinstance(t, T.BinaryType):
            c = F.hex(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def runnable(job: Job) -> Builder:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(job.build(prepare(spark), folder))

    run.__name__ = job.name
    return run
