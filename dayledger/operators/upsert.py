"""Keyed Parquet tables: read the rows a batch touches, merge by key, overwrite their partitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.skew import latest_per_key
from dayledger.session import materialize, scratch, shuffle_parts


def target_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key is in the batch; nothing is collected."""
    return target.join(batch.select(*keys).distinct(), list(keys), "left_semi")


def merge_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace stored rows of the same key; other rows stay."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


PART = "_part"
NEW = "_new"


class KeyedTable:
    """A Parquet table with a unique key, partitioned by a hash of the key.

    An upsert reads the partitions of its keys, writes the merged rows aside,
    and then overwrites those partitions; the others are neither read nor
    written. The number of partitions stays for the life of the table, like a
    bucket count. One writer at a time; a failed upsert is run again.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, parts: int | None = None):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema
        self.parts = parts or shuffle_parts(spark)
        # an empty table to read where there is none yet
        self._placed(spark.createDataFrame([], schema)).write.mode("ignore").partitionBy(PART).parquet(self.path)

    @classmethod
    def temporary(cls, spark: SparkSession, name: str, keys: Sequence[str], schema: str, parts: int | None = None) -> KeyedTable:
        return cls(spark, scratch(spark, name), keys, schema, parts)

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, {PART} int").parquet(self.path)

    def _touched(self, batch: DataFrame) -> DataFrame:
        """Stored rows of the partitions that the keys of the batch belong to; their numbers are bounded by ``parts``."""
        numbers = [r[0] for r in self._placed(batch.select(*self.keys)).select(PART).distinct().collect()]
        return self._stored().filter(F.col(PART).isin(numbers)).drop(PART)

    def _write(self, df: DataFrame, mode: str) -> None:
        self._overwrite(self._placed(df.select(*self._columns())).repartition(PART), mode)

    def _overwrite(self, spread: DataFrame, mode: str) -> None:
        spread.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(PART).parquet(self.path)

    def _columns(self) -> list[str]:
        return [c for c in self._stored().columns if c != PART]

    def read(self) -> DataFrame:
        return self._stored().drop(PART)

    def rows_for(self, batch: DataFrame) -> DataFrame:
        """Stored rows whose key is in the batch."""
        return target_rows(self._touched(batch), batch, self.keys)

    def replace(self, df: DataFrame) -> None:
        """The whole table anew; the rows must have unique keys and not come from the table."""
        self._write(df, "static")

    def _change(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        if self._stored().isEmpty():
            self._write(merge(self.read(), batch), "dynamic")
            return
        batch = materialize(batch, "batch")
        # written aside first: the partitions that are read are those that are overwritten
        self._write(materialize(merge(self._touched(batch), batch), "merged"), "dynamic")

    def upsert(self, batch: DataFrame) -> None:
        self._change(batch, lambda old, new: merge_by_key(old, new, self.keys))

    def merge(self, batch: DataFrame, one_per_key: Callable[[DataFrame], DataFrame]) -> None:
        """Stored and batch rows, the latter marked in ``NEW``, to one row per key, in one shuffle by ``PART``.

        ``one_per_key`` gets the rows of the touched partitions, those of other keys too, and keeps ``PART``. Where it
        groups by ``PART`` and the key, the rows are written where they lie. The batch is read twice, not stored.
        """
        empty = self._stored().isEmpty()
        stored = self.read() if empty else self._touched(batch)
        both = stored.withColumn(NEW, F.lit(False)).unionByName(batch.withColumn(NEW, F.lit(True)))
        merged = one_per_key(self._placed(both).repartition(PART)).select(*self._columns(), PART)
        if not empty:
            # aside as in an upsert, but by partition: its files hold one each and need no second shuffle
            path = scratch(self.spark, "merged")
            merged.write.partitionBy(PART).parquet(path)
            merged = self.spark.read.schema(merged.schema).parquet(path)
        self._overwrite(merged, "dynamic")

    def upsert_latest(self, batch: DataFrame, order: Sequence[str]) -> None:
        """Upsert where the newer of stored and incoming row wins: safe to run again."""
        self._change(batch, lambda old, new: latest_per_key(old.unionByName(new, allowMissingColumns=True), self.keys, order))


def document_id(*cols: str):
    """Composite key with a separator, so that joined parts cannot collide."""
    return F.concat_ws("~", *[F.col(c).cast("string") for c in cols])
