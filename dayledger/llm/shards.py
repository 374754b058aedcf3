"""Work on texts in shards of bounded size, with hash keys exchanged as packed arrays.

Texts are dealt to shards by a hash of id and text, a few megabytes each. A
shard sends its 64-bit keys to key buckets, one packed row for each bucket;
a bucket finds which keys meet and answers each shard with a packed row. The
same text shuffle serves every step. A key that is frequent within a shard
is sent at most twice, so the keys of a bucket that are equal number at most
twice the shards, however hot the key is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.words import pieces

SHARD_BYTES = 4_000_000
BUCKET_BYTES = 4_000_000


def volume(docs: DataFrame, text: str) -> int:
    """Bytes of text of the whole table."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def shards_for(docs: DataFrame, size: int, target: int = SHARD_BYTES) -> int:
    """Enough shards for the target size, and several for each shuffle partition, so that tasks are even."""
    return max(-(-size // target), 3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def buckets_for(keys: float, key_bytes: int) -> int:
    """A power of two of buckets of about BUCKET_BYTES."""
    return 1 << max(4, int(np.ceil(np.log2(max(keys * key_bytes / BUCKET_BYTES, 1)))))


def sharded(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(shard, id, text): rows of equal id and text share a shard."""
    return docs.select(F.pmod(F.xxhash64(key, text), F.lit(n)).cast("int").alias("shard"), F.col(key).alias("id"), F.col(text).alias("text"))


def packed(arrays: list[np.ndarray], bounds: np.ndarray) -> list[list[bytes]]:
    """For each array its slices between the bounds, as bytes."""
    return [[a[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)] for a in arrays]


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys by bucket (their top bits), the buckets that occur, and their bounds in that order."""
    bits = buckets.bit_length() - 1
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return order, found, np.append(first, len(keys))


def at_most_twice(*columns: np.ndarray) -> np.ndarray:
    """Indices that keep two rows of each distinct tuple."""
    order = np.lexsort(columns[::-1])
    same = np.ones(len(order), bool)
    for c in columns:
        s = c[order]
        same[2:] &= s[2:] == s[:-2]
    same[:2] = False
    return order[~same]


def joined(column: pa.ChunkedArray, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """All packed rows of a column as one array, and the number of entries of each row."""
    blobs = column.to_pylist()
    flat = np.frombuffer(b"".join(blobs), dtype)
    return flat, np.array([len(b) for b in blobs], np.int64) // np.dtype(dtype).itemsize


def text_slices(table: pa.Table, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    for b in table.combine_chunks().to_batches():
        yield from pieces(b, "text", limit)


def with_shards(texts: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work(texts of a shard, answers to it)`` for every shard."""
    # an int and a long of the same value hash to different tasks
    answers = answers.withColumn("shard", F.col("shard").cast("int"))
    return texts.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(work, schema)
