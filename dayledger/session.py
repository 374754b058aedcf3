"""Session settings, table loading and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import dayledger

# Python functions travel to the executors by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(dayledger)

# Rows of one key above which its group is split over several tasks.
HOT_ROWS_KEY = "spark.dayledger.hotRows"
HOT_ROWS_DEFAULT = 1_000_000
# Rows and bytes up to which a lookup side may be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
# Rows that one task of a layout of given size should get.
TASK_ROWS = 2_000_000


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job relies on; sizes stay with the launcher."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Split a skewed join side even where a later operator then needs a shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Hash join in place of sort-merge where every shuffled partition of one side was measured to be small.
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    # rows of an Arrow batch: texts and vectors are long, and a batch stands in memory on both sides
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    sc = spark.sparkContext
    if sc.master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(sc.defaultParallelism))
    scratch_root(spark)
    return spark


def local_session(cpus: str = "8", app: str = "dayledger") -> SparkSession:
    """Session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only a local session
    may fall back to a folder of its own machine.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
        if root:
            return root
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="dayledger-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so no write meets old files."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/dayledger/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def zoned(df: DataFrame, *cols: str) -> DataFrame:
    """Zoneless timestamps to TIMESTAMP (session zone UTC)."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in cols})


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of one write."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a lookup side if its rows and bytes are measured to be small; else leave the join to the optimizer."""
    text = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(text)).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= BROADCAST_BYTES else df


def parts_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """Tasks, buckets or salts for a frame: its rows over the rows of one of them, one at least."""
    return max(1, -(-df.count() // rows))


def shuffle_parts(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with, whichever of the two settings the cluster uses."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))
