"""Stream inputs and outputs: files in, files out, nothing through the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dayledger.session import scratch, table

# A time after all data; a row with it closes every window and is left out of results.
FAR_FUTURE = "2100-01-01 00:00:00"


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table as a stream, read where it lies, whether it is one file or a folder of them."""
    schema = table(spark, folder, name).schema
    # a pattern, since a plain path to a single file is refused as a stream source
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def feed(parts: Sequence[DataFrame], name: str) -> tuple[str, str]:
    """Parts written one after the other to one folder: (path, schema). Later parts have later files."""
    path = scratch(parts[0].sparkSession, name)
    for p in parts:
        p.write.mode("append").parquet(path)
    return path, parts[0].schema.simpleString()


def in_steps(parts: Sequence[DataFrame], name: str, run: Callable[[DataFrame, str], object]) -> list:
    """One folder and one run of the stream for each part, in order: ``run(rows, checkpoint)``.

    All runs share the checkpoint, so each takes up the state of the one
    before and sees the new folder only. What a batch holds depends on the
    parts, not on files or cores.
    """
    spark, root = parts[0].sparkSession, scratch(parts[0].sparkSession, name)
    checkpoint, out = scratch(spark, f"{name}-cp"), []
    for i, part in enumerate(parts):
        part.write.parquet(f"{root}/q={i:03d}")
        # a pattern that grows keeps the source the same and adds the folder
        names = ",".join(f"{k:03d}" for k in range(i + 1))
        out.append(run(spark.readStream.schema(part.schema).parquet(f"{root}/q={{{names}}}"), checkpoint))
    return out


def each_batch(rows: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """``work`` on every batch up to the end of the input."""
    return finish(rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def open_feed(spark: SparkSession, path: str, schema, files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def finish(q: StreamingQuery) -> StreamingQuery:
    q.awaitTermination()
    return q


def drain_append(df: DataFrame, name: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Run to the end of the input in append mode; the rows land in a Parquet file sink."""
    spark = df.sparkSession
    out = out or scratch(spark, name)
    writer = df.writeStream.outputMode("append").format("parquet").option("path", out).queryName(name)
    writer = writer.option("checkpointLocation", checkpoint or scratch(spark, f"{name}-cp"))
    finish(writer.trigger(availableNow=True).start())
    return spark.read.schema(df.schema).parquet(out)


def _batches(df: DataFrame, name: str, mode: str, checkpoint: str | None, out: str) -> None:
    """Each batch to its own folder, replaced when a batch runs again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = df.writeStream.outputMode(mode).foreachBatch(write).queryName(name)
    writer = writer.option("checkpointLocation", checkpoint or scratch(df.sparkSession, f"{name}-cp"))
    finish(writer.trigger(availableNow=True).start())


def drain_complete(df: DataFrame, name: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """The last full result of a complete-mode aggregate."""
    spark = df.sparkSession
    out = out or scratch(spark, name)
    _batches(df, name, "complete", checkpoint, out)
    rows = spark.read.option("basePath", out).parquet(out)
    return rows.filter(F.col("batch") == rows.select(F.max("batch")).scalar()).drop("batch")


def drain_update(
    df: DataFrame, name: str, keys: Sequence[str], checkpoint: str | None = None, out: str | None = None
) -> DataFrame:
    """The newest version of each updated row; only changed rows are written per batch."""
    spark = df.sparkSession
    out = out or scratch(spark, name)
    _batches(df, name, "update", checkpoint, out)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), "batch").alias("_row")
    rows = spark.read.option("basePath", out).parquet(out)
    return rows.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    s = stream_table(spark, folder, "events")
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def with_end(df: DataFrame, **values) -> DataFrame:
    """The frame as a last feed part: one row of the far future with the given values, else null."""
    cols = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.sparkSession.range(1).select(*cols)


def closing_event(df: DataFrame, **values) -> DataFrame:
    return with_end(df, ts=FAR_FUTURE, **values)


def lines_stream(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return stream_table(spark, folder, name).select("text")
