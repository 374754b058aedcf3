"""Stream jobs over files. Each runs to the end of its input and returns what its sink holds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dayledger.operators.upsert import KeyedTable
from dayledger.plans.files import new_name
from dayledger.plans.joins import WORDS_SQL, words
from dayledger.plans.windows import SESSION_SQL
from dayledger.registry import query
from dayledger.session import materialize, parts_for, scratch, setting, small_side, table
from dayledger.sources import inputs as I
from dayledger.streaming.feed import (
    closing_event,
    drain_append,
    drain_complete,
    drain_update,
    each_batch,
    event_stream,
    feed,
    finish,
    in_steps,
    open_feed,
    stream_table,
)

def totals() -> list[Column]:
    return [F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")]



WORD_COUNT_SQL = (
    f"SELECT word, count(*) AS n FROM ({WORDS_SQL.format(cols='', table='documents')}) WHERE word <> '' GROUP BY 1"
)
BY_DAY_SQL = "strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S')"


def by_days(e: DataFrame) -> list[DataFrame]:
    """Events in four parts along time: days 1-8, 9-16, 17-24, 25-31."""
    quarter = F.floor((F.dayofmonth("ts") - 1) / 8)
    return [e.filter(quarter == i) for i in range(4)]


@query("stream_file_source", "SELECT event_id, user_id, event_type, value FROM events")
def stream_file_source(spark: SparkSession, d: str) -> DataFrame:
    """New JSON files with a given schema, two files per trigger."""
    path = scratch(spark, "incoming")
    table(spark, d, "events").select("event_id", "user_id", "event_type", "value").write.json(path)
    schema = "event_id long, user_id long, event_type string, value double"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).json(path)
    return drain_append(s, "file_source")


@query("stream_table_source_sink", "SELECT event_id, event_type FROM events WHERE value > 5")
def stream_table_source_sink(spark: SparkSession, d: str) -> DataFrame:
    source, sink = new_name("events_in"), new_name("events_out")
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    e.write.option("path", scratch(spark, source)).format("parquet").saveAsTable(source)
    rows = spark.readStream.table(source).filter("value > 5").select("event_id", "event_type")
    spark.sql(f"CREATE TABLE {sink} (event_id LONG, event_type STRING) USING parquet LOCATION '{scratch(spark, sink)}'")
    writer = rows.writeStream.option("checkpointLocation", scratch(spark, f"{sink}-cp")).trigger(availableNow=True)
    finish(writer.toTable(sink))
    return spark.table(sink)


@query("stream_word_count", WORD_COUNT_SQL)
def stream_word_count(spark: SparkSession, d: str) -> DataFrame:
    counts = words(stream_table(spark, d, "documents")).groupBy("word").agg(F.count("*").alias("n"))
    return drain_update(counts, "word_count", ["word"])


@query("stream_word_count_messages", WORD_COUNT_SQL)
def stream_word_count_messages(spark: SparkSession, d: str) -> DataFrame:
    """A message log: key, value, topic, partition, offset, timestamp; the value is text in bytes."""
    log = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
        F.lit("documents").alias("topic"), (F.col("doc_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("doc_id") / 4).alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
    )
    path, _ = feed([log], "messages")
    texts = open_feed(spark, path, log.schema).select(F.col("value").cast("string").alias("text"))
    counts = words(texts).groupBy("word").agg(F.count("*").alias("n"))
    return drain_update(counts, "message_words", ["word"])


@query(
    "stream_window_tumbling",
    f"SELECT {BY_DAY_SQL} AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
)
def stream_window_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Windows change with each batch and leave the state once the watermark has passed them."""
    return _windows(spark, d, F.window("ts", "1 day"), "tumbling")


def _windows(spark: SparkSession, d: str, window: Column, name: str) -> DataFrame:
    out = scratch(spark, name)

    def run(rows: DataFrame, checkpoint: str) -> DataFrame:
        w = rows.withWatermark("ts", "1 day").groupBy(window, "event_type").agg(*totals())
        return drain_update(w.select("window.start", "event_type", "n", "total"), name, ["start", "event_type"], checkpoint, out)

    return in_steps(by_days(I.events(spark, d).select("ts", "event_type", "value")), name, run)[-1]


SLIDING_SQL = """
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, {key} AS event_type, count(*) AS n, round(sum(value), 2) AS total FROM (
  SELECT time_bucket(INTERVAL 6 HOURS, ts) AS start, * FROM events
  UNION ALL SELECT time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS, * FROM events) GROUP BY ALL
"""


@query("stream_window_sliding", SLIDING_SQL.format(key="event_type"))
def stream_window_sliding(spark: SparkSession, d: str) -> DataFrame:
    return _windows(spark, d, F.window("ts", "12 hours", "6 hours"), "sliding")


@query("stream_window_session", SESSION_SQL.format(gap=6))
def stream_window_session(spark: SparkSession, d: str) -> DataFrame:
    """Sessions are merged inside each task first, so that a hot user moves as sessions, not as events; they leave once
    the watermark has passed their end."""
    e = I.events(spark, d).select("user_id", "ts", "value")
    out = scratch(spark, "session_window")

    def run(rows: DataFrame, checkpoint: str) -> DataFrame:
        s = rows.withWatermark("ts", "1 hour").groupBy(F.session_window("ts", "6 hours").alias("s"), "user_id").agg(*totals())
        return drain_append(s.select("user_id", "s.start", "n", "total"), "session_window", checkpoint, out)

    with setting(spark, "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"):
        return in_steps([*by_days(e), closing_event(e, user_id=-1, value=0.0)], "sessions", run)[-1].filter("user_id >= 0")


@query(
    "stream_watermark_late",
    f"SELECT {BY_DAY_SQL} AS start, count(*) AS n, round(sum(value), 2) AS total FROM events "
    "WHERE NOT (event_id % 50 = 0 AND ts < DATE '2024-01-10') GROUP BY 1",
)
def stream_watermark_late(spark: SparkSession, d: str) -> DataFrame:
    """Rows that come after their window has closed are dropped; windows leave in append mode once closed."""
    e = I.events(spark, d).select("ts", "value", "event_id")
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit("2024-01-10").cast("timestamp"))
    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    on_time = [e.filter(~late & half), e.filter(~late & ~half)]
    path = scratch(spark, "late")
    for i, part in enumerate([*on_time, e.filter(late), closing_event(e, value=0.0)]):
        part.write.parquet(f"{path}/step={i}")
    results, cp, out = None, scratch(spark, "late-cp"), scratch(spark, "late-out")
    for i in range(4):
        seen = spark.readStream.schema(e.schema).parquet(f"{path}/step=[0-{i}]")
        w = seen.withWatermark("ts", "2 days").groupBy(F.window("ts", "1 day")).agg(*totals())
        results = drain_append(w.select("window.start", "n", "total"), "late_rows", cp, out)
    return results.filter(F.col("start") < F.lit("2099-01-01").cast("timestamp"))


@query("stream_dedup", "SELECT event_id, event_type, value FROM events")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every event comes again in a later batch, some twice in one; copies are dropped within the watermark."""
    e = I.events(spark, d)
    even = F.col("event_id") % 2 == 0
    out = scratch(spark, "dedup")

    def run(rows: DataFrame, checkpoint: str) -> DataFrame:
        s = rows.withWatermark("ts", "40 days").dropDuplicatesWithinWatermark(["event_id"])
        return drain_append(s.select("event_id", "event_type", "value"), "dedup", checkpoint, out)

    return in_steps([e.filter(even), e.filter(~even).unionAll(e.filter(even)), e.filter(~even).unionAll(e.filter(~even))], "doubled", run)[-1]


@query(
    "stream_static_join",
    "SELECT event_id, c_mktsegment, value FROM events JOIN customer ON user_id = c_custkey",
)
def stream_static_join(spark: SparkSession, d: str) -> DataFrame:
    """Sent to all tasks only if counted small; otherwise the optimizer's shuffle join."""
    c = small_side(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment"))
    return drain_append(event_stream(spark, d).join(c, "user_id").select("event_id", "c_mktsegment", "value"), "static")


@query(
    "stream_stream_join",
    """
SELECT v.event_id AS view_id, p.event_id AS buy_id FROM (SELECT * FROM events WHERE event_type = 'view') v
LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
  ON v.user_id = p.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 2 HOURS
""",
)
def stream_stream_join(spark: SparkSession, d: str) -> DataFrame:
    """Views with purchases of the next two hours; views without one leave when the watermark has passed.

    The join key is user and hour, so that one user's rows spread over many
    tasks: a purchase is sent to the hours in which its view may lie.
    """
    e = I.events(spark, d).select("event_id", "user_id", "ts", "event_type")
    ends = closing_event(e, event_id=-1, user_id=-1, event_type="view").unionAll(
        closing_event(e, event_id=-1, user_id=-1, event_type="purchase")
    )
    path, _ = feed([e, ends], "views_buys")
    s = open_feed(spark, path, e.schema)
    views = s.filter("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("seen"), F.date_trunc("hour", "ts").alias("hour")
    ).withWatermark("seen", "1 hour")
    back = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: F.date_trunc("hour", "ts") - F.make_dt_interval(hours=i))
    buys = s.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("buy_id"), F.col("user_id").alias("buyer"), F.col("ts").alias("bought"),
        F.explode(back).alias("from_hour"),
    ).withWatermark("bought", "1 hour")
    on = F.expr(
        "user_id = buyer AND hour = from_hour AND bought >= seen AND bought <= seen + interval 2 hours"
    )
    pairs = views.join(buys, on, "left").select("view_id", "buy_id")
    return drain_append(pairs, "stream_join").filter("view_id >= 0")


@query(
    "stream_union",
    "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1",
)
def stream_union(spark: SparkSession, d: str) -> DataFrame:
    kinds = [event_stream(spark, d).filter(F.col("event_type") == k) for k in ("view", "click", "purchase")]
    one = kinds[0].union(kinds[1]).union(kinds[2])
    return drain_complete(one.groupBy("event_type").agg(F.count("*").alias("n")), "union")


# a store in the files of each task, which keyed state variables need
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Rows of the whole input for which a bucket of keys is made; its keys share one state and one call a batch.
STATE_ROWS = 20_000
BALANCE_ROW = "c_custkey long, balance double, n long"


class RunningBalances(StatefulProcessor):
    """Balance and number of orders of each customer of a bucket; a balance may be given before the first order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "keys array<long>, balances array<double>, ns array<long>")

    def _held(self) -> pd.DataFrame:
        keys, balances, ns = self.held.get() if self.held.exists() else ([], [], [])
        frame = pd.DataFrame({"c_custkey": pd.array(list(keys), "Int64"), "balance": list(balances), "n": list(ns)})
        return frame.astype({"balance": "float64", "n": "int64"})

    def _hold(self, frame: pd.DataFrame) -> None:
        keys = [None if pd.isna(k) else int(k) for k in frame["c_custkey"]]
        self.held.update((keys, frame["balance"].tolist(), frame["n"].tolist()))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        given = initialState[["c_custkey", "balance"]].astype({"c_custkey": "Int64"}).assign(n=0)
        self._hold(added(self._held(), given))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        changes = self._held().iloc[:0]
        for r in rows:
            changes = added(changes, pd.DataFrame({"c_custkey": r["c_custkey"].astype("Int64"), "balance": r["price"].fillna(0.0), "n": 1}))
        now = added(self._held(), changes)
        self._hold(now)
        yield now[now["c_custkey"].isin(changes["c_custkey"])]

    def close(self) -> None:
        pass


def added(held: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
    """Balances and numbers by customer; a null key is a key."""
    both = pd.concat([held, more]) if len(held) else more
    return both.groupby("c_custkey", as_index=False, dropna=False)[["balance", "n"]].sum()


@query(
    "stream_state_sum",
    """
SELECT c_custkey, round(c_acctbal + coalesce(total, 0), 2) AS balance, coalesce(n, 0) AS n
FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
""",
)
def stream_state_sum(spark: SparkSession, d: str) -> DataFrame:
    """Running balances of customers, whose state begins with what the account holds. The orders come in three parts, and the
    stream starts anew for each. Start values enter as state, not as rows: customers without orders are never put out, and
    stand as they began. Customers share state in buckets, as many as the rows ask for: a call into Python and its state
    cost the same for one customer as for thousands."""
    start = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.lit(0).cast("long").alias("n"))
    start = materialize(start, "start-state")
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("price"), "o_orderkey")
    parts = [orders.filter(F.pmod("o_orderkey", F.lit(3)) == i).drop("o_orderkey") for i in range(3)]
    out = scratch(spark, "state_sum")
    bucket = F.pmod(F.xxhash64(F.col("c_custkey").cast("long")), F.lit(parts_for(orders, STATE_ROWS))).alias("bucket")
    begun = start.select(bucket, "c_custkey", "balance").groupBy("bucket")

    def run(rows: DataFrame, checkpoint: str) -> DataFrame:
        dealt = rows.select(bucket, "c_custkey", "price").groupBy("bucket")
        sums = dealt.transformWithStateInPandas(RunningBalances(), BALANCE_ROW, "Update", "None", initialState=begun)
        return drain_update(sums, "state_sum", ["c_custkey"], checkpoint, out)

    with setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKS):
        sums = in_steps(parts, "running_balance", run)[-1]
    every = sums.unionByName(start.join(sums, "c_custkey", "left_anti"))
    return every.withColumn("balance", F.round("balance", 2))


GAP = pd.Timedelta(hours=6)
PART = "user_id long, start timestamp, last timestamp, n long"
SESSION_ROW = "user_id long, start timestamp, seconds double, n long"


def joined_parts(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial sessions of each user put together where the gap is not reached."""
    rows = rows.sort_values(["user_id", "start"])
    prev = rows.groupby("user_id")["last"].cummax().groupby(rows["user_id"]).shift()
    fresh = prev.isna() | (rows["start"] >= prev + GAP)
    out = rows.assign(s=fresh.cumsum()).groupby(["user_id", "s"], as_index=False).agg(
        start=("start", "min"), last=("last", "max"), n=("n", "sum")
    )
    return out[["user_id", "start", "last", "n"]]


def combine_locally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield joined_parts(b)


OPEN_SESSIONS = "users array<long>, starts array<long>, lasts array<long>, ns array<long>"


def track_sessions(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Sessions of one user, who is the key; see ``_tracked``."""
    held = state.get if state.exists else ([], [], [])
    yield from _tracked((list(key) * len(held[0]), *held), batches, state, 1)


def track_bucket(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Sessions of the users of one bucket, who stand in the state; see ``_tracked``."""
    yield from _tracked(state.get if state.exists else ([], [], [], []), batches, state, 0)


def _tracked(held: Sequence[Sequence[int]], batches: Iterator[pd.DataFrame], state: GroupState, first: int) -> Iterator[pd.DataFrame]:
    """State: the sessions that may still grow, as microseconds, from its column ``first`` of ``OPEN_SESSIONS`` on. A session is
    put out once the watermark has passed its last row by the gap, so a row within the allowed delay can still join two of them."""
    users, starts, lasts, ns = held
    frame = pd.DataFrame({"user_id": users, "start": pd.to_datetime(list(starts), unit="us"), "last": pd.to_datetime(list(lasts), unit="us"), "n": ns})
    if not state.hasTimedOut:
        for b in batches:  # folded one by one: what is held at once is bounded by open sessions
            b = b[["user_id", "start", "last", "n"]]
            frame = joined_parts(pd.concat([frame, b]) if len(frame) else b)
    now = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
    over = frame["last"] + GAP <= now
    done, left = frame[over], frame[~over]
    if len(left):
        micros = lambda c: [t.value // 1000 for t in left[c].astype("datetime64[ns]")]
        state.update(([None if pd.isna(u) else int(u) for u in left["user_id"]], micros("start"), micros("last"), [int(n) for n in left["n"]])[first:])
        state.setTimeoutTimestamp(int((left["last"].min() + GAP).timestamp() * 1000))
    elif state.exists:
        state.remove()
    if len(done):
        yield done.assign(seconds=(done["last"] - done["start"]).dt.total_seconds())[["user_id", "start", "seconds", "n"]]


@query(
    "stream_session_state",
    """
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, round(epoch(max(ts)) - epoch(min(ts)), 3) AS seconds,
       count(*) AS n
FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOURS > ts
                 THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, s
""",
)
def stream_session_state(spark: SparkSession, d: str) -> DataFrame:
    """Own state for buckets of users: a call into Python costs the same for one user as for hundreds. Each Arrow batch is cut
    to partial sessions before the shuffle, so hot users shrink first."""
    e = I.events(spark, d).select("event_id", "user_id", "ts", "event_type")
    out = scratch(spark, "session_state")
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(parts_for(e, STATE_ROWS)))

    def run(s: DataFrame, checkpoint: str) -> DataFrame:
        parts = s.select("user_id", F.col("ts").alias("start"), F.col("ts").alias("last"), F.lit(1).cast("long").alias("n"))
        parts = parts.mapInPandas(combine_locally, PART).withWatermark("last", "10 minutes")
        sessions = parts.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
            track_bucket, SESSION_ROW, OPEN_SESSIONS, "append", GroupStateTimeout.EventTimeTimeout,
        )
        return drain_append(sessions, "session_state", checkpoint, out)

    rows = in_steps([*by_days(e), closing_event(e, event_id=-1, user_id=-1)], "sessions", run)[-1].filter("user_id >= 0")
    return rows.withColumn("seconds", F.round("seconds", 3))


@query("stream_window_reduce", SLIDING_SQL.format(key="'all'").replace("'all' AS event_type,", ""))
def stream_window_reduce(spark: SparkSession, d: str) -> DataFrame:
    """Sums per sliding window, kept as state and changed by each batch."""
    slides = event_stream(spark, d).withWatermark("ts", "40 days").groupBy(F.window("ts", "12 hours", "6 hours"))
    return drain_update(slides.agg(*totals()).select("window.start", "n", "total"), "window_reduce", ["start"])


@query(
    "stream_micro_counts",
    "SELECT (day(ts) - 1) // 8 AS batch, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def stream_micro_counts(spark: SparkSession, d: str) -> DataFrame:
    """A queue of folders, one per trigger; counts per batch."""
    root, out, cp = scratch(spark, "queue"), scratch(spark, "micro"), scratch(spark, "micro-cp")
    e = I.events(spark, d).select("ts", "event_type")
    for i, part in enumerate(by_days(e)):
        part.write.parquet(f"{root}/q={i}")

    def count(batch: DataFrame, batch_id: int) -> None:
        n = batch.groupBy("event_type").agg(F.count("*").alias("n"))
        n.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for i in range(4):
        s = spark.readStream.schema(e.schema).parquet(f"{root}/q=[0-{i}]")
        writer = s.writeStream.foreachBatch(count).option("checkpointLocation", cp)
        finish(writer.trigger(availableNow=True).start())
    return spark.read.option("basePath", out).parquet(out).select(F.col("batch").cast("long"), "event_type", "n")


LATEST_SCHEMA = "user_id long, ts timestamp, event_id long, event_type string"


@query(
    "stream_foreach_batch_upsert",
    "SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_id, event_type FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def stream_foreach_batch_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Each batch goes into a keyed table; the newest row of a key wins, so a repeated batch changes nothing."""
    e = I.events(spark, d).select("user_id", "ts", "event_id", "event_type")
    store = KeyedTable.temporary(spark, "latest", ["user_id"], LATEST_SCHEMA)

    def merge(batch: DataFrame, _: int) -> None:
        store.upsert_latest(batch, ["ts", "event_id"])

    in_steps(by_days(e), "upserts", lambda rows, checkpoint: each_batch(rows, checkpoint, merge))
    return store.read()


class CountingWriter:
    """Row writer: open, process, close. Adds up what it is given."""

    def __init__(self, rows, total, closed):
        self.rows, self.total, self.closed = rows, total, closed

    def open(self, partition_id: int, epoch_id: int) -> bool:
        return True

    def process(self, row) -> None:
        self.rows.add(1)
        self.total.add(row["value"])

    def close(self, error) -> None:
        if error is None:
            self.closed.add(1)


@query("stream_foreach_row", "SELECT count(*) AS n, round(sum(value), 2) AS total, true AS closed FROM events")
def stream_foreach_row(spark: SparkSession, d: str) -> DataFrame:
    sc = spark.sparkContext
    rows, total, closed = sc.accumulator(0), sc.accumulator(0.0), sc.accumulator(0)
    s = event_stream(spark, d).select("event_id", "value")
    writer = s.writeStream.foreach(CountingWriter(rows, total, closed))
    finish(writer.option("checkpointLocation", scratch(spark, "foreach-cp")).trigger(availableNow=True).start())
    done = (rows.value, total.value, closed.value > 0)
    return spark.createDataFrame([done], "n long, total double, closed boolean").withColumn("total", F.round("total", 2))


@query(
    "stream_sink_files",
    "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events "
    "WHERE event_type IN ('click', 'view') GROUP BY ALL",
)
def stream_sink_files(spark: SparkSession, d: str) -> DataFrame:
    """Append to Parquet folders per event type; the read opens two of them."""
    out = scratch(spark, "sink")
    s = event_stream(spark, d).select("event_id", "ts", "event_type")
    writer = s.writeStream.outputMode("append").format("parquet").partitionBy("event_type").queryName("sink_files")
    writer = writer.options(path=out, checkpointLocation=scratch(spark, "sink-cp"))
    finish(writer.trigger(availableNow=True).start())
    rows = spark.read.schema("event_id long, ts timestamp, event_type string").parquet(out)
    rows = rows.filter("event_type IN ('click', 'view')")
    return rows.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query(
    "stream_recover",
    f"""
WITH w AS (SELECT word FROM ({WORDS_SQL.format(cols='', table='documents')}) WHERE word <> ''),
x AS (SELECT DISTINCT word FROM ({WORDS_SQL.format(cols='', table='benchmark')}) WHERE length(word) <= 4)
SELECT CASE WHEN word IN (SELECT word FROM x) THEN '(excluded)' ELSE word END AS word, count(*) AS n FROM w GROUP BY 1
""",
)
def stream_recover(spark: SparkSession, d: str) -> DataFrame:
    """Stopped after half the input and started again from its checkpoint; excluded words are counted apart."""
    docs = table(spark, d, "documents").select("text", "lang")
    path, cp, out = scratch(spark, "recover"), scratch(spark, "recover-cp"), scratch(spark, "recover-out")
    out_words = words(table(spark, d, "benchmark")).filter(F.length("word") <= 4).distinct().withColumn("x", F.lit(True))
    for lang in (F.col("lang") == "en", F.col("lang") != "en"):
        docs.filter(lang).write.mode("append").parquet(path)
        marked = words(open_feed(spark, path, docs.schema)).join(small_side(out_words), "word", "left")
        word = F.when(F.col("x").isNull(), F.col("word")).otherwise("(excluded)").alias("word")
        counts = marked.select(word).groupBy("word").agg(F.count("*").alias("n"))
        result = drain_update(counts, "recover", ["word"], cp, out)
    return result


@query(
    "stream_trigger_once",
    "SELECT trigger_kind, count(*) AS n, round(sum(value), 2) AS total FROM events, "
    "(VALUES ('drain'), ('interval')) v(trigger_kind) GROUP BY 1",
)
def stream_trigger_once(spark: SparkSession, d: str) -> DataFrame:
    """Drain what is there and stop; or a fixed interval, stopped once the input is used up."""
    s = event_stream(spark, d).select("event_id", "value")
    drained = drain_append(s, "drain")
    out = scratch(spark, "interval")
    writer = s.writeStream.format("parquet").options(path=out, checkpointLocation=scratch(spark, "interval-cp"))
    q = writer.trigger(processingTime="500 milliseconds").start()
    q.processAllAvailable()
    q.stop()
    timed = spark.read.schema(s.schema).parquet(out)
    both = drained.select(F.lit("drain").alias("trigger_kind"), "value").unionAll(
        timed.select(F.lit("interval"), "value")
    )
    return both.groupBy("trigger_kind").agg(*totals())


@query(
    "stream_progress",
    """
WITH q AS (SELECT (day(ts) - 1) // 8 AS step, count(*) AS input_rows, date_trunc('second', max(ts)) AS top FROM events GROUP BY 1)
SELECT step, input_rows, coalesce(strftime(max(top) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
       - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S'), '1970-01-01 00:00:00') AS watermark, true AS has_state FROM q
""",
)
def stream_progress(spark: SparkSession, d: str) -> DataFrame:
    """Rows, watermark and state of each batch that had input, taken from each run as it ends; no list of limited length."""
    e = I.events(spark, d).select("ts", "event_type")

    def run(rows: DataFrame, checkpoint: str) -> list[tuple]:
        w = rows.withWatermark("ts", "1 day").groupBy(F.window("ts", "1 day"), "event_type").count()
        writer = w.writeStream.outputMode("update").foreachBatch(lambda batch, i: batch.write.format("noop").mode("overwrite").save())
        q = finish(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        if q.exception() is not None:
            raise q.exception()
        return [(p["numInputRows"], p["eventTime"]["watermark"], p["stateOperators"][0]["numRowsTotal"] > 0) for p in q.recentProgress if p["numInputRows"]]

    seen = [r for part in in_steps(by_days(e), "progress", run) for r in part]
    out = spark.createDataFrame([(i, *r) for i, r in enumerate(seen)], "step long, input_rows long, watermark string, has_state boolean")
    return out.withColumn("watermark", F.date_trunc("second", F.to_timestamp("watermark")))


@query(
    "stream_page_views",
    """
WITH v AS (SELECT event_id, user_id, ts, event_type, '/p/' || (user_id % 10) AS page, '94' || (user_id % 7) AS zip FROM events)
SELECT 'views' AS measure, page AS item, NULL AS start, count(*)::DOUBLE AS amount FROM v GROUP BY page
UNION ALL SELECT 'errors', zip, strftime(time_bucket(INTERVAL 6 HOURS, ts), '%Y-%m-%d %H:%M:%S'),
  round(count(*) FILTER (WHERE event_type = 'error') / count(*), 6) FROM v GROUP BY ALL
UNION ALL SELECT 'active', 'users', strftime(time_bucket(INTERVAL 6 HOURS, ts), '%Y-%m-%d %H:%M:%S'),
  count(DISTINCT user_id)::DOUBLE FROM v GROUP BY ALL
UNION ALL SELECT 'known', c_mktsegment, NULL, count(*)::DOUBLE FROM v JOIN customer ON user_id = c_custkey GROUP BY ALL
""",
)
def stream_page_views(spark: SparkSession, d: str) -> DataFrame:
    """Views per page, error rate per zip code and window, active users per window, views of known users."""
    e = I.events(spark, d).select("event_id", "user_id", "ts", "event_type")
    path, _ = feed([e, closing_event(e, event_id=-1, user_id=-1)], "page_views")
    s = open_feed(spark, path, e.schema).withColumns(
        {
            "page": F.concat(F.lit("/p/"), (F.col("user_id") % 10).cast("string")),
            "zip": F.concat(F.lit("94"), (F.col("user_id") % 7).cast("string")),
        }
    )
    real = s.filter("event_id >= 0")
    no_start = F.lit(None).cast("timestamp").alias("start")

    def shaped(df: DataFrame, measure: str, item, start, amount) -> DataFrame:
        return df.select(
            F.lit(measure).alias("measure"), item.alias("item"), start.alias("start"), amount.cast("double").alias("amount")
        )

    views = shaped(real.groupBy("page").agg(F.count("*").alias("n")), "views", F.col("page"), no_start, F.col("n"))
    bad = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)) / F.count("*")
    errors = real.groupBy(F.window("ts", "6 hours"), "zip").agg(F.round(bad, 6).alias("r"))
    errors = shaped(errors, "errors", F.col("zip"), F.col("window.start"), F.col("r"))
    # one row per (window, user), then a count per window: exact, and no user set is held in one place
    users = s.withWatermark("ts", "1 hour").withColumn("w", F.window("ts", "6 hours"))
    users = users.dropDuplicates(["w", "user_id"]).groupBy("w").agg(F.count("*").alias("n"))
    active = shaped(users, "active", F.lit("users"), F.col("w.start"), F.col("n"))
    c = small_side(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment"))
    known = real.join(c, "user_id").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    known = shaped(known, "known", F.col("c_mktsegment"), no_start, F.col("n"))

    out = drain_append(active, "active").filter("start < timestamp'2099-01-01'")
    for df, name in ((views, "views"), (errors, "errors"), (known, "known")):
        out = out.unionByName(drain_complete(df, name))
    return out


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


def squared_distance(v: Column, center: Column) -> Column:
    diffs = F.zip_with(v, center, lambda a, b: (a - b) * (a - b))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


class StoredModel:
    """The state of a model after each batch, in a folder per batch: a batch that runs again starts from the one before."""

    def __init__(self, spark: SparkSession, name: str, schema: str, start: list[tuple]):
        self.spark, self.path, self.schema, self.start = spark, scratch(spark, name), schema, start

    def before(self, batch_id: int) -> list[tuple]:
        if batch_id == 0:
            return self.start
        return [tuple(r) for r in self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch_id - 1}").orderBy("k").collect()]

    def save(self, batch_id: int, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


CENTRES, DECAY, STEPS = 5, 0.8, 3
KMEANS_STEP = """
d{t} AS MATERIALIZED (SELECT v.vec_id, c.c, sum((v.x - c.x) ** 2) AS d FROM e v JOIN c{p} c ON c.i = v.i WHERE v.vec_id % 3 = {p} GROUP BY ALL),
n{t} AS (SELECT vec_id, c FROM d{t} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1),
s{t} AS (SELECT n.c, e.i, sum(e.x) AS s, count(*) AS n FROM n{t} n JOIN e ON e.vec_id = n.vec_id GROUP BY ALL),
c{t} AS MATERIALIZED (SELECT c.c, c.i, CASE WHEN s.n IS NULL THEN c.x ELSE (c.x * c.w * 0.8 + s.s) / (c.w * 0.8 + s.n) END AS x,
         CASE WHEN s.n IS NULL THEN c.w ELSE c.w * 0.8 + s.n END AS w FROM c{p} c LEFT JOIN s{t} s ON s.c = c.c AND s.i = c.i)"""


@query(
    "stream_kmeans",
    "WITH e AS MATERIALIZED (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS i FROM embeddings), "
    "first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS c FROM embeddings ORDER BY vec_id LIMIT 5), "
    "c0 AS (SELECT c, i, x, 1.0::DOUBLE AS w FROM first JOIN e ON e.vec_id = first.vec_id), "
    + ", ".join(KMEANS_STEP.format(t=t, p=t - 1) for t in range(1, STEPS + 1))
    + " SELECT c AS cluster, i, round(x, 6) AS x, round(w, 6) AS weight FROM c3",
)
def stream_kmeans(spark: SparkSession, d: str) -> DataFrame:
    """Centres move with each batch and forget at a rate. A batch is cut to one sum vector per centre."""
    v = vectors(spark, d)
    seeds = [(i, 1.0, list(r.v)) for i, r in enumerate(v.orderBy("vec_id").limit(CENTRES).collect())]
    model = StoredModel(spark, "kmeans", "k int, weight double, center array<double>", seeds)

    def update(batch: DataFrame, batch_id: int) -> None:
        state = model.before(batch_id)
        near = batch.withColumn("d", F.array(*[squared_distance(F.col("v"), F.array(*[F.lit(x) for x in c])) for _, _, c in state]))
        best = (F.array_position("d", F.array_min("d")) - 1).alias("c")
        dims = near.select(best, F.posexplode("v").alias("i", "x"))
        moved: dict[int, dict[int, float]] = {}
        counts: dict[int, int] = {}
        for r in dims.groupBy("c", "i").agg(F.sum("x").alias("s"), F.count("*").alias("n")).collect():  # k x width rows
            moved.setdefault(r.c, {})[r.i] = r.s
            counts[r.c] = r.n
        rows = []
        for k, w, c in state:
            n, old = counts.get(k, 0), w * DECAY
            rows.append((k, old + n, [(x * old + moved[k][i]) / (old + n) for i, x in enumerate(c)]) if n else (k, w, c))
        model.save(batch_id, rows)

    parts = [v.filter(F.pmod("vec_id", F.lit(STEPS)) == i) for i in range(STEPS)]
    in_steps(parts, "vectors", lambda rows, checkpoint: each_batch(rows, checkpoint, update))
    out = spark.createDataFrame(model.before(STEPS), model.schema)
    return out.select(F.col("k").alias("cluster"), F.posexplode("center").alias("i", "x"), F.round("weight", 6).alias("weight")).withColumn("x", F.round("x", 6))


RATE, MOVES = 0.5, 4
MOVE_SQL = """
m{t} AS MATERIALIZED (SELECT
  any_value(b) - {rate} * avg(b + w1 * x1 + w2 * x2 - y) AS b, any_value(w1) - {rate} * avg((b + w1 * x1 + w2 * x2 - y) * x1) AS w1,
  any_value(w2) - {rate} * avg((b + w1 * x1 + w2 * x2 - y) * x2) AS w2,
  any_value(lb) - {rate} * avg(1 / (1 + exp(-(lb + l1 * x1 + l2 * x2))) - label) AS lb,
  any_value(l1) - {rate} * avg((1 / (1 + exp(-(lb + l1 * x1 + l2 * x2))) - label) * x1) AS l1,
  any_value(l2) - {rate} * avg((1 / (1 + exp(-(lb + l1 * x1 + l2 * x2))) - label) * x2) AS l2
  FROM li, m{p} WHERE part = {part})"""


@query(
    "stream_linear_models",
    "WITH li AS MATERIALIZED (SELECT l_quantity / 50 AS x1, l_discount AS x2, l_extendedprice / 100000 AS y, "
    "(l_extendedprice > 50000)::INTEGER::DOUBLE AS label, l_orderkey % 3 AS part FROM lineitem), "
    "m0 AS (SELECT 0::DOUBLE AS b, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS lb, 0::DOUBLE AS l1, 0::DOUBLE AS l2), "
    + ", ".join(MOVE_SQL.format(t=t, p=t - 1, part=(t - 1) // MOVES, rate=RATE) for t in range(1, STEPS * MOVES + 1))
    + f" SELECT 'linear' AS model, round(b, 6) AS bias, round(w1, 6) AS w1, round(w2, 6) AS w2 FROM m{STEPS * MOVES}"
    f" UNION ALL SELECT 'logistic', round(lb, 6), round(l1, 6), round(l2, 6) FROM m{STEPS * MOVES}",
)
def stream_linear_models(spark: SparkSession, d: str) -> DataFrame:
    """Linear and logistic weights moved a few times along the mean gradient of each batch, each by one aggregate."""
    li = I.lineitem(spark, d).select(
        "l_orderkey", (F.col("l_quantity") / 50).alias("x1"), F.col("l_discount").alias("x2"),
        (F.col("l_extendedprice") / 100000).alias("y"), F.when(F.col("l_extendedprice") > 50000, 1.0).otherwise(0.0).alias("label"),
    )
    names = ["linear", "logistic"]
    model = StoredModel(spark, "linear", "k int, w array<double>", [(k, [0.0] * 3) for k in range(2)])
    xs = [F.lit(1.0), F.col("x1"), F.col("x2")]

    def update(batch: DataFrame, batch_id: int) -> None:
        weights = [w for _, w in model.before(batch_id)]
        for _ in range(MOVES):
            score = [sum((w * x for w, x in zip(ws, xs)), F.lit(0.0)) for ws in weights]
            miss = [score[0] - F.col("y"), 1 / (1 + F.exp(-score[1])) - F.col("label")]
            g = batch.agg(*[F.avg(m * x) for m in miss for x in xs]).first()
            weights = [[w - RATE * g[3 * k + i] for i, w in enumerate(ws)] for k, ws in enumerate(weights)]
        model.save(batch_id, list(enumerate(weights)))

    parts = [li.filter(F.col("l_orderkey") % STEPS == i) for i in range(STEPS)]
    in_steps(parts, "lines", lambda rows, checkpoint: each_batch(rows, checkpoint, update))
    rows = [(names[k], *[round(float(x), 6) for x in w]) for k, w in model.before(STEPS)]
    return spark.createDataFrame(rows, "model string, bias double, w1 double, w2 double")


@query(
    "stream_ab_test",
    """
WITH g AS (SELECT event_type, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM events
           WHERE event_type IN ('click', 'view') GROUP BY 1)
SELECT a.n AS n_click, b.n AS n_view, round((a.m - b.m) / sqrt(a.v / a.n + b.v / b.n), 6) AS t
FROM g a, g b WHERE a.event_type = 'click' AND b.event_type = 'view'
""",
)
def stream_ab_test(spark: SparkSession, d: str) -> DataFrame:
    """Welch's t over a stream: each batch leaves count, sum and sum of squares per group; the end adds them up."""
    e = I.events(spark, d).select("ts", "event_type", "value")
    out = scratch(spark, "ab-out")

    def moments(batch: DataFrame, batch_id: int) -> None:
        v = F.col("value")
        per = batch.filter("event_type IN ('click', 'view')").groupBy("event_type").agg(
            F.count("*").alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("q")
        )
        per.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    in_steps(by_days(e), "ab", lambda rows, checkpoint: each_batch(rows, checkpoint, moments))
    parts = spark.read.schema("event_type string, n long, s double, q double").parquet(f"{out}/batch=*")
    g = parts.groupBy().pivot("event_type", ["click", "view"]).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")
    )

    def mean(k: str):
        return F.col(f"{k}_s") / F.col(f"{k}_n")

    def spread(k: str):
        n = F.col(f"{k}_n")
        return (F.col(f"{k}_q") - n * mean(k) * mean(k)) / (n - 1) / n

    t = (mean("click") - mean("view")) / F.sqrt(spread("click") + spread("view"))
    return g.select(F.col("click_n").alias("n_click"), F.col("view_n").alias("n_view"), F.round(t, 6).alias("t"))
