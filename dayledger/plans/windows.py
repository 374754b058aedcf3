"""Window functions, on ranges of key and order (``operators.hot``): one plan for all keys, whatever their rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.operators.hot import SLICE, by_ranges, framed, hot_rows, number_rows, ranked, with_slice_totals
from dayledger.operators.timed import sessions
from dayledger.registry import query
from dayledger.session import materialize, table
from dayledger.sources import inputs as I

KEY, ORDER = "o_custkey", ["o_orderdate", "o_orderkey"]


def _orders(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return I.orders(spark, d).select("o_orderkey", KEY, "o_orderdate", *more)


def _numbered(df: DataFrame) -> DataFrame:
    return number_rows(df, [KEY], ORDER)


def _ranked(df: DataFrame) -> DataFrame:
    return ranked(df, KEY, "o_orderdate", ["o_orderkey"])


@query(
    "win_rank",
    """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
       rank() OVER w AS rk, dense_rank() OVER w AS dr
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)
""",
)
def win_rank(spark: SparkSession, d: str) -> DataFrame:
    df = _ranked(_orders(spark, d))
    return df.select("o_orderkey", KEY, *[F.col(c).cast("int").alias(n) for c, n in (("_rn", "rn"), ("_first", "rk"), ("_dense", "dr"))])


@query(
    "win_distribution",
    """
SELECT o_orderkey, o_custkey, round(percent_rank() OVER w, 8) AS pr, round(cume_dist() OVER w, 8) AS cd,
       ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS quarter
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)
""",
)
def win_distribution(spark: SparkSession, d: str) -> DataFrame:
    df = _ranked(_orders(spark, d))
    n, rn0 = F.col("_size"), F.col("_rn") - 1
    # the first n % 4 tiles hold one row more
    size, more = F.floor(n / 4), n % 4
    tile = F.when(rn0 < more * (size + 1), F.floor(rn0 / (size + 1))).otherwise(
        more + F.floor((rn0 - more * (size + 1)) / F.greatest(size, F.lit(1)))
    )
    return df.select(
        "o_orderkey", KEY, F.round(F.when(n > 1, (F.col("_first") - 1) / (n - 1)).otherwise(0.0), 8).alias("pr"),
        F.round(F.col("_last") / n, 8).alias("cd"), (tile + 1).cast("int").alias("quarter"),
    )


@query(
    "win_offset",
    """
SELECT o_orderkey, lag(o_orderkey) OVER w AS prev_key, lead(o_orderkey, 2, -1) OVER w AS next2_key,
       nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_key
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""",
)
def win_offset(spark: SparkSession, d: str) -> DataFrame:
    def near(w: Window) -> dict:
        return {"prev_key": F.lag("o_orderkey").over(w), "next2_key": F.lead("o_orderkey", 2, -1).over(w)}

    rows = _orders(spark, d)
    numbered = materialize(_numbered(rows), "numbered")
    second = numbered.filter("_rn = 2").select(F.col(KEY).alias("_k"), F.col("o_orderkey").alias("second_key"))
    near_rows = framed(numbered, [KEY], 1, 2, near, hot_rows(rows))
    return near_rows.join(second, near_rows[KEY].eqNullSafe(second["_k"]), "left").select("o_orderkey", "prev_key", "next2_key", "second_key")


@query(
    "win_first_last",
    """
SELECT event_id, user_id, first(event_id) OVER w AS first_id,
       last(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS last_purchase
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""",
)
def win_first_last(spark: SparkSession, d: str) -> DataFrame:
    """A full frame has one answer per key: an aggregate with partial results and a join, no sort."""
    e = I.events(spark, d).select("event_id", "user_id", "ts", "event_type")
    order = F.struct("ts", "event_id")
    ends = e.groupBy("user_id").agg(
        F.min_by("event_id", order).alias("first_id"),
        F.max_by("event_id", F.when(F.col("event_type") == "purchase", order)).alias("last_purchase"),
    )
    return e.select("event_id", "user_id").join(ends, "user_id")


@query(
    "win_running_rows",
    """
SELECT o_orderkey, round(sum(o_totalprice) OVER w, 2) AS running, round(avg(o_totalprice) OVER w, 6) AS running_mean
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
""",
)
def win_running_rows(spark: SparkSession, d: str) -> DataFrame:
    ranged = by_ranges(_orders(spark, d, "o_totalprice"), [KEY], ORDER)
    df = with_slice_totals(ranged, [KEY], SLICE, {"s": F.sum("o_totalprice"), "c": F.count("*")})
    w = Window.partitionBy(KEY, SLICE).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    total, n = F.sum("o_totalprice").over(w) + F.col("before_s"), F.count("*").over(w) + F.col("before_c")
    return df.select("o_orderkey", F.round(total, 2).alias("running"), F.round(total / n, 6).alias("running_mean"))


@query(
    "win_range_time",
    """
SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
       RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW), 2) AS last_90_days FROM orders
""",
)
def win_range_time(spark: SparkSession, d: str) -> DataFrame:
    """Order dates are whole days: sums per (key, day) first, the range window runs over days, then a join back."""
    o = _orders(spark, d, "o_totalprice")
    days = o.groupBy(KEY, "o_orderdate").agg(F.sum("o_totalprice").alias("day_total"))
    w = Window.partitionBy(KEY).orderBy(F.unix_seconds("o_orderdate")).rangeBetween(-90 * 86400, 0)
    summed = days.select(KEY, "o_orderdate", F.round(F.sum("day_total").over(w), 2).alias("last_90_days"))
    return o.join(summed, [KEY, "o_orderdate"]).select("o_orderkey", "last_90_days")


@query(
    "win_full_partition",
    """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
       round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_suppkey), 10) AS share FROM lineitem
""",
)
def win_full_partition(spark: SparkSession, d: str) -> DataFrame:
    """Share of the supplier's total: aggregate and join, so that no supplier has to fit one task."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    totals = li.groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("total"))
    share = F.round(F.col("l_extendedprice") / F.col("total"), 10).alias("share")
    return li.join(totals, "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", share)


@query(
    "win_global",
    """
SELECT c_nationkey::BIGINT AS c_nationkey, n, rank() OVER (ORDER BY n DESC) AS rk, round(n / sum(n) OVER (), 8) AS share
FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)
""",
)
def win_global(spark: SparkSession, d: str) -> DataFrame:
    """A window without a key, after the aggregate: it sees one row per nation."""
    n = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    everything = Window.partitionBy()
    return n.select(
        "c_nationkey", "n", F.rank().over(Window.orderBy(F.desc("n"))).alias("rk"),
        F.round(F.col("n") / F.sum("n").over(everything), 8).alias("share"),
    )


@query(
    "win_topk_group",
    """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3
""",
)
def win_topk_group(spark: SparkSession, d: str) -> DataFrame:
    """Window group limit: each task keeps k rows per key before the shuffle."""
    w = Window.partitionBy(KEY).orderBy(F.desc("o_totalprice"), "o_orderkey")
    o = table(spark, d, "orders").select(KEY, "o_orderkey", "o_totalprice")
    return o.withColumn("rn", F.row_number().over(w)).filter("rn <= 3").drop("rn")


@query(
    "win_collect",
    """
SELECT o_orderkey, array_to_string(list(o_orderkey) OVER w, ',') AS last_keys,
       array_to_string(list_sort(list_distinct(list(o_orderstatus) OVER w)), ',') AS last_statuses
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""",
)
def win_collect(spark: SparkSession, d: str) -> DataFrame:
    def last3(w: Window) -> dict:
        f = w.rowsBetween(-2, 0)
        return {
            "last_keys": F.collect_list("o_orderkey").over(f),
            "last_statuses": F.array_sort(F.collect_set("o_orderstatus").over(f)),
        }

    rows = _orders(spark, d, "o_orderstatus")
    return framed(_numbered(rows), [KEY], 2, 0, last3, hot_rows(rows)).select("o_orderkey", "last_keys", "last_statuses")


@F.pandas_udf(T.DoubleType())
def own_mean(v: pd.Series) -> float:
    x = v.to_numpy()  # a call has four rows at most: the pandas mean would cost more than they do
    mean = np.add.reduce(x) / len(x)
    if mean != mean:  # nulls do not count
        x = x[x == x]
        mean = x.mean() if len(x) else mean
    return float(mean)


@query(
    "win_pandas_agg",
    """
SELECT o_orderkey, round(avg(o_totalprice) OVER w, 6) AS near_mean FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)
""",
)
def win_pandas_agg(spark: SparkSession, d: str) -> DataFrame:
    def near(w: Window) -> dict:
        return {"near_mean": F.round(own_mean("o_totalprice").over(w.rowsBetween(-2, 1)), 6)}

    rows = _orders(spark, d, "o_totalprice")
    return framed(_numbered(rows), [KEY], 2, 1, near, hot_rows(rows), calls=True).select("o_orderkey", "near_mean")


@query(
    "time_window_tumbling",
    """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n,
       round(sum(value), 2) AS total FROM events GROUP BY ALL
""",
)
def time_window_tumbling(spark: SparkSession, d: str) -> DataFrame:
    e = I.events(spark, d).groupBy(F.window("ts", "1 day"), "event_type")
    return e.agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select(
        "window.start", "event_type", "n", "total"
    )


@query(
    "time_window_sliding",
    """
SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, round(sum(value), 2) AS total FROM (
  SELECT date_trunc('day', ts)::TIMESTAMP AS day, value FROM events
  UNION ALL SELECT date_trunc('day', ts)::TIMESTAMP - INTERVAL 1 DAY, value FROM events) GROUP BY 1
""",
)
def time_window_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Days are summed first; each day total then goes to the windows that hold the day."""
    days = I.events(spark, d).groupBy(F.window("ts", "1 day")["start"].alias("day")).agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )
    w = days.groupBy(F.window("day", "2 days", "1 day"))
    return w.agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total")).select("window.start", "n", "total")


SESSION_SQL = """
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, round(sum(value), 2) AS total
FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL {gap} HOURS > ts
                 THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, s
"""


@query("time_window_session", SESSION_SQL.format(gap=6))
def time_window_session(spark: SparkSession, d: str) -> DataFrame:
    e = I.events(spark, d).select("user_id", "ts", "value")
    measures = {"n": (F.count("*"), "sum"), "total": (F.sum("value"), "sum")}
    s = sessions(e, "user_id", "ts", 6 * 3600, measures)
    return s.select("user_id", "start", "n", F.round("total", 2).alias("total"))
