"""Joins. Which side is hashed, sorted or broadcast is left to the optimizer unless a size was counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.skew import salted_join
from dayledger.operators.timed import band_join, asof_join, range_join
from dayledger.registry import query
from dayledger.session import small_side, table
from dayledger.sources import inputs as I

LARGE = 450000


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")


def _large_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.filter(F.col("o_totalprice") > LARGE).withColumnRenamed("o_custkey", "c_custkey")


@query(
    "join_inner_hash",
    "SELECT o_orderkey, c_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner_hash(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    return o.join(_customers(spark, d).drop("c_nationkey"), "c_custkey", "inner")


ORDERS_L = f"(SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > {LARGE})"


@query(
    "join_left",
    f"SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN {ORDERS_L} ON c_custkey = o_custkey",
)
def join_left(spark: SparkSession, d: str) -> DataFrame:
    return _customers(spark, d).drop("c_nationkey").join(_large_orders(spark, d), "c_custkey", "left")


@query(
    "join_right",
    f"SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM {ORDERS_L} RIGHT JOIN customer ON c_custkey = o_custkey",
)
def join_right(spark: SparkSession, d: str) -> DataFrame:
    return _large_orders(spark, d).join(_customers(spark, d).drop("c_nationkey"), "c_custkey", "right")


@query(
    "join_full",
    """
SELECT coalesce(a.k, b.k)::BIGINT AS nationkey, n_cust, n_supp FROM
  (SELECT c_nationkey AS k, count(*) AS n_cust FROM customer WHERE c_nationkey < 20 GROUP BY 1) a
  FULL JOIN (SELECT s_nationkey AS k, count(*) AS n_supp FROM supplier WHERE s_nationkey > 5 GROUP BY 1) b ON a.k = b.k
""",
)
def join_full(spark: SparkSession, d: str) -> DataFrame:
    """Both sides are counted per nation before they meet: one row per key."""
    c = table(spark, d, "customer").filter("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("nationkey"))
    s = table(spark, d, "supplier").filter("s_nationkey > 5").groupBy(F.col("s_nationkey").alias("nationkey"))
    return c.agg(F.count("*").alias("n_cust")).join(s.agg(F.count("*").alias("n_supp")), "nationkey", "outer")


@query(
    "join_semi",
    f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > {LARGE})",
)
def join_semi(spark: SparkSession, d: str) -> DataFrame:
    return _customers(spark, d).drop("c_nationkey").join(_large_orders(spark, d), "c_custkey", "left_semi")


@query(
    "join_anti",
    f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN "
    f"(SELECT o_custkey FROM orders WHERE o_totalprice > {LARGE})",
)
def join_anti(spark: SparkSession, d: str) -> DataFrame:
    return _customers(spark, d).drop("c_nationkey").join(_large_orders(spark, d), "c_custkey", "left_anti")


@query(
    "join_cross",
    """
SELECT r_name, c_mktsegment, count(*) FILTER (WHERE c_acctbal > 9000) AS n FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""",
)
def join_cross(spark: SparkSession, d: str) -> DataFrame:
    """(region, segment) pairs that occur, with how many of their customers are rich; lists are not paired blindly."""
    nation = small_side(table(spark, d, "nation").select("n_nationkey", "n_regionkey"))
    counts = (
        table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count_if(F.col("c_acctbal") > 9000).alias("n"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_regionkey").alias("r_regionkey"), "c_mktsegment").agg(F.sum("n").alias("n"))
    )
    return counts.join(small_side(table(spark, d, "region")), "r_regionkey").select("r_name", "c_mktsegment", "n")


@query(
    "join_theta",
    """
SELECT r_name AS band, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
JOIN region ON o_totalprice >= r_regionkey * 100000 AND o_totalprice < (r_regionkey + 1) * 100000 GROUP BY 1
""",
)
def join_theta(spark: SparkSession, d: str) -> DataFrame:
    """Price bands, one per region row. A band lies in at most two cells of a power of two as wide as itself, a price in
    one cell of each width in use, and the comparison decides inside a cell: an equal join, whatever the widths."""
    bands = table(spark, d, "region").select(
        F.col("r_name").alias("band"), (F.col("r_regionkey") * 100000).alias("lo"),
        ((F.col("r_regionkey") + 1) * 100000).alias("hi"),
    )
    price = F.col("o_totalprice")
    hit = band_join(table(spark, d, "orders").select("o_totalprice"), price, bands, F.col("lo"), F.col("hi"))
    return hit.groupBy("band").agg(F.count("*").alias("n"), F.round(F.sum(price), 2).alias("total"))


@query(
    "join_nullsafe",
    """
WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
SELECT o_orderkey, o.status, n FROM o JOIN (SELECT status, count(*) AS n FROM o GROUP BY 1) s
  ON o.status IS NOT DISTINCT FROM s.status
""",
)
def join_nullsafe(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    o = table(spark, d, "orders").select("o_orderkey", status.alias("status"))
    s = o.groupBy(F.col("status").alias("s_status")).agg(F.count("*").alias("n"))
    return o.join(s, F.col("status").eqNullSafe(F.col("s_status"))).drop("s_status")


@query(
    "join_self",
    """
WITH y AS (SELECT o_custkey, year(o_orderdate) AS yr, sum(o_totalprice) AS total FROM orders GROUP BY ALL)
SELECT a.o_custkey, a.yr, round(a.total, 2) AS total, round(b.total, 2) AS total_before
FROM y a JOIN y b ON a.o_custkey = b.o_custkey AND a.yr = b.yr + 1
""",
)
def join_self(spark: SparkSession, d: str) -> DataFrame:
    """Yearly totals beside the year before; one row per customer and year on each side."""
    y = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("yr")).agg(
        F.sum("o_totalprice").alias("total")
    )
    a, b = y.alias("a"), y.alias("b")
    on = (F.col("a.o_custkey") == F.col("b.o_custkey")) & (F.col("a.yr") == F.col("b.yr") + 1)
    return a.join(b, on).select(
        "a.o_custkey", "a.yr", F.round("a.total", 2).alias("total"), F.round("b.total", 2).alias("total_before")
    )


@query(
    "join_broadcast",
    """
SELECT n_name, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1
""",
)
def join_broadcast(spark: SparkSession, d: str) -> DataFrame:
    nation = small_side(table(spark, d, "nation").select("n_nationkey", "n_name"), 1000)
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    li = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice", "l_discount")
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return (
        li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(F.count("*").alias("n"), F.round(revenue, 4).alias("revenue"))
    )


@query(
    "join_hints",
    """
SELECT hint, c_nationkey::BIGINT AS c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey,
(VALUES ('merge'), ('shuffle_hash')) v(hint) GROUP BY ALL
""",
)
def join_hints(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    parts = [
        o.join(c.hint(h), "c_custkey").groupBy("c_nationkey").agg(F.count("*").alias("n")).withColumn("hint", F.lit(h))
        for h in ("merge", "shuffle_hash")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "join_skewed",
    """
SELECT c_mktsegment, event_type, count(*) AS n, round(sum(value), 2) AS total
FROM events JOIN customer ON user_id = c_custkey GROUP BY ALL
""",
)
def join_skewed(spark: SparkSession, d: str) -> DataFrame:
    """Salted: a hot user's events go to several tasks, and only the customer rows of hot users are repeated."""
    e = table(spark, d, "events").select(F.col("user_id").alias("c_custkey"), "event_id", "event_type", "value")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = salted_join(e, c, "c_custkey", ["event_id"])
    return j.groupBy("c_mktsegment", "event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "join_asof",
    """
SELECT v.event_id, v.user_id, strftime(v.ts, '%Y-%m-%d %H:%M:%S') AS ts, c.event_id AS click_id
FROM (SELECT * FROM events WHERE event_type = 'view') v
ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY ALL) c
  ON v.user_id = c.user_id AND v.ts >= c.ts
""",
)
def join_asof(spark: SparkSession, d: str) -> DataFrame:
    e = I.events(spark, d).select("event_id", "user_id", "ts", "event_type")
    views = e.filter("event_type = 'view'").drop("event_type")
    clicks = e.filter("event_type = 'click'").select("event_id", "user_id", "ts", F.col("event_id").alias("click_id"))
    return asof_join(views, clicks, "user_id", "ts", "click_id", ["event_id"])


@query(
    "join_range",
    """
WITH q AS (SELECT year(o_orderdate) * 10 + quarter(o_orderdate) AS period, min(o_orderdate) AS lo,
                  max(o_orderdate) + INTERVAL 1 DAY AS hi FROM orders GROUP BY 1)
SELECT period, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem JOIN q ON l_shipdate >= lo AND l_shipdate < hi
GROUP BY period
""",
)
def join_range(spark: SparkSession, d: str) -> DataFrame:
    """Order lines in the selling period that holds their ship date."""
    at = F.col("o_orderdate")
    periods = I.orders(spark, d).groupBy((F.year(at).cast("long") * 10 + F.quarter(at)).alias("period")).agg(
        F.min(at).alias("lo"), (F.max(at) + F.expr("interval 1 day")).alias("hi")
    )
    lines = I.lineitem(spark, d).select("l_shipdate", "l_quantity")
    hit = range_join(lines, "l_shipdate", periods, "lo", "hi")
    return hit.groupBy("period").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


LIST_BLOCK = 1000


@query(
    "cogroup_keys",
    f"""
WITH o AS (SELECT o_custkey, o_orderkey // {LIST_BLOCK} AS block, list_sort(list(o_orderkey)) AS order_keys
           FROM orders WHERE o_totalprice > {LARGE} GROUP BY ALL)
SELECT c_custkey, block, array_to_string(order_keys, ',') AS order_keys, c_name
FROM o FULL JOIN customer ON o_custkey = c_custkey
""",
)
def cogroup_keys(spark: SparkSession, d: str) -> DataFrame:
    """Both sides per key. A key's list comes in blocks of consecutive ids, so no cell grows without bound."""
    o = _large_orders(spark, d).withColumn("block", F.floor(F.col("o_orderkey") / LIST_BLOCK))
    lists = o.groupBy("c_custkey", "block").agg(F.sort_array(F.collect_list("o_orderkey")).alias("order_keys"))
    c = _customers(spark, d).drop("c_nationkey")
    matched = lists.join(c, "c_custkey", "left")
    alone = c.join(o, "c_custkey", "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


@query(
    "join_star",
    """
SELECT n_name, r_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('ASIA', 'EUROPE') AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'
GROUP BY ALL
""",
)
def join_star(spark: SparkSession, d: str) -> DataFrame:
    """Small sides first: the filtered nations cut the customers, those the orders, those the lines."""
    regions = table(spark, d, "region").filter(F.col("r_name").isin("ASIA", "EUROPE"))
    nations = table(spark, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    nations = small_side(nations.select("n_nationkey", "n_name", "r_name"), 1000)
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    day = F.col("o_orderdate")
    o = table(spark, d, "orders").filter(
        (day >= F.lit("1996-01-01").cast("timestamp_ntz")) & (day < F.lit("1999-01-01").cast("timestamp_ntz"))
    )
    o = o.select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("n_name", "r_name").agg(F.round(revenue, 4).alias("revenue"), F.count("*").alias("n"))
    )


WORDS_SQL = "SELECT {cols} unnest(string_split_regex(lower(text), '[ \\n]+')) AS word FROM {table}"


def words(df: DataFrame, *cols: str) -> DataFrame:
    """Lower-case words split at blanks and line ends."""
    return df.select(*cols, F.explode(F.split(F.lower("text"), "[ \n]+")).alias("word")).filter("word <> ''")


@query(
    "lookup_enrich",
    f"""
WITH w AS ({WORDS_SQL.format(cols='', table='documents')}),
counts AS (SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1),
scores AS (SELECT DISTINCT word, length(word) % 11 - 5 AS score
           FROM ({WORDS_SQL.format(cols='', table='benchmark')}) WHERE word <> '')
SELECT word, n, score, n * score AS weight FROM counts JOIN scores USING (word) WHERE score <> 0
""",
)
def lookup_enrich(spark: SparkSession, d: str) -> DataFrame:
    """Words are counted first; the score list is joined to the counts and ranked by weight."""
    counts = words(table(spark, d, "documents")).groupBy("word").agg(F.count("*").alias("n"))
    scores = words(table(spark, d, "benchmark")).distinct().withColumn(
        "score", F.length("word").cast("long") % 11 - 5
    )
    joined = counts.join(scores.filter("score <> 0"), "word").withColumn("weight", F.col("n") * F.col("score"))
    return joined.orderBy(F.desc("weight"), "word")


SUBQUERIES = """
SELECT c_custkey, c_name, (SELECT max(o_totalprice) FROM {orders} o WHERE o.o_custkey = c.c_custkey) AS top_price
FROM {customer} c
WHERE c_acctbal > (SELECT avg(c_acctbal) FROM {customer})
  AND c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F')
  AND EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
  AND NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 495000)
"""


@query("sql_subqueries", SUBQUERIES.format(orders="orders", customer="customer"))
def sql_subqueries(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(SUBQUERIES, orders=table(spark, d, "orders"), customer=table(spark, d, "customer"))
