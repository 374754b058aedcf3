"""Aggregations: built-in aggregates with a partial step before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.selection import quantiles
from dayledger.operators.skew import salted_agg
from dayledger.plans.joins import LIST_BLOCK, WORDS_SQL, words
from dayledger.registry import query
from dayledger.session import materialize, table
from dayledger.sources import inputs as I

PRICE = "l_extendedprice"


@query(
    "agg_basic",
    """
SELECT coalesce(l_returnflag, 'all') AS flag, count(*) AS n, round(sum(l_extendedprice), 2) AS total,
       round(avg(l_extendedprice), 6) AS mean, min(l_extendedprice) AS low, max(l_extendedprice) AS high,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS net
FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())
""",
)
def agg_basic(spark: SparkSession, d: str) -> DataFrame:
    """Per flag and in total; the total is made from the per-flag sums, not from a second scan."""
    li = table(spark, d, "lineitem").select("l_returnflag", PRICE, "l_discount")
    per = li.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum(PRICE).alias("total"), F.min(PRICE).alias("low"), F.max(PRICE).alias("high"),
        F.sum(F.col(PRICE) * (1 - F.col("l_discount"))).alias("net"),
    )
    both = per.rollup("l_returnflag").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("net").alias("net"),
    )
    return both.select(
        F.coalesce("l_returnflag", F.lit("all")).alias("flag"), "n", F.round("total", 2).alias("total"),
        F.round(F.col("total") / F.col("n"), 6).alias("mean"), "low", "high", F.round("net", 4).alias("net"),
    )


@query(
    "agg_distinct",
    """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT (l_suppkey, l_linenumber)) AS pairs,
       sum(DISTINCT l_quantity) AS distinct_quantity FROM lineitem GROUP BY 1
""",
)
def agg_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct("l_suppkey", "l_linenumber").alias("pairs"),
        F.sum_distinct("l_quantity").alias("distinct_quantity"),
    )


@query(
    "agg_approx_distinct",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS exact, true AS within_bound FROM lineitem GROUP BY 1",
)
def agg_approx_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Sketch beside the exact count; the error stays within three deviations.

    Each by its own: in one aggregate with the distinct count, a sketch would be held for every key.
    """
    rsd = 0.02
    li = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey")
    exact = li.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("exact"))
    sketch = li.groupBy(F.col("l_returnflag").alias("_flag")).agg(F.approx_count_distinct("l_orderkey", rsd).alias("estimate"))
    both = exact.join(sketch, F.col("l_returnflag").eqNullSafe(F.col("_flag")))
    error = F.abs(F.col("estimate") - F.col("exact")) / F.col("exact")
    return both.select("l_returnflag", "exact", (error <= 3 * rsd).alias("within_bound"))


@query(
    "agg_percentile_approx",
    """
SELECT l_returnflag, quantile_disc(l_quantity, 0.25) AS q25, quantile_disc(l_quantity, 0.5) AS q50,
       quantile_disc(l_quantity, 0.9) AS q90, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, true AS near
FROM lineitem GROUP BY 1
""",
)
def agg_percentile_approx(spark: SparkSession, d: str) -> DataFrame:
    """Sketch percentiles of the quantity, which has fewer values than the accuracy, so that they are exact; percentiles of
    the price, exactly, by selection of ranks. Near: the sketch of the price lies within its bound of rows of the exact one."""
    li = table(spark, d, "lineitem")
    shares = [0.25, 0.5, 0.9]
    q = F.percentile_approx("l_quantity", shares, 10000)
    p = F.percentile_approx("l_extendedprice", shares, 1000)
    per = li.groupBy("l_returnflag").agg(q.alias("q"), p.alias("p"), F.count("*").alias("n"))
    exact = quantiles(li, "l_returnflag", F.col("l_extendedprice"), F.concat("l_orderkey", F.lit("/"), "l_linenumber"), shares)
    exact = exact.groupBy(F.col("of").alias("l_returnflag")).agg(*[F.max(F.when(F.col("share") == x, F.col("value"))).alias(f"p{round(100 * x)}") for x in shares])
    both = materialize(per.join(exact, "l_returnflag"), "percentiles")
    # rows between the sketch and the exact value
    lows = [F.least(F.col("p")[i], F.col(f"p{round(100 * x)}")) for i, x in enumerate(shares)]
    highs = [F.greatest(F.col("p")[i], F.col(f"p{round(100 * x)}")) for i, x in enumerate(shares)]
    price = F.col("l_extendedprice")
    met = li.select("l_returnflag", "l_extendedprice").join(F.broadcast(both), "l_returnflag")
    between = met.groupBy("l_returnflag").agg(*[F.count_if((price > a) & (price < b)).alias(f"b{i}") for i, (a, b) in enumerate(zip(lows, highs, strict=True))])
    out = both.join(between, "l_returnflag")
    near = F.greatest("b0", "b1", "b2") <= F.col("n") / 1000 + 1
    return out.select(
        "l_returnflag", *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q90"))],
        *[F.round(c, 4).alias(c) for c in ("p25", "p50", "p90")], near.alias("near"),
    )


@query(
    "agg_spread",
    """
WITH m AS (SELECT l_returnflag, avg(l_quantity) AS mu FROM lineitem GROUP BY 1)
SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd_samp, round(stddev_pop(l_quantity), 6) AS sd_pop,
       round(var_samp(l_quantity), 5) AS var_samp, round(var_pop(l_quantity), 5) AS var_pop,
       round(avg(pow(l_quantity - mu, 3)) / pow(avg(pow(l_quantity - mu, 2)), 1.5), 6) AS skew,
       round(avg(pow(l_quantity - mu, 4)) / pow(avg(pow(l_quantity - mu, 2)), 2) - 3, 6) AS kurt
FROM lineitem JOIN m USING (l_returnflag) GROUP BY 1
""",
)
def agg_spread(spark: SparkSession, d: str) -> DataFrame:
    q = "l_quantity"
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.stddev_samp(q), 6).alias("sd_samp"), F.round(F.stddev_pop(q), 6).alias("sd_pop"),
        F.round(F.var_samp(q), 5).alias("var_samp"), F.round(F.var_pop(q), 5).alias("var_pop"),
        F.round(F.skewness(q), 6).alias("skew"), F.round(F.kurtosis(q), 6).alias("kurt"),
    )


@query(
    "agg_correlation",
    """
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS corr,
       round(covar_pop(l_quantity, l_extendedprice), 3) AS cov_pop,
       round(covar_samp(l_quantity, l_extendedprice), 3) AS cov_samp FROM lineitem GROUP BY 1
""",
)
def agg_correlation(spark: SparkSession, d: str) -> DataFrame:
    a, b = "l_quantity", PRICE
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.corr(a, b), 6).alias("corr"), F.round(F.covar_pop(a, b), 3).alias("cov_pop"),
        F.round(F.covar_samp(a, b), 3).alias("cov_samp"),
    )


@query(
    "agg_collect",
    f"""
SELECT o_custkey, o_orderkey // {LIST_BLOCK} AS block, array_to_string(list_sort(list(o_orderkey)), ',') AS order_keys,
       array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses FROM orders GROUP BY ALL
""",
)
def agg_collect(spark: SparkSession, d: str) -> DataFrame:
    """Ordered list and set per key; a list covers a block of ids and so has at most one block of entries."""
    block = F.floor(F.col("o_orderkey") / LIST_BLOCK).alias("block")
    return table(spark, d, "orders").groupBy("o_custkey", block).agg(
        F.sort_array(F.collect_list("o_orderkey")).alias("order_keys"),
        F.sort_array(F.collect_set("o_orderstatus")).alias("statuses"),
    )


@query(
    "agg_first_last",
    """
SELECT o_custkey, first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS first_key,
       last(o_orderkey ORDER BY o_orderdate, o_orderkey) AS last_key,
       last(nullif(o_orderstatus, 'P') ORDER BY o_orderdate, o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS last_status
FROM orders GROUP BY 1
""",
)
def agg_first_last(spark: SparkSession, d: str) -> DataFrame:
    order = F.struct("o_orderdate", "o_orderkey")
    settled = F.col("o_orderstatus") != "P"
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min_by("o_orderkey", order).alias("first_key"), F.max_by("o_orderkey", order).alias("last_key"),
        F.max_by("o_orderstatus", F.when(settled, order)).alias("last_status"),
    )


@query(
    "agg_rollup",
    """
SELECT l_returnflag, l_linestatus, grouping(l_returnflag)::BIGINT AS g_flag, grouping(l_linestatus)::BIGINT AS g_status,
       count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""",
)
def agg_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(
        F.grouping("l_returnflag").alias("g_flag"), F.grouping("l_linestatus").alias("g_status"),
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"),
    )


@query(
    "agg_cube",
    """
SELECT l_returnflag, l_linestatus, grouping_id(l_returnflag, l_linestatus)::BIGINT AS gid, count(*) AS n,
       sum(l_quantity) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""",
)
def agg_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(
        F.grouping_id("l_returnflag", "l_linestatus").alias("gid"), F.count("*").alias("n"),
        F.sum("l_quantity").alias("quantity"),
    )


GROUPING_SETS = """
SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, sum(l_quantity) AS quantity FROM {lineitem}
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())
"""


@query(
    "agg_grouping_sets",
    f"SELECT * REPLACE (l_linenumber::BIGINT AS l_linenumber) FROM ({GROUPING_SETS.format(lineitem='lineitem')})",
)
def agg_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(GROUPING_SETS, lineitem=table(spark, d, "lineitem"))


EVENT_TYPES = ["signup", "view", "purchase", "click", "error"]


@query(
    "agg_pivot",
    "SELECT user_id, "
    + ", ".join(f"round(sum(value) FILTER (WHERE event_type = '{t}'), 2) AS {t}" for t in EVENT_TYPES)
    + f", round(sum(value) FILTER (WHERE event_type IS NULL OR event_type NOT IN {tuple(EVENT_TYPES)}), 2) AS other FROM events GROUP BY 1",
)
def agg_pivot(spark: SparkSession, d: str) -> DataFrame:
    """The value list is given, so no extra pass looks for it; types that are not in it add up in ``other``."""
    kind = F.when(F.col("event_type").isin(EVENT_TYPES), F.col("event_type")).otherwise("other")
    p = table(spark, d, "events").withColumn("kind", kind).groupBy("user_id").pivot("kind", [*EVENT_TYPES, "other"]).agg(F.sum("value"))
    return p.select("user_id", *[F.round(t, 2).alias(t) for t in [*EVENT_TYPES, "other"]])


@query(
    "agg_unpivot",
    """
SELECT c_custkey, 'nation' AS measure, c_nationkey::DOUBLE AS amount FROM customer
UNION ALL SELECT c_custkey, 'balance', c_acctbal FROM customer
""",
)
def agg_unpivot(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("nation"), F.col("c_acctbal").alias("balance")
    )
    return c.unpivot("c_custkey", ["nation", "balance"], "measure", "amount")


@query(
    "agg_having",
    "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 "
    "HAVING count(*) >= 10 AND sum(o_totalprice) > 2000000",
)
def agg_having(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("total")
    )
    return per.filter((F.col("n") >= 10) & (F.col("total") > 2000000)).withColumn("total", F.round("total", 2))


@query(
    "agg_by_key_reduce",
    """
SELECT l_suppkey, sum(l_quantity) AS total, count(*) AS n, max(l_linenumber)::BIGINT AS top_line,
       bit_xor(l_orderkey)::BIGINT AS mark FROM lineitem GROUP BY 1
""",
)
def agg_by_key_reduce(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("total"), F.count("*").alias("n"), F.max("l_linenumber").alias("top_line"),
        F.bit_xor("l_orderkey").alias("mark"),
    )


@query("agg_tree", "SELECT count(*) AS n, sum(l_quantity) AS quantity, max(l_extendedprice) AS high FROM lineitem")
def agg_tree(spark: SparkSession, d: str) -> DataFrame:
    """Total in levels: hash buckets, groups of buckets, one row. The last step merges a fixed number of rows."""
    bucket = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(1024)).alias("b")
    first = table(spark, d, "lineitem").groupBy(bucket).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.max(PRICE).alias("high")
    )
    second = first.groupBy((F.col("b") % 32).alias("b")).agg(
        F.sum("n").alias("n"), F.sum("quantity").alias("quantity"), F.max("high").alias("high")
    )
    return second.agg(F.sum("n").alias("n"), F.sum("quantity").alias("quantity"), F.max("high").alias("high"))


EDGES = [10000, 25000, 50000]


@query(
    "agg_histogram",
    """
SELECT 'even' AS kind, CAST(floor(l_extendedprice / 11000) AS BIGINT) + 1 AS bucket, count(*) AS n FROM lineitem GROUP BY 2
UNION ALL
SELECT 'edges', CASE WHEN l_extendedprice < 10000 THEN 1 WHEN l_extendedprice < 25000 THEN 2
                     WHEN l_extendedprice < 50000 THEN 3 ELSE 4 END::BIGINT, count(*) FROM lineitem GROUP BY 2
""",
)
def agg_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Even and given buckets from one scan: each price counts once per kind."""
    p = F.col(PRICE)
    even = (F.floor(p / 11000) + 1).cast("long")
    given = sum((F.when(p >= e, 1).otherwise(0) for e in EDGES), F.lit(1)).cast("long")
    both = F.explode(
        F.array(
            F.struct(F.lit("even").alias("kind"), even.alias("bucket")),
            F.struct(F.lit("edges").alias("kind"), given.alias("bucket")),
        )
    )
    return table(spark, d, "lineitem").select(both.alias("b")).groupBy("b.kind", "b.bucket").agg(F.count("*").alias("n"))


@query(
    "agg_skew_salted",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, max(value) AS high FROM events GROUP BY 1",
)
def agg_skew_salted(spark: SparkSession, d: str) -> DataFrame:
    out = salted_agg(
        table(spark, d, "events"), ["event_type"], ["event_id"],
        {"n": F.count("*"), "total": F.sum("value"), "high": F.max("value")},
        {"n": F.sum("n"), "total": F.sum("total"), "high": F.max("high")},
    )
    return out.withColumn("total", F.round("total", 2))


@query(
    "describe_table",
    """
WITH c AS (SELECT * FROM customer)
SELECT 'count' AS summary, count(c_custkey)::DOUBLE AS c_custkey, count(c_acctbal)::DOUBLE AS c_acctbal, count(c_mktsegment)::VARCHAR AS c_mktsegment FROM c
UNION ALL SELECT 'mean', round(avg(c_custkey), 4), round(avg(c_acctbal), 4), NULL FROM c
UNION ALL SELECT 'stddev', round(stddev_samp(c_custkey), 4), round(stddev_samp(c_acctbal), 4), NULL FROM c
UNION ALL SELECT 'min', min(c_custkey), min(c_acctbal), min(c_mktsegment) FROM c
UNION ALL SELECT 'max', max(c_custkey), max(c_acctbal), max(c_mktsegment) FROM c
UNION ALL SELECT '25%', round(quantile_cont(c_custkey, 0.25), 4), round(quantile_cont(c_acctbal, 0.25), 4), NULL FROM c
UNION ALL SELECT '50%', round(quantile_cont(c_custkey, 0.5), 4), round(quantile_cont(c_acctbal, 0.5), 4), NULL FROM c
UNION ALL SELECT '75%', round(quantile_cont(c_custkey, 0.75), 4), round(quantile_cont(c_acctbal, 0.75), 4), NULL FROM c
""",
)
def describe_table(spark: SparkSession, d: str) -> DataFrame:
    """Summary with exact quartiles: the columns go under each other, and ranks are selected in all of them at once."""
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    numbers = ("c_custkey", "c_acctbal")
    long = c.select(F.col("c_custkey").alias("id"), F.explode(F.array(*[F.struct(F.lit(n).alias("of"), F.col(n).cast("double").alias("x")) for n in numbers])).alias("e"))
    found = quantiles(long.select("id", "e.of", "e.x"), "of", F.col("x"), F.col("id"), [0.25, 0.5, 0.75])
    label = F.concat(F.round(F.col("share") * 100).cast("int"), F.lit("%")).alias("summary")
    quarters = found.groupBy(label).agg(*[F.max(F.when(F.col("of") == n, F.col("value"))).alias(n) for n in numbers], F.lit(None).cast("string").alias("c_mktsegment"))
    s = c.summary("count", "mean", "stddev", "min", "max").unionByName(quarters.select("summary", *[F.col(n).cast("string") for n in numbers], "c_mktsegment"))
    return s.select("summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("c_custkey", "c_acctbal")], "c_mktsegment")


@query(
    "crosstab_pairs",
    """
SELECT o_orderpriority AS o_orderpriority_o_orderstatus, count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P
FROM orders GROUP BY 1
""",
)
def crosstab_pairs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").crosstab("o_orderpriority", "o_orderstatus")


@query(
    "frequent_items",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 "
    "HAVING count(*) >= 0.0007 * (SELECT count(*) FROM lineitem)",
)
def frequent_items(spark: SparkSession, d: str) -> DataFrame:
    """Heavy values from a counter sketch, then their exact counts.

    The sketch keeps a bounded number of counters, whatever the number of distinct values, and misses no value above its
    support; the candidates, at most the inverse of that, are then counted exactly.
    """
    keys = table(spark, d, "lineitem").select("l_partkey")
    share = 0.0007
    heavy = keys.freqItems(["l_partkey"], support=0.9 * share).select(F.explode("l_partkey_freqItems").alias("l_partkey"))
    heavy = materialize(heavy.distinct(), "candidates")
    counts = keys.join(F.broadcast(heavy), "l_partkey", "left_semi").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= share * keys.agg(F.count("*")).scalar())


@query(
    "word_count",
    f"SELECT word, count(*) AS n FROM ({WORDS_SQL.format(cols='', table='documents')}) WHERE word <> '' GROUP BY 1",
)
def word_count(spark: SparkSession, d: str) -> DataFrame:
    return words(table(spark, d, "documents")).groupBy("word").agg(F.count("*").alias("n"))


@query(
    "agg_daily_means",
    """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, round(avg(l_quantity), 6) AS mean_quantity,
       round(avg(l_extendedprice), 5) AS mean_price FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
""",
)
def agg_daily_means(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "lineitem").filter("l_returnflag = 'R'")
        .groupBy(F.to_date("l_shipdate").alias("day"))
        .agg(F.round(F.avg("l_quantity"), 6).alias("mean_quantity"), F.round(F.avg(PRICE), 5).alias("mean_price"))
    )


@query(
    "typed_aggregates",
    """
SELECT o_custkey, sum(o_totalprice::DECIMAL(12, 2))::DOUBLE AS exact_total, CAST(sum(o_totalprice::BIGINT) AS BIGINT) AS whole_total,
       count(*) AS n, round(avg(o_totalprice), 6) AS mean, min(o_totalprice) AS low, max(o_totalprice) AS high
FROM orders GROUP BY 1
""".replace("o_totalprice::BIGINT", "CAST(trunc(o_totalprice) AS BIGINT)"),
)
def typed_aggregates(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("o_totalprice")
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        F.sum(p.cast("decimal(12,2)")).alias("exact_total"), F.sum(p.cast("long")).alias("whole_total"),
        F.count("*").alias("n"), F.round(F.avg(p), 6).alias("mean"), F.min(p).alias("low"), F.max(p).alias("high"),
    )
