"""Sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.hot import number_rows
from dayledger.plans.rows import LATE_ORDERS_SQL, late_orders
from dayledger.registry import query
from dayledger.session import table


@query("sort_multi", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sort_multi(spark: SparkSession, d: str) -> DataFrame:
    """Range-partitioned; the unique key at the end lets ranges split any tie."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return o.orderBy(F.asc("o_orderstatus"), F.desc("o_totalprice"), "o_orderkey")


NULL_PLACES = ("asc_first", "asc_last", "desc_first", "desc_last")
PLACED = "SELECT '{n}' AS place, c_custkey, top_status, top_price, row_number() OVER (ORDER BY top_price {o}, c_custkey) AS at FROM {t}"


@query(
    "sort_nulls",
    " UNION ALL ".join(PLACED.format(n=n, t=LATE_ORDERS_SQL, o=n.upper().replace("_", " NULLS ")) for n in NULL_PLACES),
)
def sort_nulls(spark: SparkSession, d: str) -> DataFrame:
    """All rows in each of the four null orders, with their place in it.

    The order is written as plain columns, whether a row has a price and the price with its sign, so that one sort by
    ranges gives the places of all four.
    """
    df = late_orders(spark, d).select("c_custkey", "top_status", "top_price")
    ways = []
    for name in NULL_PLACES:
        down, last = name.startswith("desc"), name.endswith("last")
        none = F.col("top_price").isNull()
        ways.append(F.struct(F.lit(name).alias("place"), (none if last else ~none).alias("late"), (-F.col("top_price") if down else F.col("top_price")).alias("by")))
    every = df.select("*", F.explode(F.array(*ways)).alias("w")).select(*df.columns, "w.*")
    return number_rows(every, ["place"], ["late", "by", "c_custkey"], "at").select("place", *df.columns, "at")


@query(
    "limit_take",
    """
(SELECT 'first' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)
UNION ALL (SELECT 'last', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10)
UNION ALL (SELECT 'skip', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5 OFFSET 10)
""",
)
def limit_take(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    up = o.orderBy("o_totalprice", "o_orderkey")
    down = o.orderBy(F.desc("o_totalprice"), F.desc("o_orderkey"))
    parts = {"first": up.limit(10), "last": down.limit(10), "skip": up.offset(10).limit(5)}
    tagged = [p.select(F.lit(n).alias("part"), "*") for n, p in parts.items()]
    return tagged[0].unionAll(tagged[1]).unionAll(tagged[2])


@query(
    "topk_global",
    "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_orderkey, l_partkey LIMIT 25",
)
def topk_global(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return li.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_partkey").limit(25)


@query(
    "set_union",
    "SELECT c_nationkey::BIGINT AS nationkey, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def set_union(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_nationkey", "c_acctbal").toDF("nationkey", "balance")
    return c.union(table(spark, d, "supplier").select("s_nationkey", "s_acctbal"))


@query(
    "set_union_by_name",
    "SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier",
)
def set_union_by_name(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


F_KEYS = "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'"
U_KEYS = "SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'"
TAGGED_SETS = """
SELECT 'distinct' AS kind, k, count(*) AS n FROM ({f} {op} {u}) GROUP BY k
UNION ALL SELECT 'all', k, count(*) FROM ({f} {op} ALL {u}) GROUP BY k
"""


def _keys(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, d, "orders")
    k = F.col("o_custkey").alias("k")
    return o.filter("o_orderstatus = 'F'").select(k), o.filter("o_orderpriority = '1-URGENT'").select(k)


def _tagged(distinct: DataFrame, every: DataFrame) -> DataFrame:
    both = distinct.select(F.lit("distinct").alias("kind"), "k").unionAll(every.select(F.lit("all"), "k"))
    return both.groupBy("kind", "k").agg(F.count("*").alias("n"))


@query("set_intersect", TAGGED_SETS.format(f=F_KEYS, u=U_KEYS, op="INTERSECT"))
def set_intersect(spark: SparkSession, d: str) -> DataFrame:
    a, b = _keys(spark, d)
    return _tagged(a.intersect(b), a.intersectAll(b))


@query("set_except", TAGGED_SETS.format(f=F_KEYS, u=U_KEYS, op="EXCEPT"))
def set_except(spark: SparkSession, d: str) -> DataFrame:
    a, b = _keys(spark, d)
    return _tagged(a.subtract(b), a.exceptAll(b))
