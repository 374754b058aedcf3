"""Graph jobs on trade between nations and on customers joined by rare parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators import graph as G
from dayledger.registry import query
from dayledger.session import materialize, table

TRADE_SQL = """
trade AS MATERIALIZED (
  SELECT s_nationkey::BIGINT AS src, c_nationkey::BIGINT AS dst, sum(l_extendedprice) AS total, count(*) AS cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
edges AS MATERIALIZED (SELECT * FROM trade WHERE total > {share} * (SELECT avg(total) FROM trade)),
verts AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges)
"""


def nation_trade(spark: SparkSession, d: str, share: float) -> DataFrame:
    """Edges supplier nation → customer nation above a share of the mean trade."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("long").alias("src"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("dst"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(c, "o_custkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice").join(s, "l_suppkey")
    trade = li.join(o, "l_orderkey").groupBy("src", "dst").agg(
        F.sum("l_extendedprice").alias("total"), F.count("*").alias("cost")
    )
    trade = materialize(trade, "trade")
    return trade.filter(F.col("total") > share * trade.select(F.avg("total")).scalar())


def names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), "n_name")


ROUNDS = 8


def unrolled_rank_sql(rounds: int, result: str) -> str:
    text = [f"WITH {TRADE_SQL.format(share=1.1).strip()}",
            "deg AS MATERIALIZED (SELECT src, count(*) AS n FROM edges GROUP BY 1)",
            "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM verts)"]
    for i in range(rounds):
        text.append(
            f"r{i + 1} AS MATERIALIZED (SELECT v.id, 0.15 + 0.85 * coalesce(sum(r.rank / deg.n), 0) AS rank FROM verts v "
            f"LEFT JOIN edges e ON e.dst = v.id LEFT JOIN r{i} r ON r.id = e.src LEFT JOIN deg ON deg.src = e.src GROUP BY 1)"
        )
    return ",\n".join(text) + f"\n{result.format(last=rounds)}"


@query("graph_pagerank", unrolled_rank_sql(ROUNDS, "SELECT id, n_name, round(rank, 8) AS rank FROM r{last} JOIN nation ON id = n_nationkey"))
def graph_pagerank(spark: SparkSession, d: str) -> DataFrame:
    ranks = G.pagerank(nation_trade(spark, d, 1.1), ROUNDS)
    return ranks.join(names(spark, d), "id").select("id", "n_name", F.round("rank", 8).alias("rank"))


# more rounds than it takes to settle; ranks are compared to three places
@query(
    "graph_pagerank_converge",
    unrolled_rank_sql(60, "SELECT id, round(rank, 3) AS rank, n_name FROM (SELECT * FROM r{last} WHERE id % 2 = 0 ORDER BY rank DESC, id LIMIT 5) "
                          "JOIN nation ON id = n_nationkey"),
)
def graph_pagerank_converge(spark: SparkSession, d: str) -> DataFrame:
    """Ranks run until they settle; the five highest of the subgraph of even nations."""
    e = nation_trade(spark, d, 1.1)
    ranks = G.pagerank_converged(e, 1e-6).join(names(spark, d), "id")
    return ranks.filter("id % 2 = 0").orderBy(F.desc("rank"), "id").limit(5).withColumn("rank", F.round("rank", 3))


RARE_SQL = """
rare AS MATERIALIZED (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) <= 18),
pairs AS MATERIALIZED (SELECT DISTINCT o_custkey * 2 AS src, l_partkey * 2 + 1 AS dst FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey IN (SELECT l_partkey FROM rare)),
links AS MATERIALIZED (SELECT src, dst FROM pairs UNION SELECT dst, src FROM pairs)
"""


@query(
    "graph_components",
    f"""
WITH RECURSIVE {RARE_SQL.strip()},
reach AS (SELECT src AS id, src AS seen FROM links UNION SELECT l.src, r.seen FROM links l JOIN reach r ON l.dst = r.id)
SELECT id // 2 AS c_custkey, c_name, min(seen) AS comp FROM reach JOIN customer ON c_custkey = id // 2
WHERE id % 2 = 0 GROUP BY ALL
""",
)
def graph_components(spark: SparkSession, d: str) -> DataFrame:
    """Customers joined through parts that sell rarely; each gets the smallest id of its component."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    rare = li.groupBy("l_partkey").agg(F.count("*").alias("n")).filter("n <= 18").select("l_partkey")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    edges = li.join(rare, "l_partkey", "left_semi").join(o, "l_orderkey").select(
        (F.col("o_custkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst")
    )
    found = G.components(materialize(edges.distinct(), "pairs")).filter("id % 2 = 0")
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return found.select(F.floor(F.col("id") / 2).alias("c_custkey"), "comp").join(c, "c_custkey")


@query(
    "graph_triangles",
    f"""
WITH {TRADE_SQL.format(share=1.1).strip()},
e AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst),
t AS (SELECT e1.a AS x, e1.b AS y, e2.b AS z FROM e e1 JOIN e e2 ON e1.b = e2.a JOIN e e3 ON e3.a = e1.a AND e3.b = e2.b)
SELECT id, count(*) AS triangles FROM (SELECT x AS id FROM t UNION ALL SELECT y FROM t UNION ALL SELECT z FROM t) GROUP BY 1
""",
)
def graph_triangles(spark: SparkSession, d: str) -> DataFrame:
    return G.triangles(nation_trade(spark, d, 1.1))


def unrolled_paths_sql(rounds: int = 14) -> str:
    text = [f"WITH {TRADE_SQL.format(share=1.1).strip()}", "d0 AS MATERIALIZED (SELECT min(src) AS id, 0::BIGINT AS dist FROM edges)"]
    for i in range(rounds):
        text.append(
            f"d{i + 1} AS MATERIALIZED (SELECT id, min(dist) AS dist FROM (SELECT * FROM d{i} UNION ALL "
            f"SELECT e.dst, d.dist + e.cost FROM d{i} d JOIN edges e ON e.src = d.id) GROUP BY id)"
        )
    return ",\n".join(text) + f"\nSELECT id, dist FROM d{rounds}"


@query("graph_shortest_path", unrolled_paths_sql())
def graph_shortest_path(spark: SparkSession, d: str) -> DataFrame:
    """From the first selling nation."""
    e = nation_trade(spark, d, 1.1)
    source = e.agg(F.min("src")).first()[0]
    return G.shortest_paths(e, source)


@query(
    "graph_transitive_closure",
    f"""
WITH RECURSIVE {TRADE_SQL.format(share=1.6).strip()},
tc AS (SELECT src, dst FROM edges UNION SELECT tc.src, e.dst FROM tc JOIN edges e ON tc.dst = e.src)
SELECT src, dst FROM tc
""",
)
def graph_transitive_closure(spark: SparkSession, d: str) -> DataFrame:
    """On the thinned trade graph: the pairs are bounded by the square of the number of nations."""
    return G.transitive_closure(nation_trade(spark, d, 1.6))


@query(
    "graph_neighbour_agg",
    f"""
WITH {TRADE_SQL.format(share=1.1).strip()},
v AS (SELECT c_nationkey::BIGINT AS id, count(*) AS size FROM customer GROUP BY 1)
SELECT b.id, count(*) AS n_larger, round(avg(a.size), 6) AS mean_size
FROM edges e JOIN v a ON a.id = e.src JOIN v b ON b.id = e.dst WHERE a.size > b.size GROUP BY 1
""",
)
def graph_neighbour_agg(spark: SparkSession, d: str) -> DataFrame:
    """Per nation: number and mean size of the larger nations that sell to it."""
    v = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("id")).agg(F.count("*").alias("size"))
    e = nation_trade(spark, d, 1.1).select("src", "dst")
    seller = v.select(F.col("id").alias("src"), F.col("size").alias("src_size"))
    buyer = v.select(F.col("id").alias("dst"), F.col("size").alias("dst_size"))
    sent = e.join(seller, "src").join(buyer, "dst").filter("src_size > dst_size")
    return sent.groupBy(F.col("dst").alias("id")).agg(
        F.count("*").alias("n_larger"), F.round(F.avg("src_size"), 6).alias("mean_size")
    )


@query(
    "graph_degree_join",
    f"""
WITH {TRADE_SQL.format(share=1.1).strip()},
sub AS (SELECT * FROM edges WHERE src IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)
                              AND dst IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2))
SELECT n_nationkey::BIGINT AS id, n_name, coalesce(o.n, 0) AS out_degree, coalesce(i.n, 0) AS in_degree FROM nation
LEFT JOIN (SELECT src, count(*) AS n FROM sub GROUP BY 1) o ON o.src = n_nationkey
LEFT JOIN (SELECT dst, count(*) AS n FROM sub GROUP BY 1) i ON i.dst = n_nationkey
""",
)
def graph_degree_join(spark: SparkSession, d: str) -> DataFrame:
    """Degrees in the subgraph without one region, joined to all vertices and their names."""
    inside = table(spark, d, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").cast("long").alias("id"))
    e = nation_trade(spark, d, 1.1).select("src", "dst")
    sub = e.join(inside, F.col("src") == F.col("id"), "left_semi").join(inside, F.col("dst") == F.col("id"), "left_semi")
    out = sub.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree"))
    into = sub.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))
    joined = names(spark, d).join(out, "id", "left").join(into, "id", "left")
    return joined.na.fill(0, ["out_degree", "in_degree"])
