"""Graph loops on edge frames ``(src, dst, ...)``: joins and aggregates per round.

Every few rounds the state is written to the shared folder and read back, so
that plans stay short and a lost executor costs at most those rounds. Loops
stop on a count of changed rows; no rows come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.session import materialize

CUT_EVERY = 4


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def with_out_degree(edges: DataFrame) -> DataFrame:
    deg = edges.groupBy("src").agg(F.count("*").alias("out_degree"))
    return edges.select("src", "dst").join(deg, "src")


def rank_round(ranks: DataFrame, links: DataFrame, verts: DataFrame, damping: float) -> DataFrame:
    """1 - damping + damping * sum of rank shares; every vertex adds a zero share, so none is lost."""
    share = (F.col("rank") / F.col("out_degree")).alias("share")
    shares = links.join(ranks, F.col("src") == F.col("id")).select(F.col("dst").alias("id"), share)
    every = shares.unionAll(verts.select("id", F.lit(0.0)))
    return every.groupBy("id").agg((1 - damping + damping * F.sum("share")).alias("rank"))


def pagerank(edges: DataFrame, rounds: int, damping: float = 0.85) -> DataFrame:
    links = materialize(with_out_degree(edges), "links")
    verts = materialize(vertices(edges), "vertices")
    ranks = verts.withColumn("rank", F.lit(1.0))
    for i in range(rounds):
        ranks = rank_round(ranks, links, verts, damping)
        if (i + 1) % CUT_EVERY == 0 and i + 1 < rounds:
            ranks = materialize(ranks, "ranks")
    return ranks


def pagerank_converged(edges: DataFrame, tolerance: float, max_rounds: int = 200, damping: float = 0.85) -> DataFrame:
    links = materialize(with_out_degree(edges), "links")
    verts = materialize(vertices(edges), "vertices")
    ranks = verts.withColumn("rank", F.lit(1.0))
    for _ in range(0, max_rounds, CUT_EVERY):
        new = ranks
        for _ in range(CUT_EVERY):
            new = rank_round(new, links, verts, damping)
        new = materialize(new, "ranks")
        change = new.alias("a").join(ranks.alias("b"), "id").select(F.max(F.abs(F.col("a.rank") - F.col("b.rank"))))
        ranks = new
        if (change.first()[0] or 0.0) < tolerance:
            return ranks
    raise RuntimeError("ranks did not settle")


def components(edges: DataFrame) -> DataFrame:
    """Smallest vertex id of each component, by contraction.

    In a round each vertex points to the neighbour that comes first in a
    random order, if that comes before itself, and follows that one's pointer
    too. Edges are then drawn between the vertices reached; those within one
    vertex go, and equal ones become one. Pointers form short chains, so the
    edges shrink by a share of themselves. Vertices of one round keep what
    they became; the chain of these maps gives each vertex the one it ends in.
    """
    links = edges.select("src", "dst")
    links = materialize(links.filter("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct(), "links")
    first = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    maps: list[DataFrame] = []
    while not links.isEmpty():
        both = links.select(F.explode(F.array(F.struct(F.col("a").alias("id"), first("b").alias("f")), F.struct(F.col("b").alias("id"), first("a").alias("f")))).alias("e"))
        step = both.groupBy(F.col("e.id").alias("id")).agg(F.min("e.f").alias("f")).select("id", F.least("f", first("id")).getField("v").alias("to"))
        step = materialize(step, "pointers")
        reached = step.join(step.toDF("mid", "end"), F.col("to") == F.col("mid")).select("id", F.col("end").alias("to"))
        maps.append(reached)
        ends = reached.toDF("mid", "end")
        drawn = links.join(ends, F.col("a") == F.col("mid")).select(F.col("end").alias("a"), "b").join(ends, F.col("b") == F.col("mid")).select("a", F.col("end").alias("b"))
        # one that was reached but points on stays tied to where it went
        drawn = drawn.unionAll(reached.toDF("a", "b").join(reached.select(F.col("to").alias("a")).distinct(), "a", "left_semi"))
        drawn = drawn.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = materialize(drawn, "links")
    alone = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    if not maps:
        return alone.select("id", F.col("id").alias("comp"))
    known = maps[-1]
    for earlier in reversed(maps[:-1]):
        ends = known.toDF("mid", "end")
        known = materialize(earlier.join(ends, F.col("to") == F.col("mid"), "left").select("id", F.coalesce("end", "to").alias("to")), "roots")
    names = known.groupBy("to").agg(F.min("id").alias("comp"))
    return materialize(alone.join(known, "id", "left").join(names, "to", "left").select("id", F.coalesce("comp", "id").alias("comp")), "components")


def triangles(edges: DataFrame) -> DataFrame:
    """Triangles per vertex. Edges point from lower to higher degree, which bounds the pairs that meet at a hub."""
    one = edges.filter("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    one = materialize(one, "pairs")
    deg = one.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count("*").alias("d"))
    ranked = one.join(deg.select(F.col("v").alias("a"), F.col("d").alias("da")), "a").join(
        deg.select(F.col("v").alias("b"), F.col("d").alias("db")), "b"
    )
    swap = (F.col("da") > F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") > F.col("b")))
    up = materialize(
        ranked.select(
            F.when(swap, F.col("b")).otherwise(F.col("a")).alias("x"),
            F.when(swap, F.col("a")).otherwise(F.col("b")).alias("y"),
        ),
        "oriented",
    )
    e1, e2, e3 = up, up.toDF("x2", "z"), up.toDF("y3", "z3")
    wedge = e1.join(e2, F.col("y") == F.col("x2"))
    tri = wedge.join(e3, (F.col("x") == F.col("y3")) & (F.col("z") == F.col("z3")))
    return tri.select(F.explode(F.array("x", "y", "z")).alias("id")).groupBy("id").agg(F.count("*").alias("triangles"))


def shortest_paths(edges: DataFrame, source: int, max_rounds: int = 1000) -> DataFrame:
    """Smallest sum of ``cost`` from the source; only vertices that got better send again."""
    links = edges.select("src", "dst", "cost")
    dist = materialize(
        edges.sparkSession.range(1).select(F.lit(source).cast("long").alias("id"), F.lit(0).cast("long").alias("dist")),
        "dist",
    )
    front = dist
    for _ in range(max_rounds):
        offers = links.join(front, F.col("src") == F.col("id")).groupBy("dst").agg(
            F.min(F.col("dist") + F.col("cost")).alias("offer")
        )
        step = dist.join(offers, F.col("id") == F.col("dst"), "full").select(
            F.coalesce("id", "dst").alias("id"), F.least("dist", "offer").alias("dist"),
            (F.col("dist").isNull() | (F.col("offer") < F.col("dist"))).alias("better"),
        )
        step = materialize(step, "dist")
        dist, front = step.select("id", "dist"), step.filter("better").select("id", "dist")
        if front.isEmpty():
            return dist
    raise RuntimeError("distances did not settle")


def transitive_closure(edges: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """All reachable pairs; each round extends only the pairs found in the round before."""
    links = edges.select("src", "dst").distinct()
    known = materialize(links, "closure")
    fresh = known
    for _ in range(max_rounds):
        longer = fresh.join(links.toDF("mid", "end"), F.col("dst") == F.col("mid")).select("src", F.col("end").alias("dst"))
        found = materialize(longer.distinct().join(known, ["src", "dst"], "left_anti"), "fresh")
        if found.isEmpty():
            return known
        known = materialize(known.unionByName(found), "closure")
        fresh = found
    raise RuntimeError("closure did not settle")
