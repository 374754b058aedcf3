"""Graph loops against plain Python on random graphs."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from support import rows_of

from dayledger.operators import graph as G

EDGE = "src long, dst long, cost long"


def random_edges(seed: int, n: int, m: int):
    rnd = random.Random(seed)
    found = {}
    while len(found) < m:
        a, b = rnd.randrange(n), rnd.randrange(n)
        if a != b:
            found[(a, b)] = rnd.randrange(1, 20)
    return [(a, b, c) for (a, b), c in found.items()]


@pytest.mark.parametrize("edges", [random_edges(1, 40, 35), [(i, i + 1, 1) for i in range(30)], [(0, i, 1) for i in range(1, 25)]])
def test_components(spark, edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, _ in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = sorted((v, find(v)) for v in list(parent))
    assert sorted(map(tuple, G.components(spark.createDataFrame(edges, EDGE)).collect())) == want


def test_components_contract(spark, monkeypatch):
    """Edges of a round are fewer than those of the one before, on a long path and on a hub; loops and equal edges do no harm."""
    sizes = []
    keep = G.materialize

    def counting(df, name):
        out = keep(df, name)
        if name == "links":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(G, "materialize", counting)
    path = [(i, i + 1) for i in range(400)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (3, 4), (4, 3), (2000, 2000)]
    got = {r.id: r.comp for r in G.components(spark.createDataFrame(path, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(401)} | {i: 1000 for i in range(1000, 1100)} | {2000: 2000}
    assert sizes[-1] == 0 and all(b <= 0.7 * a for a, b in zip(sizes, sizes[1:], strict=False))


def test_components_of_long_pointer_chains(spark, monkeypatch):
    """An order in which every pointer of a path leads on to the next: the tie between what was reached and where it goes holds."""
    monkeypatch.setattr(G.F, "xxhash64", lambda c: F.col(c))
    path = [(i, i + 1) for i in range(60)] + [(100 + i, 101 + i) for i in range(7)]
    got = {r.id: r.comp for r in G.components(spark.createDataFrame(path, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 108)}


def test_paths_closure_triangles(spark):
    edges = random_edges(3, 15, 40)
    df = spark.createDataFrame(edges, EDGE)
    dist = {0: 0}
    for _ in range(20):
        for a, b, c in edges:
            if a in dist and dist[a] + c < dist.get(b, 10**9):
                dist[b] = dist[a] + c
    assert sorted(map(tuple, G.shortest_paths(df, 0).collect())) == sorted(dist.items())

    reach = {(a, b) for a, b, _ in edges}
    while True:
        more = {(a, d) for a, b in reach for c, d in reach if b == c} | reach
        if more == reach:
            break
        reach = more
    assert sorted(map(tuple, G.transitive_closure(df).collect())) == sorted(reach)

    pairs = {frozenset((a, b)) for a, b, _ in edges}
    count = {}
    for t in combinations(range(15), 3):
        if all(frozenset(p) in pairs for p in combinations(t, 2)):
            for v in t:
                count[v] = count.get(v, 0) + 1
    assert sorted(map(tuple, G.triangles(df).collect())) == sorted(count.items())


def test_pagerank(spark):
    edges = random_edges(5, 12, 30)
    ids = sorted({x for a, b, _ in edges for x in (a, b)})
    out = {v: [b for a, b, _ in edges if a == v] for v in ids}
    rank = dict.fromkeys(ids, 1.0)

    def step(r):
        new = dict.fromkeys(ids, 0.15)
        for v in ids:
            for b in out[v]:
                new[b] += 0.85 * r[v] / len(out[v])
        return new

    for _ in range(6):
        rank = step(rank)
    df = spark.createDataFrame(edges, EDGE)
    got = {r.id: r.rank for r in G.pagerank(df, 6).collect()}
    assert got == pytest.approx(rank)
    for _ in range(200):
        rank = step(rank)
    assert {r.id: r.rank for r in G.pagerank_converged(df, 1e-3).collect()} == pytest.approx(rank, abs=1e-2)
    assert rows_of(G.vertices(df)) == [(v,) for v in sorted(ids, key=lambda v: repr((v,)))]
