"""Model jobs: own parts against brute force, fits against bounds."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from support import SMALL
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dayledger.jobs import all_jobs
from dayledger.operators import matrix as M
from dayledger.operators.likeness import distinct_sets, hashed_bands, leader_links, like_sets, rarest_first
from dayledger.operators.nearest import best_rows
from dayledger.plans.joins import words
from dayledger.plans.models import bounded, judged
from dayledger.plans.rows import gapless_index
from dayledger.registry import runnable
from dayledger.session import table


def run(spark, name):
    return runnable(all_jobs()[name])(spark, SMALL)


def test_gram_and_cosines(spark):
    x = np.random.default_rng(1).normal(size=(50, 6))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(4)
    got = {(r.i, r.j): r.x for r in M.gram(df).collect()}
    g = x.T @ x
    assert got == pytest.approx({(i, j): g[i, j] for i in range(6) for j in range(6)})
    cos = {(r.i, r.j): r.cosine for r in M.column_cosines(df).collect()}
    n = np.linalg.norm(x, axis=0)
    assert cos == pytest.approx({(i, j): g[i, j] / n[i] / n[j] for i in range(6) for j in range(i + 1, 6)})


def test_matrix_product(spark):
    rnd = random.Random(2)
    a = {(i, j): float(rnd.randrange(1, 9)) for i in range(5) for j in range(7) if rnd.random() < 0.5}
    b = {(i, j): float(rnd.randrange(1, 9)) for i in range(7) for j in range(4) if rnd.random() < 0.5}
    frame = lambda m: spark.createDataFrame([(i, j, x) for (i, j), x in m.items()], "i long, j long, x double")
    want = {}
    for (i, k), x in a.items():
        for (k2, j), y in b.items():
            if k == k2:
                want[(i, j)] = want.get((i, j), 0.0) + x * y
    assert {(r.i, r.j): r.x for r in M.multiply(frame(a), frame(b)).collect()} == want


def random_sets(seed, n):
    """Copies, near copies, a word in all sets, empty sets."""
    rnd = random.Random(seed)
    base = [[f"w{rnd.randint(0, 300)}" for _ in range(rnd.randint(1, 25))] for _ in range(12)]
    out = {}
    for i in range(n):
        words = [w for w in rnd.choice(base) if rnd.random() > 0.15] + [f"w{rnd.randint(0, 300)}" for _ in range(rnd.randint(0, 4))]
        out[i] = sorted({*words, "the"}) if i % 17 else []
    return out


@pytest.mark.parametrize("percent", [50, 60, 80, 100])
def test_like_sets_lose_no_pair(spark, percent):
    sets = random_sets(percent, 150)
    df = spark.createDataFrame(list(sets.items()), "id long, words array<string>")
    one = distinct_sets(df, "id", "words")
    heads = {}
    for i, w in sets.items():
        heads.setdefault(tuple(w), []).append(i)
    assert {(r.id, r.copies) for r in one.collect()} == {(min(v), len(v)) for v in heads.values()}
    ordered = rarest_first(df, "id", "words")
    got = {(r.left_id, r.right_id): r.jaccard for r in like_sets(ordered.filter("id % 3 = 0"), ordered, percent).collect()}
    want = {}
    for i, a in sets.items():
        for j, b in sets.items():
            common = len(set(a) & set(b))
            if i % 3 == 0 and common and 100 * common >= percent * len(set(a) | set(b)):
                want[i, j] = common / len(set(a) | set(b))
    assert got == pytest.approx(want) and len(want) > 40


def test_leaders_take_rows_that_the_first_leader_does_not(spark):
    """One bucket with three groups: a single leader would lose two of them; no round compares all pairs."""
    groups = [[f"g{g}w{k}" for k in range(10)] for g in range(3)]
    rows = [(i, [*groups[i % 3], f"own{i}"], [7]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, words array<string>, keys array<long>")
    assert {(r.id, r.leader) for r in leader_links(df, 60).collect()} == {(i, i % 3) for i in range(3, 60)}
    hashed = hashed_bands(df.select("id", "words"), 24, 4, 1)
    links = {(r.id, r.leader) for r in leader_links(hashed, 60).collect()}
    assert {i for i, _ in links} == set(range(3, 60)) and all(i % 3 == j % 3 for i, j in links)


@pytest.mark.parametrize("metric", ["distance", "product"])
@pytest.mark.parametrize("block", [4096, 7])
def test_best_rows_are_those_of_all_pairs(spark, monkeypatch, metric, block):
    """Clusters of very different norms, copies of one vector for a third of the rows, rows that do not count."""
    monkeypatch.setattr("dayledger.operators.nearest.BLOCK_ROWS", block)
    monkeypatch.setattr("dayledger.operators.nearest.BLOCK_QUERIES", block)
    rng = np.random.default_rng(5)
    rows = np.concatenate([rng.normal(size=(200, 6)) * (1 + 3 * (k % 3)) + 9 * k for k in range(2)] + [np.ones((200, 6))])
    asked = rng.normal(size=(40, 6)) * 5
    skip = [None if i % 2 else [int(x) for x in rng.integers(0, 600, 30)] for i in range(40)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, v array<double>")
    q = spark.createDataFrame([(i, [float(x) for x in v], s) for i, (v, s) in enumerate(zip(asked, skip, strict=True))], "query long, v array<double>, skip array<long>")
    got = {}
    for r in best_rows(q, df, 5, metric).collect():
        got[r.query, r.place] = (r.id, pytest.approx(r.cost))
    want = {}
    for i, v in enumerate(asked):
        cost = np.sqrt(((rows - v) ** 2).sum(1)) if metric == "distance" else -(np.einsum("ij,j->i", rows, v))
        cost[skip[i] or []] = np.inf
        for place, j in enumerate(np.lexsort((np.arange(600), cost))[:5]):
            want[i, place + 1] = (j, cost[j])
    assert got == want
    assert best_rows(q, df.limit(0), 5, metric).count() == 0 and best_rows(q.limit(0), df, 5, metric).count() == 0


def test_tfidf_equals_the_library(spark):
    docs = table(spark, SMALL, "documents")
    got = {(r.doc_id, r.word): r.tfidf for r in run(spark, "ml_feature_tfidf").collect()}
    tokens = words(docs, "doc_id").groupBy("doc_id").agg(F.collect_list("word").alias("w"))
    cv = CountVectorizer(inputCol="w", outputCol="tf", vocabSize=1 << 20).fit(tokens)
    tf, vocabulary = cv.transform(tokens), cv.vocabulary
    out = IDF(inputCol="tf", outputCol="x").fit(tf).transform(tf).select("doc_id", vector_to_array("x").alias("x"))
    # rows of the library count only documents that have words, as here
    n_docs, n_words = docs.count(), tokens.count()
    if n_docs == n_words:
        for r in out.limit(20).collect():
            for i, x in enumerate(r.x):
                if x > 0:
                    assert got[(r.doc_id, vocabulary[i])] == pytest.approx(x, abs=1e-5)


def test_fits_are_useful(spark):
    for name in ("ml_logistic", "ml_tree_classifier", "ml_gbt_regressor"):
        rows = run(spark, name).collect()
        assert rows and all(r.good for r in rows)
    rows = run(spark, "ml_kmeans").collect()
    assert rows and all(r.nearest and r.better and r.agrees for r in rows)


def test_a_useless_fit_is_not_good(spark):
    df = spark.range(100).selectExpr("CAST(id % 2 AS DOUBLE) AS label", "1.0D AS prediction")
    assert [r.good for r in judged(df, 0.9).collect()] == [False, False]
    assert [r.good for r in bounded(df, 0.5).collect()] == [False]


def test_index_of_far_and_large_keys(spark):
    keys = [*range(1000), 10**11, 1 << 62, -(1 << 62)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    got = {r.k: r.idx for r in gapless_index(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_near_texts_are_near(spark):
    rows = run(spark, "ml_lsh_minhash").collect()
    text = {r.doc_id: set(__import__("re").split("[ \n]+", r.text.lower())) for r in table(spark, SMALL, "documents").collect()}
    for r in rows:
        a, b = text[r.doc_id], text[r.other]
        assert r.jaccard == pytest.approx(len(a & b) / len(a | b))
        assert r.jaccard >= 0.6


def test_svd_and_isotonic(spark):
    x = np.array([r.embedding for r in table(spark, SMALL, "embeddings").collect()])
    s = np.linalg.svd(x, compute_uv=False)
    got = run(spark, "ml_pca_svd").first()
    assert got.good and got.squares == pytest.approx(float((s**2).sum()), rel=1e-4)
    iso = run(spark, "ml_isotonic").orderBy("size").collect()
    assert all(a.prediction <= b.prediction + 1e-9 for a, b in zip(iso, iso[1:]))
    assert not any(math.isnan(r.prediction) for r in iso)
