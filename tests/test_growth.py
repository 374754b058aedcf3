"""What keeps work in step with the rows: tasks, calls into Python, shuffles."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from support import SMALL, rows_of

from dayledger.jobs import all_jobs
from dayledger.registry import runnable
from dayledger.session import scratch
from dayledger.streaming.feed import drain_append, in_steps


def run(spark, name):
    return runnable(all_jobs()[name])(spark, SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sketch_is_not_held_for_every_key(spark):
    """One aggregate with a distinct count would keep a sketch for each pair of flag and order."""
    keyed = [x for x in plan(run(spark, "agg_approx_distinct")).splitlines() if "l_orderkey" in x and "approx_count_distinct" in x and "keys=[l_returnflag" in x]
    assert not any("l_orderkey" in x.split("functions=")[0] for x in keyed)


def test_word2vec_trains_in_as_many_tasks_as_its_words_ask_for(spark, monkeypatch):
    from dayledger.plans import features

    seen, fit = [], features.fitted
    monkeypatch.setattr(features, "TASK_ROWS", 10_000)
    monkeypatch.setattr(features, "fitted", lambda est, df: (seen.append(est.getNumPartitions()), fit(est, df))[1])
    assert run(spark, "ml_word2vec").first().good and seen[0] > 1


def test_sessions_of_two_users_in_one_bucket(spark):
    """Both users share a key; a late row joins two sessions of one of them and leaves the other's alone."""
    from dayledger.streaming.jobs import OPEN_SESSIONS, SESSION_ROW, track_bucket

    def at(rows):
        return spark.createDataFrame(rows, "user_id long, h double").selectExpr(
            "user_id", "CAST(TIMESTAMP'2024-01-01' + make_dt_interval(0, 0, CAST(h * 60 AS INT), 0) AS TIMESTAMP) AS ts")

    out = scratch(spark, "bucket")

    def one(s, checkpoint):
        parts = s.selectExpr("user_id", "ts AS start", "ts AS last", "1L AS n", "0 AS bucket").withWatermark("last", "12 hours")
        kept = parts.groupBy("bucket").applyInPandasWithState(track_bucket, SESSION_ROW, OPEN_SESSIONS, "append", "EventTimeTimeout")
        return drain_append(kept, "bucket", checkpoint, out)

    steps = [at([(7, 0.0), (7, 11.0), (8, 1.0), (8, 10.5)]), at([(7, 5.5)]), at([(9, 300.0)])]
    rows = in_steps(steps, "bucket-in", one)[-1].select("user_id", "seconds", "n")
    assert rows_of(rows) == [(7, 11 * 3600.0, 3), (8, 0.0, 1), (8, 0.0, 1)]


def test_balances_are_added_by_customer():
    from dayledger.streaming.jobs import added

    held = pd.DataFrame({"c_custkey": pd.array([1, 2], "Int64"), "balance": [10.0, 5.0], "n": [0, 3]})
    more = pd.DataFrame({"c_custkey": pd.array([2, 2, None], "Int64"), "balance": [1.0, 2.0, 4.0], "n": 1})
    got = {None if pd.isna(k) else k: (b, n) for k, b, n in added(held, more).itertuples(index=False)}
    assert got == {1: (10.0, 0), 2: (8.0, 5), None: (4.0, 1)}


def test_python_means_leave_out_nulls():
    from dayledger.plans.udfs import count_rows, weighted_mean
    from dayledger.plans.windows import own_mean

    v = pd.Series([2.0, float("nan"), 4.0])
    assert weighted_mean.func(v, pd.Series([1.0, 1.0, 1.0])) == 3.0 and count_rows.func(v) == 2
    assert math.isnan(weighted_mean.func(v[1:2], pd.Series([1.0]))) and own_mean.func(v) == 3.0


def test_window_calls_go_over_all_partitions(spark):
    assert "REPARTITION_BY_NUM" in plan(run(spark, "win_pandas_agg"))


@pytest.mark.parametrize("hot", [3, 1000])
def test_mean_ranks_over_ranges(spark, hot_limit, hot):
    from dayledger.plans.features import mean_ranks

    values = [5.0, 1.0, 1.0, 2.0, 9.0, 9.0, 9.0, -3.0]
    with hot_limit(hot):
        got = mean_ranks(spark.createDataFrame([(v,) for v in values], "x double"), "x")
        want = pd.Series(values).rank()
        assert {r.x: r.rank_x for r in got.collect()} == dict(zip(values, want, strict=True))


def test_pairs_of_document_and_word_are_not_moved_to_be_counted(spark):
    assert "hashpartitioning(doc_id" in plan(run(spark, "ml_feature_tfidf")) and not [
        x for x in plan(run(spark, "ml_feature_tfidf")).splitlines() if "hashpartitioning(doc_id" in x and "word" in x.split("hashpartitioning")[1]
    ]


@pytest.mark.parametrize("most", [2, 500])
def test_rounds_of_small_buckets_are_done_at_once(spark, monkeypatch, most):
    """Leaders are the same whether a bucket goes on in rounds or in one call, and words are not repeated for each bucket."""
    from dayledger.operators import likeness

    monkeypatch.setattr(likeness, "BUCKET_ROWS", most)
    groups = [[f"g{g}w{k}" for k in range(10)] for g in range(6)]
    rows = [(i, [*groups[i % 6], f"own{i}"], [7, 8, 9]) for i in range(60)]
    written, write = [], likeness.materialize
    monkeypatch.setattr(likeness, "materialize", lambda df, name: (written.append(df.columns), write(df, name))[1])
    links = likeness.leader_links(spark.createDataFrame(rows, "id long, words array<string>, keys array<long>"), 60)
    assert {(r.id, r.leader) for r in links.collect()} == {(i, i % 6) for i in range(6, 60)}
    assert not any("words" in columns for columns in written)


def in_turn(rows, percent):
    """(id, leader): bucket by bucket, each row joins the first leader it is like, or leads."""
    links = set()
    for key in {k for _, _, keys in rows for k in keys}:
        leaders = []
        for i, words in sorted((i, set(words)) for i, words, keys in rows if key in keys):
            for j, other in leaders:
                if 100 * len(words & other) >= percent * len(words | other):
                    links.add((i, j))
                    break
            else:
                leaders.append((i, words))
    return links


@pytest.mark.parametrize("codes", [1 << 16, 5])
def test_a_bucket_of_unlike_rows_takes_few_rounds_and_moves_no_words(spark, monkeypatch, codes):
    """Rounds follow from the rows of a call, not from the leaders; a sketch of few codes lets through pairs that words then refuse."""
    from dayledger.operators import likeness

    rnd = np.random.default_rng(4)
    base = [[f"g{g}w{k}" for k in range(12)] for g in range(25)]
    rows = [(i, sorted({w for w in base[rnd.integers(25)] if rnd.random() > 0.2} | {f"own{i % 31}"}), [7, int(rnd.integers(3))]) for i in range(120)]
    monkeypatch.setattr(likeness, "BUCKET_ROWS", 20)
    if codes == 5:
        few = lambda c: likeness.F.array_distinct(likeness.F.transform(c, lambda w: likeness.F.pmod(likeness.F.xxhash64(w), likeness.F.lit(5)).cast("short")))
        monkeypatch.setattr(likeness, "sketch", few)
    written, write = [], likeness.materialize
    monkeypatch.setattr(likeness, "materialize", lambda df, name: (written.append((name, df.columns)), write(df, name))[1])
    links = likeness.leader_links(spark.createDataFrame(rows, "id long, words array<string>, keys array<long>"), 60)
    assert {(r.id, r.leader) for r in links.collect()} == in_turn(rows, 60)
    assert sum(name == "leader-rest" for name, _ in written) <= 6 and not any("words" in c or "sketch" in c for _, c in written)


def test_like_sets_send_words_once_to_a_cell(spark):
    """A word that all sets hold makes no row for each pair of them."""
    from dayledger.operators.likeness import like_sets, rarest_first

    sets = [(i, ["the", "of", *[f"w{i % 40}x{k}" for k in range(i % 3 + 1)]]) for i in range(400)]
    ordered = rarest_first(spark.createDataFrame(sets, "id long, words array<string>"), "id", "words")
    joined = like_sets(ordered.filter("id % 10 = 0"), ordered, 60)
    got = {(r.left_id, r.right_id) for r in joined.collect()}
    alike = lambda a, b: 100 * len(set(a) & set(b)) >= 60 * len(set(a) | set(b))
    assert got == {(i, j) for i, a in sets if i % 10 == 0 for j, b in sets if alike(a, b)}
    assert "Join" not in plan(joined)


@pytest.mark.parametrize("metric", ["distance", "product"])
def test_a_query_is_sent_to_cells_not_to_lists(metric):
    """Lists share cells of bounded size; a larger list is cut; the best rows do not depend on it."""
    from dayledger.operators.nearest import Lists, best_of, costs

    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.normal(size=(300, 4)), np.ones((200, 4))])
    lists = Lists.over(rows[rng.permutation(500)[:25]])
    where, far = lists.place(rows)
    lists.rows = np.bincount(where, minlength=25)
    lists.radius = np.array([far[where == j].max(initial=0) for j in range(25)])
    first, many, cells = lists.cells(50)
    assert cells <= 2 * 500 // 50 + 1 and many.max() >= 4 and (first + many).max() <= cells
    q = rng.normal(size=(20, 4))
    for p, ids, cost in best_of(q, [[0, 1]] * 20, np.arange(500), rows, where, lists, 7, metric):
        want = costs(q[p], rows, metric)
        want[:2] = np.inf
        assert list(ids) == list(np.lexsort((np.arange(500), want))[:7]) and list(cost) == list(want[ids])


def test_a_cheap_rule_does_not_make_the_others_long(monkeypatch):
    from dayledger.llm import quality

    asked = []

    def seconds(sample, copies, *counts):
        asked.append((copies, bool(counts) and "dear" in str(counts[0])))
        return (9.0 if asked[-1][1] else 1.0), [10, 1]

    monkeypatch.setattr(quality, "seconds", seconds)
    monkeypatch.setattr(quality.F, "count_if", lambda rule: rule)
    quality.ranked(None, {"cheap": "cheap", "dear": "dear"})
    assert {c for c, dear in asked if dear} == {4} and max(c for c, _ in asked) == 256


@pytest.mark.parametrize("name", ["ml_fm_regressor", "ml_fm_classifier"])
def test_points_of_a_fit_are_kept_once(spark, monkeypatch, name):
    """A frame that is kept as well is held twice, or read anew in each pass."""
    from dayledger.plans import models

    def refuse(est, df):
        raise AssertionError("kept by the query")

    monkeypatch.setattr(models, "fitted", refuse)
    assert all(r.good for r in run(spark, name).collect())


def test_words_of_texts_are_not_kept_beside_the_library_s_own(spark):
    from pyspark.ml.feature import Word2Vec

    from dayledger.plans.models import fitted

    class Once(Word2Vec):
        def fit(self, df, params=None):
            return df.storageLevel.useMemory

    class Passes:
        def fit(self, df):
            return df.storageLevel.useMemory

    assert [fitted(est, spark.range(3)) for est in (Once(), Passes())] == [False, True]


def test_ratings_are_made_once_and_queries_written_once(spark, monkeypatch):
    """Lines meet their orders in one plan, the library alone keeps ratings, and customers with their lists of parts are not written again."""
    from dayledger.operators import nearest
    from dayledger.plans import models

    written = []
    for module in (models, nearest):
        monkeypatch.setattr(module, "materialize", lambda df, name, write=module.materialize: (written.append((name, plan(df).count("l_orderkey"))), write(df, name))[1])
    monkeypatch.setattr(models, "fitted", lambda est, df: pytest.fail("kept by the query"))
    rows = run(spark, "ml_als").collect()
    assert rows and all(r.exact and r.unbought and r.good for r in rows)
    assert [name for name, orders in written if orders and name != "keys"] == ["ratings"] and "nearest-queries" not in [name for name, _ in written]


def test_blocks_follow_from_cores_and_memory(spark):
    from dayledger.operators.nearest import BLOCK_QUERIES, query_blocks
    from dayledger.plans.models import als_blocks

    assert [als_blocks(n, 12) for n in (0, 5_000_000, 36_000_000, 216_000_000)] == [2, 3, 12, 18]
    assert query_blocks(20 * BLOCK_QUERIES, 100, spark) == 20 and query_blocks(20 * BLOCK_QUERIES, 100, spark, 5) == 5


def test_lists_to_skip_by_position():
    import pyarrow as pa

    from dayledger.operators.nearest import Skips

    for kind in (pa.int32(), pa.int64()):
        lists = Skips(pa.chunked_array([pa.array([[9], [5, 6], None], pa.list_(kind)).slice(1), pa.array([[], [7]], pa.list_(kind))]))
        assert [list(lists[i]) for i in range(4)] == [[5, 6], [], [], [7]]


def test_a_classifier_keeps_its_two_columns_only(spark, monkeypatch):
    from dayledger.plans import models

    kept, fit = [], models.fitted
    monkeypatch.setattr(models, "parts_for", lambda df: 17)
    monkeypatch.setattr(models, "fitted", lambda est, df: (kept.append((df.columns, df.rdd.getNumPartitions())), fit(est, df))[1])
    assert all(r.good for r in run(spark, "ml_gbt_classifier").collect()) and kept == [(["features", "label"], 17)]


def test_vouchers_of_a_day_are_not_stored_ahead_of_their_merge(spark, monkeypatch):
    from dayledger.plans import pipeline

    stored, write = [], pipeline.materialize
    monkeypatch.setattr(pipeline, "materialize", lambda df, name: (stored.append(name), write(df, name))[1])
    assert len(run(spark, "run_business_day").collect()) == 3 and stored == ["users", "activity"]
