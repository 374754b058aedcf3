"""Split plans for hot keys give the result of the plain plans."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from support import SMALL, rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from dayledger.jobs import all_jobs
from dayledger.operators import hot, skew
from dayledger.operators.timed import asof_join, range_join, sessions
from dayledger.registry import runnable
from dayledger.session import HOT_ROWS_KEY

WINDOW_JOBS = [
    "win_rank", "win_distribution", "win_offset", "win_running_rows", "win_collect", "win_pandas_agg", "join_asof",
    "time_window_session", "udaf_pandas", "apply_in_pandas", "cogroup_in_pandas", "table_bucketed",
]


PYTHON_JOBS = ["win_pandas_agg", "udaf_pandas", "apply_in_pandas"]


@pytest.mark.parametrize("name", WINDOW_JOBS)
def test_job_is_the_same_with_hot_keys(spark, hot_limit, name):
    run = runnable(all_jobs()[name])
    plain = rows_of(run(spark, SMALL))
    # with 17 only the busiest keys are split, which keeps the Python jobs short
    with hot_limit(17 if name in PYTHON_JOBS else 6):
        assert rows_of(run(spark, SMALL)) == plain


def third_in_one_key(spark, n=600):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, 0 if i % 3 == 0 else rnd.randrange(1, 40), t0 + dt.timedelta(minutes=rnd.randrange(0, 20000)), float(i % 17))
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, ts timestamp, v double")


def test_hot_keys_are_found(spark, hot_limit):
    df = third_in_one_key(spark)
    assert hot.hot_keys(df, ["k"]) is None
    with hot_limit(100):
        assert rows_of(hot.hot_keys(df, ["k"])) == [(0,)]


def test_null_keys_stay_in_the_result(spark, hot_limit):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [(1, 100)], "k long, v long")
    with hot_limit(10):
        out = hot.split_hot(df, ["k"], lambda x: x.withColumn("p", F.lit("plain")), lambda x: x.withColumn("p", F.lit("hot")))
        assert {(r.p, r["count"]) for r in out.groupBy("p").count().collect()} == {("plain", 1), ("hot", 20)}


def test_number_rows(spark):
    df = third_in_one_key(spark)
    spark.conf.set(HOT_ROWS_KEY, "50")
    got = hot.number_rows(df, ["k"], ["ts", "id"])
    spark.conf.unset(HOT_ROWS_KEY)
    got = got.select("k", "id", "_rn", "_size").collect()
    want = {}
    for k in {r.k for r in got}:
        rows = sorted((r.ts, r.id) for r in df.filter(F.col("k") == k).collect())
        want.update({(k, i): (n + 1, len(rows)) for n, (_, i) in enumerate(rows)})
    assert {(r.k, r.id): (r._rn, r._size) for r in got} == want


@pytest.mark.parametrize("block_rows", [1, 2, 3, 100])
def test_frames_wider_than_a_block(spark, block_rows):
    """A frame may reach over several blocks."""
    rows = [(k, n + 1, float(7 * n % 11)) for k, many in ((1, 1), (2, 4), (None, 9)) for n in range(many)]
    df = spark.createDataFrame(rows, "k long, _rn long, v double")
    frame = lambda w: {"s": F.collect_list("v").over(w.rowsBetween(-5, 3))}
    want = df.withColumns(frame(Window.partitionBy("k").orderBy("_rn")))
    assert rows_of(hot.framed(df, ["k"], 5, 3, frame, block_rows)) == rows_of(want)


def test_own_mean_with_one_row_a_block(spark, hot_limit, tmp_path):
    days = [dt.datetime(2024, 1, 1 + i) for i in range(6)]
    rows = [(i, 1 + i % 2, days[i // 2], "F", float(i * i), "1") for i in range(12)]
    names = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string, o_totalprice double, o_orderpriority string"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "orders.parquet"))
    run = runnable(all_jobs()["win_pandas_agg"])
    plain = rows_of(run(spark, str(tmp_path)))
    with hot_limit(1):
        assert rows_of(run(spark, str(tmp_path))) == plain


def test_one_key_and_one_day_with_a_third_of_the_rows(spark, hot_limit):
    """Parts are even, also where calendar slices would hold all of it; keys up to 2^62."""
    rows = [(i, 1 << 62 if i % 3 == 0 else i, dt.datetime(2024, 1, 1, 8, 0, 0, i)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp")
    with hot_limit(100):
        ranged = hot.by_ranges(df, ["k"], ["ts", "id"])
        sizes = [r["count"] for r in ranged.groupBy(hot.SLICE).count().collect()]
        numbered = {r.id: (r._rn, r._size) for r in hot.number_rows(df, ["k"], ["ts", "id"]).collect()}
    assert sum(sizes) == 900 and max(sizes) <= 200
    assert numbered == {i: (i // 3 + 1, 300) if i % 3 == 0 else (1, 1) for i in range(900)}


def test_salted_forms(spark):
    df = third_in_one_key(spark)
    got = skew.salted_agg(df, ["k"], ["id"], {"n": F.count("*"), "s": F.sum("v")}, {"n": F.sum("n"), "s": F.sum("s")})
    assert rows_of(got) == rows_of(df.groupBy("k").agg(F.count("*"), F.sum("v")))
    side = spark.createDataFrame([(i, f"n{i}") for i in range(0, 40, 2)], "k long, name string")
    for how in ("inner", "left"):
        want = df.join(side, "k", how).select("k", "id", "name")
        for rows in (100_000, 50):
            assert rows_of(skew.salted_join(df, side, "k", ["id"], how, rows).select("k", "id", "name")) == rows_of(want)


def test_only_partners_of_hot_keys_are_repeated(spark):
    """A third of 900 rows has one key: its partner goes to a salt for each 50 rows, the other 39 partners stay single."""
    df = third_in_one_key(spark)
    side = spark.range(40).withColumnRenamed("id", "k")
    n = df.count()
    left, right = skew.salted_sides(df, side, "k", ["id"], 50)
    assert left.count() == n and right.count() <= side.count() + 2 * n // 50
    assert right.groupBy("k").count().filter("count > 1").count() == skew.hot_salts(df, "k", 50).count() < 10
    assert left.groupBy("k", "_salt").count().agg(F.max("count")).first()[0] < 120


def dates(spark, rows):
    return spark.createDataFrame(rows, "k long, d date, id long")


@pytest.mark.parametrize("limit", [10_000, 40, 7])
def test_ranks_carried_over_ranges(spark, hot_limit, limit):
    """One key with a third of the rows, a date that fills several ranges, null keys and null dates."""
    rnd = random.Random(limit)
    rows = []
    for i in range(300):
        k = 7 if i % 3 == 0 else rnd.choice([None, 1, 2, 3, 50])
        day = None if i % 29 == 0 else dt.date(2024, 1, 1) + dt.timedelta(days=0 if i % 2 else rnd.randrange(12))
        rows.append((k, day, i))
    df = dates(spark, rows)
    w = Window.partitionBy("k").orderBy("d")
    want = df.select(
        "id", F.row_number().over(Window.partitionBy("k").orderBy("d", "id")), F.rank().over(w), F.count("*").over(w.rangeBetween(Window.unboundedPreceding, 0)),
        F.dense_rank().over(w), F.count("*").over(Window.partitionBy("k")),
    )
    with hot_limit(limit):
        got = hot.ranked(df, "k", "d", ["id"]).select("id", "_rn", "_first", "_last", "_dense", "_size")
        assert rows_of(got) == rows_of(want)


def test_bands_of_very_different_widths(spark):
    """A band a million times as wide as another adds few rows, and every pair is found once."""
    from dayledger.operators.timed import band_join

    rnd = random.Random(3)
    bands = [(i, lo, lo + 10.0 ** rnd.randint(-3, 6)) for i in range(60) for lo in [rnd.uniform(-1000, 1000)]] + [(90, 5.0, 5.0), (91, 9.0, 3.0), (92, None, 1.0), (93, 0.0, 1e6)]
    points = [(i, rnd.uniform(-1500, 1500)) for i in range(300)] + [(900, None), (901, 0.0), (902, -0.0)]
    b = spark.createDataFrame(bands, "band long, lo double, hi double")
    p = spark.createDataFrame(points, "point long, x double")
    joined = band_join(p, F.col("x"), b, F.col("lo"), F.col("hi"))
    want = [(i, j) for i, x in points for j, lo, hi in bands if x is not None and lo is not None and lo <= x < hi]
    assert sorted((r.point, r.band) for r in joined.select("point", "band").collect()) == sorted(want)
    assert "NestedLoop" not in joined._jdf.queryExecution().toString() and "Cartesian" not in joined._jdf.queryExecution().toString()
    narrow = spark.createDataFrame([(i, float(i), i + 1.0) for i in range(50)], "band long, lo double, hi double")
    wide = narrow.unionByName(spark.createDataFrame([(99, 0.0, 1e6)], narrow.schema))
    cells = lambda f: f.withColumn("n", F.size(F.array_distinct(F.array(F.floor(F.col("lo") / F.pow(F.lit(2.0), F.ceil(F.log2(F.col("hi") - F.col("lo"))))), F.floor(F.col("hi") / F.pow(F.lit(2.0), F.ceil(F.log2(F.col("hi") - F.col("lo"))))))))).agg(F.sum("n")).first()[0]
    assert cells(wide) - cells(narrow) <= 2


@pytest.mark.parametrize("range_rows", [10, 100_000])
def test_quantiles_by_selection(spark, monkeypatch, range_rows):
    """Ranges are cut several times; one value fills a third of the rows; groups of one row, null groups and null values."""
    import numpy as np

    from dayledger.operators import selection

    monkeypatch.setattr(selection, "BOUNDS", 5)
    rnd = random.Random(6)
    rows = [(i, rnd.choice(["a", "b", None]), 4.25 if i % 3 == 0 else rnd.choice([rnd.gauss(0, 100), float(rnd.randint(-5, 5)), None])) for i in range(900)]
    rows += [(1000, "one", -7.5), (1001, "none", None)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["of"], r["share"]): r["value"] for r in selection.quantiles(df, "g", F.col("x"), F.col("id"), shares, range_rows).collect()}
    want = {}
    for g in ("a", "b", None, "one"):
        values = [x for _, h, x in rows if h == g and x is not None]
        want |= {(g, s): pytest.approx(float(np.quantile(values, s))) for s in shares}
    assert got == want


@pytest.mark.parametrize("limit", [10_000, 50])
def test_asof_against_brute_force(spark, hot_limit, limit):
    df = third_in_one_key(spark)
    left = df.filter("id % 2 = 0").select("id", "k", "ts")
    right = df.filter("id % 2 = 1").select("id", "k", "ts", F.col("id").alias("hit"))
    with hot_limit(limit):
        got = {r.id: r.hit for r in asof_join(left, right, "k", "ts", "hit", ["id"]).collect()}
    rights = right.collect()
    for r in left.collect():
        before = [(x.ts, x.id) for x in rights if x.k == r.k and x.ts <= r.ts]
        assert got[r.id] == (max(before)[1] if before else None)
    assert len(got) == left.count()


@pytest.mark.parametrize("limit", [10_000, 50])
def test_sessions_against_brute_force(spark, hot_limit, limit):
    df = third_in_one_key(spark)
    with hot_limit(limit):
        out = sessions(df, "k", "ts", 7200, {"n": (F.count("*"), "sum"), "top": (F.max("v"), "max")})
        got = sorted(map(tuple, out.collect()))
    want = []
    for k in range(40):
        rows = sorted((r.ts, r.v) for r in df.filter(F.col("k") == k).collect())
        for ts, v in rows:
            if want and want[-1][0] == k and ts < want[-1][2] + dt.timedelta(seconds=7200):
                k0, a, _, n, top = want[-1]
                want[-1] = (k0, a, ts, n + 1, max(top, v))
            else:
                want.append((k, ts, ts, 1, v))
    assert got == sorted(want)


def test_range_join_against_brute_force(spark):
    df = third_in_one_key(spark, 200)
    spans = spark.createDataFrame(
        [(i, dt.datetime(2023, 12, 28) + dt.timedelta(days=2 * i), dt.datetime(2024, 1, 1) + dt.timedelta(days=3 * i)) for i in range(8)],
        "span long, a timestamp, b timestamp",
    )
    got = sorted((r.id, r.span) for r in range_join(df, "ts", spans, "a", "b").collect())
    all_spans = spans.collect()
    want = sorted((p.id, s.span) for p in df.collect() for s in all_spans if s.a <= p.ts < s.b)
    assert got == want


def test_rows_at_group_max_and_latest(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 2, 2), (1, 3, 1), (None, 4, 5), (2, 5, None)], "k long, id long, v long")
    assert rows_of(skew.rows_at_group_max(df, ["k"], "v")) == rows_of(df.filter("id IN (1, 2, 4)"))
    assert rows_of(skew.latest_per_key(df, ["k"], ["v", "id"])) == rows_of(df.filter("id IN (2, 4, 5)"))
