"""Orders, plans and small edge cases of relational jobs."""

from __future__ import annotations

import pytest
from support import SMALL

from dayledger.jobs import all_jobs
from dayledger.plans.rows import gapless_index
from dayledger.session import small_side


def build(spark, name):
    return all_jobs()[name].build(spark, SMALL)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_sort_orders(spark):
    rows = build(spark, "sort_multi").collect()
    assert rows == sorted(rows, key=lambda r: (r.o_orderstatus, -r.o_totalprice, r.o_orderkey))
    rows = build(spark, "sort_nulls").collect()
    for place, down, null_first in (("asc_first", 1, True), ("asc_last", 1, False), ("desc_first", -1, True), ("desc_last", -1, False)):
        part = sorted((r for r in rows if r.place == place), key=lambda r: r.at)
        key = lambda r: ((r.top_price is None) != null_first, down * (r.top_price or 0), r.c_custkey)  # noqa: B023, E731
        assert [r.at for r in part] == [*range(1, len(rows) // 4 + 1)] and part == sorted(part, key=key)


def test_gapless_index(spark):
    df = spark.range(5, 5000, 7).toDF("k").repartition(5)
    rows = sorted((r.k, r.i) for r in gapless_index(df, "k", "i").collect())
    assert [i for _, i in rows] == list(range(len(rows)))


def test_small_side_is_counted(spark):
    assert "broadcast" in plan(small_side(spark.range(10), 10)).lower()
    assert "broadcast" not in plan(small_side(spark.range(11), 10)).lower()


def test_hints_reach_the_plan(spark):
    text = plan(build(spark, "join_hints"))
    assert "SortMergeJoin" in text and "ShuffledHashJoin" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(build(spark, "filter_set_range"))
    pushed = text.split("PushedFilters: [")[1]
    assert "In(p_brand" in pushed and "GreaterThanOrEqual(p_size,5)" in pushed
    assert "p_retailprice" not in text.split("== Physical Plan ==")[1]


def test_topk_uses_the_group_limit(spark):
    assert "WindowGroupLimit" in plan(build(spark, "win_topk_group"))


def test_range_join_has_an_equi_key(spark):
    text = plan(build(spark, "join_range")).split("== Physical Plan ==")[1]
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(build(spark, "table_bucketed")).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "hashpartitioning(c_custkey" not in text.split("SortMergeJoin")[1]


def test_quality_rule_fails_the_job(spark):
    from pyspark.sql import functions as F

    bad = spark.range(3).filter(F.assert_true(F.col("id") < 2, F.lit("bad line")).isNull())
    with pytest.raises(Exception, match="bad line"):
        bad.collect()


def test_samples_are_repeatable(spark):
    a, b = (sorted(map(tuple, build(spark, "sample_rows").collect())) for _ in range(2))
    assert a == b
    assert sum(r[2] for r in a) == spark.read.parquet(f"{SMALL}/events.parquet").count()
