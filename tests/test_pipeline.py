"""Ledger rules on small literal days."""

from __future__ import annotations

import datetime as dt

import pytest
from support import rows_of
from pyspark.sql import functions as F

from dayledger.functions.vouchers import voucher_state
from dayledger.operators import profiles as P
from dayledger.operators.upsert import NEW, PART, KeyedTable, document_id, target_rows
from dayledger.plans.pipeline import VOUCHER_SCHEMA, day_stores, run_day
from dayledger.session import scratch
from dayledger.sources import lake as L

TXN = "transId string, transStatus int, userId long, transactionTime timestamp, appId int, transType int, amount long, pmcId int"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def txn(spark, rows):
    return spark.createDataFrame([(i, s, u, at(t), a, k, m, p) for i, s, u, t, a, k, m, p in rows], TXN)


DAY1 = [
    ("a", 1, 1, "2022-03-03 09:00:00", 10, 3, 100, 1),
    ("b", 1, 1, "2022-03-03 11:00:00", 12, 2, 100, 2),
    ("c", 1, 1, "2022-03-03 10:00:00", 11, 3, 100, 3),
    ("d", 0, 2, "2022-03-03 10:00:00", 11, 3, 100, 3),
    ("e", 1, 3, "2022-03-03 10:00:00", 11, 1, 100, 3),
]


def test_activity_profile(spark):
    got = {r.userId: r for r in P.activity_profile(P.successful(txn(spark, DAY1))).collect()}
    assert set(got) == {1, 3}
    one, day = got[1], dt.date(2022, 3, 3)
    assert (one.firstPaymentDate, one.lastPaymentDate) == (day, day)
    assert one.appIds == [10, 11, 12] and one.payPmcIds == [1, 3]
    assert one.lastActiveTransactionType == 2 and one.lastPayAppId == 11
    three = got[3]
    assert three.firstPaymentDate is None and three.lastPayAppId is None and three.payPmcIds is None


def test_activity_merge_keeps_null_sets_and_takes_the_later_side(spark):
    old = P.activity_profile(txn(spark, DAY1))
    new = P.activity_profile(txn(spark, [("x", 1, 1, "2022-03-04 01:00:00", 20, 1, 5, 9), ("y", 1, 3, "2022-03-04 01:00:00", 21, 2, 5, 9)]))
    got = {r.userId: r for r in P.activity_merge(old, new).collect()}
    assert got[1].lastActiveTransactionType == 1 and got[1].lastPayAppId == 11
    assert got[1].appIds == [10, 11, 12, 20] and got[1].payPmcIds == [1, 3]
    assert got[3].payPmcIds is None and got[3].lastActiveTransactionType == 2
    assert got[1].modifiedDate == dt.date(2022, 3, 4)


def test_late_guard(spark):
    stored = P.activity_profile(txn(spark, DAY1))
    batch = P.activity_profile(txn(spark, DAY1))
    assert P.late_guard(batch, stored, F.lit("2022-03-02").cast("date")).count() == 0
    assert P.late_guard(batch, stored, F.lit("2022-03-03").cast("date")).count() == 3


def test_demographic_latest_has_one_row_per_user_on_ties(spark):
    rows = [(1, dt.date(2000, 1, 1), 1, 1, at("2022-03-03 01:00:00")), (1, dt.date(2000, 1, 1), 22, 2, at("2022-03-03 01:00:00")),
            (2, None, None, None, None)]
    got = rows_of(P.demographic_latest(spark.createDataFrame(rows, P.DEMOGRAPHIC_SCHEMA)))
    assert got == [(1, dt.date(2000, 1, 1), 22, 2, at("2022-03-03 01:00:00")), (2, None, None, None, None)]


@pytest.mark.parametrize(
    "kind, used, days, end, state",
    [
        (1, "2022-01-01", 0, "2022-02-01", "expired"),
        (1, "2022-01-01", 0, "2022-04-01", "not_expire"),
        (2, "2022-01-01", 30, "2022-04-01", "expired"),
        (2, "2022-02-20", 30, "2022-04-01", "not_expire"),
        (2, "2022-02-20", 90, "2022-02-28", "expired"),
        (1, "2022-01-01", 0, None, None),
        (2, None, 30, "2022-04-01", None),
        (None, "2022-01-01", 30, "2022-04-01", None),
        (3, "2022-01-01", 30, "2022-04-01", None),
    ],
)
def test_voucher_rule(spark, kind, used, days, end, state):
    day = lambda t: F.lit(t).cast("timestamp")
    rule = voucher_state(F.lit(kind).cast("int"), day(used), F.lit(days), day(end), day("2022-03-01"))
    assert spark.range(1).select(rule).first()[0] == state


PROMO = "userid long, voucherCode string, status string, campaignID long, time timestamp"


def promo(spark, rows):
    return spark.createDataFrame([(u, v, s, c, at(t)) for u, v, s, c, t in rows], PROMO)


def test_final_status_keeps_ties_and_drops_null_status(spark):
    p = promo(spark, [(1, "v", "GIVEN", 7, "2022-01-01"), (1, "v", "USED", 7, "2022-01-02"), (1, "v", "USED", 7, "2022-01-03"),
                      (2, "w", "GIVEN", 7, "2022-01-01"), (None, "n", "GIVEN", None, "2022-01-01"), (3, "x", None, 7, "2022-01-01")])
    got = P.final_status(p).groupBy("userid", "status").count().collect()
    assert {(r.userid, r.status, r["count"]) for r in got} == {(1, "USED", 2), (2, "GIVEN", 1), (None, "GIVEN", 1)}


def test_voucher_merge_has_one_row_per_key_and_a_fresh_state(spark):
    cfg = spark.createDataFrame([(7, 2, at("2023-01-01"), 30 * 86400)], "campaignID long, campaignType int, expireDate timestamp, expireTime long")
    early, late = F.lit("2022-01-05").cast("timestamp"), F.lit("2022-06-01").cast("timestamp")
    old = P.vouchers(promo(spark, [(1, "v", "GIVEN", 7, "2022-01-01"), (2, "w", "GIVEN", 7, "2022-01-01")]), cfg, early)
    assert {r.check_voucher for r in old.collect()} == {"not_expire"}
    new = P.vouchers(promo(spark, [(1, "v", "USED", 7, "2022-01-02")]), cfg, late)
    got = {r._id: (r.status, r.check_voucher) for r in P.voucher_merge(old, new, late).collect()}
    assert got == {"1~v~7": ("USED", "expired"), "2~w~7": ("GIVEN", "expired")}


def test_document_id_does_not_collide(spark):
    df = spark.createDataFrame([(1, "11", 1), (11, "1", 1)], "a long, b string, c long")
    assert df.select(document_id("a", "b", "c")).distinct().count() == 2


def test_keyed_table(spark):
    t = KeyedTable.temporary(spark, "t", ["k"], "k long, v string")
    assert t.read().count() == 0
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b")], t.schema))
    t.upsert(spark.createDataFrame([(2, "c"), (3, "d")], t.schema))
    assert rows_of(t.read()) == [(1, "a"), (2, "c"), (3, "d")]
    t.upsert(spark.createDataFrame([(4, "e")], t.schema))
    assert t.read().count() == 4 and KeyedTable(spark, t.path, ["k"], t.schema).read().count() == 4
    keys = spark.createDataFrame([(1,), (1,), (7,)], "k long")
    assert rows_of(target_rows(t.read(), keys, ["k"])) == [(1, "a")]


def test_an_upsert_leaves_other_partitions_alone(spark):
    t = KeyedTable.temporary(spark, "partitions", ["k"], "k long, v string", parts=10)
    t.replace(spark.range(100).selectExpr("id AS k", "'old' AS v"))
    files = lambda: {r[0] for r in spark.read.parquet(t.path).select(F.input_file_name()).distinct().collect()}
    before = files()
    assert len(before) > 5
    t.upsert(spark.createDataFrame([(17, "new")], t.schema))
    gone, new = before - files(), files() - before
    assert len(gone) == 1 and len(new) == 1 and next(iter(gone)).rsplit("/", 1)[0] == next(iter(new)).rsplit("/", 1)[0]
    assert rows_of(t.read()) == sorted([(k, "new" if k == 17 else "old") for k in range(100)], key=repr)
    assert rows_of(t.rows_for(spark.createDataFrame([(17,), (500,)], "k long"))) == [(17, "new")]
    # a batch made from the table's own rows, and one that is run twice
    t.upsert(t.read().filter("k < 50").withColumn("v", F.lit("again")))
    for _ in range(2):
        t.upsert_latest(spark.createDataFrame([(200, "x")], t.schema), ["v"])
    assert t.read().groupBy("v").count().filter("v = 'again'").first()[1] == 50 and t.read().count() == 101
    t.replace(spark.createDataFrame([(5, "only")], t.schema))
    assert rows_of(t.read()) == [(5, "only")]


def test_voucher_rows_meet_stored_ones_in_one_shuffle(spark, monkeypatch):
    cfg = spark.createDataFrame([(7, 2, at("2023-01-01"), 30 * 86400)], "campaignID long, campaignType int, expireDate timestamp, expireTime long")
    early, late = F.lit("2022-01-05").cast("timestamp"), F.lit("2022-06-01").cast("timestamp")
    old = [(1, "v", "GIVEN", 7, "2022-01-01"), (2, "w", "GIVEN", 7, "2022-01-01"), (3, "x", "USED", 7, "2022-01-01"), (4, None, "GIVEN", 8, "2022-01-01")]
    new = [(1, "v", "USED", 7, "2022-01-02"), (1, "v", "USED", 7, "2022-01-01"), (3, "x", None, 7, "2022-01-03"), (5, "y", "GIVEN", 9, "2022-01-01"), (6, "z", None, 7, "2022-01-01")]
    store, plain = (KeyedTable.temporary(spark, n, ["_id"], VOUCHER_SCHEMA, parts=3) for n in ("one", "two"))
    plans, overwrite = [], KeyedTable._overwrite
    monkeypatch.setattr(KeyedTable, "_overwrite", lambda t, df, mode: (plans.append(df._jdf.queryExecution().executedPlan().toString()), overwrite(t, df, mode)))
    for rows, now in ((old, early), (new, late)):
        batch = P.voucher_rows(promo(spark, rows), cfg.hint("broadcast"), now).withColumn("_id", document_id(*P.VOUCHER_KEY))
        store.merge(batch, lambda both, now=now: P.voucher_ledger(both, now))
        # the first load is one plan; later the rows lie aside by partition and are copied
        assert plans.pop().count("Exchange hashpartitioning") == (rows is old)
        plain.upsert(P.voucher_merge(plain.rows_for(batch).drop("_id"), batch.drop("_id"), now))
        assert rows_of(store.read()) == rows_of(plain.read())
    # the voucher that no row of the second batch names stays as stored, one whose new row has no status gets a fresh state
    assert {r._id: r.check_voucher for r in store.read().collect()} == {"1~v~7": "expired", "2~w~7": "not_expire", "3~x~7": "expired", "4~8": None, "5~y~9": None}


def test_a_merge_takes_stored_rows_of_touched_partitions_only(spark):
    t = KeyedTable.temporary(spark, "merged", ["k"], "k long, v long", parts=10)
    t.replace(spark.range(100).selectExpr("id AS k", "id AS v"))
    seen = []

    def largest(both):
        seen.append(both.filter(~F.col(NEW)).count())
        return both.groupBy(PART, "k").agg(F.max("v").alias("v"))

    t.merge(spark.createDataFrame([(17, 500), (17, 3), (18, 1)], "k long, v long"), largest)
    assert 2 <= seen[0] < 100 and rows_of(t.read()) == sorted([(k, 500 if k == 17 else k) for k in range(100)], key=repr)


HEAD = "transId\ttransStatus\tuserId\ttransactionTime\tappId\ttransType\tamount\tpmcId"


def write_text(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_malformed_rows_are_kept_apart(spark):
    path = scratch(spark, "bad")
    good = "t1\t1\t5\t2022-03-03 17:09:44.685\t70\t3\t160\t1"
    bad = "t2    1\t702 2022-03-03 00:53:27.907\t2\t2\t351437\t1"
    write_text(spark, path, [HEAD, good, bad])
    ok, rejected = L.split_malformed(L.read_tsv(spark, path, L.TRANSACTIONS).cache())
    assert ok.count() == 1 and rejected.count() == 1
    assert rejected.first()[L.CORRUPT] == bad


def test_rejected_rows_of_day_and_configuration(spark):
    src, lake = scratch(spark, "src"), scratch(spark, "lake")
    write_text(spark, f"{src}/configs", ["campaignID\tcampaignType\texpireDate\texpireTime", "7\t2\t2022-06-01 00:00:00\t2592000", "8\tx\ty\tz"])
    L.ingest_config(spark, src, lake)
    assert [r.campaignID for r in L.lake_config(spark, lake).collect()] == [7]
    assert [r[L.CORRUPT] for r in L.rejected(spark, lake, "configs").collect()] == ["8\tx\ty\tz"]
    write_text(spark, f"{src}/t", [HEAD, "t1\t1\t5\t2022-03-03 17:09:44.685\t70\t3\t160\t1"])
    L.ingest(spark, f"{src}/t", lake, "transactions", "2022-03-03", L.TRANSACTIONS)
    assert L.lake_table(spark, lake, "transactions").first().date == "2022-03-03"
    assert L.rejected(spark, lake, "transactions", "2022-03-03").count() == 0


def make_day(spark, src, day, transactions, users, promotions):
    write_text(spark, f"{src}/transactions/{day}", [HEAD, *transactions])
    write_text(spark, f"{src}/users/{day}", ["userid\tbirthdate\tprofileLevel\tgender\tupdatedTime", *users])
    write_text(spark, f"{src}/promotions/{day}", ["userid\tvoucherCode\tstatus\tcampaignID\ttime", *promotions])


def test_business_days_run_again_without_change(spark):
    src, lake = scratch(spark, "src"), scratch(spark, "lake")
    write_text(spark, f"{src}/configs", ["campaignID\tcampaignType\texpireDate\texpireTime", "7\t2\t2022-06-01 00:00:00\t2592000"])
    make_day(spark, src, "2022-03-03", ["t1\t1\t5\t2022-03-03 17:09:44.685\t70\t3\t160\t1"],
             ["5\t2006-7-07\t3\t2\t2022-03-03 23:33:10.859"], ["5\tv\tGIVEN\t7\t2022-03-01 00:00:00.000"])
    make_day(spark, src, "2022-03-04", ["t2\t1\t5\t2022-03-04 08:00:00.000\t71\t2\t160\t2"],
             ["5\t2006-7-07\t22\t2\t2022-03-04 23:33:10.859"], ["5\tv\tUSED\t7\t2022-03-01 00:00:00.000"])
    stores, now = day_stores(spark), F.lit("2022-03-10").cast("timestamp")
    for day in ("2022-03-03", "2022-03-04"):
        run_day(spark, src, lake, stores, day, now)
    first = {k: rows_of(s.read()) for k, s in stores.items()}
    run_day(spark, src, lake, stores, "2022-03-04", now)
    assert {k: rows_of(s.read()) for k, s in stores.items()} == first
    # an earlier day run again late does not turn the newer ledger back
    run_day(spark, src, lake, stores, "2022-03-03", now)
    assert {k: rows_of(s.read()) for k, s in stores.items()} == first
    a = stores["activity"].read().first()
    assert a.appIds == [70, 71] and a.lastActiveTransactionType == 2 and a.lastPayAppId == 70
    assert stores["demographic"].read().first().profileLevel == 22
    v = stores["voucher"].read().first()
    assert (v.status, v.check_voucher) == ("USED", "not_expire")
