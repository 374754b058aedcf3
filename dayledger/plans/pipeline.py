"""Daily pipeline: lake ingest, the three ledgers and the business day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators import profiles as P
from dayledger.operators.upsert import KeyedTable, document_id, target_rows
from dayledger.registry import query
from dayledger.session import materialize, scratch, table
from dayledger.sources import inputs as I
from dayledger.sources import lake as L

DAY = "2024-01-16"


def as_of():
    return F.lit(I.AS_OF).cast("timestamp")


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions in the form of the daily files, from orders."""
    return I.orders(spark, folder).select(
        F.col("o_orderkey").cast("string").alias("transId"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("transStatus"),
        F.col("o_custkey").alias("userId"),
        F.col("o_orderdate").alias("transactionTime"),
        (F.col("o_orderkey") % 13 + 1).cast("int").alias("appId"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("transType"),
        F.col("o_totalprice").cast("long").alias("amount"),
        (F.col("o_orderkey") % 20).cast("int").alias("pmcId"),
    )


@query(
    "lake_ingest_day",
    f"""
WITH {I.PROMOTIONS_SQL}, {I.USERS_SQL}
SELECT 'transactions' AS table_name, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       CAST(max(o_orderdate) AS VARCHAR) AS last_time FROM orders
UNION ALL SELECT 'promotions', count(*), CAST(sum(campaignID) AS BIGINT), CAST(max(time) AS VARCHAR) FROM promotions
UNION ALL SELECT 'users', count(*), CAST(sum(userid) AS BIGINT),
       strftime(max(updated_time), '%Y-%m-%d %H:%M:%S') FROM users
""",
)
def lake_ingest_day(spark: SparkSession, d: str) -> DataFrame:
    src, lake = scratch(spark, "tsv"), scratch(spark, "lake")
    L.write_tsv(I.promotions(spark, d), f"{src}/promotions/{DAY}")
    L.write_tsv(order_transactions(spark, d), f"{src}/transactions/{DAY}")
    L.write_tsv(I.users(spark, d), f"{src}/users/{DAY}")
    L.ingest_day(spark, src, lake, DAY)

    def summary(name: str, key: str, time: str) -> DataFrame:
        return L.lake_table(spark, lake, name, DAY).agg(
            F.count("*").alias("n"), F.sum(F.col(key).cast("long")).alias("key_sum"),
            F.max(F.to_timestamp(time)).alias("last_time"),
        ).select(F.lit(name).alias("table_name"), "*")

    return (
        summary("transactions", "transId", "transactionTime")
        .unionByName(summary("promotions", "campaignID", "time"))
        .unionByName(summary("users", "userid", "updatedTime"))
    )


@query(
    "lake_ingest_config",
    f"WITH {I.CAMPAIGNS_SQL} SELECT true AS accepted, campaignID, CAST(campaignType AS BIGINT) AS campaignType, "
    "CAST(expireDate AS VARCHAR) AS expireDate, expireTime FROM config "
    "UNION ALL SELECT false, campaignID, NULL, NULL, NULL FROM config WHERE campaignID % 7 = 3",
)
def lake_ingest_config(spark: SparkSession, d: str) -> DataFrame:
    """Some campaigns come a second time with a broken date: those rows are kept apart, none is lost."""
    src, lake = scratch(spark, "tsv"), scratch(spark, "lake")
    campaigns = I.campaigns(spark, d)
    L.write_tsv(campaigns, f"{src}/configs")
    broken = campaigns.filter("campaignID % 7 = 3").select("campaignID", "campaignType", F.lit("soon").alias("expireDate"), "expireTime")
    broken.write.mode("append").csv(f"{src}/configs", sep="\t", header=True)
    L.ingest_config(spark, src, lake)
    good = L.lake_config(spark, lake).select(F.lit(True).alias("accepted"), "*")
    bad = L.rejected(spark, lake, "configs").select(
        F.lit(False), F.substring_index(L.CORRUPT, "\t", 1).cast("long"), *[F.lit(None).cast(good.schema[c].dataType) for c in good.columns[2:]]
    )
    return good.unionAll(bad)


@query(
    "lake_quarantine_malformed",
    """
SELECT CASE WHEN event_id % 97 = 5 THEN 'rejected' ELSE 'accepted' END AS kind,
       count(*) AS n FROM events GROUP BY 1
""",
)
def lake_quarantine_malformed(spark: SparkSession, d: str) -> DataFrame:
    """Some rows lose their tabs before the first value, as in the daily files seen."""
    src, lake = scratch(spark, "tsv"), scratch(spark, "lake")
    sep = F.when(F.col("event_id") % 97 == 5, F.lit("    ")).otherwise(F.lit("\t"))
    I.events(spark, d).select(
        F.concat(
            F.col("event_id"), sep, F.col("user_id"), F.lit("\t"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("\t"), F.col("value"),
        ).alias("value")
    ).write.text(src)
    raw = spark.read.schema(f"event_id long, user_id long, ts timestamp, value double, {L.CORRUPT} string").csv(
        src, sep="\t", columnNameOfCorruptRecord=L.CORRUPT
    )
    good, bad = L.split_malformed(raw)
    good.write.parquet(f"{lake}/events")
    bad.write.parquet(f"{lake}/events_rejected")
    return (
        spark.read.parquet(f"{lake}/events").select(F.lit("accepted").alias("kind"))
        .unionAll(spark.read.parquet(f"{lake}/events_rejected").select(F.lit("rejected")))
        .groupBy("kind").agg(F.count("*").alias("n"))
    )


@query(
    "txn_success_filter",
    """
SELECT o_custkey AS userId, CAST(o_orderdate AS VARCHAR) AS transactionTime, o_orderkey % 13 + 1 AS appId,
       CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS transType, CAST(o_orderkey % 20 AS BIGINT) AS pmcId,
       CAST(o_orderkey AS VARCHAR) AS transId
FROM orders WHERE o_orderstatus = 'F'
""",
)
def txn_success_filter(spark: SparkSession, d: str) -> DataFrame:
    return P.successful(order_transactions(spark, d)).drop("amount")


@query(
    "activity_payment_dates",
    f"""
WITH {I.EVENT_TXN_SQL}
SELECT userId, CAST(min(CASE WHEN transType = 3 THEN CAST(transactionTime AS DATE) END) AS VARCHAR) AS firstPaymentDate,
       CAST(max(CASE WHEN transType = 3 THEN CAST(transactionTime AS DATE) END) AS VARCHAR) AS lastPaymentDate
FROM txn GROUP BY userId
""",
)
def activity_payment_dates(spark: SparkSession, d: str) -> DataFrame:
    return P.activity_profile(I.event_transactions(spark, d)).select("userId", "firstPaymentDate", "lastPaymentDate")


@query(
    "activity_active_dates",
    """
SELECT user_id AS userId, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS firstActiveDate,
       CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS lastActiveDate, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS modifiedDate
FROM events WHERE event_type <> 'error' GROUP BY user_id
""",
)
def activity_active_dates(spark: SparkSession, d: str) -> DataFrame:
    txn = P.successful(I.event_transactions(spark, d))
    return P.activity_profile(txn).select("userId", "firstActiveDate", "lastActiveDate", "modifiedDate")


@query(
    "activity_last_txn_type",
    f"WITH {I.EVENT_TXN_SQL} SELECT userId, "
    "CAST(last(transType ORDER BY transactionTime, transId) AS BIGINT) AS lastActiveTransactionType "
    "FROM txn GROUP BY userId",
)
def activity_last_txn_type(spark: SparkSession, d: str) -> DataFrame:
    return P.activity_profile(I.event_transactions(spark, d)).select("userId", "lastActiveTransactionType")


@query(
    "activity_last_pay_app",
    """
SELECT o_custkey AS userId, last(o_orderkey % 13 + 1 ORDER BY o_orderdate, o_orderkey) AS lastPayAppId
FROM orders WHERE o_orderstatus = 'F' AND substr(o_orderpriority, 1, 1) = '3' GROUP BY o_custkey
""",
)
def activity_last_pay_app(spark: SparkSession, d: str) -> DataFrame:
    paid = P.successful(order_transactions(spark, d)).filter(F.col("transType") == P.PAYMENT)
    moment = F.struct("transactionTime", F.col("transId").cast("long"))
    return paid.groupBy("userId").agg(F.max_by("appId", moment).alias("lastPayAppId"))


def _line_apps(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as transactions of the order: line number is the type, 3 a payment."""
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("userId"),
        F.col("l_linenumber").alias("transType"),
        (F.col("l_suppkey") % 13 + 1).cast("int").alias("appId"),
        (F.col("l_partkey") % 20).cast("int").alias("pmcId"),
    )


@query(
    "activity_app_set",
    "SELECT l_orderkey AS userId, array_to_string(list_sort(list(DISTINCT l_suppkey % 13 + 1)), ',') AS appIds "
    "FROM lineitem GROUP BY 1",
)
def activity_app_set(spark: SparkSession, d: str) -> DataFrame:
    return _line_apps(spark, d).groupBy("userId").agg(F.array_sort(F.collect_set("appId")).alias("appIds"))


@query(
    "activity_payment_campaign_set",
    "SELECT l_orderkey AS userId, array_to_string(list_sort(list(DISTINCT l_partkey % 20) "
    "FILTER (WHERE l_linenumber = 3)), ',') AS payPmcIds FROM lineitem GROUP BY 1",
)
def activity_payment_campaign_set(spark: SparkSession, d: str) -> DataFrame:
    paid = F.when(F.col("transType") == P.PAYMENT, F.col("pmcId"))
    return _line_apps(spark, d).groupBy("userId").agg(
        P.none_if_empty(F.array_sort(F.collect_set(paid))).alias("payPmcIds")
    )


def profile_sql(source: str) -> str:
    return f"""
  SELECT userId, min(CASE WHEN transType = 3 THEN CAST(transactionTime AS DATE) END) AS firstPaymentDate,
         max(CASE WHEN transType = 3 THEN CAST(transactionTime AS DATE) END) AS lastPaymentDate,
         min(CAST(transactionTime AS DATE)) AS firstActiveDate, max(CAST(transactionTime AS DATE)) AS lastActiveDate,
         list_sort(list(DISTINCT appId)) AS appIds,
         last(transType ORDER BY transactionTime, transId) AS lastActiveTransactionType,
         last(appId ORDER BY transactionTime, transId) FILTER (WHERE transType = 3) AS lastPayAppId,
         list_sort(list(DISTINCT pmcId) FILTER (WHERE transType = 3)) AS payPmcIds,
         max(CAST(transactionTime AS DATE)) AS modifiedDate
  FROM {source} GROUP BY userId"""


PROFILE_OUT = """
userId, CAST(firstPaymentDate AS VARCHAR) AS firstPaymentDate, CAST(lastPaymentDate AS VARCHAR) AS lastPaymentDate,
CAST(firstActiveDate AS VARCHAR) AS firstActiveDate, CAST(lastActiveDate AS VARCHAR) AS lastActiveDate,
array_to_string(appIds, ',') AS appIds, CAST(lastActiveTransactionType AS BIGINT) AS lastActiveTransactionType,
CAST(lastPayAppId AS BIGINT) AS lastPayAppId, array_to_string(payPmcIds, ',') AS payPmcIds,
CAST(modifiedDate AS VARCHAR) AS modifiedDate"""


@query(
    "activity_profile_day",
    f"WITH {I.EVENT_TXN_SQL}, profile AS ({profile_sql('txn WHERE transStatus = 1')}) SELECT {PROFILE_OUT} FROM profile",
)
def activity_profile_day(spark: SparkSession, d: str) -> DataFrame:
    return P.activity_profile(P.successful(I.event_transactions(spark, d)))


@query(
    "target_rows_for_batch",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey IN "
    "(SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-06-01')",
)
def target_rows_for_batch(spark: SparkSession, d: str) -> DataFrame:
    batch = table(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))
    stored = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return target_rows(stored, batch.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


CUSTOMER_DOC = "_id long, c_custkey long, c_name string, c_acctbal double, c_mktsegment string"


def _customer_docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("_id"), "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )


@query("first_load_branch", "SELECT c_custkey AS _id, c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def first_load_branch(spark: SparkSession, d: str) -> DataFrame:
    store = KeyedTable.temporary(spark, "first_load", ["_id"], CUSTOMER_DOC)
    store.upsert(_customer_docs(spark, d))
    return store.read()


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    txn = P.successful(I.event_transactions(spark, d))
    cut = F.lit(DAY).cast("timestamp")
    at = F.col("transactionTime")
    return txn.filter(at < cut), txn.filter(at >= cut)


HALVES_SQL = f"""
{I.EVENT_TXN_SQL.strip()},
stored AS ({profile_sql(f"txn WHERE transStatus = 1 AND transactionTime < DATE '{DAY}'")}),
fresh AS ({profile_sql(f"txn WHERE transStatus = 1 AND transactionTime >= DATE '{DAY}'")})"""


@query(
    "late_run_guard",
    f"WITH {HALVES_SQL} SELECT {PROFILE_OUT} FROM fresh WHERE userId NOT IN "
    "(SELECT userId FROM stored WHERE modifiedDate > DATE '2024-01-14')",
)
def late_run_guard(spark: SparkSession, d: str) -> DataFrame:
    old, new = (P.activity_profile(x) for x in _halves(spark, d))
    return P.late_guard(new, old, F.lit("2024-01-14").cast("date"))


@query(
    "activity_merge",
    f"""
WITH {HALVES_SQL},
both_sides AS (SELECT *, 0 AS side FROM stored UNION ALL SELECT *, 1 AS side FROM fresh),
merged AS (
  SELECT userId, min(firstPaymentDate) AS firstPaymentDate, max(lastPaymentDate) AS lastPaymentDate,
         min(firstActiveDate) AS firstActiveDate, max(lastActiveDate) AS lastActiveDate,
         list_sort(list_distinct(flatten(list(appIds)))) AS appIds,
         last(lastActiveTransactionType ORDER BY lastActiveDate, side) AS lastActiveTransactionType,
         last(lastPayAppId ORDER BY lastPaymentDate, side) FILTER (WHERE lastPayAppId IS NOT NULL) AS lastPayAppId,
         list_sort(list_distinct(flatten(list(payPmcIds) FILTER (WHERE payPmcIds IS NOT NULL)))) AS payPmcIds,
         max(modifiedDate) AS modifiedDate
  FROM both_sides GROUP BY userId)
SELECT {PROFILE_OUT} FROM merged
""",
)
def activity_merge(spark: SparkSession, d: str) -> DataFrame:
    old, new = (P.activity_profile(x) for x in _halves(spark, d))
    return P.activity_merge(old, new)


@query(
    "activity_array_union",
    "SELECT l_orderkey AS userId, array_to_string(list_sort(list(DISTINCT l_partkey % 20)), ',') AS payPmcIds "
    "FROM lineitem GROUP BY 1",
)
def activity_array_union(spark: SparkSession, d: str) -> DataFrame:
    per_line = _line_apps(spark, d).groupBy("userId", "transType").agg(F.collect_set("pmcId").alias("pmcIds"))
    return per_line.groupBy("userId").agg(P.array_union_agg("pmcIds").alias("payPmcIds"))


@query(
    "activity_last_nonnull",
    f"""
WITH {I.EVENT_TXN_SQL}, rows AS (SELECT *, CASE WHEN transType <= 3 THEN appId END AS app FROM txn)
SELECT userId, CAST(max(transType) AS BIGINT) AS typeByValue,
       CAST(last(app ORDER BY transType, transactionTime, transId) FILTER (WHERE app IS NOT NULL) AS BIGINT) AS appByValue,
       CAST(last(transType ORDER BY transactionTime, transId) AS BIGINT) AS typeByTime,
       CAST(last(app ORDER BY transactionTime, transId) FILTER (WHERE app IS NOT NULL) AS BIGINT) AS appByTime
FROM rows GROUP BY userId
""",
)
def activity_last_nonnull(spark: SparkSession, d: str) -> DataFrame:
    """Both readings of "last": by the type's own value (as seen) and by time (as meant)."""
    rows = I.event_transactions(spark, d).withColumn("app", F.when(F.col("transType") <= 3, F.col("appId")))
    has = F.col("app").isNotNull()
    return rows.groupBy("userId").agg(
        F.max("transType").alias("typeByValue"),
        F.max_by("app", F.when(has, F.struct("transType", "transactionTime", "transId"))).alias("appByValue"),
        F.max_by("transType", F.struct("transactionTime", "transId")).alias("typeByTime"),
        F.max_by("app", F.when(has, F.struct("transactionTime", "transId"))).alias("appByTime"),
    )


@query(
    "demographic_parse",
    f"WITH {I.USERS_SQL} SELECT userid, CAST(dob AS VARCHAR) AS dob, CAST(profileLevel AS BIGINT) AS profileLevel, "
    "CAST(gender AS BIGINT) AS gender, strftime(updated_time, '%Y-%m-%d %H:%M:%S') AS updated_time, "
    "CAST(epoch_ms(updated_time) AS BIGINT) AS updated_ms FROM users",
)
def demographic_parse(spark: SparkSession, d: str) -> DataFrame:
    return P.parse_users(I.users(spark, d)).select(
        "userid", "dob", "profileLevel", "gender", "updated_time", F.unix_millis("updated_time").alias("updated_ms")
    )


DEMO_OUT = (
    "userid, CAST(dob AS VARCHAR) AS dob, CAST(profileLevel AS BIGINT) AS profileLevel, "
    "CAST(gender AS BIGINT) AS gender, strftime(updated_time, '%Y-%m-%d %H:%M:%S') AS updated_time"
)
DEMO_ORDER = "PARTITION BY userid ORDER BY updated_time DESC, profileLevel DESC, gender DESC, dob DESC"


@query(
    "demographic_latest",
    f"WITH {I.USERS_SQL} SELECT {DEMO_OUT} FROM users QUALIFY row_number() OVER ({DEMO_ORDER}) = 1",
)
def demographic_latest(spark: SparkSession, d: str) -> DataFrame:
    return P.demographic_latest(P.parse_users(I.users(spark, d)))


@query(
    "demographic_merge",
    f"WITH {I.USERS_SQL} SELECT userid AS _id, {DEMO_OUT} FROM users QUALIFY row_number() OVER ({DEMO_ORDER}) = 1",
)
def demographic_merge(spark: SparkSession, d: str) -> DataFrame:
    """First half of the updates is stored, the second half comes as a batch."""
    rows = P.parse_users(I.users(spark, d))
    cut = F.lit("1998-07-01").cast("timestamp")
    store = KeyedTable.temporary(spark, "demographic", ["_id"], f"_id long, {P.DEMOGRAPHIC_SCHEMA}")
    for part in (rows.filter(F.col("updated_time") < cut), rows.filter(F.col("updated_time") >= cut)):
        batch = materialize(P.demographic_latest(part).withColumn("_id", F.col("userid")), "users")
        store.upsert(P.demographic_merge(store.rows_for(batch).drop("_id"), batch.drop("_id")).withColumn("_id", F.col("userid")))
    return store.read()


@query(
    "promotion_config_join",
    f"WITH {I.PROMOTIONS_SQL}, {I.CAMPAIGNS_SQL} SELECT userid, voucherCode, status, p.campaignID, "
    "CAST(campaignType AS BIGINT) AS campaignType, CAST(expireDate AS VARCHAR) AS expireDate, expireTime "
    "FROM promotions p LEFT JOIN config c ON p.campaignID = c.campaignID",
)
def promotion_config_join(spark: SparkSession, d: str) -> DataFrame:
    return P.with_config(I.promotions(spark, d), I.campaigns(spark, d)).drop("time")


@query(
    "promotion_final_status",
    f"WITH {I.VOUCHERS_SQL} SELECT userid, voucherCode, status, campaignID, CAST(time AS VARCHAR) AS time FROM final",
)
def promotion_final_status(spark: SparkSession, d: str) -> DataFrame:
    return P.final_status(I.promotions(spark, d))


@query(
    "promotion_time_fields",
    """
SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS time_use,
       CAST(CAST(o_orderkey * 7919 AS BIGINT) // 86400 AS BIGINT) AS days FROM orders
""",
)
def promotion_time_fields(spark: SparkSession, d: str) -> DataFrame:
    rows = I.orders(spark, d).select(
        F.col("o_orderkey").alias("userid"), F.lit("V").alias("voucherCode"), F.lit("USED").alias("status"),
        F.lit(1).alias("campaignID"), F.lit(2).alias("campaignType"), (F.col("o_orderkey") * 7919).alias("expireTime"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.lit("2030-01-01 00:00:00").alias("expireDate"),
    )
    return P.time_fields(rows).select(F.col("userid").alias("o_orderkey"), "time_use", "days")


VOUCHER_OUT = """
userid, voucherCode, status, campaignID, CAST(campaignType AS BIGINT) AS campaignType,
CAST(expire_date AS VARCHAR) AS expire_date, expireTime, CAST(time_use AS VARCHAR) AS time_use,
CAST(days AS BIGINT) AS days, check_voucher"""


def all_vouchers(spark: SparkSession, d: str) -> DataFrame:
    return P.vouchers(I.promotions(spark, d), I.campaigns(spark, d), as_of())


@query("voucher_expiry", f"WITH {I.VOUCHERS_SQL} SELECT {VOUCHER_OUT} FROM vouchers")
def voucher_expiry(spark: SparkSession, d: str) -> DataFrame:
    return all_vouchers(spark, d)


@query(
    "promotion_campaign_users",
    f"WITH {I.PROMOTIONS_SQL} SELECT userid, campaignID FROM promotions WHERE campaignID = 100",
)
def promotion_campaign_users(spark: SparkSession, d: str) -> DataFrame:
    """Users of one campaign; the filter reaches the scan."""
    return I.promotions(spark, d).filter(F.col("campaignID") == 100).select("userid", "campaignID")


@query(
    "promotion_expired_list",
    f"WITH {I.VOUCHERS_SQL} SELECT {VOUCHER_OUT} FROM vouchers WHERE check_voucher = 'expired'",
)
def promotion_expired_list(spark: SparkSession, d: str) -> DataFrame:
    return all_vouchers(spark, d).filter(F.col("check_voucher") == "expired")


@query(
    "promotion_live_in_campaign",
    f"WITH {I.VOUCHERS_SQL} SELECT {VOUCHER_OUT} FROM vouchers WHERE check_voucher = 'not_expire' AND campaignID = 1802",
)
def promotion_live_in_campaign(spark: SparkSession, d: str) -> DataFrame:
    return all_vouchers(spark, d).filter((F.col("campaignID") == 1802) & (F.col("check_voucher") == "not_expire"))


@query(
    "promotion_key",
    f"WITH {I.PROMOTIONS_SQL} SELECT userid || '~' || voucherCode || '~' || campaignID AS _id, count(*) AS n "
    "FROM promotions GROUP BY 1",
)
def promotion_key(spark: SparkSession, d: str) -> DataFrame:
    p = I.promotions(spark, d).select(document_id(*P.VOUCHER_KEY).alias("_id"))
    return p.groupBy("_id").agg(F.count("*").alias("n"))


@query(
    "promotion_merge",
    f"WITH {I.VOUCHERS_SQL} SELECT userid || '~' || voucherCode || '~' || campaignID AS _id, {VOUCHER_OUT} "
    "FROM vouchers QUALIFY row_number() OVER (PARTITION BY userid, voucherCode, campaignID ORDER BY time_use DESC) = 1",
)
def promotion_merge(spark: SparkSession, d: str) -> DataFrame:
    """Use times before 1998-07 are stored, later ones come as a batch."""
    cut = F.lit("1998-07-01").cast("timestamp")
    p, cfg = I.promotions(spark, d), I.campaigns(spark, d)
    old = P.voucher_rows(p.filter(F.col("time") < cut), cfg, as_of())
    new = P.voucher_rows(p.filter(F.col("time") >= cut), cfg, as_of())
    return P.voucher_merge(old, new, as_of())


@query(
    "upsert_by_key",
    """
SELECT c_custkey AS _id, c_custkey, c_name,
       CASE WHEN c_nationkey < 10 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
UNION ALL
SELECT -1 - c_custkey, -1 - c_custkey, c_name, 0.0, c_mktsegment FROM customer WHERE c_nationkey = 3
""",
)
def upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    """Changed rows of ten nations replace theirs; rows with new keys are added."""
    c = _customer_docs(spark, d)
    nation = table(spark, d, "customer").select(F.col("c_custkey").alias("_id"), "c_nationkey")
    tagged = c.join(nation, "_id")
    changed = tagged.filter(F.col("c_nationkey") < 10).withColumn("c_acctbal", F.col("c_acctbal") + 100)
    new_key = -1 - F.col("c_custkey")
    added = tagged.filter(F.col("c_nationkey") == 3).withColumns(
        {"_id": new_key, "c_custkey": new_key, "c_acctbal": F.lit(0.0)}
    )
    store = KeyedTable.temporary(spark, "customer", ["_id"], CUSTOMER_DOC)
    store.replace(c)
    store.upsert(changed.unionByName(added).drop("c_nationkey"))
    return store.read()


def run_day(spark: SparkSession, source: str, lake: str, stores: dict[str, KeyedTable], day: str, now) -> None:
    """One business day: lake, configuration, then the three ledgers. A second run changes nothing."""
    L.ingest_day(spark, source, lake, day)
    L.ingest_config(spark, source, lake)
    run_date = F.lit(day).cast("date")

    users = materialize(P.demographic_latest(P.parse_users(L.lake_table(spark, lake, "users", day))), "users").withColumn("_id", F.col("userid"))
    store = stores["demographic"]
    store.upsert(P.demographic_merge(store.rows_for(users).drop("_id"), users.drop("_id")).withColumn("_id", F.col("userid")))

    batch = materialize(P.activity_profile(P.successful(L.lake_table(spark, lake, "transactions", day))), "activity").withColumn("_id", F.col("userId"))
    store = stores["activity"]
    stored, batch = store.rows_for(batch).drop("_id"), batch.drop("_id")
    store.upsert(P.activity_merge(stored, P.late_guard(batch, stored, run_date)).withColumn("_id", F.col("userId")))

    rows = P.voucher_rows(L.lake_table(spark, lake, "promotions", day), L.lake_config(spark, lake), now)
    stores["voucher"].merge(rows.withColumn("_id", document_id(*P.VOUCHER_KEY)), lambda both: P.voucher_ledger(both, now))


VOUCHER_SCHEMA = (
    "_id string, userid long, voucherCode string, status string, campaignID long, campaignType int, "
    "expire_date timestamp, expireTime long, time_use timestamp, days int, check_voucher string"
)


def day_stores(spark: SparkSession) -> dict[str, KeyedTable]:
    return {
        "demographic": KeyedTable.temporary(spark, "demographic", ["_id"], f"_id long, {P.DEMOGRAPHIC_SCHEMA}"),
        "activity": KeyedTable.temporary(spark, "activity", ["_id"], f"_id long, {P.ACTIVITY_SCHEMA}"),
        "voucher": KeyedTable.temporary(spark, "voucher", ["_id"], VOUCHER_SCHEMA),
    }


@query(
    "run_business_day",
    f"""
WITH {I.VOUCHERS_SQL}
SELECT 'activity' AS ledger, count(DISTINCT o_custkey) AS n FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'demographic', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'voucher', count(DISTINCT userid || '~' || voucherCode || '~' || campaignID) FROM vouchers
""",
)
def run_business_day(spark: SparkSession, d: str) -> DataFrame:
    src, lake = scratch(spark, "tsv"), scratch(spark, "lake")
    L.write_tsv(I.promotions(spark, d), f"{src}/promotions/{DAY}")
    L.write_tsv(order_transactions(spark, d), f"{src}/transactions/{DAY}")
    L.write_tsv(I.users(spark, d), f"{src}/users/{DAY}")
    L.write_tsv(I.campaigns(spark, d), f"{src}/configs")
    stores = day_stores(spark)
    run_day(spark, src, lake, stores, DAY, as_of())
    parts = [s.read().agg(F.count("*").alias("n")).select(F.lit(k).alias("ledger"), "n") for k, s in stores.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
