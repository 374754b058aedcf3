"""The three per-user ledgers: activity, demographics, vouchers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.vouchers import voucher_state, whole_days
from dayledger.operators.skew import latest_per_key, rows_at_group_max
from dayledger.operators.upsert import NEW, PART, document_id

# Code of a payment among the transaction types (fixed value).
PAYMENT = 3

ACTIVITY_SCHEMA = (
    "userId long, firstPaymentDate date, lastPaymentDate date, firstActiveDate date, lastActiveDate date, "
    "appIds array<int>, lastActiveTransactionType int, lastPayAppId int, payPmcIds array<int>, modifiedDate date"
)
DEMOGRAPHIC_SCHEMA = "userid long, dob date, profileLevel int, gender int, updated_time timestamp"
VOUCHER_KEY = ["userid", "voucherCode", "campaignID"]
VOUCHER_COLUMNS = [
    "userid", "voucherCode", "status", "campaignID", "campaignType",
    "expire_date", "expireTime", "time_use", "days", "check_voucher",
]


def none_if_empty(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def successful(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("transStatus") == 1).select(
        "transId", "userId", F.to_timestamp("transactionTime").alias("transactionTime"),
        "appId", "transType", "amount", "pmcId",
    )


def activity_profile(txn: DataFrame) -> DataFrame:
    """One activity row per user: a single conditional aggregate, one shuffle of partial results.

    The two sets hold app and payment-campaign codes, which come from short code lists.
    """
    day = F.to_date("transactionTime")
    pay = F.col("transType") == PAYMENT
    moment = F.struct("transactionTime", "transId")
    return txn.groupBy("userId").agg(
        F.min(F.when(pay, day)).alias("firstPaymentDate"),
        F.max(F.when(pay, day)).alias("lastPaymentDate"),
        F.min(day).alias("firstActiveDate"),
        F.max(day).alias("lastActiveDate"),
        F.array_sort(F.collect_set("appId")).alias("appIds"),
        F.max_by("transType", moment).alias("lastActiveTransactionType"),
        F.max_by("appId", F.when(pay, moment)).alias("lastPayAppId"),
        none_if_empty(F.array_sort(F.collect_set(F.when(pay, F.col("pmcId"))))).alias("payPmcIds"),
        F.max(day).alias("modifiedDate"),
    )


def array_union_agg(col: str) -> Column:
    """Union of a group of short arrays, sorted, without repeats; null if nothing is left."""
    merged = F.array_sort(F.array_distinct(F.flatten(F.collect_set(col))))
    return none_if_empty(merged)


def late_guard(batch: DataFrame, stored: DataFrame, run_date: Column, key: str = "userId") -> DataFrame:
    """Drop batch users whose stored row is already newer than the run date."""
    newer = stored.filter(F.col("modifiedDate") > run_date).select(key)
    return batch.join(newer, key, "left_anti")


def activity_merge(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new activity to one row per user; both sides have one row per user."""
    both = stored.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)))
    active = F.when(F.col("lastActiveTransactionType").isNotNull(), F.struct("lastActiveDate", "_rank"))
    paid = F.when(F.col("lastPayAppId").isNotNull(), F.struct("lastPaymentDate", "_rank"))
    return both.groupBy("userId").agg(
        F.min("firstPaymentDate").alias("firstPaymentDate"),
        F.max("lastPaymentDate").alias("lastPaymentDate"),
        F.min("firstActiveDate").alias("firstActiveDate"),
        F.max("lastActiveDate").alias("lastActiveDate"),
        array_union_agg("appIds").alias("appIds"),
        F.max_by("lastActiveTransactionType", active).alias("lastActiveTransactionType"),
        F.max_by("lastPayAppId", paid).alias("lastPayAppId"),
        array_union_agg("payPmcIds").alias("payPmcIds"),
        F.max("modifiedDate").alias("modifiedDate"),
    )


def parse_users(users: DataFrame) -> DataFrame:
    return users.withColumns(
        {
            "dob": F.to_date("birthdate", "yyyy-M-dd"),
            "updated_time": F.to_timestamp("updatedTime", "yyyy-MM-dd HH:mm:ss.SSS"),
        }
    )


def demographic_latest(users: DataFrame) -> DataFrame:
    """Latest row per user; equal times fall back to the remaining columns."""
    rows = users.select("userid", "dob", "profileLevel", "gender", "updated_time")
    return latest_per_key(rows, ["userid"], ["updated_time", "profileLevel", "gender", "dob"])


def demographic_merge(stored: DataFrame, new: DataFrame) -> DataFrame:
    return demographic_latest(stored.unionByName(new))


def final_status(rows: DataFrame) -> DataFrame:
    """Rows at the highest status of their voucher (text order: GIVEN < USED)."""
    return rows_at_group_max(rows, VOUCHER_KEY, "status")


def with_config(promotions: DataFrame, config: DataFrame) -> DataFrame:
    return promotions.join(config, "campaignID", "left")


def time_fields(rows: DataFrame) -> DataFrame:
    return rows.select(
        "userid", "voucherCode", "status", "campaignID", "campaignType", "expireTime",
        F.to_timestamp("expireDate").alias("expire_date"),
        F.to_timestamp("time").alias("time_use"),
        whole_days(F.col("expireTime")).alias("days"),
    )


def with_state(rows: DataFrame, as_of: Column | None = None) -> DataFrame:
    state = voucher_state(F.col("campaignType"), F.col("time_use"), F.col("days"), F.col("expire_date"), as_of)
    return rows.withColumn("check_voucher", state)


def vouchers(promotions: DataFrame, config: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Daily voucher rows with state. The status filter comes before the lookup join: fewer rows to join."""
    return voucher_rows(final_status(promotions), config, as_of)


def voucher_rows(promotions: DataFrame, config: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Rows of any status with their state; enough ahead of ``voucher_merge``, which picks the final status itself."""
    return with_state(time_fields(with_config(promotions, config)), as_of).select(VOUCHER_COLUMNS)


def voucher_merge(stored: DataFrame, new: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per voucher: final status wins, then the latest use; state is worked out afresh."""
    both = stored.unionByName(new).filter(F.col("status").isNotNull()).drop("check_voucher")
    one = latest_per_key(both, VOUCHER_KEY, ["status", "time_use", "expire_date"])
    return with_state(one, as_of).select(document_id(*VOUCHER_KEY).alias("_id"), *VOUCHER_COLUMNS)


def voucher_ledger(both: DataFrame, as_of: Column | None = None) -> DataFrame:
    """``voucher_merge`` on stored and new rows in one frame that lies by ``PART``; a voucher without a new row stays as stored.

    The rows are not combined ahead of the shuffle: a voucher has few rows, and the sort for that would hold them all.
    """
    # compared in the order of the columns, so one struct is both the row and its rank
    fields = ["status", "time_use", "expire_date", "campaignType", "expireTime", "days"]
    row = F.struct(*fields, F.when(~F.col(NEW), F.col("check_voucher")).alias("_stored"))
    one = both.groupBy(PART, *VOUCHER_KEY).agg(
        F.max(F.when(F.col("status").isNotNull(), row)).alias("_row"), F.max(NEW).alias(NEW)
    )
    rows = with_state(one.filter(F.col("_row").isNotNull()).select(PART, NEW, *VOUCHER_KEY, "_row.*"), as_of)
    rows = rows.withColumn("check_voucher", F.when(F.col(NEW), F.col("check_voucher")).otherwise(F.col("_stored")))
    return rows.select(document_id(*VOUCHER_KEY).alias("_id"), *VOUCHER_COLUMNS, PART)
