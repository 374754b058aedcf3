"""Pipeline tables as views on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.session import table, zoned

# Event names as transaction types; 3 is a payment (fixed values).
TYPE_OF_EVENT = {"signup": 1, "view": 2, "purchase": 3, "click": 4, "error": 5}


def events(spark: SparkSession, folder: str) -> DataFrame:
    return zoned(table(spark, folder, "events"), "ts")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return zoned(table(spark, folder, "orders"), "o_orderdate")


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return zoned(table(spark, folder, "lineitem"), "l_shipdate")


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions from events: app and payment campaign codes come from ``props.k``."""
    kind = F.coalesce(*[F.when(F.col("event_type") == e, F.lit(c)) for e, c in TYPE_OF_EVENT.items()])
    k = F.get_json_object("props", "$.k").cast("int")
    return events(spark, folder).select(
        F.col("event_id").alias("transId"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("transStatus"),
        F.col("user_id").alias("userId"),
        F.col("ts").alias("transactionTime"),
        (k % 13 + 1).alias("appId"),
        kind.alias("transType"),
        F.col("value").alias("amount"),
        (k % 20).alias("pmcId"),
    )


EVENT_TXN_SQL = """
txn AS (
  SELECT event_id AS transId, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS transStatus,
         user_id AS userId, ts AS transactionTime, k % 13 + 1 AS appId,
         CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
                         WHEN 'click' THEN 4 ELSE 5 END AS transType,
         value AS amount, k % 20 AS pmcId
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))
"""


def promotions(spark: SparkSession, folder: str) -> DataFrame:
    """Vouchers from order lines: the user is the order's customer, the campaign the part."""
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    li = lineitem(spark, folder).select("l_orderkey", "l_suppkey", "l_partkey", "l_returnflag", "l_shipdate")
    return li.join(o, "l_orderkey").select(
        F.col("o_custkey").alias("userid"),
        F.concat(F.lit("V-"), F.col("l_suppkey")).alias("voucherCode"),
        F.col("l_returnflag").alias("status"),
        F.col("l_partkey").alias("campaignID"),
        F.col("l_shipdate").alias("time"),
    )


PROMOTIONS_SQL = """
promotions AS (
  SELECT o_custkey AS userid, 'V-' || l_suppkey AS voucherCode, l_returnflag AS status,
         l_partkey AS campaignID, l_shipdate AS time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def campaigns(spark: SparkSession, folder: str) -> DataFrame:
    """Campaign configuration from parts; parts above size 40 have none."""
    typ = (F.col("p_partkey") % 2 + 1).cast("int")
    return (
        table(spark, folder, "part")
        .filter(F.col("p_size") <= 40)
        .select(
            F.col("p_partkey").alias("campaignID"),
            typ.alias("campaignType"),
            F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 2500).cast("int"))
            .cast("timestamp")
            .alias("expireDate"),
            F.when(typ == 2, F.col("p_size").cast("long") * 86400).otherwise(F.lit(0).cast("long")).alias("expireTime"),
        )
    )


CAMPAIGNS_SQL = """
config AS (
  SELECT p_partkey AS campaignID, CAST(p_partkey % 2 + 1 AS INTEGER) AS campaignType,
         CAST(DATE '1995-01-01' + CAST(p_partkey % 2500 AS INTEGER) AS TIMESTAMP) AS expireDate,
         CASE WHEN p_partkey % 2 + 1 = 2 THEN CAST(p_size AS BIGINT) * 86400 ELSE 0 END AS expireTime
  FROM part WHERE p_size <= 40)
"""

AS_OF = "1999-01-01 00:00:00"

VOUCHERS_SQL = f"""
{PROMOTIONS_SQL.strip()}, {CAMPAIGNS_SQL.strip()},
final AS (
  SELECT * FROM (SELECT *, max(status) OVER (PARTITION BY userid, voucherCode, campaignID) AS top FROM promotions)
  WHERE status = top),
timed AS (
  SELECT userid, voucherCode, status, f.campaignID, campaignType, expireDate AS expire_date, expireTime,
         f.time AS time_use, CAST(expireTime // 86400 AS INTEGER) AS days
  FROM final f LEFT JOIN config c ON f.campaignID = c.campaignID),
vouchers AS (
  SELECT *, CASE WHEN eff < TIMESTAMP '{AS_OF}' THEN 'expired' WHEN eff >= TIMESTAMP '{AS_OF}' THEN 'not_expire' END
            AS check_voucher
  FROM (SELECT *, CASE WHEN campaignType = 1 THEN expire_date
                       WHEN campaignType = 2 THEN least(time_use + to_days(days), expire_date) END AS eff
        FROM timed))
"""


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Daily user rows from orders: one profile update per order."""
    d = orders(spark, folder)
    return d.select(
        F.col("o_custkey").alias("userid"),
        F.date_format(F.date_sub(F.to_date("o_orderdate"), 9000), "yyyy-M-dd").alias("birthdate"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("profileLevel"),
        F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(2).alias("gender"),
        F.concat(
            F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10:20:30."),
            F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"),
        ).alias("updatedTime"),
    )


USERS_SQL = """
users AS (
  SELECT o_custkey AS userid, CAST(CAST(o_orderdate AS DATE) - 9000 AS DATE) AS dob,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS profileLevel,
         CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS gender,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL '10 hours 20 minutes 30 seconds'
           + to_milliseconds(o_orderkey % 1000) AS updated_time,
         o_orderkey
  FROM orders)
"""
