"""Daily tab-separated files to a Parquet lake laid out as ``<lake>/<table>/date=<day>/accepted=<true or false>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed schemas of the daily files and the configuration.
PROMOTIONS = "userid long, voucherCode string, status string, campaignID long, time timestamp"
TRANSACTIONS = (
    "transId string, transStatus int, userId long, transactionTime timestamp, "
    "appId int, transType int, amount long, pmcId int"
)
USERS = "userid long, birthdate string, profileLevel int, gender int, updatedTime string"
CONFIG = "campaignID long, campaignType int, expireDate timestamp, expireTime long"
DAILY = {"promotions": PROMOTIONS, "transactions": TRANSACTIONS, "users": USERS}

CORRUPT = "_corrupt"


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headed tab-separated text with a fixed schema; rows that do not fit keep their text in ``_corrupt``."""
    return spark.read.schema(f"{schema}, {CORRUPT} string").csv(
        path, sep="\t", header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, timestampFormat="yyyy-MM-dd HH:mm:ss.SSS")


def split_malformed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), raw.filter(F.col(CORRUPT).isNotNull())


def lake_path(lake: str, table: str, day: str) -> str:
    return f"{lake}/{table}/date={day}"


def write_sorted_out(raw: DataFrame, path: str) -> None:
    """Rows that fit and rows that do not, each kind in its folder, from one pass over the text."""
    raw.withColumn("accepted", F.col(CORRUPT).isNull()).write.mode("overwrite").partitionBy("accepted").parquet(path)


def ingest(spark: SparkSession, src: str, lake: str, table: str, day: str, schema: str) -> None:
    """One table of one day, replaced as a whole; bad rows keep their text."""
    write_sorted_out(read_tsv(spark, src, schema), lake_path(lake, table, day))


def ingest_day(spark: SparkSession, source: str, lake: str, day: str) -> None:
    for name, schema in DAILY.items():
        ingest(spark, f"{source}/{name}/{day}", lake, name, day, schema)


def ingest_config(spark: SparkSession, source: str, lake: str) -> None:
    write_sorted_out(read_tsv(spark, f"{source}/configs", CONFIG), f"{lake}/configs")


def _kind(spark: SparkSession, path: str, schema: str, accepted: bool) -> DataFrame:
    """Rows of one kind; the filter opens that folder only, and a kind without rows has none."""
    rows = spark.read.schema(f"{schema}, {CORRUPT} string, accepted boolean").parquet(path)
    return rows.filter(F.col("accepted") == accepted).drop("accepted")


def lake_table(spark: SparkSession, lake: str, table: str, day: str | None = None) -> DataFrame:
    """Accepted rows of one table of the lake with their ``date``, or of one day of it (read by folder)."""
    if day is None:
        return _kind(spark, f"{lake}/{table}", f"{DAILY[table]}, date string", True).drop(CORRUPT)
    return _kind(spark, lake_path(lake, table, day), DAILY[table], True).drop(CORRUPT)


def lake_config(spark: SparkSession, lake: str) -> DataFrame:
    return _kind(spark, f"{lake}/configs", CONFIG, True).drop(CORRUPT)


def rejected(spark: SparkSession, lake: str, table: str, day: str | None = None) -> DataFrame:
    """Rows of a daily table or of ``configs`` that did not fit the schema, with their text."""
    path = f"{lake}/configs" if table == "configs" else lake_path(lake, table, day) if day else f"{lake}/{table}"
    return _kind(spark, path, CONFIG if table == "configs" else DAILY[table], False)
