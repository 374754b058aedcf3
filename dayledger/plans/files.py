"""Sources and sinks: each job writes to the shared folder and reads back."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.operators.hot import split_hot
from dayledger.operators.skew import salted_join
from dayledger.registry import query
from dayledger.session import TASK_ROWS, parts_for, scratch, setting, small_side, table
from dayledger.sources import inputs as I


def new_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer"
CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query(
    "read_csv_options",
    """
SELECT c_custkey, c_name || chr(10) || '"' || c_mktsegment || '"; x' AS note, nullif(c_mktsegment, 'BUILDING') AS segment,
       c_acctbal AS balance FROM customer WHERE c_custkey % 50 <> 7
""",
)
def read_csv_options(spark: SparkSession, d: str) -> DataFrame:
    """Semicolons, header, null mark, quotes and line ends inside fields; rows that do not parse are dropped."""
    path = scratch(spark, "csv")
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('"; x'))
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    balance = F.when(F.col("c_custkey") % 50 == 7, "broken").otherwise(F.col("c_acctbal").cast("string"))
    rows = table(spark, d, "customer").select(
        "c_custkey", note.alias("note"), segment.alias("segment"), balance.alias("balance")
    )
    rows.write.csv(path, sep=";", header=True, nullValue="NA", quote='"', escape='"')
    return spark.read.schema("c_custkey long, note string, segment string, balance double").csv(
        path, sep=";", header=True, nullValue="NA", quote='"', escape='"', multiLine=True, mode="DROPMALFORMED"
    )


@query("write_csv", CUSTOMER_SQL)
def write_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "csv")
    table(spark, d, "customer").write.csv(path, header=True, quoteAll=True, compression="gzip")
    return spark.read.schema(CUSTOMER).csv(path, header=True)


@query(
    "read_json_schema",
    """
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       'event_id,props,user_id' AS inferred_columns FROM events
""",
)
def read_json_schema(spark: SparkSession, d: str) -> DataFrame:
    """Explicit schema for the read; an inferred one, from a share of the rows, beside it."""
    path = scratch(spark, "json")
    nothing = F.lit(None).cast("string").alias("nothing")
    props = F.from_json("props", "k long").alias("props")
    e = table(spark, d, "events").select("event_id", "user_id", props, nothing)
    e.write.json(path, ignoreNullFields=False)
    inferred = spark.read.json(path, samplingRatio=0.5, dropFieldIfAllNull=True).columns
    rows = spark.read.schema("event_id long, user_id long, props struct<k: long>").json(path)
    return rows.select("event_id", "user_id", "props.k", F.lit(",".join(inferred)).alias("inferred_columns"))


@query(
    "write_json",
    """
SELECT CASE WHEN event_type = 'error' THEN '{"event_id":' || event_id || '}'
       ELSE '{"event_id":' || event_id || ',"kind":"' || event_type || '"}' END AS line,
       '{"event_id":' || event_id || ',"kind":' || CASE WHEN event_type = 'error' THEN 'null'
         ELSE '"' || event_type || '"' END || '}' AS with_nulls FROM events
""",
)
def write_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines with null fields dropped (as written) and kept (rows to JSON text)."""
    path = scratch(spark, "json")
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    table(spark, d, "events").select("event_id", kind).write.json(path, compression="gzip")
    back = spark.read.schema("value string").text(path)
    parsed = F.from_json("value", "event_id long, kind string")
    return back.select(F.col("value").alias("line"), F.to_json(parsed, {"ignoreNullFields": "false"}).alias("with_nulls"))


@query(
    "read_parquet_merge",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END::BIGINT AS part FROM orders
""",
)
def read_parquet_merge(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "merge")
    o = table(spark, d, "orders")
    o.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_totalprice").alias("price")).write.parquet(f"{path}/part=1")
    o.filter("o_orderstatus <> 'F'").select("o_orderkey", F.col("o_orderpriority").alias("priority")).write.parquet(
        f"{path}/part=2"
    )
    return spark.read.option("mergeSchema", True).parquet(path).select("o_orderkey", "price", "priority", "part")


@query(
    "write_parquet_partitioned",
    "SELECT o_orderstatus, year(o_orderdate) AS yr, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders "
    "WHERE year(o_orderdate) >= 1998 GROUP BY ALL",
)
def write_parquet_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """Partitioned by year and status; the read opens only the folders it needs."""
    path = scratch(spark, "parquet")
    o = I.orders(spark, d).withColumn("yr", F.year("o_orderdate").cast("long"))
    o.write.partitionBy("yr", "o_orderstatus").parquet(path, compression="zstd")
    schema = T.StructType([*o.drop("yr").schema.fields, T.StructField("yr", T.LongType())])
    back = spark.read.schema(schema).parquet(path).filter("yr >= 1998")
    return back.groupBy("o_orderstatus", "yr").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "read_write_orc",
    "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part WHERE p_brand = 'Brand#3'",
)
def read_write_orc(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "orc")
    p = table(spark, d, "part")
    p.write.option("orc.bloom.filter.columns", "p_brand").option("orc.dictionary.key.threshold", "1.0").orc(path)
    return spark.read.schema(p.schema).orc(path).filter("p_brand = 'Brand#3'").select(
        "p_partkey", "p_name", "p_brand", "p_retailprice"
    )


@query(
    "read_write_text",
    """
SELECT 'lines' AS kind, count(*) AS n, sum(length(line))::BIGINT AS chars
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
UNION ALL SELECT 'records', count(*), sum(length(text))::BIGINT FROM documents
UNION ALL SELECT 'files', 1, sum(length(text) + 1)::BIGINT FROM documents
""",
)
def read_write_text(spark: SparkSession, d: str) -> DataFrame:
    """Lines, records with their own separator, and whole files (kept small by a row limit per file)."""
    path = scratch(spark, "text")
    docs = table(spark, d, "documents").select("text")
    docs.write.option("maxRecordsPerFile", 1000).text(path)
    docs.write.option("lineSep", "\x01").text(f"{path}-records")
    chars = F.sum(F.length("value").cast("long")).alias("chars")
    lines = spark.read.text(path).agg(F.count("*").alias("n"), chars)
    records = spark.read.text(f"{path}-records", lineSep="\x01").agg(F.count("*").alias("n"), chars)
    files = spark.read.text(path, wholetext=True).agg(F.lit(1).cast("long").alias("n"), chars)
    return (
        lines.select(F.lit("lines").alias("kind"), "*")
        .unionAll(records.select(F.lit("records"), "*"))
        .unionAll(files.select(F.lit("files"), "*"))
    )


@query(
    "read_libsvm",
    """
SELECT label::DOUBLE AS label, count(*) AS n, round(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE))), 3) AS total
FROM embeddings GROUP BY 1
""",
)
def read_libsvm(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "libsvm")
    e = table(spark, d, "embeddings")
    terms = F.transform("embedding", lambda x, i: F.concat_ws(":", (i + 1).cast("string"), x.cast("double").cast("string")))
    e.select(F.concat_ws(" ", F.col("label").cast("string"), F.array_join(terms, " "))).write.text(path)
    width = e.select(F.size("embedding").alias("n")).first()["n"]
    rows = spark.read.format("libsvm").option("numFeatures", width).load(path)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum(total), 3).alias("total"))


@query(
    "read_binary_files",
    "SELECT sum(strlen(html) + 1)::BIGINT AS bytes, true AS lengths_match FROM pages",
)
def read_binary_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "binary")
    table(spark, d, "pages").select("html").write.option("maxRecordsPerFile", 500).text(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    match = F.min((F.octet_length("content") == F.col("length")).cast("int")) == 1
    return files.agg(F.sum("length").alias("bytes"), match.alias("lengths_match"))


@query(
    "read_file_filters",
    "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def read_file_filters(spark: SparkSession, d: str) -> DataFrame:
    """Folders per segment; a glob, a recursive lookup and time limits choose the files."""
    path = scratch(spark, "filters")
    c = table(spark, d, "customer")
    for segment, form in (("BUILDING", "csv"), ("MACHINERY", "csv"), ("HOUSEHOLD", "json")):
        part = c.filter(F.col("c_mktsegment") == segment).select("c_custkey", "c_name")
        part.write.format(form).save(f"{path}/deep/{segment}")
    return (
        spark.read.schema("c_custkey long, c_name string")
        .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
        .option("modifiedAfter", "2000-01-01T00:00:00").option("modifiedBefore", "2999-01-01T00:00:00")
        .csv(path)
    )


@query(
    "save_modes",
    """
SELECT s_suppkey, count(*) AS n FROM (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0
  UNION ALL SELECT s_suppkey FROM supplier WHERE s_acctbal <= 0 UNION ALL SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)
GROUP BY 1
""",
)
def save_modes(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "modes")
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    s.write.mode("error").parquet(path)
    s.filter("s_acctbal > 0").write.mode("overwrite").parquet(path)
    s.filter("s_acctbal <= 0").write.mode("append").parquet(path)
    s.filter("s_acctbal > 5000").write.mode("append").format("parquet").save(path)
    s.write.mode("ignore").parquet(path)
    return spark.read.schema(s.schema).parquet(path).groupBy("s_suppkey").agg(F.count("*").alias("n"))


# the engine refuses more by default; a bucket may then hold more rows
MAX_BUCKETS = 100_000


def bucketed(df: DataFrame, stem: str, key: str, buckets: int) -> DataFrame:
    """External table in the shared folder, bucketed and sorted by ``key``; one task per bucket on write."""
    spark, name = df.sparkSession, new_name(stem)
    (
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        .option("path", scratch(spark, stem)).format("parquet").saveAsTable(name)
    )
    return spark.table(name)


@query(
    "table_bucketed",
    """
SELECT c_custkey, c_name, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
""",
)
def table_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Two tables bucketed alike join without a shuffle. Hot customers stay out of the buckets and are salted."""
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    out = ["c_custkey", "c_name", "o_totalprice"]

    def plain(df: DataFrame) -> DataFrame:
        n = min(parts_for(df), MAX_BUCKETS)
        return bucketed(df, "orders", "c_custkey", n).join(bucketed(c, "customer", "c_custkey", n), "c_custkey").select(out)

    def salted(df: DataFrame) -> DataFrame:
        # the other side holds partners of the hot customers only
        partners = c.join(F.broadcast(df.select("c_custkey").distinct()), "c_custkey", "left_semi")
        return salted_join(df, partners, "c_custkey", ["o_orderkey"]).select(out)

    joined = split_hot(o, ["c_custkey"], plain, salted)
    return joined.groupBy("c_custkey", "c_name").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "table_insert",
    """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT'
GROUP BY ALL
""",
)
def table_insert(spark: SparkSession, d: str) -> DataFrame:
    """Create, append, then replace one partition only."""
    name = new_name("orders_by_status")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    first = o.filter("o_orderstatus = 'F'")
    first.write.partitionBy("o_orderstatus").option("path", scratch(spark, name)).format("parquet").saveAsTable(name)
    o.filter("o_orderstatus <> 'F'").write.insertInto(name)
    urgent = o.filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        urgent.write.insertInto(name, overwrite=True)
    return spark.table(name).groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("table_create_as", "SELECT p_type, p_brand, count(*) AS n, 'parts' AS owner FROM part GROUP BY ALL")
def table_create_as(spark: SparkSession, d: str) -> DataFrame:
    """Table from a query with properties, and an outside table on its files whose partitions are looked up."""
    name, path = new_name("parts"), scratch(spark, "parts")
    spark.sql(
        f"CREATE TABLE {name} USING parquet PARTITIONED BY (p_type) LOCATION '{path}' "
        "TBLPROPERTIES ('ledger.owner' = 'parts') AS SELECT p_partkey, p_brand, p_type FROM {part}",
        part=table(spark, d, "part"),
    )
    outside = new_name("parts_outside")
    spark.sql(
        f"CREATE TABLE {outside} (p_partkey LONG, p_brand STRING, p_type STRING) USING parquet "
        f"PARTITIONED BY (p_type) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(outside)
    spark.catalog.refreshTable(outside)
    owner = spark.sql(f"SHOW TBLPROPERTIES {name} ('ledger.owner')").first()["value"]
    return spark.table(outside).groupBy("p_type", "p_brand").agg(F.count("*").alias("n")).withColumn("owner", F.lit(owner))


@query(
    "view_sql",
    "SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS mean FROM customer WHERE c_acctbal > 0 GROUP BY 1",
)
def view_sql(spark: SparkSession, d: str) -> DataFrame:
    view, shared = new_name("v_customer"), new_name("g_customer")
    spark.sql(f"SELECT * FROM parquet.`{d}/customer.parquet`").createOrReplaceTempView(view)
    spark.table(view).filter("c_acctbal > 0").createGlobalTempView(shared)
    return spark.newSession().sql(
        f"SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS mean FROM global_temp.{shared} GROUP BY 1"
    )


NATION_GROUPS = [(k, f"group {k}") for k in range(4)]


@query(
    "warehouse_keyvalue_join",
    """
SELECT c_custkey, c_name, 'group ' || (c_nationkey % 4) AS label FROM customer WHERE c_custkey > 10
""",
)
def warehouse_keyvalue_join(spark: SparkSession, d: str) -> DataFrame:
    """Warehouse table joined with a frame made in memory, filtered and ordered."""
    name = new_name("kv")
    kv = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    kv.write.option("path", scratch(spark, name)).format("parquet").saveAsTable(name)
    labels = spark.createDataFrame(NATION_GROUPS, "group_no int, label string")
    rows = spark.sql(f"SELECT c_custkey, c_name, pmod(c_nationkey, 4) AS group_no FROM {name} WHERE c_custkey > 10")
    return rows.join(small_side(labels), "group_no").drop("group_no").orderBy("c_custkey")


@query(
    "frame_from_rows",
    """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partial' END AS status_name,
       substr(o_orderpriority, 1, 1)::BIGINT AS rank_no, (6 - substr(o_orderpriority, 1, 1)::BIGINT) * 10 AS weight FROM orders
""",
)
def frame_from_rows(spark: SparkSession, d: str) -> DataFrame:
    """Code lists from rows, pandas and a range, joined to the orders they explain."""
    names = spark.createDataFrame(
        [Row(code="F", status_name="finished"), Row(code="O", status_name="open"), Row(code="P", status_name="partial")]
    )
    schema = T.StructType([T.StructField("rank_no", T.LongType()), T.StructField("weight", T.LongType())])
    weights = spark.createDataFrame(pd.DataFrame({"rank_no": range(1, 6), "weight": range(50, 0, -10)}), schema)
    known = spark.range(1, 6).toDF("rank_no")
    o = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("code"), F.substring("o_orderpriority", 1, 1).cast("long").alias("rank_no")
    )
    ranks = small_side(weights.join(known, "rank_no", "left_semi"))
    return o.join(small_side(names), "code").join(ranks, "rank_no").select("o_orderkey", "status_name", "rank_no", "weight")


@query(
    "fn_partition_transform",
    """
SELECT year(ts) AS y, month(ts) AS m, day(ts) AS dy, hour(ts) AS h, count(*) AS n, round(sum(value), 2) AS total
FROM events WHERE day(ts) BETWEEN 10 AND 12 GROUP BY ALL
""",
)
def fn_partition_transform(spark: SparkSession, d: str) -> DataFrame:
    """Year/month/day folders and user buckets on a table; day filters open single folders.

    The session catalog takes no transform expressions, so the parts are
    columns; the hour stays a column inside the files.
    """
    name = new_name("events_by_day")
    e = I.events(spark, d).select("event_id", "user_id", "value", "ts")
    e = e.withColumns({"h": F.hour("ts"), "y": F.year("ts"), "m": F.month("ts"), "dy": F.dayofmonth("ts")})
    # a task writes one bucket of one day, and only a bucket with very many rows is cut into several tasks and files
    n = min(parts_for(e), MAX_BUCKETS)
    cell = ["y", "m", "dy", "bucket"]
    e = e.withColumn("bucket", F.pmod(F.hash("user_id"), F.lit(n)))
    big = e.groupBy(*cell).agg(F.ceil(F.count("*") / TASK_ROWS).cast("int").alias("cuts")).filter("cuts > 1")
    e = e.join(F.broadcast(big), cell, "left").withColumn("cut", F.pmod(F.xxhash64("event_id"), F.coalesce("cuts", F.lit(1)))).drop("cuts")
    (
        e.repartition(*cell, "cut").drop("bucket", "cut").write.partitionBy("y", "m", "dy").bucketBy(n, "user_id")
        .option("path", scratch(spark, name)).format("parquet").saveAsTable(name)
    )
    days = spark.table(name).filter("dy BETWEEN 10 AND 12")
    return days.groupBy("y", "m", "dy", "h").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
