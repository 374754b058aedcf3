"""Projections, filters, predicates and row hygiene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.registry import query
from dayledger.session import materialize, parts_for, table
from dayledger.sources import inputs as I


@query(
    "project_rename",
    "SELECT c_custkey AS id, c_name AS customer_name, c_acctbal AS balance, c_mktsegment AS segment, "
    "(c_nationkey + 1000)::BIGINT AS nation_code FROM customer",
)
def project_rename(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return (
        c.select(c.colRegex("`c_.*`"))
        .withColumn("nation_code", F.col("c_nationkey").cast("long") + 1000)
        .withColumnRenamed("c_name", "customer_name")
        .drop("c_nationkey")
        .toDF("id", "customer_name", "balance", "segment", "nation_code")
    )


@query(
    "project_expr",
    """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS gross, 'EUR' AS currency,
       upper(l_returnflag) || '/' || l_linestatus AS mark
FROM lineitem
""",
)
def project_expr(spark: SparkSession, d: str) -> DataFrame:
    def priced(df: DataFrame) -> DataFrame:
        return df.selectExpr(
            "*", "l_extendedprice * (1 - l_discount) AS raw_net", "upper(l_returnflag) || '/' || l_linestatus AS mark"
        )

    def finished(df: DataFrame) -> DataFrame:
        return df.select(
            "l_orderkey", "l_linenumber", F.round("raw_net", 4).alias("net"),
            F.expr("round(raw_net * (1 + l_tax), 6)").alias("gross"), F.lit("EUR").alias("currency"), "mark",
        )

    return table(spark, d, "lineitem").transform(priced).transform(finished)


@query(
    "arith_ops",
    """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity + 1 AS plus, l_quantity - 1 AS minus,
       round(l_quantity * l_discount, 4) AS times,
       round(CASE WHEN l_tax <> 0 THEN l_quantity / l_tax END, 6) AS ratio,
       l_orderkey % 7 AS modulo, -l_quantity AS negated, round(pow(l_quantity, 2), 2) AS squared
FROM lineitem
""",
)
def arith_ops(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (q + 1).alias("plus"), (q - 1).alias("minus"),
        F.round(q * F.col("l_discount"), 4).alias("times"),
        F.round(F.try_divide(q, F.col("l_tax")), 6).alias("ratio"),
        (F.col("l_orderkey") % 7).alias("modulo"), (-q).alias("negated"), F.round(q**2, 2).alias("squared"),
    )


@query(
    "filter_compare",
    """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE (l_quantity > 10 AND l_quantity <= 40) AND NOT (l_returnflag = 'R') AND (l_discount < 0.03 OR l_tax >= 0.07)
  AND l_linenumber <> 2 AND nullif(l_linestatus, 'O') IS NOT DISTINCT FROM NULL
""",
)
def filter_compare(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    open_line = F.when(F.col("l_linestatus") != "O", F.col("l_linestatus"))
    return (
        table(spark, d, "lineitem")
        .filter((q > 10) & (q <= 40) & ~(F.col("l_returnflag") == "R"))
        .filter((F.col("l_discount") < 0.03) | (F.col("l_tax") >= 0.07))
        .filter((F.col("l_linenumber") != 2) & open_line.eqNullSafe(F.lit(None)))
        .select("l_orderkey", "l_partkey", "l_quantity")
    )


@query(
    "filter_set_range",
    "SELECT p_partkey, p_brand, p_size::BIGINT AS p_size FROM part "
    "WHERE p_brand IN ('Brand#2', 'Brand#13', 'Brand#17') AND p_size BETWEEN 5 AND 30",
)
def filter_set_range(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    keep = p.p_brand.isin("Brand#2", "Brand#13", "Brand#17") & p.p_size.between(5, 30)
    return p.filter(keep).select("p_partkey", "p_brand", "p_size")


@query(
    "filter_text",
    """
SELECT p_partkey, p_name, p_type FROM part
WHERE contains(p_name, 'ring') OR starts_with(p_name, 'red') OR ends_with(p_name, 'bolt')
   OR p_name LIKE '%l__ w%' OR regexp_matches(p_type, '^(PROMO|SMALL)$')
""",
)
def filter_text(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_name")
    keep = n.contains("ring") | n.startswith("red") | n.endswith("bolt") | n.like("%l__ w%")
    keep = keep | F.col("p_type").rlike("^(PROMO|SMALL)$")
    return table(spark, d, "part").filter(keep).select("p_partkey", "p_name", "p_type")


LATE_ORDERS_SQL = (
    "customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top_price, max(o_orderstatus) AS top_status FROM orders "
    "WHERE o_orderdate >= DATE '2001-01-01' GROUP BY 1) ON c_custkey = o_custkey"
)


def late_orders(spark: SparkSession, d: str) -> DataFrame:
    """Customers with their largest order of 2001; null where there is none."""
    o = (
        table(spark, d, "orders")
        .filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
        .groupBy("o_custkey")
        .agg(F.max("o_totalprice").alias("top_price"), F.max("o_orderstatus").alias("top_status"))
    )
    return table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")


@query(
    "filter_null",
    f"""
SELECT c_custkey, top_price IS NULL AS no_order, top_price IS NOT NULL AS has_order, c_acctbal < 0 AS bad_number
FROM {LATE_ORDERS_SQL} WHERE top_price IS NULL OR c_acctbal < 0
""",
)
def filter_null(spark: SparkSession, d: str) -> DataFrame:
    number = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    df = late_orders(spark, d).withColumn("number", number)
    return df.filter(F.isnull("top_price") | F.isnan("number")).select(
        "c_custkey", F.col("top_price").isNull().alias("no_order"), F.col("top_price").isNotNull().alias("has_order"),
        F.isnan("number").alias("bad_number"),
    )


@query(
    "case_when",
    """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_totalprice > 150000 THEN 'middle'
       ELSE 'small' END AS size_class, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END::BIGINT AS status_code
FROM orders
""",
)
def case_when(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(price > 400000, "large").when(price > 150000, "middle").otherwise("small").alias("size_class"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).alias("status_code"),
    )


@query(
    "null_choice",
    f"""
SELECT c_custkey, coalesce(top_price, c_acctbal) AS first_known,
       CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS number,
       greatest(c_acctbal, c_nationkey::DOUBLE, top_price) AS largest,
       least(c_acctbal, c_nationkey::DOUBLE, top_price) AS smallest
FROM {LATE_ORDERS_SQL}
""",
)
def null_choice(spark: SparkSession, d: str) -> DataFrame:
    number = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    three = ["c_acctbal", "nation", "top_price"]
    return (
        late_orders(spark, d)
        .withColumn("nation", F.col("c_nationkey").cast("double"))
        .select(
            "c_custkey", F.coalesce("top_price", "c_acctbal").alias("first_known"),
            F.nanvl(number, F.lit(0.0)).alias("number"), F.greatest(*three).alias("largest"),
            F.least(*three).alias("smallest"),
        )
    )


@query(
    "cast_types",
    """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_orderkey AS VARCHAR) AS key_text,
       CAST(trunc(l_extendedprice) AS BIGINT) AS whole, l_quantity > 25 AS flag,
       TRY_CAST(l_returnflag AS INTEGER)::BIGINT AS bad_number, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day,
       CAST(CAST(l_discount AS DECIMAL(6, 3)) AS DOUBLE) AS disc
FROM lineitem
""",
)
def cast_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("key_text"),
        F.col("l_extendedprice").cast("long").alias("whole"),
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).cast("boolean").alias("flag"),
        F.col("l_returnflag").try_cast("int").alias("bad_number"), F.col("l_shipdate").cast("date").alias("ship_day"),
        F.col("l_discount").cast("decimal(6,3)").alias("disc"),
    )


@query(
    "bit_ops",
    """
SELECT o_orderkey, o_orderkey & 255 AS b_and, o_orderkey | 1024 AS b_or, xor(o_orderkey, 77::BIGINT) AS b_xor,
       ~o_orderkey AS b_not, o_orderkey * 4 AS s_left, o_orderkey >> 2 AS s_right, o_orderkey >> 3 AS s_right_u
FROM orders
""",
)
def bit_ops(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        k, k.bitwiseAND(255).alias("b_and"), k.bitwiseOR(1024).alias("b_or"), k.bitwiseXOR(77).alias("b_xor"),
        F.bitwise_not(k).alias("b_not"), F.shiftleft(k, 2).alias("s_left"), F.shiftright(k, 2).alias("s_right"),
        F.shiftrightunsigned(k, 3).alias("s_right_u"),
    )


@query(
    "na_drop_fill_replace",
    f"""
SELECT c_custkey, coalesce(top_price, 0.0) AS top_price, coalesce(top_status, 'none') AS top_status,
       CASE segment WHEN 'MACHINERY' THEN 'MACHINES' WHEN 'HOUSEHOLD' THEN 'HOME' ELSE segment END AS segment
FROM (SELECT *, nullif(c_mktsegment, 'BUILDING') AS segment FROM {LATE_ORDERS_SQL})
WHERE NOT (top_price IS NULL AND segment IS NULL) AND segment IS NOT NULL
""",
)
def na_drop_fill_replace(spark: SparkSession, d: str) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    df = late_orders(spark, d).select("c_custkey", "top_price", "top_status", segment.alias("segment"))
    return (
        df.na.drop(thresh=2)
        .na.drop(how="all", subset=["top_price", "segment"])
        .na.drop(subset=["segment"])
        .na.fill({"top_price": 0.0, "top_status": "none"})
        .na.replace({"MACHINERY": "MACHINES", "HOUSEHOLD": "HOME"}, subset=["segment"])
    )


@query(
    "dedup_rows",
    "SELECT min(doc_id) AS doc_id, count(*) AS copies, arg_min(lang, doc_id) AS lang FROM documents GROUP BY text",
)
def dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per text, that of the smallest id. Texts are hashed first, so that only digests move."""
    docs = table(spark, d, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("digest"))
    return docs.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min_by("lang", "doc_id").alias("lang")
    ).drop("digest")


SHARES = {"bernoulli": 0.1, "with_repeats": 0.5, "train": 0.8, "test": 0.2}
STRATA = {"click": 0.2, "view": 0.05}


@query(
    "sample_rows",
    "SELECT event_type, count(*) AS n, count(*) AS split_n, true AS bernoulli, true AS with_repeats, true AS stratified, "
    "true AS train, true AS test FROM events GROUP BY 1",
)
def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    """Bernoulli and stratified samples and a weighted split per event type: the split gives all rows, and each sample
    has its share but for six standard deviations."""
    e = table(spark, d, "events").select("event_id", "event_type")
    train, test = e.randomSplit([0.8, 0.2], seed=42)
    parts = {
        "bernoulli": e.sample(fraction=0.1, seed=42),
        "with_repeats": e.sample(withReplacement=True, fraction=0.5, seed=42),
        "stratified": e.sampleBy("event_type", STRATA, seed=42),
        "train": train,
        "test": test,
    }
    tagged = [p.select(F.lit(n).alias("sample"), "event_type") for n, p in parts.items()]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionAll(t)
    counts = out.groupBy("event_type").pivot("sample", list(parts)).count().na.fill(0)
    counts = e.groupBy("event_type").agg(F.count("*").alias("n")).join(counts, "event_type")
    strata = F.coalesce(F.create_map(*[F.lit(x) for kv in STRATA.items() for x in kv])[F.col("event_type")], F.lit(0.0))

    def near(sample: str, share) -> Column:
        return (F.abs(F.col(sample) - F.col("n") * share) <= 6 * F.sqrt(F.col("n") * share) + 1e-9).alias(sample)

    return counts.select(
        "event_type", "n", (F.col("train") + F.col("test")).alias("split_n"),
        *[near(k, F.lit(x)) for k, x in SHARES.items()], near("stratified", strata),
    )


def gapless_index(df: DataFrame, key: str, name: str = "idx") -> DataFrame:
    """0-based position of each row by a unique key.

    The rows are dealt to ranges of sampled bounds and written with the number
    of their range; a position is a number within the range plus the rows of
    earlier ranges. Ranges are even whatever the keys are.
    """
    ranges = parts_for(df)
    dealt = materialize(df.repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n")).withColumn("_all", F.lit(0))
    before = Window.partitionBy("_all").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    placed = dealt.withColumn("_local", local).join(starts, "_range")
    return placed.withColumn(name, F.col("_local") - 1 + F.col("_before")).drop("_range", "_local", "_before")


@query(
    "row_ids",
    "SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS idx, true AS has_id, true AS has_file FROM customer",
)
def row_ids(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(
        "c_custkey",
        (F.monotonically_increasing_id() >= F.spark_partition_id().cast("long") * F.lit(1 << 33)).alias("has_id"),
        F.input_file_name().contains("customer").alias("has_file"),
    )
    return gapless_index(c, "c_custkey").select("c_custkey", "idx", "has_id", "has_file")


@query(
    "layout_partitions",
    "SELECT layout, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem, "
    "(VALUES ('by_key'), ('by_range'), ('fewer')) v(layout) GROUP BY layout",
)
def layout_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The same rows in three layouts. The hash layout adds the line to the supplier, so a hot supplier spreads."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity")
    n = spark.sparkContext.defaultParallelism
    layouts = {
        "by_key": li.repartition(n, "l_suppkey", "l_orderkey").sortWithinPartitions("l_suppkey", "l_shipdate"),
        "by_range": li.repartitionByRange(n, "l_shipdate", "l_orderkey", "l_linenumber"),
        "fewer": li.coalesce(max(1, n // 2)),
    }
    parts = [
        df.withColumn("part", F.spark_partition_id()).groupBy("part")
        .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
        .agg(F.sum("n").alias("n"), F.sum("quantity").alias("quantity"))
        .select(F.lit(name).alias("layout"), "n", "quantity")
        for name, df in layouts.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("quality_assert", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def quality_assert(spark: SparkSession, d: str) -> DataFrame:
    """Fails the job at the first line that breaks a rule."""
    rule = (F.col("l_quantity") > 0) & F.col("l_discount").between(0, 1)
    known = F.when(F.col("l_returnflag").isin("A", "N", "R"), F.lit(None)).otherwise(
        F.raise_error(F.concat(F.lit("unknown flag "), F.col("l_returnflag")))
    )
    checked = table(spark, d, "lineitem").filter(F.assert_true(rule, F.lit("bad line")).isNull() & known.isNull())
    return checked.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query(
    "log_regex_stats",
    """
SELECT '10.0.' || (user_id % 256) || '.1' AS ip, 'u' || user_id AS usr, '/' || event_type AS request,
       count(*) AS n, CAST(sum(CAST(floor(value * 10) AS BIGINT)) AS BIGINT) AS bytes
FROM events GROUP BY ALL
""",
)
def log_regex_stats(spark: SparkSession, d: str) -> DataFrame:
    line = F.format_string(
        '10.0.%d.1 - u%d [%s] "GET /%s HTTP/1.1" 200 %d', F.col("user_id") % 256, F.col("user_id"),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.col("event_type"), F.floor(F.col("value") * 10),
    )
    pattern = r'^(\S+) \S+ (\S+) \[([^\]]+)\] "GET (\S+) [^"]*" (\d+) (\d+)$'
    logs = I.events(spark, d).select(line.alias("line"))
    return (
        logs.select(
            F.regexp_extract("line", pattern, 1).alias("ip"), F.regexp_extract("line", pattern, 2).alias("usr"),
            F.regexp_extract("line", pattern, 4).alias("request"),
            F.regexp_extract("line", pattern, 6).try_cast("long").alias("size"),
        )
        .groupBy("ip", "usr", "request")
        .agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    )


@query(
    "text_grep_count",
    """
SELECT src, count(*) AS n_lines FROM (
  SELECT 'documents' AS src, unnest(string_split(text, chr(10))) AS line FROM documents
  UNION ALL SELECT 'conversations', unnest(string_split(text, chr(10))) FROM conversations
  UNION ALL SELECT 'benchmark', unnest(string_split(text, chr(10))) FROM benchmark)
WHERE contains(line, 'the') GROUP BY src
""",
)
def text_grep_count(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        table(spark, d, n).select(F.lit(n).alias("src"), F.explode(F.split("text", "\n")).alias("line"))
        for n in ("documents", "conversations", "benchmark")
    ]
    lines = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return lines.filter(F.col("line").contains("the")).groupBy("src").agg(F.count("*").alias("n_lines"))
