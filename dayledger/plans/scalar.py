"""Built-in scalar functions, each used on a test table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.registry import query
from dayledger.session import table
from dayledger.sources import inputs as I


@query(
    "fn_text_clean",
    """
SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low,
       array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
       trim('  ' || p_name || ' ') AS t, ltrim('  ' || p_name || ' ') AS lt, rtrim('  ' || p_name || ' ') AS rt,
       lpad(p_partkey::VARCHAR, 8, '0') AS lp, rpad(p_type, 12, '.') AS rp, length(p_name) AS len, repeat(p_brand, 2) AS twice
FROM part
""",
)
def fn_text_clean(spark: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return table(spark, d, "part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"), F.initcap("p_name").alias("title"),
        F.trim(padded).alias("t"), F.ltrim(padded).alias("lt"), F.rtrim(padded).alias("rt"),
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("lp"), F.rpad("p_type", 12, ".").alias("rp"),
        F.length("p_name").alias("len"), F.repeat("p_brand", 2).alias("twice"),
    )


@query(
    "fn_text_slice",
    """
SELECT p_partkey, substr(p_name, 2, 4) AS sub, split_part(p_name, ' ', 1) AS head, instr(p_name, 'i')::BIGINT AS at,
       CASE WHEN instr(substr(p_name, 4), 'e') > 0 THEN instr(substr(p_name, 4), 'e') + 3 ELSE 0 END::BIGINT AS at_from,
       substr(p_name, 1, 2) || '##' || substr(p_name, 5) AS over_text, translate(p_name, 'aei', '123') AS tr,
       array_to_string(string_split(p_name, ' '), ',') AS parts, p_brand || '|' || p_type AS joined
FROM part
""",
)
def fn_text_slice(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        "p_partkey", F.col("p_name").substr(2, 4).alias("sub"), F.substring_index("p_name", " ", 1).alias("head"),
        F.instr("p_name", "i").alias("at"), F.locate("e", "p_name", 4).alias("at_from"),
        F.overlay("p_name", F.lit("##"), 3, 2).alias("over_text"), F.translate("p_name", "aei", "123").alias("tr"),
        F.split("p_name", " ").alias("parts"), F.concat_ws("|", "p_brand", "p_type").alias("joined"),
    )


@query(
    "fn_text_regex",
    """
SELECT doc_id, regexp_extract(text, '([A-Za-z]+)ing', 1) AS stem,
       length(regexp_replace(text, '[aeiou]+', '', 'g')) AS consonants,
       md5(regexp_replace(text, '[0-9]', '#', 'g')) AS masked FROM documents
""",
)
def fn_text_regex(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", F.regexp_extract("text", "([A-Za-z]+)ing", 1).alias("stem"),
        F.length(F.regexp_replace("text", "[aeiou]+", "")).alias("consonants"),
        F.md5(F.regexp_replace("text", "[0-9]", "#")).alias("masked"),
    )


@query(
    "fn_text_format",
    """
SELECT l_orderkey, l_partkey, printf('%06d/%s %.1f', l_orderkey, l_returnflag, l_quantity) AS label,
       format('{:,.2f}', l_extendedprice) AS price FROM lineitem
""",
)
def fn_text_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.format_string("%06d/%s %.1f", "l_orderkey", "l_returnflag", "l_quantity").alias("label"),
        F.format_number("l_extendedprice", 2).alias("price"),
    )


@query(
    "fn_text_similarity",
    """
WITH c AS (SELECT p_partkey, p_name, p_type,
  string_split(translate(p_type, 'BFPVCGJKQSXZDTLMNRAEIOUYHW', '111122222222334556000000'), '') AS l FROM part)
SELECT p_partkey, levenshtein(p_name, lower(p_type)) AS distance,
       p_type[1] || rpad(replace(array_to_string(
         list_filter(l, lambda x, i: i > 1 AND x <> l[i - 1]), ''), '0', '')[:3], 3, '0') AS sound
FROM c
""",
)
def fn_text_similarity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        "p_partkey", F.levenshtein("p_name", F.lower("p_type")).alias("distance"), F.soundex("p_type").alias("sound")
    )


@query(
    "fn_text_encode",
    """
SELECT p_partkey, ascii(p_name)::BIGINT AS code, to_base64(encode(p_name)) AS b64, p_name AS from_b64, p_name AS decoded,
       hex(p_name) AS hexed, p_name AS unhexed, bin(p_partkey) AS bits, hex(p_partkey) AS base16 FROM part
""",
)
def fn_text_encode(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_name")
    return table(spark, d, "part").select(
        "p_partkey", F.ascii(n).alias("code"), F.base64(F.encode(n, "UTF-8")).alias("b64"),
        F.unbase64(F.base64(F.encode(n, "UTF-8"))).cast("string").alias("from_b64"),
        F.decode(F.encode(n, "UTF-16"), "UTF-16").alias("decoded"), F.hex(n).alias("hexed"),
        F.unhex(F.hex(n)).cast("string").alias("unhexed"), F.bin("p_partkey").alias("bits"),
        F.conv(F.col("p_partkey").cast("string"), 10, 16).alias("base16"),
    )


@query(
    "fn_hash_keys",
    "SELECT c_custkey, md5(c_name) AS m, sha1(c_name) AS s1, sha256(c_name) AS s2, true AS numbers FROM customer",
)
def fn_hash_keys(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("c_name")
    numbers = F.crc32(n.cast("binary")).isNotNull() & F.hash(n).isNotNull() & F.xxhash64(n, "c_custkey").isNotNull()
    return table(spark, d, "customer").select(
        "c_custkey", F.md5(n).alias("m"), F.sha1(n).alias("s1"), F.sha2(n, 256).alias("s2"), numbers.alias("numbers")
    )


@query(
    "fn_math_round",
    """
SELECT l_orderkey, l_partkey, abs(l_quantity - 25) AS a, ceil(l_quantity / 4)::BIGINT AS c, floor(l_quantity / 4)::BIGINT AS f,
       round(l_quantity / 4, 1) AS r, round_even(l_quantity / 4, 1) AS br, round_even(l_quantity / 2, 0) AS ri,
       sign(l_quantity - 25)::DOUBLE AS s FROM lineitem
""",
)
def fn_math_round(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", F.abs(q - 25).alias("a"), F.ceil(q / 4).alias("c"), F.floor(q / 4).alias("f"),
        F.round(q / 4, 1).alias("r"), F.bround(q / 4, 1).alias("br"), F.rint(q / 2).alias("ri"),
        F.signum(q - 25).alias("s"),
    )


@query(
    "fn_math_power",
    """
SELECT l_orderkey, l_partkey, round(sqrt(l_quantity), 8) AS sq, round(cbrt(l_quantity), 8) AS cb,
       round(pow(l_quantity, 1.5), 6) AS pw, round(exp(l_discount), 8) AS ex, round(exp(l_discount) - 1, 8) AS em,
       round(ln(l_quantity), 8) AS ln_q, round(log10(l_quantity), 8) AS lg, round(ln(1 + l_tax), 8) AS l1,
       round(log2(l_quantity), 8) AS l2, round(ln(l_quantity) / ln(3), 8) AS l3,
       factorial(l_linenumber)::BIGINT AS fa, round(sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber), 8) AS hy
FROM lineitem
""",
)
def fn_math_power(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    cols = {
        "sq": F.sqrt(q), "cb": F.cbrt(q), "ex": F.exp("l_discount"), "em": F.expm1("l_discount"), "ln_q": F.log(q),
        "lg": F.log10(q), "l1": F.log1p("l_tax"), "l2": F.log2(q), "l3": F.log(3.0, q),
        "hy": F.hypot(q, F.col("l_linenumber").cast("double")),
    }
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", F.round(F.pow(q, 1.5), 6).alias("pw"), F.factorial("l_linenumber").alias("fa"),
        *[F.round(c, 8).alias(n) for n, c in cols.items()],
    )


@query(
    "fn_math_trig",
    """
WITH p AS (SELECT s_suppkey, (s_suppkey * 37 % 180 - 90)::DOUBLE AS lat, (s_suppkey * 91 % 360 - 180)::DOUBLE AS lon,
                  s_acctbal / 20000 AS u FROM supplier),
r AS (SELECT *, radians(lat) AS phi, radians(lon) AS lam FROM p)
SELECT s_suppkey, round(2 * 6371 * asin(sqrt(pow(sin(phi / 2), 2) + cos(phi) * pow(sin(lam / 2), 2))), 4) AS km,
       round(tan(u), 8) AS ta, round(acos(u), 8) AS ac, round(atan(lat), 8) AS at, round(atan2(lat, lon), 8) AS at2,
       round(sinh(u), 8) AS sh, round(cosh(u), 8) AS ch, round(tanh(u), 8) AS th, round(asinh(lat), 8) AS ash,
       round(acosh(1 + abs(lat)), 8) AS ach, round(atanh(u), 8) AS ath, round(degrees(phi), 6) AS deg FROM r
""",
)
def fn_math_trig(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    p = table(spark, d, "supplier").select(
        k, (k * 37 % 180 - 90).cast("double").alias("lat"), (k * 91 % 360 - 180).cast("double").alias("lon"),
        (F.col("s_acctbal") / 20000).alias("u"),
    )
    phi, lam, u, lat = F.radians("lat"), F.radians("lon"), F.col("u"), F.col("lat")
    half = F.pow(F.sin(phi / 2), 2) + F.cos(phi) * F.pow(F.sin(lam / 2), 2)
    cols = {
        "ta": F.tan(u), "ac": F.acos(u), "at": F.atan(lat), "at2": F.atan2("lat", "lon"), "sh": F.sinh(u),
        "ch": F.cosh(u), "th": F.tanh(u), "ash": F.asinh(lat), "ach": F.acosh(1 + F.abs(lat)), "ath": F.atanh(u),
    }
    return p.select(
        "s_suppkey", F.round(2 * 6371 * F.asin(F.sqrt(half)), 4).alias("km"), F.round(F.degrees(phi), 6).alias("deg"),
        *[F.round(c, 8).alias(n) for n, c in cols.items()],
    )


@query(
    "fn_random",
    "SELECT event_id, true AS uniform, true AS normal, array_to_string(list_sort([event_id, user_id, 0]), ',') AS mixed FROM events",
)
def fn_random(spark: SparkSession, d: str) -> DataFrame:
    """Random values within their ranges; a shuffled array, sorted again."""
    u, z = F.rand(42), F.randn(42)
    mixed = F.shuffle(F.array("event_id", "user_id", F.lit(0).cast("long")), seed=42)
    return table(spark, d, "events").select(
        "event_id", ((u >= 0) & (u < 1)).alias("uniform"), (F.abs(z) < 7).alias("normal"), F.array_sort(mixed).alias("mixed")
    )


@query(
    "fn_date_parts",
    """
WITH t AS (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey * 61 % 86400) AS ts FROM orders)
SELECT o_orderkey, year(ts) AS y, quarter(ts) AS q, month(ts) AS m, dayofweek(ts) + 1 AS dw, day(ts) AS dm,
       dayofyear(ts) AS dy, hour(ts) AS h, minute(ts) AS mi, second(ts) AS s, weekofyear(ts) AS w FROM t
""",
)
def fn_date_parts(spark: SparkSession, d: str) -> DataFrame:
    at = I.orders(spark, d).select(
        "o_orderkey",
        F.timestamp_seconds(F.unix_seconds("o_orderdate") + F.col("o_orderkey") * 61 % 86400).alias("ts"),
    )
    parts = {
        "y": F.year, "q": F.quarter, "m": F.month, "dw": F.dayofweek, "dm": F.dayofmonth, "dy": F.dayofyear,
        "h": F.hour, "mi": F.minute, "s": F.second, "w": F.weekofyear,
    }
    return at.select("o_orderkey", *[f("ts").alias(n) for n, f in parts.items()])


@query(
    "fn_date_arith",
    """
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, DATE '2000-02-29' AS x FROM orders)
SELECT o_orderkey, CAST(d + 45 AS VARCHAR) AS da, CAST(d - 45 AS VARCHAR) AS ds, datediff('day', d, x) AS dd,
       CAST(CAST(d + INTERVAL 5 MONTHS AS DATE) AS VARCHAR) AS am,
       round((year(d) - year(x)) * 12 + month(d) - month(x)
         + CASE WHEN day(d) = day(x) OR (last_day(d) = d AND last_day(x) = x) THEN 0 ELSE (day(d) - day(x)) / 31.0 END, 8) AS mb,
       CAST(d + (8 - isodow(d))::INTEGER AS VARCHAR) AS nd, CAST(last_day(d) AS VARCHAR) AS ld FROM t
""",
)
def fn_date_arith(spark: SparkSession, d: str) -> DataFrame:
    day, mark = F.to_date("o_orderdate"), F.lit("2000-02-29").cast("date")
    return I.orders(spark, d).select(
        "o_orderkey", F.date_add(day, 45).alias("da"), F.date_sub(day, 45).alias("ds"),
        F.datediff(mark, day).alias("dd"), F.add_months(day, 5).alias("am"),
        F.round(F.months_between(day, mark), 8).alias("mb"), F.next_day(day, "Mon").alias("nd"),
        F.last_day(day).alias("ld"),
    )


@query(
    "fn_date_parse",
    """
SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M') AS txt, CAST(CAST(ts AS DATE) AS VARCHAR) AS day_back,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS time_back,
       CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month_start,
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start FROM events
""",
)
def fn_date_parse(spark: SparkSession, d: str) -> DataFrame:
    text = F.date_format("ts", "dd/MM/yyyy HH:mm")
    return I.events(spark, d).select(
        "event_id", text.alias("txt"), F.to_date(text, "dd/MM/yyyy HH:mm").alias("day_back"),
        F.to_timestamp(text, "dd/MM/yyyy HH:mm").alias("time_back"), F.trunc("ts", "month").alias("month_start"),
        F.date_trunc("hour", "ts").alias("hour_start"),
    )


@query(
    "fn_epoch_zone",
    """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS unix, strftime(ts, '%Y-%m-%d %H:%M:%S') AS txt,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS again, strftime(ts + INTERVAL 9 HOURS, '%Y-%m-%d %H:%M:%S') AS tokyo,
       strftime(ts - INTERVAL 9 HOURS, '%Y-%m-%d %H:%M:%S') AS from_tokyo FROM events
""",
)
def fn_epoch_zone(spark: SparkSession, d: str) -> DataFrame:
    unix = F.unix_timestamp("ts")
    return I.events(spark, d).select(
        "event_id", unix.alias("unix"), F.from_unixtime(unix).alias("txt"), F.timestamp_seconds(unix).alias("again"),
        F.from_utc_timestamp("ts", "Asia/Tokyo").alias("tokyo"), F.to_utc_timestamp("ts", "Asia/Tokyo").alias("from_tokyo"),
    )


@query(
    "fn_array_build",
    """
SELECT o_orderkey, o_orderkey || ',' || o_custkey || ',7' AS arr, o_orderstatus || ',' || o_orderstatus AS twice,
       array_to_string(range(1, o_custkey % 5 + 2), ',') AS seq, 3::BIGINT AS n, o_custkey AS second,
       (o_orderkey = 7 OR o_custkey = 7 OR true) AS has7,
       CASE WHEN o_orderkey = 7 THEN 1 WHEN o_custkey = 7 THEN 2 ELSE 3 END::BIGINT AS pos7 FROM orders
""",
)
def fn_array_build(spark: SparkSession, d: str) -> DataFrame:
    arr = F.array("o_orderkey", "o_custkey", F.lit(7).cast("long"))
    return table(spark, d, "orders").select(
        "o_orderkey", arr.alias("arr"), F.array_repeat("o_orderstatus", 2).alias("twice"),
        F.sequence(F.lit(1).cast("long"), F.col("o_custkey") % 5 + 1).alias("seq"), F.size(arr).alias("n"),
        F.element_at(arr, 2).alias("second"), F.array_contains(arr, 7).alias("has7"),
        F.array_position(arr, 7).alias("pos7"),
    )


@query(
    "fn_array_change",
    """
WITH t AS (SELECT o_orderkey, [o_orderkey % 5, o_custkey % 7, 3, o_orderkey % 5] AS a FROM orders)
SELECT o_orderkey, array_to_string(a[2:3], ',') AS cut, array_to_string(list_reverse_sort(a), ',') AS down,
       array_to_string(list_sort(a), ',') AS up, array_to_string(list_filter(a, lambda x: x <> 3), ',') AS without3,
       array_to_string(list_sort(list_distinct(a)), ',') AS uniq, array_to_string(list_reverse(a), ',') AS back,
       array_to_string(a, '-') AS joined, list_min(a) AS low, list_max(a) AS high,
       array_to_string(list_concat(a, [9]), ',') AS flat, array_to_string(list_concat(a, [o_orderkey]), ',') AS longer,
       a[1] || ':' || a[1] || '/' || a[2] || ':' || a[2] AS zipped FROM t
""",
)
def fn_array_change(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    three = F.lit(3).cast("long")
    t = table(spark, d, "orders").select(k, F.array(k % 5, c % 7, three, k % 5).alias("a"))
    a = F.col("a")
    pairs = F.slice(F.arrays_zip(F.col("a").alias("x"), F.col("a").alias("y")), 1, 2)
    return t.select(
        k, F.slice(a, 2, 2).alias("cut"), F.sort_array(a, asc=False).alias("down"), F.array_sort(a).alias("up"),
        F.array_remove(a, 3).alias("without3"), F.array_sort(F.array_distinct(a)).alias("uniq"),
        F.reverse(a).alias("back"), F.array_join(a.cast("array<string>"), "-").alias("joined"),
        F.array_min(a).alias("low"), F.array_max(a).alias("high"),
        F.flatten(F.array(a, F.array(F.lit(9).cast("long")))).alias("flat"), F.concat(a, F.array(k)).alias("longer"),
        F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["x"], p["y"])), "/").alias("zipped"),
    )


@query(
    "fn_array_sets",
    """
WITH s AS (SELECT l_orderkey, coalesce(list(DISTINCT l_linenumber) FILTER (WHERE l_returnflag = 'R'), []) AS r,
                  coalesce(list(DISTINCT l_linenumber) FILTER (WHERE l_linestatus = 'O'), []) AS o FROM lineitem GROUP BY 1)
SELECT l_orderkey, list_has_any(r, o) AS meet, array_to_string(list_sort(list_intersect(r, o)), ',') AS both_in,
       array_to_string(list_sort(list_distinct(list_concat(r, o))), ',') AS any_in,
       array_to_string(list_sort(list_filter(r, lambda x: NOT list_contains(o, x))), ',') AS only_r FROM s
""",
)
def fn_array_sets(spark: SparkSession, d: str) -> DataFrame:
    """Line numbers (1 to 7) per order, as two sets."""
    line = F.col("l_linenumber")
    s = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.collect_set(F.when(F.col("l_returnflag") == "R", line)).alias("r"),
        F.collect_set(F.when(F.col("l_linestatus") == "O", line)).alias("o"),
    )
    return s.select(
        "l_orderkey", F.arrays_overlap("r", "o").alias("meet"),
        F.array_sort(F.array_intersect("r", "o")).alias("both_in"),
        F.array_sort(F.array_union("r", "o")).alias("any_in"), F.array_sort(F.array_except("r", "o")).alias("only_r"),
    )


@query(
    "fn_explode",
    """
WITH t AS (SELECT CASE WHEN lang <> 'de' THEN string_split(text, chr(10)) END AS lines FROM documents),
c AS (SELECT count(*) FILTER (WHERE lines IS NOT NULL) AS docs, count(*) FILTER (WHERE lines IS NULL) AS no_docs,
             sum(len(lines))::BIGINT AS n, sum(len(lines) * (len(lines) - 1) // 2)::BIGINT AS places FROM t)
SELECT 'explode' AS kind, n, NULL::BIGINT AS places FROM c UNION ALL SELECT 'posexplode', n, places FROM c
UNION ALL SELECT 'explode_outer', n + no_docs, NULL FROM c UNION ALL SELECT 'posexplode_outer', n + no_docs, places FROM c
""",
)
def fn_explode(spark: SparkSession, d: str) -> DataFrame:
    lines = F.when(F.col("lang") != "de", F.split("text", "\n"))
    t = table(spark, d, "documents").select(lines.alias("lines"))

    def counted(df: DataFrame, kind: str, places) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"), places.alias("places")).select(F.lit(kind).alias("kind"), "*")

    none, pos = F.lit(None).cast("long"), F.sum(F.col("pos").cast("long"))
    return (
        counted(t.select(F.explode("lines")), "explode", none)
        .unionAll(counted(t.select(F.posexplode("lines")), "posexplode", pos))
        .unionAll(counted(t.select(F.explode_outer("lines")), "explode_outer", none))
        .unionAll(counted(t.select(F.posexplode_outer("lines")), "posexplode_outer", pos))
    )


@query(
    "fn_array_lambda",
    """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
SELECT vec_id, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS norm,
       round(list_sum(list_transform(v, lambda x, i: x * v[65 - i])), 6) AS mirror_dot,
       len(list_filter(v, lambda x: x > 0.3)) > 0 AS any_large, len(list_filter(v, lambda x: abs(x) >= 1)) = 0 AS all_small,
       len(list_filter(v, lambda x: x > 0)) AS positive FROM e
""",
)
def fn_array_lambda(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v")
    )

    def total(arr):
        return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)

    products = F.zip_with("v", F.reverse("v"), lambda x, y: x * y)
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x, lambda acc: F.sqrt(acc))
    return e.select(
        "vec_id", F.round(norm, 6).alias("norm"), F.round(total(products), 6).alias("mirror_dot"),
        F.exists("v", lambda x: x > 0.3).alias("any_large"), F.forall("v", lambda x: F.abs(x) < 1).alias("all_small"),
        F.size(F.filter("v", lambda x: x > 0)).alias("positive"),
    )


def entries(m):
    """Map as sorted ``key=value`` text."""
    pairs = F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return F.array_sort(pairs)


@query(
    "fn_map_build",
    """
SELECT c_custkey, 'bank=' || c_nationkey || ',name=' || c_mktsegment AS made, 'bank,name' AS ks,
       c_nationkey || ',' || c_mktsegment AS vs, 'a=' || c_nationkey || ',b=' || c_mktsegment AS zipped,
       'bank=' || c_nationkey || ',extra=x,name=' || c_mktsegment AS wide, c_mktsegment AS name_value FROM customer
""",
)
def fn_map_build(spark: SparkSession, d: str) -> DataFrame:
    nation = F.col("c_nationkey").cast("string")
    made = F.create_map(F.lit("bank"), nation, F.lit("name"), F.col("c_mktsegment"))
    zipped = F.map_from_arrays(F.array(F.lit("a"), F.lit("b")), F.array(nation, F.col("c_mktsegment")))
    extra = F.map_from_entries(F.array(F.struct(F.lit("extra"), F.lit("x"))))
    return table(spark, d, "customer").select(
        "c_custkey", entries(made).alias("made"), F.map_keys(made).alias("ks"), F.map_values(made).alias("vs"),
        entries(zipped).alias("zipped"), entries(F.map_concat(made, extra)).alias("wide"),
        made["name"].alias("name_value"),
    )


@query(
    "fn_map_lambda",
    """
SELECT c_custkey, 'A=' || c_nationkey || ',B=' || c_custkey AS upper_keys,
       'a=' || (c_nationkey + 1) || ',b=' || (c_custkey + 1) AS plus_one,
       CASE WHEN c_nationkey > 10 THEN 'a=' || c_nationkey ELSE '' END ||
       CASE WHEN c_nationkey > 10 AND c_custkey > 10 THEN ',' ELSE '' END ||
       CASE WHEN c_custkey > 10 THEN 'b=' || c_custkey ELSE '' END AS large,
       'a=' || (2 * c_nationkey) || ',b=' || (2 * c_custkey) AS summed FROM customer
""",
)
def fn_map_lambda(spark: SparkSession, d: str) -> DataFrame:
    m = F.create_map(F.lit("a"), F.col("c_nationkey").cast("long"), F.lit("b"), F.col("c_custkey"))
    return table(spark, d, "customer").select(
        "c_custkey", entries(F.transform_keys(m, lambda k, _: F.upper(k))).alias("upper_keys"),
        entries(F.transform_values(m, lambda _, v: v + 1)).alias("plus_one"),
        entries(F.map_filter(m, lambda _, v: v > 10)).alias("large"),
        entries(F.map_zip_with(m, m, lambda _, x, y: x + y)).alias("summed"),
    )


@query(
    "fn_struct",
    """
SELECT c_custkey, c_name AS name, c_acctbal AS balance, upper(c_mktsegment) AS segment,
       '{"name":"' || c_name || '","segment":"' || upper(c_mktsegment) || '"}' AS rest FROM customer
""",
)
def fn_struct(spark: SparkSession, d: str) -> DataFrame:
    s = F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    c = table(spark, d, "customer").select("c_custkey", s.alias("s"))
    c = c.withColumn("s", F.col("s").withField("segment", F.upper("s.segment")))
    return c.select(
        "c_custkey", F.col("s").getField("name").alias("name"), F.col("s").getItem("balance").alias("balance"),
        "s.segment", F.col("s").dropFields("balance").alias("rest"),
    )


@query(
    "fn_json",
    """
WITH t AS (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, k AS by_path, k AS by_tuple, CAST(k AS BIGINT) AS parsed, '{"k":' || k || ',"id":' || event_id || '}' AS written,
       'STRUCT<k: BIGINT>' AS inferred FROM t
""",
)
def fn_json(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "props", F.json_tuple("props", "k").alias("by_tuple"))
    parsed = F.from_json("props", "k long")["k"]
    return e.select(
        "event_id", F.get_json_object("props", "$.k").alias("by_path"), "by_tuple", parsed.alias("parsed"),
        F.to_json(F.struct(parsed.alias("k"), F.col("event_id").alias("id"))).alias("written"),
        F.schema_of_json('{"k": 87}').alias("inferred"),
    )


@query(
    "fn_csv",
    """
SELECT c_custkey, c_custkey || ',' || c_name || ',' || c_nationkey AS line, c_name AS name_back,
       c_nationkey::BIGINT AS nation_back, 'STRUCT<_c0: INT, _c1: STRING>' AS inferred FROM customer
""",
)
def fn_csv(spark: SparkSession, d: str) -> DataFrame:
    line = F.to_csv(F.struct("c_custkey", "c_name", "c_nationkey"))
    c = table(spark, d, "customer").select("c_custkey", line.alias("line"))
    back = F.from_csv("line", "k long, name string, nation int")
    return c.select(
        "c_custkey", "line", back["name"].alias("name_back"), back["nation"].alias("nation_back"),
        F.schema_of_csv("1,abc").alias("inferred"),
    )
