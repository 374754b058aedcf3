"""Line deduplication by overlapping windows of three lines, in DataFrame operations only.

Each run of three consecutive lines is hashed. Where a run occurs more than
once in the corpus, the occurrence of smallest (doc_id, line) stays and the
lines covered by any other occurrence go. Covered positions are merged, so
that a passage of any length goes as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.frames import boxed
from dayledger.session import materialize

WIDTH = 3


def line_windows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text hash, position, two independent 64-bit hashes) of each window of WIDTH lines with a word in it."""
    lines = docs.filter(F.col(text).isNotNull()).select(
        F.col(key).alias("_id"), F.xxhash64(text).alias("_th"),
        F.transform(F.split(text, "\n"), lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), x.rlike("[^ \\t\\n\\x0B\\f\\r]").alias("w"))).alias("l"),
    ).filter(F.size("l") >= WIDTH)
    at = lines.select("_id", "_th", "l", F.explode(F.sequence(F.lit(0), F.size("l") - WIDTH)).alias("pos"))
    part = [F.col("l")[F.col("pos") + k] for k in range(WIDTH)]
    some = part[0]["w"] | part[1]["w"] | part[2]["w"]
    return at.filter(some).select(
        "_id", "_th", "pos", F.xxhash64(*[p["a"] for p in part]).alias("k1"), F.xxhash64(*[p["b"] for p in part]).alias("k2"),
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with later repeats of three-line passages cut out; adds ``n_lines`` and ``n_removed``.

    Lines are the pieces between line ends. A text of fewer than three lines,
    and runs without a word, stay as they are; a null text stays null with 0
    lines. Rows of equal id and text share their positions, so neither is
    later than the other and both are treated alike; null ids come first.
    Input columns named ``n_lines`` or ``n_removed`` are replaced.

    Hot passages: their first occurrence is found by an aggregate that
    combines before the shuffle, and is written out, so that the join of the
    occurrences with it can split skewed partitions.
    """
    docs = docs.drop("n_lines", "n_removed")
    windows = line_windows(docs, key, text)
    place = F.struct("_id", "_th", "pos")
    first = windows.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    first = materialize(first, "line-firsts")
    later = windows.join(first, ["k1", "k2"]).filter(~((F.col("_id").eqNullSafe(F.col("first._id"))) & (F.col("pos") == F.col("first.pos")) & (F.col("_th") == F.col("first._th"))))
    starts = later.groupBy("_id", "_th").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    # bounds of the merged runs of covered lines; written, so that the arrays are worked out once per document
    cover = materialize(
        starts.select(
            "_id", "_th",
            F.expr(f"filter(p, (x, i) -> i = 0 OR x > p[i - 1] + {WIDTH})").alias("begins"),
            F.expr(f"transform(filter(p, (x, i) -> i = size(p) - 1 OR p[i + 1] > x + {WIDTH}), x -> x + {WIDTH})").alias("ends"),
        ),
        "line-cover",
    )
    own = F.col("row").getField(text)
    box = boxed(docs).withColumn("h", F.xxhash64(own)).withColumn("lines", F.split(own, "\n"))
    # one plan at every size: a broadcast where the bounds happen to be few would not hold for more of them
    marked = box.join(cover.hint("shuffle_hash"), F.col("row").getField(key).eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_th")), "left")
    gone = F.coalesce(F.expr("aggregate(zip_with(ends, begins, (e, b) -> e - b), 0, (s, x) -> s + x)"), F.lit(0))
    left = F.expr(
        "flatten(transform(sequence(0, size(begins)), k -> slice(lines,"
        " IF(k = 0, 0, ends[k - 1]) + 1,"
        " IF(k = size(begins), size(lines), begins[k]) - IF(k = 0, 0, ends[k - 1]))))"
    )
    cut = F.when(F.col("begins").isNull(), own).otherwise(F.array_join(left, "\n"))
    return marked.select(
        *[cut.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns],
        F.when(own.isNull(), 0).otherwise(F.size("lines")).cast("bigint").alias("n_lines"), gone.cast("bigint").alias("n_removed"),
    )


LINES_SQL = """
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
wins AS (SELECT doc_id, p, l[p] AS a, l[p + 1] AS b, l[p + 2] AS c
         FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM docs WHERE len(l) >= 3)
         WHERE regexp_matches(l[p] || l[p + 1] || l[p + 2], '[^ \\t\\n\\x0B\\f\\r]')),
firsts AS (SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS r FROM wins),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM firsts, (SELECT unnest([0, 1, 2]) AS k) WHERE r > 1),
every AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS p, unnest(l) AS line FROM docs),
kept AS (SELECT e.doc_id, count(*) AS n_lines, count(g.p) AS n_removed,
                coalesce(string_agg(CASE WHEN g.p IS NULL THEN e.line END, chr(10) ORDER BY e.p), '') AS text
         FROM every e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id)
SELECT doc_id, n_lines, n_removed, text FROM kept
"""
