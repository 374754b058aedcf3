"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule is a column expression that is true for a text to reject. On a
bounded sample the cost of each rule is timed and its selectivity counted;
the rules then run in the order of rejections per cost, and a text that one
rule rejects is not put to the others. The verdict does not depend on the
order, only the time does.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.frames import boxed
from dayledger.llm.sampling import bounded_sample
from dayledger.session import materialize

SPACE = "[ \\t\\n\\x0B\\f\\r]+"
REPEAT_WIDTH = 5


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long).

    A null text has no words and no lines: all are 0. Arrays that a later
    step reads more than once are columns of their own, so that they are
    worked out once per text.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    step = boxed(docs, *[c for c in made if c != text]).withColumn("t", F.coalesce(F.col("row").getField(text), F.lit("")))
    step = step.withColumn("_w", F.filter(F.split("t", SPACE), lambda x: x != ""))
    step = step.withColumn("_l", F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]")))
    step = step.withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
    grams = F.expr(
        f"transform(sequence(0, size(_h) - {REPEAT_WIDTH}), i -> xxhash64({', '.join(f'_h[i + {k}]' for k in range(REPEAT_WIDTH))}))"
    )
    step = step.withColumn("_g", F.when(F.size("_h") >= REPEAT_WIDTH, grams).otherwise(F.array().cast("array<bigint>")))
    # only texts that repeat a window need the sort
    twice = F.size(F.array_distinct("_g")) < F.size("_g")
    step = step.withColumn("_s", F.when(twice, F.array_sort(F.expr("transform(_g, (x, i) -> struct(x AS g, i AS i))"))))
    again = F.expr("transform(filter(_s, (x, k) -> x.g = get(_s, k - 1).g OR x.g = get(_s, k + 1).g), x -> x.i)")
    step = step.withColumn("_p", F.array_sort(again))
    covered = F.expr(
        f"aggregate(_p, struct(0L AS n, 0 AS e), (a, p) -> struct(a.n + {REPEAT_WIDTH} - greatest(0, a.e - p) AS n, p + {REPEAT_WIDTH} AS e), a -> a.n)"
    )
    return step.select(
        "row.*",
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("t", "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def default_rules(text: str = "text") -> dict[str, Column]:
    """Rules for prose, each with room to spare on both sides of labelled texts; they read the base columns and the text.

    symbols: more than three marks of markup or tables to ten words.
    letters: fewer letters than half of the characters that are not white.
    capitals: more than half of the letters are capitals.
    word_length: words of under two or over fifteen characters on average.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.col("n_words")

    def kind(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, ""))

    return {
        "symbols": 10 * F.col("n_symbols") > 3 * n,
        "letters": 2 * kind("[^\\p{L}]+") < F.col("word_chars"),
        "capitals": 2 * kind("[^\\p{Lu}]+") > kind("[^\\p{L}]+"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
    }


def seconds(sample: DataFrame, copies: int, *counts: Column) -> tuple[float, list[int]]:
    """Shortest time of three runs over ``copies`` of the sample, and the counts."""
    rows = sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    best, got = float("inf"), []
    for _ in range(3):
        t0 = time.perf_counter()
        got = list(rows.agg(F.count(F.lit(1)), *counts).first())
        best = min(best, time.perf_counter() - t0)
    return best, got


def ranked(sample: DataFrame, rules: Mapping[str, Column], most: int = 256) -> list[str]:
    """Names of the rules by rejections per second on the sample, the most first.

    A rule's cost is its own: the time of the same job without the rule is taken off, and the sample is repeated until what
    is left outweighs that, or ``most`` times. Each rule begins with few copies: what a cheap one needs would be long for others.
    """
    rates, empties = {}, {}
    for name, rule in rules.items():
        copies = 4
        while True:
            if copies not in empties:
                empties[copies] = seconds(sample, copies)[0]
            empty = empties[copies]
            took, (n, hit) = seconds(sample, copies, F.count_if(rule))
            if took >= 2 * empty or copies >= most:
                break
            copies *= 4
        cost = max(took - empty, 1e-3 * empty, 1e-9) / copies
        rates[name] = (hit + copies) / (n + copies) / cost
    return sorted(rules, key=lambda k: -rates[k])


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """Name of the first rule, in this order, that rejects; null for a text that all let pass."""
    out = F.lit(None).cast("string")
    for name in reversed(order):
        out = F.when(rules[name], F.lit(name)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: Mapping[str, Column] | None = None, key: str = "doc_id", text: str = "text", sample_rows: int = 1000) -> DataFrame:
    """Adds the base columns, base_failed, rejected_by and kept to the documents.

    base_failed: fewer than ten words, or over a fifth of the words in
    repeated windows. Rules whose value is null do not reject. Equal rows are
    judged alike; an empty table stays empty; columns of these names are
    replaced. ``sample_rows`` bounds the sample that sets the order.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept")
    docs = docs.drop(*[c for c in made if c not in (key, text)])
    rules = rules or default_rules(text)
    sample = materialize(base_columns(bounded_sample(docs.select(key, text), sample_rows, key), text), "quality-sample")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdict = F.when(failed, F.lit("base")).otherwise(cascade(rules, ranked(sample, rules)))
    return base_columns(docs, text).withColumn("base_failed", failed).withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the base columns, base_failed, kept."""
    return judge(docs.select("doc_id", "text")).drop("text", "rejected_by")


QUALITY_SQL = r"""
WITH docs AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
                     list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l FROM documents),
wins AS (SELECT doc_id, p, list_slice(w, p, p + 4) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM docs WHERE len(w) >= 5)),
many AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM wins) WHERE c > 1),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, p + k AS p FROM many, (SELECT unnest([0, 1, 2, 3, 4]) AS k)) GROUP BY doc_id),
base AS (SELECT d.doc_id, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
         FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                  length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS letters, length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS capitals FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * letters < word_chars OR 2 * capitals > letters
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM judged
"""
