"""Mixing of sources to target weights by Poisson replication, in DataFrame operations only.

A source of n documents and share w of the target T gets the mean repetition
rate T * w / n. A document's number of copies is the Poisson quantile of that
mean at a uniform number taken from a hash of its id, so the draw is the same
each time and needs no state. Copies are then dealt out at random over all
partitions and put in random order within each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.frames import boxed
from dayledger.session import small_side

MAX_BROADCAST_SOURCES = 10_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts: 52 bits, the same in every engine."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def poisson_tables(rates: DataFrame, key: str, rate: str) -> DataFrame:
    """Per row of ``rates`` the array ``cdf``: P(X <= k) for k = 0, 1, ... until it is 1 to machine precision.

    Terms are summed from logarithms, so that large rates do not underflow. A
    rate of zero has the one entry 1. The arrays are as long as the rates are
    large, one for each source.
    """
    top = F.ceil(F.col(rate) + 12 * F.sqrt(rate) + 30)
    w = Window.partitionBy(key).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    terms = (
        rates.filter(F.col(rate) > 0)
        .select(key, rate, F.explode(F.sequence(F.lit(0).cast("bigint"), top)).alias("k"))
        .withColumn("log_p", F.sum(F.when(F.col("k") == 0, -F.col(rate)).otherwise(F.log(F.col(rate) / F.col("k")))).over(w))
        .withColumn("cdf", F.sum(F.exp("log_p")).over(w))
    )
    tables = terms.groupBy(key).agg(F.sort_array(F.collect_list("cdf")).alias("cdf"))
    joined = rates.join(tables, rates[key].eqNullSafe(tables[key]), "left").drop(tables[key])
    return joined.withColumn("cdf", F.coalesce("cdf", F.array(F.lit(1.0))))


def target_rates(docs: DataFrame, source: str, weights: dict[str, float] | None, power: float, target: int | None) -> DataFrame:
    """Per source its rows and rate. Without ``weights`` a source weighs its rows to the given power.

    Named weights give sources that they do not name weight zero. A null
    source is a source of its own. Sums over sources are combined before the
    shuffle, so a hot source costs no more than others.
    """
    counts = docs.groupBy(source).agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        share = F.pow(F.col("rows").cast("double"), F.lit(power))
    else:
        share = F.lit(0.0)
        for name, w in weights.items():
            share = F.when(F.col(source).eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(share)
    shared = counts.withColumn("share", share)
    total = shared.agg(F.sum("share"), F.sum("rows")).first()
    size = target if target is not None else total[1]
    rate = F.col("share") / F.lit(total[0]) * F.lit(size) / F.col("rows") if total[0] else F.lit(0.0)
    return shared.select(source, "rows", rate.alias("rate"))


def mix(
    docs: DataFrame, source: str = "source", key: str = "doc_id", weights: dict[str, float] | None = None,
    power: float = 0.5, target: int | None = None, seed: int = 17,
) -> DataFrame:
    """Documents repeated to their source's rate and shuffled, with ``copy`` (from 0) and ``n_copies``.

    Rows of equal ids have equal numbers of copies; a null id draws as the
    empty text. An empty table stays empty. Input columns named ``copy`` or
    ``n_copies`` are replaced. The source tables (one row per source) are
    broadcast only where there are at most MAX_BROADCAST_SOURCES.
    """
    box = boxed(docs, "copy", "n_copies")
    rates = target_rates(docs, source, weights, power, target).withColumnRenamed(source, "of")
    tables = small_side(poisson_tables(rates, "of", "rate").select("of", "cdf"), MAX_BROADCAST_SOURCES)
    ident = F.col("row").getField(key)
    drawn = box.withColumn("u", uniform(F.lit(seed), ident)).withColumn("from", F.col("row").getField(source))
    drawn = drawn.join(tables, F.col("from").eqNullSafe(F.col("of")))
    drawn = drawn.withColumn("n_copies", F.size(F.filter("cdf", lambda c: c <= F.col("u"))).cast("bigint")).filter("n_copies > 0")
    copies = drawn.select("row", "n_copies", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_copies") - 1)).alias("copy"))
    copies = copies.withColumn("order", F.md5(F.concat_ws(":", F.lit(seed + 1), ident.cast("string"), F.col("copy").cast("string"))))
    return copies.repartition("order").sortWithinPartitions("order").select("row.*", "n_copies", "copy")


MIX_SQL = """
WITH counts AS (SELECT source, count(*) AS n, pow(count(*), 0.5) AS share FROM documents GROUP BY source),
rates AS (SELECT source, share / (SELECT sum(share) FROM counts) * (SELECT sum(n) FROM counts) / n AS rate FROM counts),
steps AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates),
logs AS (SELECT source, k, sum(CASE WHEN k = 0 THEN -rate ELSE ln(rate / k) END) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS log_p FROM steps),
cdfs AS (SELECT source, k, sum(exp(log_p)) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS cdf FROM logs),
draws AS (SELECT doc_id, source, text, CAST('0x' || substr(md5('17:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents),
drawn AS (SELECT d.doc_id, d.source, d.text, (SELECT count(*) FROM cdfs c WHERE c.source IS NOT DISTINCT FROM d.source AND c.cdf <= d.u) AS n_copies FROM draws d)
SELECT doc_id, source, text, n_copies, unnest(range(0, n_copies)) AS copy FROM drawn WHERE n_copies > 0
"""
