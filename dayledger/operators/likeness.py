"""Joins of like word sets: exact by prefix filter, and by banded MinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import feature as FT
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.operators.hot import spread
from dayledger.operators.nearest import met_in_cells
from dayledger.session import materialize, small_side

# Buckets in which words are counted for their order.
WORD_BUCKETS = 1 << 18
# Words of the sets that meet in one call, of each side, and words in common that are looked at in one step.
SET_WORDS = 1 << 22
STEP_MEETINGS = 1 << 18
# Ids up to which a list of them may be broadcast, if their bytes allow it.
FEW_IDS = 1_000_000


def distinct_sets(rows: DataFrame, key: str, words: str) -> DataFrame:
    """One row per distinct set: ``key`` (the smallest), ``copies``, ``words``. Equal sets, however many, become one."""
    digest = F.sha2(F.to_json(F.struct(F.array_sort(words).alias("w"))), 256)
    return rows.groupBy(digest.alias("_h")).agg(F.min(key).alias(key), F.count("*").alias("copies"), F.first(words).alias(words)).drop("_h")


def rarest_first(sets: DataFrame, key: str, words: str) -> DataFrame:
    """``words`` in one order for all sets: by the number of sets that hold a word or another of its bucket, then by hash and
    word. No word is moved: the counts are a table of ``WORD_BUCKETS`` numbers. Sets without words have no row."""
    sets = sets.select(key, words).filter(F.size(words) > 0)
    bucket = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(WORD_BUCKETS)).cast("int"))
    found = sets.select(F.explode(bucket).alias("at")).groupBy("at").agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(WORD_BUCKETS, np.int64)
    counts[found["at"].to_numpy()] = found["n"].to_numpy()

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lengths, flat, h = np.asarray(b.column(1).value_lengths()), b.column(1).flatten(), b.column(2).flatten().to_numpy(zero_copy_only=False)
            row, n = np.repeat(np.arange(len(lengths)), lengths), counts[h & (WORD_BUCKETS - 1)]
            at = np.lexsort((h, n, row))
            if ((h[at][1:] == h[at][:-1]) & (row[at][1:] == row[at][:-1])).any():  # two words of one hash
                names = flat.to_pylist()
                at = np.array(sorted(range(len(names)), key=lambda i: (row[i], n[i], h[i], names[i])))
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, flat.take(pa.array(at)))], names=[key, words])

    return sets.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w))).mapInArrow(order, sets.schema)


def least_common(percent: int, size: Column) -> Column:
    """Words that a set of ``size`` shares at least with any set of that likeness."""
    return F.floor((F.lit(percent) * size + 99) / 100).cast("int")


def jaccard(a: str, b: str) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def numbered_words(*sides: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each side of word lists: the words as numbers that are the same on all sides, the row of each, and the sizes."""
    sizes = [np.concatenate([np.zeros(0, np.int64), *(np.asarray(c.value_lengths()) for c in side.chunks)]).astype(np.int64) for side in sides]
    # chunk by chunk with one dictionary: the words are not copied
    flat = [c.flatten() for side in sides for c in side.chunks]
    codes = np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in pa.chunked_array(flat).dictionary_encode().chunks)]).astype(np.int32)
    parts = np.split(codes, np.cumsum([n.sum() for n in sizes])[:-1])
    return [(c, np.repeat(np.arange(len(n), dtype=np.int32), n), n) for c, n in zip(parts, sizes, strict=True)]


def like_rows(mine: pa.Table, here: pa.Table, percent: int) -> pa.Table:
    """(left_id, right_id, jaccard) of the like pairs of two tables of sets, (query, words) and (id, words), words in one order."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if mine.num_rows and here.num_rows:
        (ca, ra, na), (cb, rb, nb) = numbered_words(mine["words"], here["words"])
        words = 1 + max(ca.max(initial=0), cb.max(initial=0))
        from_a, from_b = np.cumsum(na) - na, np.cumsum(nb) - nb
        pa_, pb = (np.arange(len(r), dtype=np.int32) - f.astype(np.int32)[r] for r, f in ((ra, from_a), (rb, from_b)))
        first = lambda n: n - (percent * n + 99) // 100
        held = np.flatnonzero(pa_ <= first(na).astype(np.int32)[ra])
        held = held[np.argsort(ca[held], kind="stable")]  # the first words of the left sets, by word
        many = np.bincount(ca[held], minlength=words)
        begin = np.cumsum(many) - many
        asks = np.flatnonzero((pb <= first(nb).astype(np.int32)[rb]) & (many > 0)[cb])
        upto = np.cumsum(many[cb[asks]])
        ends = np.flatnonzero(np.append(rb[asks][1:] != rb[asks][:-1], True)) + 1 if len(asks) else np.zeros(0, int)  # of a right set
        mark, at = np.zeros(words, bool), 0
        while at < len(asks):
            limit = (upto[at - 1] if at else 0) + STEP_MEETINGS
            end = max(int(ends[max(np.searchsorted(upto[ends - 1], limit, "right") - 1, 0)]), int(ends[np.searchsorted(ends, at, "right")]))
            e, at = asks[at:end], end
            t = many[cb[e]]
            i = held[np.repeat(begin[cb[e]] - (np.cumsum(t) - t), t) + np.arange(t.sum())]
            j = np.repeat(e, t)
            p, q = na[ra[i]], nb[rb[j]]
            # of the likeness follows the least overlap of two sets of known sizes
            need = -(-percent * (p + q) // (100 + percent))
            able = (100 * q >= percent * p) & (100 * p >= percent * q) & (np.minimum(p - pa_[i], q - pb[j]) >= need)
            i, j = i[able], j[able]
            pair = rb[j].astype(np.int64) * len(na) + ra[i]
            order = np.argsort(pair, kind="stable")
            pairs, start, met = np.unique(pair[order], return_index=True, return_counts=True)
            if not len(pairs):
                continue
            r, l = pairs // len(na), pairs % len(na)  # noqa: E741
            last_a, last_b = np.maximum.reduceat(pa_[i][order], start), np.maximum.reduceat(pb[j][order], start)
            # words met, and those that may come after the last of them
            able = met + np.minimum(na[l] - last_a, nb[r] - last_b) - 1 >= -(-percent * (na[l] + nb[r]) // (100 + percent))
            r, l = r[able], l[able]  # noqa: E741
            common = np.zeros(len(r), np.int64)
            for a, b in zip(*(np.flatnonzero(x) for x in (np.append(True, r[1:] != r[:-1]), np.append(r[1:] != r[:-1], True))), strict=True) if len(r) else ():
                theirs = cb[from_b[r[a]] : from_b[r[a]] + nb[r[a]]]
                mark[theirs] = True
                for k in range(a, b + 1):
                    common[k] = mark[ca[from_a[l[k]] : from_a[l[k]] + na[l[k]]]].sum()
                mark[theirs] = False
            union = na[l] + nb[r] - common
            like = 100 * common >= percent * union
            out.append((l[like], r[like], common[like] / union[like]))
    many_of = lambda k, t: np.concatenate([x[k] for x in out]) if out else np.zeros(0, t)
    return pa.table({"left_id": mine["query"].take(pa.array(many_of(0, np.int64))), "right_id": here["id"].take(pa.array(many_of(1, np.int64))),
                     "jaccard": pa.array(many_of(2, float), pa.float64())})


def like_sets(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """(left_id, right_id, jaccard) of all pairs of sets of ``percent`` likeness or more, none lost.

    Both sides are (id, words) with words in the order of ``rarest_first``.
    Two such sets share one of their first words: of n words all but those
    that may be missing from the other. Left sets lie in blocks and right sets
    in cells, both of bounded size; each left set is sent once to a cell, each
    right set once to a block, and pairs are met, and decided by the whole
    sets, where they lie. Rare words meet first, and only where sizes and the
    words still to come allow the likeness. Empty sets meet nothing.
    """
    spark = right.sparkSession
    n, words = right.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    asked = left.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    cells = max(1, -(-words // SET_WORDS), min(spark.sparkContext.defaultParallelism, -(-n // 1000)))
    cell = F.pmod(F.xxhash64("id"), F.lit(cells)).alias("cell")
    pairs = met_in_cells(left.select(F.col("id").alias("query"), "words"), right.select("id", "words", cell), cells, max(1, -(-asked // SET_WORDS)))
    return pairs.applyInArrow(lambda a, b: like_rows(a, b, percent), "left_id long, right_id long, jaccard double")


def among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows with one of these ids. Where the ids are few the others are left out at once; else it is left to the join that follows."""
    few = small_side(ids, FEW_IDS)
    return rows if few is ids else rows.join(few, key, "left_semi")


def sketch(words: str) -> Column:
    """Distinct hashes of 16 bits of the words: a fifth of their bytes or less, and a bound on the words of two sets in common."""
    return F.array_distinct(F.transform(words, lambda w: (F.pmod(F.xxhash64(w), F.lit(1 << 16)) - (1 << 15)).cast("short")))


def maybe_like(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """The pairs of (left_id, right_id) whose sketches allow the likeness: all that have it, and few others."""
    side = lambda df, name: df.select(F.col("id").alias(f"{name}_id"), F.size("words").alias(f"{name}_n"), sketch("words").alias(f"{name}_s"))
    both = pairs.join(side(left, "left"), "left_id").join(side(right, "right"), "right_id")
    lost = F.least(F.col("left_n") - F.size("left_s"), F.col("right_n") - F.size("right_s"))  # words that share a hash
    common = F.size(F.array_intersect("left_s", "right_s")) + lost
    return both.filter((100 + percent) * common >= percent * (F.col("left_n") + F.col("right_n"))).select(*pairs.columns)


def surely_like(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """The pairs of (left_id, right_id), a written table, that have the likeness, with ``jaccard``: by the words of the sets in the pairs."""
    side = lambda df, name: among(df.select(F.col("id").alias(f"{name}_id"), F.col("words").alias(f"{name}_words")), pairs.select(f"{name}_id").distinct(), f"{name}_id")
    both = pairs.join(side(left, "left"), "left_id").join(side(right, "right"), "right_id")
    return both.withColumn("jaccard", jaccard("left_words", "right_words")).filter(F.col("jaccard") * 100 >= percent).select(*pairs.columns, "jaccard")


def hashed_bands(sets: DataFrame, bands: int, rows: int, seed: int) -> DataFrame:
    """(id, words, keys): a key for each band of ``rows`` MinHash values of a set, which two sets share with likeness^rows."""
    tf = FT.HashingTF(inputCol="words", outputCol="_f", numFeatures=1 << 18, binary=True).transform(sets.filter(F.size("words") > 0))
    model = FT.MinHashLSH(inputCol="_f", outputCol="_hashes", numHashTables=bands * rows, seed=seed).fit(tf)
    values = F.transform("_hashes", lambda v: vector_to_array(v)[0])
    hashed = model.transform(tf).select("id", "words", values.alias("_v"))
    # the values are bound to a variable first: named in the inner function, they would be worked out again for each band
    every = F.sequence(F.lit(0), F.lit(bands - 1))
    keys = F.transform(F.array("_v"), lambda v: F.transform(every, lambda k: F.xxhash64(F.slice(v, k * rows + 1, F.lit(rows)), k)))[0]
    return hashed.select("id", "words", keys.alias("keys"))


def hashed_like_sets(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """(left_id, right_id, jaccard) of the pairs of sets of that likeness which share a key; some pairs may be missed."""
    a = left.select(F.col("id").alias("left_id"), F.explode("keys").alias("key"))
    b = right.select(F.col("id").alias("right_id"), F.explode("keys").alias("key"))
    met = a.join(b, "key").select("left_id", "right_id").distinct()
    met = materialize(met, "hashed-pairs")
    return surely_like(met, left, right, percent)


# Rows of a bucket that one call compares with each other, and rows beside their leaders.
BUCKET_ROWS = 2000


def led_rows(bucket: pa.Table, percent: int) -> pa.Table:
    """(key, id, leader) of the rows of one bucket: each row, from the smallest id on, joins the first leader it is like, or leads."""
    leaders: list[tuple[int, int, set]] = []
    links = []
    for i, words in sorted(zip(bucket["id"].to_pylist(), bucket["words"].to_pylist(), strict=True)):
        mine = set(words)
        for leader, n, theirs in leaders:
            if 100 * min(n, len(words)) >= percent * max(n, len(words)):
                common = len(mine & theirs)
                if common / (n + len(words) - common) * 100 >= percent:
                    links.append((i, leader))
                    break
        else:
            leaders.append((i, len(words), mine))
    return links_table(bucket, links)


def links_table(bucket: pa.Table, links: list[tuple[int, int]]) -> pa.Table:
    keys = pa.array([bucket["key"][0].as_py()] * len(links) if links else [], pa.int64())
    return pa.table({"key": keys, "id": pa.array([x[0] for x in links], pa.int64()), "leader": pa.array([x[1] for x in links], pa.int64())})


class Sketches:
    """Sets known by size and sketch, and which of them a set may be like."""

    def __init__(self, room: int, width: int) -> None:
        self.flat, self.rows, self.used = np.zeros(width, np.int32), np.zeros((room, 4), np.int64), 0  # id, size, sketch size, start
        self.end = 0

    def add(self, i: int, n: int, codes: np.ndarray) -> None:
        if not len(codes):  # like nothing
            return
        self.rows[self.used] = i, n, len(codes), self.end
        self.flat[self.end : self.end + len(codes)] = codes
        self.used, self.end = self.used + 1, self.end + len(codes)

    def like(self, n: int, codes: np.ndarray, mark: np.ndarray, percent: int) -> np.ndarray:
        """Ids of the sets that may be like one of ``n`` words, in the order they came."""
        if not self.used or not len(codes):
            return np.zeros(0, np.int64)
        ids, sizes, short, start = self.rows[: self.used].T
        mark[codes] = 1
        common = np.add.reduceat(mark[self.flat[: self.end]], start, dtype=np.int64) + np.minimum(sizes - short, n - len(codes))
        mark[codes] = 0
        fits = (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)) & ((100 + percent) * common >= percent * (sizes + n))
        return ids[fits]


def sketched_rows(bucket: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
    """(id, size, sketch) from the smallest id on."""
    ids, sizes, lists = bucket["id"].to_numpy(), bucket["n"].to_numpy(), bucket["sketch"].combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32) + (1 << 15)
    ends = np.cumsum(np.asarray(lists.value_lengths()))
    for k in np.argsort(ids, kind="stable"):
        yield int(ids[k]), int(sizes[k]), flat[ends[k - 1] if k else 0 : ends[k]]


def maybe_led_rows(bucket: pa.Table, percent: int) -> pa.Table:
    """As ``led_rows``, by sketches: right wherever each of these links holds, for what is not linked is surely not like."""
    leaders = Sketches(bucket.num_rows, len(bucket["sketch"].combine_chunks().flatten()))
    links, mark = [], np.zeros(1 << 16, np.int8)
    for i, n, codes in sketched_rows(bucket):
        found = leaders.like(n, codes, mark, percent)
        if len(found):
            links.append((i, int(found[0])))
        else:
            leaders.add(i, n, codes)
    return links_table(bucket, links)


def maybe_joined(rows: pa.Table, heads: pa.Table, percent: int) -> pa.Table:
    """(key, id, leader) of all leaders that each row may be like."""
    leaders = Sketches(heads.num_rows, len(heads["sketch"].combine_chunks().flatten()) if heads.num_rows else 0)
    links, mark = [], np.zeros(1 << 16, np.int8)
    for row in sketched_rows(heads) if heads.num_rows else ():
        leaders.add(*row)
    for i, n, codes in sketched_rows(rows) if rows.num_rows else ():
        links += [(i, int(x)) for x in leaders.like(n, codes, mark, percent)]
    return links_table(rows, links)


LINK = "key long, id long, leader long"


def leader_links(rows: DataFrame, percent: int) -> DataFrame:
    """(id, leader): within each bucket of (id, words, keys), rows join the first leader they are like; leaders have no row.

    The smallest id of a bucket leads. Rows that are not like it go on: the
    first ``BUCKET_ROWS`` of them, in one call, join each other or lead, the
    others join these leaders, and those that do not go on to a next round,
    until none is left; so a row is never left out because the first leader
    was another's. A bucket of n like rows costs n comparisons, not all pairs,
    and one of n unlike rows n / ``BUCKET_ROWS`` rounds. Buckets hold ids,
    sizes and sketches; a sketch says which sets may be like, and only for
    these pairs are words moved, once to a pair, which decides.
    """
    left = materialize(rows.select("id", F.size("words").alias("n"), F.explode("keys").alias("key")), "leader-rows")
    sketches = rows.select("id", F.size("words").alias("n"), sketch("words").alias("sketch"))
    sure = lambda pairs: surely_like(
        materialize(pairs.select(F.col("id").alias("left_id"), F.col("leader").alias("right_id")).distinct(), "leader-maybe"), rows, rows, percent
    ).select(F.col("left_id").alias("id"), F.col("right_id").alias("leader"))

    leaders = left.groupBy("key").agg(F.min(F.struct("id", "n")).alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    leaders = leaders.select("key", F.col("first.id").alias("leader"), F.col("first.n").alias("leader_n"))
    met = materialize(left.join(leaders, "key").filter("id <> leader"), "leader-round")
    sizes = 100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n")
    pairs = met.filter(sizes).select(F.col("id").alias("left_id"), F.col("leader").alias("right_id")).distinct()
    pairs = maybe_like(pairs, rows, rows, percent).toDF("id", "leader")
    found = [materialize(sure(pairs), "leader-pairs")]
    rest = materialize(met.join(found[0], ["id", "leader"], "left_anti").select("id", "key"), "leader-rest")
    while not rest.isEmpty():
        large = materialize(rest.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > BUCKET_ROWS).select("key"), "large-buckets")
        several = not large.isEmpty()
        head = rest
        if several:
            place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
            first = rest.join(F.broadcast(large), "key", "left_semi").withColumn("place", place).filter(F.col("place") <= BUCKET_ROWS).select("id", "key")
            head = materialize(rest.join(F.broadcast(large), "key", "left_anti").select("id", "key").unionByName(first), "leader-heads")
        told = head.join(sketches, "id").select("key", "id", "n", "sketch")
        links = materialize(spread(told, "key").groupBy("key").applyInArrow(lambda t: maybe_led_rows(t, percent), LINK), "leader-links")
        like = materialize(sure(links), "leader-pairs")
        # a link that does not hold leaves the rest of its bucket open: it is done again by words
        again = materialize(links.join(like, ["id", "leader"], "left_anti").select("key").distinct(), "leader-again")
        if not again.isEmpty():
            words = head.join(again, "key", "left_semi").join(rows.select("id", "words"), "id").select("key", "id", "words")
            done = spread(words, "key").groupBy("key").applyInArrow(lambda t: led_rows(t, percent), LINK)
            links = materialize(links.join(again, "key", "left_anti").unionByName(done), "leader-links")
        found.append(links.select("id", "leader"))
        if not several:
            break
        others = materialize(rest.join(F.broadcast(large), "key", "left_semi").join(head, ["key", "id"], "left_anti").select("id", "key"), "leader-others")
        heads = head.join(F.broadcast(large), "key", "left_semi").join(links, ["key", "id"], "left_anti")
        # the rows of a bucket in slices, each beside all leaders of the round
        slices = others.groupBy("key").agg(F.ceil(F.count("*") / BUCKET_ROWS).cast("int").alias("slices"))
        dealt = others.join(slices, "key").withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")).join(sketches, "id")
        beside = heads.join(slices, "key").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).join(sketches, "id")
        keys, cols = ["key", "slice"], ["key", "slice", "id", "n", "sketch"]
        near = spread(dealt.select(*cols), *keys).groupBy(*keys).cogroup(spread(beside.select(*cols).toDF(*cols), *keys).groupBy(*keys))
        near = materialize(near.applyInArrow(lambda a, b: maybe_joined(a, b, percent), LINK), "leader-links")
        joined = near.join(materialize(sure(near), "leader-pairs"), ["id", "leader"]).groupBy("key", "id").agg(F.min("leader").alias("leader"))
        joined = materialize(joined, "leader-links")
        found.append(joined.select("id", "leader"))
        rest = materialize(others.join(joined, ["key", "id"], "left_anti"), "leader-rest")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct()
