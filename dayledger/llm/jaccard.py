"""Set similarity join on word n-grams by PartEnum signatures.

Two sets of sizes up to R whose Jaccard similarity is at least s differ in at
most k = 2R(1-s)/(1+s) members. The domain of n-grams is cut into first-level
parts, each into three. With more first-level parts than k/2, some part holds
at most one difference, so two of its three pieces are equal: the sets share
the signature that stands for those two pieces. There are some parts more, so
that a match shares several signatures and each set can leave out its most
frequent ones. Sizes fall into bands; a set
signs for its own band and, where it may match a larger set of the next, for
that one too. Signatures only propose; every link is decided on the sets.

Sets that are equal are one class from the start. The members of a signature
are tested against its leader and, in blocks of bounded size, against each
other. Where a leader has several blocks that did not grow together, members
outside its main component meet all blocks: so no link between components is
lost, and groups that are connected cost no more than their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.llm.frames import boxed
from dayledger.llm.shards import buckets_for, by_bucket, joined, packed, sharded, shards_for, text_slices, volume, with_shards
from dayledger.llm.words import buffers, find_words, mix, pieces, rolling
from dayledger.operators.graph import components
from dayledger.session import materialize

BLOCK_ROWS = 512
BLOCK_SHINGLES = 2_000_000
BAND_GROWTH = 1.5


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the n-grams of each document, one after the other, and their bounds."""
    words = find_words(data, offsets, lower=True)
    h = words.hashes()
    grams = rolling(h, width)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= width:
            sets.append(np.unique(grams[a : b - width + 1]))
        elif b > a:  # fewer words: the whole sequence is the one n-gram
            sets.append(rolling(h[a:b], b - a) ^ np.uint64(b - a))
        else:
            sets.append(h[:0])
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else h[:0], bounds


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[bounds[1:]] - total[bounds[:-1]]


def set_keys(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers that stand for each set."""
    a = sums_between(mix(flat), bounds)
    b = sums_between(mix(flat ^ np.uint64(0x2545F4914F6CDD1D)), bounds)
    return a.view(np.int64), b.view(np.int64)


def bands(largest: int) -> np.ndarray:
    """Lower bounds of the size bands, up to one above the largest size."""
    out = [1]
    while out[-1] <= largest:
        out.append(int(np.ceil(out[-1] * BAND_GROWTH)) + (out[-1] == 1))
    return np.array([*out, int(np.ceil(out[-1] * BAND_GROWTH))])


def signatures(flat: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signature hashes, the index of the set of each, its band, and how many signatures a match shares at least there."""
    sizes = np.diff(bounds)
    if not len(flat):
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    low = bands(int(sizes.max()))
    own = np.searchsorted(low, sizes, "right") - 1
    who = np.flatnonzero(sizes > 0)
    up = who[100 * sizes[who] >= percent * low[own[who] + 1]]
    who, band = np.concatenate([who, up]), np.concatenate([own[who], own[up] + 1])
    differ = (100 - percent) * 2 * (np.append(low, 2 * low[-1])[band + 1] - 1) // (100 + percent)
    # sets that may not differ at all are equal, and those are joined already
    who, band, differ = who[differ > 0], band[differ > 0], differ[differ > 0]
    parts = differ // 2 + 1 + differ // 4 + 1
    base = np.concatenate([[0], np.cumsum(parts)])
    with np.errstate(over="ignore"):
        count = sizes[who]
        inst = np.repeat(np.arange(len(who)), count)
        at = np.repeat(bounds[who], count) + np.arange(len(inst)) - np.repeat(np.cumsum(count) - count, count)
        place = mix(flat[at] ^ np.uint64(0x6A09E667F3BCC909))
        part = ((place >> np.uint64(34)).astype(np.int64) * parts[inst]) >> 30
        cell = (base[inst] + part) * 3 + (place % np.uint64(3)).astype(np.int64)
        sums = np.zeros(3 * base[-1], np.uint64)
        np.add.at(sums, cell, mix(flat[at] + np.uint64(0x9E3779B9)))
        sums = sums.reshape(-1, 3)
        inst = np.repeat(np.arange(len(who)), parts)
        salt = mix((np.arange(len(inst)) - base[inst]).astype(np.uint64) * np.uint64(64) + band[inst].astype(np.uint64))
        keys, owner, empty = [], [], []
        for left in range(3):
            a, b = sums[:, (left + 1) % 3], sums[:, (left + 2) % 3]
            keys.append(mix(mix(a + salt) + np.uint64(3) * b + np.uint64(left)))
            empty.append((a == 0) & (b == 0))
            owner.append(who[inst])
    # an agreement on nothing proposes everyone; it is needed only where a set has so many empty parts
    # that they may be all on which a match agrees
    hollow = np.bincount(inst, weights=np.any(empty, axis=0), minlength=len(who))
    needed = hollow >= parts - differ // 2
    keep = ~np.concatenate(empty) | np.tile(needed[inst], 3)
    least = np.where(needed, 1, parts - differ // 2 - hollow)
    return np.concatenate(keys)[keep], np.concatenate(owner)[keep], np.tile(band[inst], 3)[keep], np.tile(least[inst], 3)[keep]


def without_most_frequent(keys: np.ndarray, owner: np.ndarray, band: np.ndarray, least: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which signatures to keep: of each set and band all but the ``least - 1`` most frequent.

    Sets that match share at least ``least`` signatures of a band. In the
    order of frequency the first that they share has least - 1 others behind
    it in either set, so it is kept in both. Frequent signatures, such as
    those of a passage that many texts quote, go where a set can spare them.
    """
    order = np.lexsort((keys, count, band, owner))
    o, b = owner[order], band[order]
    edge = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (b[1:] != b[:-1]))) if len(o) else np.zeros(0, np.int64)
    length = np.diff(np.append(edge, len(o)))
    place = np.arange(len(o)) - np.repeat(edge, length)
    keep = np.zeros(len(o), bool)
    keep[order] = place <= np.repeat(length, length) - least[order]
    return keep


def block_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets of one block."""
    m = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    distinct, column = np.unique(column, return_inverse=True)
    common = np.zeros((m, m), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    wide = max(1024, 2_000_000 // max(m, 1))
    for at in range(0, len(distinct), wide):
        i, j = np.searchsorted(column, [at, at + wide])
        part = np.zeros((m, min(wide, len(distinct) - at)), np.float32)
        part[owner[i:j], column[i:j] - at] = 1
        common += part @ part.T
    sizes = np.array([len(s) for s in sets], np.float64)
    union = sizes[:, None] + sizes[None, :] - common
    a, b = np.nonzero(np.triu(100 * common >= percent * union, 1) & (common > 0))
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


class JaccardJoin:
    """One join: the texts in shards, their classes, and the steps on them."""

    def __init__(self, docs: DataFrame, width: int, percent: int, key: str, text: str):
        self.width, self.percent = width, percent
        size = volume(docs, text)
        self.n_shards = shards_for(docs, size)
        self.texts = sharded(docs, key, text, self.n_shards)
        self.n_buckets = buckets_for(size / 6 * 0.7 * (100 - percent) / 20, 12)

    def sizes(self) -> DataFrame:
        """(shard, id, n_shingles, a, b) of every row; a and b stand for the set."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in pieces(whole, "text"):
                    flat, bounds = shingle_sets(*buffers(b.column("text")), width)
                    x, y = set_keys(flat, bounds)
                    yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("id"), pa.array(np.diff(bounds)), pa.array(x), pa.array(y)], names=["shard", "id", "n_shingles", "a", "b"])

        return self.texts.mapInArrow(run, "shard int, id long, n_shingles long, a long, b long")

    def leaders(self, heads: DataFrame) -> DataFrame:
        """For each shard the signatures that other shards have too: their keys, leaders, leaders' shards, and shards in all."""
        width, percent, n = self.width, self.percent, self.n_buckets

        def send(mine: pa.Table, told: pa.Table) -> pa.Table:
            keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for ident, flat, bounds in head_sets(mine, told, width):
                k, own, _, _ = signatures(flat, bounds, percent)
                keys.append(k)
                ids.append(ident[own])
            k, i = np.concatenate(keys), np.concatenate(ids)
            order = np.lexsort((i, k))
            k, i = k[order], i[order]
            first = np.ones(len(k), bool)
            first[1:] = k[1:] != k[:-1]
            k, i = k[first], i[first]
            order, found, bounds = by_bucket(k, n)
            pk, pi = packed([k[order], i[order]], bounds)
            shard = told["shard"][0].as_py() if told.num_rows else 0
            return pa.table({"bucket": pa.array(found, pa.int32()), "shard": pa.array(np.full(len(found), shard), pa.int32()), "keys": pa.array(pk, pa.binary()), "ids": pa.array(pi, pa.binary())})

        def meet(t: pa.Table) -> pa.Table:
            k, count = joined(t["keys"], np.uint64)
            i = joined(t["ids"], np.int64)[0]
            shard = np.repeat(t["shard"].to_numpy(), count)
            order = np.lexsort((i, k))
            k, i, shard = k[order], i[order], shard[order]
            first = np.ones(len(k), bool)
            first[1:] = k[1:] != k[:-1]
            lead = np.flatnonzero(first)[np.cumsum(first) - 1] if len(k) else np.zeros(0, np.int64)
            times = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1].astype(np.int32) if len(k) else np.zeros(0, np.int32)
            many = times > 1
            k, li, ls, shard, times = k[many], i[lead[many]], shard[lead[many]].astype(np.int32), shard[many], times[many]
            order = np.argsort(shard, kind="stable")
            who, at = np.unique(shard[order], return_index=True)
            pk, pi, ps, pt = packed([k[order], li[order], ls[order], times[order]], np.append(at, len(order)))
            return pa.table({"shard": pa.array(who, pa.int32()), "keys": pa.array(pk, pa.binary()), "leads": pa.array(pi, pa.binary()), "homes": pa.array(ps, pa.binary()), "times": pa.array(pt, pa.binary())})

        sent = with_shards(self.texts, heads, send, "bucket int, shard int, keys binary, ids binary")
        return sent.groupBy("bucket").applyInArrow(meet, "shard int, keys binary, leads binary, homes binary, times binary")

    def proposals(self, heads: DataFrame, answers: DataFrame) -> DataFrame:
        """(leader, home, id, shard, size): each set beside the leaders of its signatures."""
        width, percent = self.width, self.percent

        def run(mine: pa.Table, told: pa.Table) -> pa.Table:
            asked = told.filter(pa.compute.is_valid(told["keys"])) if told.num_rows else told
            k, lead, home, times = (joined(asked[c], t)[0] for c, t in (("keys", np.uint64), ("leads", np.int64), ("homes", np.int32), ("times", np.int32)))
            order = np.argsort(k, kind="stable")
            k, lead, home, times = k[order], lead[order], home[order], times[order]
            shard = told["shard"][0].as_py() if told.num_rows else 0
            rows: list[np.ndarray] = [np.zeros((4, 0), np.int64)]
            local_k, local_i, local_n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for ident, flat, bounds in head_sets(mine, told, width):
                s, own, band, least = signatures(flat, bounds, percent)
                count = np.ones(len(s), np.int64)
                if len(k):
                    at = np.minimum(np.searchsorted(k, s), len(k) - 1)
                    count[k[at] == s] = times[at[k[at] == s]]
                keep = without_most_frequent(s, own, band, least, count)
                s, own = s[keep], own[keep]
                local_k.append(s)
                local_i.append(ident[own])
                local_n.append(np.diff(bounds)[own])
            s, i, n = np.concatenate(local_k), np.concatenate(local_i), np.concatenate(local_n)
            # signatures that other shards share: their leader; the rest: the smallest id of this shard
            order = np.lexsort((i, s))
            s, i, n = s[order], i[order], n[order]
            if len(s):
                first = np.ones(len(s), bool)
                first[1:] = s[1:] != s[:-1]
                leader, where = i[np.flatnonzero(first)[np.cumsum(first) - 1]], np.full(len(s), shard, np.int64)
                if len(k):
                    at = np.minimum(np.searchsorted(k, s), len(k) - 1)
                    hit = k[at] == s
                    leader[hit], where[hit] = lead[at[hit]], home[at[hit]]
                real = leader != i
                rows.append(np.unique(np.stack([leader, where, i, n])[:, real], axis=1))
            r = np.concatenate(rows, axis=1)
            return pa.table({"leader": r[0], "home": r[1].astype(np.int32), "id": r[2], "size": r[3], "shard": np.full(r.shape[1], shard, np.int32)})

        told = heads.unionByName(answers, allowMissingColumns=True)
        return with_shards(self.texts, told, run, "leader long, home int, id long, size long, shard int")

    def linked(self, wanted: DataFrame) -> DataFrame:
        """Edges among the texts that share a cell. ``wanted``: (shard, id, leader, cell) rows, whose cells are bounded."""
        width, percent = self.width, self.percent
        groups = max(1, -(-wanted.count() // BLOCK_ROWS))
        wanted = wanted.withColumn("group", F.pmod(F.xxhash64("leader", "cell"), F.lit(groups)))

        def ship(mine: pa.Table, told: pa.Table) -> pa.Table:
            if not told.num_rows or not mine.num_rows:
                return pa.table({c: pa.array([], t) for c, t in (("group", pa.int64()), ("leader", pa.int64()), ("cell", pa.int64()), ("id", pa.int64()), ("text", pa.string()))})
            both = told.select(["group", "leader", "cell", "id"]).join(mine.select(["id", "text"]).combine_chunks(), "id", join_type="inner")
            return both.select(["group", "leader", "cell", "id", "text"]).cast(pa.schema([("group", pa.int64()), ("leader", pa.int64()), ("cell", pa.int64()), ("id", pa.int64()), ("text", pa.string())]))

        def test(t: pa.Table) -> pa.Table:
            t = t.sort_by([("leader", "ascending"), ("cell", "ascending"), ("id", "ascending")])
            lead, cell, ident = (t[c].to_numpy() for c in ("leader", "cell", "id"))
            edge = np.flatnonzero(np.append(True, (lead[1:] != lead[:-1]) | (cell[1:] != cell[:-1])))
            src, dst = [], []
            for i, j in zip(edge, np.append(edge[1:], len(lead)), strict=True):
                flat, bounds = shingle_sets(*buffers(t["text"].slice(i, j - i)), width)
                for x, y in block_links([flat[p:q] for p, q in zip(bounds[:-1], bounds[1:], strict=True)], percent):
                    src.append(int(ident[i + x]))
                    dst.append(int(ident[i + y]))
            return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

        shipped = with_shards(self.texts, wanted, ship, "group long, leader long, cell long, id long, text string")
        return shipped.groupBy("group").applyInArrow(test, "src long, dst long").filter("src <> dst").distinct()


def head_sets(mine: pa.Table, told: pa.Table, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, sets, bounds) of the rows of a shard that stand for their class, each class once."""
    if not told.num_rows or not mine.num_rows:
        return
    wanted = {x for x in zip(*(told[c].to_pylist() for c in ("id", "a", "b")), strict=True) if x[0] is not None}
    for part in text_slices(mine):
        flat, bounds = shingle_sets(*buffers(part.column("text")), width)
        a, b = set_keys(flat, bounds)
        keep = []
        for k, x in enumerate(zip(part.column("id").to_pylist(), a.tolist(), b.tolist(), strict=True)):
            if x in wanted:
                wanted.discard(x)
                keep.append(k)
        if keep:
            sets = [flat[bounds[k] : bounds[k + 1]] for k in keep]
            yield (part.column("id").to_numpy(zero_copy_only=False)[keep].astype(np.int64), np.concatenate(sets),
                   np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable over links of at least ``percent``/100).

    Words are lower-cased in A-Z. Null and wordless texts have 0 n-grams and
    are linked with nothing: they are components of their own. A null id gets
    a null component. Rows of one id are one vertex, whatever their texts.
    """
    docs = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    join = JaccardJoin(docs, width, percent, "id", "text")
    rows = materialize(join.sizes(), "jaccard-sizes")
    full = rows.filter("n_shingles > 0 AND id IS NOT NULL")
    classes = materialize(full.groupBy("n_shingles", "a", "b").agg(F.min("id").alias("head"), F.min_by("shard", "id").alias("shard")), "jaccard-classes")
    heads = classes.select("shard", F.col("head").alias("id"), "a", "b")
    pairs = materialize(join.proposals(heads, join.leaders(heads)), "jaccard-pairs")
    # members of each leader in blocks of bounded rows and n-grams
    blocks = pairs.groupBy("leader", "home").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("blocks"))
    blocks = materialize(blocks, "jaccard-blocks")
    placed = pairs.join(blocks.select("leader", "blocks"), "leader").withColumn("cell", F.pmod(F.xxhash64("id"), F.col("blocks")))
    every = blocks.select(F.col("home").alias("shard"), F.col("leader").alias("id"), "leader", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("cell"))
    wanted = materialize(placed.select("shard", "id", "leader", "cell").unionByName(every), "jaccard-wanted")
    edges = materialize(join.linked(wanted), "jaccard-edges")
    # one id with several texts joins their classes
    known = full.join(classes.select("n_shingles", "a", "b", "head"), ["n_shingles", "a", "b"])
    firsts = known.groupBy("id").agg(F.min("head").alias("dst"))
    edges = edges.unionByName(known.join(firsts, "id").filter("head <> dst").select(F.col("head").alias("src"), "dst").distinct())
    found = components(edges)
    # also where no leader has a second block: the plan, and what it costs, is the same at every size
    more = materialize(join.linked(left_over(wanted, blocks, found)), "jaccard-more")
    if not more.isEmpty():
        found = components(found.filter("id <> comp").select(F.col("id").alias("src"), F.col("comp").alias("dst")).unionByName(more))
    named = classes.join(found.select(F.col("id").alias("head"), "comp"), "head", "left")
    named = materialize(named.select("n_shingles", "a", "b", F.coalesce("comp", "head").alias("comp")), "jaccard-named")
    out = rows.join(named, ["n_shingles", "a", "b"], "left")
    comp = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    return out.select(F.col("id").alias(key), "n_shingles", comp.alias("component_id"))


def left_over(wanted: DataFrame, blocks: DataFrame, found: DataFrame) -> DataFrame:
    """Cells of the pairs that share a leader with several blocks and are in different components so far.

    The members outside a leader's largest component, in blocks, meet every
    block of the leader.
    """
    big = blocks.filter("blocks > 1").select("leader", "blocks")
    members = wanted.join(big, "leader").join(found.select("id", "comp"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    members = materialize(members, "jaccard-members")
    main = members.groupBy("leader", "comp").agg(F.countDistinct("id").alias("n")).groupBy("leader").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"))
    main = materialize(main, "jaccard-main")
    outside = materialize(members.join(main, "leader").filter("comp <> main").select("shard", "id", "leader", "cell", "blocks"), "jaccard-outside")
    counts = outside.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("rows"))
    counts = materialize(counts, "jaccard-outside-blocks")
    # cell number: block of the outsiders * blocks + block of the members
    asks = outside.join(counts, "leader").withColumn("q", F.pmod(F.xxhash64("id", F.lit(1)), F.col("rows")))
    asks = asks.select("shard", "id", "leader", F.explode(F.expr("transform(sequence(0L, blocks - 1), b -> q * blocks + b)")).alias("cell"))
    meets = members.join(counts, "leader").select("shard", "id", "leader", F.explode(F.expr("transform(sequence(0L, rows - 1), q -> q * blocks + cell)")).alias("cell"))
    return materialize(asks.unionByName(meets).distinct(), "jaccard-left-over")


def vertices(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with ``vertex``: the id, or a hash of id and text where an id stands for several texts, so that each text is one."""
    id_, seen = F.col(key).cast("bigint"), [F.xxhash64(text), F.xxhash64(text, F.lit(1))]
    texts = docs.filter(id_.isNotNull()).select(id_.alias("_k"), *[h.alias(f"_h{k}") for k, h in enumerate(seen)]).distinct()
    several = materialize(texts.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_k"), "jaccard-several")
    if several.isEmpty():
        return docs.withColumn("vertex", id_)
    salt = 0
    while True:
        hashed = lambda t, s=salt: F.xxhash64("_k", *t, F.lit(s))
        named = texts.join(several, "_k", "left_semi").select(hashed(["_h0", "_h1"]).alias("v")).unionByName(texts.join(several, "_k", "left_anti").select(F.col("_k").alias("v")))
        if named.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            break
        salt += 1  # two texts of one hash
    marked = docs.withColumn("_k", id_).join(several.withColumn("_several", F.lit(True)), "_k", "left")
    return marked.withColumn("vertex", F.when(F.col("_several"), hashed(seen)).otherwise(F.col("_k"))).drop("_k", "_several")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component of like texts, one row of it, with the columns of the input. Null ids stay.

    It is that of the smallest id. Where an id stands for several texts, each is a document of its own, known by a hash of
    id and text: texts that are not alike all stay.
    """
    box = boxed(docs).withColumns({"key": F.col("row").getField(key), "text": F.col("row").getField(text)})
    box = vertices(box, "key", "text")
    found = jaccard_components(box.select("vertex", "text"), width, percent, "vertex", "text").filter("component_id IS NOT NULL")
    heads = materialize(found.filter("vertex = component_id").select(F.col("vertex").alias("head")).distinct(), "jaccard-keep")
    order = F.xxhash64(*[F.col("row").getField(c) for c in docs.columns if not isinstance(docs.schema[c].dataType, T.MapType)])
    single = box.join(heads, F.col("vertex") == F.col("head"), "left_semi").groupBy("vertex").agg(F.min_by("row", order).alias("row"))
    return single.select("row.*").unionByName(docs.filter(F.col(key).isNull()))
