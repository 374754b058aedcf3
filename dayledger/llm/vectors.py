"""Embedding near-duplicates by product quantisation: coarse inverted lists with residual codes.

Vectors are normalised, put into the list of their nearest coarse centre, and
their residual is coded by the nearest of 256 words in each of eight
subspaces. A vector is looked up in every list that can hold a neighbour: a
vector y within distance r of x lies nearer to its own centre c than to x's
centre b, so d(x,c)^2 - d(x,b)^2 <= 2 r d(b,c). In a list, table lookups give
the distance from x to the coded y; y is a candidate if that is at most r
plus the coding error kept with y. Both bounds are sufficient, so no
neighbour is missed; candidates are decided by the exact cosine.

Equal vectors of a label are one class with a count. Centres and code words
are fitted on a bounded sample; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.sampling import bounded_sample
from dayledger.operators.graph import components
from dayledger.session import materialize

SUBSPACES, CODE_WORDS = 8, 256
LIST_ROWS, ASK_ROWS = 1024, 2048  # rows of a block of a list and of its lookups
MAX_CENTRES = 1024
SLACK = 1e-6  # for rounding in the bounds; the exact cosine decides


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square vanishes or overflows."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)


def centres(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's iterations; a centre that loses all its points stays where it is."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = squares(x, c).argmin(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


@dataclass
class Quantiser:
    coarse: np.ndarray  # (lists, dim)
    words: list[np.ndarray]  # of each subspace: (words, its width)
    cuts: list[slice]

    @classmethod
    def fit(cls, x: np.ndarray, lists: int, seed: int = 3) -> Quantiser:
        coarse = centres(x, min(lists, len(x)), 8, seed)
        rest = x - coarse[squares(x, coarse).argmin(1)]
        edges = np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int)
        cuts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return cls(coarse, [centres(rest[:, s], min(CODE_WORDS, len(x)), 5, seed + 1) for s in cuts], cuts)

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and the length of what the codes leave out."""
        codes = np.stack([squares(rest[:, s], w).argmin(1) for s, w in zip(self.cuts, self.words, strict=True)], 1)
        coded = np.concatenate([w[codes[:, m]] for m, w in enumerate(self.words)], 1)
        return codes.astype(np.uint8), np.sqrt(((rest - coded) ** 2).sum(1))

    def distances(self, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """From each query's residual to each coded vector of the list, by table lookup."""
        out = np.zeros((len(rest), len(codes)))
        for m, (s, w) in enumerate(zip(self.cuts, self.words, strict=True)):
            out += squares(rest[:, s], w)[:, codes[:, m]]
        return np.sqrt(out)


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Vectors kept as bytes of 64-bit numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def usable(vector: str, label: str):
    return (
        F.col(label).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def near_vectors(df: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label", sample_rows: int = 16_000) -> DataFrame:
    """Per row: key, n_links, component_id, kept (key = component_id).

    Vectors of equal, non-null labels with a cosine of at least ``threshold``
    link. A vector that is null, empty, zero, or holds a null or non-finite
    component links with nothing, as does one of a null label or id: 0 links,
    a component of its own, kept. Vectors of different lengths have no cosine
    and do not link. Lengths up to the same power of two share an index, in
    lists of their own. Rows of one id are one vertex.
    """
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    good = rows.filter(usable("v", "label") & F.col("id").isNotNull())
    classes = good.groupBy("label", "v").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "vector-classes")
    spans = classes.groupBy(F.ceil(F.log2(F.size("v"))).cast("int").alias("span")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("labels"), F.max(F.size("v")).alias("dim")).collect()
    if not spans:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = None
    for span in spans:  # at most one for each power of two
        dim = span["dim"]
        # zeros at the end change no cosine between vectors of one length
        padded = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("v")))
        indexed = classes.filter(F.ceil(F.log2(F.size("v"))) == span["span"])
        indexed = indexed.select(F.struct("label", F.size("v").alias("width")).alias("label"), padded.alias("v"), "head", "copies")
        sample = unit(np.array([r["v"] for r in bounded_sample(indexed.select("head", "v"), sample_rows, "head").collect()], np.float64))
        quantiser = Quantiser.fit(sample, int(min(max(np.sqrt(span["n"] / span["labels"]), 1), MAX_CENTRES)))
        links = materialize(lookups(indexed, quantiser, threshold, dim), "vector-links")
        found = links if found is None else found.unionByName(links)
    counts = found.filter("other IS NULL").groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.filter("other IS NOT NULL").select(F.col("id").alias("src"), F.col("other").alias("dst")).distinct()
    # one id with several vectors joins their classes
    known = good.join(classes, ["label", "v"])
    firsts = known.groupBy("id").agg(F.min("head").alias("dst"))
    edges = edges.unionByName(known.join(firsts, "id").filter("head <> dst").select(F.col("head").alias("src"), "dst").distinct())
    comps = components(edges).select(F.col("id").alias("head"), "comp")
    named = classes.join(counts.withColumnRenamed("id", "head"), "head", "left").join(comps, "head", "left")
    named = materialize(named.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("comp", "head").alias("comp")), "vector-named")
    out = rows.withColumn("ok", usable("v", "label") & F.col("id").isNotNull()).join(named, ["label", "v"], "left")
    comp = F.when(F.col("ok"), F.coalesce("comp", "id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(key), F.when(F.col("ok"), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"),
    )


def lookups(classes: DataFrame, quantiser: Quantiser, threshold: float, dim: int) -> DataFrame:
    """(id, links, null) sums of linked copies, and (id, 0, other) edges of a spanning forest of each block."""
    reach = float(np.sqrt(max(2 - 2 * threshold, 0))) + SLACK
    between = np.sqrt(squares(quantiser.coarse, quantiser.coarse))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for the list of a vector, and one for each list of a number at least as high that can hold a neighbour."""
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                x = unit(b.column("v").flatten().to_numpy().reshape(-1, dim))
                d = squares(x, quantiser.coarse)
                home = d.argmin(1)
                gap = d - d[np.arange(len(x)), home][:, None]
                ask = (gap <= 2 * reach * between[home] + SLACK) & (np.arange(d.shape[1])[None, :] >= home[:, None])
                codes, error = quantiser.encode(x - quantiser.coarse[home])
                raw = np.array([r.tobytes() for r in x], object)
                who, cell = np.nonzero(ask)
                n, m = len(x), len(who)
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([b.column("label"), b.column("label").take(pa.array(who))]),
                    pa.array(np.concatenate([home, cell]), pa.int32()), pa.array(np.repeat([False, True], [n, m])),
                    pa.concat_arrays([b.column("head"), b.column("head").take(pa.array(who))]),
                    pa.concat_arrays([b.column("copies"), b.column("copies").take(pa.array(who))]),
                    pa.array([*raw, *raw[who]], pa.binary()), pa.array([r.tobytes() for r in codes] + [None] * m, pa.binary()),
                    pa.array(np.concatenate([error, np.zeros(m)])), pa.array(np.concatenate([home == home, cell == home[who]])),
                ], names=["label", "cell", "asks", "head", "copies", "x", "codes", "error", "own"])

    def search(t: pa.Table) -> pa.Table:
        asks = t["asks"].to_numpy().astype(bool)
        q, r = t.filter(pa.array(asks)), t.filter(pa.array(~asks))
        ids, links, other = [], [], []
        if q.num_rows and r.num_rows:
            cell = t["cell"][0].as_py()
            x, y = matrix(q["x"], dim), matrix(r["x"], dim)
            codes = np.frombuffer(b"".join(r["codes"].to_pylist()), np.uint8).reshape(len(y), -1)
            close = quantiser.distances(x - quantiser.coarse[cell], codes) <= reach + r["error"].to_numpy()[None, :] + SLACK
            qi, ri, own = q["head"].to_numpy(), r["head"].to_numpy(), q["own"].to_numpy().astype(bool)
            # in a vector's own list each pair comes from its smaller id
            close &= ~own[:, None] | (qi[:, None] < ri[None, :])
            a, b = np.nonzero(close)
            keep = np.zeros(len(a), bool)
            for at in range(0, len(a), 100_000):
                s = slice(at, at + 100_000)
                keep[s] = np.einsum("ij,ij->i", x[a[s]], y[b[s]]) >= threshold
            a, b = a[keep], b[keep]
            for mine, theirs, i, copies in ((a, b, qi, r["copies"].to_numpy()), (b, a, ri, q["copies"].to_numpy())):
                total = np.bincount(mine, weights=copies[theirs], minlength=len(i))
                hit = np.flatnonzero(total)
                ids.extend(i[hit].tolist())
                links.extend(total[hit].astype(np.int64).tolist())
                other.extend([None] * len(hit))
            for u, v in forest(qi[a], ri[b]):
                ids.append(u)
                links.append(0)
                other.append(v)
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()), "other": pa.array(other, pa.int64())})

    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.mapInArrow(place, f"label {kind}, cell int, asks boolean, head long, copies long, x binary, codes binary, error double, own boolean")
    placed = materialize(placed, "vector-lists")
    sizes = placed.groupBy("label", "cell").agg(
        F.ceil(F.count_if(~F.col("asks")) / LIST_ROWS).alias("rows"), F.ceil(F.count_if("asks") / ASK_ROWS).alias("lots"))
    sizes = materialize(sizes.filter("rows > 0 AND lots > 0"), "vector-list-sizes")
    both = placed.join(sizes, ["label", "cell"])
    mine = F.when(F.col("asks"), F.pmod(F.xxhash64("head"), F.col("lots"))).otherwise(F.pmod(F.xxhash64("head"), F.col("rows")))
    blocks = both.withColumn("mine", mine).withColumn("theirs", F.explode(F.expr("sequence(0L, IF(asks, rows, lots) - 1)")))
    blocks = blocks.withColumn("block", F.expr("IF(asks, mine * rows + theirs, theirs * rows + mine)")).drop("rows", "lots", "mine", "theirs")
    return blocks.groupBy("label", "cell", "block").applyInArrow(search, "id long, links long, other long")


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that hold the components of the given pairs together."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
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
