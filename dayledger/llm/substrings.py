"""Substring deduplication: runs of words that occur more than once, found from difference-cover anchors.

Two equal runs of ``width`` words may start anywhere. With a difference cover
D of the residues modulo v, every two places i and j have a shift below v that
moves both onto places of D. So it is enough to hash runs of
``width - v + 1`` words at places of D: equal windows share such an anchor at
the same distance. Windows around anchors that occur once cannot repeat and
are dropped there; the others are extended to the full width and compared by
96 bits of hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.shards import (
    at_most_twice, buckets_for, by_bucket, joined, packed, sharded, shards_for, text_slices, volume, with_shards,
)
from dayledger.llm.words import buffers, find_words, mix, rolling

# Perfect difference sets by period: every non-zero residue is the difference of one pair.
COVERS = {1: (0,), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
LEAST_ANCHOR = 12  # words; shorter ones would meet by chance


def cover_for(width: int) -> int:
    return max(v for v in COVERS if v == 1 or width - v + 1 >= LEAST_ANCHOR)


def runs(words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs of ``width`` words within one document, and their hashes."""
    h = rolling(hashes, width)
    inside = np.zeros(len(hashes), bool)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= width:
            inside[a : b - width + 1] = True
    at = np.flatnonzero(inside[: len(h)])
    return at, h[at]


def anchors(words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of each document."""
    v = cover_for(width)
    at, h = runs(words, hashes, width - v + 1)
    on = np.zeros(v, bool)
    on[list(COVERS[v])] = True
    place = at - np.repeat(words.first[:-1], words.counts)[at]
    keep = on[place % v]
    return at[keep], h[keep]


def near_anchor(words, places: np.ndarray, width: int) -> np.ndarray:
    """Whether a window that starts at each word has one of the anchors in reach: starts up to v - 1 words before it."""
    v = cover_for(width)
    n = len(words.starts)
    edge = np.zeros(n + 1, np.int64)
    low = np.maximum(places - v + 1, np.repeat(words.first[:-1], words.counts)[places])
    np.add.at(edge, low, 1)
    np.add.at(edge, places + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def dedup_substrings(docs: DataFrame, width: int = 35, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, n_removed, kept (words joined by one space), removed (word spans [begin, end)).

    A word goes if it lies in a window of ``width`` words whose words also
    start at another place, in the same text or another; windows are those
    of the input. A null text has no words. A text of fewer words than the
    width loses none. Rows of equal id and text count as separate texts, so
    they repeat each other; a null id is kept as it is.
    """
    docs = docs.select(key, text)
    size = volume(docs, text)
    n = shards_for(docs, size)
    texts = sharded(docs, key, text, n)
    v = cover_for(width)
    anchor_buckets = buckets_for(size / 6 * len(COVERS[v]) / v, 12)
    window_buckets = buckets_for(size / 12, 12)

    def send_anchors(mine: pa.Table) -> pa.Table:
        """At most two of a kind from a shard, however many of its documents quote a passage."""
        hs = [np.zeros(0, np.uint64)]
        for b in text_slices(mine):
            words = find_words(*buffers(b.column("text")))
            h = anchors(words, words.hashes(), width)[1]
            hs.append(h[at_most_twice(h)])
        h = np.concatenate(hs)
        h = h[at_most_twice(h)]
        order, found, bounds = by_bucket(h, anchor_buckets)
        (keys,) = packed([h[order]], bounds)
        return pa.table({"bucket": pa.array(found, pa.int32()), "shard": pa.array(np.full(len(found), mine["shard"][0].as_py()), pa.int32()), "keys": pa.array(keys, pa.binary())})

    def answer(h: np.ndarray, again: np.ndarray, owner: np.ndarray) -> pa.Table:
        h, owner = h[again], owner[again]
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[fresh], owner[fresh]
        who, first = np.unique(owner, return_index=True)
        (keys,) = packed([h], np.append(first, len(h)))
        return pa.table({"shard": pa.array(who, pa.int32()), "keys": pa.array(keys, pa.binary())})

    def meet_anchors(t: pa.Table) -> pa.Table:
        h, sizes = joined(t["keys"], np.uint64)
        _, at, count = np.unique(h, return_inverse=True, return_counts=True)
        return answer(h, count[at] > 1, np.repeat(t["shard"].to_numpy(), sizes))

    def send_windows(mine: pa.Table, told: pa.Table) -> pa.Table:
        known = np.sort(joined(told["keys"], np.uint64)[0])
        hs, xs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        shard = mine["shard"][0].as_py() if mine.num_rows else 0
        for b in text_slices(mine) if len(known) else ():
            words = find_words(*buffers(b.column("text")))
            hashes = words.hashes()
            at, h = anchors(words, hashes, width)
            reach = near_anchor(words, at[contains(known, h)], width)
            start, w = runs(words, hashes, width)
            hs.append(w[reach[start]])
            xs.append((rolling(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), width)[start[reach[start]]] >> np.uint64(32)).astype(np.uint32))
        h, x = np.concatenate(hs), np.concatenate(xs)
        keep = at_most_twice(h, x)
        h, x = h[keep], x[keep]
        order, found, bounds = by_bucket(h, window_buckets)
        keys, more = packed([h[order], x[order]], bounds)
        return pa.table({"bucket": pa.array(found, pa.int32()), "shard": pa.array(np.full(len(found), shard), pa.int32()), "keys": pa.array(keys, pa.binary()), "more": pa.array(more, pa.binary())})

    def meet_windows(t: pa.Table) -> pa.Table:
        h, count = joined(t["keys"], np.uint64)
        x = joined(t["more"], np.uint32)[0]
        owner = np.repeat(t["shard"].to_numpy(), count)
        order = np.lexsort((x, h))
        h, x, owner = h[order], x[order], owner[order]
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = (h[1:] == h[:-1]) & (x[1:] == x[:-1])
        return answer(h, same[1:] | same[:-1], owner)

    def cut(mine: pa.Table, told: pa.Table) -> pa.Table:
        known = np.sort(joined(told["keys"], np.uint64)[0])
        out = []
        for b in text_slices(mine):
            words = find_words(*buffers(b.column("text")))
            start, h = runs(words, words.hashes(), width)
            edge = np.zeros(len(words.starts) + 1, np.int64)
            hit = start[contains(known, h)]
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + width, -1)
            gone = np.cumsum(edge[:-1]) > 0
            out.append(pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(words.counts, pa.int64()), *remains(words, gone)],
                names=["id", "n_words", "n_removed", "kept", "removed"],
            ))
        return pa.Table.from_batches(out) if out else None

    kind = docs.schema[key].dataType.simpleString()
    sent = texts.groupBy("shard").applyInArrow(send_anchors, "bucket int, shard int, keys binary")
    told = sent.groupBy("bucket").applyInArrow(meet_anchors, "shard int, keys binary")
    sent = with_shards(texts, told, send_windows, "bucket int, shard int, keys binary, more binary")
    told = sent.groupBy("bucket").applyInArrow(meet_windows, "shard int, keys binary")
    schema = f"id {kind}, n_words long, n_removed long, kept string, removed array<struct<begin:long,end:long>>"
    return with_shards(texts, told, cut, schema).withColumnRenamed("id", key)


def contains(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array."""
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return known[at] == keys


def remains(words, gone: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Per document: removed words, kept text, removed spans."""
    docs = len(words.first) - 1
    owner = words.document()
    removed = np.bincount(owner[gone], minlength=docs)
    kept = np.flatnonzero(~gone)
    length = words.ends[kept] - words.starts[kept] + 1
    out = np.full(int(length.sum()), 32, np.uint8)
    begin = np.cumsum(length) - length
    inner = np.arange(len(out)) - np.repeat(begin, length)
    source = np.repeat(words.starts[kept], length) + inner
    real = inner < np.repeat(length - 1, length)
    out[real] = words.data[source[real]]
    # bounds of each document's words; the space after its last word is left out
    first = np.searchsorted(owner[kept], np.arange(docs + 1))
    edges = np.append(begin, len(out))
    texts = [out[edges[a] : max(edges[b] - 1, edges[a])].tobytes().decode() for a, b in zip(first[:-1], first[1:], strict=True)]
    before, after = np.zeros(len(gone), bool), np.zeros(len(gone), bool)
    before[1:] = gone[:-1] & (owner[1:] == owner[:-1])
    after[:-1] = gone[1:] & (owner[1:] == owner[:-1])
    a, b = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
    base = words.first[owner[a]]
    spans = pa.StructArray.from_arrays([pa.array(a - base, pa.int64()), pa.array(b - base + 1, pa.int64())], names=["begin", "end"])
    bounds = np.searchsorted(owner[a], np.arange(docs + 1)).astype(np.int32)
    return pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)


def substring_report(docs: DataFrame, width: int = 35) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    return dedup_substrings(docs, width).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
