"""Toxicity scores: a bidirectional gated recurrent network with attention pooling over windows of words.

A word enters as the sum of a hashed word vector, the mean of its hashed
character 4-gram vectors and the mean of the hashed vectors of its beginnings. Every text is scored as a whole: windows of WINDOW
words start every STRIDE words, and the document's score is that of its
highest window. The network is trained in numpy by back-propagation through
time on a bounded sample of labelled documents; each round it learns from the
windows that it now scores highest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.frames import boxed, extended
from dayledger.llm.gru import PAD_GATE, Adam, scan, sigmoid, unscan
from dayledger.llm.sampling import bounded_sample, crc_mod
from dayledger.llm.words import buffers, byte_table, mix, pieces

WINDOW, STRIDE, WIDE = 32, 16, 4096
HIDDEN, DIM = 8, 8
WORD_SLOTS, GRAM_SLOTS, HEAD_SLOTS, GRAM = 1 << 14, 1 << 15, 1 << 16, 4
SMOOTH = 4  # documents without evidence that a slot is taken to have besides its own
HEADS = range(4, 10)  # bytes of the beginnings that are told apart

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Tokens:
    """Letter runs of a batch of texts, by distinct word."""

    word: np.ndarray  # index of the distinct word at each place
    first: np.ndarray  # places of each document
    slot: np.ndarray  # word slot of each distinct word
    gram: np.ndarray  # gram slots of all distinct words, one after the other
    gram_word: np.ndarray  # whose they are
    head: np.ndarray  # slots of the beginnings of all distinct words
    head_word: np.ndarray


def tokenize(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Words are runs of ASCII letters and of bytes above them, so that signs stuck to a word do not hide it. A word
    that follows itself is read once: windows of one word are like nothing that was learned from."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _LETTER[data]
    begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    full = np.flatnonzero(np.diff(offsets))
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    begins[heads], stops[tails] = inside[1:-1][heads], inside[1:-1][tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15)
        # rolling sums would need powers of the whole buffer: words are short, so hash their distinct bytes by place
        table = byte_table(5)
        sums = np.zeros(len(data) + 1, np.uint64)
        place = np.arange(len(data), dtype=np.uint64)
        owner = np.zeros(len(data) + 1, np.int64)
        owner[starts] = starts
        owner = np.maximum.accumulate(owner)[:-1]
        rel = (place - owner.astype(np.uint64)) * base
        np.cumsum(mix(table[data] ^ rel) if len(data) else np.zeros(0, np.uint64), out=sums[1:])
        keys = mix(sums[ends] - sums[starts])
        fresh = np.ones(len(keys), bool)
        owner = np.searchsorted(offsets, starts, "right")
        fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        starts, ends, keys = starts[fresh], ends[fresh], keys[fresh]
        distinct, at, word = np.unique(keys, return_index=True, return_inverse=True)
        s, e = starts[at], ends[at]
        # grams of " word ": the word with one space on each side, at least one gram
        length = e - s + 2
        grams = np.maximum(length - GRAM + 1, 1)
        gram_word = np.repeat(np.arange(len(distinct)), grams)
        begin = np.arange(len(gram_word)) - np.repeat(np.cumsum(grams) - grams, grams)
        code = np.zeros(len(gram_word), np.uint64)
        padded = np.concatenate([data, np.zeros(1, np.uint8)])
        for k in range(GRAM):
            off = begin + k - 1
            real = (off >= 0) & (off < (e - s)[gram_word])
            byte = np.where(real, padded[np.minimum(np.maximum(s[gram_word] + off, 0), len(data))], 32)
            code = code * np.uint64(257) + byte.astype(np.uint64) + np.uint64(1)
        heads, head_words, so_far = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], np.zeros(len(s), np.uint64)
        for k in range(max(HEADS)):
            so_far = so_far * np.uint64(0x100000001B3) + padded[np.minimum(s + k, len(data))].astype(np.uint64) + np.uint64(1)
            if k + 1 in HEADS:
                long = np.flatnonzero(e - s > k)
                heads.append(mix(so_far[long] + np.uint64(k)))
                head_words.append(long)
        head, head_word = np.concatenate(heads), np.concatenate(head_words)
        by_word = np.argsort(head_word, kind="stable")
    return Tokens(word, np.searchsorted(starts, offsets), (distinct % np.uint64(WORD_SLOTS)).astype(np.int64),
                  (mix(code) % np.uint64(GRAM_SLOTS)).astype(np.int64), gram_word,
                  (head[by_word] % np.uint64(HEAD_SLOTS)).astype(np.int64), head_word[by_word])


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length in places, and document, of the windows that cover every word."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return first[:-1][doc] + start, np.minimum(WINDOW, n[doc] - start), doc


@dataclass
class ToxicModel:
    params: dict[str, np.ndarray]

    def word_vectors(self, tok: Tokens) -> np.ndarray:
        """(DIM, words) vectors of the distinct words."""
        p, n = self.params, len(tok.slot)
        out = p["words"][:, tok.slot]
        for key, slots, owner in (("grams", tok.gram, tok.gram_word), ("heads", tok.head, tok.head_word)):
            count = np.maximum(np.bincount(owner, minlength=n), 1)
            out = out + np.stack([np.bincount(owner, weights=row[slots], minlength=n) for row in p[key]]) / count
        return out.astype(np.float32)

    def inputs(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Both directions' input table, its last column a padded step."""
        out = []
        for side in "fb":
            x = np.zeros((3 * HIDDEN, vectors.shape[1] + 1), np.float32)
            x[:, :-1] = self.params[f"p{side}"] @ vectors + self.params[f"b{side}"][:, None]
            x[:HIDDEN, -1] = PAD_GATE
            out.append(x)
        return out

    def run(self, tables: list[np.ndarray], at: np.ndarray, keep: tuple[list, list] | None = None) -> tuple:
        """Scores of windows ``at`` (WINDOW, n) of word indices, -1 for none; with states, attention and pooled state."""
        p, n = self.params, at.shape[1]
        f = scan(lambda t: np.take(tables[0], at[t], axis=1), range(WINDOW), n, p["uf"], p["cf"], keep and keep[0])
        b = scan(lambda t: np.take(tables[1], at[t], axis=1), range(WINDOW)[::-1], n, p["ub"], p["cb"], keep and keep[1])
        h = np.concatenate([f, b], axis=1)
        a = np.einsum("h,thn->tn", p["att"], h)
        a[at < 0] = -1e9
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tn,thn->hn", a, h)
        return sigmoid(p["out"] @ pooled + p["off"][0]), h, a, pooled

    def window_scores(self, tok: Tokens, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        tables = self.inputs(self.word_vectors(tok))
        out = np.zeros(len(start))
        for i in range(0, len(start), WIDE):
            out[i : i + WIDE] = self.run(tables, places(tok, start[i : i + WIDE], length[i : i + WIDE]))[0]
        return out

    def document_scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Highest window of each document; 0 where there is no word."""
        out = np.zeros(len(offsets) - 1)
        tok = tokenize(data, offsets)
        start, length, doc = windows(tok.first)
        if len(start):
            np.maximum.at(out, doc, self.window_scores(tok, start, length))
        return out


def places(tok: Tokens, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    step = np.arange(WINDOW)[:, None]
    at = np.minimum(start[None, :] + step, len(tok.word) - 1)
    return np.where(step < length[None, :], tok.word[at], -1)


def fit(texts: list[str], labels: np.ndarray, rounds: int = 6, batch: int = 256, seed: int = 11) -> ToxicModel:
    rng = np.random.default_rng(seed)
    shapes = {"words": (DIM, WORD_SLOTS), "grams": (DIM, GRAM_SLOTS), "heads": (DIM, HEAD_SLOTS), "pf": (3 * HIDDEN, DIM), "pb": (3 * HIDDEN, DIM),
              "bf": (3 * HIDDEN,), "bb": (3 * HIDDEN,), "uf": (3 * HIDDEN, HIDDEN), "ub": (3 * HIDDEN, HIDDEN),
              "cf": (HIDDEN,), "cb": (HIDDEN,), "att": (2 * HIDDEN,), "out": (2 * HIDDEN,), "off": (1,)}
    p = {k: rng.normal(0, 0.02 if k in ("words", "grams", "heads") else 0.3, s).astype(np.float32) for k, s in shapes.items()}
    model = ToxicModel(p)
    tok = tokenize(*buffers(pa.array(texts, pa.large_string())))
    start, length, doc = windows(tok.first)
    if not len(start):
        return model
    start_vectors(p, tok, labels)
    small = {k: v for k, v in p.items() if k not in ("words", "grams", "heads")}
    adam = Adam(small, 0.02)
    for r in range(rounds):
        scores = model.window_scores(tok, start, length)
        # of each document the two highest windows, of a clean one also a random one
        order = np.lexsort((-scores, doc))
        rank = np.arange(len(order)) - np.searchsorted(doc[order], doc[order])
        chosen = order[rank < np.where(labels[doc[order]] == 1, 1, 2)]
        other = rng.integers(0, len(start), len(texts))
        chosen = np.concatenate([chosen, other[labels[doc[other]] == 0]])
        rng.shuffle(chosen)
        y = labels[doc[chosen]].astype(np.float32)
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3)).astype(np.float32)
        for i in range(0, len(chosen), batch):
            learn(model, adam, tok, places(tok, start[chosen[i : i + batch]], length[chosen[i : i + batch]]),
                  y[i : i + batch], weight[i : i + batch], 0.05 if r else 0.0)
    return model


def start_vectors(p: dict[str, np.ndarray], tok: Tokens, labels: np.ndarray) -> None:
    """A coordinate for each kind of slot: smoothed log odds of the slot in toxic against other training documents.

    A word counts once for a document, however often the text repeats it.
    """
    n = len(tok.slot)
    pairs = np.unique(np.repeat(np.arange(len(labels)), np.diff(tok.first)) * n + tok.word)
    word_all = np.bincount(pairs % n, minlength=n)
    word_toxic = np.bincount(pairs % n, weights=labels[pairs // n], minlength=n)
    kinds = (("words", tok.slot, np.arange(len(tok.slot))), ("grams", tok.gram, tok.gram_word), ("heads", tok.head, tok.head_word))
    for i, (key, slots, owner) in enumerate(kinds):
        a = np.bincount(slots, weights=word_toxic[owner], minlength=p[key].shape[1])
        b = np.bincount(slots, weights=(word_all - word_toxic)[owner], minlength=p[key].shape[1])
        rate = (a.sum() + 1) / (b.sum() + 1)
        p[key][i] += (0.5 * np.log((a + SMOOTH * rate) / (b + SMOOTH) / rate)).astype(np.float32)


def learn(model: ToxicModel, adam: Adam, tok: Tokens, at: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float) -> None:
    """One step on a batch of windows; the vectors of the words in it, of their grams and of their beginnings follow with
    plain gradient steps."""
    p = model.params
    used, at, part = part_tokens(tok, at)
    vectors = model.word_vectors(part)
    keep: tuple[list, list] = ([], [])
    score, h, a, pooled = model.run(model.inputs(vectors), at, keep)
    d = (score - y) * weight / len(y)
    grads = {"out": pooled @ d, "off": np.array([d.sum()], np.float32)}
    d_pooled = p["out"][:, None] * d
    d_a = np.einsum("hn,thn->tn", d_pooled, h)
    d_s = a * (d_a - (a * d_a).sum(0))
    grads["att"] = np.einsum("tn,thn->h", d_s, h)
    d_h = a[:, None, :] * d_pooled[None] + d_s[:, None, :] * p["att"][:, None]
    real = at.ravel() >= 0
    words = at.ravel()[real]
    d_v = np.zeros((len(used), DIM), np.float32)
    for side, rows in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
        d_x, grads[f"u{side}"], grads[f"c{side}"] = unscan(np.ascontiguousarray(d_h[:, rows]), keep[side == "b"], p[f"u{side}"])
        d_x = d_x.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN)[real]
        grads[f"p{side}"] = d_x.T @ vectors[:, words].T
        grads[f"b{side}"] = d_x.sum(0)
        np.add.at(d_v, words, d_x @ p[f"p{side}"])
    adam.step({k: v.astype(np.float32) for k, v in grads.items()})
    if rate:
        np.add.at(p["words"].T, tok.slot[used], -np.clip(rate * len(y) * d_v, -0.05, 0.05))
        for key, slots, owner in (("grams", part.gram, part.gram_word), ("heads", part.head, part.head_word)):
            # a word's vector is the mean of its slots: each gets its share, and a slot the sum over its words
            share = d_v / np.maximum(np.bincount(owner, minlength=len(used)), 1)[:, None]
            found, of = np.unique(slots, return_inverse=True)
            d_slot = np.stack([np.bincount(of, weights=c[owner], minlength=len(found)) for c in share.T])
            p[key][:, found] -= np.clip(rate * len(y) * d_slot, -0.05, 0.05).astype(np.float32)


def part_tokens(tok: Tokens, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, Tokens]:
    """The distinct words of these windows, the windows in terms of them, and their slots."""
    used, compact = np.unique(at[at >= 0], return_inverse=True)
    small = np.full(at.shape, -1)
    small[at >= 0] = compact
    parts = []
    for slots, owner in ((tok.gram, tok.gram_word), (tok.head, tok.head_word)):
        lo, hi = np.searchsorted(owner, used), np.searchsorted(owner, used, "right")
        own = np.repeat(np.arange(len(used)), hi - lo)
        at_slot = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange(len(own))
        parts.extend((slots[at_slot], own))
    return used, small, Tokens(tok.word, tok.first, tok.slot[used], *parts)


def train(docs: DataFrame, labels: DataFrame, rows: int = 3000, max_chars: int = 6_000) -> ToxicModel | None:
    """Model from about ``rows`` labelled documents of at most ``max_chars``; None where there is none.

    Only documents with crc32(doc_id) mod 3 other than 1 are drawn. The drawn
    labels are bounded by ``rows``, so that they may be broadcast; an id gives
    one text, so that the driver gets no more texts than labels.
    """
    known = labels.filter((crc_mod("doc_id", 3) != 1) & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    drawn = bounded_sample(known, rows, "doc_id")
    texts = docs.filter(F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("doc_id", F.lower("text").alias("text"))
    # one text of an id, however many rows have it
    got = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    got = got.limit(2 * rows).toPandas().sort_values("doc_id")
    return fit(list(got["text"]), got["toxic"].to_numpy(np.int64)) if len(got) else None


def score(docs: DataFrame, model: ToxicModel | None, text: str = "text", name: str = "score") -> DataFrame:
    """Adds the toxicity of each text, 0 to 1; 0 for null texts, texts without a letter, or without a model.

    Rows are scored one by one from their text alone: equal texts get equal
    scores. A column of the given name is replaced; other columns stay.
    """
    box = boxed(docs, *[c for c in (name,) if c != text]).withColumn("low", F.lower(F.col("row").getField(text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "low", 1_000_000):
                s = np.zeros(b.num_rows) if model is None else model.document_scores(*buffers(b.column("low")))
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(np.clip(s, 0, 1), pa.float64())], names=["row", "score"])

    schema = extended(box.select("row").schema, "score double")
    return box.mapInArrow(run, schema).select("row.*", F.col("score").alias(name))


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, rows: int = 3000) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 where score >= threshold)."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, rows))
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
