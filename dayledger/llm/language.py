"""Language identification: a bidirectional gated recurrent network over bytes.

Every byte gets a probability for each language; a document's probabilities
are the means over its bytes. The network is trained in numpy by
back-propagation through time on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.frames import boxed, extended
from dayledger.llm.gru import PAD_GATE, Adam, scan, unscan
from dayledger.llm.sampling import bounded_sample, crc_mod
from dayledger.llm.words import buffers, pieces

SEGMENT = 128  # bytes that one run of the network reads
WIDE = 4096  # segments side by side
HIDDEN = 8
PAD = 256


@dataclass
class ByteModel:
    langs: list[str]
    params: dict[str, np.ndarray]

    def states(self, seg: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
        """Both directions' states at each byte: (SEGMENT, 2H, n). ``seg`` is (SEGMENT, n) byte codes."""
        p, n = self.params, seg.shape[1]
        f = scan(lambda t: np.take(p["xf"], seg[t], axis=1), range(len(seg)), n, p["uf"], p["cf"], keep and keep[0])
        b = scan(lambda t: np.take(p["xb"], seg[t], axis=1), range(len(seg))[::-1], n, p["ub"], p["cb"], keep and keep[1])
        return np.concatenate([f, b], axis=1)

    def label(self, states: np.ndarray) -> np.ndarray:
        """Language probabilities of each byte: (SEGMENT, languages, n)."""
        a = np.matmul(self.params["v"], states) + self.params["d"][:, None]
        a -= a.max(1, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(1, keepdims=True)
        return a

    def document_sums(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sums of the byte probabilities of each document: (documents, languages)."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        seg, doc = segments(data, offsets)
        for at in range(0, seg.shape[1], WIDE):
            part = seg[:, at : at + WIDE]
            probs = self.label(self.states(part)) * (part != PAD)[:, None, :]
            np.add.at(out, doc[at : at + WIDE], probs.sum(0).T)
        return out


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents cut into runs of SEGMENT bytes, the last padded: (SEGMENT, n) and each run's document."""
    runs = -(-np.diff(offsets) // SEGMENT)
    doc = np.repeat(np.arange(len(runs)), runs)
    first = np.cumsum(runs) - runs
    start = offsets[:-1][doc] + (np.arange(len(doc)) - first[doc]) * SEGMENT
    at = start[None, :] + np.arange(SEGMENT)[:, None]
    inside = at < offsets[1:][doc][None, :]
    seg = np.full(at.shape, PAD, np.int32)
    seg[inside] = data[at[inside]]
    return seg, doc


def hold_pad(params: dict[str, np.ndarray]) -> None:
    for k in ("xf", "xb"):
        params[k][:, PAD] = 0
        params[k][:HIDDEN, PAD] = PAD_GATE


def fit(texts: list[str], langs: list[str], rounds: int = 6, batch: int = 256, seed: int = 7) -> ByteModel:
    """Each byte of a training segment has its document's language as label."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    shapes = {"xf": (3 * HIDDEN, 257), "xb": (3 * HIDDEN, 257), "uf": (3 * HIDDEN, HIDDEN), "ub": (3 * HIDDEN, HIDDEN),
              "cf": (HIDDEN,), "cb": (HIDDEN,), "v": (len(names), 2 * HIDDEN), "d": (len(names),)}
    params = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items()}
    hold_pad(params)
    model = ByteModel(names, params)
    seg, doc = segments(*buffers(pa.array(texts, pa.large_string())))
    # several segments of each document: long ones do not outweigh the rest
    order = rng.permutation(seg.shape[1])
    rank = np.zeros(len(doc), int)
    seen = np.zeros(len(texts), int)
    for i in order:
        rank[i] = seen[doc[i]]
        seen[doc[i]] += 1
    chosen = np.flatnonzero(rank < 4)
    want = np.array([names.index(x) for x in langs], int)
    adam = Adam(params, 0.02)
    for _ in range(rounds):
        rng.shuffle(chosen)
        for at in range(0, len(chosen), batch):
            i = chosen[at : at + batch]
            part, keep = seg[:, i], ([], [])
            h = model.states(part, keep)
            probs = model.label(h)
            real = (part != PAD).astype(np.float32)
            probs[:, want[doc[i]], np.arange(len(i))] -= 1
            d_a = probs * (real / real.sum())[:, None, :]
            d_h = np.matmul(params["v"].T, d_a)
            grads = {"v": np.einsum("tcn,thn->ch", d_a, h), "d": d_a.sum((0, 2))}
            for side, rows in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
                d_x, grads[f"u{side}"], grads[f"c{side}"] = unscan(np.ascontiguousarray(d_h[:, rows]), keep[side == "b"], params[f"u{side}"])
                g = np.zeros((257, 3 * HIDDEN), np.float32)
                np.add.at(g, part.ravel(), d_x.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN))
                grads[f"x{side}"] = np.ascontiguousarray(g.T)
            adam.step(grads)
            hold_pad(params)
    return model


def train(docs: DataFrame, rows: int = 3000, max_chars: int = 20_000) -> ByteModel | None:
    """Model from about ``rows`` labelled documents of at most ``max_chars``; None where there is none.

    Only documents with crc32(doc_id) mod 4 other than 2, a language and a letter are drawn.
    """
    known = docs.filter((crc_mod("doc_id", 4) != 2) & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")
                        & (F.length("text") <= max_chars)).select("doc_id", "text", "lang")
    got = bounded_sample(known, rows, "doc_id").select("text", "lang").toPandas()
    return fit(list(got["text"]), list(got["lang"])) if len(got) else None


def identify(docs: DataFrame, model: ByteModel | None, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the mean probability of that language over the text's bytes.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text without a model. Equal rows get equal results, input columns with
    one of the two names are replaced, and every byte of a long text counts.
    """
    box = boxed(docs, *[c for c in ("lang_pred", "score") if c != text]).withColumn("text", F.col("row").getField(text))
    box = box.withColumn("letter", F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "text"):
                names, scores = [None] * b.num_rows, np.zeros(b.num_rows)
                letter = b.column("letter").to_numpy(zero_copy_only=False).astype(bool)
                if model is None:
                    letter = np.zeros(b.num_rows, bool)
                else:
                    data, offsets = buffers(b.column("text"))
                    sums = model.document_sums(data, offsets)
                    best = sums.argmax(1)
                    scores = sums[np.arange(len(best)), best] / np.maximum(np.diff(offsets), 1)
                    names = [model.langs[k] for k in best]
                out = [x if ok else "und" for x, ok in zip(names, letter, strict=True)]
                score = np.where(letter, np.clip(scores, 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.string()), pa.array(score, pa.float64())], names=["row", "lang_pred", "score"])

    schema = extended(box.select("row").schema, "lang_pred string, score double")
    return box.mapInArrow(run, schema).select("row.*", "lang_pred", "score")


def language_report(docs: DataFrame, rows: int = 3000) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    model = train(docs, rows)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
