"""Token counts by prefix dynamic programming over a piece vocabulary.

Pieces of the vocabulary hold a space only at their start and no line end, so
an encoding falls apart into that of units: a run of other characters with the
spaces before it, spaces at a line's end, one line end. Where no piece joins
letters with other signs, such runs are cut between them too. Within a unit the
table has an entry for every prefix: how many tokens the prefix encodes to,
and the last of them. The encoding of a prefix is that of a shorter prefix
plus one piece ``t``; the right one is where the last token ``s`` of the
shorter prefix and ``t`` stay as they are when ``s + t`` is encoded alone.
Sums over units give the exact count at every prefix of a text, so questions
about truncation and budgets need no further encoding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.frames import extended

UNIT = re.compile(r" *[^ \n]+| +|\n")
# where no piece joins a Latin letter with another sign, runs of either are units of their own
LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
FINE_UNIT = re.compile(rf" *[{LETTER}]+| *[^{LETTER} \n]+| +|\n")
CACHED_UNITS = 500_000  # bounds a task's memory; a full cache starts anew


class PrefixTable:
    """Exact token counts of prefixes for one sentencepiece BPE model with identity normalization."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.sp.get_piece_size())
        self.pieces = {
            self.sp.id_to_piece(i).replace("▁", " ") for i in ids
            if not (self.sp.is_control(i) or self.sp.is_byte(i) or self.sp.is_unknown(i))
        }
        inner = [p for p in self.pieces if " " in p.lstrip(" ") or "\n" in p]
        if inner:
            raise ValueError("pieces of this vocabulary cross words")
        letter = re.compile(f"[{LETTER}]")
        mixed = any(bool(letter.match(a)) != bool(letter.match(b)) for p in self.pieces for s in [p.lstrip(" ")] for a, b in zip(s, s[1:]))
        self.unit = UNIT if mixed else FINE_UNIT
        self.longest = max(map(len, self.pieces))
        # what the encoder yields for a line end at the start of a text: its own tokens come before the rest
        self.lead = len(self.sp.encode("\n"))
        self.units: dict[str, int] = {}
        self.stay: dict[tuple[str, str], bool] = {}

    def kept_apart(self, s: str, t: str) -> bool:
        """Whether pieces s and t next to each other stay two tokens."""
        key = (s, t)
        if key not in self.stay:
            if len(self.stay) > CACHED_UNITS:
                self.stay.clear()
            got = self.sp.encode("\n" + s + t, out_type=str)[self.lead :]
            self.stay[key] = [g.replace("▁", " ") for g in got] == [s, t]
        return self.stay[key]

    def unit_counts(self, unit: str) -> list[int]:
        """Tokens of each prefix of a unit, the empty one first."""
        counts, last = [0], [""]
        for j in range(1, len(unit) + 1):
            for i in range(max(0, j - self.longest), j):
                t = unit[i:j]
                if t in self.pieces and (not last[i] or self.kept_apart(last[i], t)):
                    counts.append(counts[i] + 1)
                    last.append(t)
                    break
            else:  # a character outside the vocabulary: one token a byte, never merged
                counts.append(counts[j - 1] + len(unit[j - 1].encode()))
                last.append("")
        return counts

    def unit_total(self, unit: str) -> int:
        n = self.units.get(unit)
        if n is None:
            if len(self.units) > CACHED_UNITS:
                self.units.clear()
            n = self.units[unit] = self.unit_counts(unit)[-1]
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "▁" in text:  # stands for a space in the vocabulary
            text = text.replace("▁", " ")
        return sum(map(self.unit_total, self.unit.findall(" " + text)))

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of each prefix of a text by characters: entry k is the count of ``text[:k]``."""
        if not text:
            return [0]
        out, base = [], 0
        for unit in self.unit.findall(" " + text.replace("▁", " ")):
            counts = self.unit_counts(unit)
            out.extend(base + c for c in counts[1:])
            base += counts[-1]
        return [0, *out[1:]]  # the first entry is that of the space put in front

    def fits(self, text: str, budget: int) -> int:
        """Length of the longest prefix of at most ``budget`` tokens, without cutting a character."""
        units = self.unit.findall(" " + text.replace("▁", " ")) if text else []
        ends = list(accumulate(map(len, units)))
        sums = list(accumulate(map(self.unit_total, units)))
        # counts may fall within a unit, so each unit that begins within the budget is looked at, last first
        for u in range(len(units) - 1, -1, -1):
            if sums[u] <= budget:
                return ends[u] - 1
            base = sums[u] - self.unit_total(units[u])
            if base <= budget:
                counts = self.unit_counts(units[u])
                k = max((k for k, c in enumerate(counts) if base + c <= budget), default=0)
                if k:
                    return ends[u] - len(units[u]) + k - 1
        return 0


def token_counts(df: DataFrame, model_path: str, text: str = "text", budgets: tuple[int, ...] = ()) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and for each budget b ``fits_<b>``, the characters that b tokens hold.

    Null texts count as empty: 0 bytes, 0 tokens. Columns of the input that
    have one of these names are replaced. No row moves; any number of equal
    rows, and texts of any length, are counted as they are.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    added = ["n_bytes", "n_tokens", *[f"fits_{b}" for b in budgets]]
    df = df.drop(*[c for c in added if c != text])
    keep = df.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PrefixTable(model)
        for b in batches:
            texts = b.column(keep.index(text)).to_pylist()
            cols = [pa.array([len((x or "").encode()) for x in texts], pa.int64())]
            cols.append(pa.array([table.count(x or "") for x in texts], pa.int64()))
            cols.extend(pa.array([table.fits(x or "", k) for x in texts], pa.int64()) for k in budgets)
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*keep, *added])

    return df.mapInArrow(count, extended(df.schema, ", ".join(f"{c} long" for c in added)))


def count_report(df: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    counted = token_counts(df.select("doc_id", "text"), model_path)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
