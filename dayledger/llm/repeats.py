"""Periodic runs of words, found on-line by dyadic catchers.

A square is a stretch of words followed by itself. If its half has p words and
2B - 1 <= p <= 4B - 2, that half holds a whole block of B words that starts at
a multiple of B, and the block stands again p words later. So each completed
block of each power-of-two length B has a catcher, which compares the last B
words so far with its block while between 2B - 1 and 4B - 2 words have come
after the block began anew; every half length belongs to one B. Words are
appended in slices, and a slice advances all catchers that still watch. A caught
place is extended to both sides, and squares of one stretch merge into a run.
Stretches are compared by prefix sums modulo two primes; the words of every
run are compared themselves, and a text where that fails is read again with
other numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.words import buffers, find_words, mix, pieces

SLICE_WORDS = 1 << 20
CELLS = 1 << 21  # comparisons made at once
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525)

_POWERS: dict[tuple[int, int], np.ndarray] = {}


def power_table(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo the prime; the longest table asked for so far is kept."""
    have = _POWERS.get((base, prime), np.ones(1, np.uint64))
    while len(have) < n:
        step = np.uint64(pow(base, len(have), prime))
        have = np.concatenate([have, have * step % np.uint64(prime)])
    _POWERS[base, prime] = have
    return have[:n]


class Catchers:
    """Runs of at least ``power`` periods in the words of some texts, which are appended slice by slice.

    ``first`` holds the bounds of the texts among all words; no run crosses them.
    """

    def __init__(self, first: np.ndarray, power: int, salt: int = 0):
        self.first, self.power, self.n = first, power, 0
        self.bases = [(b + 2 * salt) % p for b, p in zip(BASES, PRIMES, strict=True)]
        self.sums = [np.zeros(int(first[-1]) + 1, np.uint32) for _ in PRIMES]
        self.found = np.zeros((0, 3), np.int64)  # start, period, end

    def text_bounds(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the text that holds each place, as far as its words have come."""
        text = np.searchsorted(self.first, at, "right") - 1
        return self.first[text], np.minimum(self.first[text + 1], self.n)

    def names(self, low: int, high: int, width: int) -> np.ndarray:
        """A number for each stretch of ``width`` words that starts in [low, high); equal stretches have equal ones."""
        out = np.zeros(max(high - low, 0), np.uint64)
        for base, prime, sums in zip(self.bases, PRIMES, self.sums, strict=True):
            back = power_table(pow(base, -1, prime), prime, high)[low:high]
            part = (sums[low + width : high + width].astype(np.uint64) + np.uint64(prime) - sums[low:high]) % np.uint64(prime)
            out = (out << np.uint64(32)) | (part * back % np.uint64(prime))
        return out

    def same(self, at: np.ndarray, width: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Whether the stretches from ``at`` and ``apart`` words later are equal."""
        out = np.ones(len(at), bool)
        for base, prime, sums in zip(self.bases, PRIMES, self.sums, strict=True):
            p = np.uint64(prime)
            here = (sums[at + width].astype(np.uint64) + p - sums[at]) % p
            there = (sums[at + apart + width].astype(np.uint64) + p - sums[at + apart]) % p
            out &= here * power_table(base, prime, int(apart.max(initial=0)) + 1)[apart] % p == there
        return out

    def reach(self, at: np.ndarray, room: np.ndarray, apart: np.ndarray, back: bool) -> np.ndarray:
        """How many words, ``room`` at most, equal those ``apart`` later, before or from ``at`` on: halving the step."""
        got = np.zeros(len(at), np.int64)
        step = 1 << max(int(room.max(initial=0)).bit_length() - 1, 0)
        while step and len(at):
            may = np.flatnonzero(got + step <= room)
            start = at[may] - got[may] - step if back else at[may] + got[may]
            got[may[self.same(start, np.full(len(may), step), apart[may])]] += step
            step //= 2
        return got

    def append(self, words: np.ndarray) -> None:
        """Further words, as 64-bit numbers: catchers compare, runs that were open at the end go on."""
        before, self.n = self.n, self.n + len(words)
        for base, prime, sums in zip(self.bases, PRIMES, self.sums, strict=True):
            value = (words % np.uint64(prime)) * power_table(base, prime, self.n)[before:] % np.uint64(prime)
            sums[before + 1 : self.n + 1] = (np.cumsum(value, dtype=np.uint64) + sums[before]) % np.uint64(prime)
        going_on = self.found[:, 2] == before
        start, period, end = self.found[going_on].T
        room = self.text_bounds(start)[1] - end
        self.found[going_on, 2] = end + self.reach(end - period, room, period, back=False)
        block = 1
        while self.advance(block, before):
            block *= 2

    def advance(self, block: int, before: int) -> bool:
        """Comparisons of the catchers of one block length for the words from ``before`` on; False where no text is long enough."""
        if (np.diff(self.first) // self.power).max(initial=0) < 2 * block - 1:
            return False
        # blocks whose catchers compare within this slice, and two blocks' length before, so that each stretch of three is seen at once
        low = max(before - 8 * block, 0) // block * block
        at = np.arange(low, self.n - block + 1, block)
        begin, end = self.text_bounds(at)
        longest = (self.first[np.searchsorted(self.first, at, "right")] - begin) // self.power
        widest = np.minimum(np.minimum(end - at - block, longest), 4 * block - 2)
        least = np.maximum(before - 2 * block - at - block + 1, 2 * block - 1)
        watch = widest >= least
        at, widest, least = at[watch], widest[watch], least[watch]
        if not len(at):
            return True
        names = self.names(low, self.n - block + 1, block)
        mine = names[at - low]
        text = np.searchsorted(self.first, at, "right")
        # neighbours in the row below: next block of the same text
        joined = np.append((np.diff(at) == block) & (text[1:] == text[:-1]), False)
        some = max(1, CELLS // len(at))
        for p0 in range(int(least.min()), int(widest.max()) + 1, some):
            apart = np.arange(p0, min(p0 + some, int(widest.max()) + 1))[:, None]
            place = at - low + apart
            np.minimum(place, len(names) - 1, out=place)
            equal = names[place] == mine
            equal &= (apart <= widest) & (apart >= least)
            # a stretch of this many periods holds at least so many blocks in a row
            rows = max(1, ((self.power - 1) * p0 - block + 1) // block)
            rows = min(rows, 3)
            chain = equal.copy()
            for k in range(1, rows):
                chain[:, :-k] &= equal[:, k:] & joined[k - 1 : len(at) - 1]
                chain[:, len(at) - k :] = False
            if rows > 1:
                chain[:, :-1] &= joined[:-1]
            # the first of each chain is enough: it is extended to both sides
            chain[:, 1:] &= ~(chain[:, :-1] & joined[:-1])
            which, cell = np.nonzero(chain)
            if len(cell):
                self.catch(at[cell], apart[which, 0], block)
        return True

    def catch(self, at: np.ndarray, period: np.ndarray, block: int) -> None:
        """Blocks that stand again ``period`` words later, extended and merged with the runs so far."""
        if len(self.found):
            # a square within a run whose period divides its own tells nothing new
            run = np.maximum(np.searchsorted(self.found[:, 0], at, "right") - 1, 0)
            start, short, stop = self.found[run].T
            new = (start > at) | (stop < at + block + period) | (period % short != 0)
            at, period = at[new], period[new]
        begin, end = self.text_bounds(at)
        start = at - self.reach(at, at - begin, period, back=True)
        stop = at + block + period
        stop += self.reach(at + block, end - stop, period, back=False)
        long = (stop - start >= self.power * period) | (stop == self.n)
        new = np.stack([start, period, stop], axis=1)[long]
        found = np.concatenate([self.found, new])
        found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
        # of one stretch the smallest period stays, and its multiples go
        fresh = np.ones(len(found), bool)
        fresh[1:] = (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 2]) != 0)
        least = found[np.maximum.accumulate(np.where(fresh, np.arange(len(found)), 0)), 1]
        self.found = found[fresh | (found[:, 1] % least != 0)]

    def runs(self, least: int) -> np.ndarray:
        """(start, length, period) of the runs of at least ``least`` words, by start, then period."""
        start, period, end = self.found.T
        keep = (end - start >= self.power * period) & (end - start >= least)
        out = np.stack([start, end - start, period], axis=1)[keep]
        return out[np.lexsort((out[:, 2], out[:, 0]))]


def find_runs(words: np.ndarray, first: np.ndarray, power: int, least: int, salt: int = 0) -> np.ndarray:
    catchers = Catchers(first, power, salt)
    for at in range(0, len(words), SLICE_WORDS):
        catchers.append(words[at : at + SLICE_WORDS])
    return catchers.runs(least)


def checked_runs(words: list[bytes], runs: np.ndarray, hashes: np.ndarray, power: int, least: int) -> np.ndarray:
    """The runs of one text if its words repeat as they say; else those found with other numbers."""
    salt = 0
    while not all(words[s : s + n - p] == words[s + p : s + n] for s, n, p in runs.tolist()):
        salt += 1
        runs = find_runs(mix(hashes + np.uint64(salt)), np.array([0, len(words)]), power, least, salt)
    return runs


def periodic_runs(docs: DataFrame, power: int = 4, least: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, runs (structs of start, length, period, by start, then period), collapsed.

    A run is a stretch of words with smallest period p, of at least ``power``
    periods and ``least`` words, that goes no further to either side. The
    collapsed text holds, joined by one space, the words that no run contains
    after its first period. A null or empty text has no words and no runs;
    rows are worked on one by one, equal rows and ids too, and no row moves.
    Other columns of the input do not take part.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "text"):
                data, offsets = buffers(b.column("text"))
                found = find_words(data, offsets)
                hashes = found.hashes()
                runs = find_runs(hashes, found.first, power, least)
                of_text = np.searchsorted(runs[:, 0], found.first)
                raw = data.tobytes()
                collapsed, sizes, out = [], [], []
                for d in range(b.num_rows):
                    words = raw[offsets[d] : offsets[d + 1]].split()
                    mine = runs[of_text[d] : of_text[d + 1]] - [found.first[d], 0, 0]
                    if len(mine):
                        mine = checked_runs(words, mine, hashes[found.first[d] : found.first[d + 1]], power, least)
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, mine[:, 0] + mine[:, 2], 1)
                        np.add.at(edge, mine[:, 0] + mine[:, 1], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                        out.append(mine)
                    sizes.append(len(mine))
                    collapsed.append(b" ".join(words).decode())
                flat = np.concatenate([np.zeros((0, 3), np.int64), *out])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
                bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(found.counts, pa.int64()), pa.ListArray.from_arrays(bounds, structs), pa.array(collapsed, pa.string())],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(scan, schema).withColumnRenamed("id", key)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the texts of about a tenth of the ids go on periodically from some word on, words joined by one space.

    Place and period follow from the crc32 of the id; null ids, null texts and texts without words stay as they are.
    """

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            for k, (x, h) in enumerate(zip(texts, b.column("h").to_pylist(), strict=True)):
                words = x.encode().split() if x and h is not None and h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    whole = -(-(n - a) // p)
                    texts[k] = b" ".join((words[:a] + words[a : a + p] * whole)[:n]).decode()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    return rows.mapInArrow(plant, f"doc_id {kind}, text string")


def runs_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_runs, the run of the greatest exponent (start, length, period, exponent_milli), checksums of runs and collapsed text."""
    found = periodic_runs(with_planted_repeats(docs))
    none = "cast(null as struct<start:bigint,length:bigint,period:bigint>)"
    # runs come by start, then period: the first of equal exponents stays
    best = f"aggregate(runs, {none}, (b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.selectExpr("doc_id", "runs", f"{best} as best", "collapsed", f"{lines} as run_lines").selectExpr(
        "doc_id", "cast(size(runs) as bigint) as n_runs", "best.start as start", "best.length as length", "best.period as period",
        "best.length * 1000 div best.period as exponent_milli", "sha2(run_lines, 256) as runs_sha256", "sha2(collapsed, 256) as collapsed_sha256",
    )
