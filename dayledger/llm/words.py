"""Words of Arrow text columns as byte spans with 64-bit hashes, in numpy on whole buffers.

A word is a run of bytes outside space and \\x09-\\x0D. Those separators are
ASCII, so a scan of UTF-8 bytes cuts texts at the same places as the pattern
``[^\\x20\\x09-\\x0D]+`` does on code points. No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000
HASH_BYTES = 64_000  # the numbers of so many bytes stay in a core's cache
_B = np.uint64(0x9E3779B97F4A7C15)
_C = np.uint64(0xD1342543DE82EF95)


def _inverse(odd: np.uint64) -> np.uint64:
    """Inverse modulo 2^64."""
    return np.uint64(pow(int(odd), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 to base^(n-1); the longest run asked for so far is kept."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[:1] = 1
        with np.errstate(over="ignore"):
            have = _POWERS[int(base)] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def byte_table(salt: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(salt))


@dataclass
class Words:
    """Words of a run of documents. ``first[d]`` to ``first[d+1]`` are the words of document d."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # byte bounds of the documents
    starts: np.ndarray  # byte bounds of the words
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """Index of the document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, salt: int = 0) -> np.ndarray:
        """A 64-bit hash of the bytes of each word, equal in every batch and process.

        Worked out for words of about HASH_BYTES at a time: a very long text needs no 64-bit number for each byte.
        """
        out = np.zeros(len(self.starts), np.uint64)
        values, at = byte_table(salt), 0
        while at < len(out):
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + HASH_BYTES, "right")))
            data, start, end = self.data[low : self.ends[to - 1]], self.starts[at:to] - low, self.ends[at:to] - low
            with np.errstate(over="ignore"):
                sums = np.zeros(len(data) + 1, np.uint64)
                np.cumsum(values[data] * powers(_B, len(data)), out=sums[1:])
                back = powers(_inverse(_B), len(data) + 1)
                out[at:to] = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
            at = to
        return out


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` hashes; the runs may cross documents."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(_C, n), out=sums[1:])
        return mix((sums[width:] - sums[:-width]) * powers(_inverse(_C), n - width + 1))


_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
# letters a-z, digits and everything outside ASCII
ALNUM = np.arange(256) > 127
ALNUM[48:58] = ALNUM[97:123] = True


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls become empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1] if off else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def look_up(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values[data]`` for 256 values of one byte, without a 64-bit index for each byte."""
    return np.frombuffer(data.tobytes().translate(values.tobytes()), values.dtype)


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, letters: np.ndarray = _WORD) -> Words:
    """Runs of the bytes marked in ``letters``; bytes of ASCII signs must be marked one by one. ``lower``: A-Z become a-z first."""
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = look_up(data, table)
    inside = look_up(data, letters)
    edge = np.empty(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[[0, -1]] = inside[[0, -1]] if len(data) else False
    at = np.flatnonzero(edge)
    # a document ends its last word
    heads = offsets[:-1][np.diff(offsets) > 0][1:]
    heads = heads[inside[heads - 1] & inside[heads]]
    starts, ends = (np.insert(x, np.searchsorted(x, heads), heads) for x in (at[::2], at[1::2]))
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text: bounds memory, cuts no row."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
