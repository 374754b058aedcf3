"""Packing of documents into sequences by lexical retrieval.

Document frequencies and the number of words are counted once over all
documents, in a table of fixed size by hashed term. Documents are sorted by
the few terms that weigh most in them, so that documents of like content lie
together, and the sorted run is cut into shards by size. A shard holds a BM25
inverted index of its documents, with the frequencies of the whole table. The
document that opens a sequence is its seed; the sequence is filled with the
seed's best unused neighbours, the last of which is cut and opens the next
sequence. So every sequence is full but the last of a shard, and that is cut
into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.words import buffers, find_words, look_up, pieces
from dayledger.session import materialize

K1, B = 1.2, 0.75
FIRST_NEIGHBOURS = 32
SLOT_BITS = 20  # the table of document frequencies has 2^SLOT_BITS counts
LEADING = 4  # terms by which documents are sorted
TASK_BYTES = 32_000_000


class ByteTokenizer:
    """Ids of a byte-level BPE tokenizer file. Where the file is of the plain kind, the same merges run in tiktoken, which is
    several times faster; texts that hold one of the file's special tokens, and all texts of other files, go to the tokenizers library.

    A space before a character that is no white space begins a token, and what stands before it is split as at the
    end of a text. So many texts are cut at such spaces, and each distinct stretch of them is encoded once.
    """

    # where no two spaces follow each other, a split that looks ahead is not needed, and a faster engine does the rest
    SINGLE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
    PATTERN = SINGLE.replace(r"|\s+", r"|\s+(?!\S)|\s+")
    SPACES = re.compile(r"\s\s")

    def __init__(self, spec: str):
        self.spec = spec
        self.library = None
        parsed = json.loads(spec)
        self.special = [t["content"] for t in parsed["added_tokens"]]
        self.fast = self.single = None
        if self._plain(parsed):
            self.fast, self.single = self._tiktoken(parsed, self.PATTERN, self.SINGLE)
            vocab = parsed["model"]["vocab"]
            self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
            self.bytes_of[list(vocab.values())] = list(map(len, vocab))

    @staticmethod
    def _plain(parsed: dict) -> bool:
        """No normalizer, the standard byte-level split, and tokens whose ids rise with the rank of their merge."""
        model, split = parsed["model"], parsed["pre_tokenizer"] or {}
        if parsed.get("normalizer") or model["type"] != "BPE" or split.get("type") != "ByteLevel":
            return False
        if split["add_prefix_space"] or not split.get("use_regex", True) or model.get("ignore_merges") or model.get("dropout"):
            return False
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"].get(a + b, -1) for a, b in merges]
        made = {a + b for a, b in merges}
        alone = max((i for t, i in model["vocab"].items() if len(t) == 1), default=-1)
        special = {t["content"] for t in parsed["added_tokens"]}
        whole = all(len(t) == 1 or t in made or t in special for t in model["vocab"])
        return whole and all(a < b for a, b in zip([alone, *ids], ids))

    def _tiktoken(self, parsed: dict, *patterns: str) -> list:
        import tiktoken

        code = self._byte_of_char()
        special = set(self.special)
        ranks = {bytes(code[c] for c in t): i for t, i in parsed["model"]["vocab"].items() if t not in special}
        return [tiktoken.Encoding("byte-bpe", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in patterns]

    @staticmethod
    def _byte_of_char() -> dict[str, int]:
        """Byte-level files write printable bytes as themselves and the others as characters from 256 on."""
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(seen)]
        return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(other)}

    def encode(self, text: str, apart: bool = False) -> np.ndarray:
        """``apart``: no two spaces are known to follow each other."""
        if self.fast is None or any(s in text for s in self.special):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_str(self.spec)
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array((self.single if apart or not self.SPACES.search(text) else self.fast).encode_ordinary(text), np.uint32)

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; a null is empty."""
        if self.fast is None:
            return [self.encode(x.as_py() or "") for x in texts]
        data, offsets = buffers(texts)
        cut = np.append(opens(data), [False, False])[: len(data) + 1]
        cut[offsets[offsets > 0] - 1] = False  # a space at the end of a text stands before nothing
        cut[offsets] = True
        bounds = np.flatnonzero(cut)
        stretches = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        which = stretches.indices.to_numpy()
        ids, first, count = self._distinct(stretches.dictionary)
        size = count[which]
        ends = np.append(0, np.cumsum(size))
        flat = ids[np.repeat(first[which] - ends[:-1], size) + np.arange(ends[-1])]
        of_text = ends[np.searchsorted(bounds, offsets)].tolist()
        out = [flat[i:j] for i, j in zip(of_text[:-1], of_text[1:], strict=True)]
        for s in self.special:
            for k in np.flatnonzero(pc.match_substring(texts, s).fill_null(False).to_numpy(zero_copy_only=False)):
                out[k] = self.encode(texts[k].as_py())
        return out

    def _distinct(self, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct stretches, the place of each one's first id, and their number. Stretches that open with a cut are encoded as one text."""
        data, offsets = buffers(stretches)
        joins = np.append(opens(data), False)[offsets[:-1]] & (np.diff(offsets) > 1)
        apart = spaces_apart(stretches) & ~_SPACE[data[offsets[1:] - 1]]
        heads = np.flatnonzero(~joins)  # beginnings of texts
        order = [np.flatnonzero(joins & apart), np.flatnonzero(joins & ~apart), heads]
        found, count = [], []
        for use, engine in zip(order[:2], (self.single, self.fast), strict=True):
            some, to = buffers(stretches.take(pa.array(use)))
            found.append(np.array(engine.encode_ordinary(some.tobytes().decode()), np.uint32))
            count.append(np.diff(np.searchsorted(np.cumsum(self.bytes_of[found[-1]]), to, "right")))
        found.extend(np.array(self.fast.encode_ordinary(x.as_py()), np.uint32) for x in stretches.take(pa.array(heads)))
        count = np.concatenate([*count, np.array([len(x) for x in found[2:]], np.int64)])
        back = np.argsort(np.concatenate(order))
        return np.concatenate(found), (np.cumsum(count) - count)[back], count[back]


# white space of ASCII, and bytes that other white space begins with
_SPACE, _OTHER = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = _OTHER[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WHITE = _SPACE | _OTHER


def opens(data: np.ndarray) -> np.ndarray:
    """Of each byte but the last: it is a space, and the next one surely begins no white space."""
    return (data[:-1] == 32) & ~look_up(data[1:], _WHITE)


def spaces_apart(texts: pa.Array) -> np.ndarray:
    """Texts that surely hold no two white-space characters in a row; the others must be searched for them."""
    data, offsets = buffers(texts)
    space = look_up(data, _SPACE)
    two = space[1:] & space[:-1]
    two[offsets[(offsets > 0) & (offsets < len(data))] - 1] = False  # of two texts
    at = np.append(np.flatnonzero(two), np.flatnonzero(look_up(data, _OTHER)))
    out = np.ones(len(texts), bool)
    out[np.searchsorted(offsets, at, "right") - 1] = False
    return out


@dataclass
class Frequencies:
    """Documents by hashed term (an upper bound for terms that share a slot), documents and words of the whole table."""

    slots: np.ndarray
    docs: int
    words: int

    def of(self, terms: np.ndarray) -> np.ndarray:
        return self.slots[terms >> np.uint64(32 - SLOT_BITS)]


@dataclass
class Terms:
    """(document, term) pairs in order with their counts; a term is 32 bits of its hash."""

    counts: np.ndarray  # words of each document
    doc: np.ndarray
    term: np.ndarray
    tf: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Terms:
        words = find_words(*buffers(texts), lower=True)
        both = np.sort((words.document().astype(np.uint64) << np.uint64(32)) | (words.hashes() >> np.uint64(32)))
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, np.int64)
        tf = np.diff(np.append(first, len(both)))
        both = both[first]
        return cls(words.counts, (both >> np.uint64(32)).astype(np.int64), both & np.uint64(0xFFFFFFFF), tf)

    def frequencies(self) -> Frequencies:
        slots = np.bincount((self.term >> np.uint64(32 - SLOT_BITS)).astype(np.int64), minlength=1 << SLOT_BITS)
        return Frequencies(slots, len(self.counts), int(self.counts.sum()))

    def weights(self, all_docs: Frequencies, df: np.ndarray) -> np.ndarray:
        """BM25 weight of each pair of frequency ``df``."""
        # terms of more than half of the documents weigh nothing
        idf = np.maximum(np.log((np.maximum(all_docs.docs - df, 0) + 0.5) / (df + 0.5)), 0)
        length = self.counts / max(all_docs.words / max(all_docs.docs, 1), 1e-9)
        return idf * self.tf * (K1 + 1) / (self.tf + K1 * (1 - B + B * length[self.doc]))


class Index:
    """BM25 over the documents of a shard: postings by term, with weights worked out once from the frequencies of the whole table."""

    def __init__(self, texts: pa.Array, all_docs: Frequencies | None = None):
        found = Terms.of(texts)
        self.n = len(found.counts)
        all_docs = all_docs or found.frequencies()
        weight = found.weights(all_docs, all_docs.of(found.term))
        by_term = np.sort((found.term << np.uint64(32)) | np.arange(len(found.term), dtype=np.uint64))
        pair = (by_term & np.uint64(0xFFFFFFFF)).astype(np.int64)
        term = by_term >> np.uint64(32)
        fresh = np.append(True, term[1:] != term[:-1]) if len(term) else np.zeros(0, bool)
        size = np.diff(np.append(np.flatnonzero(fresh), len(term)))
        group = np.cumsum(fresh) - 1
        # a term of one document leads to no neighbour, one without weight to none that counts
        use = (weight[pair] > 0) & (size[group] > 1)
        self.post_doc, self.post_weight = found.doc[pair[use]], weight[pair[use]]
        first = np.append(0, np.cumsum(np.bincount(group[use], minlength=len(size))))
        # of each used pair, by document: bounds of its term's postings
        back = np.sort((pair[use] << 32) | group[use])
        group = back & 0xFFFFFFFF
        self.begin, self.length = first[group], first[group + 1] - first[group]
        self.doc_first = np.searchsorted(found.doc[back >> 32], np.arange(self.n + 1))

    def neighbours(self, seed: int, used: np.ndarray | None = None) -> Iterator[int]:
        """Documents not ``used`` that share a term with the seed, best first; ties by place. Few are asked for, so few are sorted at first."""
        mine = slice(self.doc_first[seed], self.doc_first[seed + 1])
        a, n = self.begin[mine], self.length[mine]
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        scores = np.bincount(self.post_doc[at], weights=self.post_weight[at], minlength=self.n)
        scores[seed] = 0
        if used is not None:
            scores[used] = 0
        found = np.flatnonzero(scores)
        least = np.partition(scores[found], -FIRST_NEIGHBOURS)[-FIRST_NEIGHBOURS] if len(found) > FIRST_NEIGHBOURS else 0
        for some in (found[scores[found] >= least], found[scores[found] < least]):
            yield from some[np.argsort(-scores[some], kind="stable")].tolist()


def fill(lengths: list[int], index: Index, size: int, content: list) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset); documents in the given order open sequences.

    A neighbour whose ``content`` is in the sequence already is passed over
    there: copies do not fill one window. Equal contents are equal texts, by hash.
    """
    used = np.zeros(len(lengths), bool)
    out: list[tuple[int, int, int, int, int]] = []
    sequence, offset, seed, near, following, here = 0, 0, 0, iter(()), 0, set()
    for _ in range(len(lengths)):
        doc = -1
        if offset:
            if near is None:
                near = index.neighbours(seed, used)
            doc = next((d for d in near if not used[d] and content[d] not in here), -1)
        if doc < 0:
            while used[following]:
                following += 1
            doc = following
        used[doc] = True
        start = 0
        while start < lengths[doc]:
            if offset == 0:
                seed, near, here = doc, None, set()
            here.add(content[doc])
            n = min(size - offset, lengths[doc] - start)
            out.append((doc, start, n, sequence, offset))
            start, offset = start + n, offset + n
            if offset == size:
                sequence, offset = sequence + 1, 0
    # the last sequence, if not full, in sequences of powers of two
    tail = [p for p in out if offset and p[3] == sequence]
    out = out[: len(out) - len(tail)]
    room = at = 1 << (offset.bit_length() - 1) if offset else 0
    for doc, start, n, _, _ in tail:
        while n:
            k = min(n, at)
            out.append((doc, start, k, sequence, room - at))
            start, n, at, offset = start + k, n - k, at - k, offset - k
            if at == 0 and offset:
                sequence += 1
                room = at = 1 << (offset.bit_length() - 1)
    return out


def table_frequencies(docs: DataFrame, text: str) -> Frequencies:
    """Counts over all documents: each task counts its own, sums are made by slot. The table has a fixed size, whatever the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, n, words = np.zeros(1 << SLOT_BITS, np.int64), 0, 0
        for whole in batches:
            for b in pieces(whole, "text"):
                one = Terms.of(b.column("text")).frequencies()
                slots, n, words = slots + one.slots, n + one.docs, words + one.words
        used = np.flatnonzero(slots)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, [-1, -2]).astype(np.int32)), pa.array(np.append(slots[used], [n, words]))], names=["slot", "n"]
        )

    sums = docs.select(F.col(text).alias("text")).mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = sums["slot"].to_numpy(), sums["n"].to_numpy()
    slots = np.zeros(1 << SLOT_BITS, np.int64)
    slots[slot[slot >= 0]] = n[slot >= 0]
    return Frequencies(slots, int(n[slot == -1].sum()), int(n[slot == -2].sum()))


def leading(found: Terms, all_docs: Frequencies) -> np.ndarray:
    """The terms of highest BM25 weight times root of their frequency, LEADING for each document, 0 where there are fewer; ties by hash."""
    df = all_docs.of(found.term)
    score = (found.weights(all_docs, df) * np.sqrt(df)).astype(np.float32)
    at = np.flatnonzero((df > 1) & (score > 0))
    # positive floats order as their bits do
    falling = np.uint64(0xFFFFFFFF) - score[at].view(np.uint32)
    at = at[np.argsort((found.doc[at].astype(np.uint64) << np.uint64(32)) | falling, kind="stable")]
    place = np.arange(len(at)) - np.searchsorted(found.doc[at], found.doc[at])
    out = np.zeros((LEADING, len(found.counts)), np.int64)
    out[place[place < LEADING], found.doc[at[place < LEADING]]] = found.term[at[place < LEADING]]
    return out


def by_content(docs: DataFrame, key: str, text: str, all_docs) -> DataFrame:
    """(id, text, no, t0, t1, ...): each row with its leading terms and a number of its own; ``all_docs`` is a broadcast of the fields of the frequencies. Written, so that both stay."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "text"):
                terms = leading(Terms.of(b.column("text")), Frequencies(*all_docs.value))
                yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(t) for t in terms]], names=[*b.schema.names, *[f"t{k}" for k in range(LEADING)]])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("no"))
    return materialize(rows.mapInArrow(lead, f"id {kind}, text string, no long, " + ", ".join(f"t{k} long" for k in range(LEADING))), "packing-rows")


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows in order, cut where a shard has ``size`` bytes of text; a longer text is one row of one shard."""
    held, have = [], 0
    for whole in batches:
        for b in pieces(whole, "text", size // 8):
            held.append(b)
            have += buffers(b.column("text"))[1][-1]
            if have >= size:
                yield pa.Table.from_batches(held)
                held, have = [], 0
    if held:
        yield pa.Table.from_batches(held)


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text",
         shard_bytes: int = 4_000_000, with_ids: bool = True) -> DataFrame:
    """Per piece: key, start, length, ids (little-endian unsigned 32-bit), ids_crc32, doc_tokens, sequence_id, offset.

    Without ``with_ids`` the ids stay behind and their checksum stands for them.

    A document is its ids and ``end_id``; a null text is empty, so one id.
    Each row of the input is packed, equal rows too, each id once. Columns
    other than key and text do not take part. About ``shard_bytes`` of text share
    an index; a longer text is still one document of one shard. Equal rows have
    numbers of their own, so they spread over shards as other rows do.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    context = docs.sparkSession.sparkContext
    docs = docs.select(key, text)
    stored = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    counted = table_frequencies(docs, text)
    # plain values: executors need no copy of this package to read them
    all_docs = context.broadcast((counted.slots, counted.docs, counted.words))
    rows = by_content(docs, key, text, all_docs)
    kind = docs.schema[key].dataType.simpleString()
    parts = max(context.defaultParallelism, -(-stored // TASK_BYTES))
    order = [*[f"t{k}" for k in range(LEADING)], "id", "no"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end, last = ByteTokenizer(spec), np.array([end_id], np.uint32), -1
        for t in shards(batches, shard_bytes):
            content = t["text"].combine_chunks()
            ids = [np.concatenate([x, end]) for x in tokens.encode_all(content)]
            same = [hash(x.as_py() or "") for x in content]
            placed = fill([len(x) for x in ids], Index(content, Frequencies(*all_docs.value)), size, same)
            doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*placed, strict=True))
            sequence += last + 1
            last = int(sequence[-1])
            raw = [ids[d][s : s + n].astype("<u4", copy=False).tobytes() for d, s, n, _, _ in placed]
            first = int(t["part"][0].as_py()) << 40
            yield from pa.table({
                "id": t["id"].combine_chunks().take(pa.array(doc)), "start": start, "length": length,
                **({"ids": pa.array(raw, pa.binary())} if with_ids else {}), "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                "doc_tokens": np.array([len(x) for x in ids], np.int64)[doc], "sequence_id": sequence + first, "offset": offset,
            }).to_batches()

    schema = f"id {kind}, start long, length long, {'ids binary, ' * with_ids}ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", key)


def packing_report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(docs, tokenizer_path, with_ids=False)
