"""Each operator on nulls, empty and long texts, ties, equal rows, empty tables and clashing columns, against plain Python."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from samples import CLASH, LOWER, SCHEMA, WORD, corpus, prose, with_clashes

from dayledger.llm import jaccard, language, lines, mixing, packing, quality, substrings, tokens, toxicity, vectors
from dayledger.llm.queries import tokenizer


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(3))


@pytest.fixture(scope="module")
def empty(spark):
    return with_clashes(spark.createDataFrame([], SCHEMA))


def words(text):
    return WORD.findall(text or "")


def kept_columns(df, docs):
    assert set(docs.columns) <= set(df.columns) and len(set(df.columns)) == len(df.columns)
    first = df.first()
    assert all(first[c] == k for k, c in enumerate(CLASH))


def test_substrings(docs, empty, rows):
    seen = Counter(tuple(w[i : i + 35]) for r in rows for w in [words(r[1])] for i in range(len(w) - 34))
    want = Counter()
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert Counter(map(tuple, substrings.substring_report(docs).collect())) == want
    for r in substrings.dedup_substrings(docs).collect():
        assert sum(s.end - s.begin for s in r.removed) == r.n_removed
        assert len(words(r.kept)) == r.n_words - r.n_removed
    assert substrings.substring_report(empty).count() == 0


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard(docs, empty, rows, width, percent):
    sets = []
    for r in rows:
        w = words((r[1] or "").translate(LOWER))
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            x, y = rows[i][0], rows[j][0]
            if n and x is not None and y is not None and 100 * n >= percent * len(a | sets[j]):
                p, q = root(x), root(y)
                parent[max(p, q)] = min(p, q)
    want = Counter((r[0], len(s), None if r[0] is None else root(r[0])) for r, s in zip(rows, sets, strict=True))
    assert Counter(map(tuple, jaccard.jaccard_components(docs, width, percent).collect())) == want
    if percent == 80:
        kept = jaccard.keep_one(docs)
        kept_columns(kept, docs)
        # texts are the vertices here: of two texts of one id that are not alike both stay
        texts = sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=repr)
        of_text = {(r[0], r[1]): sets[k] for k, r in enumerate(rows)}
        group = list(range(len(texts)))
        for i, a in enumerate(texts):
            for j in range(i):
                x, y = of_text[a], of_text[texts[j]]
                if x & y and 100 * len(x & y) >= percent * len(x | y):
                    group = [group[j] if g == group[i] else g for g in group]
        heads = [(r.doc_id, r.text) for r in kept.collect()]
        assert Counter(group[texts.index(h)] for h in heads if h[0] is not None) == Counter(set(group))
        assert sorted(h[1] or "" for h in heads if h[0] is None) == sorted(r[1] or "" for r in rows if r[0] is None)
        one_text = [i for i, n in Counter(i for i, _ in texts).items() if n == 1]
        for i, t in heads:
            if i is not None:
                mine = [x for x, g in zip(texts, group, strict=True) if g == group[texts.index((i, t))]]
                assert any(x not in one_text for x, _ in mine) or i == min(x for x, _ in mine)
    assert jaccard.jaccard_components(empty, width, percent).count() == 0


def test_jaccard_of_many_near_copies(spark, monkeypatch):
    """Blocks smaller than the group, and members that reach the group only over members of other blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 4)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(40):
        w = list(base)
        for j in range(k % 5):
            w[(7 * k + 31 * j) % 120] = f"x{k}.{j}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string")
    sets = [{tuple(w[i : i + 3]) for i in range(118)} for w in map(str.split, texts)]
    comp = list(range(40))
    for _ in range(40):
        for i in range(40):
            for j in range(40):
                if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                    comp[i] = min(comp[i], comp[j])
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, 3, 90).collect()} == dict(enumerate(comp))


def test_quality(docs, empty, rows):
    got = quality.judge(docs)
    kept_columns(got, docs)
    want = Counter()
    for r in rows:
        w = words(r[1])
        full = [x for x in (r[1] or "").split("\n") if words(x)]
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        signs = sum(c in "#*$%&|<>" for c in r[1] or "")
        want[r[0], len(w), sum(map(len, w)), signs, len(full) - len(set(full)), len(covered), failed] += 1
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == want
    assert not [r for r in got.collect() if r.kept and r.base_failed]
    assert quality.judge(empty).count() == 0


def test_quality_order_does_not_change_the_verdict(docs):
    rules = quality.default_rules()
    base = quality.base_columns(docs)
    there = base.select(quality.cascade(rules, list(rules)).isNull().alias("k"), "doc_id").collect()
    back = base.select(quality.cascade(rules, list(rules)[::-1]).isNull().alias("k"), "doc_id").collect()
    assert Counter(map(tuple, there)) == Counter(map(tuple, back))


def test_mixing(docs, empty, rows):
    weights = {"a": 3.0, "b": 1.0}
    got = mixing.mix(docs, weights=weights, target=300)
    kept_columns(got, docs)
    n = Counter(r[3] for r in rows)
    want = Counter()
    for r in rows:
        rate = 300 * weights.get(r[3], 0.0) / 4 / n[r[3]]
        key = "" if r[0] is None else str(r[0])
        u = int(hashlib.md5(f"17:{key}".encode()).hexdigest()[:13], 16) / 2**52
        k, below, term = 0, 0.0, math.exp(-rate)
        while (below := below + term) <= u:
            k += 1
            term *= rate / k
        want.update((r[0], r[1], c, k) for c in range(k))
    assert Counter((r.doc_id, r.text, r.copy, r.n_copies) for r in got.collect()) == want
    assert mixing.mix(empty).count() == 0


def test_mixing_means_follow_the_rates(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id < 3600, 'big', 'small') AS source")
    n = Counter(r.source for r in mixing.mix(docs, weights={"big": 1, "small": 1}).collect())
    assert abs(n["big"] - 2000) < 200 and abs(n["small"] - 2000) < 250
    # far above where exp(-rate) is zero
    one = spark.createDataFrame([(1, "s")], "doc_id long, source string")
    assert abs(mixing.mix(one, target=5000).count() - 5000) < 400


def test_tokens(docs, empty, rows):
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = tokens.token_counts(docs, path, budgets=(7,))
    kept_columns(got, docs)
    want = Counter()
    for r in rows:
        t = r[1] or ""
        fits = next(k for k in range(min(len(t), 60), -1, -1) if len(sp.encode(t[:k])) <= 7)
        want[r[0], len(t.encode()), len(sp.encode(t)), fits] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.fits_7) for r in got.collect()) == want
    assert tokens.token_counts(empty, path).count() == 0


def test_prefix_tables():
    import random

    import sentencepiece

    with open(tokenizer("piece_bpe_32k.model"), "rb") as f:
        table = tokens.PrefixTable(f.read())
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    rnd = random.Random(5)
    for _ in range(300):
        t = "".join(rnd.choice("aábcthe \n\t①中X▁<s>") for _ in range(rnd.randint(0, 30)))
        assert table.prefix_counts(t) == [len(sp.encode(t[:k])) for k in range(len(t) + 1)]


def test_lines(docs, empty, rows):
    got = lines.dedup_lines(docs)
    kept_columns(got, docs)
    # in order of id (nulls first) and place; equal rows stand together
    distinct = sorted({r[:2] for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    for i, t in distinct:
        ls = t.split("\n")
        for p in range(len(ls) - 2):
            first.setdefault(tuple(ls[p : p + 3]), (i, p))
    want = Counter()
    for r in rows:
        ls = [] if r[1] is None else r[1].split("\n")
        gone = {p + k for p in range(len(ls) - 2) if words("".join(ls[p : p + 3])) and first[tuple(ls[p : p + 3])] != (r[0], p) for k in range(3)}
        want[r[0], None if r[1] is None else "\n".join(x for k, x in enumerate(ls) if k not in gone), len(ls), len(gone)] += 1
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == want
    assert lines.dedup_lines(empty).count() == 0


def test_packing(docs, empty, rows):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = Counter()
    for r in rows:
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want[r[0]] += len(ids)
    got = packing.pack(docs.withColumn("length", docs.n_chars), path, size=64).collect()
    have, at = Counter(), Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id] and len(r.ids) == 4 * r.length
        at[r.sequence_id] += r.length
        have[r.doc_id] += r.length
    assert have == want
    assert all(n == 64 or n < 64 and n & (n - 1) == 0 for n in at.values())
    assert packing.pack(empty, path).count() == 0


def test_packed_pieces_are_the_document(spark):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "it's  1½ \x1c\x85\xa0 x\n\n y", "word " * 700, "", "é中 !?"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.packing_report(docs, path).collect()
    for k, t in enumerate(texts):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r for r in got if r.doc_id == k), key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces]])[:-1])
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids) for r in pieces)


def test_packing_takes_lexical_neighbours():
    import pyarrow as pa

    texts = ["red apple pie", "steel bridge bolts", "apple pie recipe", "bridge of steel", "wool", "tin", "oak", "fog"]
    index = packing.Index(pa.array(texts))
    assert next(index.neighbours(0)) == 2 and next(index.neighbours(1)) == 3
    pieces = packing.fill([3] * 8, index, 6, texts)
    assert [{p[0] for p in pieces if p[3] == s} for s in range(2)] == [{0, 2}, {1, 3}]


def test_packing_deals_like_documents_together(spark):
    """Weights are those of the whole table, and documents of one topic share shards at every size."""
    rows = [(k, f"topic{k % 20} about{k % 20} common{k % 3} " + prose(1000 + k, 12)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    size = sum(len(t) for _, t in rows)
    found = packing.table_frequencies(docs, "text")
    assert (found.docs, found.words) == (len(rows), len(rows) * 15)
    df = Counter(w for _, t in rows for w in set(t.split()))
    terms = packing.Terms.of(pa.array(list(df)))
    assert len(terms.term) == len(df) and all(found.of(terms.term) >= [df[w] for w in df])
    assert sum(found.of(terms.term)) < 1.01 * sum(df.values())  # few terms share a slot
    order = ["t0", "t1", "t2", "t3", "id", "no"]
    by_content = lambda d, f: packing.by_content(d, "doc_id", "text", spark.sparkContext.broadcast((f.slots, f.docs, f.words))).orderBy(*order).collect()
    got = by_content(docs, found)
    assert sorted((r.id, r.text) for r in got) == rows

    def shard_of(rows):
        table = pa.table({"id": [r.id for r in rows], "text": [r.text for r in rows]})
        return [t["id"].to_pylist() for t in packing.shards(table.to_batches(), size // 20)]

    shard = {i: k for k, ids in enumerate(shard_of(got)) for i in ids}
    together = [shard[i] == shard[j] for i in range(400) for j in range(i + 20, 400, 20)]
    assert sum(together) / len(together) > 0.25  # one in 20 by chance
    # equal rows are no unit of their own: shards are cut by size alone
    hot = spark.createDataFrame([(1000, "same words in all of these")] * 3000 + rows, "doc_id long, text string")
    parts = shard_of(by_content(hot, packing.table_frequencies(hot, "text")))
    assert sum(map(len, parts)) == 3400 and max(map(len, parts)) < 150


def test_packing_spreads_equal_rows_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_BYTES", 5000)
    text = prose(77, 20)
    docs = spark.createDataFrame([(1, text)] * 600 + [(k, prose(k, 20)) for k in range(2, 300)], "doc_id long, text string")
    got = packing.pack(docs, tokenizer("byte_bpe_50k.json"), size=256, shard_bytes=4000).toPandas()
    assert (got[got.start == 0].groupby("doc_id").size().loc[1]) == 600
    tasks = (got[got.doc_id == 1].sequence_id // (1 << 40)).value_counts()
    assert len(tasks) > 5 and tasks.max() < 300


def test_spaces_are_known_to_lie_apart():
    texts = ["a b\nc", "a  b", "a \nb", "", None, "a ", " b", "a \u00a0b", "a\u2003\u2003b", "\u3000 x", "\u1680\tx", "a\x1f b", "é à ü", "a\x85\x85b"]
    odd = [bool(packing.ByteTokenizer.SPACES.search(x or "")) for x in texts]
    apart = packing.spaces_apart(pa.array(texts)).tolist()
    assert not any(a and o for a, o in zip(apart, odd, strict=True)) and apart[:7] == [True, False, False, True, True, True, True] and apart[12]
    # the end of one text and the start of the next are no run, also in a slice
    assert packing.spaces_apart(pa.array(["  ", "a ", " b", "x  y"]).slice(1)).tolist() == [True, True, False]
    with open(tokenizer("byte_bpe_50k.json"), encoding="utf-8") as f:
        tok = packing.ByteTokenizer(f.read())
    assert all(tok.encode(x or "", a).tolist() == tok.encode(x or "").tolist() for x, a in zip(texts, apart, strict=True))


def test_each_distinct_stretch_is_encoded_once():
    import random

    from tokenizers import Tokenizer

    path, rng = tokenizer("byte_bpe_50k.json"), random.Random(5)
    with open(path, encoding="utf-8") as f:
        tok = packing.ByteTokenizer(f.read())
    bits = [" ", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u1680", "a", "It", "'s", "'", "é", "中", "’", "12", "½", "!?", "<|endoftext|>", "\0"]
    texts = ["", None, " ", "  ", "a ", " a", "a  ", " \n", "\u2003", *["".join(rng.choices(bits, k=rng.randrange(1, 30))) for _ in range(3000)]]
    library = Tokenizer.from_file(path)
    want = [library.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert [x.tolist() for x in tok.encode_all(pa.array(texts))] == want
    assert [x.tolist() for x in tok.encode_all(pa.array(texts).slice(7, 900))] == want[7:907]
    assert [x.tolist() for x in tok.encode_all(pa.array(texts[9:10]))] == want[9:10] and tok.encode_all(pa.array([], pa.string())) == []

    class Counted:
        def __init__(self, engine):
            self.engine, self.chars = engine, 0

        def encode_ordinary(self, text):
            self.chars += len(text)
            return self.engine.encode_ordinary(text)

    tok.fast, tok.single = Counted(tok.fast), Counted(tok.single)
    texts = [" ".join(rng.choices(["some", "words,", "come", "again\nand", "again."], k=400)) for _ in range(50)]
    got = tok.encode_all(pa.array(texts))
    assert [x.tolist() for x in got] == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert tok.fast.chars + tok.single.chars < 1000


def test_words_are_the_runs_between_separators():
    import re

    from dayledger.llm import words

    texts = [None, "", "a", "b c", " ", "d ", " e", "f", "", "g\x0bH\n\ni", "é\xa0中", None]
    for some in (texts, texts[:1], texts[1:4], []):
        for lower in (False, True):
            w = words.find_words(*words.buffers(pa.array(some, pa.string())), lower=lower)
            got = [[bytes(w.data[w.starts[k] : w.ends[k]]).decode() for k in range(i, j)] for i, j in zip(w.first[:-1], w.first[1:])]
            want = [re.findall(r"[^\x20\x09-\x0D]+", x or "") for x in some]
            assert got == [[x.lower() if lower else x for x in ws] for ws in want]


def test_used_documents_are_no_neighbours():
    index = packing.Index(pa.array([f"{prose(k, 9)} {prose(k % 5, 9)}" for k in range(80)]))
    used = np.arange(80) % 3 == 0
    for seed in range(0, 80, 7):
        assert list(index.neighbours(seed, used)) == [d for d in index.neighbours(seed) if not used[d]]


def test_hashes_do_not_depend_on_the_block(monkeypatch):
    from dayledger.llm import words

    found = words.find_words(*words.buffers(pa.array([prose(k, 50) for k in range(20)] + ["x" * 5000])))
    whole = found.hashes()
    assert words.HASH_BYTES <= 1 << 17
    monkeypatch.setattr(words, "HASH_BYTES", 100)
    assert (found.hashes() == whole).all()


def test_ids_of_another_kind_of_file_come_from_the_library():
    import json

    from tokenizers import Tokenizer

    with open(tokenizer("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    plain, other = packing.ByteTokenizer(spec), json.loads(spec)
    assert plain.fast is not None
    merges = other["model"]["merges"]
    merges[0], merges[1] = merges[1], merges[0]  # ids no longer rise with the merges
    changed = packing.ByteTokenizer(json.dumps(other))
    assert changed.fast is None
    for text in ("Some words, 12 of them's  \n x", "", prose(5, 40)):
        assert plain.encode(text).tolist() == Tokenizer.from_str(spec).encode(text, add_special_tokens=False).ids
        assert changed.encode(text).tolist() == Tokenizer.from_str(json.dumps(other)).encode(text, add_special_tokens=False).ids


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    rows = [(k, base[k].tolist(), k % 2) for k in range(60)]
    rows += [(100 + k, (base[k % 9] + 0.04 * rng.normal(size=16)).tolist(), k % 9 % 2) for k in range(80)]
    rows += [(300, base[0].tolist(), 0), (301, (2 * base[0]).tolist(), 0), (302, base[0].tolist(), 1), (303, base[0].tolist(), None),
             (304, None, 0), (305, [], 0), (306, [0.0] * 16, 0), (307, [float("nan")] + [1.0] * 15, 0), (308, [float("inf")] * 16, 0),
             (309, [None] + [1.0] * 15, 0), (None, base[0].tolist(), 0), (0, base[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    good = [(i, np.array(v, np.float32).astype(float), y) for i, v, y in rows if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, parent = Counter(), {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    got = vectors.near_vectors(df).collect()
    per_row = []
    for a, (i, x, y) in enumerate(good):
        n = 0
        for b, (j, z, w) in enumerate(good):
            if a != b and y == w and x @ z / np.sqrt(x @ x) / np.sqrt(z @ z) >= 0.98:
                n += 1
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
        per_row.append((i, n))
    want = Counter((i, n, root(i), root(i) == i) for i, n in per_row)
    bad = [r for r in rows if not any(r[0] == g[0] for g in good)]
    want += Counter((r[0], 0, r[0], True) for r in bad)
    assert Counter(map(tuple, got)) == want
    assert vectors.near_vectors(df.limit(0)).count() == 0
    assert vectors.near_vectors(df.filter("vec_id > 302 AND vec_id < 310")).count() == 7


def test_vectors_of_several_widths(spark):
    """Each width links among itself; tiny and huge vectors are as good as others; names of the caller do not clash."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(9)
    rows, want, at = [], Counter(), 0
    for width, n in ((16, 5), (8, 4), (9, 3), (1, 2), (4, 2)):
        v = rng.normal(size=width)
        for k in range(n):
            scale = (1e-200, 1.0, 1e200)[k % 3] if width != 4 else (1e-200, 2e-200)[k]
            rows.append((at + k, [float(x) for x in (v + 0.001 * k) * scale], 1))
            want[at + k, n - 1, at, k == 0] += 1
        at += n
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(1) for c in CLASH})
    assert Counter(map(tuple, vectors.near_vectors(df).collect())) == want


def test_training_texts_are_bounded_by_labels(spark):
    """Many rows of one labelled id bring one text to the driver."""
    docs = spark.range(3000).selectExpr("0L AS doc_id", "concat('text ', id) AS text")
    labels = spark.createDataFrame([(0, 1)], "doc_id long, toxic int")
    seen = []
    old = toxicity.fit
    try:
        toxicity.fit = lambda texts, y: seen.append((texts, list(y)))
        toxicity.train(docs, labels)
    finally:
        toxicity.fit = old
    assert seen == [(["text 0"], [1])]


def test_two_texts_of_one_id_both_stay(spark):
    texts = [prose(900 + k, 60) for k in range(3)]
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[1] + " more"), (1, texts[0])], "doc_id long, text string")
    kept = jaccard.keep_one(docs).collect()
    assert sorted(r.text.replace(" more", "") for r in kept) == sorted(texts)


def test_language(docs, empty, rows):
    model = language.fit(["aaa bbb aab " * 30, "xyz zzy yxx " * 30] * 6, ["l1", "l2"] * 6)
    got = language.identify(docs, model)
    kept_columns(got, docs)
    assert got.count() == len(rows)
    for r in got.collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert r.lang_pred == "und" and r.score == 0
        else:
            assert r.lang_pred in ("l1", "l2") and 0 <= r.score <= 1
    assert language.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.language_report(empty).count() == 0


def test_toxicity(spark, docs, empty, rows):
    clean = "good words here " * 20
    model = toxicity.fit([clean, clean + "vilething " + clean] * 300, np.array([0, 1] * 300))
    got = toxicity.score(docs, model)
    kept_columns(got, docs)
    assert got.count() == len(rows) and all(0 <= r.score <= 1 for r in got.collect())
    assert {r.score for r in got.filter("text IS NULL OR text = ''").collect()} == {0.0}
    # one word anywhere in a long text is found
    far = spark.createDataFrame([(1, clean * 200), (2, clean * 150 + "VILETHING### " + clean * 50)], "doc_id long, text string")
    assert [r.score > 0.7 for r in toxicity.score(far, model).orderBy("doc_id").collect()] == [False, True]
    labels = spark.createDataFrame([(None, None, None), (1, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_report(docs, labels).filter("score = 0").count() == len(rows)
    assert toxicity.toxicity_report(empty, labels.limit(0)).count() == 0


def test_toxicity_learns_its_character_tables():
    """Gradients reach the grams and beginnings: in the slots that occur, and in every coordinate."""
    texts, labels = ["good words here " * 8, "good vilething here " * 8] * 40, np.array([0, 1] * 40)
    start, model = toxicity.fit(texts, labels, rounds=1), toxicity.fit(texts, labels, rounds=4)
    tok = toxicity.tokenize(*toxicity.buffers(pa.array(texts, pa.large_string())))
    for key, slots in (("grams", tok.gram), ("heads", tok.head)):
        moved = model.params[key] != start.params[key]
        assert moved[:, np.unique(slots)].mean() > 0.9
        assert not np.delete(moved, slots, axis=1).any()
