"""The registered queries on the smallest tables against SQL or plain Python, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from samples import LOWER, WORD

import __spark_entry__ as entry
import corpus_pipeline
from dayledger.llm.queries import ORACLES, QUERIES, tokenizer

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{k}" for k in range(1, 14)), "pipeline"])
    assert set(QUERIES) < set(names) and set(ORACLES) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard", "mixing", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    res = con.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    df = QUERIES[name](spark, SMALL)
    assert sorted(cols) == sorted(df.columns)
    assert Counter(tuple(r) for r in df.select(cols).collect()) == Counter(map(tuple, res.fetchall()))


def test_substring_dedup(spark, documents):
    words = {i: WORD.findall(t) for i, t in zip(documents.doc_id, documents.text, strict=True)}
    seen = Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    got = {r.doc_id: tuple(r) for r in QUERIES["op1_substring_dedup"](spark, SMALL).collect()}
    assert len(got) == len(words)
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert got[i] == (i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_token_counts(spark, documents):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    got = {r.doc_id: tuple(r) for r in QUERIES["op5_token_counts"](spark, SMALL).collect()}
    for i, t in zip(documents.doc_id, documents.text, strict=True):
        n = len(sp.encode(t))
        assert got[i] == (i, len(t.encode()), n, n > 4096)


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    got = QUERIES["op7_packing"](spark, SMALL).toPandas()
    for i, t in zip(documents.doc_id, documents.text, strict=True):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in got[got.doc_id == i].sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sizes = got.groupby("sequence_id").length.sum()
    assert all(n == 2048 or n < 2048 and n & (n - 1) == 0 for n in sizes)


def test_near_vectors_have_full_recall(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    x = np.stack(rows.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & (rows.label.to_numpy()[:, None] == rows.label.to_numpy()[None, :])
    np.fill_diagonal(near, False)
    got = QUERIES["op8_embedding_near_dups"](spark, SMALL).toPandas().set_index("vec_id").loc[rows.vec_id]
    assert (got.n_links.to_numpy() == near.sum(1)).all()


def test_classifiers_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id").toxic
    got = QUERIES["op9_toxicity"](spark, folder).toPandas().set_index("doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.index]).all()
    held = got[got.held_out & got.index.isin(labels.index)]
    truth = labels.loc[held.index] == 1
    hit = held.predicted == 1
    assert (hit & truth).sum() / truth.sum() > 0.8 and (hit & ~truth).sum() / (~truth).sum() < 0.02
    lang = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id").lang
    got = QUERIES["op10_language_id"](spark, folder).toPandas().set_index("doc_id")
    held = got[got.held_out]
    assert (held.lang_pred == lang.loc[held.index]).mean() > 0.95


def test_pipeline_by_stage(spark, documents):
    """Every stage is run on what the one before it kept, and held against plain Python."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas().set_index("doc_id").toxic
    stages = dict(corpus_pipeline.STAGES)
    seen = {}
    for name in ("toxicity", "line_dedup", "ngram_jaccard", "mixing"):
        out = stages[name](spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = out.toPandas()
        docs = spark.createDataFrame(seen[name], docs.schema)
    clean = set(labels[labels == 0].index)
    kept = set(seen["toxicity"].doc_id)
    assert len(clean - kept) <= 0.02 * len(clean)

    before, first, want = seen["toxicity"].sort_values("doc_id"), {}, {}
    for i, t in zip(before.doc_id, before.text, strict=True):
        ls = t.split("\n")
        for p in range(len(ls) - 2):
            first.setdefault(tuple(ls[p : p + 3]), (i, p))
        gone = {p + k for p in range(len(ls) - 2) if first[tuple(ls[p : p + 3])] != (i, p) for k in range(3)}
        want[i] = "\n".join(x for k, x in enumerate(ls) if k not in gone)
    assert dict(zip(seen["line_dedup"].doc_id, seen["line_dedup"].text, strict=True)) == want
    assert (seen["line_dedup"].n_chars == seen["line_dedup"].text.str.len()).all()

    sets = {}
    for i, t in want.items():
        w = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    changed = True
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            m = min(comp[i], comp[j])
            changed |= comp[i] != m or comp[j] != m
            comp[i] = comp[j] = m
    assert set(seen["ngram_jaccard"].doc_id) == {i for i in comp if comp[i] == i}

    mixed = Counter(seen["mixing"].doc_id)
    assert set(mixed) <= set(seen["ngram_jaccard"].doc_id)
    packed = stages["packing"](spark, docs, SMALL).toPandas()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    text = dict(zip(seen["mixing"].doc_id, seen["mixing"].text, strict=True))
    total = {i: n * (len(tok.encode(text[i], add_special_tokens=False).ids) + 1) for i, n in mixed.items()}
    assert packed.groupby("doc_id").length.sum().to_dict() == total


def test_pipeline_runs_from_the_entry(spark):
    assert entry.queries()["pipeline"](spark, SMALL).count() > 100
